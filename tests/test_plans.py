"""What Spark makes of the queries: joins, pruning, top-k, no row-at-a-time Python."""

import pytest

from tesserae import registry
from tesserae.__main__ import main

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = registry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_nested_loops(spark, name):
    text = plan(spark, name)
    assert "BatchEvalPython" not in text
    if name != "flow_cell":  # an outer product of four short ranges
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_shapes(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_barcodes")
    assert "ReadSchema: struct<user_id:bigint>" in plan(spark, "tag_histogram")
    text = plan(spark, "skimmed")
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in text and "Exchange" not in text
    assert "Join" not in plan(spark, "hexagon_bins") and "Exchange" not in plan(spark, "hexagon_bins")
    assert plan(spark, "dge_cell_metrics").count("Exchange") <= 4
    assert "PushedFilters: [IsNotNull(o_orderpriority)" in plan(spark, "tile_matches")


def test_cli(spark, capsys, tmp_path):
    main(["list"])
    assert "tag_histogram" in capsys.readouterr().out
    main(["strategy", "bowtie2:rRNA->STAR:genome"])
    assert "final = genome.STAR" in capsys.readouterr().out
    main(["run", "tag_histogram", SF, str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
