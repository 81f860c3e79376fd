"""Tiles, stitching, meshes, rasters, neighbourhoods: embeddings and customers as spots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.operators import mesh, tiles, tissue
from tesserae.plans.common import POINTS_SQL, points, table
from tesserae.registry import query

_TILES = "SELECT c_nationkey AS tile, c_custkey AS bc, c_acctbal AS x, (c_custkey % 97)::DOUBLE AS y FROM customer"


def customer_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("puck_id"), F.col("c_custkey").alias("cell_bc"), F.col("c_acctbal").alias("x_pos"), (F.col("c_custkey") % 97).cast("double").alias("y_pos"))


@query(f"""
WITH t AS ({_TILES}), q AS (SELECT DISTINCT o_custkey AS bc FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT tile, count(*) AS n_barcodes, count(q.bc) AS n_matching, min(x) AS x_pos_min_px, max(x) AS x_pos_max_px, min(y) AS y_pos_min_px, max(y) AS y_pos_max_px,
       round(count(q.bc) / count(*), 6) AS matching_ratio, count(q.bc) / count(*) > 0.7 AS pass_threshold FROM t LEFT JOIN q USING (bc) GROUP BY tile
""")
def tile_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    out = tiles.tile_matches(customer_tiles(spark, sf_dir), q, by="o_custkey", threshold=0.7)
    return out.withColumn("matching_ratio", F.round("matching_ratio", 6))


@query(f"""
WITH t AS ({_TILES}), q AS (SELECT DISTINCT o_custkey AS bc FROM orders), m AS (SELECT tile, count(*) AS n, count(q.bc) AS k, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM t LEFT JOIN q USING (bc) GROUP BY tile)
SELECT min(x0) AS x_pos_min_px, max(x1) AS x_pos_max_px, min(y0) AS y_pos_min_px, max(y1) AS y_pos_max_px, round(avg(n), 6) AS n_barcodes, round(avg(k), 6) AS n_matching, round(avg(k / n), 6) AS matching_ratio FROM m
""")
def tile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = tiles.tile_matches(customer_tiles(spark, sf_dir), table(spark, sf_dir, "orders"), by="o_custkey")
    return tiles.tile_summary(m).withColumns({c: F.round(c, 6) for c in ("n_barcodes", "n_matching", "matching_ratio")})


@query(f"WITH t AS ({_TILES}) SELECT bc AS cell_bc, x AS x_pos, y AS y_pos FROM t WHERE bc IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def matched_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "orders").filter("o_totalprice > 400000")
    return tiles.matched_rows(customer_tiles(spark, sf_dir), q, by="o_custkey").select("cell_bc", "x_pos", "y_pos")


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) SELECT o_custkey, o_orderkey, o_totalprice FROM o WHERE n = 1
""")
def first_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.keep_first(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("SELECT o_orderkey, c_custkey, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000")
def located_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return tiles.with_coordinates(cells, table(spark, sf_dir, "customer").filter("c_acctbal > 5000").select("c_custkey", "c_acctbal"), "c_custkey")


@query(f"""
WITH t AS ({_TILES}) SELECT bc::VARCHAR || ':' || tile AS cell_bc, tile AS puck_id, x + tile % 5 * 1000 AS x_pos, y + tile // 5 * 1000 AS y_pos FROM t
""")
def stitched_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = customer_tiles(spark, sf_dir).withColumn("cell_bc", F.col("cell_bc").cast("string"))
    to = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("puck_id"), (F.col("n_nationkey") % 5 * 1000).alias("x_offset"), (F.floor(F.col("n_nationkey") / 5) * 1000).alias("y_offset"))
    return tiles.stitched(spots, to)


@query("""
SELECT 'L' || l || CASE WHEN s = 1 THEN 'a' ELSE 'b' END || '_tile_' || s || lpad(c::VARCHAR, 2, '0') || lpad(r::VARCHAR, 2, '0') AS puck_id, c * 33000 AS x_offset, r * 37000 + (CASE WHEN s = 1 THEN -1 ELSE 1 END) * (CASE WHEN c % 2 = 1 THEN 6201 ELSE 0 END) AS y_offset, 0::BIGINT AS z_offset
FROM range(1, 5) a(l), range(1, 3) b(s), range(1, 7) d(c), range(1, 79) e(r)
""")
def flow_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.coordinate_system(spark, 4, 6, 78, 33000, 37000, 6201, 0)


@query(f"""
WITH p AS ({POINTS_SQL}) SELECT min(x_pos) AS x0, max(x_pos) AS x1, min(y_pos) AS y0, max(y_pos) AS y1, (max(x_pos) - min(x_pos)) / 1000 AS coord_by_um, 1000.0::DOUBLE AS width_um, floor((max(y_pos) - min(y_pos)) / ((max(x_pos) - min(x_pos)) / 1000))::BIGINT AS height_um FROM p
""")
def puck_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.puck_geometry(points(spark, sf_dir), 1000)


LATTICE = mesh.Lattice(24, 14, -3.0, 3.0, -3.0, 3.0, True)


def _hexagons_sql(lattice: mesh.Lattice) -> str:
    (sx, sy), left = lattice.step, lattice.x0 - lattice.pad
    n1, m1 = lattice.nx + 1, lattice.rows1
    return f"""
i AS (SELECT *, (x_pos - ({left!r})) / {sx!r} AS ix, (y_pos - ({lattice.y0!r})) / {sy!r} AS iy FROM p),
  j AS (SELECT *, round_even(ix, 0) AS i1, round_even(iy, 0) AS j1, floor(ix) AS i2, floor(iy) AS j2 FROM i),
  d AS (SELECT *, (ix - i1) * (ix - i1) + 3.0 * (iy - j1) * (iy - j1) < (ix - i2 - 0.5) * (ix - i2 - 0.5) + 3.0 * (iy - j2 - 0.5) * (iy - j2 - 0.5) AS one FROM j),
  u AS (SELECT *, CASE WHEN one AND i1 >= 0 AND i1 < {n1} AND j1 >= 0 AND j1 < {m1} THEN (i1 * {m1} + j1)::BIGINT
    WHEN NOT one AND i2 >= 0 AND i2 < {lattice.nx} AND j2 >= 0 AND j2 < {lattice.ny} THEN (i2 * {lattice.ny} + j2 + {n1 * m1})::BIGINT END AS unit FROM d),
  h AS (SELECT *, (CASE WHEN one THEN i1 ELSE i2 + 0.5 END) * {sx!r} + ({left!r}) AS cx, (CASE WHEN one THEN j1 ELSE j2 + 0.5 END) * {sy!r} + ({lattice.y0!r}) AS cy FROM u WHERE unit IS NOT NULL)"""


@query(f"WITH p AS ({POINTS_SQL}), {_hexagons_sql(LATTICE)} SELECT cell_bc, unit, round(cx, 6) AS cx, round(cy, 6) AS cy FROM h")
def hexagon_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = points(spark, sf_dir).select("cell_bc", mesh.hexagon_of(F.col("x_pos"), F.col("y_pos"), LATTICE).alias("h"))
    return h.select("cell_bc", "h.*").filter("unit IS NOT NULL").withColumns({"cx": F.round("cx", 6), "cy": F.round("cy", 6)})


@query(f"""
WITH p AS ({POINTS_SQL}), {_hexagons_sql(LATTICE)}
SELECT unit, count(*) AS n_joined, sum(puck_id)::BIGINT AS total_counts, round(avg(x_pos), 6) AS x_mean, trunc(avg(puck_id))::BIGINT AS compression FROM h WHERE sqrt((x_pos - cx) * (x_pos - cx) + (y_pos - cy) * (y_pos - cy)) < 0.1 GROUP BY unit
""")
def circle_mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = mesh.placed(points(spark, sf_dir), LATTICE, 0.1)
    own = inside.withColumns({"total_counts": F.col("puck_id").cast("long"), "x_mean": F.col("x_pos"), "compression": F.col("puck_id")})
    return mesh.mesh_metrics(own, ["total_counts"], ["x_mean"], ["compression"]).drop("cx", "cy").withColumn("x_mean", F.round("x_mean", 6))


@query(f"""
WITH p AS ({POINTS_SQL}), {_hexagons_sql(LATTICE)}, c AS (SELECT l_suppkey % 500 AS cell, l_returnflag AS gene, count(DISTINCT l_orderkey) AS umis, count(*) AS reads FROM lineitem GROUP BY ALL)
SELECT unit, gene, sum(umis)::BIGINT AS umis, sum(reads)::BIGINT AS reads FROM c JOIN h ON cell = cell_bc GROUP BY ALL
""")
def mesh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.operators.counts import molecule_counts

    line = table(spark, sf_dir, "lineitem").withColumn("c", F.col("l_suppkey") % 500)
    c = molecule_counts(line, "c", "l_returnflag", "l_orderkey")
    h = points(spark, sf_dir).select(F.col("cell_bc").alias("cell"), mesh.hexagon_of(F.col("x_pos"), F.col("y_pos"), LATTICE).alias("h")).select("cell", "h.unit").filter("unit IS NOT NULL")
    return mesh.mesh_counts(h, c)


@query("""
WITH a AS (SELECT 27.5 + i * 100.0 AS x, 27.5 + j * 100.0 * sqrt(3) AS y FROM range(0, 11) t(i), range(0, 7) s(j)) SELECT round(x, 6) AS x, round(y, 6) AS y FROM a WHERE x < 1055 AND y < 1055
""")
def mesh_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.mesh_points(spark, 1000, 1000, 55, 100, 27.5, 27.5).select(F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(f"WITH p AS ({POINTS_SQL}) SELECT floor(x_pos / 0.25)::BIGINT AS px, floor(y_pos / 0.25)::BIGINT AS py, sum(puck_id + 1)::BIGINT AS value FROM p GROUP BY ALL")
def expression_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.raster(points(spark, sf_dir).withColumn("v", (F.col("puck_id") + 1).cast("long")), 0.25, "v")


@query(f"""
WITH p AS ({POINTS_SQL}) SELECT a.cell_bc AS a, b.cell_bc AS b, round(sqrt((a.x_pos - b.x_pos) * (a.x_pos - b.x_pos) + (a.y_pos - b.y_pos) * (a.y_pos - b.y_pos)), 6) AS distance FROM p a JOIN p b ON a.cell_bc < b.cell_bc
WHERE sqrt((a.x_pos - b.x_pos) * (a.x_pos - b.x_pos) + (a.y_pos - b.y_pos) * (a.y_pos - b.y_pos)) < 0.1 AND sqrt((a.x_pos - b.x_pos) * (a.x_pos - b.x_pos) + (a.y_pos - b.y_pos) * (a.y_pos - b.y_pos)) > 0.01
""")
def neighbour_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tissue.neighbours(points(spark, sf_dir), 0.1, 0.01).withColumn("distance", F.round("distance", 6))


@query(f"""
WITH RECURSIVE p AS ({POINTS_SQL}), low AS (SELECT * FROM p WHERE puck_id < 4),
  e AS (SELECT a.cell_bc AS a, b.cell_bc AS b FROM low a JOIN low b ON a.cell_bc <> b.cell_bc AND (a.x_pos - b.x_pos) * (a.x_pos - b.x_pos) + (a.y_pos - b.y_pos) * (a.y_pos - b.y_pos) < 0.04),
  r(node, seen) AS (SELECT cell_bc, cell_bc FROM low UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
  c AS (SELECT node, min(seen) AS island FROM r GROUP BY 1), big AS (SELECT island FROM c GROUP BY 1 ORDER BY count(*) DESC, island LIMIT 1)
SELECT cell_bc, puck_id FROM p WHERE puck_id >= 4 OR cell_bc IN (SELECT node FROM c WHERE island NOT IN (SELECT island FROM big))
""")
def tissue_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tissue.tissue(points(spark, sf_dir), 4, 0.2, value="puck_id").select("cell_bc", "puck_id")


@query(f"""
WITH p AS ({POINTS_SQL}), {_hexagons_sql(LATTICE)}, c AS (SELECT DISTINCT unit, cx, cy FROM h),
  far AS (SELECT p.cell_bc AS point, c.unit, sqrt((x_pos - cx) * (x_pos - cx) + (y_pos - cy) * (y_pos - cy)) AS distance FROM p, c)
SELECT point, arg_min(unit, distance) AS unit, round(min(distance), 6) AS distance FROM far WHERE distance < 0.25 GROUP BY 1
""")
def nearest_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir).select(F.col("cell_bc").alias("point"), F.col("x_pos").alias("x"), F.col("y_pos").alias("y"))
    c = p.select(mesh.hexagon_of(F.col("x"), F.col("y"), LATTICE).alias("h")).select("h.*").filter("unit IS NOT NULL").distinct()
    return tissue.nearest(p, c, 0.25).withColumn("distance", F.round("distance", 6))


MESH = mesh.mesh_lattice(6.0, 6.0, 0.4 * mesh.ROOT3, 0.4 * mesh.ROOT3)


@query(f"WITH p AS (SELECT cell_bc, x_pos + 3 AS x_pos, y_pos + 3 AS y_pos FROM ({POINTS_SQL})), {_hexagons_sql(MESH)} SELECT unit, count(*) AS n FROM h GROUP BY 1")
def hexagon_mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mesh of hexagons leaves no holes: spots by unit."""
    p = points(spark, sf_dir).withColumns({"x_pos": F.col("x_pos") + 3, "y_pos": F.col("y_pos") + 3})
    return mesh.placed(p, MESH).groupBy("unit").agg(F.count("*").alias("n"))


@query(f"""
WITH p AS ({POINTS_SQL}), r AS (SELECT floor(x_pos / 0.25)::BIGINT AS px, floor(y_pos / 0.25)::BIGINT AS py, sum(puck_id + 1)::BIGINT AS value FROM p GROUP BY ALL), c AS (SELECT quantile_cont(value, 0.7) AS c FROM r),
  i AS (SELECT px, py, value >= c AS on_ FROM r, c), v AS (SELECT px + dx AS px, py + dy AS py, count(*) AS votes FROM i, range(-1, 2) a(dx), range(-1, 2) b(dy) WHERE on_ AND (dx <> 0 OR dy <> 0) GROUP BY ALL)
SELECT px, py, on_ AS "on", on_ OR coalesce(votes, 0) >= 3 AS filled FROM i LEFT JOIN v USING (px, py)
""")
def filled_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of most expression, and holes among them filled."""
    r = mesh.raster(points(spark, sf_dir).withColumn("v", (F.col("puck_id") + 1).cast("long")), 0.25, "v")
    on = mesh.thresholded(r, 30).select("px", "py", "on")
    return on.join(mesh.filled(on).withColumnRenamed("on", "filled"), ["px", "py"])


@query("SELECT c_custkey, (c_acctbal - 10) * 0.5 AS x_pos, ((c_custkey % 97)::DOUBLE - 20) * 0.5 AS y_pos FROM customer")
def image_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.image_coordinates(customer_tiles(spark, sf_dir), 0.5, 10.0, 20.0).select(F.col("cell_bc").alias("c_custkey"), "x_pos", "y_pos")


#: Barcodes of customers: a run of one base, and for some the end of a reversed primer or the placeholder.
BARCODES_SQL = """SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'TAG=XC' ELSE 'GATC' || repeat(substr('ACGT', (c_custkey % 4 + 1)::INTEGER, 1), (c_custkey // 4 % 12)::INTEGER) || CASE WHEN c_custkey % 7 = 0 THEN 'NTTGGCCAA' WHEN c_custkey % 7 = 1 THEN 'NTTG' ELSE 'N' END END AS cell_bc FROM customer"""


@query(f"""
WITH b AS ({BARCODES_SQL})
SELECT c_custkey, cell_bc FROM b WHERE cell_bc <> 'TAG=XC' AND NOT contains(cell_bc, 'TTTTTT') AND NOT contains(cell_bc, 'AAAAAAAA') AND NOT contains(cell_bc, 'CCCCCCCC') AND NOT contains(cell_bc, 'GGGGGGGG') AND c_custkey % 7 <> 0
""")
def clean_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Homopolymers, the placeholder and what shares more than six bases with the reversed primer go."""
    k = F.col("c_custkey")
    run = F.repeat(F.substr(F.lit("ACGT"), (k % 4 + 1).cast("int"), F.lit(1)), (F.floor(k / 4) % 12).cast("int"))
    end = F.when(k % 7 == 0, "NTTGGCCAA").when(k % 7 == 1, "NTTG").otherwise("N")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 50 == 0, "TAG=XC").otherwise(F.concat(F.lit("GATC"), run, end)).alias("cell_bc"))
    return tiles.clean_barcodes(c, "AACCGGTT")


@query("""
WITH e AS (SELECT min(c_acctbal) AS x0, max(c_acctbal) AS x1 FROM customer), a AS (SELECT *, CASE WHEN x1 - x0 < 3000 THEN 2 ELSE 3 END AS digits, greatest(pow(10.0, digits), round((x1 - x0) / 3, digits)) AS apart FROM e)
SELECT i::BIGINT AS i, round(x0 + i * apart, 6) AS mark, format('{:.1f} mm', round_even(i * apart / 1000, 1)) AS label FROM a, range(0, 100) t(i) WHERE x0 + i * apart < x1
""")
def map_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tiles.map_scales(customer_tiles(spark, sf_dir))
    return spark.createDataFrame([(i, round(m, 6), t) for i, (m, t) in enumerate(zip(s["x"], s["x_labels"], strict=True))], "i long, mark double, label string")
