"""Text lines with their numbers, read by Spark (any file system, gzip included), without moving the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, paths: str | list[str], blocks_too: bool = False) -> DataFrame:
    """(file, line_no from 0, value), and with blocks_too the block that a line is read with. Globs are allowed.

    A row's place in its block is its running number in the partition less the block's first; how many lines the blocks
    before it have comes from one count per block, a table of a row per block.
    """
    raw = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).withColumn("m", F.monotonically_increasing_id())
    blocks = raw.groupBy("file", "block").agg(F.min("m").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return raw.join(blocks, ["file", "block"]).select("file", (F.col("m") - F.col("first") + F.col("before")).alias("line_no"), "value", *(["block"] if blocks_too else []))
