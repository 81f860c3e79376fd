"""Streams: new record files as they arrive, first-seen molecules, running counts.

Exact distinct counts don't exist on streams; molecules are deduplicated with state first, then counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.sources.sequences import parse_sam


def stream_sam(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """Alignments of SAM text files that appear in a folder, with their time of arrival."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return lines.filter(~F.col("value").startswith("@")).select(*parse_sam(F.col("value")), F.current_timestamp().alias("arrived"))


def stream_table(spark: SparkSession, folder: str, schema, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_seen_stream(df: DataFrame, key: list[str], time: str = "arrived", within: str | None = "1 hour") -> DataFrame:
    """Rows whose key is new, within a time behind the watermark (None: for ever, with state that grows)."""
    return df.dropDuplicates(key) if within is None else df.withWatermark(time, within).dropDuplicatesWithinWatermark(key)


def running_molecules(df: DataFrame, cell: str, gene: str) -> DataFrame:
    """Molecules per cell and gene of a stream that is free of duplicates (update or complete mode)."""
    return df.groupBy(F.col(cell).alias("cell"), F.col(gene).alias("gene")).agg(F.count("*").alias("umis"))


def approximate_molecules(df: DataFrame, cell: str, gene: str, umi: str, error: float = 0.02) -> DataFrame:
    """Approximate distinct molecules per cell and gene, in update mode, in bounded state per group."""
    return df.groupBy(F.col(cell).alias("cell"), F.col(gene).alias("gene")).agg(F.approx_count_distinct(umi, error).alias("umis"))


def windowed_counts(df: DataFrame, time: str, size: str, by: list[str], late: str = "10 minutes") -> DataFrame:
    """Counts per event-time window with a watermark for late rows."""
    return df.withWatermark(time, late).groupBy(F.window(time, size), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")
