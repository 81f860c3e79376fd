"""Readers of the tables that the registered queries run over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as records: cell, gene and molecule."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("cell"), F.col("event_type").alias("gene"), F.get_json_object("props", "$.k").cast("long").alias("umi"), "event_id", "ts", "value")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as spots: the first two components as coordinates."""
    e = table(spark, sf_dir, "embeddings")
    x = lambda i: F.get("embedding", F.lit(i)).cast("double")
    return e.select(F.col("vec_id").alias("cell_bc"), x(0).alias("x_pos"), x(1).alias("y_pos"), F.col("label").alias("puck_id"))


POINTS_SQL = "SELECT vec_id AS cell_bc, embedding[1]::DOUBLE AS x_pos, embedding[2]::DOUBLE AS y_pos, label AS puck_id FROM embeddings"
MOLECULES_SQL = "SELECT user_id AS cell, event_type AS gene, CAST(json_extract_string(props, '$.k') AS BIGINT) AS umi, event_id, ts, value FROM events"
