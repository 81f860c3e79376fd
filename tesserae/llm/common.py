"""What the corpus operators share: staging, word splitting and state of Python workers."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from tesserae.sources.shared import shared_folder

#: A word: a run of anything but space and the control characters 9 to 13 (what bytes.split() cuts at).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]"
#: Rows of an Arrow batch of texts, at most.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df into the shared folder and read it back: lineage ends here, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def n_words(text: Column) -> Column:
    """Count WORD matches: every word with the gap behind it becomes one mark, after the leading gap is cut."""
    led = F.regexp_replace(text, f"^{GAP}+", "")
    return F.length(F.regexp_replace(led, f"{WORD}{GAP}*+", "x")).cast("long")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value evaluated, and written into the plan, once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def map_texts(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """df.mapInArrow(run, schema), run being given batches of at most BATCH_ROWS rows: they hold whole texts, which may be long.

    Spark bounds the bytes of a batch that it sends (spark.sql.execution.arrow.maxBytesPerBatch); no setting is touched.
    """
    return df.mapInArrow(lambda batches: run(small_batches(batches)), schema)


def small_batches(batches: Iterable, rows: int = BATCH_ROWS) -> Iterator:
    for b in batches:
        yield from (b.slice(i, rows) for i in range(0, len(b), rows))


def column(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return _hashable(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def row_mark(df: DataFrame) -> Column:
    """A hash of a whole row, which with its key tells rows apart; rows alike in both are repeats (maps don't count)."""
    return F.xxhash64(F.lit(0), *[column(f.name) for f in df.schema.fields if _hashable(f.dataType)])


def worker_state(key: str, build):
    """State that one Python worker process keeps from task to task (caches, loaded tokenizers)."""
    store = sys.modules.setdefault("_tesserae_worker", types.ModuleType("_tesserae_worker")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]
