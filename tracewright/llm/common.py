"""What several operators share: word splitting, tables, bounded filters."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import checkpoint_folder, release, settle

__all__ = ["BATCH_BYTES", "BATCH_ROWS", "SPACE", "give_back", "lean", "let", "release", "settle", "shared_folder", "small", "small_batches", "table", "words"]

#: ASCII white space, the separators of words: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
_SPACE_SQL = "concat(' ', char(9), char(10), char(11), char(12), char(13))"
#: Bytes and rows of an Arrow batch: texts meet the first limit, numbers the second.
BATCH_BYTES, BATCH_ROWS = 16 << 20, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null and blank texts have none."""
    bare = F.call_function("btrim", F.coalesce(text, F.lit("")), F.expr(_SPACE_SQL))
    return F.when(bare == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(bare, SPACE))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def small_batches(spark: SparkSession) -> None:
    """Bound what an Arrow batch of long texts can hold in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Have the allocators of this process return free memory to the system, those that can (Arrow's, glibc's)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # another C library


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, after which its worker gives free memory back.

    Spark keeps workers for later tasks.  Left to their allocators, they hold the most
    that any task has needed, beside the executor's JVM, while they wait.
    """

    @functools.wraps(run)
    def given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return given_back


#: Rows of ids or keys that may be broadcast: some 130 bytes each in a hash table, 33 MB together.
BROADCAST_ROWS = 250_000


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is counted and has BROADCAST_ROWS at most, else itself; settle it first."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the checkpoint folder, as a URI that all executors reach."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"
