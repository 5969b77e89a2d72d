"""Writing traces, quarantined rows and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, single: bool = False) -> None:
    """UTF-8 JSON lines, null fields kept; a folder of parts, or of one part for small results."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _file(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_table(df: DataFrame, path: str) -> None:
    """The rows as Parquet in place of what was there.

    They are written beside it first, so a write that fails leaves the old rows
    as they were; then two renames swap the folders.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    path = path.rstrip("/")
    at, files = _file(spark, path)
    new, old = (_file(spark, f"{path}.{kind}-{mark}")[0] for kind in ("new", "old"))
    try:
        df.write.parquet(new.toString())
    except Exception:
        files.delete(new, True)
        raise
    if files.exists(at):
        files.rename(at, old)
    if not files.rename(new, at):
        raise OSError(f"{path} can't be replaced; its new rows are in {new.toString()}")
    files.delete(old, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small UTF-8 file on whatever file system the path names, written beside the old one and then renamed."""
    at, files = _file(spark, path)
    new, _ = _file(spark, f"{path}.new-{uuid.uuid4().hex}")
    stream = files.create(new, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    files.delete(at, False)
    files.rename(new, at)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    at, files = _file(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    at, files = _file(spark, path)
    files.delete(at, True)


def quarantine(invalid: DataFrame, folder: str, stage: str) -> None:
    """Invalid rows and their errors, one folder a stage."""
    invalid.withColumn("stage", F.lit(stage)).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/{stage}")


def report(counts: list[dict], name: str) -> str:
    """A run's counts as Markdown."""
    lines = [f"# {name}", "", "| stage | valid | invalid |", "|-|-|-|"]
    lines += [f"| {c['stage']} | {c['n_valid']} | {c['n_invalid']} |" for c in counts]
    total = {k: sum(c[k] for c in counts) for k in ("n_valid", "n_invalid")}
    return "\n".join([*lines, f"| total | {total['n_valid']} | {total['n_invalid']} |", ""])
