"""Reading traffic tables and JSON lines, with an explicit order and strict or lenient types."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checkpoints import number_rows
from ..schemas import HTTP_TRAFFIC


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None, limit: int | None = None, mode: str = "strict") -> DataFrame:
    """JSON lines with ``ord``, the order of files and lines.

    strict: a line that is not JSON, or whose value has another type than the
    schema says, fails the read.  lenient: such lines are left out.  A missing
    path is a FileNotFoundError; an empty file has no rows.  limit: the first so
    many, all for None, 0 or less.
    """
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    strict = mode == "strict"
    if schema is None:
        schema = spark.read.option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path).schema
        if not schema.fields:
            return spark.createDataFrame([], T.StructType([T.StructField("ord", T.LongType())]))
    # the lines are read once: parsed, judged and numbered before the settled rows are asked for bad ones
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = spark.read.text(path).select("value", place.alias("_place")).where(F.col("value").rlike(r"\S"))
    shape = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = rows.withColumn("_line", F.from_json("value", shape, {"columnNameOfCorruptRecord": _CORRUPT}))
    broken = F.col("_line").isNull() | F.col("_line").getField(_CORRUPT).isNotNull()
    rows = rows.withColumn("_bad", broken | _other_type(F.try_parse_json("value"), schema)) if strict else rows.where(~broken)
    fields = [F.col("_line").getField(f.name).alias(f.name) for f in schema.fields]
    out = number_rows(rows.select("_place", *["_bad"] * strict, *fields), "_place", name="ord").drop("_place")
    if strict:
        if out.where("_bad").limit(1).count():
            raise ValueError(f"{path}: a line is not JSON or has a value of another type than its field")
        out = out.drop("_bad")
    return out.where(F.col("ord") < limit) if limit and limit > 0 else out


_CORRUPT = "_tracewright_corrupt"


def _other_type(line: Column, schema: T.StructType) -> Column:
    """Is the line no JSON, or a top-level value of another kind than its field?  Numbers are no strings here."""
    wanted = {T.StringType: "STRING", T.LongType: "BIGINT", T.IntegerType: "BIGINT", T.BooleanType: "BOOLEAN", T.ArrayType: "ARRAY", T.StructType: "OBJECT"}
    bad = line.isNull()
    for field in schema.fields:
        kind = wanted.get(type(field.dataType))
        if kind and field.name != "ord":
            value = F.try_variant_get(line, f"$['{field.name}']", "variant")
            got = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
            bad = bad | F.coalesce(~got.isin(kind, "VOID"), F.lit(False))
    return bad


def read_traffic(spark: SparkSession, path: str) -> DataFrame:
    """Captured traffic as Parquet, in the schema of the capture."""
    return spark.read.schema(HTTP_TRAFFIC).parquet(path)


def read_sqlite(spark: SparkSession, database: str, name: str, schema: T.StructType, key: str = "id", slice_rows: int = 50_000) -> DataFrame:
    """A SQLite table by ranges of its integer key, each range read by a task; the file must be on a shared path."""
    with sqlite3.connect(f"file:{database}?mode=ro", uri=True) as db:
        low, high = db.execute(f'SELECT min("{key}"), max("{key}") FROM "{name}"').fetchone()
    if low is None:
        return spark.createDataFrame([], schema)
    ranges = spark.range(low, high + 1, slice_rows, numPartitions=max(1, (high - low) // slice_rows + 1))
    columns = ", ".join(f'"{f.name}"' for f in schema.fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with sqlite3.connect(f"file:{database}?mode=ro", uri=True) as db:
            for batch in batches:
                for start in batch.column(0).to_pylist():
                    cursor = db.execute(f'SELECT {columns} FROM "{name}" WHERE "{key}" >= ? AND "{key}" < ? ORDER BY "{key}"', (start, start + slice_rows))
                    while rows := cursor.fetchmany(1000):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow)

    return ranges.mapInArrow(run, schema)


def browse(df: DataFrame, n: int = 5, preview: int = 40) -> DataFrame:
    """The first rows, binary columns as the start of their hex."""
    return df.limit(n).select(*[F.hex(F.substring(f.name, 1, preview)).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name) for f in df.schema.fields])


def sqlite_catalog(database: str) -> dict[str, list[tuple[str, str]]]:
    """Every table of a SQLite file with its columns and their declared types; a file that is none is a ValueError."""
    try:
        with sqlite3.connect(f"file:{database}?mode=ro", uri=True) as db:
            names = [n for (n,) in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
            return {n: [(c[1], c[2]) for c in db.execute(f'PRAGMA table_info("{n}")')] for n in names}
    except sqlite3.DatabaseError as e:
        raise ValueError(f"{database} can't be read as SQLite: {e}") from e


def has_table(database: str, name: str) -> bool:
    return name in sqlite_catalog(database)


def summary(df: DataFrame) -> DataFrame:
    """A row a column: name, type, and how many rows have a value in it, of how many."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kind).alias("type"), F.col(f"_n{i}").alias("n_values"), F.col("_rows").alias("n_rows")) for i, (c, kind) in enumerate(df.dtypes)])
    return counts.select(F.inline(each))


def sample_calls(traffic: DataFrame, targets: tuple[str, ...], n: int = 1, preview: int = 2000) -> DataFrame:
    """The first n calls to the hosts by id: url, status, and the start of both bodies, decoded as far as they are UTF-8."""
    from ..operators.extract import host_matches, lenient

    rows = traffic.where(host_matches(lenient(F.col("request_host")), targets)).orderBy("id").limit(n)
    body = lambda c: F.substring(lenient(F.col(c)), 1, preview).alias(c)
    return rows.select("id", lenient(F.col("request_url")).alias("request_url"), "response_status_code", body("request_content"), body("response_content"))
