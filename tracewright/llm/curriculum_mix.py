"""Mixing sources to target weights by a time-varying curriculum.

Each source gets a word target by water-filling.  A source's documents, in a
hashed order, are a stream that is read until the target is met, twice at most.
Integrating the source's weight schedule over training time and inverting it
turns a document's place in that stream into a training position, and documents
are range-sorted by position.  All in DataFrame expressions: running sums use
hash buckets inside a source, so that no source, however large, meets in one
task; only totals per source and bucket are ever ordered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settle, table, words

#: Sources by code point, null last, weigh these in turn.
WEIGHTS = (3, 1, 2)
#: Words to share, as a part of all words, and how often a source may be read.
SHARE, EPOCHS = 1.5, 2
#: Relative weight of a source over training time 0 to 1, by knots (time, weight), in turn as WEIGHTS.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))
#: Documents that a bucket of the running sum holds, about.
BUCKET_ROWS = 1_000


def _invert(schedule: tuple, done: Column) -> Column:
    """The time at which the integral of the schedule reaches this part of its whole."""
    pieces, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        pieces.append((t0, w0, (w1 - w0) / (t1 - t0), area, area := area + (w0 + w1) / 2 * (t1 - t0)))
    need = done * F.lit(area)
    out = None
    for t0, w0, slope, start, end in pieces:
        rest = need - F.lit(start)
        at = F.lit(t0) + rest * 2.0 / (F.lit(w0) + F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + rest * 2.0 * slope)))
        out = F.when(need <= end, at) if out is None else out.when(need <= end, at)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), out.otherwise(F.lit(1.0)))), 9)


def targets(narrow: DataFrame) -> DataFrame:
    """Per source: its words, its turn among WEIGHTS, its target.

    The targets are least(level * weight, EPOCHS * words), with the one level at
    which they add up to SHARE of all words; that is where handing the excess of
    capped sources to the others by weight ends.  One row per source: a mixture
    is set by source, so this table is small, but it is never sent to the driver.
    """
    per = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    per = per.withColumn("turn", (turn % len(WEIGHTS)).cast("int"))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("turn") + 1).cast("double"))
    per = per.withColumn("cap", (F.col("source_size") * EPOCHS).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.asc_nulls_last("source"))
    capped = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum("cap").over(capped), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(capped), F.lit(0.0))
    )
    per = per.withColumn("level", level)
    first = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    per = per.withColumn("target", F.least(F.col("cap"), F.coalesce(first * F.col("weight"), F.col("cap"))))
    return per.select("source", "source_size", "turn", "target")


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: size, its source's words and target, words taken, training positions.

    taken: the words that the mix reads of the document, over both passes; the
    last document of a source is cut where the target is met, so a source's taken
    words are its target rounded down.  position: training time from 0 to 1 of
    its first reading, null if it is never read; position_again: of the second.
    Rows come range-sorted by position, unread ones last.  A null text has size
    0; a null source is a source; repeated rows are read one after the other; an
    empty table gives an empty one.  ``carry``: further columns to keep.
    """
    text = F.col(text_col)
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.size(words(text)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))).alias("order_key"),
        *[F.col(c).alias(f"_carry_{c}") for c in carry],
    )
    narrow = settle(narrow)
    bits = min(20, max(4, math.ceil(math.log2(max(1, narrow.count()) / BUCKET_ROWS + 1))))
    narrow = narrow.withColumn("bucket", F.shiftright(F.conv(F.substring("order_key", 1, 5), 16, 10).cast("int"), 20 - bits))
    narrow = narrow.withColumn("skey", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))

    sums = narrow.groupBy("skey", "source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = targets(sums.select("source", F.col("bucket_size").alias("size"))).withColumn("skey", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")
    starts = sums.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).cast("long")).drop("bucket_size", "source").join(per, "skey")

    running = Window.partitionBy("skey", "bucket").orderBy("order_key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = narrow.withColumn("_running", F.sum("size").over(running)).join(starts, ["skey", "bucket"])
    at = F.col("bucket_start") + F.col("_running") - F.col("size")
    goal = F.floor("target").cast("long")
    part = lambda start: F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), goal - start))
    rows = rows.withColumns({"_start": at, "_first": part(at), "_again": part(F.col("source_size") + at)})

    def position(read: str, start: Column) -> Column:
        done = start / F.col("target")
        out = None
        for k, schedule in enumerate(SCHEDULES):
            here = (F.col(read) > 0) & (F.col("turn") == k)
            out = F.when(here, _invert(schedule, done)) if out is None else out.when(here, _invert(schedule, done))
        return out

    rows = rows.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("_first") + F.col("_again")).alias("taken"),
        position("_first", F.col("_start")).alias("position"),
        position("_again", F.col("source_size") + F.col("_start")).alias("position_again"),
        "order_key",
        *[F.col(f"_carry_{c}").alias(c) for c in carry],
    )
    return rows.orderBy(F.asc_nulls_last("position"), "order_key").drop("order_key")


def op5_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by the production weights and schedules."""
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "position", "position_again")


def _sql_position(read: str, start: str) -> str:
    arms = []
    for k, schedule in enumerate(SCHEDULES):
        area = 0.0
        spans = []
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
            spans.append((t0, w0, (w1 - w0) / (t1 - t0), area, area := area + (w0 + w1) / 2 * (t1 - t0)))
        for t0, w0, slope, low, high in spans:
            need = f"({start} / target * {area!r}::DOUBLE)"
            rest = f"({need} - {low!r}::DOUBLE)"
            arms.append(
                f"WHEN {read} > 0 AND turn = {k} AND {need} <= {high!r}::DOUBLE THEN round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, "
                f"{t0!r}::DOUBLE + {rest} * 2.0::DOUBLE / ({w0!r}::DOUBLE + sqrt(greatest(0.0::DOUBLE, {w0 * w0!r}::DOUBLE + {rest} * 2.0::DOUBLE * {slope!r}::DOUBLE))))), 9)"
            )
    return f"CASE {' '.join(arms)} END"


OP5_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT AS turn FROM d GROUP BY source
), w AS (SELECT *, [3.0, 1.0, 2.0][turn + 1]::DOUBLE AS weight, (2 * source_size)::DOUBLE AS cap FROM s
), l AS (
  SELECT *, cap / weight AS ratio,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, turn, least(cap, coalesce(weight * (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1), cap)) AS target FROM l
), r AS (
  SELECT doc_id, size, source_size, turn, target, k,
         (sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, least(size, greatest(0, floor(target)::BIGINT - start)) AS first, least(size, greatest(0, floor(target)::BIGINT - source_size - start)) AS again FROM r
)
SELECT doc_id, size, source_size, target, (first + again)::BIGINT AS taken,
       {_sql_position("first", "start")} AS position, {_sql_position("again", "(source_size + start)")} AS position_again
FROM p
"""
