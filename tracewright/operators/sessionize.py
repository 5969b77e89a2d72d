"""Sessions: runs of traces that each continue the one before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import number_rows, running_count
from .shape import by_name, message


def _print(messages: Column) -> Column:
    """A fingerprint of roles and contents; null contents differ from empty ones."""
    pairs = F.transform(messages, lambda m: F.struct(m["role"].alias("r"), m["content"].alias("c")))
    return F.sha2(F.to_json(pairs, {"ignoreNullFields": "false"}), 256)


def sessionize(traces: DataFrame, *order: str) -> DataFrame:
    """``traces`` with session_id and turn_in_session_id, in the given order.

    A trace continues the one right before it if its messages but the last are
    that one's messages and completion.  Traces without messages or completion are
    left out and break nothing.  Only fingerprints are ordered; no task sees all rows.
    """
    rows = by_name(traces).where(F.col("messages").isNotNull() & F.col("completion").isNotNull())
    n = F.size("messages")
    rows = rows.withColumns({
        "_context": _print(F.when(n > 1, F.slice("messages", 1, n - 1)).otherwise(F.slice("messages", 1, 0))),
        "_whole": _print(F.concat("messages", F.array(message(F.lit("assistant"), F.col("completion"))))),
    })
    numbered = number_rows(rows, *order, name="_idx")
    keys = numbered.select("_idx", "_context", "_whole")
    previous = keys.select((F.col("_idx") + 1).alias("_idx"), F.col("_whole").alias("_before"))
    keys = keys.join(previous, "_idx", "left").select("_idx", (~F.coalesce(F.col("_context") == F.col("_before"), F.lit(False))).alias("_new"))
    keys = running_count(keys, "_new", "_idx", "_session")
    turn = F.row_number().over(Window.partitionBy("_session").orderBy("_idx"))
    keys = keys.withColumn("turn_in_session_id", turn).withColumn("session_id", F.format_string("session_%03d", "_session")).select("_idx", "session_id", "turn_in_session_id")
    return numbered.join(keys, "_idx").drop("_idx", "_context", "_whole")


def longest_per_session(sessions: DataFrame, *order: str) -> DataFrame:
    """Each session's trace with most messages, the earliest of equals."""
    best = Window.partitionBy("session_id").orderBy(F.size("messages").desc(), *[F.asc(c) for c in order])
    return sessions.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")
