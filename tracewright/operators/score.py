"""Heuristic complexity of traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import COMPLEXITY_KEYWORDS, keyword_hits

CAP = 25


def score_complexity(traces: DataFrame, keywords=COMPLEXITY_KEYWORDS) -> DataFrame:
    """``traces`` with complexity_score (0 to 100), its parts in complexity_reasoning, and null model columns.

    Null messages count as none, null contents and completions as empty.
    """
    contents = F.transform(F.coalesce("messages", F.array()), lambda m: F.coalesce(m["content"], F.lit("")))
    completion = F.coalesce("completion", F.lit(""))
    turns = F.least(F.greatest(F.size("messages"), F.lit(0)) * 2, F.lit(CAP))
    length = F.least(F.floor(F.aggregate(contents, F.lit(0), lambda a, c: a + F.length(c)) / 100), F.lit(CAP))
    answer = F.least(F.floor(F.length(completion) / 75), F.lit(CAP))
    words = F.least(keyword_hits(F.concat(F.array_join(contents, " "), F.lit(" "), completion), keywords) * 2, F.lit(CAP))
    out = traces.withColumns({"_t": turns.cast("long"), "_m": length.cast("long"), "_c": answer.cast("long"), "_k": words.cast("long")})
    out = out.withColumns({
        "complexity_score": (F.col("_t") + F.col("_m") + F.col("_c") + F.col("_k")).cast("double"),
        "complexity_reasoning": F.format_string("Heuristic - (Turns: %d; MsgLen: %d; CompLen: %d; Keywords: %d)", "_t", "_m", "_c", "_k"),
    }).drop("_t", "_m", "_c", "_k")
    for name, kind in (("llm_complexity_score", "double"), ("llm_complexity_rationale", "string")):
        if name not in traces.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    return out


def score_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("n"), F.round(F.avg("complexity_score"), 2).alias("avg_score"), F.min("complexity_score").alias("min_score"), F.max("complexity_score").alias("max_score"))
