"""Redaction by ordered patterns, and its summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import REDACTIONS, redact, replaced
from ..schemas import MESSAGES

LEGACY = ("anonymized_messages", "anonymized_completion", "sensitive_patterns_found")


def redact_text(df: DataFrame, text_col: str, rules=REDACTIONS) -> DataFrame:
    """``df`` with redacted and patterns_found (in rule order) of a text column; a projection for each rule, all inside generated code.

    The two come out of an array of one struct: a filter on either, also one that
    Spark infers, stops there.  Pushed below the projections it would be written out
    in terms of the text, and each rule names its input several times.
    """
    steps, result = [f"_tracewright_{k}" for k in range(len(rules) + 1)], "_tracewright_result"
    out = df.withColumn(steps[0], F.col(text_col))
    for k, (name, pattern, placeholder) in enumerate(rules):
        out = out.withColumn(steps[k + 1], replaced(F.col(steps[k]), name, pattern, placeholder))
    found = F.array_compact(F.array(*[F.when(F.col(steps[k + 1]) != F.col(steps[k]), F.lit(rule[0])) for k, rule in enumerate(rules)]).cast("array<string>"))
    out = out.withColumn(result, F.explode(F.array(F.struct(F.col(steps[-1]).alias("redacted"), found.alias("patterns_found")))))
    return out.withColumns({"redacted": F.col(f"{result}.redacted"), "patterns_found": F.col(f"{result}.patterns_found")}).drop(result, *steps)


def redact_traces(traces: DataFrame, rules=REDACTIONS) -> DataFrame:
    """Messages and completion redacted; originals kept where they changed, null elsewhere; sorted pattern names."""
    out = traces.withColumns({
        "_m": F.transform("messages", lambda m: F.struct(m["role"].alias("role"), redact(m["content"], rules).alias("r"))),
        "_c": redact(F.col("completion"), rules),
    })
    changed = F.exists("_m", lambda m: F.size(m["r"]["found"]) > 0)
    found = F.array_sort(F.array_distinct(F.concat(F.flatten(F.coalesce(F.transform("_m", lambda m: m["r"]["found"]), F.array())), F.col("_c.found"))))
    out = out.withColumns({
        "original_messages": F.when(changed, F.col("messages")).cast(MESSAGES),
        "original_completion": F.when(F.col("_c.text") != F.col("completion"), F.col("completion")),
        "anonymization_details": F.struct(found.alias("regex_patterns_found")),
    })
    out = out.withColumns({"messages": F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["r"]["text"].alias("content"))).cast(MESSAGES), "completion": F.col("_c.text")})
    return out.drop("_m", "_c", *LEGACY)


def pattern_summary(found: DataFrame, found_col: str = "patterns_found") -> DataFrame:
    """Rows with each pattern, by name."""
    return found.select(F.explode(found_col).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n_rows")).orderBy("pattern")
