"""Rows checked against their stage: errors as data, invalid rows set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ROLES, STAGE_REQUIRED


def _error(loc: Column, kind: str, msg: Column) -> Column:
    return F.struct(loc.alias("loc"), F.lit(kind).alias("type"), msg.alias("msg"))


def _message_errors(name: str) -> Column:
    at = lambda i, f: F.array(F.lit(name), i.cast("string"), F.lit(f))
    each = F.transform(
        F.coalesce(F.col(name), F.array()),
        lambda m, i: F.array_compact(F.array(
            F.when(m["role"].isNull(), _error(at(i, "role"), "missing", F.lit("Field required")))
            .when(~m["role"].isin(*ROLES), _error(at(i, "role"), "value_error", F.concat(F.lit("Role must be known, got '"), m["role"], F.lit("'")))),
            F.when(m["content"].isNull(), _error(at(i, "content"), "missing", F.lit("Field required"))),
        )),
    )
    return F.flatten(each)


def with_errors(df: DataFrame, stage: str) -> DataFrame:
    """``df`` with errors: an array of (loc, type, msg), empty for valid rows.

    A required column that is absent is an error of every row.  A stage that is not known is a KeyError.
    """
    if not isinstance(df, DataFrame):
        raise TypeError("validation needs a DataFrame")
    required = STAGE_REQUIRED[stage]
    missing = [F.when(F.col(c).isNull() if c in df.columns else F.lit(True), _error(F.array(F.lit(c)), "missing", F.lit("Field required"))) for c in required]
    errors = F.array_compact(F.array(*missing))
    for name in ("messages", "original_messages"):
        if name in df.columns and (name in required or stage not in ("base", "sessionize")):
            errors = F.concat(errors, _message_errors(name))
    return df.withColumn("errors", errors)


def split_valid(df: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    checked = with_errors(df, stage)
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def validation_counts(df: DataFrame, stage: str) -> DataFrame:
    return with_errors(df, stage).agg(F.lit(stage).alias("stage"), F.count_if(F.size("errors") == 0).alias("n_valid"), F.count_if(F.size("errors") > 0).alias("n_invalid"))
