"""Semi-structured values: guarded access to VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANTS = "array<variant>"


def kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, ... of a variant's top; null for a missing one."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def items(value: Column, path: str) -> Column:
    """The array at a path as array<variant>, empty if there is none."""
    return F.coalesce(F.try_variant_get(value, path, VARIANTS), F.expr(f"cast(array() as {VARIANTS})"))


def text_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def parts_text(value: Column, path: str = "$.parts") -> Column:
    """The texts of all parts that have one, joined."""
    return F.array_join(F.filter(F.transform(items(value, path), lambda p: text_at(p, "$.text")), lambda x: x.isNotNull()), "")
