"""From extracted calls to training examples, and traces out of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_values import items, kind, text_at
from ..schemas import MESSAGES

#: The first message of every training example, the version of the schemas.
SYSTEM_PROMPT = "You are a helpful assistant."
SCHEMA_VERSION = "1.0"


def message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def to_examples(traces: DataFrame, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """{messages, completion} of each extracted call whose request parses.

    The system message comes first; a turn counts if it has a role and its first
    part a text; the role model becomes assistant; no response is an empty completion.
    """
    rows = traces.where(F.coalesce(F.col("request_full_json"), F.lit("")) != "").withColumn("_req", F.try_parse_json("request_full_json")).where(F.col("_req").isNotNull())
    turns = F.filter(
        F.transform(items(F.col("_req"), "$.contents"), lambda c: message(
            F.when(text_at(c, "$.role") == "model", "assistant").otherwise(text_at(c, "$.role")), text_at(c, "$.parts[0].text"))),
        lambda m: (F.coalesce(m["role"], F.lit("")) != "") & (F.coalesce(m["content"], F.lit("")) != ""),
    )
    usable = F.when(kind(F.col("_req")) == "OBJECT", turns).otherwise(F.slice(F.array(message(F.lit(""), F.lit(""))), 1, 0))
    messages = F.concat(F.array(message(F.lit("system"), F.lit(system_prompt))), usable).cast(MESSAGES)
    return rows.select(F.col("original_http_traffic_id").alias("ord"), messages.alias("messages"), F.coalesce("llm_response_text", F.lit("")).alias("completion"))


def add_trace_ids(examples: DataFrame, source: str = "base", ord_col: str = "ord") -> DataFrame:
    """trace_id from source and order, the same in every run, and the schema version; existing ones are replaced."""
    h = F.sha2(F.concat_ws(":", F.lit(source), F.col(ord_col).cast("string")), 256)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return examples.withColumn("trace_id", F.concat_ws("-", *parts)).withColumn("schema_version", F.lit(SCHEMA_VERSION))


def untranspose(value: Column) -> Column:
    """struct(role array, content array) as an array of messages; null where the lengths differ."""
    return F.when(F.size(value["role"]) == F.size(value["content"]), F.zip_with(value["role"], value["content"], message)).cast(MESSAGES)


def conversation_traces(conversations: DataFrame) -> DataFrame:
    """A trace for every assistant turn after the first: the turns before it, and its text as completion.

    Columns conv_id, turn, messages, completion; order by (conv_id, turn).
    """
    so_far = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    rows = conversations.withColumn("messages", F.collect_list(message(F.col("role"), F.col("text"))).over(so_far))
    return rows.where((F.col("role") == "assistant") & (F.size("messages") > 0)).select("conv_id", "turn", F.col("messages").cast(MESSAGES).alias("messages"), F.coalesce("text", F.lit("")).alias("completion"))


def by_name(df: DataFrame) -> DataFrame:
    """``df`` with the fields of message columns in their fixed order, whatever order a reader inferred.

    Message columns that hold an array for each field are turned into arrays of messages.
    """
    out = df
    for name in ("messages", "original_messages"):
        kind = df.schema[name].dataType if name in df.columns else None
        if isinstance(kind, T.StructType) and {"role", "content"} <= set(kind.names) and all(isinstance(kind[x].dataType, T.ArrayType) for x in ("role", "content")):
            out = out.withColumn(name, untranspose(F.col(name)))
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and {"role", "content"} <= set(kind.elementType.names):
            out = out.withColumn(name, F.transform(name, lambda m: message(m["role"], m["content"])).cast(MESSAGES))
    return out


def first_n(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first n rows in order; all of them for None, 0 or less."""
    return df.orderBy(*order).limit(n) if n and n > 0 else df
