"""Stages that ask a language model, behind a client protocol.

A client is made in each worker by a factory and answers one prompt at a time; a
pool of threads per task overlaps the waiting.  Everything before and after the
call is columns: chunking, collecting, replacing, parsing of replies.
"""

from __future__ import annotations

import json
import re
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checkpoints import settle
from ..functions.text import chunks, is_blank, replace_items
from ..schemas import MESSAGES, PII_ITEM

#: Categories of sensitive text.
CATEGORIES = (
    "PERSON_NAME", "ORGANIZATION_NAME", "LOCATION_ADDRESS", "PHONE_NUMBER", "EMAIL_ADDRESS", "USER_ID_USERNAME",
    "PASSWORD_CREDENTIAL", "API_KEY_SECRET", "FINANCIAL_INFO", "HEALTH_INFO", "PROJECT_CODENAME_INTERNAL", "OTHER_SENSITIVE_CONTEXTUAL",
)
PII_PROMPT = (
    "List every piece of sensitive text of these categories: " + ", ".join(CATEGORIES) + '. Answer with JSON only: {"pii_list": [{"value": "...", "category": "..."}]}, an empty list if there is none.'
)
CORRECTION_PROMPT = (
    "Read the conversation and answer with JSON only, with the keys is_user_feedback_on_error, is_assistant_self_correction, "
    "is_assistant_error_before_correction (booleans) and correction_rationale (string or null)."
)
CHUNK_SIZE, CHUNK_OVERLAP, WORKERS = 4000, 200, 4
#: Prompts that a worker takes from its batch at once, for each thread; bytes of a batch.
AHEAD, BATCH_BYTES = 16, 4 << 20


class Client(Protocol):
    name: str

    def ask(self, system: str, user: str) -> str: ...


class ModelError(Exception):
    """The model's server answered with an error."""


class RuleClient:
    """Answers by fixed rules: a stand-in for a model in tests and offline runs."""

    name = "rules"

    def ask(self, system: str, user: str) -> str:
        if system.startswith("List every"):
            found = [{"value": m[0], "category": "EMAIL_ADDRESS"} for m in re.finditer(r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", user)]
            return json.dumps({"pii_list": found})
        lower = user.lower()
        feedback, self_made = "that's wrong" in lower or "incorrect" in lower, "apologies" in lower or "i misunderstood" in lower
        reason = "a turn speaks of an error" if feedback or self_made else None
        return json.dumps({"is_user_feedback_on_error": feedback, "is_assistant_self_correction": self_made, "is_assistant_error_before_correction": feedback or self_made, "correction_rationale": reason})


#: Shapes that a server may be asked to answer in.
PII_SHAPE = {"type": "object", "required": ["pii_list"], "properties": {"pii_list": {"type": "array", "items": {
    "type": "object", "required": ["category", "value"], "properties": {"category": {"type": "string", "enum": list(CATEGORIES)}, "value": {"type": "string"}}}}}}
CORRECTION_SHAPE = {"type": "object", "properties": {
    **{x: {"type": "boolean"} for x in ("is_user_feedback_on_error", "is_assistant_self_correction", "is_assistant_error_before_correction")}, "correction_rationale": {"type": ["string", "null"]}}}


class HttpClient:
    """Asks a chat server: POST <url>/api/chat with model, messages and the shape of the answer; the reply is message.content.

    An HTTP error is a ModelError with the server's own message; a server that
    cannot be reached, or answers with something else, is any other error.
    """

    def __init__(self, url: str, model: str, shape: dict | str = "json", timeout: float = 120.0):
        self.url, self.name, self.shape, self.timeout = url.rstrip("/"), model, shape, timeout

    def ask(self, system: str, user: str) -> str:
        messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        body = json.dumps({"model": self.name, "messages": messages, "format": self.shape, "stream": False}).encode()
        request = urllib.request.Request(f"{self.url}/api/chat", body, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                return json.loads(reply.read())["message"]["content"]
        except urllib.error.HTTPError as e:
            text = e.read().decode("utf-8", "replace")
            try:
                text = json.loads(text)["error"]
            except (ValueError, KeyError, TypeError):
                pass
            raise ModelError(f"{e.code} {text}") from e


def ask_all(df: DataFrame, system: str, user_col: str, out_col: str, factory: Callable[[], Client], workers: int = WORKERS) -> DataFrame:
    """``df`` with the model's reply to each prompt, and <out_col>_error where the call failed; null prompts are not sent.

    Rows pass the worker as Arrow has them; only prompts become Python's strings, a
    few ahead of the calls under way, so a worker holds little beside its batch.
    """
    _bound_batches(df.sparkSession)
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType()), T.StructField(f"{out_col}_error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = factory()

        def one(prompt):
            if prompt is None:
                return None, None
            try:
                return client.ask(system, prompt), None
            except ModelError as e:
                return None, f"Model error: {e}"
            except Exception as e:  # a failed call is a result of its row, not the end of the task
                return None, f"Unexpected error: {e}"

        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                prompts = (x.as_py() for x in batch.column(user_col))
                answers = list(_in_order(pool, one, prompts, AHEAD * workers))
                columns = [pa.array([a[k] for a in answers], pa.string()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema=pa.schema([*batch.schema, *(pa.field(n, pa.string()) for n in schema.names[-2:])]))

    return df.mapInArrow(run, schema)


def _bound_batches(spark: SparkSession) -> None:
    """Have the session make Arrow batches of BATCH_BYTES, or of fewer where it does already."""
    limit = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < limit <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _in_order(pool: ThreadPoolExecutor, call: Callable, values: Iterable, ahead: int) -> Iterator:
    """call(value) of each value, in order; at most ``ahead`` values are taken before their results are."""
    waiting = deque()
    for value in values:
        waiting.append(pool.submit(call, value))
        if len(waiting) >= ahead:
            yield waiting.popleft().result()
    while waiting:
        yield waiting.popleft().result()


def _parse_items(reply: Column) -> Column:
    """Items of a reply; none of an empty, broken or wrongly shaped one."""
    parsed = F.try_variant_get(F.try_parse_json(reply), "$.pii_list", "array<struct<category: string, value: string>>")
    good = F.forall(parsed, lambda x: x["value"].isNotNull() & x["category"].isNotNull())
    return F.when(good, parsed).otherwise(F.array()).cast(T.ArrayType(PII_ITEM))


def _first_seen(items: Column) -> Column:
    return F.array_distinct(items)


def redact_by_model(traces: DataFrame, factory: Callable[[], Client], size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, workers: int = WORKERS, per_field: bool = False) -> DataFrame:
    """Sensitive text that the model finds, replaced in messages and completion.

    By default a trace's findings, of all its messages and its completion, apply
    to all of them, and all detected categories are reported; per_field applies
    each text's own findings to it alone and reports only categories replaced.
    Blank texts are not sent; broken replies find nothing.  Where calls failed,
    text may have passed unseen: llm_call_error has the first error, null elsewhere.
    Null and repeated keys are traces of their own.
    """
    given, key = traces.columns, "_tracewright_row"
    traces = settle(traces.withColumn(key, F.monotonically_increasing_id()))  # settled, so the same number each time
    texts = F.concat(
        F.transform(F.coalesce("messages", F.array()), lambda m, i: F.struct(i.alias("field"), F.coalesce(m["content"], F.lit("")).alias("text"))),
        F.array(F.struct(F.lit(-1).alias("field"), F.coalesce("completion", F.lit("")).alias("text"))),
    )
    fields = traces.select(key, F.explode(texts).alias("t")).where(~is_blank(F.col("t.text")))
    pieces = fields.select(key, F.col("t.field").alias("field"), F.posexplode(chunks(F.col("t.text"), size, overlap)).alias("piece", "prompt"))
    asked = ask_all(pieces, PII_PROMPT, "prompt", "reply", factory, workers).withColumn("items", _parse_items(F.col("reply")))
    # a trace's chunks are as many as its text holds; their order decides between equal items
    per = asked.groupBy(key, "field").agg(F.transform(F.array_sort(F.collect_list(F.struct("piece", "items"))), lambda x: x["items"]).alias("lists"), F.min("reply_error").alias("error"))
    per = per.select(key, "field", _first_seen(F.flatten("lists")).alias("items"), "error")
    found = per.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("field", "items"))).alias("_by_field"), F.min("error").alias("llm_call_error"))
    rows = traces.join(found.withColumnRenamed(key, "_key"), traces[key] == F.col("_key"), "left").drop("_key")

    none = F.array().cast(T.ArrayType(PII_ITEM))
    by_field = F.coalesce("_by_field", F.array().cast("array<struct<field: int, items: array<struct<category: string, value: string>>>>"))
    of_messages = _first_seen(F.flatten(F.transform(F.filter(by_field, lambda x: x["field"] >= 0), lambda x: x["items"])))
    of_completion = F.flatten(F.transform(F.filter(by_field, lambda x: x["field"] < 0), lambda x: x["items"]))
    rows = rows.withColumns({"_of_messages": F.coalesce(of_messages, none), "_of_completion": F.coalesce(of_completion, none), "_fields": by_field})
    everything = F.array_union("_of_messages", "_of_completion")
    own = lambda i: F.coalesce(F.get(F.filter("_fields", lambda x: x["field"] == i), F.lit(0))["items"], none)
    new_messages = F.transform(F.coalesce("messages", F.array()), lambda m, i: F.struct(F.coalesce(m["role"], F.lit("")).alias("role"), replace_items(F.coalesce(m["content"], F.lit("")), own(i) if per_field else everything).alias("content")))
    old_completion = F.coalesce("completion", F.lit(""))
    rows = rows.withColumns({"_messages": new_messages.cast(MESSAGES), "_completion": replace_items(old_completion, F.col("_of_completion") if per_field else everything)})
    replaced = F.exists("_messages", lambda m: m["content"].contains("_REDACTED]")) | F.col("_completion").contains("_REDACTED]")
    categories = F.array_sort(F.array_distinct(F.transform(everything, lambda x: x["category"])))
    if per_field:
        shown = F.concat(F.array_join(F.transform("_messages", lambda m: m["content"]), " "), F.lit(" "), F.col("_completion"))
        categories = F.when(replaced, F.filter(categories, lambda c: shown.contains(F.concat(F.lit("["), F.upper(c), F.lit("_REDACTED]"))))).otherwise(F.array().cast("array<string>"))
    blank = (lambda c, kind: F.lit(None).cast(kind)) if per_field else (lambda c, kind: c)
    before = lambda name, kind: F.col(name) if name in traces.columns else F.lit(None).cast(kind)
    rows = rows.withColumns({
        "original_messages": F.coalesce(before("original_messages", MESSAGES), F.when(~F.col("_messages").eqNullSafe(F.col("messages")), F.col("messages")), blank(F.array().cast(MESSAGES), MESSAGES)),
        "original_completion": F.coalesce(before("original_completion", "string"), F.when(F.col("_completion") != old_completion, old_completion), blank(F.lit(""), "string")),
        "llm_anonymization_details": F.struct(
            categories.alias("llm_sensitive_categories_found"), F.col("_of_messages").alias("llm_detected_pii_items_messages"), F.col("_of_completion").alias("llm_detected_pii_items_completion"),
        ),
    })
    out = rows.withColumns({"messages": F.col("_messages"), "completion": F.col("_completion")})
    if "session_id" in out.columns:
        out = out.withColumn("session_id", F.coalesce("session_id", F.lit("")))
    out = out.drop("_by_field", "_fields", "_of_messages", "_of_completion", "_messages", "_completion", key)
    return out.select(*given, *[c for c in out.columns if c not in given])


def category_summary(redacted: DataFrame) -> DataFrame:
    return redacted.select(F.explode("llm_anonymization_details.llm_sensitive_categories_found").alias("category")).groupBy("category").agg(F.count("*").alias("n_rows")).orderBy("category")


FLAGS = ("is_user_feedback_on_error", "is_assistant_self_correction", "is_assistant_error_before_correction")


def correction_prompt() -> Column:
    return F.concat(F.lit("MESSAGES:\n"), F.to_json(F.coalesce("messages", F.array().cast(MESSAGES)), {"pretty": "true"}), F.lit("\n\nFINAL COMPLETION:\n"), F.coalesce("completion", F.lit("")))


def parse_corrections(reply: Column) -> Column:
    """struct of the flags and the rationale; defaults if the reply is broken or any field has the wrong type."""
    clean = F.regexp_replace(F.regexp_replace(reply, r"(?U)^\s*```(?:json)?\s*", ""), r"(?U)\s*```\s*$", "")
    v = F.try_parse_json(clean)
    raw = [F.try_variant_get(v, f"$.{f}", "string") for f in FLAGS]
    flags = [r.try_cast("boolean") for r in raw]
    shaped = F.coalesce(F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0) == "OBJECT", F.lit(False))
    for r, f in zip(raw, flags, strict=True):
        shaped = shaped & (r.isNull() | f.isNotNull())
    no = F.lit(False)
    return F.struct(*[F.when(shaped, F.coalesce(f, no)).otherwise(no).alias(n) for n, f in zip(FLAGS, flags, strict=True)], F.when(shaped, F.try_variant_get(v, "$.correction_rationale", "string")).alias("correction_rationale"))


def label_corrections(traces: DataFrame, factory: Callable[[], Client], workers: int = WORKERS, model: str = "rules") -> DataFrame:
    """``traces`` with three flags, a rationale and the raw reply; a failed call leaves the flags false and its error as the reply."""
    asked = ask_all(traces.withColumn("_prompt", correction_prompt()), CORRECTION_PROMPT, "_prompt", "_reply", factory, workers)
    asked = asked.withColumn("_p", parse_corrections(F.col("_reply")))
    out = asked.withColumns({f: F.coalesce(F.col(f"_p.{f}"), F.lit(False)) for f in FLAGS})
    out = out.withColumn("correction_rationale", F.col("_p.correction_rationale"))
    out = out.withColumn("correction_analysis_details", F.struct(F.coalesce("_reply", "_reply_error").alias("llm_raw_output"), F.lit(model).alias("model_used")))
    return out.drop("_prompt", "_reply", "_reply_error", "_p")


def correction_summary(labelled: DataFrame) -> DataFrame:
    return labelled.agg(F.count("*").alias("n"), *[F.count_if(F.col(f)).alias(f"n_{f}") for f in FLAGS])
