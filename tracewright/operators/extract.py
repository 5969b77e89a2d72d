"""From captured traffic to valid model traces, in one narrow stage of expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_values import items, kind, parts_text, text_at

#: Fixed value: hosts whose traffic is a model call.
TARGET_HOSTS = ("generativelanguage.googleapis.com",)
#: Line ends that split an event stream.
_LINES = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def host_matches(host: Column, targets=TARGET_HOSTS) -> Column:
    """Does the host end in one of the targets?  Null and empty hosts do not."""
    host = F.coalesce(host, F.lit(""))
    return reduce(lambda a, b: a | b, [(host != "") & host.endswith(t) for t in targets], F.lit(False))


def lenient(value: Column) -> Column:
    return F.call_function("make_valid_utf8", value.cast("string"))


def model_from_url(url: Column) -> Column:
    """What follows models/ up to a colon or slash, a query included; null if there is nothing."""
    return F.nullif(F.regexp_extract(url, "models/([^:/]*)", 1), F.lit(""))


def extract_traces(traffic: DataFrame, targets=TARGET_HOSTS) -> DataFrame:
    """One row per good model call: prompts, response text, model and token counts.

    Kept: target host, status 200, both bodies non-empty valid UTF-8, request a
    JSON object, response JSON or an event stream with at least one JSON event.
    The last non-empty usage of a stream counts, whole.  A row whose parts have
    the wrong shape is dropped, others are not affected.
    """
    rows = traffic.where(
        host_matches(lenient(F.col("request_host")), targets)
        & (F.col("response_status_code") == 200)
        & (F.octet_length("request_content") > 0)
        & (F.octet_length("response_content") > 0)
        & F.call_function("is_valid_utf8", F.col("request_content").cast("string"))
        & F.call_function("is_valid_utf8", F.col("response_content").cast("string"))
    )
    rows = rows.withColumns({
        "_req": F.try_parse_json(F.col("request_content").cast("string")),
        "_body": F.col("response_content").cast("string"),
        "_heads": F.try_parse_json(lenient(F.col("response_headers"))),
        "_url": lenient(F.col("request_url")),
    })
    req = F.col("_req")
    system, contents = F.try_variant_get(req, "$.systemInstruction", "variant"), F.try_variant_get(req, "$.contents", "variant")
    shaped = (kind(req) == "OBJECT") & (system.isNull() | (kind(system) == "OBJECT")) & (contents.isNull() | (kind(contents) == "ARRAY"))
    rows = rows.where(shaped & (kind(F.col("_heads")) == "OBJECT"))

    lower = F.lower("_url")
    content_type = F.lower(F.coalesce(text_at(F.col("_heads"), "$['content-type']"), F.lit("")))
    stream = content_type.contains("text/event-stream") | lower.contains("alt=sse") | lower.contains(":streamgeneratecontent")
    events = F.filter(
        F.transform(F.filter(F.split("_body", _LINES), lambda x: x.startswith("data:")), lambda x: F.try_parse_json(F.regexp_replace(F.substring(x, F.lit(6), F.length(x)), r"(?U)^\s+|\s+$", ""))),
        lambda v: v.isNotNull(),
    )
    whole = F.filter(F.array(F.try_parse_json("_body")), lambda v: v.isNotNull())
    rows = rows.withColumn("_events", F.when(stream, events).otherwise(whole)).where((F.size("_events") > 0) & F.forall("_events", lambda v: kind(v) == "OBJECT"))

    users = F.filter(items(req, "$.contents"), lambda c: F.lower(F.coalesce(text_at(c, "$.role"), F.lit(""))) == "user")
    answer = F.array_join(F.transform(F.flatten(F.transform("_events", lambda v: items(v, "$.candidates"))), lambda c: parts_text(c, "$.content.parts")), "")
    usages = F.filter(F.transform("_events", lambda v: F.try_variant_get(v, "$.usageMetadata", "variant")), lambda u: F.coalesce(F.to_json(u) != "{}", F.lit(False)) & ~F.call_function("is_variant_null", u))
    usage = F.try_element_at(usages, F.lit(-1))
    versions = F.filter(F.transform("_events", lambda v: text_at(v, "$.modelVersion")), lambda x: F.coalesce(x != "", F.lit(False)))
    return rows.select(
        F.col("id").alias("original_http_traffic_id"),
        "timestamp",
        F.col("_url").alias("request_url"),
        F.coalesce(F.nullif(text_at(req, "$.model"), F.lit("")), model_from_url(F.col("_url")), F.get(versions, 0)).alias("model_name"),
        F.when(F.size(items(req, "$.systemInstruction.parts")) > 0, parts_text(req, "$.systemInstruction.parts")).alias("system_prompt"),
        F.array_join(F.transform(users, lambda c: parts_text(c)), "").alias("user_prompt"),
        answer.alias("llm_response_text"),
        F.col("request_content").cast("string").alias("request_full_json"),
        F.concat(F.lit("["), F.array_join(F.transform("_events", lambda v: F.to_json(v)), ", "), F.lit("]")).alias("response_parts_json_array"),
        "duration",
        *[F.try_variant_get(usage, f"$.{key}", "bigint").alias(name) for key, name in (("promptTokenCount", "prompt_token_count"), ("candidatesTokenCount", "candidates_token_count"), ("totalTokenCount", "total_token_count"))],
    )
