"""Schemas of traffic, traces and the stages that add to them."""

from __future__ import annotations

from pyspark.sql import types as T

#: Roles that a message may have.
ROLES = ("system", "user", "assistant", "tool_code", "tool_outputs")

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)
PII_ITEM = T.StructType([T.StructField("category", T.StringType()), T.StructField("value", T.StringType())])


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in pairs])


#: The names and order of the fields below.
S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

HTTP_TRAFFIC = _fields(
    ("id", L), ("timestamp", T.TimestampType()), ("request_method", S), ("request_url", S), ("request_host", S), ("request_http_version", S),
    ("request_headers", S), ("request_content", T.BinaryType()), ("response_status_code", I), ("response_reason", S), ("response_http_version", S),
    ("response_headers", S), ("response_content", T.BinaryType()), ("client_ip", S), ("server_ip", S), ("duration", D),
)

VALID_TRACES = _fields(
    ("original_http_traffic_id", L), ("timestamp", T.TimestampType()), ("request_url", S), ("model_name", S), ("system_prompt", S), ("user_prompt", S),
    ("llm_response_text", S), ("request_full_json", S), ("response_parts_json_array", S), ("duration", D), ("prompt_token_count", L),
    ("candidates_token_count", L), ("total_token_count", L),
)

TRACE = _fields(("trace_id", S), ("schema_version", S), ("messages", MESSAGES), ("completion", S))
SESSIONIZED = T.StructType([*TRACE.fields, *_fields(("session_id", S), ("turn_in_session_id", I)).fields])
REDACTED = T.StructType([
    *SESSIONIZED.fields,
    *_fields(("original_messages", MESSAGES), ("original_completion", S), ("anonymization_details", _fields(("regex_patterns_found", T.ArrayType(S))))).fields,
])
MODEL_REDACTED = T.StructType([
    *REDACTED.fields,
    T.StructField("llm_anonymization_details", _fields(
        ("llm_sensitive_categories_found", T.ArrayType(S)),
        ("llm_detected_pii_items_messages", T.ArrayType(PII_ITEM)),
        ("llm_detected_pii_items_completion", T.ArrayType(PII_ITEM)),
    )),
])
SCORED = T.StructType([
    *MODEL_REDACTED.fields,
    *_fields(("complexity_score", D), ("complexity_reasoning", S), ("llm_complexity_score", D), ("llm_complexity_rationale", S)).fields,
])
CORRECTED = T.StructType([
    *SCORED.fields,
    *_fields(
        ("is_user_feedback_on_error", B), ("is_assistant_self_correction", B), ("is_assistant_error_before_correction", B), ("correction_rationale", S),
        ("correction_analysis_details", _fields(("llm_raw_output", S), ("model_used", S))),
    ).fields,
])

#: What each stage's rows must have: the fields that may not be null.  Message arrays are checked for roles and text too.
STAGE_REQUIRED: dict[str, tuple[str, ...]] = {
    "base": ("trace_id", "schema_version", "messages", "completion"),
    "sessionize": ("trace_id", "schema_version", "messages", "completion", "session_id", "turn_in_session_id"),
    "redact": ("trace_id", "schema_version", "messages", "completion", "session_id", "turn_in_session_id", "anonymization_details"),
}
STAGE_REQUIRED["model_redact"] = (*STAGE_REQUIRED["redact"], "llm_anonymization_details")
STAGE_REQUIRED["score"] = (*STAGE_REQUIRED["model_redact"], "complexity_score", "complexity_reasoning")
STAGE_REQUIRED["corrections"] = (
    *STAGE_REQUIRED["score"], "is_user_feedback_on_error", "is_assistant_self_correction", "is_assistant_error_before_correction", "correction_analysis_details",
)
