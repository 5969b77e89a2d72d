"""Queries over the driver's tables that apply the trace operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import REDACTIONS, chunks, keyword_hits, replace_items
from .operators import extract, model_stage, redact, score, sessionize, shape, validate
from .schemas import ROLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.conversation_traces(_table(spark, sf_dir, "conversations"))


def _long(column) -> F.Column:
    return column.cast("long")


def traces_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), F.coalesce(m["content"], F.lit("")))), "\n")
    return _traces(spark, sf_dir).select("conv_id", "turn", _long(F.size("messages")).alias("n_messages"), F.md5(prompt).alias("prompt_md5"), _long(F.length("completion")).alias("completion_chars"))


_TRACES_SQL = """
t AS (
  SELECT conv_id, turn, role, text,
         list(role || ':' || coalesce(text, '')) OVER w AS msgs, list(coalesce(text, '')) OVER w AS contents
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), tr AS (
  SELECT conv_id, turn, msgs, contents, coalesce(text, '') AS completion FROM t WHERE role = 'assistant' AND len(msgs) > 0
)"""
_SESSION_SQL = _TRACES_SQL + """, f AS (
  SELECT *, array_to_string(msgs[:-2], chr(1)) AS ctx, array_to_string(list_append(msgs, 'assistant:' || completion), chr(1)) AS whole, len(msgs) AS n FROM tr
), b AS (
  SELECT *, CASE WHEN ctx = lag(whole) OVER (ORDER BY conv_id, turn) THEN 0 ELSE 1 END AS new FROM f
), s AS (SELECT *, sum(new) OVER (ORDER BY conv_id, turn) AS sid FROM b
), ss AS (SELECT *, 'session_' || CASE WHEN sid < 1000 THEN lpad(sid::VARCHAR, 3, '0') ELSE sid::VARCHAR END AS session_id, row_number() OVER (PARTITION BY sid ORDER BY conv_id, turn) AS turn_in_session_id FROM s
)"""


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionize.sessionize(_traces(spark, sf_dir), "conv_id", "turn")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir).select("conv_id", "turn", "session_id", _long(F.col("turn_in_session_id")).alias("turn_in_session_id"))


def longest_per_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = sessionize.longest_per_session(_sessions(spark, sf_dir), "conv_id", "turn")
    return best.select("session_id", "conv_id", "turn", _long(F.size("messages")).alias("n_messages"))


def session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = _sessions(spark, sf_dir).groupBy("session_id").agg(F.count("*").alias("n_turns"), _long(F.max(F.size("messages"))).alias("max_messages"))
    return per.groupBy("n_turns").agg(F.count("*").alias("n_sessions"), F.max("max_messages").alias("max_messages"))


#: Words that the invented text of the tables has, to score where the fixed keywords never occur.
VOCABULARY = ("the", "and", "of", "with", "die", "que")


def complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score.score_complexity(_traces(spark, sf_dir), VOCABULARY)
    return out.select("conv_id", "turn", "complexity_score", "complexity_reasoning")


def _hits_sql(text: str) -> str:
    """Words of the vocabulary, cut at what is no letter, mark or digit of any script."""
    return "len(list_filter(regexp_extract_all({}, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda v: lower(v) IN ({})))".format(text, ", ".join(f"'{w}'" for w in VOCABULARY))


_SCORE_SQL = _TRACES_SQL + f""", p AS (
  SELECT conv_id, turn, least(len(msgs) * 2, 25) AS a, least(list_sum(list_transform(contents, lambda x: length(x)))::BIGINT // 100, 25) AS b,
         least(length(completion) // 75, 25) AS c,
         least(2 * {_hits_sql("array_to_string(contents, ' ') || ' ' || completion")}, 25) AS d
  FROM tr
), sc AS (
  SELECT conv_id, turn, (a + b + c + d)::DOUBLE AS complexity_score, 'Heuristic - (Turns: ' || a || '; MsgLen: ' || b || '; CompLen: ' || c || '; Keywords: ' || d || ')' AS complexity_reasoning FROM p
)"""


def complexity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.score_summary(score.score_complexity(_traces(spark, sf_dir), VOCABULARY))


def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", _long(keyword_hits(F.col("text"), VOCABULARY)).alias("n_hits"))


def _redact_query(name: str, key: str, text: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = redact.redact_text(_table(spark, sf_dir, name).select(key, text), text)
        return out.select(key, F.md5("redacted").alias("redacted_md5"), F.array_join("patterns_found", ",").alias("patterns"))

    return run


def _redact_sql(name: str, key: str, text: str) -> str:
    steps, before = [f"r0 AS (SELECT {key}, {text} AS x, '' AS f FROM {name})"], "r0"
    for k, (rule, pattern, placeholder) in enumerate(REDACTIONS, 1):
        p = pattern.replace("'", "''")
        steps.append(f"r{k} AS (SELECT {key}, regexp_replace(x, '{p}', '{placeholder}', 'g') AS x, f || CASE WHEN regexp_matches(x, '{p}') THEN '{rule},' ELSE '' END AS f FROM {before})")
        before = f"r{k}"
    return f"WITH {', '.join(steps)} SELECT {key}, md5(x) AS redacted_md5, rtrim(f, ',') AS patterns FROM {before}"


def pattern_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact.pattern_summary(redact.redact_text(_table(spark, sf_dir, "documents").select("text"), "text"))


def redact_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = redact.redact_traces(_traces(spark, sf_dir))
    contents = F.array_join(F.transform("messages", lambda m: F.coalesce(m["content"], F.lit(""))), "\n")
    return out.select("conv_id", "turn", F.md5(contents).alias("messages_md5"), F.md5("completion").alias("completion_md5"), F.col("original_messages").isNotNull().alias("messages_changed"), F.col("original_completion").isNotNull().alias("completion_changed"))


def _fold_sql(x: str) -> str:
    for _, pattern, placeholder in REDACTIONS:
        x = "regexp_replace({}, '{}', '{}', 'g')".format(x, pattern.replace("'", "''"), placeholder)
    return x


CHUNK, OVERLAP = 500, 50


def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunks(F.col("text"), CHUNK, OVERLAP)).alias("chunk", "piece"))
    return pieces.select("doc_id", _long(F.col("chunk")).alias("chunk"), _long(F.length("piece")).alias("n_chars"), F.md5("piece").alias("piece_md5"))


def _as_traces(conversations: DataFrame) -> DataFrame:
    """Every turn as a trace of one message, to be validated."""
    return conversations.select("role", "text", "turn", F.lit("t").alias("trace_id"), F.lit("1.0").alias("schema_version"), F.array(shape.message(F.col("role"), F.col("text"))).alias("messages"), F.lit("").alias("completion"))


def role_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validate.with_errors(_as_traces(_table(spark, sf_dir, "conversations")), "base")
    return rows.groupBy("role").agg(F.count_if(F.size("errors") == 0).alias("n_valid"), F.count_if(F.size("errors") > 0).alias("n_invalid"))


def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by place and kind; every fifth turn has a role that is none, every seventh no text."""
    rows = _table(spark, sf_dir, "conversations").withColumns({"role": F.when(F.col("turn") % 5 == 0, "robot").otherwise(F.col("role")), "text": F.when(F.col("turn") % 7 != 0, F.col("text"))})
    errors = validate.with_errors(_as_traces(rows), "base").select(F.explode("errors").alias("e"))
    return errors.groupBy(F.array_join("e.loc", ".").alias("place"), F.col("e.type").alias("kind"), F.col("e.msg").alias("msg")).agg(F.count("*").alias("n"))


def stage_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces against the base stage; every seventh conversation's have lost their schema version."""
    rows = shape.add_trace_ids(_traces(spark, sf_dir).withColumn("ord", F.col("conv_id") * 1000 + F.col("turn")))
    rows = rows.withColumn("schema_version", F.when(F.col("conv_id") % 7 != 0, F.col("schema_version")))
    return validate.validation_counts(rows, "base")


def url_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.call_function("parse_url", F.col("url"), F.lit("HOST"))
    return _table(spark, sf_dir, "pages").select("page_id", extract.host_matches(host, ("example.com", "example.net")).alias("target"))


def url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model segment of URLs made from page urls, as the capture would have them."""
    url = F.concat(F.lit("https://host/v1/models/m-"), F.col("page_id").cast("string"), F.lit(":streamGenerateContent?src="), F.col("url"))
    return _table(spark, sf_dir, "pages").select("page_id", extract.model_from_url(url).alias("model_name"))


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return _table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(value).alias("n_k"), F.sum(value).alias("sum_k"))


ITEMS = (("the", "FREQUENT"), ("then", "RARE"), ("de la", "PAIR"))


def literal_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(v).alias("value")) for v, c in ITEMS])
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(replace_items(F.col("text"), items)).alias("replaced_md5"))


def first_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.first_n(_table(spark, sf_dir, "documents").select("doc_id", "source"), 130, "doc_id")


def trace_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "source"), _table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id").groupBy("source").agg(F.count("*").alias("n_labelled"), F.sum("quality").alias("n_good"), F.sum("toxic").alias("n_toxic"))


def traffic_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic as a capture of the conversations would have it: one call a trace, every other one an event stream."""
    t = _traces(spark, sf_dir)
    model_role = lambda m: F.when(m["role"] == "assistant", "model").otherwise(m["role"])
    turns = F.transform(F.filter("messages", lambda m: m["role"] != "system"), lambda m: F.struct(model_role(m).alias("role"), F.array(F.struct(m["content"].alias("text"))).alias("parts")))
    system = F.filter("messages", lambda m: m["role"] == "system")
    system_parts = F.when(F.size(system) > 0, F.struct(F.transform(system, lambda m: F.struct(m["content"].alias("text"))).alias("parts")))
    request = F.to_json(F.struct(turns.alias("contents"), system_parts.alias("systemInstruction")))
    half = F.floor(F.length("completion") / 2).cast("int")
    reply = lambda text, tokens: F.to_json(F.struct(
        F.array(F.struct(F.struct(F.array(F.struct(text.alias("text"))).alias("parts")).alias("content"))).alias("candidates"),
        F.struct(F.length("completion").alias("promptTokenCount"), tokens.alias("candidatesTokenCount"), (F.length("completion") + tokens).alias("totalTokenCount")).alias("usageMetadata"),
        F.lit("m-1").alias("modelVersion"),
    ))
    stream = F.col("turn") % 2 == 1
    one, two = F.substring("completion", F.lit(1), half), F.substring("completion", half + 1, F.length("completion"))
    body = F.when(stream, F.concat(F.lit("data: "), reply(one, F.lit(1)), F.lit("\n\ndata: broken\r\ndata: "), reply(two, F.lit(2)), F.lit("\n"))).otherwise(reply(F.col("completion"), F.lit(3)))
    return t.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("https://x.googleapis.com/v1/models/"), F.when(F.col("conv_id") % 3 == 0, "m-3").otherwise(""), F.when(stream, ":streamGenerateContent?alt=sse").otherwise(":generateContent")).alias("request_url"),
        F.when(F.col("conv_id") % 5 == 0, "elsewhere.org").otherwise("generativelanguage.googleapis.com").alias("request_host"),
        request.cast("binary").alias("request_content"), F.when(F.col("conv_id") % 11 == 0, 500).otherwise(200).alias("response_status_code"),
        F.lit('{"content-type": "application/json"}').alias("response_headers"), body.cast("binary").alias("response_content"), F.lit(0.5).alias("duration"),
    )


def extracted_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.extract_traces(traffic_from_conversations(spark, sf_dir))
    return out.select("original_http_traffic_id", "model_name", F.md5("system_prompt").alias("system_md5"), F.md5("user_prompt").alias("user_md5"), F.md5("llm_response_text").alias("response_md5"), "prompt_token_count", "candidates_token_count", "total_token_count")


_EXTRACT_SQL = """
t AS (
  SELECT conv_id, turn, role, text,
         list({'r': role, 'c': text}) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM conversations
), x AS (
  SELECT conv_id * 1000 + turn AS id, conv_id, turn, coalesce(text, '') AS completion, m FROM t
  WHERE role = 'assistant' AND len(m) > 0 AND conv_id % 5 <> 0 AND conv_id % 11 <> 0
)"""


def training_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shape.to_examples(extract.extract_traces(traffic_from_conversations(spark, sf_dir)))
    return out.select("ord", _long(F.size("messages")).alias("n_messages"), F.md5(F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")).alias("messages_md5"), F.md5("completion").alias("completion_md5"))


def model_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one-message traces, redacted by the rule client."""
    out = model_stage.redact_by_model(_document_traces(spark, sf_dir, ""), model_stage.RuleClient)
    return out.select(F.col("trace_id").cast("long").alias("doc_id"), F.md5(F.col("messages")[0]["content"]).alias("redacted_md5"))


def _document_traces(spark: SparkSession, sf_dir: str, completion: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("trace_id"), F.array(shape.message(F.lit("user"), F.col("text"))).alias("messages"), F.lit(completion).alias("completion"))


def model_redaction_per_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and a fixed completion, each redacted by what was found in itself."""
    out = model_stage.redact_by_model(_document_traces(spark, sf_dir, "to a@b.co"), model_stage.RuleClient, per_field=True)
    return out.select(F.col("trace_id").cast("long").alias("doc_id"), F.md5(F.col("messages")[0]["content"]).alias("redacted_md5"), "completion")


def model_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_stage.category_summary(model_stage.redact_by_model(_document_traces(spark, sf_dir, ""), model_stage.RuleClient))


def correction_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies made from the labels, parsed: fenced, bare, of a wrong type, or no JSON at all."""
    labels = _table(spark, sf_dir, "labels")
    flag = lambda c: F.when(F.col(c) == 1, "true").otherwise("false")
    body = F.concat(F.lit('{"is_user_feedback_on_error": '), flag("quality"), F.lit(', "is_assistant_self_correction": '), flag("toxic"), F.lit(', "correction_rationale": "because"}'))
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    wrong = F.lit('{"is_user_feedback_on_error": "perhaps"}')
    reply = F.when(F.col("doc_id") % 4 == 0, fenced).when(F.col("doc_id") % 4 == 1, body).when(F.col("doc_id") % 4 == 2, wrong).otherwise(F.lit("no idea"))
    parsed = labels.select("doc_id", model_stage.parse_corrections(reply).alias("p"))
    return parsed.select("doc_id", "p.is_user_feedback_on_error", "p.is_assistant_self_correction", "p.is_assistant_error_before_correction", "p.correction_rationale")


def undecodable_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls left when every fourth conversation's request bodies are no UTF-8."""
    traffic = traffic_from_conversations(spark, sf_dir)
    broken = F.when(F.floor(F.col("id") / 1000) % 4 == 0, F.concat("request_content", F.unhex(F.lit("FF")))).otherwise(F.col("request_content"))
    return extract.extract_traces(traffic.withColumn("request_content", broken)).select("original_http_traffic_id")


def trace_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.add_trace_ids(_table(spark, sf_dir, "documents").select("doc_id"), "base", "doc_id").select("doc_id", "trace_id", "schema_version")


def untransposed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as an array for each field, turned back into messages; every fifth has lost a text."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))))
    rows = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    texts = F.transform("t", lambda x: x["text"])
    texts = F.when(F.col("conv_id") % 5 == 0, F.slice(texts, F.lit(1), F.size(texts) - 1)).otherwise(texts)
    made = shape.untranspose(F.struct(F.transform("t", lambda x: x["role"]).alias("role"), texts.alias("content")))
    return rows.select("conv_id", F.md5(F.array_join(F.transform(made, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")).alias("messages_md5"))


def trace_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the patterns found anywhere in a trace."""
    out = redact.redact_traces(_traces(spark, sf_dir))
    return out.select("conv_id", "turn", F.array_join("anonymization_details.regex_patterns_found", ",").alias("patterns"))


def correction_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_stage.correction_summary(model_stage.label_corrections(_traces(spark, sf_dir), model_stage.RuleClient))


QUERIES = {
    "traces_from_conversations": traces_from_conversations,
    "sessionize": sessions,
    "longest_per_session": longest_per_session,
    "session_stats": session_stats,
    "complexity_score": complexity,
    "complexity_summary": complexity_summary,
    "keyword_counts": keyword_counts,
    "redact_documents": _redact_query("documents", "doc_id", "text"),
    "redact_pages": _redact_query("pages", "page_id", "html"),
    "pattern_summary": pattern_summary,
    "redact_conversations": redact_conversations,
    "chunk_documents": chunk_documents,
    "role_validation": role_validation,
    "stage_validation": stage_validation,
    "host_suffix_filter": url_hosts,
    "url_model_extract": url_models,
    "json_extract_props": event_props,
    "literal_replace": literal_replace,
    "first_n_in_order": first_documents,
    "label_lineage": trace_labels,
    "extract_traces": extracted_traces,
    "training_examples": training_examples,
    "model_redaction": model_redaction,
    "correction_labels": correction_labels,
    "validation_errors": validation_errors,
    "model_redaction_per_field": model_redaction_per_field,
    "model_categories": model_categories,
    "correction_replies": correction_replies,
    "undecodable_calls": undecodable_calls,
    "trace_ids": trace_ids,
    "untransposed_messages": untransposed_messages,
    "trace_patterns": trace_patterns,
}

_EMAIL = r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
#: What the rule client finds in the documents' pieces of 4000 characters, 200 of them shared, replaced longest first.
_FOUND_SQL = f"""
p AS (SELECT doc_id, text, unnest(range(0, 1 + greatest(0, ceil((length(text) - 4000) / 3800)::BIGINT))) AS i FROM documents WHERE length(text) > 0),
f AS (SELECT doc_id, list_distinct(flatten(list(regexp_extract_all(substr(text, i * 3800 + 1, 4000), '{_EMAIL}')))) AS found FROM p GROUP BY doc_id),
r AS (
  SELECT doc_id, found, list_reduce(
    list_prepend(coalesce(text, ''), list_transform(list_sort(list_transform(coalesce(found, []::VARCHAR[]), lambda v: {{'n': -length(v), 'v': v}})), lambda x: x.v)),
    lambda t, v: replace(t, v, '[EMAIL_ADDRESS_REDACTED]')) AS redacted
  FROM documents LEFT JOIN f USING (doc_id)
)"""
ORACLES = {
    "traces_from_conversations": f"WITH {_TRACES_SQL} SELECT conv_id, turn, len(msgs)::BIGINT AS n_messages, md5(array_to_string(msgs, chr(10))) AS prompt_md5, length(completion)::BIGINT AS completion_chars FROM tr",
    "sessionize": f"WITH {_SESSION_SQL} SELECT conv_id, turn, session_id, turn_in_session_id FROM ss",
    "longest_per_session": f"WITH {_SESSION_SQL} SELECT session_id, conv_id, turn, n::BIGINT AS n_messages FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, conv_id, turn) AS k FROM ss) WHERE k = 1",
    "session_stats": f"WITH {_SESSION_SQL} SELECT n_turns, count(*) AS n_sessions, max(m)::BIGINT AS max_messages FROM (SELECT session_id, count(*) AS n_turns, max(n) AS m FROM ss GROUP BY session_id) GROUP BY n_turns",
    "complexity_score": f"WITH {_SCORE_SQL} SELECT * FROM sc",
    "complexity_summary": f"WITH {_SCORE_SQL} SELECT count(*) AS n, round(avg(complexity_score), 2) AS avg_score, min(complexity_score) AS min_score, max(complexity_score) AS max_score FROM sc",
    "keyword_counts": f"SELECT doc_id, {_hits_sql('text')}::BIGINT AS n_hits FROM documents",
    "redact_documents": _redact_sql("documents", "doc_id", "text"),
    "redact_pages": _redact_sql("pages", "page_id", "html"),
    "pattern_summary": f"SELECT pattern, count(*) AS n_rows FROM (SELECT unnest(string_split(patterns, ',')) AS pattern FROM ({_redact_sql('documents', 'doc_id', 'text')}) WHERE patterns <> '') GROUP BY pattern",
    "redact_conversations": f"""WITH {_TRACES_SQL}, r AS (
      SELECT conv_id, turn, contents, completion, list_transform(contents, lambda x: {_fold_sql('x')}) AS c2, {_fold_sql('completion')} AS d2 FROM tr)
      SELECT conv_id, turn, md5(array_to_string(c2, chr(10))) AS messages_md5, md5(d2) AS completion_md5, c2 <> contents AS messages_changed, d2 <> completion AS completion_changed FROM r""",
    "chunk_documents": f"""SELECT doc_id, i::BIGINT AS chunk, length(piece)::BIGINT AS n_chars, md5(piece) AS piece_md5 FROM (
      SELECT doc_id, i, substr(text, i * {CHUNK - OVERLAP} + 1, {CHUNK}) AS piece FROM (
        SELECT doc_id, text, unnest(range(0, 1 + greatest(0, ceil((length(text) - {CHUNK}) / {CHUNK - OVERLAP})::BIGINT))) AS i FROM documents WHERE length(text) > 0))""",
    "role_validation": "SELECT role, count(*) FILTER (ok) AS n_valid, count(*) FILTER (NOT ok) AS n_invalid FROM (SELECT role, coalesce(role IN ({}) AND text IS NOT NULL, false) AS ok FROM conversations) GROUP BY role".format(", ".join(f"'{r}'" for r in ROLES)),
    "stage_validation": f"WITH {_TRACES_SQL} SELECT 'base' AS stage, count(*) FILTER (conv_id % 7 <> 0) AS n_valid, count(*) FILTER (conv_id % 7 = 0) AS n_invalid FROM tr",
    "host_suffix_filter": "SELECT page_id, coalesce(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1), '') SIMILAR TO '.*(example\\.com|example\\.net)' AS target FROM pages",
    "url_model_extract": "SELECT page_id, 'm-' || page_id AS model_name FROM pages",
    "json_extract_props": "SELECT event_type, count(k) AS n_k, sum(k)::BIGINT AS sum_k FROM (SELECT event_type, (props::JSON ->> '$.k')::BIGINT AS k FROM events) GROUP BY event_type",
    "literal_replace": "SELECT doc_id, md5(replace(replace(replace(text, 'de la', '[PAIR_REDACTED]'), 'then', '[RARE_REDACTED]'), 'the', '[FREQUENT_REDACTED]')) AS replaced_md5 FROM documents",
    "first_n_in_order": "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 130",
    "label_lineage": "SELECT source, count(*) AS n_labelled, sum(quality)::BIGINT AS n_good, sum(toxic)::BIGINT AS n_toxic FROM documents JOIN labels USING (doc_id) GROUP BY source",
    "extract_traces": f"""WITH {_EXTRACT_SQL} SELECT id AS original_http_traffic_id, CASE WHEN conv_id % 3 = 0 THEN 'm-3' ELSE 'm-1' END AS model_name,
      md5(CASE WHEN len(list_filter(m, lambda y: y.r = 'system')) > 0 THEN array_to_string(list_transform(list_filter(m, lambda y: y.r = 'system'), lambda y: y.c), '') END) AS system_md5,
      md5(coalesce(array_to_string(list_transform(list_filter(m, lambda y: y.r = 'user'), lambda y: y.c), ''), '')) AS user_md5, md5(completion) AS response_md5,
      length(completion)::BIGINT AS prompt_token_count, CASE WHEN turn % 2 = 1 THEN 2 ELSE 3 END::BIGINT AS candidates_token_count,
      (length(completion) + CASE WHEN turn % 2 = 1 THEN 2 ELSE 3 END)::BIGINT AS total_token_count FROM x""",
    "training_examples": f"""WITH {_EXTRACT_SQL} SELECT id AS ord, (1 + len(k))::BIGINT AS n_messages,
      md5(array_to_string(list_concat(['system:You are a helpful assistant.'], list_transform(k, lambda y: y.r || ':' || y.c)), chr(10))) AS messages_md5, md5(completion) AS completion_md5
      FROM (SELECT id, completion, list_filter(m, lambda y: y.r <> 'system' AND y.c <> '') AS k FROM x)""",
    "model_redaction": f"WITH {_FOUND_SQL} SELECT doc_id, md5(redacted) AS redacted_md5 FROM r",
    "model_redaction_per_field": f"WITH {_FOUND_SQL} SELECT doc_id, md5(redacted) AS redacted_md5, 'to [EMAIL_ADDRESS_REDACTED]' AS completion FROM r",
    "model_categories": f"WITH {_FOUND_SQL} SELECT 'EMAIL_ADDRESS' AS category, count(*) AS n_rows FROM r WHERE len(found) > 0 HAVING count(*) > 0",
    "correction_labels": f"""WITH {_TRACES_SQL}, q AS (
      SELECT w LIKE '%that''s wrong%' OR w LIKE '%incorrect%' AS a, w LIKE '%apologies%' OR w LIKE '%i misunderstood%' AS b FROM (SELECT lower(array_to_string(contents, chr(1)) || chr(1) || completion) AS w FROM tr))
      SELECT count(*) AS n, count(*) FILTER (a) AS n_is_user_feedback_on_error, count(*) FILTER (b) AS n_is_assistant_self_correction, count(*) FILTER (a OR b) AS n_is_assistant_error_before_correction FROM q""",
    "validation_errors": """WITH c AS (SELECT CASE WHEN turn % 5 = 0 THEN 'robot' ELSE role END AS role, CASE WHEN turn % 7 <> 0 THEN text END AS text FROM conversations)
      SELECT place, kind, msg, count(*) AS n FROM (
        SELECT 'messages.0.role' AS place, 'value_error' AS kind, 'Role must be known, got ' || chr(39) || role || chr(39) AS msg FROM c WHERE role NOT IN ('system', 'user', 'assistant', 'tool_code', 'tool_outputs')
        UNION ALL SELECT 'messages.0.role', 'missing', 'Field required' FROM c WHERE role IS NULL
        UNION ALL SELECT 'messages.0.content', 'missing', 'Field required' FROM c WHERE text IS NULL) GROUP BY place, kind, msg""",
    "correction_replies": """SELECT doc_id, doc_id % 4 < 2 AND quality = 1 AS is_user_feedback_on_error, doc_id % 4 < 2 AND toxic = 1 AS is_assistant_self_correction,
      false AS is_assistant_error_before_correction, CASE WHEN doc_id % 4 < 2 THEN 'because' END AS correction_rationale FROM labels""",
    "undecodable_calls": f"WITH {_EXTRACT_SQL} SELECT id AS original_http_traffic_id FROM x WHERE conv_id % 4 <> 0",
    "trace_ids": """SELECT doc_id, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS trace_id, '1.0' AS schema_version
      FROM (SELECT doc_id, sha256('base:' || doc_id) AS h FROM documents)""",
    "untransposed_messages": "SELECT conv_id, CASE WHEN conv_id % 5 <> 0 THEN md5(string_agg(role || ':' || coalesce(text, ''), chr(10) ORDER BY turn)) END AS messages_md5 FROM conversations GROUP BY conv_id",
    "trace_patterns": f"""WITH {_TRACES_SQL}, u AS (
      SELECT {{'c': conv_id, 't': turn}} AS k, unnest(list_append(contents, completion)) AS text FROM tr
    ), g AS ({_redact_sql("u", "k", "text")}
    ), n AS (SELECT k, unnest(string_split(patterns, ',')) AS p FROM g WHERE patterns <> '')
    SELECT conv_id, turn, coalesce(names, '') AS patterns FROM tr LEFT JOIN (SELECT k.c AS conv_id, k.t AS turn, string_agg(DISTINCT p, ',' ORDER BY p) AS names FROM n GROUP BY k.c, k.t) USING (conv_id, turn)""",
}
