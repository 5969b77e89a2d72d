import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from tracewright.operators import extract, model_stage, redact, score, sessionize, shape, validate
from tracewright.schemas import HTTP_TRAFFIC, MESSAGES, TRACE
from tracewright.sources import readers, writers


def msg(role, content):
    return {"role": role, "content": content}


def traces(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"ord long, messages {MESSAGES.simpleString()}, completion string")


def test_sessions_join_traces_that_continue_the_one_before(spark):
    a, b = msg("user", "a"), msg("assistant", "b")
    rows = [([a], "b"), ([a, b, msg("user", "c")], "d"), ([msg("user", "new")], "x"), (None, "skipped"), ([msg("user", "new"), msg("assistant", "x"), msg("user", "y")], "z"), ([msg("user", "q")], None)]
    out = sessionize.sessionize(traces(spark, rows), "ord")
    assert [(r["ord"], r["session_id"], r["turn_in_session_id"]) for r in out.orderBy("ord").collect()] == [(0, "session_001", 1), (1, "session_001", 2), (2, "session_002", 1), (4, "session_002", 2)]
    best = sessionize.longest_per_session(out, "ord")
    assert sorted(r["ord"] for r in best.collect()) == [1, 4]


def test_null_content_is_no_empty_content(spark):
    rows = [([msg("user", None)], "b"), ([msg("user", ""), msg("assistant", "b"), msg("user", "c")], "d")]
    out = sessionize.sessionize(traces(spark, rows), "ord")
    assert out.select("session_id").distinct().count() == 2


def test_many_sessions_number_past_999(spark):
    out = sessionize.sessionize(traces(spark, [([msg("user", str(k))], "x") for k in range(1005)]), "ord")
    assert out.agg(F.max(F.length("session_id"))).first()[0] == len("session_1005")
    assert out.where("session_id = 'session_1005'").first()["ord"] == 1004


def test_sessions_of_nothing(spark):
    assert sessionize.sessionize(traces(spark, []), "ord").count() == 0


def test_scores(spark):
    rows = [([msg("user", "hello")], "hi"), ([msg("user", "x" * 150), msg("assistant", "explain the error"), msg("user", None)], "y" * 1050), (None, None)]
    got = score.score_complexity(traces(spark, rows)).orderBy("ord").collect()
    assert [r["complexity_score"] for r in got] == [2.0, 6 + 1 + 14 + 4, 0.0]
    assert got[1]["complexity_reasoning"] == "Heuristic - (Turns: 6; MsgLen: 1; CompLen: 14; Keywords: 4)"
    assert got[0]["llm_complexity_score"] is None


def test_redacted_traces_keep_originals_only_where_changed(spark):
    rows = [([msg("user", "a@b.co"), msg("user", "ok")], "fine"), ([msg("user", "ok")], "10.0.0.1")]
    one, two = redact.redact_traces(traces(spark, rows)).orderBy("ord").collect()
    assert one["messages"][0]["content"] == "[EMAIL_REDACTED]" and one["original_messages"][0]["content"] == "a@b.co" and one["original_completion"] is None
    assert two["original_messages"] is None and two["original_completion"] == "10.0.0.1" and two["anonymization_details"]["regex_patterns_found"] == ["IP_ADDRESS_V4"]


HOST = "generativelanguage.googleapis.com"


def call(id_, request, response, host=HOST, status=200, url="https://h/v1/models/m-9:generateContent", headers='{"content-type": "application/json"}'):
    raw = lambda x: x if isinstance(x, bytes) else json.dumps(x).encode()
    row = dict.fromkeys([f.name for f in HTTP_TRAFFIC.fields]) | {"id": id_, "request_url": url, "request_host": host, "request_content": raw(request), "response_content": raw(response), "response_status_code": status, "response_headers": headers}
    return tuple(row[f.name] for f in HTTP_TRAFFIC.fields)


def answer(*texts, **more):
    return {"candidates": [{"content": {"parts": [{"text": t} for t in texts]}}], **more}


def test_extraction_keeps_good_calls_and_reads_both_kinds_of_reply(spark):
    good = {"contents": [{"role": "User", "parts": [{"text": "a"}, {"image": 1}, {"text": "b"}]}, {"role": "model", "parts": [{"text": "m"}]}, {"role": "user", "parts": []}]}
    sse = b"data: " + json.dumps(answer("x", usageMetadata={"promptTokenCount": 1, "totalTokenCount": 9})).encode() + b"\r\ndata: broken\n\ndata:" + json.dumps(answer("y", "z", usageMetadata={"promptTokenCount": 2}, modelVersion="v")).encode()
    rows = [
        call(1, good | {"systemInstruction": {"parts": [{"text": "sys"}]}, "model": "body"}, answer("one", "two", usageMetadata={"promptTokenCount": 5, "candidatesTokenCount": 6, "totalTokenCount": 11})),
        call(2, good, sse, url="https://h/x?alt=sse"),
        call(3, good, answer("t"), host="evil" + HOST),
        call(4, good, answer("t"), host="other.org"), call(5, good, answer("t"), status=500), call(6, good, b""), call(7, b"", answer("t")),
        call(8, good, b"\x1f\x8b\x08\x00\xff"), call(9, b"\xff\xfe", answer("t")), call(10, b"{broken", answer("t")), call(11, good, b"not json"),
        call(12, good | {"systemInstruction": None}, answer("t")), call(13, [1], answer("t")), call(14, good | {"systemInstruction": {"parts": []}}, answer()),
    ]
    out = {r["original_http_traffic_id"]: r for r in extract.extract_traces(spark.createDataFrame(rows, HTTP_TRAFFIC)).collect()}
    assert sorted(out) == [1, 2, 3, 14]
    assert (out[1]["model_name"], out[1]["system_prompt"], out[1]["user_prompt"], out[1]["llm_response_text"], out[1]["total_token_count"]) == ("body", "sys", "ab", "onetwo", 11)
    assert (out[2]["model_name"], out[2]["llm_response_text"], out[2]["prompt_token_count"], out[2]["total_token_count"]) == ("v", "xyz", 2, None)
    assert (out[14]["model_name"], out[14]["system_prompt"], out[14]["llm_response_text"]) == ("m-9", None, "")
    assert json.loads(out[2]["response_parts_json_array"])[1]["modelVersion"] == "v"
    examples = {r["ord"]: r for r in shape.to_examples(extract.extract_traces(spark.createDataFrame(rows[:1], HTTP_TRAFFIC))).collect()}
    assert [(m["role"], m["content"]) for m in examples[1]["messages"]] == [("system", shape.SYSTEM_PROMPT), ("User", "a"), ("assistant", "m")]


def test_hosts_match_by_suffix(spark):
    hosts = spark.createDataFrame([("a.google.com",), ("evilgoogle.com",), ("google.org",), ("",), (None,)], "h string")
    assert [r[0] for r in hosts.select(extract.host_matches(F.col("h"), ("google.com",))).collect()] == [True, True, False, False, False]


def test_validation_names_the_place_of_an_error(spark):
    good = ("t", "1.0", [("user", "a")], "c")
    rows = [good, ("t", "1.0", [("user", "a"), ("robot", "b")], "c"), ("t", None, [("user", None)], "c")]
    checked = validate.with_errors(spark.createDataFrame(rows, TRACE), "base").collect()
    assert checked[0]["errors"] == []
    assert [(e["loc"], e["type"]) for e in checked[1]["errors"]] == [(["messages", "1", "role"], "value_error")]
    assert [e["loc"] for e in checked[2]["errors"]] == [["schema_version"], ["messages", "0", "content"]]
    with pytest.raises(TypeError):
        validate.with_errors([], "base")
    with pytest.raises(KeyError):
        validate.with_errors(spark.createDataFrame(rows, TRACE), "no stage")


def test_trace_ids_are_the_same_in_every_run(spark):
    df = traces(spark, [([msg("user", "a")], "b")] * 3)
    one, two = ([r["trace_id"] for r in shape.add_trace_ids(df, "s").orderBy("ord").collect()] for _ in range(2))
    assert one == two and len(set(one)) == 3


def test_transposed_messages(spark):
    df = spark.createDataFrame([((["user", "assistant"], ["a", "b"]),), ((["user"], ["a", "b"]),)], "m struct<role: array<string>, content: array<string>>")
    got = [r[0] for r in df.select(shape.untranspose(F.col("m"))).collect()]
    assert [(x["role"], x["content"]) for x in got[0]] == [("user", "a"), ("assistant", "b")] and got[1] is None


class Scripted:
    name = "scripted"

    def __init__(self, reply):
        self.reply = reply

    def ask(self, system, user):
        if self.reply is None:
            raise model_stage.ModelError("down")
        return self.reply


@pytest.mark.parametrize(
    "reply,flags,rationale",
    [
        ('```json\n{"is_user_feedback_on_error": true, "is_assistant_self_correction": "yes", "correction_rationale": "why"}\n```', (True, True, False), "why"),
        ('{"is_user_feedback_on_error": true, "is_assistant_self_correction": "not_a_boolean"}', (False, False, False), None),
        ("no json", (False, False, False), None),
        (None, (False, False, False), None),
    ],
)
def test_correction_replies(spark, reply, flags, rationale):
    out = model_stage.label_corrections(traces(spark, [([msg("user", "a")], "b")]), lambda: Scripted(reply), model="m").first()
    assert tuple(out[f] for f in model_stage.FLAGS) == flags and out["correction_rationale"] == rationale
    assert out["correction_analysis_details"]["llm_raw_output"] == (reply or "Model error: down")


@pytest.mark.parametrize("per_field", [False, True])
def test_model_redaction(spark, per_field):
    rows = [([msg("user", "I am a@b.co"), msg("assistant", "hi a@b.co")], "c@d.org a@b.co"), ([msg("user", " ")], "")]
    df = shape.add_trace_ids(traces(spark, rows))
    one, two = model_stage.redact_by_model(df, model_stage.RuleClient, size=12, overlap=8, per_field=per_field).orderBy("ord").collect()
    assert "a@b.co" not in str(one["messages"]) and one["original_messages"][0]["content"] == "I am a@b.co"
    assert one["llm_anonymization_details"]["llm_sensitive_categories_found"] == ["EMAIL_ADDRESS"]
    assert two["messages"][0]["content"] == " " and two["original_messages"] == (None if per_field else [])


def test_jsonl_reading(spark, tmp_path):
    good, bad, mixed, empty = (tmp_path / n for n in ("good.jsonl", "bad.jsonl", "mixed.jsonl", "empty.jsonl"))
    good.write_text('{"id": 2, "text": "é"}\n{"id": 1, "text": "b"}\n{"id": 3, "text": null}\n')
    bad.write_text('{"id": 2, "text": "a"}\n{nope\n')
    mixed.write_text('{"id": 2, "text": "a"}\n{"id": 3, "text": 4}\n')
    empty.write_text("")
    assert [r["id"] for r in readers.read_jsonl(spark, str(good)).orderBy("ord").collect()] == [2, 1, 3]
    assert readers.read_jsonl(spark, str(good), limit=2).count() == 2 and readers.read_jsonl(spark, str(good), limit=-1).count() == 3
    assert readers.read_jsonl(spark, str(empty)).count() == 0
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id long, text string")
    assert readers.read_jsonl(spark, str(bad), schema, mode="lenient").count() == 1
    for path in (bad, mixed):
        with pytest.raises(ValueError):
            readers.read_jsonl(spark, str(path), schema)
    odd = tmp_path / "odd.jsonl"
    odd.write_text('\n{"id": "x", "text": "a"}\n \t\n{"id": 5, "text": "b", "more": 1}\n{"id": null}\n')
    assert [tuple(r) for r in readers.read_jsonl(spark, str(odd), schema, mode="lenient").orderBy("ord").collect()] == [(5, "b", 0), (None, None, 1)]
    with pytest.raises(ValueError, match="odd.jsonl"):
        readers.read_jsonl(spark, str(odd), schema)
    with pytest.raises(FileNotFoundError):
        readers.read_jsonl(spark, str(tmp_path / "none"))
    writers.write_jsonl(readers.read_jsonl(spark, str(good)).orderBy("ord").drop("ord"), str(tmp_path / "out"), single=True)
    assert [r["text"] for r in readers.read_jsonl(spark, str(tmp_path / "out")).orderBy("ord").collect()] == ["é", "b", None]


def test_sqlite_reading(spark, tmp_path):
    from pyspark.sql.types import StructType

    path = str(tmp_path / "t.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, host TEXT, body BLOB)")
        db.executemany("INSERT INTO t VALUES (?, ?, ?)", [(k, f"h{k}", bytes([k])) for k in range(1, 12)])
    out = readers.read_sqlite(spark, path, "t", StructType.fromDDL("id long, host string, body binary"), slice_rows=3)
    assert sorted((r["id"], r["host"], bytes(r["body"])) for r in out.collect()) == [(k, f"h{k}", bytes([k])) for k in range(1, 12)]
    assert readers.browse(out, 1).first()["body"] == "01"
