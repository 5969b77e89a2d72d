"""What keeps data safe and private, and the edges: sinks, model server, command line, inspection."""

import json
import sqlite3
import threading
import time
import tracemalloc
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tracewright.__main__ import main, stages_for
from tracewright.operators import model_stage, shape
from tracewright.plans.pipeline import BASE, STAGES, Config, Runner, Step
from tracewright.schemas import HTTP_TRAFFIC
from tracewright.sources import readers, writers
from tracewright.streaming.capture import capture_rows, capture_sink, stream_sessions

TRACES = "trace_id string, messages array<struct<role: string, content: string>>, completion string, ord long"


class Failing:
    name = "failing"

    def ask(self, system, user):
        raise model_stage.ModelError("503 busy") if "fail" in user else ValueError("odd")


def test_null_and_repeated_keys_are_redacted(spark):
    rows = [(None, [("user", "mail a@b.co")], "x", 0), (None, [("user", "c@d.co")], "", 1), ("t", [("user", "e@f.co")], "a@b.co", 2), ("t", [("user", "g")], "e@f.co", 3)]
    got = model_stage.redact_by_model(spark.createDataFrame(rows, TRACES), model_stage.RuleClient).orderBy("ord").collect()
    assert [r["messages"][0]["content"] for r in got] == ["mail [EMAIL_ADDRESS_REDACTED]", "[EMAIL_ADDRESS_REDACTED]", "[EMAIL_ADDRESS_REDACTED]", "g"]
    assert [r["completion"] for r in got] == ["x", "", "[EMAIL_ADDRESS_REDACTED]", "[EMAIL_ADDRESS_REDACTED]"]
    assert {r["llm_call_error"] for r in got} == {None}


def test_failed_calls_leave_a_mark(spark):
    rows = [("a", [("user", "fail here")], "", 0), ("b", [("user", "else")], "", 1), ("c", [("user", " ")], "", 2)]
    got = model_stage.redact_by_model(spark.createDataFrame(rows, TRACES), Failing).orderBy("ord").collect()
    assert [r["llm_call_error"] for r in got] == ["Model error: 503 busy", "Unexpected error: odd", None]


class Weighing:
    """Answers with the most bytes that Python has held since the client was made."""

    name = "weighing"

    def __init__(self):
        tracemalloc.start()

    def ask(self, system, user):
        most = tracemalloc.get_traced_memory()[1]
        if user == "last":
            tracemalloc.stop()
        return str(most)


def test_a_worker_that_asks_holds_few_prompts(spark):
    prompt = F.when(F.col("id") < 7999, F.repeat(F.lit("x"), 4000)).otherwise("last")  # 32 MB
    rows = spark.range(0, 8000, 1, 1).select(F.when(F.col("id") % 2 == 0, (1 << 53) + F.col("id") + 1).alias("n"), "id", prompt.alias("p"))
    got = model_stage.ask_all(rows, "", "p", "reply", Weighing).collect()
    assert [(r["id"], r["n"]) for r in got] == [(k, None if k % 2 else (1 << 53) + k + 1) for k in range(8000)]
    assert max(int(r["reply"]) for r in got) < 16 << 20 and {r["reply_error"] for r in got} == {None}


def test_null_prompts_are_not_sent_and_replies_keep_their_rows(spark):
    rows = spark.range(0, 700, 1, 2).select("id", F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 7 > 0, F.concat(F.lit("m"), "id", F.lit("@b.co"))).otherwise("fail")).alias("p"))
    client = lambda: type("Some", (), {"ask": lambda self, system, user: Failing().ask(system, user) if user == "fail" else user.upper()})()
    got = model_stage.ask_all(rows, "", "p", "reply", client, workers=3).orderBy("id").collect()
    want = [(None, None) if k % 3 == 0 else (f"M{k}@B.CO", None) if k % 7 else (None, "Model error: 503 busy") for k in range(700)]
    assert [(r["reply"], r["reply_error"]) for r in got] == want


def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_table(spark.range(5), path)
    with pytest.raises(Exception, match="boom"):
        writers.replace_table(spark.range(9).select(F.when(F.col("id") > 3, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    writers.replace_table(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_rows_invalid_after_model_redaction_go_no_further(spark, tmp_path):
    base = tmp_path / "base.jsonl"
    base.write_text("".join(json.dumps({"messages": [{"role": "user", "content": f"q{k}"}], "completion": "r"}) + "\n" for k in range(3)))
    lost = lambda df, **o: STAGES["model_redact"](df, **o).withColumn("trace_id", F.when(F.col("ord") > 0, F.col("trace_id")))
    steps = [Step("one", "sessionize", BASE), Step("two", "redact"), Step("three", "model_redact"), Step("four", "score")]
    counts = Runner(spark, Config("run", str(base), str(tmp_path / "out"), steps), STAGES | {"model_redact": lost}).run()
    assert [(c["n_valid"], c["n_invalid"]) for c in counts] == [(3, 0), (3, 0), (2, 1), (2, 0)]
    assert spark.read.json(str(tmp_path / "out/invalid/model_redact")).count() == 1


def call(k, text):
    request = json.dumps({"contents": [{"role": "user", "parts": [{"text": text}]}]})
    reply = json.dumps({"candidates": [{"content": {"parts": [{"text": "fine"}]}}], "modelVersion": "m"})
    host = "generativelanguage.googleapis.com"
    return (k, None, "POST", f"https://{host}/v1/models/m-1:generateContent", host, "1.1", "{}", request.encode(), 200, "OK", "1.1", "{}", reply.encode(), None, None, 0.1)


def test_traffic_to_training_examples_as_a_chain(spark, tmp_path):
    spark.createDataFrame([call(k, f"q{k}") for k in range(4)], HTTP_TRAFFIC).write.parquet(str(tmp_path / "traffic"))
    steps = [Step("one", "extract", BASE), Step("two", "examples"), Step("three", "sessionize")]
    counts = Runner(spark, Config("run", str(tmp_path / "traffic"), str(tmp_path / "out"), steps)).run()
    assert [c["n_valid"] for c in counts] == [4, 4, 4]
    one = spark.read.parquet(str(tmp_path / "out/02-examples")).orderBy("ord").first()
    assert [m["content"] for m in one["messages"]] == ["You are a helpful assistant.", "q0"] and one["completion"] == "fine" and one["trace_id"]


def test_exchanges_are_captured_once(spark, tmp_path):
    schema = "id long, request_headers map<string, string>, response_headers map<string, string>, request_start timestamp, response_end timestamp"
    rows = spark.sql("SELECT 1L AS id, map('a', 'b') AS request_headers, map('c', 'd') AS response_headers, timestamp'2024-01-01 00:00:00' AS request_start, timestamp'2024-01-01 00:00:02.5' AS response_end")
    rows.write.parquet(str(tmp_path / "in"))
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in HTTP_TRAFFIC.fields if f.name not in ("id", "request_headers", "response_headers", "duration")]
    one = capture_rows(spark.read.parquet(str(tmp_path / "in")).select("*", *rest)).first()
    assert one["duration"] == 2.5 and one["request_headers"] == '{"a":"b"}'
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in")).select("*", *rest)
        assert capture_sink(stream, str(tmp_path / "traffic"), str(tmp_path / "ck"), available_now=True).awaitTermination(60)
    assert readers.read_traffic(spark, str(tmp_path / "traffic")).count() == 1


def test_a_key_that_comes_back_repeats_no_session_name(spark, tmp_path):
    rows = [("k", 4, [("user", "q")], "r"), ("k", 6, [("user", "z")], "s")]
    schema = "conv string, ord long, messages array<struct<role: string, content: string>>, completion string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "traces"))
    out = stream_sessions(spark.readStream.schema(schema).parquet(str(tmp_path / "traces")), "conv", timeout="1 hour")
    q = out.writeStream.format("memory").queryName("named").outputMode("append").start()
    began = time.time()
    while spark.sql("SELECT * FROM named").count() < 2 and time.time() - began < 90:
        time.sleep(0.5)
    q.stop()  # a stream with timeouts never ends of itself
    assert sorted(r["session_id"] for r in spark.sql("SELECT * FROM named").collect()) == ["session_001@4", "session_002@4"]


@pytest.fixture
def server():
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append(body)
            bad = "bad" in body["messages"][1]["content"]
            answer = {"error": "no such model"} if bad else {"message": {"content": json.dumps({"pii_list": [{"category": "PERSON_NAME", "value": "Ann"}]})}}
            data = json.dumps(answer).encode()
            self.send_response(404 if bad else 200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *a):
            pass

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}", asked
    http.shutdown()


def test_a_chat_server_is_asked_for_a_shape_and_its_errors_are_told(spark, server):
    url, asked = server
    client = model_stage.HttpClient(url + "/", "m", model_stage.PII_SHAPE)
    assert "Ann" in client.ask("s", "u") and asked[0]["format"]["required"] == ["pii_list"] and asked[0]["stream"] is False
    with pytest.raises(model_stage.ModelError, match="404 no such model"):
        client.ask("s", "bad")
    got = stages_for(url, "m")["model_redact"](spark.createDataFrame([("t", [("user", "Ann is here")], "bad", 0)], TRACES)).first()
    assert got["messages"][0]["content"] == "[PERSON_NAME_REDACTED] is here" and got["llm_call_error"] == "Model error: 404 no such model"
    assert stages_for(None, "m") is STAGES


def test_the_command_line_runs_a_chain(spark, tmp_path):
    base = tmp_path / "base.jsonl"
    base.write_text(json.dumps({"messages": [{"role": "user", "content": "q"}], "completion": "r"}) + "\n")
    config = tmp_path / "run.json"
    config.write_text(json.dumps({"name": "n", "base_input": str(base), "folder": str(tmp_path / "out"), "steps": [{"name": "one", "stage": "sessionize", "input": BASE}, {"name": "two", "stage": "redact"}]}))
    assert main([str(config), "--steps", "1", "--log-file", str(tmp_path / "log")], spark) == 0
    assert main([str(config), "--resume", "--log-level", "DEBUG"], spark) == 0
    assert spark.read.parquet(str(tmp_path / "out/02-redact")).count() == 1 and "sessionize: 1 valid" in (tmp_path / "log").read_text()
    assert main([str(tmp_path / "none.json")], spark) == 1


def test_inspection(spark, tmp_path):
    with sqlite3.connect(tmp_path / "x.db") as db:
        db.execute("CREATE TABLE t (id INTEGER, name TEXT)")
    assert readers.sqlite_catalog(str(tmp_path / "x.db")) == {"t": [("id", "INTEGER"), ("name", "TEXT")]}
    assert readers.has_table(str(tmp_path / "x.db"), "t") and not readers.has_table(str(tmp_path / "x.db"), "u")
    (tmp_path / "bad.db").write_text("no database at all, just text " * 40)
    with pytest.raises(ValueError, match="bad.db"):
        readers.sqlite_catalog(str(tmp_path / "bad.db"))
    df = spark.createDataFrame([(1, None), (2, "b")], "a long, `b.c` string")
    assert [tuple(r) for r in readers.summary(df).collect()] == [("a", "bigint", 2, 2), ("b.c", "string", 1, 2)]
    traffic = spark.createDataFrame([call(2, "hello"), call(1, "first")], HTTP_TRAFFIC)
    (one,) = readers.sample_calls(traffic, ("googleapis.com",)).collect()
    assert one["id"] == 1 and "first" in one["request_content"] and "fine" in one["response_content"]


def test_inferred_transposed_messages_are_turned(spark):
    df = spark.createDataFrame([({"role": ["user", "assistant"], "content": ["q", "r"]},)], "messages struct<role: array<string>, content: array<string>>")
    assert [tuple(m) for m in shape.by_name(df).first()["messages"]] == [("user", "q"), ("assistant", "r")]
