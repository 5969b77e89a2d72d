import json
import time

import pytest
from pyspark.sql import functions as F

from tracewright.plans.pipeline import BASE, STAGES, Config, PipelineError, Runner, Step, config_value, select_steps
from tracewright.streaming.capture import stream_extract, stream_sessions, traffic_stream


def config(tmp_path, steps, rows=2):
    base = tmp_path / "base.jsonl"
    base.write_text("".join(json.dumps({"messages": [{"role": "user", "content": f"q{k} a@b.co"}], "completion": "r"}) + "\n" for k in range(rows)))
    return Config("run", str(base), str(tmp_path / "out"), steps)


def steps():
    return [Step("one", "sessionize", BASE), Step("two", "redact"), Step("three", "model_redact"), Step("four", "score"), Step("five", "corrections")]


def test_a_whole_run_and_its_report(spark, tmp_path):
    runner = Runner(spark, config(tmp_path, steps()))
    counts = runner.run()
    assert [(c["n_valid"], c["n_invalid"]) for c in counts] == [(2, 0)] * 5
    assert "| total | 10 | 0 |" in (tmp_path / "out/report.md").read_text()
    assert spark.read.parquet(str(tmp_path / "out/05-corrections")).where("messages[0].content like '%REDACTED%'").count() == 2


def test_resume_goes_on_after_the_last_finished_step(spark, tmp_path):
    ran = []

    def noted(name):
        def stage(df, **_):
            ran.append(name)
            if name == "b" and len(ran) == 2:
                raise RuntimeError("broken")
            return df

        return stage

    runner = Runner(spark, config(tmp_path, [Step("a", "a", BASE), Step("b", "b"), Step("c", "c")]), {n: noted(n) for n in "abc"})
    with pytest.raises(RuntimeError):
        runner.run()
    assert [c["stage"] for c in runner.run(resume=True)] == ["a", "b", "c"]
    assert ran == ["a", "b", "b", "c"]
    runner.config.steps[2].limit = 1  # another configuration has no checkpoint here
    assert runner.load_checkpoint() is None
    runner.run(force=True)
    assert ran[4:] == ["a", "b", "c"]


def test_invalid_rows_are_set_aside_and_stay_unless_dropped(spark, tmp_path):
    stages = STAGES | {"sessionize": lambda df, **_: STAGES["sessionize"](df).withColumn("trace_id", F.when(F.col("ord") > 0, F.col("trace_id")))}
    counts = Runner(spark, config(tmp_path, steps()[:2], 3), stages).run()
    assert [(c["n_valid"], c["n_invalid"]) for c in counts] == [(2, 1), (2, 1)]
    assert spark.read.json(str(tmp_path / "out/invalid/sessionize")).count() == 1
    counts = Runner(spark, config(tmp_path, steps()[:2], 3), stages, drop_invalid=True).run(force=True)
    assert [(c["n_valid"], c["n_invalid"]) for c in counts] == [(2, 1), (2, 0)]


def test_empty_input_and_missing_input(spark, tmp_path):
    assert [c["n_valid"] for c in Runner(spark, config(tmp_path, [Step("x", "x", BASE)], 0), {"x": lambda df, **_: df}).run()] == [0]
    broken = config(tmp_path, steps()[:1])
    broken.base_input += ".none"
    with pytest.raises(PipelineError):
        Runner(spark, broken).run()
    with pytest.raises(PipelineError):
        Runner(spark, config(tmp_path, [Step("first", "redact")])).run()
    with pytest.raises(PipelineError):
        Config.load({"name": "x"})


def test_steps_are_chosen_by_name_or_number():
    s = [Step("a", "x"), Step("b", "x", enabled=False), Step("c", "x")]
    names = lambda w: [x.name for x in select_steps(s, w)]
    assert names(None) == ["a", "c"] and names("3, b, 3, nope") == ["b", "c"] and names("9") == []


def test_settings_come_from_the_first_place_that_has_them():
    assert config_value("K", None, {"K": "7"}, {"K": "8"}, 9, int) == 7
    assert config_value("K", None, {}, {"K": "yes"}, False, bool) is True
    assert config_value("K", None, {}, {}, None, int) is None


def test_streams_give_what_batch_gives(spark, tmp_path):
    from tests.test_traces import answer, call
    from tracewright.schemas import HTTP_TRAFFIC

    good = {"contents": [{"role": "user", "parts": [{"text": "a"}]}]}
    spark.createDataFrame([call(1, good, answer("x")), call(2, good, answer("y"), status=500)], HTTP_TRAFFIC).write.parquet(str(tmp_path / "traffic"))
    q = stream_extract(traffic_stream(spark, str(tmp_path / "traffic"))).writeStream.format("memory").queryName("calls").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    assert [r["llm_response_text"] for r in spark.sql("SELECT * FROM calls").collect()] == ["x"]

    u, a = ("user", "q"), ("assistant", "r")
    rows = [("k", 0, [u], "r"), ("j", 1, [u], "r"), ("k", 2, [u, a, u], "s"), ("k", 3, [u], "t")]
    schema = "conv string, ord long, messages array<struct<role: string, content: string>>, completion string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "traces"))
    out = stream_sessions(spark.readStream.schema(schema).parquet(str(tmp_path / "traces")), "conv", timeout=None)
    q = out.writeStream.format("memory").queryName("sessions").outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM sessions").collect())
    assert got == [("j", 1, "session_001", 1), ("k", 0, "session_001", 1), ("k", 2, "session_001", 2), ("k", 3, "session_002", 1)]


def test_settled_rows_leave_no_shuffle_behind(spark):
    from tracewright import checkpoints

    shuffles = lambda: {x.strip("(,)") for x in str(spark._jsparkSession.sparkContext().env().blockManager().diskBlockManager().getAllBlocks()).removeprefix("ArraySeq").split() if "shuffle_" in x}
    before = shuffles()
    frame = spark.range(1000).repartition(7, "id")
    rows = checkpoints.settle(frame)
    waited = time.time() + 5
    while shuffles() - before and time.time() < waited:
        time.sleep(0.1)
    assert not shuffles() - before
    assert rows.count() == 1000 and frame.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_released_native_memory_goes_back_to_the_system(spark, monkeypatch):
    import re
    import time
    from pathlib import Path

    from tracewright import checkpoints

    jvm = spark.sparkContext._jvm
    rollup = Path(jvm.java.io.File("/proc/self").getCanonicalPath()) / "smaps_rollup"
    resident = lambda: sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", rollup.read_text()))) / 1024

    monkeypatch.setattr(checkpoints, "PAUSE", 0.0)
    jvm.System.gc()
    held = [jvm.java.util.zip.Deflater() for _ in range(1000)]  # each has some 200 KB outside the heap
    full = resident()
    for k, one in enumerate(held):
        if k % 10:
            one.end()  # those that stay keep the allocator from shrinking by itself
    jvm.System.gc()
    time.sleep(1)
    kept = resident()
    checkpoints.release(spark)
    after = resident()
    for one in held[::10]:
        one.end()
    assert after < kept - 40, (full, kept, after)
