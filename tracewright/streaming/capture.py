"""Live capture: traffic files as a stream, extracted by the batch expressions, and sessions per key with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.extract import TARGET_HOSTS, extract_traces
from ..operators.sessionize import _print
from ..operators.shape import message
from ..schemas import HTTP_TRAFFIC


def capture_rows(exchanges: DataFrame) -> DataFrame:
    """Traffic rows from exchanges: header maps as JSON, seconds from request start to response end, null if either is missing."""
    seconds = (F.col("response_end").cast("double") - F.col("request_start").cast("double")).alias("duration")
    names = [f.name for f in HTTP_TRAFFIC.fields]
    made = {"request_headers": F.to_json("request_headers").alias("request_headers"), "response_headers": F.to_json("response_headers").alias("response_headers"), "duration": seconds}
    return exchanges.select(*[made.get(n, F.col(n)) for n in names])


def capture_sink(exchanges: DataFrame, folder: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Exchanges appended to the traffic folder as Parquet; each once, as the checkpoint remembers what was written."""
    out = capture_rows(exchanges).writeStream.format("parquet").outputMode("append").option("path", folder).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if available_now else out).start()


def traffic_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(HTTP_TRAFFIC).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def stream_extract(traffic: DataFrame, targets=TARGET_HOSTS) -> DataFrame:
    """The batch extraction as it is: it has no state."""
    return extract_traces(traffic, targets)


SESSION = "key string, ord long, session_id string, turn_in_session_id int"


def stream_sessions(traces: DataFrame, key_col: str, timeout: str | None = "1 hour") -> DataFrame:
    """Session and turn of each trace within its key, in order of arrival and ``ord``.

    A key's state is the fingerprint of its last trace, its session and turn; it
    is dropped when the key is silent for the timeout, and never for None.  With a
    timeout a session's name ends in @ and the ``ord`` of the first trace since the
    key was last silent, so that a key that comes back repeats no name.  Unlike in
    batch, traces of other keys between two turns do not break a session.
    """
    n = F.size("messages")
    rows = traces.where(F.col("messages").isNotNull() & F.col("completion").isNotNull()).select(
        F.col(key_col).cast("string").alias("key"),
        "ord",
        _print(F.when(n > 1, F.slice("messages", 1, n - 1)).otherwise(F.slice("messages", 1, 0))).alias("context"),
        _print(F.concat("messages", F.array(message(F.lit("assistant"), F.col("completion"))))).alias("whole"),
    )
    wait = int(pd.Timedelta(timeout).total_seconds() * 1000) if timeout else 0

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, session, turn, since = state.get if state.exists else ("", 0, 0, -1)
        for frame in frames:
            frame = frame.sort_values("ord", kind="stable")
            out = []
            for ord_, context, whole in zip(frame["ord"], frame["context"], frame["whole"], strict=True):
                if context == last and session:
                    turn += 1
                else:
                    session, turn = session + 1, 1
                last = whole
                since = int(ord_) if since < 0 else since
                out.append((key[0], ord_, f"session_{session:03d}" + (f"@{since}" if wait else ""), turn))
            yield pd.DataFrame(out, columns=["key", "ord", "session_id", "turn_in_session_id"])
        state.update((last, session, turn, since))
        if wait:
            state.setTimeoutDuration(wait)

    return rows.groupBy("key").applyInPandasWithState(step, SESSION, "last string, session int, turn int, since long", "append", GroupStateTimeout.ProcessingTimeTimeout if wait else GroupStateTimeout.NoTimeout)
