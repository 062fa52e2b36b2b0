"""Structured Streaming twins of the run-log operators, and event-time windows.

State is kept per key and bounded: a host keeps one flag, a run keeps a counter and the few hosts of a streak.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_stream(spark: SparkSession, path: str, schema, max_files: int = 10_000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def quarantine_stream(log: DataFrame) -> DataFrame:
    """STR-2: rows (host, seq, pushback boolean) with quarantined: true after a host's first pushback. Rows of one
    trigger are taken in their order; a later trigger's rows are later."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        shut = state.get[0] if state.exists else False
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for push in rows["pushback"]:
            out.append(shut)
            shut = shut or bool(push)
        state.update((shut,))
        yield pd.DataFrame({"host": key[0], "seq": rows["seq"].to_numpy(), "quarantined": out})

    return log.groupBy("host").applyInPandasWithState(run, "host string, seq long, quarantined boolean", "shut boolean", "append", GroupStateTimeout.NoTimeout)


def streak_stream(log: DataFrame, streak: int = 8, least_hosts: int = 4) -> DataFrame:
    """STR-1: rows (run, seq, host, failed boolean) with the streak of failures, its hosts and suspect. A success sets
    both back; hosts are only remembered up to the number that matters."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, seen = (state.get[0], set(filter(None, state.get[1].split("\x1f")))) if state.exists else (0, set())
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for host, failed in zip(rows["host"], rows["failed"]):
            if failed:
                n += 1
                if len(seen) < least_hosts:
                    seen.add(host or "")
            else:
                n, seen = 0, set()
            out.append((n, len(seen), n >= streak and len(seen) >= least_hosts))
        state.update((n, "\x1f".join(sorted(seen))))
        a, b, c = zip(*out)
        yield pd.DataFrame({"run": key[0], "seq": rows["seq"].to_numpy(), "streak": a, "hosts": b, "suspect": c})

    return log.groupBy("run").applyInPandasWithState(run, "run string, seq long, streak int, hosts int, suspect boolean", "n int, hosts string", "append", GroupStateTimeout.NoTimeout)


def ready_stream(log: DataFrame, floor_s: float) -> DataFrame:
    """STR-3: for each request (host, seq, asked timestamp) the time at which it may go: the floor after the host's
    last one."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for asked in rows["asked"]:
            t = asked.timestamp()
            last = t if last is None else max(t, last + floor_s)
            out.append(last)
        state.update((last,))
        yield pd.DataFrame({"host": key[0], "seq": rows["seq"].to_numpy(), "ready_at": out})

    return log.groupBy("host").applyInPandasWithState(run, "host string, seq long, ready_at double", "last double", "append", GroupStateTimeout.NoTimeout)


def finished_units(progress: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """STR-4: each finished unit once, however often it is reported, as long as the watermark remembers it."""
    return progress.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["run_id", "unit"])


def tumbling(events: DataFrame, ts: str, width: str, by: list[str], value: str, watermark: str = "1 hour") -> DataFrame:
    """Event-time windows with late data up to the watermark (an addition)."""
    w = events.withWatermark(ts, watermark) if events.isStreaming else events
    return w.groupBy(F.window(ts, width), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *by, "n", "total")


def sessions(events: DataFrame, ts: str, gap: str, by: list[str], watermark: str = "1 hour") -> DataFrame:
    """Session windows (an addition)."""
    w = events.withWatermark(ts, watermark) if events.isStreaming else events
    return w.groupBy(F.session_window(ts, gap), *by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n")


def run_to_end(stream: DataFrame) -> DataFrame:
    """Drive a bounded stream to its end into a table in the shared folder, where its checkpoint lies too, and read it."""
    import uuid

    from plumbline.session import shared_dir

    base = f"{shared_dir(stream.sparkSession)}/plumbline/{uuid.uuid4().hex}"
    q = stream.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/rows")
