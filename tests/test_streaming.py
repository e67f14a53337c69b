"""Keyed pacing state: single steps, the batch twin, and the stream against the twin."""

from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from wordtide.functions import text as T
from wordtide.streaming import logs, pacing

START = datetime(2026, 9, 28, 15, tzinfo=UTC)


def test_steps():
    p, t = pacing.Pace(), START
    assert p.apply("claim", t) == "blocked"
    assert p.apply("resume", t) == "resumed" and p.level == 1
    assert p.apply("claim", t) == "reserved"
    assert p.apply("claim", t) == "awaiting_capture" and p.apply("resume", t) == "refused_inflight"
    assert p.apply("success", t + timedelta(seconds=30)) == "completed"
    assert p.apply("claim", t + timedelta(seconds=50)) == "waiting_interval"
    assert p.apply("claim", t + timedelta(seconds=75)) == "reserved"
    assert p.apply("cooldown", t + timedelta(seconds=80)) == "cooling_down" and p.level == 2
    assert p.due == t + timedelta(seconds=80 + 7200)
    assert p.apply("claim", t + timedelta(seconds=100)) == "cooling_down"
    for _ in range(20):
        p.apply("cooldown", t)
    assert p.due == t + timedelta(seconds=86400)
    assert p.apply("block", t) == "blocked" and p.apply("claim", t + timedelta(days=9)) == "blocked"


def test_healthy_reset():
    p = pacing.Pace()
    p.apply("resume", START)
    for i in range(6):
        now = START + timedelta(minutes=5 * i)
        assert p.apply("claim", now) == "reserved" and p.apply("success", now) == "completed"
    assert p.level == 0 and p.healthy == 6


def test_retry_at(spark):
    texts = ["60", "-5", "soon", None, "", " 60 ", "Mon, 28 Sep 2026 16:00:00 GMT", "28 Sep 2026 18:00:00 +0200", "Mon, 28 Sep 2026 14:00:00 GMT", "28-SEP-2026 17:00:00", "99999999999999", "31 Feb 2026 10:00:00 GMT", "1e3"]
    df = spark.createDataFrame([(i, t, START) for i, t in enumerate(texts)], "i int, v string, at timestamp")
    got = [r["s"] for r in df.select("i", (F.unix_timestamp(T.retry_at(F.col("v"), F.col("at"))) - F.unix_timestamp("at")).alias("s")).orderBy("i").collect()]
    assert got == [60, 0, 0, 0, 0, 60, 3600, 3600, 0, 7200, 3_155_760_000, 0, 0]


def test_a_pace_waits_for_the_later_of_both():
    p = pacing.Pace()
    assert p.apply("resume", START, START + timedelta(hours=2)) == "resumed" and p.status == "cooldown" and p.due == START + timedelta(hours=2)
    p.apply("cooldown", START, START + timedelta(days=3))
    assert p.due == START + timedelta(days=3)


SCHEMA = "root string, at timestamp, op string, retry_after string, seq bigint"


def log(spark, n=60):
    ops = ["resume", "claim", "success", "claim", "cooldown"]
    rows = [(f"r{i % 3}", (START + timedelta(seconds=40 * i)).replace(tzinfo=None), ops[(i * 7 + i // 3) % 5], None, i) for i in range(n)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["root", "at", "op", "retry_after", "seq"]), SCHEMA)


def key(rows):
    return sorted((r["root"], str(r["at"]), r["op"], r["outcome"], r["status"], str(r["due"]), r["level"], r["healthy"]) for r in rows)


def test_stream_matches_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    events = log(spark)
    events.where("seq < 30").coalesce(1).write.parquet(str(tmp_path / "in"))
    events.where("seq >= 30").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = pacing.paced(stream).writeStream.format("memory").queryName("paced").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert key(spark.table("paced").collect()) == key(pacing.replay(events).collect())


def test_append_once_and_daily(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int").write.parquet(str(tmp_path / "in"))
    stream = logs.read_stream(spark, str(tmp_path / "in"), "k string, v int")
    for _ in range(2):
        logs.append_once(stream, "k", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    done = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["k"] for r in done.collect()) == ["a", "b"]
    queue = spark.createDataFrame([("a",), ("c",)], "k string")
    assert [r["k"] for r in logs.pending(queue, done, "k").collect()] == ["c"]
    old = spark.createDataFrame([("a", 5, "x"), ("b", 1, "y")], "k string, at int, v string")
    new = spark.createDataFrame([("a", 5, "later file"), ("b", 2, "z"), ("c", 1, "w")], "k string, at int, v string")
    merged = {r["k"]: r["v"] for r in logs.merge_latest(old, new, "k", "at").collect()}
    assert merged == {"a": "x", "b": "z", "c": "w"}


def test_replay_holds_one_batch(spark):
    """A root's log goes through in batches, its state is carried over, and roots stay apart."""
    ops, begin = ("resume", "claim", "success", "claim", "cooldown"), datetime(2026, 1, 1)
    log = [("hot" if i % 4 else f"r{i % 3}", begin + timedelta(seconds=20 * i), ops[i * 7 % 5], None, i) for i in range(400)]
    want, paces = [], {}
    for root, at, op, _, _ in log:
        pace = paces.setdefault(root, pacing.Pace())
        outcome = pace.apply(op, at.replace(tzinfo=UTC))
        want.append((root, at, outcome, pace.status, pace.level, pace.healthy))
    events = spark.createDataFrame(log[::-1], "root string, at timestamp, op string, retry_after string, seq long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        out = pacing.replay(events)
        got = [(r["root"], r["at"], r["outcome"], r["status"], r["level"], r["healthy"]) for r in out.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got) == sorted(want)
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString()
