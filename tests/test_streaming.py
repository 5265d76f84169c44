import json
import os

import pytest
from pyspark.sql import functions as F

from paylake.operators import metrics
from paylake.operators.envelope import read_envelopes, valid_rows
from paylake.plans.jobs import ingest_batch
from paylake.plans.table_queries import _fed
from paylake.session import settings
from paylake.sources.layers import scan_raw
from paylake.sources.streams import file_messages, kafka_messages, send_to_kafka
from paylake.streaming import ingest
from paylake.streaming.ingest import drain_ingest, start_ingest
from paylake.streaming.rates import live_counts, live_rates
from paylake.streaming.sessions import live_sessions, once_each
from paylake.streaming.updates import STATE_PARTS, latest, start_updates, store_updates


def text(number, minute=0, hour=10):
    at = f"2026-02-15T{hour:02d}:{minute:02d}:00.000"
    return json.dumps({"source": ["faker", "stripe"][number % 2], "received_at": at, "payload": {"n": number}})


def put(folder, name, lines):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}", "w") as file:
        file.write("\n".join(lines) + "\n")


def drain(spark, folder, files_per_batch=1):
    return drain_ingest(
        file_messages(spark, f"{folder}/in", files_per_batch), f"{folder}/raw", f"{folder}/rejects", f"{folder}/checkpoints"
    )


def stored(spark, folder):
    return sorted(json.loads(row.payload)["n"] for row in scan_raw(spark, f"{folder}/raw").collect())


def test_several_batches_store_what_one_batch_would(spark, folder):
    for batch in range(4):
        put(folder, f"{batch}.txt", [text(batch * 10 + i, minute=i, hour=8 + batch) for i in range(10)])
    drain(spark, folder)
    assert stored(spark, folder) == list(range(40))
    streamed = scan_raw(spark, f"{folder}/raw")
    batch = valid_rows(read_envelopes(spark.read.text(f"{folder}/in")))
    assert streamed.exceptAll(batch.select(streamed.columns)).count() == 0


def test_restart_adds_only_what_is_new(spark, folder):
    put(folder, "1.txt", [text(1), "junk", text(2), "{}"])
    assert drain(spark, folder) == {"accepted": 2, "refused": 2}
    assert drain(spark, folder) == {"accepted": 0, "refused": 0}
    assert stored(spark, folder) == [1, 2]
    assert spark.read.parquet(f"{folder}/rejects").count() == 2
    put(folder, "2.txt", [text(3), "[]"])
    drain(spark, folder)
    assert stored(spark, folder) == [1, 2, 3]
    reasons = {row.reason: row["count"] for row in spark.read.parquet(f"{folder}/rejects").groupBy("reason").count().collect()}
    assert reasons == {"not_object": 2, "missing_key": 1}


def test_a_batch_is_not_kept_and_nothing_is_sorted(spark, folder, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refuses(*_):
        raise AssertionError("a batch may be larger than the memory")

    monkeypatch.setattr(DataFrame, "persist", refuses)
    seen, replace = [], ingest.replace_parts

    def replaces(df, *arguments, **options):
        seen.append(int(df.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        replace(df, *arguments, **options)

    monkeypatch.setattr(ingest, "replace_parts", replaces)
    put(folder, "1.txt", [text(i, hour=i % 24) for i in range(30)] + ["junk"])
    assert drain(spark, folder) == {"accepted": 30, "refused": 1}
    assert stored(spark, folder) == list(range(30)) and spark.read.parquet(f"{folder}/rejects").count() == 1
    assert seen and min(seen) >= 48 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_late_messages_go_to_their_own_hour(spark, folder):
    put(folder, "1.txt", [text(1, hour=12)])
    drain(spark, folder)
    put(folder, "2.txt", [text(2, hour=3)])
    drain(spark, folder)
    assert {(row.hr, json.loads(row.payload)["n"]) for row in scan_raw(spark, f"{folder}/raw").collect()} == {("12", 1), ("03", 2)}


def test_continuous_run_can_be_stopped(spark, folder):
    put(folder, "1.txt", [text(1), text(2)])
    query = start_ingest(
        file_messages(spark, f"{folder}/in"), f"{folder}/raw", f"{folder}/rejects", f"{folder}/checkpoints"
    )
    query.processAllAvailable()
    query.stop()
    assert stored(spark, folder) == [1, 2]


def test_every_batch_is_counted_whatever_the_engine_remembers(spark, folder):
    for batch in range(8):
        put(folder, f"{batch}.txt", [text(batch), "junk"])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        assert drain(spark, folder) == {"accepted": 8, "refused": 8}
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert stored(spark, folder) == list(range(8))


def test_a_crash_between_write_and_commit_repeats_nothing(spark, folder, monkeypatch):
    put(folder, "1.txt", [text(1), text(2), "junk"])
    store = ingest._store

    def dies_after_writing(*arguments):
        store(*arguments)
        raise OSError("lost")

    monkeypatch.setattr(ingest, "_store", dies_after_writing)
    with pytest.raises(Exception, match="lost"):
        drain(spark, folder)
    monkeypatch.setattr(ingest, "_store", store)
    put(folder, "2.txt", [text(3)])
    assert drain(spark, folder) == {"accepted": 3, "refused": 1}
    assert stored(spark, folder) == [1, 2, 3] and spark.read.parquet(f"{folder}/rejects").count() == 1
    assert not os.path.exists(f"{folder}/raw/_spark_metadata")


def test_streams_and_batches_share_a_layer(spark, folder):
    put(folder, "1.txt", [text(1)])
    drain(spark, folder)
    ingest_batch(spark.read.text(f"{folder}/in"), f"{folder}/raw")
    drain_ingest(file_messages(spark, f"{folder}/in"), f"{folder}/raw", f"{folder}/r", f"{folder}/c")
    assert stored(spark, folder) == [1, 1, 1]


def test_ingest_does_not_shuffle(spark, folder):
    put(folder, "1.txt", [text(1)])
    rows = valid_rows(read_envelopes(spark.read.text(f"{folder}/in")))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("live, batch, keys", [
    (live_counts, metrics.per_minute, ["minute", "source"]),
    (live_rates, metrics.trailing_rate, ["window_end", "source"]),
])
def test_live_metrics_equal_batch_metrics(spark, folder, live, batch, keys):
    for part in range(3):
        put(folder, f"{part}.txt", [text(i, minute=(part * 7 + i) % 30) for i in range(50)])

    def events(messages):
        envelopes = valid_rows(read_envelopes(messages))
        return envelopes.select("source", F.col("received_at").cast("timestamp_ntz").alias("ts"))

    updates = live(events(file_messages(spark, f"{folder}/in", 1)), ["source"], lateness="1 hour")
    store_updates(updates, f"{folder}/updates", f"{folder}/state")
    expected = batch(events(spark.read.text(f"{folder}/in")), ["source"])
    found = latest(spark, f"{folder}/updates", keys).select(expected.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_the_newest_row_is_of_the_highest_batch(spark, folder):
    """Twelve batches change one key; as text, batch 9 would come last."""
    schema = "id bigint, ts timestamp_ntz"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/in")
    live = live_counts(spark.readStream.schema(schema).parquet(f"{folder}/in"), [], lateness="1 day")
    running = start_updates(live, f"{folder}/out", f"{folder}/state")
    for batch in range(12):
        spark.range(batch + 1).selectExpr("id", "timestamp_ntz'2026-02-15 10:00:00' AS ts").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        running.processAllAvailable()
    running.stop()
    assert [row.n for row in latest(spark, f"{folder}/out", ["minute"]).collect()] == [78]


def test_values_of_the_newest_row_stay_together(spark, folder):
    for batch, row in enumerate([("k", 1, "a"), ("k", None, "b")]):
        spark.createDataFrame([row], "key string, n int, t string").write.parquet(f"{folder}/u/batch={batch}")
    assert [tuple(r) for r in latest(spark, f"{folder}/u", ["key"]).collect()] == [("k", None, "b")]


def _hours(spark, folder, build, batches, schema="id string, user string, ts timestamp"):
    """Feed rows (id, user, hour) batch by batch; returns the rows given, and the state rows held after each batch."""
    spark.createDataFrame([], schema).write.parquet(f"{folder}/in")
    running = start_updates(build(spark.readStream.schema(schema).parquet(f"{folder}/in")), f"{folder}/out", f"{folder}/state", "append")
    held = []
    for rows in batches:
        made = spark.createDataFrame([(i, u, f"2026-02-15 00:00:00 +{h}") for i, u, h in rows], "id string, user string, t string")
        made = made.selectExpr("id", "user", "timestamp'2026-02-15 00:00:00' + make_interval(0, 0, 0, 0, int(split(t, '[+]')[1])) AS ts")
        made.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        running.processAllAvailable()
        held.append(sum(s["numRowsTotal"] for s in running.lastProgress["stateOperators"]))
    running.stop()
    return spark.read.parquet(f"{folder}/out"), held


def test_messages_are_kept_once_and_forgotten_with_the_watermark(spark, folder):
    batches = [[(f"m{h}", "u", h), (f"m{h}", "v", h), *([(f"m{h - 1}", "u", h - 1)] if h else [])] for h in range(14)]
    out, held = _hours(spark, folder, lambda live: once_each(live, ["id"], "ts", "3 hours"), batches)
    assert sorted(r["id"] for r in out.collect()) == sorted(f"m{h}" for h in range(14))
    assert max(held[6:]) <= 6  # a key is held for three hours, and the watermark trails by three, however long the stream runs


def test_sessions_close_with_the_watermark(spark, folder):
    rows = {"a": [0, 1, 2, 9, 10, 20], "b": [0, 5, 6, 7, 20]}
    every = sorted((h, u) for u, hours in rows.items() for h in hours)
    batches = [[(f"{u}{h}", u, h) for h, u in every if h == hour] for hour in sorted({h for h, _ in every})]
    batches.append([("late", "a", 1)])
    batches.append([("end", "c", 60)])
    batches.append([("after", "c", 61)])
    out, held = _hours(spark, folder, lambda live: live_sessions(live, ["user"], "2 hours", lateness="1 hour"), batches)
    got = sorted((r["user"], r["began"].hour, r["n"]) for r in out.collect())
    assert got == [("a", 0, 3), ("a", 9, 2), ("a", 20, 1), ("b", 0, 1), ("b", 5, 3), ("b", 20, 1)]
    assert max(held) <= 4


def test_repeats_and_sessions_in_one_stream(spark, folder):
    batches = [[(f"m{h}", "u", h), (f"m{h}", "u", h)] + ([(f"m{h - 1}", "u", h - 1)] if h else []) for h in range(5)] + [[("end", "w", 40)], [("more", "w", 41)], [("last", "w", 42)]]

    def build(live):
        return live_sessions(once_each(live, ["id"], "ts", "2 hours"), ["user"], "90 minutes", lateness=None)

    out, _ = _hours(spark, folder, build, batches)
    assert [(r["user"], r["n"]) for r in out.collect()] == [("u", 5)]


def test_a_streams_state_has_as_many_parts_as_the_cores_need(spark, folder):
    rows = [("a", "u", 0), ("b", "v", 1)]
    with settings(spark, {"spark.sql.shuffle.partitions": "40"}):
        spark.createDataFrame(rows, "id string, user string, h int").selectExpr("id", "timestamp_seconds(3600 + h) AS ts").write.parquet(f"{folder}/in")
        live = once_each(spark.readStream.schema("id string, ts timestamp").parquet(f"{folder}/in"), ["id"], "ts", "1 hour")
        running = start_updates(live, f"{folder}/out", f"{folder}/state", "append", drain=True)
        running.awaitTermination()
        parts = [s["numShufflePartitions"] for p in running.recentProgress for s in p["stateOperators"]]
        assert set(parts) == {STATE_PARTS * spark.sparkContext.defaultParallelism} and max(parts) < 40
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/out").collect()) == ["a", "b"]


def test_an_arrival_is_one_batch_of_the_stream(spark, folder):
    rows = spark.range(0, 3000, 1, 30).selectExpr("id", "id % 3 AS arrival")
    seen = []

    def start(live):
        return live.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count())).option("checkpointLocation", f"{folder}/state").start()

    _fed(rows, folder, start)
    assert seen == [1000, 1000, 1000]


class Recorded:
    """Stands for a reader or writer and keeps what it is told, as there is no connector here."""

    def __init__(self, streaming=False):
        self.told, self.isStreaming = {}, streaming
        self.readStream = self.writeStream = self.write = self

    def format(self, name):
        return self.options(format=name)

    def option(self, key, value):
        return self.options(**{key: value})

    def options(self, **more):
        self.told |= more
        return self

    def load(self):
        return self

    start = save = load


def test_batches_of_messages_start_by_count_or_delay():
    told = kafka_messages(Recorded(), "a:1,b:2", ["faker", "stripe"]).told
    assert told == {
        "format": "kafka", "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "faker,stripe", "startingOffsets": "earliest",
        "minOffsetsPerTrigger": 1000, "maxTriggerDelay": "180s",
    }
    told = kafka_messages(Recorded(), "a:1", ["faker"], smallest_batch=5, longest_wait="1s", largest_batch=9).told
    assert (told["minOffsetsPerTrigger"], told["maxTriggerDelay"], told["maxOffsetsPerTrigger"]) == (5, "1s", 9)


def test_a_sent_stream_keeps_its_place():
    table = {"format": "kafka", "kafka.bootstrap.servers": "a:1", "topic": "t"}
    assert send_to_kafka(Recorded(), "a:1", "t").told == table
    assert send_to_kafka(Recorded(streaming=True), "a:1", "t", "/checks").told == table | {"checkpointLocation": "/checks"}
