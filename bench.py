"""Times the headline operators and queries on local cores and prints one JSON line.

Messages and layers are staged on disk first, so an operator is timed on what it reads in production: ingest
on message files, normalisers on the raw layer, compaction on the processed layer. Each entry is the best of
`RUNS` runs with results discarded.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import fixtures
from paylake.operators.asof import asof_join
from paylake.operators.delivery import check_stripe_events, verified_deliveries, with_message_key
from paylake.operators.envelope import read_envelopes, rejected_rows, valid_rows
from paylake.operators.metrics import cumulative, per_minute, trailing_rate
from paylake.operators.normalize import normalize, rejected_payloads
from paylake.plans import registry
from paylake.plans.jobs import compact_days, ingest_batch, process_days
from paylake.session import configure
from paylake.sources.layers import scan_processed, scan_raw
from paylake.sources.streams import file_messages
from paylake.streaming.ingest import drain_ingest

RUNS = int(os.environ.get("BENCH_RUNS", "2"))
FIRST, LAST = date(2024, 1, 1), date(2024, 1, 2)
SQL_QUERIES = [
    "sql_join_inner", "sql_join_left", "sql_range_join", "sql_anti", "sql_group_agg", "sql_cube", "sql_distinct", "sql_rank",
    "sql_lag_lead", "sql_range_frame", "sql_topk", "sql_topk_group", "sql_intersect", "sql_lateral", "sql_json", "sql_explode",
    "sql_session", "sql_time_bucket", "sql_pivot", "sql_stats", "range_join",
]


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="run-")

    fixtures.all_env(spark, sf_dir, folded=True).repartition(16).write.text(f"{work}/messages")
    messages = spark.read.text(f"{work}/messages")
    rows = messages.count()
    ingest_batch(messages, f"{work}/raw")
    process_days(spark, f"{work}/raw", f"{work}/processed", FIRST, LAST, ["faker", "stripe", "revolut"])
    events = fixtures.table(spark, sf_dir, "events")
    scan_raw(spark, f"{work}/raw", sources=["stripe"]).select(F.col("payload").alias("body")).repartition(16).write.parquet(f"{work}/bodies")
    bodies = spark.read.parquet(f"{work}/bodies")
    times = scan_raw(spark, f"{work}/raw").select("source", F.col("received_at").cast("timestamp_ntz").alias("ts"))
    queries = registry.queries()

    def raw(source: str) -> DataFrame:
        return scan_raw(spark, f"{work}/raw", sources=[source])

    def asof() -> DataFrame:
        transfers = scan_processed(spark, f"{work}/processed", "revolut").select("user_id", F.col("received_at").alias("ts"), "amount")
        credits = transfers.filter("amount > 50000").withColumnRenamed("amount", "large")
        return asof_join(transfers, credits, ["user_id"], "ts")

    def stream() -> None:
        root = tempfile.mkdtemp(prefix="run-")
        drain_ingest(file_messages(spark, f"{work}/messages"), f"{root}/raw", f"{root}/rejects", f"{root}/checkpoints")

    def fresh(job) -> None:
        job(tempfile.mkdtemp(prefix="run-"))

    sources = ["faker", "stripe", "revolut"]
    tasks = {
        "ingest_valid": lambda: discard(valid_rows(read_envelopes(messages))),
        "ingest_rejects": lambda: discard(rejected_rows(read_envelopes(messages))),
        "ingest_write": lambda: fresh(lambda root: ingest_batch(messages, root)),
        "stream_ingest": stream,
        "message_key": lambda: discard(with_message_key(messages)),
        "stripe_event_check": lambda: discard(check_stripe_events(bodies)),
        "webhook_signature": lambda: discard(verified_deliveries(fixtures.webhook_deliveries(events), fixtures.SIGNING_SECRET)),
        **{f"normalize_{s}": (lambda s=s: discard(normalize(raw(s), s))) for s in sources},
        "normalize_rejects": lambda: [discard(rejected_payloads(raw(s), s)) for s in sources],
        "process_days": lambda: fresh(lambda root: process_days(spark, f"{work}/raw", root, FIRST, LAST, sources)),
        "compact": lambda: fresh(lambda root: compact_days(spark, f"{work}/processed", root, FIRST, LAST, sources, 1 << 20)),
        "rate_by_source": lambda: discard(trailing_rate(times, ["source"])),
        "increase_1m": lambda: discard(per_minute(times)),
        "cumulative": lambda: discard(cumulative(times, ["source"])),
        "asof_join": lambda: discard(asof()),
        **{name: (lambda name=name: discard(queries[name](spark, sf_dir))) for name in SQL_QUERIES},
    }

    seconds = {}
    for name, task in tasks.items():
        best = float("inf")
        for _ in range(RUNS):
            started = time.perf_counter()
            task()
            best = min(best, time.perf_counter() - started)
        seconds[name] = round(best, 3)
        print(f"{name}: {best:.3f}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1], "messages": rows, "messages_per_second": round(rows / seconds["ingest_valid"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
