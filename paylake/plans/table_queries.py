"""Registered queries for streams that arrive in batches, damaged files, windows over whole tables, and NOT IN."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paylake import fixtures
from paylake.operators.absent import not_in
from paylake.operators.distinct_sketches import ERROR, daily_sketches, estimate, in_both, only_in, united
from paylake.operators.ordered import with_ranks, with_row_numbers
from paylake.operators.overlaps import overlap_join
from paylake.operators.quantiles import RANK_ERROR, estimated_percentiles, exact_percentiles, merged_sketches, quantile_sketches, rank_errors
from paylake.operators.samples import bottom_k, share
from paylake.plans.jobs import ingest_batch
from paylake.plans.lake_queries import query
from paylake.session import scratch_folder
from paylake.sources import quarantine
from paylake.sources.layers import scan_raw
from paylake.streaming.rates import live_counts
from paylake.streaming.sessions import live_sessions, once_each
from paylake.streaming.updates import appended, latest, start_updates


# --- streams of more than ten batches --------------------------------------------------------------

#: Slices of event time; an event arrives in its slice's batch or later. Watermarks trail by LATE_SLICES of them.
SLICES, LATE_SLICES = 12, 3
GAP_HOURS = 6

#: Every tenth event is a batch late, every seventh is sent twice, and some come when the watermark has passed them.
_ARRIVALS = f"""b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
s AS (SELECT events.*, lo, hi, (epoch_us(ts) - lo) * {SLICES} // (hi - lo + 1) AS slice FROM events, b),
kept AS (SELECT *, hi // 1000 - ((hi - lo + 1) * {LATE_SLICES} // {SLICES} // 1000000 + 2) * 1000 AS watermark
    FROM s WHERE NOT (event_id % 101 = 5 AND slice <= 6))"""


def _arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Events with the batch they arrive in, and the watermark's delay."""
    events = fixtures.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    slices = events.withColumn("slice", F.expr(f"(unix_micros(ts) - {lo}) * {SLICES} div {hi - lo + 1}"))
    arrival = F.expr("slice + CASE WHEN event_id % 101 = 5 AND slice <= 6 THEN 6 WHEN event_id % 10 = 3 THEN 1 ELSE 0 END")
    once = slices.withColumn("arrival", arrival)
    again = once.filter("event_id % 7 = 0").withColumn("arrival", F.col("arrival") + 1)
    delay = (hi - lo + 1) * LATE_SLICES // SLICES // 1_000_000 + 2
    return once.unionByName(again).drop("slice"), f"{delay} seconds"


def _fed(batches: DataFrame, root: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Start a stream over a folder and let the batches arrive there one after another, by their column `arrival`.

    A batch is written once, and its folder renamed, so the stream does not see a part of it.
    """
    spark, rows = batches.sparkSession, batches.drop("arrival")
    batches.write.partitionBy("arrival").parquet(f"{root}/batches")
    numbers = sorted(int(r[0]) for r in batches.select("arrival").distinct().collect())
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path(f"{root}/in"))
    running = start(spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{root}/in"))
    try:
        for n in numbers:
            if not files.rename(path(f"{root}/batches/arrival={n}"), path(f"{root}/in/arrival={n}")):
                raise OSError(f"batch {n} could not be moved to {root}/in")
            running.processAllAvailable()
    finally:
        running.stop()


@query("SELECT event_type, date_trunc('minute', date_trunc('day', ts)) AS minute, count(*) AS n FROM events GROUP BY ALL")
def stream_latest(spark, sf_dir):
    """Counts that every one of twelve batches updates; the newest row of a key is the one of the highest batch number."""
    root = scratch_folder(spark, "stream-latest")
    events = fixtures.table(spark, sf_dir, "events").select("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"), (F.col("event_id") % 12).alias("arrival"))
    _fed(events, root, lambda live: start_updates(live_counts(live, ["event_type"], lateness="3650 days"), f"{root}/out", f"{root}/checkpoint"))
    return latest(spark, f"{root}/out", ["event_type", "minute"])


@query(f"""WITH {_ARRIVALS} SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM kept GROUP BY 1""")
def stream_distinct(spark, sf_dir):
    """Messages that come late or twice count once; those older than the watermark are dropped."""
    root = scratch_folder(spark, "stream-distinct")
    batches, delay = _arrivals(spark, sf_dir)
    _fed(batches, root, lambda live: start_updates(once_each(live, ["event_id"], "ts", delay), f"{root}/out", f"{root}/checkpoint", "append"))
    return appended(spark, f"{root}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query(f"""WITH {_ARRIVALS},
t AS (SELECT *, coalesce(ts > lag(ts) OVER u + INTERVAL {GAP_HOURS} HOUR, true) AS opens FROM kept WINDOW u AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(opens::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM t)
SELECT min(ts) AS began, max(ts) + INTERVAL {GAP_HOURS} HOUR AS ended, user_id, count(*) AS n FROM g
GROUP BY user_id, session, watermark HAVING epoch_us(max(ts) + INTERVAL {GAP_HOURS} HOUR) <= watermark * 1000""")
def stream_sessions(spark, sf_dir):
    """Sessions of users that the watermark has closed, from messages that come late, twice, or too late."""
    root = scratch_folder(spark, "stream-sessions")
    batches, delay = _arrivals(spark, sf_dir)

    def start(live: DataFrame) -> StreamingQuery:
        found = live_sessions(once_each(live, ["event_id"], "ts", delay), ["user_id"], f"{GAP_HOURS} hours", lateness=None)
        return start_updates(found, f"{root}/out", f"{root}/checkpoint", "append")

    _fed(batches, root, start)
    return appended(spark, f"{root}/out")


# --- unreadable files ------------------------------------------------------------------------------


def _write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target)
    out.write(data)
    out.close()


@query("""SELECT 'rows' AS what, count(*) AS n FROM events
UNION ALL SELECT what, n FROM (VALUES ('empty', 1), ('too_short', 1), ('not_parquet', 2), ('cut', 1), ('bad_footer', 2), ('files that are neither read nor set aside', 0)) AS v(what, n)""")
def quarantine_files(spark, sf_dir):
    """A raw layer of the events with damaged files among its own: those are set aside by reason, the rest is read whole."""
    root = scratch_folder(spark, "quarantine")
    ingest_batch(fixtures.faker_env(fixtures.table(spark, sf_dir, "events")), f"{root}/raw")
    spark.range(1).coalesce(1).write.parquet(f"{root}/sample")
    sound = bytes(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{root}/sample").first()["content"])
    hour = f"{root}/raw/source=faker/year=2024/month=01/day=01/hr=00/batch=damaged"
    damaged = {
        "empty": b"", "short": b"PAR1PAR1", "text": b"these are words, and no columns", "json": b'{"source": "faker", "payload": {}}',
        "cut": sound[: len(sound) // 2], "footer": sound[:-8] + b"\xff\xff\xff\x7f" + sound[-4:], "garbled": sound[:4] + b"\xff" * (len(sound) - 12) + sound[-8:],
    }
    for name, data in damaged.items():
        _write_bytes(spark, f"{hour}/{name}.parquet", data)
    counts = quarantine.set_aside(spark, f"{root}/raw", f"{root}/aside")
    found = quarantine.aside_log(spark, f"{root}/aside").groupBy(F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    rows = scan_raw(spark, f"{root}/raw").agg(F.lit("rows").alias("what"), F.count(F.lit(1)).alias("n"))
    missing = counts["listed"] - counts["read"] - sum(n for k, n in counts.items() if k not in ("listed", "read"))
    told = spark.createDataFrame([("files that are neither read nor set aside", missing)], "what string, n bigint")
    return rows.unionByName(found).unionByName(told)


# --- windows over whole tables and hot keys --------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, row_number() OVER o AS row_number, ntile(100) OVER o AS ntile,
    CAST(sum(CAST(l_quantity AS DECIMAL(12, 2))) OVER (o ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS quantity_so_far
FROM lineitem WINDOW o AS (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber)""")
def window_numbers(spark, sf_dir):
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_quantity").cast("decimal(12,2)").alias("quantity"))
    made = with_row_numbers(lines, ["l_extendedprice DESC", "l_orderkey", "l_linenumber"], sums={"quantity_so_far": "quantity"}, ntile=100)
    return made.select("l_orderkey", "l_linenumber", "row_number", "ntile", F.col("quantity_so_far").cast("double").alias("quantity_so_far"))


@query("""SELECT l_orderkey, l_linenumber, rank() OVER o AS rank, dense_rank() OVER o AS dense_rank, percent_rank() OVER o AS percent_rank,
    cume_dist() OVER o AS cume_dist, CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2))) OVER o AS DOUBLE) AS price_so_far
FROM lineitem WINDOW o AS (ORDER BY l_quantity)""")
def window_ranks(spark, sf_dir):
    """Fifty values of the order share all rows."""
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    return with_ranks(lines, ["l_quantity"], sums={"price_so_far": "price"}).withColumn("price_so_far", F.col("price_so_far").cast("double")).drop("l_quantity", "price")


@query("""SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS row_number,
    ntile(10) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS ntile,
    rank() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) AS rank FROM events""")
def window_hot_keys(spark, sf_dir):
    """Five keys share all rows, one of them a third or more; each is ranked by many tasks."""
    events = fixtures.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.col("ts").cast("date").alias("day"))
    numbered = with_row_numbers(events, ["ts", "event_id"], ["event_type"], ntile=10)
    return with_ranks(numbered, ["day"], ["event_type"]).select("event_id", "event_type", "row_number", "ntile", "rank")


# --- NOT IN ----------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS key FROM customer),
o AS (SELECT CASE WHEN o_orderkey % 1000 <> 1 THEN o_custkey END AS key FROM orders WHERE o_totalprice > 100000)
SELECT 'values' AS side, c_custkey FROM c WHERE key NOT IN (SELECT key FROM o WHERE key IS NOT NULL)
UNION ALL SELECT 'with nulls', c_custkey FROM c WHERE key NOT IN (SELECT key FROM o)
UNION ALL SELECT 'nothing', c_custkey FROM c WHERE key NOT IN (SELECT key FROM o WHERE false)""")
def not_in_column(spark, sf_dir):
    """A side of values, one that holds a null (nothing stays), and one without rows (all stays, nulls too)."""
    customers = fixtures.table(spark, sf_dir, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS key"))
    orders = fixtures.table(spark, sf_dir, "orders").filter("o_totalprice > 100000").select(F.expr("CASE WHEN o_orderkey % 1000 <> 1 THEN o_custkey END AS key"))
    sides = {"values": orders.filter("key IS NOT NULL"), "with nulls": orders, "nothing": orders.filter("false")}
    made = [not_in(customers, side, ["key"]).select(F.lit(name).alias("side"), "c_custkey") for name, side in sides.items()]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 <> 0 THEN l_partkey END AS a, CASE WHEN l_linenumber <> 3 THEN l_suppkey END AS b FROM lineitem),
r AS (SELECT CASE WHEN l_orderkey % 4 <> 0 THEN l_partkey END AS c, CASE WHEN l_orderkey % 8 <> 1 THEN l_suppkey END AS d FROM lineitem WHERE l_quantity > 45 AND l_orderkey % 8 <> 0 AND l_suppkey % 3 = 0)
SELECT l_orderkey, l_linenumber FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE a = c AND b = d)
    AND NOT EXISTS (SELECT 1 FROM r WHERE a = c AND d IS NULL) AND NOT EXISTS (SELECT 1 FROM r WHERE c IS NULL AND b = d)
    AND NOT (a IS NULL AND EXISTS (SELECT 1 FROM r WHERE b = d)) AND NOT (b IS NULL AND EXISTS (SELECT 1 FROM r WHERE a = c))
    AND NOT (a IS NULL AND EXISTS (SELECT 1 FROM r WHERE d IS NULL)) AND NOT (b IS NULL AND EXISTS (SELECT 1 FROM r WHERE c IS NULL))
    AND NOT (a IS NULL AND b IS NULL AND EXISTS (SELECT 1 FROM r)) AND NOT EXISTS (SELECT 1 FROM r WHERE c IS NULL AND d IS NULL)""")
def not_in_columns(spark, sf_dir):
    """Two columns with nulls on both sides, in every combination."""
    lines = fixtures.table(spark, sf_dir, "lineitem")
    left = lines.selectExpr("l_orderkey", "l_linenumber", "CASE WHEN l_orderkey % 3 <> 0 THEN l_partkey END AS a", "CASE WHEN l_linenumber <> 3 THEN l_suppkey END AS b")
    right = lines.filter("l_quantity > 45 AND l_orderkey % 8 <> 0 AND l_suppkey % 3 = 0").selectExpr("CASE WHEN l_orderkey % 4 <> 0 THEN l_partkey END AS c", "CASE WHEN l_orderkey % 8 <> 1 THEN l_suppkey END AS d")
    return not_in(left, right, ["a", "b"], ["c", "d"]).select("l_orderkey", "l_linenumber")


# --- overlaps, quantiles, sketches and samples -----------------------------------------------------


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate AS began, l_shipdate + to_days(CAST(l_quantity AS INT)) AS ended FROM lineitem)
SELECT a.l_orderkey, a.l_linenumber, count(*) AS n FROM l a JOIN l b ON a.l_partkey = b.l_partkey AND a.began < b.ended AND b.began < a.ended GROUP BY 1, 2""")
def overlap_join_lines(spark, sf_dir):
    """Lines of the same part that are under way at the same time; how long depends on the quantity."""
    lines = fixtures.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate AS began", "timestampadd(DAY, CAST(l_quantity AS INT), CAST(l_shipdate AS TIMESTAMP_NTZ)) AS ended"
    )
    pairs = overlap_join(lines, lines, ("began", "ended"), ("began", "ended"), ["l_partkey"])
    return pairs.groupBy(F.col("left.l_orderkey").alias("l_orderkey"), F.col("left.l_linenumber").alias("l_linenumber")).agg(F.count(F.lit(1)).alias("n"))


_FRACTIONS = [0.01, 0.5, 0.9, 0.999]


@query(" UNION ALL ".join(f"SELECT l_returnflag, {f}::DOUBLE AS fraction, round(quantile_cont(l_extendedprice, {f}), 6) AS percentile FROM lineitem GROUP BY 1" for f in _FRACTIONS))
def exact_price_percentiles(spark, sf_dir):
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    found = exact_percentiles(lines, "l_extendedprice", _FRACTIONS, ["l_returnflag"])
    return found.select("l_returnflag", "fraction", F.round("percentile", 6).alias("percentile"))


@query("""SELECT l_returnflag, f.fraction AS fraction, true AS held FROM (SELECT DISTINCT l_returnflag FROM lineitem),
    (VALUES (0.01::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE), (0.99::DOUBLE)) AS f(fraction)""")
def sketched_price_percentiles(spark, sf_dir):
    """Sketches per flag and ship month merge to one per flag, and keep the rank error they state."""
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_returnflag", F.date_trunc("month", "l_shipdate").alias("month"), "l_extendedprice")
    stored = merged_sketches(quantile_sketches(lines, "l_extendedprice", ["l_returnflag", "month"]), ["l_returnflag"])
    errors = rank_errors(lines, estimated_percentiles(stored, [0.01, 0.5, 0.9, 0.99], ["l_returnflag"]), "l_extendedprice", ["l_returnflag"])
    return errors.select("l_returnflag", "fraction", (F.col("rank_error") <= RANK_ERROR).alias("held"))


@query("""SELECT event_type, date_trunc('week', ts)::TIMESTAMP AS week, count(DISTINCT user_id) AS users, true AS united, true AS only_here, true AS in_both
FROM events GROUP BY 1, 2""")
def distinct_sketch_weeks(spark, sf_dir):
    """Users of a week by kind of event, from the stored sketches of its days: estimates keep their bounds beside exact counts.

    Compared with all users of the week, whatever they did: those who did not do this, and those who did.
    """
    root = scratch_folder(spark, "sketches")
    events = fixtures.table(spark, sf_dir, "events").select("event_type", "user_id", "ts")
    daily_sketches(events, "user_id", "ts", ["event_type"]).write.partitionBy("day").parquet(root)
    days = spark.read.parquet(root).withColumn("week", F.date_trunc("week", F.col("day").cast("date")).cast("timestamp_ntz"))
    weeks, everyone = united(days, ["event_type", "week"]), united(days, ["week"]).withColumnRenamed("sketch", "whole")
    told = weeks.join(everyone, "week").select("event_type", "week", estimate("sketch").alias("e"), only_in("whole", "sketch").alias("o"), in_both("whole", "sketch").alias("b"))
    timed = events.withColumn("week", F.date_trunc("week", "ts").cast("timestamp_ntz"))
    exact = timed.groupBy("event_type", "week").agg(F.count_distinct("user_id").alias("users"))
    total = timed.groupBy("week").agg(F.count_distinct("user_id").alias("all_users"))
    near = lambda estimate, truth, of: F.abs(F.col(estimate) - truth) <= ERROR * F.col(of)
    return exact.join(total, "week").join(told, ["event_type", "week"]).select(
        "event_type", "week", "users", near("e", F.col("users"), "users").alias("united"), near("o", F.col("all_users") - F.col("users"), "all_users").alias("only_here"),
        near("b", F.col("users"), "all_users").alias("in_both"),
    )


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_returnflag, md5('7/=' || l_orderkey || '/=' || l_linenumber) AS place FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY place) AS n FROM p)
SELECT 'share' AS kind, l_orderkey, l_linenumber, l_returnflag FROM p WHERE ('0x' || left(place, 8))::BIGINT < 100 * 4294967296 // 1000
UNION ALL SELECT 'fixed', l_orderkey, l_linenumber, l_returnflag FROM r WHERE n <= 500""")
def stable_samples(spark, sf_dir):
    """A tenth of all lines, and 500 lines of each flag: the same rows however the table is split."""
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    key = ["l_orderkey", "l_linenumber"]
    some, fixed = share(lines, key, 100, seed=7), bottom_k(lines.repartition(7), ["l_returnflag"], key, 500, seed=7)
    return some.withColumn("kind", F.lit("share")).unionByName(fixed.withColumn("kind", F.lit("fixed"))).select("kind", *key, "l_returnflag")
