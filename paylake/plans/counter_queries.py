"""Registered queries for counters that restart, and for the merge of a raw layer's small batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake import fixtures
from paylake.operators.counters import counter_totals, windowed_increase
from paylake.operators.merge_batches import clean_merged, merge_batches, stored_batches
from paylake.plans.jobs import ingest_batch
from paylake.plans.lake import FIRST, LAST
from paylake.plans.lake_queries import query
from paylake.schemas import HOUR_PARTS
from paylake.session import scratch_folder
from paylake.sources.layers import Days, scan_raw_batches
from paylake.sources.swaps import is_visible, read_swaps

# --- counters that restart -------------------------------------------------------------------------

STEP, WIDTH = 1800, 6 * 3600

# Producers count events by type and restart at five in the morning; each event is a sample of its producer.
_SAMPLES = """n AS (SELECT event_type AS producer, ts,
    row_number() OVER (PARTITION BY event_type, CAST(ts - INTERVAL 5 HOUR AS DATE) ORDER BY ts, event_id) AS value
    FROM events WHERE ts IS NOT NULL),
s AS (SELECT producer, ts, max(value) AS value FROM n GROUP BY ALL)"""

# Per window: last minus first, and at each restart inside it the value that was lost.
_INCREASES = f"""{_SAMPLES},
w AS (SELECT s.*, time_bucket(INTERVAL {STEP} SECOND, ts - INTERVAL 1 MICROSECOND, TIMESTAMP '1970-01-01') + to_seconds({STEP} * i) AS window_end
    FROM s, generate_series(1, {WIDTH // STEP}) AS g(i)),
v AS (SELECT *, lag(value) OVER (PARTITION BY producer, window_end ORDER BY ts) AS before FROM w),
r AS (SELECT window_end, producer, count(*) AS n, min(ts) AS f, max(ts) AS l, arg_min(value, ts) AS fv,
    CAST(arg_max(value, ts) - arg_min(value, ts) + coalesce(sum(before) FILTER (value < before), 0) AS BIGINT) AS increase
    FROM v GROUP BY ALL HAVING count(*) >= 2),
d AS (SELECT *, CAST(epoch_us(l) - epoch_us(f) AS DOUBLE) AS spread, CAST(epoch_us(f) - epoch_us(window_end) + {WIDTH * 1_000_000} AS DOUBLE) AS s0,
    CAST(epoch_us(window_end) - epoch_us(l) AS DOUBLE) AS e0, CAST(epoch_us(l) - epoch_us(f) AS DOUBLE) / (n - 1) AS mean FROM r),
x AS (SELECT *, CASE WHEN s0 >= mean * 1.1::DOUBLE THEN mean / 2 ELSE s0 END AS s1, CASE WHEN e0 >= mean * 1.1::DOUBLE THEN mean / 2 ELSE e0 END AS e1,
    CASE WHEN increase > 0 THEN spread * (CAST(fv AS DOUBLE) / CAST(increase AS DOUBLE)) END AS zero FROM d),
y AS (SELECT window_end, producer, n, increase,
    CAST(increase AS DOUBLE) * ((spread + CASE WHEN zero < s1 THEN zero ELSE s1 END + e1) / spread) AS extrapolated FROM x)"""


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.table(spark, sf_dir, "events").filter("ts IS NOT NULL")
    life = Window.partitionBy("event_type", F.to_date(F.expr("ts - INTERVAL '5' HOUR"))).orderBy("ts", "event_id")
    return events.select(F.col("event_type").alias("producer"), "ts", F.row_number().over(life).cast("bigint").alias("value"))


@query(f"WITH {_INCREASES} SELECT window_end, producer, n, increase, round(extrapolated, 6) AS extrapolated, round(extrapolated / {WIDTH}.0, 9) AS rate FROM y")
def counter_rates(spark, sf_dir):
    """Increase and rate of each producer's counter, through its restarts."""
    rates = windowed_increase(_samples(spark, sf_dir), ["producer"], STEP, WIDTH)
    return rates.withColumns({"extrapolated": F.round("extrapolated", 6), "rate": F.round("rate", 9)})


@query(f"""WITH {_INCREASES} SELECT window_end, CAST(round(sum(CAST(extrapolated AS DECIMAL(18, 6)))) AS BIGINT) AS messages,
    count(*) AS producers FROM y GROUP BY 1""")
def counter_increase_total(spark, sf_dir):
    """Messages of all producers in the trailing window, as whole numbers."""
    rates = windowed_increase(_samples(spark, sf_dir), ["producer"], STEP, WIDTH)
    total = F.round(F.sum(F.col("extrapolated").cast("decimal(18,6)"))).cast("bigint")
    return rates.groupBy("window_end").agg(total.alias("messages"), F.count(F.lit(1)).alias("producers"))


@query(f"""WITH {_SAMPLES}, b AS (SELECT *, lag(value) OVER (PARTITION BY producer ORDER BY ts) AS before FROM s)
SELECT producer, count(*) AS samples, count(*) FILTER (value < before) AS restarts,
    CAST(sum(CASE WHEN value >= before THEN value - before ELSE value END) AS BIGINT) AS total FROM b GROUP BY 1""")
def counter_restarts(spark, sf_dir):
    return counter_totals(_samples(spark, sf_dir), ["producer"])


# --- merged batches of the raw layer ---------------------------------------------------------------

BATCHES = 4

_HOUR = "year(folded)::VARCHAR AS year, strftime(folded, '%m') AS month, strftime(folded, '%d') AS day, strftime(folded, '%H') AS hr"


@query(f"""WITH e AS (SELECT event_id % {BATCHES + 1} AS batch, TIMESTAMP '2024-01-01' + to_minutes(event_id % 2880) AS folded FROM events),
h AS (SELECT {_HOUR}, count(*) AS every, count(*) FILTER (batch < {BATCHES}) AS early,
    count(DISTINCT batch) FILTER (batch < {BATCHES}) AS folders, count(*) FILTER (batch = {BATCHES}) AS late FROM e GROUP BY ALL)
SELECT '1 stored' AS state, year, month, day, hr, early AS n, folders FROM h WHERE early > 0
UNION ALL SELECT '2 merged', year, month, day, hr, early, 1 FROM h WHERE early > 0
UNION ALL SELECT '3 late', year, month, day, hr, every, CAST(early > 0 AS INT) + CAST(late > 0 AS INT) FROM h
UNION ALL SELECT '4 cleaned', year, month, day, hr, every, 1 FROM h""")
def raw_merge(spark, sf_dir):
    """Rows and folders per hour as readers see them: batches as stored, merged, with a late one, and merged again and cleaned.

    The whole table arrives in five batches. The last state counts the folders that are left, not only those seen.
    """
    root, later = scratch_folder(spark, "raw-merge"), datetime(2100, 1, 1)
    window = Days(FIRST, LAST)
    messages = fixtures.table(spark, sf_dir, "events").withColumn("batch", F.col("event_id") % (BATCHES + 1))

    def arrive(number: int) -> None:
        ingest_batch(fixtures.faker_env(messages.filter(F.col("batch") == number), folded=True), f"{root}/raw")

    def keep(state: str, rows: DataFrame) -> None:
        counts = rows.groupBy(*HOUR_PARTS).agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("folders"))
        counts.withColumn("state", F.lit(state)).write.mode("append").parquet(f"{root}/states")

    def seen() -> DataFrame:
        swaps = read_swaps(spark, f"{root}/raw", window.day_folders())
        return stored_batches(scan_raw_batches(spark, f"{root}/raw", window).filter(is_visible(swaps)))

    for number in range(BATCHES):
        arrive(number)
    keep("1 stored", seen())
    merge_batches(spark, f"{root}/raw", window, later)
    keep("2 merged", seen())
    arrive(BATCHES)
    keep("3 late", seen())
    merge_batches(spark, f"{root}/raw", window, later)
    clean_merged(spark, f"{root}/raw", window, later)
    keep("4 cleaned", stored_batches(scan_raw_batches(spark, f"{root}/raw", window)))
    return spark.read.parquet(f"{root}/states").select("state", *HOUR_PARTS, "n", "folders")
