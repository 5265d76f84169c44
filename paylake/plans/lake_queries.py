"""Registered queries for the lake's own operators, each with its oracle where plain SQL can say it."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import fixtures
from paylake.functions.iso_time import day_parts, utc_clock, wall_clock
from paylake.functions.signing import hmac_sha256, signing_key
from paylake.operators import metrics
from paylake.operators.asof import asof_join
from paylake.operators.compact import plan_sizes
from paylake.operators.delivery import (
    check_stripe_events,
    signature_is_valid,
    with_message_key,
    wrap_events,
)
from paylake.operators.envelope import read_envelopes, rejected_rows, valid_rows
from paylake.operators.gate import register_alias, run_query
from paylake.operators.normalize import normalize, rejected_payloads, union_sources
from paylake.operators.ranges import range_join
from paylake.plans.lake import FIRST, LAST, SOURCES, lake_of
from paylake.plans.jobs import compact_days, ingest_batch, process_days
from paylake.plans.oracles import ENV, FK, RV, ST, money, parts, with_tables
from paylake.schemas import HOUR_PARTS
from paylake.session import configure, scratch_folder
from paylake.sources.layers import (
    Days,
    append_raw,
    days_between,
    in_previous_day,
    in_previous_hour,
    scan_analytics,
    scan_processed,
    scan_raw,
)
from paylake.sources.streams import table_rows
from paylake.streaming.ingest import drain_ingest
from paylake.streaming.rates import live_counts, live_rates
from paylake.streaming.updates import latest, store_updates

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        key = name or function.__name__
        QUERIES[key] = run
        if oracle:
            ORACLES[key] = oracle
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, name)


def _messages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "faker": fixtures.faker_env(_table(spark, sf_dir, "events")),
        "stripe": fixtures.stripe_env(_table(spark, sf_dir, "orders")),
        "revolut": fixtures.revolut_env(_table(spark, sf_dir, "lineitem")),
    }


def _normalized(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return normalize(valid_rows(read_envelopes(_messages(spark, sf_dir)[source])), source)


def _timed(envelopes: DataFrame) -> DataFrame:
    return envelopes.withColumn("ts", wall_clock(F.col("received_at")))


def _count() -> Column:
    return F.count(F.lit(1)).alias("n")


def _money() -> Column:
    return F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount")


# --- ingest ----------------------------------------------------------------------------------------


@query("""SELECT 'faker' AS source, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS received_at, 'tx-' || event_id AS id
FROM events""")
def ingest_envelope(spark, sf_dir):
    envelopes = read_envelopes(fixtures.faker_env(_table(spark, sf_dir, "events")))
    return envelopes.select("source", "received_at", F.get_json_object("payload", "$.transaction_id").alias("id"))


@query(f"""SELECT 'faker' AS source, {parts("ts", hour=True)},
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || CASE WHEN event_id % 50 = 6 THEN '+02:00' ELSE '' END AS received_at,
    CASE WHEN event_id % 50 <> 5 THEN 'tx-' || event_id END AS id
FROM events WHERE event_id % 50 NOT IN (0, 1, 2, 3, 4, 7, 8, 9)""")
def ingest_valid(spark, sf_dir):
    rows = valid_rows(read_envelopes(fixtures.bad_env(_table(spark, sf_dir, "events"))))
    return rows.select("source", *HOUR_PARTS, "received_at", F.get_json_object("payload", "$.transaction_id").alias("id"))


@query("""SELECT CASE WHEN event_id % 50 IN (3, 4, 9) THEN 'not_object' WHEN event_id % 50 IN (0, 1) THEN 'missing_key'
    ELSE 'bad_received_at' END AS reason, count(*) AS n
FROM events WHERE event_id % 50 IN (0, 1, 2, 3, 4, 7, 8, 9) GROUP BY 1""")
def ingest_rejects(spark, sf_dir):
    return metrics.counts_by(rejected_rows(read_envelopes(fixtures.bad_env(_table(spark, sf_dir, "events")))), "reason")


@query(with_tables("SELECT source, id, amount FROM env", ENV))
def ingest_payload(spark, sf_dir):
    paths = {
        "faker": ("$.transaction_id", "$.amount"),
        "stripe": ("$.data.object.id", "$.data.object.amount"),
        "revolut": ("$.data.id", "$.data.legs[1].amount"),
    }
    rows = [
        valid_rows(read_envelopes(messages)).select(
            "source",
            F.get_json_object("payload", paths[source][0]).alias("id"),
            F.get_json_object("payload", paths[source][1]).cast("double").alias("amount"),
        )
        for source, messages in _messages(spark, sf_dir).items()
    ]
    return union_sources(rows)


@query(with_tables(f"SELECT source, {parts('seen', hour=True)}, count(*) AS n FROM env GROUP BY ALL", ENV))
def ingest_partition_counts(spark, sf_dir):
    rows = valid_rows(read_envelopes(fixtures.all_env(spark, sf_dir)))
    return metrics.counts_by(rows, "source", *HOUR_PARTS)


_FOLDED_HOURS = with_tables(
    f"SELECT source, {parts('folded', hour=True)}, count(*) AS n, min(strftime(folded, '%Y-%m-%dT%H:%M:%S.%g')) "
    "AS first_at FROM env GROUP BY ALL", ENV)


def _hours_of(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source", *HOUR_PARTS).agg(_count(), F.min("received_at").alias("first_at"))


@query(_FOLDED_HOURS)
def ingest_roundtrip(spark, sf_dir):
    return _hours_of(scan_raw(spark, lake_of(spark, sf_dir).raw))


def _folded_stream(spark, sf_dir) -> DataFrame:
    def rows(name):
        return table_rows(spark, f"{sf_dir}/{name}.parquet")

    return reduce(DataFrame.unionByName, [
        fixtures.faker_env(rows("events"), folded=True),
        fixtures.stripe_env(rows("orders"), folded=True),
        fixtures.revolut_env(rows("lineitem"), folded=True),
    ])


@query(_FOLDED_HOURS)
def stream_ingest(spark, sf_dir):
    root = scratch_folder(spark, "stream-ingest")
    drain_ingest(_folded_stream(spark, sf_dir), f"{root}/raw", f"{root}/rejects", f"{root}/checkpoints")
    return _hours_of(scan_raw(spark, f"{root}/raw"))


@query("""SELECT CASE WHEN event_id % 50 IN (0, 1, 2, 3, 4, 7, 8, 9) THEN 'rejected' ELSE 'stored' END AS outcome,
    count(*) AS n FROM events GROUP BY 1""")
def stream_restart(spark, sf_dir):
    """Draining twice with one checkpoint stores and rejects every message once."""
    root = scratch_folder(spark, "stream-restart")
    for _ in range(2):
        messages = fixtures.bad_env(table_rows(spark, f"{sf_dir}/events.parquet"), folded=True)
        drain_ingest(messages, f"{root}/raw", f"{root}/rejects", f"{root}/checkpoints")
    stored = scan_raw(spark, f"{root}/raw").select(F.lit("stored").alias("outcome"))
    rejected = spark.read.parquet(f"{root}/rejects").select(F.lit("rejected").alias("outcome"))
    return metrics.counts_by(stored.unionByName(rejected), "outcome")


# --- deliveries and keys ---------------------------------------------------------------------------


@query("""SELECT key, count(*) AS n FROM (
    SELECT 'user_' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS key FROM events
    UNION ALL SELECT 'stripe_payment_intent_pi_' || o_orderkey FROM orders
    UNION ALL SELECT 'revolut_transaction_rv_' || l_orderkey || '_' || l_linenumber FROM lineitem) GROUP BY 1""")
def message_key(spark, sf_dir):
    return metrics.counts_by(with_message_key(fixtures.all_env(spark, sf_dir)), "key")


@query("""SELECT '{"source":"revolut","received_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '","payload":'
    || props || '}' AS value, NULL AS reason, NULL AS payload FROM events WHERE event_id % 5 <> 0
UNION ALL SELECT NULL, 'not_json', 'broken ' || props FROM events WHERE event_id % 5 = 0""")
def envelope_json(spark, sf_dir):
    """Every fifth body is not JSON; its text is kept with a reason."""
    body = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("broken "), "props")).otherwise(F.col("props"))
    return wrap_events(_table(spark, sf_dir, "events").select("ts", body.alias("body")), "revolut", "ts", "body")


@query("""SELECT o_orderkey, CASE o_orderkey % 10 WHEN 1 THEN 'not_object' WHEN 2 THEN 'id' WHEN 3 THEN 'type'
    WHEN 4 THEN 'data' WHEN 5 THEN 'created' WHEN 6 THEN 'livemode' END AS reason,
    CASE WHEN o_orderkey % 10 IN (0, 7, 8, 9) THEN '{"id":"evt_' || o_orderkey ||
    '","type":"payment_intent.created","data":{"object":{"id":"pi_' || o_orderkey || '"}},"api_version":' ||
    CASE o_orderkey % 10 WHEN 8 THEN 'null,"created":null,"livemode":null}'
    WHEN 9 THEN '"v1","created":17,"livemode":false}' ELSE '"v1","created":' || o_orderkey || ',"livemode":true}' END
    END AS payload FROM orders""")
def stripe_event_check(spark, sf_dir):
    head, kind = "\"id\":\"evt_', o_orderkey, '\"", "\"type\":\"payment_intent.created\""
    data, version = "\"data\":{\"object\":{\"id\":\"pi_', o_orderkey, '\"}}", "\"api_version\":\"v1\""
    times, live = "\"created\":', o_orderkey, '", "\"livemode\":true"

    def event(*fields):
        return "concat('{" + ",".join(fields) + "}')"

    body = f"""CASE o_orderkey % 10
        WHEN 1 THEN concat('[', o_orderkey, ']')
        WHEN 2 THEN {event(kind, data)}
        WHEN 3 THEN {event(head, '"type":5', data)}
        WHEN 4 THEN {event(head, kind, '"data":[1]')}
        WHEN 5 THEN {event(head, kind, data, '"created":1.5')}
        WHEN 6 THEN {event(head, kind, data, '"livemode":"perhaps"')}
        WHEN 7 THEN {event('"extra":{"a":1}', live, times, version, data, kind, head)}
        WHEN 8 THEN {event(head, kind, data)}
        WHEN 9 THEN {event(head, kind, data, version, '"created":"17"', '"livemode":"No"')}
        ELSE {event(head, kind, data, version, times, live)} END"""
    bodies = _table(spark, sf_dir, "orders").select("o_orderkey", F.expr(body).alias("body"))
    return check_stripe_events(bodies).select("o_orderkey", "reason", "payload")


def _hex_pad(pad: int) -> str:
    return bytes(b ^ pad for b in fixtures.SIGNING_SECRET.encode().ljust(64, b"\0")).hex()


@query(f"""WITH signed AS (SELECT event_id, sha256(unhex('{_hex_pad(0x5C)}') || unhex(sha256(unhex('{_hex_pad(0x36)}')
    || CAST('v1.' || epoch_us(ts) // 1000 || '.' || props AS BLOB)))) AS digest FROM events)
SELECT event_id, digest, event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 AS valid FROM signed""")
def webhook_signature(spark, sf_dir):
    deliveries = fixtures.webhook_deliveries(_table(spark, sf_dir, "events"))
    stamp = F.unix_millis(F.col("at").cast("timestamp")).cast("string")
    key = signing_key(spark, fixtures.SIGNING_SECRET)
    digest = hmac_sha256(key, F.concat(F.lit("v1."), stamp, F.lit("."), F.col("body")))
    valid = signature_is_valid(key, F.col("body"), F.col("ts"), F.col("signature"))
    return deliveries.select("event_id", digest.alias("digest"), valid.alias("valid"))


# --- normalisers -----------------------------------------------------------------------------------

_TRANSFER = "source, received_at, transaction_id, user_id, amount, currency, transaction_type"
_INTENT = "source, received_at, payment_intent_id, customer_id, amount, currency, payment_method"


@query(with_tables(f"SELECT {_TRANSFER} FROM fk", FK))
def normalize_faker(spark, sf_dir):
    return _normalized(spark, sf_dir, "faker")


@query(with_tables(f"SELECT {_INTENT} FROM st", ST))
def normalize_stripe(spark, sf_dir):
    return _normalized(spark, sf_dir, "stripe")


@query(with_tables(f"SELECT {_TRANSFER} FROM rv", RV))
def normalize_revolut(spark, sf_dir):
    return _normalized(spark, sf_dir, "revolut")


@query(with_tables(f"""SELECT {_TRANSFER}, NULL AS payment_intent_id, NULL AS customer_id, NULL AS payment_method FROM fk
UNION ALL SELECT {_TRANSFER}, NULL, NULL, NULL FROM rv
UNION ALL SELECT source, received_at, NULL, NULL, amount, currency, NULL, payment_intent_id, customer_id, payment_method
FROM st""", FK, ST, RV))
def normalize_all(spark, sf_dir):
    tables = [_normalized(spark, sf_dir, source) for source in SOURCES]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


@query("""SELECT 'faker' AS source, CASE event_id % 10 WHEN 1 THEN 'bad_amount' WHEN 2 THEN 'not_object'
    WHEN 4 THEN 'not_text' ELSE 'missing_field' END AS reason, count(*) AS n FROM events
WHERE event_id % 10 < 5 GROUP BY ALL
UNION ALL SELECT 'stripe', CASE o_orderkey % 10 WHEN 2 THEN 'bad_amount' WHEN 3 THEN 'missing_field'
    ELSE 'not_json' END, count(*) FROM orders WHERE o_orderkey % 10 IN (2, 3, 4) GROUP BY ALL
UNION ALL SELECT 'revolut', 'missing_field', count(*) FROM lineitem WHERE l_orderkey % 10 IN (1, 3) GROUP BY ALL""")
def normalize_rejects(spark, sf_dir):
    raw = fixtures.bad_payloads(spark, sf_dir)
    return metrics.counts_by(union_sources([rejected_payloads(rows, name) for name, rows in raw.items()]), "source", "reason")


@query(with_tables("""SELECT source, received_at, amount, currency FROM fk
UNION ALL SELECT source, received_at, amount, currency FROM st
UNION ALL SELECT source, received_at, amount, currency FROM rv""", FK, ST, RV), name="union_sources")
def union_sources_shared(spark, sf_dir):
    shared = ["source", "received_at", "amount", "currency"]
    return union_sources([_normalized(spark, sf_dir, source).select(*shared) for source in SOURCES])


@query("""WITH t AS (SELECT event_id, ts, date_trunc('milliseconds', ts) AS ms, event_id % 12 AS k FROM events)
SELECT event_id,
    CASE k WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('hour', ts) WHEN 4 THEN date_trunc('minute', ts)
        WHEN 10 THEN date_trunc('hour', ts) WHEN 8 THEN NULL WHEN 9 THEN NULL WHEN 11 THEN NULL ELSE ms END AS wall,
    CASE k WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('hour', ts) WHEN 4 THEN date_trunc('minute', ts)
        WHEN 5 THEN ms - INTERVAL 2 HOUR WHEN 6 THEN ms + INTERVAL 330 MINUTE
        WHEN 10 THEN date_trunc('hour', ts) + INTERVAL 1 HOUR
        WHEN 8 THEN NULL WHEN 9 THEN NULL WHEN 11 THEN NULL ELSE ms END AS utc
FROM t""")
def received_at_parse(spark, sf_dir):
    """Twelve spellings of the event time: which are accepted, what they say, which instant they mean."""
    spelling = """CASE event_id % 12
        WHEN 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")
        WHEN 1 THEN date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        WHEN 2 THEN date_format(ts, "yyyy-MM-dd")
        WHEN 3 THEN date_format(ts, "yyyy-MM-dd'T'HH")
        WHEN 4 THEN date_format(ts, "yyyy-MM-dd'_'HH:mm")
        WHEN 5 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'")
        WHEN 6 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-05:30'")
        WHEN 7 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        WHEN 8 THEN date_format(ts, "yyyy-M-d'T'HH:mm:ss")
        WHEN 9 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.S")
        WHEN 10 THEN date_format(ts, "yyyy-MM-dd'T'HH'-01:00'")
        ELSE date_format(ts, "yyyyMMdd'T'HHmmss") END"""
    rows = _table(spark, sf_dir, "events").select("event_id", F.expr(spelling).alias("text"))
    return rows.select("event_id", wall_clock(F.col("text")).alias("wall"), utc_clock(F.col("text")).alias("utc"))


# --- layers ----------------------------------------------------------------------------------------


@query(with_tables("SELECT source, count(*) AS n, count(DISTINCT id) AS ids FROM env GROUP BY 1", ENV), name="scan_raw")
def scan_raw_layer(spark, sf_dir):
    rows = _identified(scan_raw(spark, lake_of(spark, sf_dir).raw))
    return rows.groupBy("source").agg(_count(), F.count_distinct("id").alias("ids"))


def _identified(raw: DataFrame) -> DataFrame:
    # A parse costs far more than a search; a key that is not spelled in the text, or with escapes, is not there.
    spelled = F.contains("payload", F.lit("transaction_id")) | F.contains("payload", F.lit("\\"))
    ident = F.coalesce(
        F.when(spelled, F.get_json_object("payload", "$.transaction_id")),
        F.get_json_object("payload", "$.data.id"),
        F.get_json_object("payload", "$.data.object.id"),
    )
    return raw.select("source", "received_at", ident.alias("id"))


_FOLDED_ROWS = "SELECT source, strftime(folded, '%Y-%m-%dT%H:%M:%S.%g') AS received_at, id FROM env WHERE "


@query(with_tables(_FOLDED_ROWS + "source = 'stripe' AND folded >= TIMESTAMP '2024-01-02' AND hour(folded) = 5", ENV))
def scan_pruned(spark, sf_dir):
    window = Days.on("2024-01-02", hour=5)
    return _identified(scan_raw(spark, lake_of(spark, sf_dir).raw, window, ["stripe"]))


@query(with_tables(_FOLDED_ROWS + "folded >= TIMESTAMP '2024-01-01 23:00:00' AND folded < TIMESTAMP '2024-01-02'", ENV))
def scan_prev_hour(spark, sf_dir):
    """Shortly after midnight the previous hour is the last one of the day before."""
    return _identified(scan_raw(spark, lake_of(spark, sf_dir).raw, in_previous_hour(datetime(2024, 1, 2, 0, 10))))


@query(with_tables(
    f"SELECT source, {parts('folded')}, count(*) AS n, {money('amount')} AS amount FROM ("
    "SELECT source, folded, amount FROM fk UNION ALL SELECT source, folded, amount FROM st UNION ALL "
    "SELECT source, folded, amount FROM rv) WHERE folded < TIMESTAMP '2024-01-02' GROUP BY ALL", FK, ST, RV))
def scan_prev_day(spark, sf_dir):
    window = in_previous_day(datetime(2024, 1, 2, 1, 45))
    root = lake_of(spark, sf_dir).processed
    days = [
        scan_processed(spark, root, source, window).select("source", "year", "month", "day", "amount")
        for source in SOURCES
    ]
    return union_sources(days).groupBy("source", "year", "month", "day").agg(_count(), _money())


@query(with_tables("SELECT source, count(*) AS n FROM env WHERE source IN ('faker', 'revolut') GROUP BY 1", ENV))
def scan_sources(spark, sf_dir):
    raw = scan_raw(spark, lake_of(spark, sf_dir).raw, Days(FIRST, LAST), ["faker", "revolut"])
    return metrics.counts_by(raw, "source")


@query("""SELECT strftime(d.day, '%Y') AS year, strftime(d.day, '%m') AS month,
    strftime(d.day, '%d') AS day, count(o_orderkey) AS orders
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-12-30', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day) d
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d.day GROUP BY d.day""")
def date_range_days(spark, sf_dir):
    """Orders on every day of a window, days without orders included."""
    window = Days.through("1994-12-30", "2001-12-31")
    days = days_between(spark, window.first, window.last)
    orders = _table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(_count())
    return days.join(orders, "date", "left").select(
        "year", "month", "day", F.coalesce("n", F.lit(0)).alias("orders")
    )


_FOLDED_DAYS = with_tables(
    f"SELECT source, {parts('folded')}, count(*) AS n, {money('amount')} AS amount FROM ("
    "SELECT source, folded, amount FROM fk UNION ALL SELECT source, folded, amount FROM st UNION ALL "
    "SELECT source, folded, amount FROM rv) GROUP BY ALL", FK, ST, RV)


def _days_of(tables: list[DataFrame]) -> DataFrame:
    shared = [table.select("source", "year", "month", "day", "amount") for table in tables]
    return union_sources(shared).groupBy("source", "year", "month", "day").agg(_count(), _money())


@query(_FOLDED_DAYS)
def processed_roundtrip(spark, sf_dir):
    root = lake_of(spark, sf_dir).processed
    return _days_of([scan_processed(spark, root, source) for source in SOURCES])


# --- compaction ------------------------------------------------------------------------------------


@query("""WITH t AS (SELECT lang, count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY 1),
p AS (SELECT *, greatest(1, CAST(floor(100000 / (bytes / rows)) AS BIGINT)) AS rows_per_file FROM t)
SELECT lang, rows, bytes, rows_per_file, CAST(ceil(rows / rows_per_file) AS BIGINT) AS files FROM p""")
def compact_plan(spark, sf_dir):
    totals = _table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("bytes")
    )
    return plan_sizes(totals, 100_000)


@query(_FOLDED_DAYS)
def compact_rows(spark, sf_dir):
    root = lake_of(spark, sf_dir).analytics
    return _days_of([scan_analytics(spark, root, source) for source in SOURCES])


_ALL_FOLDED = f"""SELECT {_TRANSFER}, NULL AS payment_intent_id, NULL AS customer_id, NULL AS payment_method FROM fk
UNION ALL SELECT {_TRANSFER}, NULL, NULL, NULL FROM rv
UNION ALL SELECT source, received_at, NULL, NULL, amount, currency, NULL, payment_intent_id, customer_id, payment_method FROM st"""


@query(with_tables(_ALL_FOLDED.replace("received_at", "folded AS received_at"), FK, ST, RV))
def compact_roundtrip(spark, sf_dir):
    root = lake_of(spark, sf_dir).analytics
    tables = [scan_analytics(spark, root, source).drop("year", "month", "day") for source in SOURCES]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


@query(with_tables(f"""SELECT 'processed' AS layer, source, {parts('folded', hour=True)}, count(*) AS n FROM fk
WHERE folded >= TIMESTAMP '2024-01-02' AND hour(folded) < 12 GROUP BY ALL
UNION ALL SELECT 'analytics', source, {parts('folded')}, NULL, count(*) FROM fk
WHERE folded >= TIMESTAMP '2024-01-02' AND hour(folded) < 12 GROUP BY ALL""", FK))
def rebuilt_window(spark, sf_dir):
    """A window rebuilt from a raw layer that has fewer hours, and one day less, holds those only."""
    root = scratch_folder(spark, "rebuilt")
    messages = fixtures.faker_env(_table(spark, sf_dir, "events"), folded=True)
    fewer = valid_rows(read_envelopes(messages)).filter("day = '02' AND hr < '12'")
    ingest_batch(messages, f"{root}/raw")
    append_raw(fewer, f"{root}/less")
    for raw in ("raw", "less"):
        process_days(spark, f"{root}/{raw}", f"{root}/processed", FIRST, LAST, ["faker"])
        compact_days(spark, f"{root}/processed", f"{root}/analytics", FIRST, LAST, ["faker"])
    hours = scan_processed(spark, f"{root}/processed", "faker").groupBy("source", *HOUR_PARTS).agg(_count())
    days = scan_analytics(spark, f"{root}/analytics", "faker").groupBy("source", "year", "month", "day").agg(_count())
    return hours.withColumn("layer", F.lit("processed")).unionByName(
        days.withColumn("layer", F.lit("analytics")), allowMissingColumns=True
    )


@query("""WITH f AS (SELECT event_id % 10 AS k, CASE event_id % 10 WHEN 1 THEN 'bad_amount' WHEN 2 THEN 'not_object'
    WHEN 4 THEN 'not_text' ELSE 'missing_field' END AS reason, event_id // 3 % 3 = 1 AS done FROM events)
SELECT 'read' AS outcome, NULL AS reason, count(*) AS n FROM f
UNION ALL SELECT 'rejected', reason, count(*) FROM f WHERE k < 5 GROUP BY reason
UNION ALL SELECT 'kept', NULL, count(*) FROM f WHERE k >= 5 AND done
UNION ALL SELECT 'dropped', NULL, count(*) FROM f WHERE k >= 5 AND NOT done""")
def process_rejects(spark, sf_dir):
    """What the process job read is kept, rejected with a reason, or dropped as not wanted; counted and stored."""
    root = scratch_folder(spark, "process-rejects")
    raw = fixtures.bad_payloads(spark, sf_dir)["faker"]
    at = F.concat(F.lit("2024-01-01T"), F.substring("received_at", 12, 12))
    append_raw(raw.withColumn("received_at", at).select("*", *[day_parts(F.col("received_at"))[p].alias(p) for p in HOUR_PARTS]), f"{root}/raw")
    counts = process_days(spark, f"{root}/raw", f"{root}/processed", FIRST, FIRST, ["faker"], rejects_root=f"{root}/rejects")["faker"]
    stored = spark.read.parquet(f"{root}/rejects").groupBy("reason").agg(_count()).withColumn("outcome", F.lit("rejected"))
    kept = scan_processed(spark, f"{root}/processed", "faker").agg(_count()).withColumn("outcome", F.lit("kept"))
    told = spark.createDataFrame([(k, counts[k]) for k in ("read", "dropped")], "outcome string, n bigint")
    return stored.unionByName(kept.unionByName(told), allowMissingColumns=True)


# --- metrics ---------------------------------------------------------------------------------------


@query(with_tables("SELECT source, count(*) AS n FROM env GROUP BY 1", ENV))
def metric_consumed(spark, sf_dir):
    return metrics.counts_by(valid_rows(read_envelopes(fixtures.all_env(spark, sf_dir))), "source")


@query("""SELECT count(*) FILTER (event_id % 50 NOT IN (0, 1, 2, 3, 4, 7, 8, 9)) AS accepted,
    count(*) FILTER (event_id % 50 IN (0, 1, 2, 3, 4, 7, 8, 9)) AS refused FROM events""")
def metric_errors(spark, sf_dir):
    envelopes = read_envelopes(fixtures.bad_env(_table(spark, sf_dir, "events")))
    return envelopes.agg(
        F.count_if(F.col("reason").isNull()).alias("accepted"), F.count_if(F.col("reason").isNotNull()).alias("refused")
    )


@query("""SELECT 'user_' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS producer, count(*) AS n FROM events GROUP BY 1""")
def metric_sent(spark, sf_dir):
    keyed = with_message_key(fixtures.faker_env(_table(spark, sf_dir, "events")))
    return metrics.counts_by(keyed.withColumnRenamed("key", "producer"), "producer")


def _rate_oracle(label: str) -> str:
    return with_tables(f"""SELECT time_bucket(INTERVAL 30 SECOND, seen, TIMESTAMP '1970-01-01') + to_seconds(30 * i) AS window_end,
    {label}count(*) / 60.0 AS rate FROM env, (VALUES (1), (2)) AS s(i) GROUP BY ALL""", ENV)


def _message_times(spark, sf_dir) -> DataFrame:
    return _timed(valid_rows(read_envelopes(fixtures.all_env(spark, sf_dir)))).select("ts", "source")


@query(_rate_oracle(""))
def rate_overall(spark, sf_dir):
    return metrics.trailing_rate(_message_times(spark, sf_dir))


@query(_rate_oracle("source, "))
def rate_by_source(spark, sf_dir):
    return metrics.trailing_rate(_message_times(spark, sf_dir), ["source"])


@query(with_tables("SELECT date_trunc('minute', seen) AS minute, count(*) AS n FROM env GROUP BY 1", ENV))
def increase_1m(spark, sf_dir):
    return metrics.per_minute(_message_times(spark, sf_dir))


@query("""WITH e AS (
    SELECT 'producer' AS side, date_trunc('minute', ts) AS minute FROM events
    WHERE event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0
    UNION ALL
    SELECT 'consumer', date_trunc('minute', ts) FROM events WHERE event_id % 50 IN (0, 1, 2, 3, 4, 7, 8, 9)),
m AS (SELECT side, minute, count(*) AS n FROM e GROUP BY ALL)
SELECT side, minute, CAST(sum(n) OVER (PARTITION BY side ORDER BY minute) AS BIGINT) AS total FROM m""")
def errors_cumulative(spark, sf_dir):
    """Error totals over time: refused deliveries on the producer side, refused messages on the consumer side."""
    events = _table(spark, sf_dir, "events")
    valid = signature_is_valid(signing_key(spark, fixtures.SIGNING_SECRET), F.col("body"), F.col("ts"), F.col("signature"))
    unsigned = fixtures.webhook_deliveries(events).filter(~valid)
    producer = unsigned.select(F.lit("producer").alias("side"), F.col("at").alias("ts"))
    messages = fixtures.bad_env(events, keep=("ts",))
    refused = read_envelopes(messages, keep=("ts",)).filter(F.col("reason").isNotNull())
    consumer = refused.select(F.lit("consumer").alias("side"), "ts")
    return metrics.cumulative(producer.unionByName(consumer), ["side"])


@query("SELECT 'faker' AS source, date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY ALL")
def stream_rate(spark, sf_dir):
    root = scratch_folder(spark, "stream-rate")
    messages = fixtures.faker_env(table_rows(spark, f"{sf_dir}/events.parquet"))
    events = _timed(valid_rows(read_envelopes(messages))).select("ts", "source")
    store_updates(live_counts(events, ["source"]), f"{root}/counts", f"{root}/checkpoint")
    return latest(spark, f"{root}/counts", ["source", "minute"])


@query("""SELECT 'faker' AS source, time_bucket(INTERVAL 30 SECOND, ts, TIMESTAMP '1970-01-01') + to_seconds(30 * i) AS window_end,
    count(*) / 60.0 AS rate FROM events, (VALUES (1), (2)) AS s(i) GROUP BY ALL""")
def stream_rate_sliding(spark, sf_dir):
    root = scratch_folder(spark, "stream-rate-sliding")
    messages = fixtures.faker_env(table_rows(spark, f"{sf_dir}/events.parquet"))
    events = _timed(valid_rows(read_envelopes(messages))).select("ts", "source")
    store_updates(live_rates(events, ["source"]), f"{root}/rates", f"{root}/checkpoint")
    return latest(spark, f"{root}/rates", ["source", "window_end"])


# --- the SQL gate, the as-of join and the interval join --------------------------------------------


@query(with_tables(f"""SELECT source, count(*) AS n, {money('amount')} AS amount FROM (SELECT source, amount FROM fk
UNION ALL SELECT source, amount FROM st UNION ALL SELECT source, amount FROM rv) GROUP BY 1""", FK, ST, RV))
def sql_alias_sources(spark, sf_dir):
    register_alias(spark, "payments", f"{lake_of(spark, sf_dir).analytics}/tb-*/**/*.parquet")
    return run_query(spark, f"SELECT source, count(*) AS n, {money('amount')} AS amount FROM payments() GROUP BY source")


@query("""WITH i AS (SELECT event_id AS error_id, ts AS began, ts + INTERVAL 10 MINUTE AS ended FROM events WHERE event_type = 'error'),
p AS (SELECT event_id AS purchase_id, ts AS bought FROM events WHERE event_type = 'purchase')
SELECT error_id, purchase_id FROM i JOIN p ON began <= bought AND bought < ended""", name="range_join")
def range_join_events(spark, sf_dir):
    """Purchases of anyone in the ten minutes after an error."""
    events = _table(spark, sf_dir, "events")
    errors = events.filter("event_type = 'error'").selectExpr("event_id AS error_id", "ts AS began", "ts + INTERVAL '10' MINUTE AS ended")
    bought = events.filter("event_type = 'purchase'").selectExpr("event_id AS purchase_id", "ts AS bought")
    return range_join(errors, bought, "began", "ended", "bought").select("error_id", "purchase_id")


@query(with_tables(f"SELECT payment_method, count(*) AS n, {money('amount')} AS amount FROM st GROUP BY 1", ST))
def sql_alias(spark, sf_dir):
    register_alias(spark, "intents", f"{lake_of(spark, sf_dir).processed}/source=stripe/**/*.parquet")
    return run_query(spark, f"SELECT payment_method, count(*) AS n, {money('amount')} AS amount FROM intents() GROUP BY 1")


@query(with_tables(f"SELECT transaction_type, count(*) AS n, {money('amount')} AS amount FROM fk GROUP BY 1", FK))
def sql_path_scan(spark, sf_dir):
    path = f"{lake_of(spark, sf_dir).processed}/source=faker/**/*.parquet"
    return run_query(
        spark, f"SELECT transaction_type, count(*) AS n, {money('amount')} AS amount FROM read_parquet('{path}') GROUP BY 1"
    )


@query("""WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, ts, 'click-' || event_id AS click_id, value AS click_value FROM events WHERE event_type = 'click')
SELECT l.event_id, l.user_id, l.ts, r.click_id, r.click_value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""", name="asof_join")
def asof_join_events(spark, sf_dir):
    """The last click of the user before each purchase."""
    events = _table(spark, sf_dir, "events")
    left = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = events.filter("event_type = 'click'").select(
        "user_id", "ts", F.concat(F.lit("click-"), "event_id").alias("click_id"), F.col("value").alias("click_value")
    )
    return asof_join(left, right, ["user_id"], "ts")
