"""Envelopes derived from the given tables, every row of them, as messages with one column `value`.

The tables stand for a stream: events become card transactions, orders payment intents, line items account
transfers. `folded` variants move all rows onto two days, so that writing them makes few partition folders;
no row is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.functions.signing import hmac_sha256, signing_key

START = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
FOLD_MINUTES = 2 * 24 * 60
SIGNING_SECRET = "wsk_example"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(ts: str) -> str:
    return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")"


def _minutes_in(expr: str, span: int) -> str:
    return f"timestampadd(MINUTE, {expr} % {span}, {START})"


FAKER_PAYLOAD = """named_struct(
    'transaction_id', concat('tx-', event_id),
    'user_id', concat('user_', lpad(CAST(user_id AS STRING), 7, '0')),
    'card_number', lpad(CAST(event_id AS STRING), 16, '4'),
    'amount', value,
    'currency', 'EUR',
    'timestamp', received_at,
    'transaction_type', element_at(array('DEBIT', 'CREDIT', 'REFUND'), CAST(event_id % 3 AS INT) + 1),
    'status', element_at(array('PENDING', 'COMPLETED', 'FAILED'), CAST((event_id div 3) % 3 AS INT) + 1))"""

STRIPE_PAYLOAD = """named_struct(
    'id', concat('evt_', o_orderkey),
    'type', concat('payment_intent.', lower(o_orderstatus)),
    'data', named_struct('object', named_struct(
        'id', concat('pi_', o_orderkey),
        'object', IF(o_orderkey % 5 = 0, 'charge', 'payment_intent'),
        'status', CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'requires_action' ELSE 'processing' END,
        'amount', CAST(round(o_totalprice * 100) AS BIGINT),
        'currency', 'eur',
        'customer', concat('cus_', o_custkey),
        'payment_method', o_orderpriority,
        'payment_intent', IF(o_orderkey % 5 = 0, concat('pi_', o_orderkey), NULL))))"""

REVOLUT_PAYLOAD = """named_struct(
    'event', 'TransactionCreated',
    'timestamp', received_at,
    'data', named_struct(
        'id', concat('rv_', l_orderkey, '_', l_linenumber),
        'type', lower(l_returnflag),
        'state', IF(l_linestatus = 'F', 'completed', 'pending'),
        'legs', array(
            named_struct('account_id', concat('acc_', l_suppkey), 'amount', -l_extendedprice, 'currency', 'GBP'),
            named_struct('account_id', concat('acc_', l_partkey), 'amount', l_extendedprice, 'currency', 'EUR'))))"""


def _messages(rows: DataFrame, source: str, at: str, payload: str) -> DataFrame:
    timed = rows.withColumn("received_at", F.expr(_iso(at)))
    envelope = F.expr(f"to_json(named_struct('source', '{source}', 'received_at', received_at, 'payload', {payload}))")
    return timed.select(envelope.alias("value"))


def faker_env(events: DataFrame, folded: bool = False) -> DataFrame:
    at = _minutes_in("event_id", FOLD_MINUTES) if folded else "ts"
    return _messages(events, "faker", at, FAKER_PAYLOAD)


def stripe_env(orders: DataFrame, folded: bool = False) -> DataFrame:
    at = _minutes_in("o_orderkey", FOLD_MINUTES if folded else 43200)
    return _messages(orders, "stripe", at, STRIPE_PAYLOAD)


def revolut_env(lineitem: DataFrame, folded: bool = False) -> DataFrame:
    at = _minutes_in("(l_orderkey * 7 + l_linenumber)", FOLD_MINUTES if folded else 43200)
    return _messages(lineitem, "revolut", at, REVOLUT_PAYLOAD)


def all_env(spark: SparkSession, sf_dir: str, folded: bool = False) -> DataFrame:
    return (
        faker_env(table(spark, sf_dir, "events"), folded)
        .unionByName(stripe_env(table(spark, sf_dir, "orders"), folded))
        .unionByName(revolut_env(table(spark, sf_dir, "lineitem"), folded))
    )


def bad_env(events: DataFrame, folded: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Card transactions of which every 50 have ten that are damaged or unusual."""
    at = _minutes_in("event_id", FOLD_MINUTES) if folded else "ts"
    rows = events.withColumn("received_at", F.expr(_iso(at))).withColumn("kind", F.expr("event_id % 50"))
    payload = f"to_json({FAKER_PAYLOAD})"

    def message(received_at: str, payload_json: str = payload) -> str:
        return (
            f"concat('{{\"source\":\"faker\",\"received_at\":', {received_at}, "
            f"',\"payload\":', {payload_json}, '}}')"
        )

    quoted = "concat('\"', received_at, '\"')"
    value = f"""CASE kind
        WHEN 0 THEN concat('{{"received_at":', {quoted}, ',"payload":', {payload}, '}}')
        WHEN 1 THEN concat('{{"source":"faker","received_at":', {quoted}, '}}')
        WHEN 2 THEN {message("'\"bad\"'")}
        WHEN 3 THEN concat('not json ', event_id)
        WHEN 4 THEN concat('[', event_id, ',2]')
        WHEN 5 THEN {message(quoted, "'null'")}
        WHEN 6 THEN {message("concat('\"', received_at, '+02:00\"')")}
        WHEN 7 THEN {message("'null'")}
        WHEN 8 THEN {message("CAST(event_id AS STRING)")}
        WHEN 9 THEN CAST(event_id AS STRING)
        ELSE {message(quoted)} END"""
    return rows.select(F.expr(value).alias("value"), *keep)


def bad_payloads(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw rows per source with damaged payloads among good ones: `source, received_at, payload`."""
    faker = table(spark, sf_dir, "events").withColumn("received_at", F.expr(_iso("ts")))
    faker_json = f"""CASE event_id % 10
        WHEN 0 THEN to_json(named_struct('transaction_id', concat('tx-', event_id)))
        WHEN 1 THEN to_json(named_struct('status', 'completed', 'transaction_id', concat('tx-', event_id),
            'user_id', 'u', 'amount', CAST(value AS STRING), 'currency', 'EUR', 'transaction_type', 'DEBIT'))
        WHEN 2 THEN concat('[', event_id, ']')
        WHEN 3 THEN concat('{{"status":"completed","transaction_id":"tx-', event_id, '"}}')
        WHEN 4 THEN to_json(named_struct('status', 7))
        ELSE to_json({FAKER_PAYLOAD}) END"""

    at = _minutes_in("o_orderkey", 43200)
    stripe = table(spark, sf_dir, "orders").withColumn("received_at", F.expr(_iso(at)))

    def intent(amount: str) -> str:
        return f"""concat('{{"data":{{"object":{{"id":"pi_', o_orderkey, '","object":"payment_intent","status":"succeeded",',
            '"amount":', {amount}, ',"currency":"eur","customer":"c","payment_method":"card"}}}}}}')"""

    stripe_json = f"""CASE o_orderkey % 10
        WHEN 1 THEN {intent("concat('\"', CAST(round(o_totalprice * 100) AS BIGINT), '\"')")}
        WHEN 2 THEN {intent("'null'")}
        WHEN 3 THEN concat('{{"data":{{"object":{{"id":"pi_', o_orderkey, '"}}}}}}')
        WHEN 4 THEN concat('broken ', o_orderkey)
        ELSE to_json({STRIPE_PAYLOAD}) END"""

    at = _minutes_in("(l_orderkey * 7 + l_linenumber)", 43200)
    revolut = table(spark, sf_dir, "lineitem").withColumn("received_at", F.expr(_iso(at)))
    revolut_json = f"""CASE l_orderkey % 10
        WHEN 1 THEN concat('{{"data":{{"id":"rv_', l_orderkey, '","type":"x","state":"completed",',
            '"legs":[{{"account_id":"a","amount":1,"currency":"EUR"}}]}}}}')
        WHEN 2 THEN concat('{{"data":{{"id":"rv_', l_orderkey, '"}}}}')
        WHEN 3 THEN concat('{{"event":"x', l_orderkey, '"}}')
        ELSE to_json({REVOLUT_PAYLOAD}) END"""

    return {
        source: rows.select(F.lit(source).alias("source"), "received_at", F.expr(payload).alias("payload"))
        for source, rows, payload in (
            ("faker", faker, faker_json), ("stripe", stripe, stripe_json), ("revolut", revolut, revolut_json),
        )
    }


def webhook_deliveries(events: DataFrame) -> DataFrame:
    """Signed bodies: every 7th signature is altered, every 11th is missing, every 13th has no timestamp."""
    at = F.col("at").cast("timestamp")
    body = events.select("event_id", F.col("ts").alias("at"), F.col("props").alias("body"))
    stamp = F.unix_millis(at).cast("string")
    digest = hmac_sha256(signing_key(events.sparkSession, SIGNING_SECRET), F.concat(F.lit("v1."), stamp, F.lit("."), F.col("body")))
    signature: Column = (
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 7 == 0, F.concat(F.lit("v1="), F.translate(digest, "0123456789abcdef", "123456789abcdef0")))
        .otherwise(F.concat(F.lit("v1="), digest))
    )
    sent = F.when(F.col("event_id") % 13 != 0, stamp)
    return body.select("event_id", "at", "body", sent.alias("ts"), signature.alias("signature"))
