"""Registered SQL queries: one or more per family of SQL a user of the gate can write.

Each entry has the tables it reads, the text for the gate, and the oracle's text where the dialects differ.
`fk`, `st` and `rv` are the normalised tables. Windows and ordered lists run over partial results that the
calendar or a set of labels bounds, so one busy key does not end up in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from paylake import fixtures
from paylake.operators.envelope import read_envelopes, valid_rows
from paylake.operators.gate import run_query
from paylake.operators.normalize import normalize
from paylake.plans.oracles import FK, RV, ST, money, with_tables
from paylake.session import configure

_NORMALIZED = {
    "fk": ("faker", "events", fixtures.faker_env, FK),
    "st": ("stripe", "orders", fixtures.stripe_env, ST),
    "rv": ("revolut", "lineitem", fixtures.revolut_env, RV),
}


@dataclass(frozen=True)
class SqlQuery:
    tables: tuple[str, ...]
    text: str
    oracle: str | None = None
    #: Estimates and samples are an engine's own; their tests check bounds instead.
    exact: bool = True

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        for name in self.tables:
            _view(spark, sf_dir, name)
        return run_query(spark, self.text)

    def oracle_text(self) -> str:
        body = self.oracle or self.text
        ctes = [_NORMALIZED[name][3] for name in self.tables if name in _NORMALIZED]
        if not ctes:
            return body
        return with_tables(body, *ctes)


def _view(spark: SparkSession, sf_dir: str, name: str) -> None:
    if name in _NORMALIZED:
        source, base, derive, _ = _NORMALIZED[name]
        messages = derive(fixtures.table(spark, sf_dir, base))
        normalize(valid_rows(read_envelopes(messages)), source).createOrReplaceTempView(name)
    else:
        fixtures.table(spark, sf_dir, name).createOrReplaceTempView(name)


_DAILY = f"""WITH daily AS (
    SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, {money('value')} AS total
    FROM events GROUP BY event_type, CAST(ts AS DATE))
"""

SQL: dict[str, SqlQuery] = {}


def _sql(name: str, tables: str, text: str, oracle: str | None = None, exact: bool = True) -> None:
    SQL[name] = SqlQuery(tuple(tables.split()), text, oracle, exact)


# S1 projection and filter
_sql("sql_filter_project", "fk", """
SELECT transaction_id, user_id, amount,
       CASE WHEN amount >= 100 THEN 'large' WHEN amount >= 20 THEN 'medium' ELSE 'small' END AS size
FROM fk
WHERE transaction_type IN ('debit', 'credit') AND amount BETWEEN 5 AND 400 AND user_id LIKE 'user_00000%'
  AND currency IS NOT NULL AND NOT (amount = 7)""")
_sql("sql_all_but", "st", "SELECT * EXCEPT (source, currency) FROM st",
     "SELECT received_at, payment_intent_id, customer_id, amount, payment_method FROM st")

# S2 equi joins
_sql("sql_join_inner", "orders customer nation", f"""
SELECT n_name, o_orderpriority, count(*) AS n, {money('o_totalprice')} AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderpriority""")
_sql("sql_join_left", "customer orders", f"""
SELECT c_mktsegment, count(*) AS n, count(o_orderkey) AS matched, {money('o_totalprice')} AS total
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
GROUP BY c_mktsegment""")
_sql("sql_join_right", "orders customer", """
SELECT c_custkey, count(o_orderkey) AS n
FROM orders RIGHT JOIN customer ON o_custkey = c_custkey
GROUP BY c_custkey""")
_sql("sql_join_full", "fk st", """
SELECT coalesce(f.day, s.day) AS day, f.n AS card_payments, s.n AS intents FROM
  (SELECT CAST(CAST(received_at AS DATE) AS STRING) AS day, CAST(count(*) AS DOUBLE) AS n FROM fk GROUP BY 1) f
FULL JOIN
  (SELECT CAST(CAST(received_at AS DATE) AS STRING) AS day, CAST(count(*) AS DOUBLE) AS n FROM st GROUP BY 1) s
ON f.day = s.day""")

# S3 semi and anti joins
_sql("sql_semi", "customer orders", """
SELECT c_custkey, c_name FROM customer LEFT SEMI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 450000""",
     """SELECT c_custkey, c_name FROM customer WHERE EXISTS
     (SELECT 1 FROM orders WHERE c_custkey = o_custkey AND o_totalprice > 450000)""")
_sql("sql_anti", "customer orders", """
SELECT c_custkey, c_name FROM customer LEFT ANTI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 450000""",
     """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
     (SELECT 1 FROM orders WHERE c_custkey = o_custkey AND o_totalprice > 450000)""")

# S4 range and theta joins: with an equality to join on, and against a fixed handful of bands
_sql("sql_range_join", "orders lineitem", f"""
SELECT o_orderpriority, count(*) AS n, {money('l_extendedprice')} AS total
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL '60' DAY
GROUP BY o_orderpriority""")
_sql("sql_theta_join", "fk", f"""
SELECT band, count(*) AS n, {money('amount')} AS total
FROM fk JOIN (VALUES ('small', NULL, 20), ('medium', 20, 100), ('large', 100, NULL)) AS bands(band, low, high)
  ON (low IS NULL OR amount >= low) AND (high IS NULL OR amount < high)
GROUP BY band""")

# S6 aggregates
_sql("sql_group_agg", "lineitem", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, {money('l_extendedprice')} AS total,
       min(l_quantity) AS least, max(l_quantity) AS most
FROM lineitem GROUP BY ALL HAVING count(*) > 10""")
_sql("sql_agg_filter", "events", f"""
SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors,
       coalesce({money("CASE WHEN event_type = 'purchase' THEN value END")}, 0) AS spent
FROM events GROUP BY user_id""")

# S7 distinct
_sql("sql_distinct", "lineitem", """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts
FROM lineitem GROUP BY l_returnflag""")
_sql("sql_select_distinct", "orders", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
_sql("sql_approx_distinct", "lineitem", """
SELECT l_returnflag, approx_count_distinct(l_partkey, 0.02) AS parts FROM lineitem GROUP BY l_returnflag""", exact=False)

# S8 grouping sets
# Every grouping is made from the finest one, so rows are not multiplied before they are combined.
_GROUPED = """
SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag) AS INT) AS no_flag,
       CAST(GROUPING(l_linestatus) AS INT) AS no_status, CAST(sum(c) AS BIGINT) AS n, CAST(sum(s) AS DOUBLE) AS total
FROM (SELECT l_returnflag, l_linestatus, count(*) AS c, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS s
      FROM lineitem GROUP BY l_returnflag, l_linestatus) AS finest
GROUP BY """
_sql("sql_grouping_sets", "lineitem", _GROUPED + "GROUPING SETS ((l_returnflag), (l_linestatus), ())")
_sql("sql_cube", "lineitem", _GROUPED + "CUBE (l_returnflag, l_linestatus)")
_sql("sql_rollup", "lineitem", _GROUPED + "ROLLUP (l_returnflag, l_linestatus)")

# S9, S10 windows over daily totals
_sql("sql_rank", "events", _DAILY + """
SELECT event_type, CAST(day AS STRING) AS day, total,
       CAST(row_number() OVER w AS BIGINT) AS position, CAST(rank() OVER (PARTITION BY event_type ORDER BY n) AS BIGINT) AS by_count,
       CAST(dense_rank() OVER (PARTITION BY event_type ORDER BY n) AS BIGINT) AS dense,
       CAST(ntile(4) OVER w AS BIGINT) AS quarter,
       percent_rank() OVER w AS share, cume_dist() OVER w AS covered
FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY total DESC, day)""")
_sql("sql_lag_lead", "events", _DAILY + """
SELECT event_type, CAST(day AS STRING) AS day, lag(total) OVER w AS before, lead(total, 2, -1.0) OVER w AS later,
       first_value(total) OVER w AS first_total, nth_value(total, 3) OVER w AS third,
       last_value(busy) IGNORE NULLS OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_busy
FROM (SELECT *, CASE WHEN n % 2 = 0 THEN total END AS busy FROM daily)
WINDOW w AS (PARTITION BY event_type ORDER BY day)""",
     _DAILY + """
SELECT event_type, CAST(day AS STRING) AS day, lag(total) OVER w AS before, lead(total, 2, -1.0) OVER w AS later,
       first_value(total) OVER w AS first_total, nth_value(total, 3) OVER w AS third,
       last_value(busy IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_busy
FROM (SELECT *, CASE WHEN n % 2 = 0 THEN total END AS busy FROM daily)
WINDOW w AS (PARTITION BY event_type ORDER BY day)""")
_sql("sql_running_sum", "events", _DAILY + """
SELECT event_type, CAST(day AS STRING) AS day,
       CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS so_far,
       CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS around
FROM daily""")
_sql("sql_range_frame", "events", _DAILY + """
SELECT event_type, CAST(day AS STRING) AS day,
       CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL '6' DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS week
FROM daily""")

# S11 sort, limit, top-k
_sql("sql_topk", "orders", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5""")
_sql("sql_topk_group", "orders", """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders)
WHERE position <= 3""")

# S12 set operations
_sql("sql_union", "customer supplier", """
SELECT c_nationkey AS nationkey, 'buys' AS role FROM customer UNION SELECT s_nationkey, 'sells' FROM supplier""")
_sql("sql_union_all", "fk st rv", """
SELECT source, count(*) AS n FROM (SELECT source FROM fk UNION ALL SELECT source FROM st UNION ALL SELECT source FROM rv)
GROUP BY source""")
_sql("sql_intersect", "orders", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000
INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 300000""")
_sql("sql_except", "customer orders", """
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000""")
_sql("sql_set_all", "orders", """
SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 250000
EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 400000""")
_sql("sql_intersect_all", "orders", """
SELECT o_custkey FROM orders WHERE o_totalprice > 250000
INTERSECT ALL SELECT o_custkey FROM orders WHERE o_totalprice < 300000""")

# S13 subqueries and common table expressions
_sql("sql_subquery", "orders", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT max(o_totalprice) * 0.9 FROM orders)
  AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
_sql("sql_exists", "customer orders", """
SELECT c_mktsegment, count(*) AS n FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > c_acctbal * 50)
GROUP BY c_mktsegment""")
_sql("sql_lateral", "customer orders", """
SELECT c_custkey, n, best FROM customer,
LATERAL (SELECT count(*) AS n, coalesce(max(o_totalprice), 0) AS best FROM orders WHERE o_custkey = c_custkey)""",
     """SELECT c_custkey, count(o_orderkey) AS n, coalesce(max(o_totalprice), 0) AS best
     FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
_sql("sql_recursive", "conversations", """
WITH RECURSIVE thread AS (
  SELECT conv_id, turn, role AS path FROM conversations WHERE turn = 0
  UNION ALL
  SELECT c.conv_id, c.turn, concat(path, '>', c.role) AS path
  FROM thread t JOIN conversations c ON c.conv_id = t.conv_id AND c.turn = t.turn + 1)
SELECT conv_id, turn, path FROM thread""")

# S14 strings
_STRINGS = """
SELECT p_partkey, upper(p_name) AS loud, substr(p_name, 2, 4) AS middle, concat(p_brand, '/', p_type) AS label,
       lpad(CAST(p_partkey AS STRING), 8, '0') AS padded, {split} AS first_word,
       regexp_extract(p_brand, '#([0-9]+)', 1) AS brand, regexp_replace(p_name, '[aeiou]+', '*'{all}) AS masked,
       CAST(levenshtein(p_name, lower(p_type)) AS BIGINT) AS distance, md5(p_name) AS digest,
       {sha} AS long_digest, CAST(length(trim(p_name)) AS BIGINT) AS letters, replace(p_type, 'E', 'e') AS swapped,
       CAST({position} AS BIGINT) AS blank
FROM part"""
_sql("sql_string", "part",
     _STRINGS.format(split="split(p_name, ' ')[0]", all="", sha="sha2(p_name, 256)", position="locate(' ', p_name)"),
     _STRINGS.format(split="split_part(p_name, ' ', 1)", all=", 'g'", sha="sha256(p_name)", position="instr(p_name, ' ')"))
_sql("sql_text_digest", "documents", """
SELECT doc_id, md5(text) AS digest, CAST(length(text) AS BIGINT) AS letters, lang FROM documents""")

# S15 dates
_sql("sql_date", "orders", """
SELECT o_orderkey, date_trunc('MONTH', CAST(o_orderdate AS TIMESTAMP_NTZ)) AS month, extract(YEAR FROM o_orderdate) AS year,
       quarter(o_orderdate) AS quarter, date_format(o_orderdate, 'yyyy/MM/dd') AS label,
       datediff(DATE'2002-01-01', CAST(o_orderdate AS DATE)) AS age,
       o_orderdate + INTERVAL '1' MONTH AS due, dayofyear(o_orderdate) AS day_of_year
FROM orders""", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, CAST(extract(YEAR FROM o_orderdate) AS INT) AS year,
       CAST(quarter(o_orderdate) AS INT) AS quarter, strftime(o_orderdate, '%Y/%m/%d') AS label,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INT) AS age,
       o_orderdate + INTERVAL 1 MONTH AS due, CAST(dayofyear(o_orderdate) AS INT) AS day_of_year
FROM orders""")
_sql("sql_series", "orders", """
WITH monthly AS (SELECT CAST(trunc(o_orderdate, 'MONTH') AS DATE) AS filled, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(month AS STRING) AS month, coalesce(n, 0) AS n
FROM (SELECT explode(sequence(first, last, INTERVAL '1' MONTH)) AS month FROM (
  SELECT min(filled) AS first, max(filled) AS last FROM monthly)) m
LEFT JOIN monthly ON filled = month""", """
SELECT CAST(CAST(month AS DATE) AS STRING) AS month, count(o_orderkey) AS n
FROM (SELECT unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS month FROM (
  SELECT date_trunc('month', min(o_orderdate)) AS first, max(o_orderdate) AS last FROM orders)) m
LEFT JOIN orders ON date_trunc('month', o_orderdate) = month
GROUP BY month""")

# S16 numbers and casts
_sql("sql_math", "lineitem", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, CAST(floor(l_extendedprice) AS BIGINT) AS low, CAST(ceil(l_extendedprice) AS BIGINT) AS high,
       abs(l_discount - 0.05) AS off, power(l_quantity, 2) AS squared, sqrt(l_quantity) AS root,
       CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(l_quantity AS DECIMAL(6, 0)) > 100000 AS large,
       try_cast(l_returnflag AS INT) IS NULL AS no_number, CAST(l_quantity AS BIGINT) % 7 AS rest, l_linenumber::STRING AS line
FROM lineitem""")

# S17 arrays, maps, structs
_sql("sql_array", "embeddings", """
SELECT vec_id, CAST(size(embedding) AS BIGINT) AS dims, CAST(size(filter(embedding, x -> x > 0)) AS BIGINT) AS positive,
       CAST(array_max(embedding) AS DOUBLE) AS peak, CAST(element_at(embedding, 1) AS DOUBLE) AS head,
       CAST(aggregate(transform(embedding, x -> IF(x > 0.1, 1, 0)), 0, (a, b) -> a + b) AS BIGINT) AS strong
FROM embeddings""", """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dims, CAST(len(list_filter(embedding, lambda x: x > 0)) AS BIGINT) AS positive,
       CAST(list_max(embedding) AS DOUBLE) AS peak, CAST(embedding[1] AS DOUBLE) AS head,
       CAST(len(list_filter(embedding, lambda x: CAST(x AS DOUBLE) > 0.1)) AS BIGINT) AS strong
FROM embeddings""")
_sql("sql_explode", "embeddings", """
SELECT label, count(*) AS n, count_if(x > 0) AS positive FROM embeddings LATERAL VIEW explode(embedding) AS x GROUP BY label""",
     """SELECT label, count(*) AS n, count(*) FILTER (x > 0) AS positive
     FROM (SELECT label, unnest(embedding) AS x FROM embeddings) GROUP BY label""")
_sql("sql_map", "events", """
SELECT event_id, m['type'] AS kind, CAST(cardinality(map_keys(m)) AS BIGINT) AS entries, pair.amount AS amount
FROM (SELECT event_id, map('type', event_type, 'props', props) AS m, named_struct('user', user_id, 'amount', value) AS pair
      FROM events)""",
     "SELECT event_id, event_type AS kind, CAST(2 AS BIGINT) AS entries, value AS amount FROM events")

# S18 JSON
_sql("sql_json", "events", """
SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k, from_json(props, 'k BIGINT').k AS k_typed,
       try_variant_get(parse_json(props), '$.k', 'bigint') AS k_variant, get_json_object(props, '$.none') IS NULL AS no_field
FROM events""", """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, CAST(props->>'$.k' AS BIGINT) AS k_typed,
       CAST(props->>'$.k' AS BIGINT) AS k_variant, (props->>'$.none') IS NULL AS no_field FROM events""")

# S19 statistics and ordered aggregates: over values of small domains
_sql("sql_stats", "lineitem", """
SELECT l_returnflag, median(l_quantity) AS middle, percentile_cont(0.9) WITHIN GROUP (ORDER BY l_quantity) AS high,
       mode(l_linenumber) AS usual, round(stddev(l_quantity), 6) AS spread,
       round(corr(l_quantity, l_linenumber), 6) AS relation
FROM lineitem GROUP BY l_returnflag""", """
SELECT l_returnflag, median(l_quantity) AS middle, quantile_cont(l_quantity, 0.9) AS high,
       mode(l_linenumber) AS usual, round(stddev(l_quantity), 6) AS spread,
       round(corr(l_quantity, l_linenumber), 6) AS relation
FROM lineitem GROUP BY l_returnflag""")
_sql("sql_max_by", "orders", """
SELECT o_orderpriority, max_by(o_custkey, o_orderkey) AS newest, min_by(o_custkey, o_orderkey) AS oldest
FROM orders GROUP BY o_orderpriority""")
_sql("sql_listagg", "events", """
SELECT user_id, listagg(event_type, ',') WITHIN GROUP (ORDER BY event_type) AS kinds
FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id""", """
SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS kinds
FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id""")

# S20 pivot
_sql("sql_pivot", "events", """
SELECT * FROM (SELECT user_id, event_type FROM events)
PIVOT (count(1) FOR event_type IN ('click' AS clicks, 'view' AS views, 'purchase' AS purchases, 'error' AS errors, 'signup' AS signups))""", """
SELECT user_id, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'view') AS views,
       count(*) FILTER (event_type = 'purchase') AS purchases, count(*) FILTER (event_type = 'error') AS errors,
       count(*) FILTER (event_type = 'signup') AS signups FROM events GROUP BY user_id""")
_sql("sql_unpivot", "part", """
SELECT * FROM (SELECT p_brand, min(p_size) AS smallest, max(p_size) AS largest FROM part GROUP BY p_brand)
UNPIVOT (size FOR measure IN (smallest, largest))""")

# S21 time buckets and sessions
_sql("sql_time_bucket", "events", """
SELECT window(ts, '15 minutes').start AS bucket, event_type, count(*) AS n FROM events GROUP BY ALL""",
     "SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, event_type, count(*) AS n FROM events GROUP BY ALL")
_sql("sql_session", "events", """
SELECT user_id, s.start AS started, s.end AS ended, n FROM (
  SELECT user_id, session_window(ts, '2 hours') AS s, count(*) AS n FROM events GROUP BY user_id, session_window(ts, '2 hours'))""",
     """WITH marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM marked)
SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 2 HOUR AS ended, count(*) AS n FROM numbered GROUP BY user_id, session""")

# S22 sampling
_sql("sql_sample", "lineitem", """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem TABLESAMPLE (10 PERCENT) REPEATABLE (42)""", exact=False)
