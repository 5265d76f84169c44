"""All registered queries and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake import fixtures
from paylake.operators.envelope import read_envelopes, valid_rows
from paylake.operators.gate import run_query
from paylake.operators.normalize import normalize
from paylake.plans import counter_queries, lake_queries, table_queries  # noqa: F401  (registers its queries)
from paylake.plans.oracles import money
from paylake.plans.sql_queries import SQL
from paylake.session import configure


def queries() -> dict:
    return lake_queries.QUERIES | {name: entry.run for name, entry in SQL.items()}


def oracles() -> dict[str, str]:
    return lake_queries.ORACLES | {name: entry.oracle_text() for name, entry in SQL.items() if entry.exact}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.faker_env(fixtures.table(configure(spark), sf_dir, "events"))
    normalize(valid_rows(read_envelopes(messages)), "faker").createOrReplaceTempView("transactions")
    return run_query(
        spark,
        f"""SELECT currency, transaction_type, count(*) AS n, {money('amount')} AS amount
        FROM transactions GROUP BY currency, transaction_type ORDER BY currency, transaction_type""",
    )
