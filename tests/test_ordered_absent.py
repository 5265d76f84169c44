import random
import re

import pandas as pd
import duckdb
import pytest

from paylake.operators.absent import not_in
from paylake.operators.ordered import with_ranks, with_row_numbers
from tests.conftest import plan_of

SCHEMA = "id bigint, k string, x int, v decimal(10,2), d double"


def table(spark, n=400, seed=1, hot=0.6):
    """Most rows share one key, and half of the order's values are one value; keys, values and the order have nulls."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rng.random() < hot else rng.choice(["a", "b", None])
        x = 5 if rng.random() < 0.5 else rng.choice([None, *range(12)])
        rows.append((i, k, x, rng.choice([None, round(rng.uniform(-9, 9), 2)]), float(rng.randint(0, 9))))
    from decimal import Decimal

    return spark.createDataFrame([(i, k, x, None if v is None else Decimal(str(v)), d) for i, k, x, v, d in rows], SCHEMA).repartition(5)


def same(df, sql):
    t = df[0].toPandas()  # noqa: F841  read by the oracle
    got, want = df[1].toPandas(), duckdb.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda f: sorted([tuple(None if pd.isna(v) else round(float(v), 9) if not isinstance(v, str) else v for v in r) for r in f[sorted(f.columns)].itertuples(index=False)], key=repr)
    assert rows(got) == rows(want)


def window(keys, order):
    return f"({'PARTITION BY ' + ', '.join(keys) if keys else ''} ORDER BY {order})"


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("order, text", [(["x", "id"], "x NULLS FIRST, id"), (["x DESC", "id"], "x DESC NULLS LAST, id")])
def test_row_numbers_equal_sql(spark, keys, order, text):
    df = table(spark)
    made = with_row_numbers(df, order, keys, {"total": "v", "doubles": "d"}, ntile=7, partitions=6)
    w = window(keys, text)
    rows = w[:-1] + " ROWS UNBOUNDED PRECEDING)"
    same((df, made), f"SELECT *, row_number() OVER {w} AS row_number, ntile(7) OVER {w} AS ntile, sum(v) OVER {rows} AS total, sum(d) OVER {rows} AS doubles FROM t")


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("order, text", [(["x"], "x NULLS FIRST"), (["x DESC", "d"], "x DESC NULLS LAST, d")])
def test_ranks_equal_sql(spark, keys, order, text):
    df = table(spark, seed=2)
    made = with_ranks(df, order, keys, {"total": "v"}, partitions=6)
    w = window(keys, text)
    same((df, made), f"""SELECT *, rank() OVER {w} AS rank, dense_rank() OVER {w} AS dense_rank, percent_rank() OVER {w} AS percent_rank,
        cume_dist() OVER {w} AS cume_dist, sum(v) OVER {w} AS total FROM t""")


def test_few_rows_and_none(spark):
    df = table(spark, 3)
    same((df, with_row_numbers(df, ["id"], ntile=10)), "SELECT *, row_number() OVER (ORDER BY id) AS row_number, ntile(10) OVER (ORDER BY id) AS ntile FROM t")
    assert with_row_numbers(df.limit(0), ["id"], ntile=2).count() == 0 and with_ranks(df.limit(0), ["id"], ["k"]).count() == 0
    with pytest.raises(ValueError, match="rank"):
        with_ranks(df.withColumnRenamed("d", "rank"), ["id"])


def test_no_task_gets_the_whole_table(spark):
    df = table(spark, 2000)
    for made in (with_row_numbers(df, ["x", "id"], partitions=6), with_ranks(df, ["x"], partitions=6), with_row_numbers(df, ["x", "id"], ["k"], partitions=6)):
        made.collect()
        assert "SinglePartition" not in plan_of(made)
    numbered = with_row_numbers(df, ["x", "id"], ["k"], partitions=6)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(numbered))
    assert any("_range" in columns for columns in dealt)


def _nulls(rng, n, m):
    return [tuple(rng.choice([None, 1, 2, 3]) for _ in range(m)) for _ in range(n)]


def _kept(left, right):
    differ = lambda a, b: any(x is not None and y is not None and x != y for x, y in zip(a, b, strict=True))
    return sorted([a for a in left if all(differ(a, b) for b in right)], key=repr)


@pytest.mark.parametrize("columns", [1, 2, 3])
def test_not_in_equals_its_definition(spark, columns):
    rng = random.Random(columns)
    names = [f"c{i}" for i in range(columns)]
    schema = ", ".join(f"{n} int" for n in names)
    for n_right in (0, 1, 2, 3, 5):
        for _ in range(3):
            left, right = _nulls(rng, 30, columns), _nulls(rng, n_right, columns)
            made = not_in(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), names)
            assert sorted([tuple(r) for r in made.collect()], key=repr) == _kept(left, right)


def test_one_column_agrees_with_the_engine(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "a int")
    for right in ([], [(2,)], [(2,), (None,)], [(None,)]):
        other = spark.createDataFrame(right, "b int")
        left.createOrReplaceTempView("l")
        other.createOrReplaceTempView("r")
        want = spark.sql("SELECT a FROM l WHERE a NOT IN (SELECT b FROM r)").collect()
        assert sorted(map(tuple, not_in(left, other, ["a"], ["b"]).collect()), key=repr) == sorted(map(tuple, want), key=repr)


def test_not_in_never_broadcasts(spark):
    left = spark.range(1000).selectExpr("IF(id % 3 = 0, NULL, id) AS a", "IF(id % 5 = 0, NULL, id) AS b")
    right = spark.range(0, 3000, 7).selectExpr("IF(id % 2 = 0, NULL, id) AS a", "IF(id % 2 = 1, NULL, id) AS b")
    made = not_in(left, right, ["a", "b"])
    made.collect()
    assert "Broadcast" not in plan_of(made) and "NestedLoop" not in plan_of(made)
    with pytest.raises(ValueError, match="same number"):
        not_in(left, right, ["a"], ["a", "b"])
