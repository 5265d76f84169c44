import random

import duckdb
import pytest
from pyspark.sql import functions as F

from paylake.operators import distinct_sketches as ds
from paylake.operators.overlaps import dyadic_cover, overlap_join
from paylake.operators.quantiles import RANK_ERROR, estimated_percentiles, exact_percentiles, merged_sketches, quantile_sketches, rank_errors
from paylake.operators.samples import bottom_k, share
from tests.conftest import plan_of


def test_covers_are_disjoint_aligned_and_whole(spark):
    rng = random.Random(1)
    spans = [(0, 0), (1, 1), (0, 1023), (-5, 7), (-8, -1), (3, 2**40)] + [(a, a + rng.randint(0, 3000)) for a in (rng.randint(-5000, 5000) for _ in range(80))]
    df = spark.createDataFrame(spans, "l bigint, h bigint")
    for row in df.withColumn("c", dyadic_cover(F.col("l"), F.col("h"))).collect():
        cells = sorted((c["cell"] << c["size"], (c["cell"] + 1) << c["size"]) for c in row["c"])
        assert cells[0][0] == row["l"] and cells[-1][1] == row["h"] + 1
        assert all(a[1] == b[0] for a, b in zip(cells, cells[1:]))
        assert all(sum(c["size"] == s for c in row["c"]) <= 2 for s in range(60))


def _spans(rng, n, longest):
    rows = []
    for i in range(n):
        a = rng.choice([None, *[rng.uniform(-50, 50) for _ in range(20)]])
        rows.append((i, rng.choice(["p", "q", None]), a, None if rng.random() < 0.05 or a is None else a + rng.choice([-1, 0, 0.5, rng.uniform(0, longest)])))
    return rows


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_overlaps_equal_all_pairs(spark, keys):
    rng = random.Random(2)
    one, two = _spans(rng, 120, 3), _spans(rng, 90, 10)
    one += [(1000, "p", -1e6, 1e6), (1001, "q", 5.0, 8.0), (1002, "q", 5.0, 8.0)]  # one over the whole axis, and two alike
    two += [(2000, "q", 5.0, 8.0), (2001, "p", 8.0, 9.0)]
    schema = "id int, k string, a double, z double"
    made = overlap_join(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema), ("a", "z"), ("a", "z"), keys)
    ok = lambda r: r[2] is not None and r[3] is not None and r[2] < r[3]
    want = sorted((x[0], y[0]) for x in one for y in two if ok(x) and ok(y) and x[2] < y[3] and y[2] < x[3] and (not keys or (x[1] is not None and x[1] == y[1])))
    assert sorted((r["left"]["id"], r["right"]["id"]) for r in made.collect()) == want and len(want) > 25
    assert "NestedLoop" not in plan_of(made) and "Cartesian" not in plan_of(made)


def test_covers_of_a_join_need_no_loop_and_no_long_expression(spark):
    """Loops run interpreted, and code over all cells of a cover is too long for the JIT compiler."""
    df = spark.range(50).selectExpr("id % 5 AS k", "double(id) AS a", "double(id + 1 + id % 7) AS z")
    made = overlap_join(df, df, ("a", "z"), ("a", "z"), ["k"])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "array(CASE" not in plan
    rows = df.collect()
    assert made.count() == sum(x["k"] == y["k"] and x["a"] < y["z"] and y["a"] < x["z"] for x in rows for y in rows)


def test_overlaps_of_nothing(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0)], "id int, a double, z double")
    assert overlap_join(df, df, ("a", "z"), ("a", "z")).count() == 0


def _values(spark, n=3000):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, 1.5, 1.5, round(rng.uniform(-9, 9), 3)])) for _ in range(n)]
    return spark.createDataFrame([*rows, ("no values", None), ("one", 4.0)], "k string, v double").repartition(5)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_exact_percentiles_equal_sql(spark, keys):
    df = _values(spark)
    t = df.toPandas()  # noqa: F841  read by the oracle
    fractions = [0.0, 0.25, 0.5, 0.987, 1.0]
    made = exact_percentiles(df, "v", fractions, keys, partitions=6)
    key = "".join(f"{k}, " for k in keys)
    want = []
    for f in fractions:
        want += [(*r[:-1], f, r[-1]) for r in duckdb.sql(f"SELECT {key}quantile_cont(v, {f}) FROM t {'GROUP BY ' + keys[0] if keys else ''}").fetchall()]
    rows = lambda rs: sorted([tuple(round(v, 9) if isinstance(v, float) and v == v else None if v != v else v for v in r) for r in rs], key=repr)
    assert rows(map(tuple, made.collect())) == rows(want)
    assert "SinglePartition" not in plan_of(made.select("percentile")) or not keys


def test_sketches_merge_within_their_error(spark):
    df = _values(spark, 20000).withColumn("part", F.col("v").cast("int") % 7)
    stored = quantile_sketches(df.filter("v IS NOT NULL"), "v", ["k", "part"])
    merged = merged_sketches(stored, ["k"])
    errors = rank_errors(df, estimated_percentiles(merged, [0.01, 0.1, 0.5, 0.9, 0.99], ["k"]), "v", ["k"]).collect()
    assert len(errors) == 20 and max(r["rank_error"] for r in errors) <= RANK_ERROR


def test_stored_distinct_sketches_unite_and_subtract(spark):
    days = spark.range(70_000).selectExpr("id % 20000 AS user", "timestampadd(DAY, id % 7, timestamp_ntz'2026-02-02 10:00:00') AS ts", "IF(id % 20000 < 5000, 'a', 'b') AS kind")
    stored = ds.daily_sketches(days.unionByName(days.limit(500)), "user", "ts", ["kind"])
    assert stored.count() == 14
    week = {r["kind"]: r["n"] for r in ds.united(stored, ["kind"]).select("kind", ds.estimate("sketch").alias("n")).collect()}
    assert abs(week["a"] - 5000) <= ds.ERROR * 5000 and abs(week["b"] - 15000) <= ds.ERROR * 15000
    both = ds.united(stored, []).crossJoin(ds.united(stored.filter("kind = 'a'"), []).withColumnRenamed("sketch", "a"))
    row = both.select(ds.only_in("sketch", "a").alias("o"), ds.in_both("sketch", "a").alias("b")).first()
    assert abs(row["o"] - 15000) <= ds.ERROR * 20000 and abs(row["b"] - 5000) <= ds.ERROR * 20000


def test_samples_follow_the_rows_alone(spark):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 10 < 8 THEN 'hot' WHEN id % 10 = 8 THEN NULL ELSE 'b' END AS k")
    for sample in (lambda d: share(d, ["id"], 50, 3), lambda d: bottom_k(d, ["k"], ["id"], 40, 3)):
        runs = [sorted(r["id"] for r in sample(d).collect()) for d in (df, df.repartition(11), df.coalesce(1))]
        assert runs[0] == runs[1] == runs[2]
    assert 800 < share(df, ["id"], 50, 3).count() < 1200
    assert share(df, ["id"], 0).count() == 0 and share(df, ["id"], 1000).count() == 20_000
    assert {r["k"]: r["count"] for r in bottom_k(df, ["k"], ["id"], 40).groupBy("k").count().collect()} == {"hot": 40, None: 40, "b": 40}
    assert bottom_k(df.filter("id < 30"), ["k"], ["id"], 40).count() == 30
    assert runs[0] != sorted(r["id"] for r in bottom_k(df, ["k"], ["id"], 40, 4).collect())


def test_tasks_keep_the_smallest_before_the_shuffle(spark):
    plan = plan_of(bottom_k(spark.range(1000).selectExpr("id", "id % 3 AS k"), ["k"], ["id"], 5))
    assert plan.count("WindowGroupLimit") >= 2
