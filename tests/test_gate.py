import pytest
from pyspark.errors import AnalysisException, ParseException, PySparkException

from paylake.operators.gate import register_alias, run_query


@pytest.fixture
def stored(spark, folder):
    spark.sql("SELECT 1 AS id, 'a' AS kind UNION ALL SELECT 2, 'b'").write.partitionBy("kind").parquet(f"{folder}/t")
    return f"{folder}/t"


@pytest.mark.parametrize("sql", [
    "INSERT INTO t VALUES (1)", "CREATE TABLE t (a INT)", "DROP TABLE t", "SET a = 1", "", "   ", "; SELECT 1",
    "VALUES (1)", "EXPLAIN SELECT 1", "-- SELECT 1\nDROP VIEW v", "MERGE INTO t USING s ON true WHEN MATCHED THEN DELETE",
])
def test_other_statements_are_refused(spark, sql):
    with pytest.raises(ValueError):
        run_query(spark, sql)


@pytest.mark.parametrize("sql", [
    "SELECT 1; SELECT 2", "SELECT 1; DROP VIEW guarded", "SELECT 1) ; SET a = 1 --", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a",
    "SELECT 1) AS x; CREATE TEMP VIEW v AS (SELECT 1", "SELECT * FROM (DROP VIEW guarded)", "SELECT 1 /*",
])
def test_hidden_statements_are_refused_before_anything_runs(spark, sql):
    spark.sql("CREATE OR REPLACE TEMP VIEW guarded AS SELECT 1 AS a")
    with pytest.raises(ParseException):
        run_query(spark, sql)
    assert spark.table("guarded").count() == 1


@pytest.mark.parametrize("call", [
    "reflect('java.lang.System', 'getProperty', 'user.home')", "java_method('java.lang.System', 'exit', 0)",
    "try_reflect('java.lang.System', 'lineSeparator')", "`reflect`('java.lang.System', 'lineSeparator')",
    "reflect /* c */ ('java.lang.System', 'lineSeparator')", "IDENTIFIER('reflect')('java.lang.System', 'lineSeparator')",
    "IDENTIFIER('re' || 'flect')('java.lang.System', 'lineSeparator')", "upper(reflect('java.lang.System', 'lineSeparator'))",
])
@pytest.mark.parametrize("form", [
    "SELECT {0}", "WITH a AS (SELECT {0} AS x) SELECT 1 FROM a", "SELECT (SELECT {0})", "SELECT 1 WHERE EXISTS (SELECT {0} WHERE true)",
    "SELECT * FROM range(1), LATERAL (SELECT {0} AS x)", "SELECT id FROM range(2) ORDER BY {0}",
])
def test_jvm_calls_are_refused(spark, call, form):
    with pytest.raises((ValueError, AnalysisException), match="JVM|determin"):
        run_query(spark, form.format(call))


def test_a_view_does_not_hide_a_call(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW calls AS SELECT reflect('java.lang.System', 'lineSeparator') AS x")
    with pytest.raises(ValueError, match="JVM"):
        run_query(spark, "SELECT 1 FROM calls")


@pytest.mark.parametrize("sql", [
    "SELECT TRANSFORM(id) USING 'cat' AS (x STRING) FROM range(3)", "SELECT * FROM (FROM range(2) MAP id USING 'cat' AS (x STRING))",
    "SELECT * FROM (FROM range(2) REDUCE id USING 'cat' AS (x STRING))", "WITH a AS (SELECT TRANSFORM(id) USING 'cat' AS (x STRING) FROM range(3)) SELECT * FROM a",
    "SELECT (SELECT max(x) FROM (SELECT TRANSFORM(id) USING 'cat' AS (x STRING) FROM range(3)))",
])
def test_programs_are_refused(spark, sql):
    with pytest.raises(ValueError, match="programs"):
        run_query(spark, sql)


@pytest.mark.parametrize("form", ["text", "csv", "json", "orc", "binaryFile"])
def test_only_parquet_is_read(spark, folder, form):
    if form == "orc":
        spark.range(1).write.orc(f"{folder}/f")
    else:
        spark.range(1).selectExpr("to_json(struct(id)) AS value").write.text(f"{folder}/f")
    for sql in (f"SELECT * FROM {form}.`{folder}/f`", f"SELECT 1 WHERE 1 IN (SELECT 1 FROM {form}.`{folder}/f`)"):
        with pytest.raises((ValueError, AnalysisException), match="Parquet|INFER"):
            run_query(spark, sql)


@pytest.mark.parametrize("sql", [
    "SELECT * FROM a ASOF JOIN b ON a.x >= b.x", "SELECT * FROM a asof left join b USING (x)", "SELECT * FROM a POSITIONAL JOIN b",
])
def test_joins_of_another_dialect_are_refused(spark, sql):
    with pytest.raises(ValueError, match="dialect"):
        run_query(spark, sql)


def test_reading_words_that_sound_like_writes(spark):
    spark.sql("SELECT 1 AS updated_at, 'x' AS created_at").createOrReplaceTempView("words")
    row = run_query(spark, "SELECT updated_at, replace(created_at, 'x', 'drop; insert') AS text FROM words;").first()
    assert tuple(row) == (1, "drop; insert")
    assert run_query(spark, "SELECT 'a asof join b' AS t, 'reflect(' AS u -- reflect(1)").count() == 1
    assert run_query(spark, "/* lead */ WITH a AS (SELECT 5 AS n) SELECT n FROM a").first().n == 5


def test_order_and_limit_survive(spark):
    rows = run_query(spark, "SELECT id FROM range(10) ORDER BY id DESC LIMIT 3").collect()
    assert [row.id for row in rows] == [9, 8, 7]


def test_nothing_is_collected(spark):
    assert run_query(spark, "SELECT raise_error('ran') AS a FROM range(3)").columns == ["a"]


def test_errors_of_the_engine_pass_through(spark):
    with pytest.raises(AnalysisException):
        run_query(spark, "SELECT nothing FROM nowhere")


@pytest.mark.parametrize("path", ["{0}", "{0}/**", "{0}/**/*", "{0}/**/*.parquet"])
def test_path_scan(spark, stored, path):
    rows = run_query(spark, f"SELECT id, kind FROM read_parquet('{path.format(stored)}') WHERE kind = 'b'").collect()
    assert [tuple(row) for row in rows] == [(2, "b")]


def test_path_scan_with_partition_flag(spark, stored):
    assert run_query(spark, f"SELECT * FROM read_parquet('{stored}/**/*.parquet', hive_partitioning = true)").count() == 2


def test_a_quoted_read_call_is_text(spark):
    assert run_query(spark, """SELECT "read_parquet('x')" AS t""").first().t == "read_parquet('x')"


def test_alias_follows_new_files(spark, stored):
    register_alias(spark, "kinds", f"{stored}/**/*.parquet")
    assert run_query(spark, "SELECT * FROM kinds() LIMIT 10").count() == 2
    spark.sql("SELECT 3 AS id, 'c' AS kind").write.mode("append").partitionBy("kind").parquet(stored)
    assert run_query(spark, "SELECT * FROM kinds()").count() == 3
    assert run_query(spark, "SELECT * FROM kinds").count() == 3


def test_alias_can_be_replaced(spark, stored, folder):
    register_alias(spark, "thing", stored)
    spark.sql("SELECT 9 AS other").write.parquet(f"{folder}/u")
    register_alias(spark, "thing", f"{folder}/u")
    assert run_query(spark, "SELECT * FROM thing()").columns == ["other"]


@pytest.mark.parametrize("name", ["1a", "_a", "", "a-b", "a b", "a;b", "a()", "ä", "a\n"])
def test_alias_names(spark, stored, name):
    with pytest.raises(ValueError, match="alias"):
        register_alias(spark, name, stored)


def test_alias_path_cannot_leave_its_quotes(spark):
    with pytest.raises(PySparkException):
        register_alias(spark, "safe", "x` UNION SELECT 1 --")


def test_path_lists_and_merged_columns(spark, folder):
    spark.sql("SELECT 1 AS a").write.parquet(f"{folder}/x/source=p/day=01")
    spark.sql("SELECT 2 AS a, 'n' AS b").write.parquet(f"{folder}/x/source=q/day=02")
    one, two = f"{folder}/x/source=p/**/*.parquet", f"{folder}/x/source=q/**/*.parquet"
    rows = run_query(spark, f"SELECT a, source, day FROM read_parquet(['{one}', '{two}'], union_by_name = true) ORDER BY a").collect()
    assert [tuple(r) for r in rows] == [(1, "p", "01"), (2, "q", "02")]
    rows = run_query(spark, f"SELECT source, b FROM read_parquet('{folder}/x/source=*/**/*.parquet', union_by_name=true, hive_partitioning=true) ORDER BY 1").collect()
    assert [tuple(r) for r in rows] == [("p", None), ("q", "n")]
    both = f"SELECT l.source, r.source AS other FROM read_parquet('{one}') l CROSS JOIN read_parquet('{two}') r"
    assert [tuple(r) for r in run_query(spark, both).collect()] == [("p", "q")]
    with pytest.raises(ValueError, match="union_by_name"):
        run_query(spark, f"SELECT * FROM read_parquet('{one}', filename = true)")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("paths_")]


def test_the_told_classes_are_those_of_the_tree(spark, folder):
    """The plan's JSON names every class that a walk over its nodes finds, in all registered SQL queries."""
    from paylake.operators import gate
    from paylake.plans import registry

    plans, refuse = [], gate._refuse
    gate._refuse = lambda gateway, plan: plans.append(plan)
    try:
        for name, query in registry.queries().items():
            if name.startswith("sql_"):
                query(spark, "/root/testdata/sf0.001")
    finally:
        gate._refuse = refuse
    gateway = spark.sparkContext._gateway
    assert len(plans) > 40
    for plan in plans:
        walked = list(gate._nodes(gateway, plan))
        assert {n.getClass().getSimpleName().rstrip("$") for n in walked} <= gate._kinds(gateway, plan)
        stored = [n.relation() for n in walked if n.getClass().getSimpleName() == "LogicalRelation"]
        assert len(stored) <= len(list(gate._relations(plan)))


def test_a_call_in_grouping_sets_is_found(spark):
    call = "reflect('java.lang.Math', 'abs', 1)"
    for sql in (f"SELECT * FROM (SELECT {call} AS x, 1 AS y) UNPIVOT (v FOR k IN (x))", f"SELECT x, count(*) FROM (SELECT {call} AS x) GROUP BY CUBE (x)"):
        with pytest.raises((ValueError, AnalysisException)):
            run_query(spark, sql)
