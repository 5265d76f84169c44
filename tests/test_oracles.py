"""Every registered query against plain SQL in DuckDB."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def frame_of(result) -> pd.DataFrame:
    """Whole numbers stay whole where a column has nulls, as they do in the oracle's frame."""
    frame = result.toPandas()
    for field in result.schema.fields:
        if field.dataType.typeName() in ("long", "integer") and frame[field.name].dtype.kind == "f":
            frame[field.name] = frame[field.name].astype("Int64")
    return frame


def rows_of(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(tuple(str(value) for value in row) for row in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_matches_oracle(spark, duck, name):
    result = frame_of(driver.queries()[name](spark, SF))
    oracle = driver.oracle_sql().get(name)
    if oracle is None:
        assert len(result) > 0
        return
    expected = duck.execute(oracle).fetchdf()
    assert sorted(result.columns) == sorted(expected.columns)
    assert rows_of(result) == rows_of(expected)


def test_flagship(spark):
    assert driver.entry(spark).count() == 3


def test_every_oracle_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
