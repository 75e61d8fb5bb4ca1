"""Every named query against its SQL twin on DuckDB."""

import datetime as dt
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SMALL = Path("/root/testdata/sf0.001")
SQL = entry_point.oracle_sql()
QUERIES = entry_point.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def content(table):
    def plain(v):
        return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else 0.0 if v == 0 and isinstance(v, float) else v

    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted((tuple(plain(v) for v in r) for r in zip(*columns, strict=True)), key=repr)


def kinds(table):
    def kind(t):
        text = str(t)
        return "time" if text.startswith("timestamp") else text.replace("large_", "")

    return {f.name: kind(f.type) for f in table.schema}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, str(SMALL)).toArrow()
    theirs = duck.sql(SQL[name]).to_arrow_table()
    assert kinds(ours) == kinds(theirs)
    assert content(ours) == content(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, str(SMALL)).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["window_start", "window_end", "vehicle_id"]
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_filters_remove_rows_and_keep_rows(star):
    """The rows that the reports filter on; otherwise a wrong comparison would not show."""
    from pyspark.sql import functions as F

    from haulmark.plans.registry import lookback

    def splits(df, condition):
        kept, rows = df.filter(condition).count(), df.count()
        assert 0 < kept < rows, condition

    splits(star.telemetry, F.col("timestamp") >= lookback())
    splits(star.deliveries, F.col("pickup_time") >= lookback())
    splits(star.incidents, F.col("timestamp") >= lookback())
    splits(star.telemetry, F.col("speed") > 0)
    splits(star.telemetry, F.col("vehicle_id") != F.col("driver_id"))
    splits(star.incidents, F.col("severity") == F.lower("severity"))
    for column in ("vehicle_id", "driver_id", "speed", "fuel_level"):
        splits(star.telemetry, F.col(column).isNull())
    assert star.deliveries.filter("vehicle_id = customer_id").count() == 0
