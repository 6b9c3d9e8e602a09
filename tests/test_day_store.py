"""Tables stored by stock-day: the rows of the plain plan, without moving what is stored."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from tickwright.operators.levels import open_close, price_levels
from tickwright.plans import on_days_of, open_by_day, store_by_day, updown_day, updown_day_stored
from tickwright.sources import work_list
from tickwright.sources.events import event_ticks

BUCKETS = 8


def _table():
    return f"stored_{uuid.uuid4().hex}"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def plain(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir)
    return [price_levels(ticks), open_close(ticks), work_list(ticks)]


@pytest.fixture(scope="module")
def stored(plain, tmp_path_factory):
    folder = tmp_path_factory.mktemp("by-day")
    return [store_by_day(df, _table(), str(folder / str(k)), BUCKETS) for k, df in enumerate(plain)]


@pytest.fixture
def large(spark):
    """Joins as they are between sides too large to be sent whole."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_same_rows_as_the_plain_plan(plain, stored):
    for condition in ("true", "dayofmonth(order_date) % 2 = 0", "order_code = 'click'", "false"):
        listed = [df.where(condition) for df in (plain[2], stored[2])]
        assert _rows(updown_day_stored(*stored[:2], listed[1])) == _rows(updown_day(*plain[:2], listed[0]))


def test_stored_rows_are_not_moved(stored, large):
    plan = _planned(updown_day_stored(*stored[:2], stored[2].where("order_code IN ('click', 'view')")))
    # Days are the only thing that is sent anywhere.
    assert set(re.findall(r"Exchange (\w+partitioning\(\w*|Single\w*|RoundRobin\w*)", plan)) == {"hashpartitioning(in_day"}
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 3


def test_other_days_are_not_opened(stored, large):
    few = stored[2].where("order_code = 'click' AND dayofmonth(order_date) = 3")
    listed = on_days_of(stored[0], few)
    assert "dynamicpruning" in _planned(listed)
    assert {r.order_date.day for r in listed.select("order_date").distinct().collect()} == {3}


def test_opened_by_another_catalog_entry(spark, plain, stored, tmp_path):
    path, first = str(tmp_path / "levels"), _table()
    store_by_day(plain[0], first, path, BUCKETS)
    spark.sql(f"DROP TABLE {first}")
    again = open_by_day(spark, _table(), path, plain[0].schema, BUCKETS)
    assert _rows(again.drop("in_day")) == _rows(plain[0])
    assert _rows(updown_day_stored(again, *stored[1:])) == _rows(updown_day(*plain))


def test_empty_tables_and_missing_keys(spark, plain, stored, tmp_path):
    empty = store_by_day(plain[0].limit(0), _table(), str(tmp_path / "empty"), BUCKETS)
    assert updown_day_stored(empty, *stored[1:]).count() == 0
    odd = plain[0].limit(5).withColumn("order_code", F.lit(None).cast("string")).unionByName(
        plain[0].limit(5).withColumn("order_date", F.lit(None).cast("date"))
    )
    kept = store_by_day(plain[0].unionByName(odd), _table(), str(tmp_path / "odd"), BUCKETS)
    assert kept.count() == plain[0].count() + 10
    assert _rows(updown_day_stored(kept, *stored[1:])) == _rows(updown_day(*plain))
