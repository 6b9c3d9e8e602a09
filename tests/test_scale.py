"""What the plans must keep at any size: pruned scans, sums before shuffles, nothing through Python."""

import re

import pytest

from tickwright.checks.queries import QUERIES
from tickwright.operators.changes import price_changes
from tickwright.operators.levels import open_close, price_levels
from tickwright.operators.moments import weighted_moments
from tickwright.schemas import STOCK_DAY
from tickwright.sources.events import coarse, event_ticks, lineitem_ticks

STREAMS_AND_FILES = {
    "stream_price_changes",
    "stream_price_changes_batches",
    "stream_price_changes_timed",
    "stream_change_log",
    "stream_day_window",
    "stream_closed_days",
    "tsv_files",
    "day_lines",
    "labelled_load",
    "csv_files",
    "updown_append",
    "keyed_update",
    "keyed_update_files",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS_AND_FILES))
def test_no_python_no_product(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|NestedLoop|SinglePartition", plan)


def test_scans_read_what_they_need(spark, sf_dir):
    plan = plan_of(price_levels(event_ticks(spark, sf_dir)))
    schema = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert "event_id" not in schema and "user_id" not in schema
    filtered = plan_of(QUERIES["where_scan"](spark, sf_dir))
    assert "EqualTo(event_type,click)" in filtered and "GreaterThanOrEqual(value,50.0)" in filtered


def test_sums_before_the_shuffle(spark, sf_dir):
    plan = plan_of(price_levels(event_ticks(spark, sf_dir)))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan
    assert "partial_min_by" in plan_of(open_close(event_ticks(spark, sf_dir)))


def executed_plan(df) -> str:
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    return final[: final.find("== Initial Plan ==")]


@pytest.mark.parametrize("name", ["updown_day", "totals_vwap", "day_features"])
def test_day_rows_read_ticks_once(spark, sf_dir, name):
    """Levels are shuffled once to be built and once more, by day, for all that follows."""
    plan = executed_plan(QUERIES[name](spark, sf_dir))
    scans = 1 if name != "day_features" else 2  # its limits are made of the ticks' days here
    assert plan.count("Scan parquet") == scans
    assert plan.count("Exchange hashpartitioning") <= 2 * scans


@pytest.mark.parametrize("name, times", [("run_accumulator", 1), ("open_close", 1), ("edge_ticks", 2)])
def test_edges_need_one_pass(spark, sf_dir, name, times):
    """Whole ticks travel in the aggregate: one scan and one exchange for each edge, and no join back."""
    plan = executed_plan(QUERIES[name](spark, sf_dir))
    assert plan.count("Scan parquet") == plan.count("Exchange hashpartitioning") == times
    assert "Join" not in plan and plan.count("partial_m") >= times


def test_moments_are_summed_before_the_shuffle(spark, sf_dir):
    plan = plan_of(weighted_moments(price_levels(lineitem_ticks(spark, sf_dir)), STOCK_DAY))
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 2 and "partial_try_sum" in plan


def test_moment_sums_are_not_sent(spark, sf_dir):
    """Levels go to their key's task and are summed there: neither sums of all keys in each task nor wide rows sent."""
    plan = plan_of(weighted_moments(price_levels(lineitem_ticks(spark, sf_dir)), STOCK_DAY))
    above, below = plan.split("REPARTITION_BY_COL")
    assert "partial_try_sum" in above and "try_sum" not in below and "try_multiply" not in below


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_key_semijoin_keeps_some_and_drops_some(spark, scale):
    folder = f"/root/testdata/{scale}"
    kept = QUERIES["key_semijoin"](spark, folder).count()
    assert 0.2 < kept / event_ticks(spark, folder).count() < 0.8


def test_without_hot_keys_changes_are_a_plain_lag(spark, sf_dir):
    plan = plan_of(price_changes(coarse(event_ticks(spark, sf_dir))))
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 1 and plan.count("Window ") == 1
