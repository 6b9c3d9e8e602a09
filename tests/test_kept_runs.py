"""Kept run rows against the runs of all ticks."""

import glob
import os
import shutil

import pytest

from tests import frames
from tickwright.operators.runs import accumulate, run_rows
from tickwright.plans import keep_runs, kept_runs, run_store
from tickwright.schemas import TICKS
from tickwright.sinks.tables import append_rows


def _rows(runs):
    return sorted(run_rows(runs).collect(), key=str)


def _load(spark, path, first, count=40):
    rows = [(f"c{i % 3}", f"09:{i % 60:02d}:00", i, i % 7 + 1, i, frames.DAY) for i in range(first, first + count)]
    rows += [("none", "09:00:00", None, 1, 1), ("none", "09:00:00", 7, None, 1)]
    frames.ticks(spark, rows).repartition(3, "tran_id").write.mode("append").parquet(path)


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "ticks + 5% in"), str(tmp_path / "store")


def _agrees(spark, path, store):
    assert _rows(kept_runs(spark, path, store)) == _rows(accumulate(spark.read.schema(TICKS).parquet(path)))


def test_only_new_files_are_read(spark, folders):
    path, store = folders
    _load(spark, path, 0)
    first = len(glob.glob(f"{path}/*.parquet"))
    assert keep_runs(spark, path, store) == first
    _agrees(spark, path, store)
    assert keep_runs(spark, path, store) == 0
    _load(spark, path, 1000)
    assert keep_runs(spark, path, store) == len(glob.glob(f"{path}/*.parquet")) - first
    _agrees(spark, path, store)


def test_replaced_and_removed_files(spark, folders, tmp_path):
    path, store = folders
    _load(spark, path, 0)
    keep_runs(spark, path, store)
    other = str(tmp_path / "other")
    _load(spark, other, 5000, 90)
    old, gone = sorted(glob.glob(f"{path}/*.parquet"))[:2]
    shutil.copyfile(max(glob.glob(f"{other}/*.parquet"), key=os.path.getsize), old)
    checksum = os.path.join(path, f".{os.path.basename(old)}.crc")
    if os.path.exists(checksum):
        os.unlink(checksum)
    os.unlink(gone)
    assert keep_runs(spark, path, store) == 1
    _agrees(spark, path, store)


def test_a_load_that_broke_off_does_not_count(spark, folders):
    path, store = folders
    _load(spark, path, 0)
    keep_runs(spark, path, store)
    _load(spark, path, 500)
    ticks = spark.read.schema(TICKS).parquet(path)
    append_rows(run_store._parts_of(ticks, "broken", run_store._file_read()), f"{store}/parts", by_day="order_date")
    keep_runs(spark, path, store)
    _agrees(spark, path, store)


def test_no_ticks(spark, folders):
    path, store = folders
    spark.createDataFrame([], TICKS).write.parquet(path)
    keep_runs(spark, path, store)
    assert kept_runs(spark, path, store).count() == 0


def test_a_day_reads_its_folder_only(spark, folders):
    path, store = folders
    _load(spark, path, 0)
    keep_runs(spark, path, store)
    day = kept_runs(spark, path, store).where(f"order_date = DATE'{frames.DAY}'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan
    assert day.count() == 3
