"""Updates by key that rewrite only the files they meet."""

import glob
import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tickwright.schemas import BARS
from tickwright.sinks import VersionTaken, create_versions, forget_before, read_version, update_version, versions
from tests import frames

N = 2000


@pytest.fixture
def bars(spark):
    """Ids in the order of days; the third of all bars is on one day."""
    day = F.date_add(F.lit(frames.DAY), F.greatest(F.lit(0), F.col("id").cast("int") - N // 3))
    rows = spark.range(N).select("id", F.lit("c").alias("code"), day.alias("date"), F.lit(1.0).alias("start"))
    return rows.withColumn("end", F.col("id").cast("double"))


@pytest.fixture
def path(tmp_path, bars):
    folder = str(tmp_path / "bars + 5% in")
    create_versions(bars, folder, key=["id"], part="date", file_rows=20)
    return folder


def _files(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{glob.escape(path)}/rows/*/*.parquet")}


def _named(spark, path, number=None):
    of = versions.version(path, number)
    return {"rows/" + f for f in versions._names(versions._manifest(spark, path, of), "file")}


def _updates(bars, condition, start=7.5):
    return bars.where(condition).select("date", "id", F.lit(start).alias("start"))


def _rows(df):
    return sorted(map(tuple, df.select(*BARS.names).collect()), key=str)


def _expected(bars, condition, start=7.5):
    return _rows(bars.withColumn("start", F.when(condition, start).otherwise(F.col("start"))))


def test_one_percent_rewrites_its_files_only(spark, bars, path):
    before = _named(spark, path)
    assert len(before) >= N // 20
    hit = F.col("id").between(700, 719)
    made, n = update_version(_updates(bars, hit), path)
    after = _named(spark, path)
    assert made.number == 2 and n == len(before - after) <= 2
    assert _rows(read_version(spark, path)) == _expected(bars, hit)
    assert _rows(read_version(spark, path, 1)) == _rows(bars)
    # Files that are new are as narrow as those they replace.
    assert len(after - before) <= n + 1


def test_scattered_keys(spark, bars, path):
    hit = F.col("id").isin(3, 640, 1999)
    _, n = update_version(_updates(bars, hit), path)
    assert n == 3
    assert _rows(read_version(spark, path)) == _expected(bars, hit)
    _, n = update_version(_updates(bars, F.col("id") % 2 == 0, 8.0), path)
    assert n == len(_named(spark, path, 2))
    assert _rows(read_version(spark, path)) == _rows(
        bars.withColumn("start", F.expr("CASE WHEN id % 2 = 0 THEN 8.0D WHEN id = 3 OR id = 1999 THEN 7.5D ELSE start END"))
    )


def test_odd_updates(spark, bars, path):
    day = frames.DAY
    rows = [(day, 5, 2.0), (day, 5, 3.0), (day, None, 9.0), (None, 6, 9.0), (day, 999_999, 9.0), (day + timedelta(1), 7, 9.0), (day, 8, None)]
    updates = spark.createDataFrame(rows, "date date, id long, start double")
    update_version(updates.withColumn("stranger", F.lit(1)), path)
    found = {r.id: r.start for r in read_version(spark, path).collect()}
    assert found[5] == 3.0 and found[8] is None
    assert [k for k, v in found.items() if v != 1.0] == [k for k in found if k in (5, 8)]
    assert len(found) == N


def test_updates_that_meet_nothing_make_no_version(spark, bars, path):
    nothing = spark.createDataFrame([(date(1999, 1, 1), 5, 2.0)], "date date, id long, start double")
    for updates in (nothing, nothing.limit(0)):
        made, n = update_version(updates, path)
        assert (made.number, n) == (1, 0)
    assert versions.versions(path) == [1]


def test_the_later_of_two_updates_fails(spark, bars, path):
    base = versions.version(path)
    update_version(_updates(bars, F.col("id") < 10), path, base)
    with pytest.raises(VersionTaken):
        update_version(_updates(bars, F.col("id") > 1990), path, base)
    assert _rows(read_version(spark, path)) == _expected(bars, F.col("id") < 10)
    with pytest.raises(VersionTaken):
        create_versions(bars, path, key=["id"], part="date")


def test_an_update_that_breaks_off_is_not_seen(spark, bars, path, monkeypatch):
    def broken(*_):
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(versions, "_commit", broken)
        with pytest.raises(OSError):
            update_version(_updates(bars, F.col("id") < 10), path)
    assert _files(path) > _named(spark, path)
    assert _rows(read_version(spark, path)) == _rows(bars)
    update_version(_updates(bars, F.col("id") < 10), path)
    assert _rows(read_version(spark, path)) == _expected(bars, F.col("id") < 10)


def test_empty_table_and_rows_without_key(spark, bars, tmp_path):
    empty, odd = str(tmp_path / "empty"), str(tmp_path / "odd")
    create_versions(bars.limit(0), empty, key=["id"], part="date")
    assert update_version(_updates(bars, F.lit(True)), empty)[1] == 0
    assert read_version(spark, empty).count() == 0
    rows = [(None, "c", frames.DAY, 1.0, 2.0), (1, None, None, 1.0, 2.0), (2, "c", frames.DAY, None, 2.0)]
    table = spark.createDataFrame(rows, BARS).withColumn("__extra", F.lit("x"))
    create_versions(table, odd, key=["id"], part="date")
    update_version(table.select("date", "id", F.lit(5.0).alias("start")), odd)
    found = read_version(spark, odd)
    assert found.columns == table.columns
    assert sorted((r.id or 0, r.start) for r in found.collect()) == [(0, 1.0), (1, 1.0), (2, 5.0)]


def test_old_versions_go_with_their_files_only(spark, bars, path):
    first, low, high = _named(spark, path), F.col("id") < 10, F.col("id") > 1990
    update_version(_updates(bars, low), path)
    update_version(_updates(bars, high), path)
    assert forget_before(spark, path, 1) == 0
    kept = _named(spark, path, 2) | _named(spark, path, 3)
    assert forget_before(spark, path, 2) == len(first - kept) > 0
    assert versions.versions(path) == [2, 3] and _files(path) == kept
    assert _rows(read_version(spark, path, 2)) == _expected(bars, low)
    assert _rows(read_version(spark, path)) == _expected(bars, low | high)
    assert update_version(_updates(bars, low, 9.0), path)[0].number == 4
    with pytest.raises(ValueError):
        forget_before(spark, path, 1)
