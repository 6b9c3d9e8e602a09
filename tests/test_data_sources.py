"""Loads under a label, and lines by day behind a source that takes filters."""

import json
import os

import pytest
from frames import DAY, ticks
from pyspark.sql import functions as F

from tickwright.operators.changes import price_changes
from tickwright.schemas import PRICE_CHANGES
from tickwright.session import shared_dir
from tickwright.sinks import load_labelled, read_labelled, write_day_lines
from tickwright.sources import lines, read_day_lines
from tickwright.sources.events import coarse, event_ticks


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _changes(spark, *days):
    rows = [("aé", f"09:30:0{i}", i, p, None if i == 2 else i, DAY.replace(day=d)) for d in days for i, p in enumerate((10, 11, 11, 12), 1)]
    return price_changes(ticks(spark, rows))


def test_a_label_is_loaded_once(spark):
    path = shared_dir(spark, "labels")
    one, two = _changes(spark, 1, 2), _changes(spark, 3)
    assert read_labelled(spark, path, PRICE_CHANGES).collect() == []
    load_labelled(one, path, "first")
    load_labelled(two, path, "first")
    assert _rows(read_labelled(spark, path, PRICE_CHANGES)) == _rows(one)
    load_labelled(two, path, "second")
    load_labelled(two.limit(0), path, "none")
    assert _rows(read_labelled(spark, path, PRICE_CHANGES)) == _rows(one.union(two))
    with open(f"{path}/_labels/first.json") as entry:
        assert json.load(entry)["rows"] == one.count()
    for label in ("", "../x", ".hidden"):
        with pytest.raises(ValueError):
            load_labelled(one, path, label)


def test_a_failed_load_leaves_nothing(spark):
    path = shared_dir(spark, "failed")
    rows = _changes(spark, 1, 2).repartition(3)
    broken = rows.withColumn("order_dc", F.when(F.col("price") == 12, F.raise_error(F.lit("broken off")).cast("string")).otherwise(F.lit("x")))
    with pytest.raises(Exception, match="broken off"):
        load_labelled(broken, path, "first")
    assert read_labelled(spark, path, PRICE_CHANGES).collect() == [] and not os.listdir(f"{path}/_labels")
    load_labelled(rows, path, "first")
    assert _rows(read_labelled(spark, path, PRICE_CHANGES)) == _rows(rows)


def test_two_loads_of_a_label_at_once(spark):
    """Of two that both found no entry, the one that commits last takes its files away."""
    from tickwright.sinks.labelled import _Writer

    path = shared_dir(spark, "race")
    os.makedirs(path)
    batch = _changes(spark, 1).toArrow().to_batches()
    writers = [_Writer(path, "same"), _Writer(path, "same")]
    staged = [[w.write(iter(batch))] for w in writers]
    for w, messages in zip(writers, staged):
        w.commit(messages)
    assert _rows(read_labelled(spark, path, PRICE_CHANGES)) == _rows(_changes(spark, 1))
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1


@pytest.mark.parametrize("split", [64_000_000, 50])
def test_lines_by_day(spark, monkeypatch, split):
    monkeypatch.setattr(lines, "SPLIT_BYTES", split)
    path = shared_dir(spark, "lines")
    rows = _changes(spark, 1, 2, 3)
    write_day_lines(rows, path)
    table = read_day_lines(spark, path)
    assert _rows(table) == _rows(rows)
    for where in ("order_date = DATE'2024-11-02'", "order_code = 'aé' AND volume IS NULL", "order_code IN ('b', 'c')", "order_date > DATE'2024-11-01' AND price < 11.5"):
        assert _rows(table.where(where)) == _rows(rows.where(where)), where
    few = read_day_lines(spark, path, type(PRICE_CHANGES)([PRICE_CHANGES["price"], PRICE_CHANGES["order_time"]]))
    assert _rows(few) == _rows(rows.select("price", "order_time"))


def test_filters_choose_files(spark, sf_dir):
    path = shared_dir(spark, "pruned")
    write_day_lines(price_changes(coarse(event_ticks(spark, sf_dir))), path)
    found = read_day_lines(spark, path).where("order_date = DATE'2024-01-05' AND order_code = 'click' AND price > 20")
    # Other days' files may hold anything: they are not opened.
    for folder in os.listdir(path):
        if folder.startswith("order_date=") and "2024-01-05" not in folder:
            for name in os.listdir(f"{path}/{folder}"):
                if not name.startswith("."):
                    with open(f"{path}/{folder}/{name}", "wb") as file:
                        file.write(b"not a line\n")
    wanted = price_changes(coarse(event_ticks(spark, sf_dir))).where("order_date = DATE'2024-01-05' AND order_code = 'click' AND price > 20")
    assert _rows(found) == _rows(wanted) and wanted.count() > 0
