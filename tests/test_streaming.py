"""Streams give the rows of their batch twins, over any number of files and after a repeat."""

import glob
import random
import time
from collections import Counter

import pandas as pd
import pytest
from frames import DAY, ticks
from pyspark.sql import functions as F

from tickwright.operators.changes import price_changes
from tickwright.operators.runs import accumulate, run_rows
from tickwright.schemas import PRICE_CHANGES, TICKS
from tickwright.session import shared_dir
from tickwright.sinks import print_stream
from tickwright.sources import read_table, read_tick_stream
from tickwright.sources.events import coarse, event_columns, event_ticks
from tickwright.streaming import (
    day_window,
    drain,
    latest_rows,
    replay,
    stream_change_log,
    stream_day_window,
    stream_price_changes,
)
from tickwright.streaming.change_log import _SliceChanges


def rows_of(df):
    return sorted(map(tuple, df.select(*PRICE_CHANGES.names).collect()))


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    """Ticks of the first three days in five files, in time order."""
    few = coarse(event_ticks(spark, sf_dir)).where("order_date < DATE'2024-01-04'").persist()
    cuts = [0, *[few.agg(F.max("tran_id")).first()[0] * i // 5 for i in range(1, 5)], 10**12]
    path = shared_dir(spark, "time-ordered")
    for low, high in zip(cuts, cuts[1:]):
        part = few.where((F.col("tran_id") >= low) & (F.col("tran_id") < high))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return path, few


@pytest.mark.parametrize("per_trigger", [1, 2, None])
@pytest.mark.parametrize("hot_over", [5, 10**9])
def test_changes_over_files(spark, parts, per_trigger, hot_over):
    path, few = parts
    work = shared_dir(spark, "stream-test")
    stream = read_tick_stream(spark, path, schema=TICKS, files_per_trigger=per_trigger)
    stream_price_changes(stream, f"{work}/out", work, hot_over=hot_over).awaitTermination()
    batches = {1: 5, 2: 3, None: 1}[per_trigger]
    assert len(glob.glob(f"{work}/out/batch=*")) == batches
    assert rows_of(read_table(spark, f"{work}/out")) == rows_of(price_changes(few))


def test_repeated_batch(spark, parts):
    """A batch that is handed over again, as after a failure, leaves the same result."""
    path, few = parts
    work = shared_dir(spark, "repeat")
    seen = []

    def twice(write):
        def again(batch, number):
            write(batch, number)
            write(batch, number)
            seen.append(number)

        return again

    from tickwright.streaming import changes

    original = changes.drain
    changes.drain = lambda stream, write, *rest, **more: original(stream, twice(write), *rest, **more)
    try:
        stream = read_tick_stream(spark, path, files_per_trigger=1)
        stream_price_changes(stream, f"{work}/out", work).awaitTermination()
    finally:
        changes.drain = original
    assert seen == [0, 1, 2, 3, 4]
    assert rows_of(read_table(spark, f"{work}/out")) == rows_of(price_changes(few))


def test_restart_goes_on(spark):
    folder, work = shared_dir(spark, "restart-in"), shared_dir(spark, "restart")

    def run(rows):
        ticks(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = read_tick_stream(spark, folder, files_per_trigger=1)
        stream_price_changes(stream, f"{work}/out", work).awaitTermination()

    run([("a", "09:30:00", 1, 10, 1), ("b", "09:30:00", 2, 5, 1)])
    run([("a", "09:30:01", 3, 10, 1), ("a", "09:30:02", 4, 11, 1)])
    run([("b", "09:30:03", 5, 5, 1), ("a", "09:30:03", 6, 11, 1), ("b", "09:30:04", 7, 6, 1)])
    got = [(r[0], r[2], int(r[4])) for r in rows_of(read_table(spark, f"{work}/out"))]
    assert got == [
        ("a", "09:30:00", 10),
        ("a", "09:30:02", 11),
        ("b", "09:30:00", 5),
        ("b", "09:30:04", 6),
    ]


def test_a_batch_writes_its_own_days_only(spark):
    from datetime import timedelta

    folder, work = shared_dir(spark, "days-in"), shared_dir(spark, "days")
    versions = []
    for i, days in enumerate([(0, 1), (1,), (2, 1), (0,)]):
        rows = [("a", f"09:3{i}:00", 10 * i + d, 10 + i, 1, DAY + timedelta(d)) for d in days]
        ticks(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = read_tick_stream(spark, folder, files_per_trigger=1)
        stream_price_changes(stream, f"{work}/out", work).awaitTermination()
        written = spark.read.parquet(f"{work}/last_price").where(F.col("batch") == i)
        versions.append({(r.order_date - DAY).days: int(r.price) for r in written.collect()})
        time.sleep(1.1)
    assert versions == [{0: 10, 1: 10}, {1: 11}, {1: 12, 2: 12}, {0: 13}]
    folders = glob.glob(f"{work}/last_price/slot=*/order_date=*")
    assert len(folders) == 5  # two versions of days 0 and 1, one of day 2
    assert len(rows_of(read_table(spark, f"{work}/out"))) == 6


def test_late_ticks_are_reported(spark):
    folder, work = shared_dir(spark, "order-in"), shared_dir(spark, "order")
    for rows in (
        [("a", "09:30:05", 5, 10, 1), ("b", "09:30:00", 6, 7, 1)],
        [("a", "09:30:01", 1, 11, 1), ("a", "09:30:05", 5, 12, 1), ("a", "09:30:05", 7, 13, 1)],
        [("a", "09:30:06", 8, 13, 1), ("c", "09:00:00", 9, 1, 1)],
    ):
        ticks(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    stream = read_tick_stream(spark, folder, files_per_trigger=1)
    stream_price_changes(stream, f"{work}/out", work).awaitTermination()
    late = read_table(spark, f"{work}/late").collect()
    assert sorted((r.batch, r.order_code, int(r.price)) for r in late) == [(1, "a", 11), (1, "a", 12)]
    got = [(r[0], r[2], int(r[4])) for r in rows_of(read_table(spark, f"{work}/out"))]
    assert got == [("a", "09:30:05", 10), ("a", "09:30:05", 13), ("b", "09:30:00", 7), ("c", "09:00:00", 1)]


def test_day_window(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = read_tick_stream(spark, f"{sf_dir}/event[s].parquet", schema=schema)
    whole = rows_of(run_rows(accumulate(event_ticks(spark, sf_dir))))
    for mode in ("update", "append"):
        work = shared_dir(spark, f"days-{mode}")
        stream_day_window(event_columns(source), f"{work}/out", work, mode=mode).awaitTermination()
        got = rows_of(latest_rows(read_table(spark, f"{work}/out")))
        last = max(r[1] for r in whole)
        assert got == (whole if mode == "update" else [r for r in whole if r[1] < last])


def test_late_ticks_are_left_out(spark):
    folder, work = shared_dir(spark, "late-in"), shared_dir(spark, "late")
    for rows in (
        [("a", "12:00:00", 1, 10, 5)],
        [("a", "12:00:00", 2, 10, 5, DAY.replace(day=25))],
        [("a", "12:01:00", 3, 10, 1, DAY.replace(day=25))],
        [("a", "13:00:00", 4, 10, 5)],
    ):
        ticks(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    stream = read_tick_stream(spark, folder, files_per_trigger=1)
    stream_day_window(stream, f"{work}/out", work).awaitTermination()
    got = latest_rows(read_table(spark, f"{work}/out")).collect()
    assert {r.order_date: r.volume for r in got} == {DAY: 5, DAY.replace(day=25): 6}


def test_drain_and_print(spark, parts):
    path, few = parts
    numbers = []
    stream = read_tick_stream(spark, path, files_per_trigger=2)
    query = drain(stream, lambda batch, n: numbers.append(n), shared_dir(spark, "drain"))
    query.awaitTermination()
    assert numbers == [0, 1, 2]
    timed = drain(
        stream, lambda batch, n: numbers.append(n), shared_dir(spark, "timed"), every="1 second"
    )
    timed.processAllAvailable()
    timed.stop()
    assert len(numbers) == 6
    shown = print_stream(stream, shared_dir(spark, "console"), rows=1)
    shown.awaitTermination()
    assert shown.exception() is None and shown.lastProgress["numInputRows"] > 0


def test_day_window_is_streaming(spark, parts):
    path, _ = parts
    assert day_window(read_tick_stream(spark, path).withColumn("ts", F.current_timestamp())).isStreaming


def _rows(log):
    return sorted(map(tuple, replay(log).collect()), key=str)


def test_log_of_ticks_in_any_order(spark, sf_dir):
    """Ticks dealt over batches by chance: after each batch the log gives the changes of all ticks so far."""
    few = coarse(event_ticks(spark, sf_dir)).where("order_date < DATE'2024-01-03'").withColumn("part", F.pmod(F.xxhash64("tran_id"), F.lit(3)))
    folder, work = shared_dir(spark, "log-in"), shared_dir(spark, "log")
    taken_back = 0
    for part in range(3):
        few.where(F.col("part") == part).drop("part").repartition(2).write.mode("append").parquet(folder)
        stream = read_tick_stream(spark, folder, schema=TICKS)
        stream_change_log(stream, f"{work}/out", work, slice_chars=2).awaitTermination()  # starts anew each time
        log = read_table(spark, f"{work}/out")
        assert _rows(log) == sorted(map(tuple, price_changes(few.where(F.col("part") <= part)).collect()), key=str)
        taken_back += log.where("op < 0").count()
    assert taken_back > 0
    assert log.where(F.col("batch") == 0).where("op < 0").count() == 0


def test_late_ticks_undo_changes(spark):
    folder, work = shared_dir(spark, "late-log-in"), shared_dir(spark, "late-log")
    seen = []
    for rows in (
        [("a", "09:30:05", 5, 10, 1), ("a", "09:31:00", 6, 11, 2), ("b", "x", 1, 7, 1)],
        [("a", "09:30:30", 4, 11, 3), ("a", "09:30:31", 5, 11, 4), ("a", "09:30:05", 5, 10, 1)],
        [("a", "09:29:00", 1, 10, 5), ("c", None, 1, 1, 1), ("c", "09:29:00", None, 1, 1), ("b", "w", 1, 7, None)],
    ):
        ticks(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream_change_log(read_tick_stream(spark, folder), f"{work}/out", work).awaitTermination()
        log = read_table(spark, f"{work}/out").where(F.col("batch") == len(seen))
        seen.append(sorted((r.op, r.order_code, r.order_time, int(r.price)) for r in log.collect()))
        time.sleep(1.1)
    assert seen == [
        [(1, "a", "09:30:05", 10), (1, "a", "09:31:00", 11), (1, "b", "x", 7)],
        [(-1, "a", "09:31:00", 11), (1, "a", "09:30:30", 11)],
        [(-1, "a", "09:30:05", 10), (-1, "b", "x", 7), (1, "a", "09:29:00", 10), (1, "b", "w", 7)],
    ]


def test_a_slice_is_kept_as_one_value():
    """However many ticks a slice has, the state store is read and written once for it, not once a tick."""

    class Kept:
        value, calls = None, 0

        def getValueState(self, name, schema, ttl):
            return self

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

    chance, kept, slices = random.Random(2), Kept(), _SliceChanges(1000)
    slices.init(kept)
    rows = [(f"09:30:{chance.randrange(60):02d}", i, chance.choice(["B", None]), chance.randrange(3), chance.choice([None, i])) for i in range(3000)]
    chance.shuffle(rows)
    seen, left = [], Counter()
    for k in range(0, 3000, 1000):
        new, seen = rows[k : k + 1000], sorted(rows[: k + 1000], key=lambda t: t[:2])
        (made,) = slices.handleInputRows(("a", DAY, "09"), iter([pd.DataFrame(new, columns=["order_time", "tran_id", "order_dc", "price", "volume"])]), None)
        for op, *tick in made.drop(columns=["order_code", "order_date", "slice", "last_price"]).itertuples(index=False):
            left[tuple(None if pd.isna(v) else v for v in tick)] += op
        assert kept.calls == 2 * (k // 1000 + 1)
        assert sorted((+left).elements(), key=lambda t: t[:2]) == [b for a, b in zip(seen, seen[1:]) if a[3] != b[3]]
        assert min(left.values()) == 0
        assert made.where(made["op"] == 0).dropna(subset=["op"])["last_price"].tolist() in ([], [seen[-1][3]])


def test_a_batch_reads_its_source_once(spark, monkeypatch):
    """What a batch is made of is worked out once, however often its rows are used."""
    folder, work = shared_dir(spark, "once-in"), shared_dir(spark, "once")
    ticks(spark, [("a", "09:30:00", i, i % 7, 1) for i in range(1, 60)]).coalesce(1).write.parquet(folder)
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    source = read_tick_stream(spark, folder)
    stream_price_changes(source.mapInArrow(seen, source.schema), f"{work}/out", work).awaitTermination()
    assert counted.value == 59
