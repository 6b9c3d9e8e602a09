"""Price changes, runs and carried bars."""

import random
from datetime import date, timedelta

import pytest
from frames import DAY, ticks
from pyspark.sql import functions as F

from tickwright.operators import previous
from tickwright.operators.carry import apply_starts, bars_in_order, carry_forward
from tickwright.operators.changes import last_prices, price_changes
from tickwright.operators.levels import TICK_ORDER
from tickwright.operators.previous import hot_keys, sliced
from tickwright.operators.runs import accumulate, merge_runs, run_rows
from tickwright.schemas import BARS, PRICE_CHANGES, STOCK_DAY


def expected_changes(rows):
    """One pass over each day's ticks in order."""
    last, kept = {}, []
    for code, time, tran, price, volume in sorted(rows, key=lambda r: (r[1], r[2])):
        if last.get(code) != price:
            kept.append((code, time, float(price), volume))
        last[code] = price
    return sorted(kept)


def found_changes(df):
    return sorted((r.order_code, r.order_time, float(r.price), r.volume) for r in df.collect())


def random_ticks(seed, codes, count, stamps):
    chance = random.Random(seed)
    return [
        (f"c{chance.randrange(codes)}", chance.choice(stamps), i, chance.randint(1, 3), i % 7)
        for i in range(count)
    ]


def test_flat_run(spark):
    rows = [("a", f"09:30:0{i}", i, p, 100 + i) for i, p in enumerate([10, 10, 11, 11, 10])]
    result = price_changes(ticks(spark, rows)).orderBy("order_time")
    assert result.schema.names == PRICE_CHANGES.names
    got = result.collect()
    assert [int(r.price) for r in got] == [10, 11, 10]
    assert [r.volume for r in got] == [100, 102, 104]
    assert [int(r["sum"]) for r in got] == [1000, 1122, 1040]


def test_ties_and_nulls(spark):
    rows = [
        ("a", "09:30:00", 2, 11, 1),
        ("a", "09:30:00", 1, 10, 1),
        ("a", "09:30:01", None, 50, 1),
        ("a", "09:30:02", 3, None, 1),
        ("a", "09:30:03", 4, 11, 1),
    ]
    got = price_changes(ticks(spark, rows)).orderBy("price").collect()
    assert [int(r.price) for r in got] == [10, 11]


def test_slices_change_nothing(spark):
    seconds = [f"09:3{i}:{j:02d}" for i in range(3) for j in range(0, 60, 20)]
    finer = ["09:30:00", "09:30:00.1", "09:30:00.25", "09:30:01", "9"]
    for stamps in (seconds, ["15:00:00"], finer):
        rows = random_ticks(len(stamps), 3, 900, stamps)
        rows += [("small", "10:00:00", -5, 4, 1), ("small", "10:00:00", 5, 4, 1)]
        table = ticks(spark, rows)
        wanted = expected_changes(rows)
        for hot_over in (0, 100, 10**9):
            assert found_changes(price_changes(table, hot_over=hot_over)) == wanted


@pytest.mark.parametrize(
    "name", ["dense ids", "spread ids", "one time", "sub-second", "half in one second"]
)
def test_slices_are_as_large_as_they_may_be(spark, name):
    """Slices per hot key and rows per slice are bounded whatever the order values look like."""
    chance, n, hot_over = random.Random(name), 20_000, 1000
    clock = lambda i: f"{9 + i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}"
    made = {
        "dense ids": lambda i: (clock(i), i),
        "spread ids": lambda i: (clock(i), i << 22),
        "one time": lambda i: ("15:00:00", i * 7919),
        "sub-second": lambda i: (f"09:30:00.{i:06d}", i),
        "half in one second": lambda i: (clock(i) if i % 2 else "09:30:00", chance.randrange(10**15)),
    }[name]
    table = ticks(spark, [("a", *made(i), 1, 1) for i in range(n)] + [("b", "9", i, 1, 1) for i in range(50)])
    hot = hot_keys(table, STOCK_DAY, hot_over)
    assert [(r.order_code, r.rows) for r in hot] == [("a", n)]
    cut = sliced(table.where("order_code = 'a'"), STOCK_DAY, TICK_ORDER, hot_over, n)
    sizes = [r["count"] for r in cut.groupBy(*STOCK_DAY, "slice").count().collect()]
    assert sum(sizes) == n and max(sizes) <= hot_over and len(sizes) <= 2 * n / hot_over + 1


def test_small_slices_cost_no_tasks(spark):
    """Slices of few rows share a task and its file, and rows at one place may be dealt to several slices."""
    rows = random_ticks(3, 2, 6000, ["09:30:00", "09:30:01", "15:00:00"])
    table = ticks(spark, rows)
    cut = sliced(table, STOCK_DAY, TICK_ORDER, 5, len(rows))
    assert len(cut.inputFiles()) == 1
    assert max(r["count"] for r in cut.groupBy(*STOCK_DAY, "slice").count().collect()) <= 5
    assert found_changes(price_changes(table, hot_over=5)) == expected_changes(rows)
    twice = table.unionByName(table)
    plain = sorted(map(tuple, price_changes(twice, hot_over=10**9).collect()))
    assert sorted(map(tuple, price_changes(twice, hot_over=3).collect())) == plain


def test_only_the_largest_keys_are_listed(spark, monkeypatch):
    monkeypatch.setattr(previous, "MOST_HOT", 2)
    rows = random_ticks(9, 6, 900, ["09:30:00", "09:31:00"])
    table = ticks(spark, rows)
    assert len(hot_keys(table, STOCK_DAY, 10)) == 2
    assert found_changes(price_changes(table, hot_over=10)) == expected_changes(rows)


def test_changes_of_changes(spark):
    """No equal neighbours are left, so the operator keeps every row of its own result."""
    rows = random_ticks(5, 4, 400, [f"09:30:{i:02d}" for i in range(60)])
    wanted = expected_changes(rows)
    kept, last = [], {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        if last.get(row[0]) != row[3]:
            kept.append(row)
        last[row[0]] = row[3]
    assert found_changes(price_changes(ticks(spark, kept))) == wanted


def test_earlier_last_price(spark):
    first = [("a", "09:30:00", 1, 10, 1), ("b", "09:30:00", 2, 5, 1), ("z", "09:30:00", 3, 1, 1)]
    second = [("a", "09:31:00", 4, 10, 1), ("a", "09:31:01", 5, 12, 1), ("b", "09:31:00", 6, 7, 1)]
    before = last_prices(ticks(spark, first))
    for hot_over in (0, 1, 10**9):
        got = price_changes(ticks(spark, second), hot_over=hot_over, before=before)
        assert found_changes(got) == [("a", "09:31:01", 12.0, 1), ("b", "09:31:00", 7.0, 1)]


def test_processing_date(spark):
    rows = [("a", "09:30:00", 1, 10, 1)]
    got = price_changes(ticks(spark, rows), day=F.lit("2030-01-02").cast("date")).first()
    assert got.order_date == date(2030, 1, 2)


def test_runs_do_not_depend_on_the_split(spark):
    rows = random_ticks(8, 3, 500, ["09:30:00", "10:30:00", "11:30:00"])
    table = ticks(spark, rows)
    whole = sorted(map(tuple, run_rows(accumulate(table)).collect()))
    for parts in (1, 7):
        split = table.repartition(parts).withColumn("part", F.spark_partition_id())
        pieces = accumulate(split, F.col("tran_id") % 5)
        assert sorted(map(tuple, run_rows(merge_runs(pieces)).collect())) == whole
    last = {}
    for code, time, tran, price, volume in sorted(rows, key=lambda r: (r[1], r[2])):
        count = last.get(code, (0, 0, 0, 0))
        last[code] = (time, price, count[2] + volume, count[3] + price * volume)
    assert {r[0]: (r[2], int(r[4]), r[5], int(r[6])) for r in whole} == last


def bars(spark, rows):
    return spark.createDataFrame(rows, BARS)


def test_carry(spark):
    rows = [
        (1, "a", DAY, 1.0, 2.0),
        (2, "a", DAY + timedelta(1), 5.0, 6.0),
        (3, "a", DAY + timedelta(2), 9.0, 9.0),
        (4, "b", DAY, None, None),
        (5, "b", DAY + timedelta(1), 3.0, 4.0),
        (6, None, DAY, 1.0, 2.0),
        (7, None, DAY + timedelta(1), None, 4.0),
    ]
    for hot_over in (0, 2, 10**9):
        got = carry_forward(bars(spark, rows), hot_over=hot_over).orderBy("id").collect()
        assert [(r.id, r.start, r.end) for r in got] == [
            (1, 1.0, 2.0),
            (2, 2.0, 6.0),
            (3, 6.0, 9.0),
            (4, 0.0, None),
            (5, 0.0, 4.0),
            (6, 1.0, 2.0),
            (7, None, 4.0),
        ]


def test_sliced_carry(spark):
    chance = random.Random(4)
    rows = [
        (i, chance.choice("aab"), DAY + timedelta(chance.randrange(9)), 1.0, float(i))
        for i in range(400)
    ]
    table = bars(spark, rows)
    plain = sorted(map(tuple, carry_forward(table, hot_over=10**9).collect()))
    assert sorted(map(tuple, carry_forward(table, hot_over=150).collect())) == plain
    last, wanted = {}, []
    for i, code, day, start, end in sorted(rows, key=lambda r: (r[2], r[0])):
        wanted.append((i, code, day, last.get(code, start), end))
        last[code] = end
    assert plain == sorted(wanted)


def test_bars_in_order(spark):
    rows = [(3, "b", DAY, 1.0, 1.0), (2, "a", DAY + timedelta(1), 1.0, 1.0), (1, "a", DAY, 1.0, 1.0)]
    assert [r.id for r in bars_in_order(bars(spark, rows)).collect()] == [1, 2, 3]
    assert [r.id for r in bars_in_order(bars(spark, rows), "a").collect()] == [1, 2]


def test_update_by_id(spark):
    table = bars(spark, [(1, "a", DAY, 1.0, 2.0), (2, "a", DAY, 5.0, 6.0)])
    updates = spark.createDataFrame([(2, 7.5)], "id bigint, start double")
    got = apply_starts(table, updates).orderBy("id").collect()
    assert [(r.id, r.start, r.end) for r in got] == [(1, 1.0, 2.0), (2, 7.5, 6.0)]
