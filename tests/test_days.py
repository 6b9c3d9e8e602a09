"""Up/down rows, feature rows, totals and bands on hand-made days."""

from datetime import date
from decimal import Decimal

import pytest
from frames import DAY, by_code, edges, levels, limits, listed, ticks
from pyspark.sql import functions as F

from tickwright.operators.bands import price_bands
from tickwright.operators.levels import first_ticks, last_ticks, open_close, price_levels
from tickwright.plans import day_features, day_features_of_ticks, updown_day, updown_day_of_ticks
from tickwright.plans.features import in_table_band_order
from tickwright.schemas import BANDS, FEATURES, STOCK_DAY, UPDOWN
from tickwright.sources import literal_keys


def test_levels_and_edges_from_ticks(spark):
    table = ticks(
        spark,
        [
            ("a", "09:30:01", 2, 10.00, 100),
            ("a", "09:30:00", 9, 10.50, 10),
            ("a", "09:30:00", 3, 11.00, 20),
            ("a", "15:00:00", 5, 10.00, 7),
            ("a", "15:00:00", 4, 12.00, 1),
            ("a", "09:00:00", None, 99.00, 1),
            ("b", "10:00:00", 1, None, 1),
            ("b", "11:00:00", 2, 5.00, 1),
        ],
    )
    found = {(r.order_code, r.price): (r.volume_sum, r["sum"]) for r in price_levels(table).collect()}
    assert found[("a", Decimal("10.00"))] == (107, Decimal("1070.00"))
    assert found[("a", Decimal("99.00"))] == (1, Decimal("99.00"))
    assert ("b", None) not in found
    prices = by_code(open_close(table))
    assert (prices["a"].open_price, prices["a"].close_price) == (Decimal("11.00"), Decimal("10.00"))
    assert prices["b"].open_price is None
    assert by_code(first_ticks(table))["a"].tran_id == 3
    assert by_code(last_ticks(table))["a"].tran_id == 5


@pytest.mark.parametrize("seed", range(3))
def test_edges_follow_time_as_text(spark, seed):
    """First and last ticks by (order_time, tran_id), for times of any length and form, and without one."""
    import random

    chance = random.Random(seed)
    times = ["", "9", "09", "09:30", "09:30:00", "09:30:00.", "09:30:00.1", "09:30:00.09", "09:30:00.123456789", "09:30:00+08:00", "2024-01-01T09:30:00.1234567890123Z", "9am", "é", ":", "093000", None]
    ids = [-(2**63), -5, 0, 7, 2**63 - 1]
    rows = [(f"c{c}", chance.choice(times), chance.choice(ids), p, 1) for c in range(40) for p in range(1, chance.randint(2, 6))]
    rows += [(f"c{c}", "0", None, 99, 1) for c in range(40)]
    table = ticks(spark, rows)
    first, last, prices = by_code(first_ticks(table)), by_code(last_ticks(table)), by_code(open_close(table))
    for code in first:
        order = sorted((r for r in rows if r[0] == code and r[2] is not None), key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[2], r[3]))
        assert (first[code].order_time, first[code].tran_id) == order[0][1:3]
        assert (last[code].order_time, last[code].tran_id) == order[-1][1:3]
        assert first[code].price == order[0][3] and last[code].price == order[-1][3]
        assert prices[code].open_price in {r[3] for r in order if r[1:3] == order[0][1:3]}


def test_day_rows_of_ticks_equal_those_of_levels(spark):
    """Days without transaction ids, with a first tick without price, and with ties, by either way."""
    rows = [
        ("a", "09:30:01", 2, 10.00, 100),
        ("a", "09:30:00", 9, 10.50, 10),
        ("a", "09:30:00", 3, 11.00, 20),
        ("a", "15:00:00", 5, 10.00, 7),
        ("b", "10:00:00", 1, None, 1),
        ("b", "11:00:00", 2, 5.00, 1),
        ("c", "11:00:00", None, 5.00, 1),
        ("c", "11:00:01", None, 6.00, 2),
        ("d", "11:00:00", 3, 5.00, 1),
        ("d", "12:00:00", 4, None, 1),
    ]
    table = ticks(spark, rows)
    stored, opening = price_levels(table), open_close(table)
    for default in (None, 0):
        for keys in (None, stored.select(*STOCK_DAY).where("order_code <> 'a'")):
            one = updown_day(stored, opening, keys, close_default=default).collect()
            other = updown_day_of_ticks(table, keys, close_default=default).collect()
            assert sorted(map(str, one)) == sorted(map(str, other)) and one
    bounds = limits(spark, [(f"{c}.SZ", 9, 11) for c in "abcd"] + [("a.SH", 10, 12)])
    named = stored.select(F.concat("order_code", F.lit(".SZ")).alias("ts_code"), F.col("order_date").alias("trade_date"), "price", "volume_sum", "sum")
    both = named.unionByName(named.where("ts_code = 'a.SZ'").withColumn("ts_code", F.lit("a.SH")))
    one, other = day_features(both, opening, bounds).collect(), day_features_of_ticks(table, bounds).collect()
    assert sorted(map(str, one)) == sorted(map(str, other)) and len(one) == 4


def test_updown_columns(spark):
    table = levels(spark, [("a", 9, 10), ("a", 10, 5), ("a", 11, 20)])
    rows = updown_day(table, edges(spark, [("a", 10, 11)]))
    assert rows.schema.names == UPDOWN.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in UPDOWN]
    row = rows.first().asDict()
    assert row == {
        "order_code": "a",
        "order_date": DAY,
        "start_price": Decimal("10.00"),
        "end_price": Decimal("11.00"),
        "next_price": None,
        "avg_price": Decimal("10.29"),
        "volume": 35,
        "all_volume": 0,
        "volume_proportion": None,
        "up_volume": 20,
        "up_sum": Decimal("220.00"),
        "down_volume": 10,
        "down_sum": Decimal("90.00"),
        "up_down": "up",
        "up_down_proportion": None,
        "up_price": Decimal("11.00"),
        "down_price": Decimal("9.00"),
        "price_tendency": Decimal("1.14"),
        "score": 0,
        "value1": None,
    }


def test_updown_edges(spark):
    table = levels(
        spark,
        [
            ("no_ticks", 5, 10),
            ("balance", 9, 20),
            ("balance", 12, 15),
            ("down", 9, 20),
            ("zero_volume", 9, 0),
            ("zero_price", 0, 5),
            ("zero_price", 3, 5),
            ("null_price", None, 5),
            ("null_price", 3, 5),
            ("null_amount", 3, 5, None),
            ("null_volume", 3, None),
            ("null_open", 3, 5),
        ],
    )
    table = table.withColumn("sum", F.when(F.col("order_code") != "null_amount", F.col("sum")))
    opening = edges(
        spark,
        [
            ("balance", 10, 10),
            ("down", 10, 10),
            ("zero_volume", 9, 9),
            ("zero_price", 1, 1),
            ("null_price", 1, 1),
            ("null_amount", 1, 1),
            ("null_volume", 1, 1),
            ("null_open", None, 4),
            ("no_levels", 1, 1),
        ],
    )
    found = by_code(updown_day(table, opening))
    assert set(found) == {"no_ticks", "balance", "down", "zero_volume", "null_volume"}
    assert found["no_ticks"].start_price == 0 and found["no_ticks"].end_price is None
    assert found["no_ticks"].up_volume == 10 and found["no_ticks"].up_down == "up"
    assert found["balance"].up_down == "balance"
    assert found["down"].up_down == "down" and found["down"].up_price == 0
    assert found["zero_volume"].avg_price == 0 and found["zero_volume"].up_down == "balance"
    assert found["null_volume"].volume == 0
    closed = by_code(updown_day(table, opening, close_default=0))
    assert closed["no_ticks"].end_price == 0


def test_work_list(spark):
    table = levels(spark, [("a", 9, 10), ("b", 9, 20)])
    keys = literal_keys(spark, [("a", DAY), ("a", DAY), ("no_levels", DAY), ("b", date(2020, 1, 1))])
    rows = updown_day(table, edges(spark, [("a", 9, 9)]), keys).collect()
    assert [(r.order_code, r.volume) for r in rows] == [("a", 10)]


def test_half_up_prices(spark):
    rows = updown_day(levels(spark, [("a", 1.00, 1), ("a", 1.01, 1)]), edges(spark, [("a", 1, 1)]))
    assert rows.first().avg_price == Decimal("1.01")


def test_bands(spark):
    table = levels(
        spark,
        [
            ("at_limits", 1, 10),
            ("at_limits", 11, 20),
            ("at_limits", 100.99, 1),
            ("at_limits", 101, 30),
            ("at_limits", 0.99, 19),
            ("at_limits", 101.01, 20),
            ("equal", 5, 10),
            ("none", 5, 10),
            ("third", 1, 1),
            ("third", 50, 2),
        ],
    )
    bounds = limits(
        spark, [("at_limits", 1, 101), ("equal", 5, 5), ("none", None, 101), ("third", 1, 101)]
    ).withColumnsRenamed({"ts_code": "order_code", "trade_date": "order_date"})
    found = by_code(price_bands(table.join(bounds, STOCK_DAY), STOCK_DAY))
    at = [found["at_limits"][b] for b in BANDS]
    assert at == [Decimal("0.1"), Decimal("0.2"), *[0] * 7, Decimal("0.31")]
    assert all(found[c][b] == 0 for c in ("equal", "none") for b in BANDS)
    assert found["third"]["volume_d5_bucket"] == Decimal("0.333333")
    assert found["third"]["volume_d1_bucket"] == Decimal("0.666667")


def test_feature_rows(spark):
    table = listed(
        levels(
            spark,
            [
                ("000159.SZ", 9, 10),
                ("000159.SZ", 10, 5),
                ("000159.SZ", 11, 20),
                ("idle.SZ", 9, 0),
                ("quiet.SZ", 5, 10),
                ("unlisted.SZ", 5, 10),
            ],
        )
    )
    opening = edges(spark, [("000159", 10, 11), ("idle", 9, 9)])
    bounds = limits(
        spark,
        [("000159.SZ", 9, 11), ("000159.SZ", 9, 11), ("idle.SZ", 1, 2), ("quiet.SZ", None, None)],
    )
    rows = day_features(table, opening, bounds)
    assert rows.schema.names == FEATURES.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in FEATURES]
    assert rows.count() == 2
    found = by_code(rows, "ticket_code")
    row = found["000159.SZ"]
    assert row.ticket_dc == "000159.SZ_2024-11-18"
    assert (row.price_start, row.price_end) == (Decimal("10.00"), Decimal("11.00"))
    assert (row.price_mean, row.price_mean_up, row.price_mean_down) == (
        Decimal("10.29"),
        Decimal("11.00"),
        Decimal("9.00"),
    )
    assert (row.price_min, row.price_max, row.price_range) == (9, 11, 2)
    assert (row.volume_total, row.volume_up, row.volume_down) == (35, 20, 10)
    assert row.price_open30_mean == row.price_median == row.volume_open30min == 0
    assert row.volume_d5_bucket == Decimal("0.285714")
    assert row.volume_u1_bucket == Decimal("0.142857")
    assert row.volume_u5_bucket == Decimal("0.571429")
    quiet = found["quiet.SZ"]
    assert quiet.price_start == 0 and quiet.price_end is None
    assert quiet.volume_up == 10 and all(quiet[b] == 0 for b in BANDS)
    moved = by_code(in_table_band_order(rows), "ticket_code")["000159.SZ"]
    assert moved.volume_u1_bucket == row.volume_d5_bucket
    assert moved.volume_d1_bucket == row.volume_u1_bucket
    assert moved.volume_d5_bucket == row.volume_u5_bucket
    assert moved.volume_u5_bucket == row.volume_d1_bucket


def test_sides_add_up(spark, sf_dir):
    """Up, down and at-open volume make the day; band shares make at most one."""
    from tickwright.checks.queries import features, updown
    from tickwright.sources.events import event_ticks

    ticks_table = event_ticks(spark, sf_dir)
    at_open = (
        price_levels(ticks_table)
        .join(open_close(ticks_table), STOCK_DAY)
        .where("price = open_price")
        .groupBy(*STOCK_DAY)
        .agg(F.sum("volume_sum").alias("at_open"))
    )
    wrong = (
        updown(spark, sf_dir)
        .join(at_open, STOCK_DAY, "left")
        .where("up_volume + down_volume + coalesce(at_open, 0) <> volume")
    )
    assert wrong.count() == 0
    shares = features(spark, sf_dir).select(sum(F.col(b) for b in BANDS).alias("share"))
    assert shares.where("share > 1.00001").count() == 0
