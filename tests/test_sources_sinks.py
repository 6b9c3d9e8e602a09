"""Decoding, scans, key filters, files and option builders."""

import glob
from datetime import date
from decimal import Decimal
from types import SimpleNamespace

import pytest
from frames import DAY, edges, levels, limits, listed, ticks
from statistics_by_hand import kurtosis, skewness

from tickwright.operators.keys import distinct_codes, of_days, of_stock_day, of_work_list
from tickwright.plans import day_features
from tickwright.schemas import FEATURES, STOCK_DAY, TICKS, WORK_LIST_LIMITS
from tickwright.session import shared_dir
from tickwright.sinks import (
    append_rows,
    jdbc_write_options,
    print_rows,
    write_change_lines,
    write_feature_csv,
    write_new_version,
)
from tickwright.sources import (
    decode_json,
    decode_positional,
    jdbc_options,
    literal_keys,
    read_table,
    split_rejected,
    ticks_of_day_by_sql,
    work_list,
    work_list_limits,
)

GOOD = "a 2024-11-18 7 09:30:00 B 10.5 100 1 2 T 3 10.4 4 10.6".split()


def untyped(spark, *rows):
    return spark.createDataFrame([(list(r),) for r in rows], "fields array<string>")


def test_positional(spark):
    no_kind = [*GOOD[:9], None, *GOOD[10:]]
    no_price = [*GOOD[:5], None, *GOOD[6:]]
    bad_number = [*GOOD[:6], "many", *GOOD[7:]]
    short = GOOD[:4]
    decoded = decode_positional(untyped(spark, GOOD, no_kind, no_price, bad_number, short))
    assert [(f.name, f.dataType) for f in decoded.schema] == [(f.name, f.dataType) for f in TICKS]
    accepted, rejected = split_rejected(decoded)
    assert accepted.count() == 2 and rejected.count() == 3
    first = accepted.where("type = 'T'").first()
    assert first.order_date == DAY and first.tran_id == 7 and first.price == Decimal("10.50")
    assert first.buy_order_price == Decimal("10.60") and first.sale_order_id == 3


def test_strict(spark):
    decoded = decode_positional(untyped(spark, GOOD, GOOD[:4]))
    accepted, _ = split_rejected(decoded, strict=True)
    with pytest.raises(Exception, match="without a required field"):
        accepted.collect()
    fine, _ = split_rejected(decode_positional(untyped(spark, GOOD)), strict=True)
    assert fine.count() == 1


def test_json(spark):
    text = (
        '{"orderCode":"a","orderDate":"20241118","tranId":7,"orderTime":"09:30:00","orderDc":"B",'
        '"price":10.5,"volume":100,"saleVolume":1,"buyVolume":2,"type":null,"saleOrderId":3,'
        '"saleOrderPrice":10.4,"buyOrderId":4,"buyOrderPrice":10.6}'
    )
    rows = spark.createDataFrame([(bytearray(text.encode()),), (bytearray(b"{oops"),)], "value binary")
    accepted, rejected = split_rejected(decode_json(rows))
    row = accepted.first()
    bare = spark.createDataFrame(
        [('{"orderCode":"a","orderDate":"20241118","orderTime":"9","orderDc":"B","price":1}',)],
        "value string",
    )
    assert split_rejected(decode_json(bare))[0].first().volume == 0
    assert (row.order_code, row.order_date, row.price) == ("a", DAY, Decimal("10.50"))
    assert row.type is None and row.buy_order_price == Decimal("10.60")
    assert rejected.count() == 1


def test_scans_and_keys(spark):
    other = date(2024, 11, 19)
    table = ticks(
        spark,
        [
            ("a", "10:00:00", 2, 1, 1),
            ("a", "09:00:00", 1, 1, 1),
            ("a", "09:00:00", 3, 1, 1, other),
            ("b", "09:00:00", 4, 1, 1),
        ],
    )
    assert [r.tran_id for r in ticks_of_day_by_sql(table, "a", DAY).collect()] == [1, 2]
    assert of_stock_day(table, "a", other).count() == 1
    assert of_days(table, [DAY]).count() == 3 and of_days(table, [DAY, other], "a").count() == 3
    assert work_list(table).count() == 3 and work_list(table, [other]).count() == 1
    keys = literal_keys(spark, [("a", DAY), ("a", DAY), ("c", DAY)])
    assert of_work_list(table, keys).count() == 2
    assert distinct_codes(listed(table)).count() == 2
    path = shared_dir(spark, "scan")
    append_rows(table, path, by_day="order_date")
    append_rows(table, path, by_day="order_date")
    assert read_table(spark, path, where="order_date = '2024-11-19'").count() == 2
    assert sorted(read_table(spark, path, schema=TICKS).columns) == sorted(TICKS.names)


def test_limit_list(spark):
    rows = [("a.SZ", "20241118", 1, 2), ("b.SZ", "2024-11-18", None, 2), ("c.SZ", "2024-13-01", 1, 2)]
    rows = [(c, d, None if u is None else Decimal(u), Decimal(w)) for c, d, u, w in rows]
    found = {r.ts_code: r for r in work_list_limits(spark.createDataFrame(rows, WORK_LIST_LIMITS)).collect()}
    assert found["a.SZ"].trade_date == found["b.SZ"].trade_date == DAY
    assert found["b.SZ"].up_limit is None and found["c.SZ"].trade_date is None


def lines_of(path):
    return sorted(line for f in glob.glob(f"{path}/part-*") for line in open(f).read().splitlines())


def test_change_lines(spark):
    changes = spark.sql(
        "SELECT 'a' order_code, DATE'2024-11-18' order_date, '09:30:00' order_time, "
        "CAST(NULL AS STRING) order_dc, 10.50BD price, 3L volume, 31.50BD sum"
    )
    path = shared_dir(spark, "lines")
    write_change_lines(changes, path)
    write_change_lines(changes, path)
    assert lines_of(path) == ["a\t2024-11-18\t09:30:00\tnull\t10.50\t3\t31.50"] * 2


def test_feature_csv(spark):
    table = listed(levels(spark, [('a,"b.SZ', 9, 10), ('a,"b.SZ', 11, 20)]))
    rows = day_features(table, edges(spark, []), limits(spark, [('a,"b.SZ', 9, 11)]))
    path = shared_dir(spark, "csv")
    write_feature_csv(rows, path)
    header, line = sorted(lines_of(path), reverse=True)
    assert header == ",".join(FEATURES.names)
    book = [(Decimal(9), 10), (Decimal(11), 20)]
    assert (f"{skewness(book):.2f}", f"{kurtosis(book):.2f}") == ("-0.02", "-1.60")
    assert line == (
        'a"b.SZ,2024-11-18,a"b.SZ_2024-11-18,0.00,0.00,10.33,10.33,0.00,0.00,0.00,0.94,11.00,9.00,'
        "2.00,-0.02,-1.60,30,30,0,0,0.00,0.00,0.00,0.00,0.67,0.00,0.00,0.00,0.00,0.33"
    )


def test_new_version(spark):
    path = shared_dir(spark, "version")
    write_new_version(levels(spark, [("a", 1, 1)]), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_new_version(levels(spark, [("a", 1, 1)]), path)
    assert read_table(spark, path).count() == 1


def test_print(spark, capfd):
    print_rows(levels(spark, [("printed", 1, 1)]))
    assert "printed" in capfd.readouterr().out


def test_shared_dir_follows_the_session():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: settings.get(k, d)))

    there = session(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_dir(there, "x").startswith("hdfs:///shared/x-")
    alone = session(**{"spark.master": "local[2]"})
    assert "/tickwright-" in shared_dir(alone, "x")
    for cluster in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(session(**{"spark.master": cluster}), "x")


def test_jdbc_options():
    """No database is at hand: the options are checked, not a connection."""
    assert jdbc_options("jdbc:x", table="t", user="u", password="p", whole=True) == {
        "url": "jdbc:x",
        "dbtable": "t",
        "user": "u",
        "password": "p",
        "fetchsize": "10000",
        "queryTimeout": "0",
    }
    split = jdbc_options(
        "jdbc:x",
        query="SELECT 1",
        partition_column="order_date",
        lower="2024-01-01",
        upper="2024-12-31",
        partitions=64,
    )
    assert split["dbtable"] == "(SELECT 1) split_source" and "query" not in split
    assert split["numPartitions"] == "64" and split["lowerBound"] == "2024-01-01"
    whole_and_split = dict(table="t", partition_column="d", lower=1, upper=9, partitions=2, whole=True)
    for wrong in ({}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "d"}, {"table": "t"}, whole_and_split):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:x", **wrong)
    assert jdbc_write_options("jdbc:x", "t", connections=30) == {
        "url": "jdbc:x",
        "dbtable": "t",
        "batchsize": "4000",
        "numPartitions": "30",
    }
