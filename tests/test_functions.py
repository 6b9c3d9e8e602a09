import random
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F
from statistics_by_hand import settled

from tickwright.functions import (
    clean_text,
    day_key,
    half_up_ratio,
    parse_day,
    plain_long,
    plain_price,
    plain_statistic,
    root_steps,
    tab_line,
    whole_quotient,
    without_suffix,
)


@pytest.mark.parametrize("scale", [0, 2, 6, 10])
def test_half_up_ratio_is_exact(spark, scale):
    chance = random.Random(scale)
    rows = [(chance.randint(-(10**6), 10**6), chance.randint(1, 400)) for _ in range(500)]
    rows += [(0, 7), (5, 0), (1, 2), (-1, 2), (1, 8), (3, 8), (10**8, 3)]
    df = spark.createDataFrame(rows, "num bigint, den bigint")
    for row in df.withColumn("q", half_up_ratio("num", "den", scale, 30)).collect():
        exact = Decimal(0)
        if row.den:
            step = Decimal(1).scaleb(-scale)
            exact = (Decimal(row.num) / row.den).quantize(step, ROUND_HALF_UP)
        assert row.q == exact


def test_root_is_exact(spark):
    chance = random.Random(3)
    steps = [chance.randint(1, 10 ** chance.randint(4, 26)) for _ in range(2000)]
    steps += [k * k // 10**8 + d for k in (10**9 + 7, 10**12 + 9) for d in (-1, 0, 1)] + [1, 0, -5]
    df = spark.createDataFrame([(Decimal(v),) for v in steps], "v decimal(38,0)")
    for step in root_steps("root", "v", 8):
        df = df.selectExpr("*", *[f"CAST({text} AS DECIMAL(38,0)) AS {name}" for name, text in step.items()])
    for row in df.collect():
        assert Decimal(row.root).scaleb(-8) == settled(row.v.scaleb(-8), 8)


def test_whole_quotient(spark):
    rows = [(7, 2), (-7, 2), (6, 3), (-6, 3), (10**31, 7), (-(10**37), 10**12), (0, 5)]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in rows], "a decimal(38,0), b decimal(38,0)")
    found = [int(r[0]) for r in df.selectExpr(whole_quotient("a", "b")).collect()]
    assert found == [a // b for a, b in rows]


def test_parse_day(spark):
    rows = [("20241118",), ("2024-11-18",), ("2024-13-01",), ("x",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    plain = [r[0] for r in df.select(parse_day(F.col("t"))).collect()]
    assert plain == [date(2024, 11, 18), date(2024, 11, 18), None, None, None]
    fallback = F.lit(date(2000, 1, 1))
    filled = [r[0] for r in df.select(parse_day(F.col("t"), fallback)).collect()]
    assert filled[2:] == [date(2000, 1, 1)] * 3


def test_texts(spark):
    row = spark.sql(
        "SELECT 'a,b' c, CAST(NULL AS STRING) n, '000159.SZ' ts, DATE'2024-11-18' d, "
        "CAST(NULL AS DECIMAL(10,2)) p, 1234.565BD q, 0.123456785D s, -0.001D m, CAST(NULL AS BIGINT) l"
    ).select(
        clean_text(F.col("c")).alias("comma"),
        clean_text(F.col("n")).alias("empty"),
        without_suffix(F.col("ts")).alias("code"),
        day_key(F.col("ts"), F.col("d")).alias("key"),
        plain_price(F.col("p")).alias("no_price"),
        plain_price(F.col("q")).alias("price"),
        plain_statistic(F.col("s")).alias("stat"),
        plain_statistic(F.col("m")).alias("minus"),
        plain_long(F.col("l")).alias("no_long"),
        tab_line(F.col("c"), F.col("n"), F.col("q")).alias("line"),
    )
    assert row.first().asDict() == {
        "comma": "ab",
        "empty": "",
        "code": "000159",
        "key": "000159.SZ_2024-11-18",
        "no_price": "0.00",
        "price": "1234.57",
        "stat": "0.12",
        "minus": "-0.00",
        "no_long": "0",
        "line": "a,b\tnull\t1234.565",
    }
