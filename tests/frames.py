"""Small hand-made tables."""

from datetime import date
from decimal import Decimal

from tickwright.schemas import PRICE_LEVELS, STOCK_DAY, TICKS

DAY = date(2024, 11, 18)


def money(text) -> Decimal | None:
    return None if text is None else Decimal(str(text)).quantize(Decimal("0.01"))


def ticks(spark, rows):
    """Rows of (code, time, id, price, volume), all on one day unless a sixth value gives the day."""
    full = []
    for code, time, tran, price, volume, *day in rows:
        day = day[0] if day else DAY
        full.append((code, day, tran, time, "B", money(price), volume, 0, 0, None, 0, None, 0, None))
    return spark.createDataFrame(full, TICKS)


def levels(spark, rows):
    """Rows of (code, price, volume); the amount is price times volume."""
    full = []
    for code, price, volume, *amount in rows:
        price = money(price)
        if amount:
            total = money(amount[0])
        else:
            total = money((price or 0) * (volume or 0))
        full.append((code, DAY, price, volume, total))
    return spark.createDataFrame(full, PRICE_LEVELS)


def edges(spark, rows):
    """Rows of (code, open, close)."""
    schema = "order_code string, order_date date, open_price decimal(10,2), close_price decimal(10,2)"
    return spark.createDataFrame([(c, DAY, money(o), money(e)) for c, o, e in rows], schema)


def listed(df):
    return df.withColumnsRenamed({"order_code": "ts_code", "order_date": "trade_date"})


def limits(spark, rows):
    """Rows of (ts_code, down, up)."""
    schema = "ts_code string, trade_date date, down_limit decimal(10,2), up_limit decimal(10,2)"
    return spark.createDataFrame([(c, DAY, money(d), money(u)) for c, d, u in rows], schema)


def by_code(df, column="order_code") -> dict:
    return {row[column]: row for row in df.collect()}


__all__ = ["DAY", "STOCK_DAY", "by_code", "edges", "levels", "limits", "listed", "money", "ticks"]
