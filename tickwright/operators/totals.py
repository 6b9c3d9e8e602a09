"""Totals, average prices and price extremes of a stock-day, from its price levels."""

from pyspark.sql import Column, DataFrame, functions as F

from tickwright.functions import cents, half_up_ratio


def total_sums() -> list[Column]:
    """Aggregates over levels that carry ``start_price``. A price equal to it counts as neither side."""
    volume = "coalesce(volume_sum, 0)"
    texts = {
        "volume": f"sum({volume})",
        "amount": "CAST(sum(sum) AS DECIMAL(28,2))",
        "up_volume": f"sum(CASE WHEN price > start_price THEN {volume} ELSE 0 END)",
        "up_sum": "CAST(sum(CASE WHEN price > start_price THEN sum ELSE 0 END) AS DECIMAL(28,2))",
        "down_volume": f"sum(CASE WHEN price < start_price THEN {volume} ELSE 0 END)",
        "down_sum": "CAST(sum(CASE WHEN price < start_price THEN sum ELSE 0 END) AS DECIMAL(28,2))",
        "price_min": "min(price)",
        "price_max": "max(price)",
        "damaged": "bool_or(price IS NULL OR sum IS NULL)",
    }
    return [F.expr(text).alias(name) for name, text in texts.items()]


def average_price(money: str, volume: str) -> Column:
    """Money per share with two decimals, half up; 0 where nothing was traded."""
    return half_up_ratio(cents(money, "DECIMAL(38,0)"), f"CAST({volume} AS DECIMAL(20,0)) * 100", 2)


def with_averages(totals: DataFrame) -> DataFrame:
    """Add the volume-weighted average price of the day and of its two sides, and the price range."""
    return totals.withColumns(
        {
            "avg_price": average_price("amount", "volume"),
            "up_price": average_price("up_sum", "up_volume"),
            "down_price": average_price("down_sum", "down_volume"),
            "price_range": (F.col("price_max") - F.col("price_min")).cast("decimal(10,2)"),
        }
    )


def day_totals(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Totals and averages per key, from levels that carry ``start_price``."""
    sums = levels.groupBy(*keys).agg(*total_sums()).where(~F.col("damaged"))
    return with_averages(sums.drop("damaged"))
