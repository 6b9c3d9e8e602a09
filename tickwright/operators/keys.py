"""Restricting ticks and price levels to a work list."""

from pyspark.sql import Column, DataFrame, functions as F

from tickwright.schemas import STOCK_DAY


def with_transaction(ticks: DataFrame) -> DataFrame:
    """Ticks that carry a transaction id."""
    return ticks.where(F.col("tran_id").isNotNull())


def of_stock_day(df: DataFrame, code: str, day) -> DataFrame:
    """Rows of one stock on one day."""
    return df.where((F.col("order_code") == code) & (F.col("order_date") == F.lit(day).cast("date")))


def of_days(df: DataFrame, days: list, code: str | None = None) -> DataFrame:
    """Rows of the given days, for one stock or all."""
    wanted: Column = F.col("order_date").isin([F.lit(str(d)).cast("date") for d in days])
    if code is not None:
        wanted = wanted & (F.col("order_code") == code)
    return df.where(wanted)


def of_work_list(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose stock-day is on the work list, each once however often the list names it.

    The list is left to Spark to broadcast or shuffle by its measured size. Filtering it by day
    prunes day partitions of the other side.
    """
    return df.join(keys, STOCK_DAY, "left_semi")


def distinct_codes(df: DataFrame, column: str = "ts_code") -> DataFrame:
    """Every code once."""
    return df.select(column).distinct()
