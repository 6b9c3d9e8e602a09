"""Price levels of a stock-day, and its first and last price and ticks."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickwright.functions import amount
from tickwright.operators.keys import with_transaction
from tickwright.schemas import AMOUNT, STOCK_DAY

# Ties in time are settled by the transaction id.
TICK_ORDER = ["order_time", "tran_id"]



def place() -> Column:
    """A tick's place in its day: (order_time, tran_id), null without a transaction id.

    Times are compared as text of any length and form; a missing one comes before all.
    """
    return F.when(F.col("tran_id").isNotNull(), F.struct(*TICK_ORDER))


def _level_sums() -> list[Column]:
    return [
        F.sum("volume").alias("volume_sum"),
        F.sum(amount(F.col("price"), F.col("volume"))).cast(AMOUNT).alias("sum"),
    ]


def price_levels(ticks: DataFrame) -> DataFrame:
    """Volume and amount per stock-day and price.

    Summed before the shuffle, and spread by price, so a stock that holds much of the data is
    neither sent whole nor gathered in one task.
    """
    priced = ticks.where(F.col("price").isNotNull())
    return priced.groupBy(*STOCK_DAY, "price").agg(*_level_sums())


def opened_levels(ticks: DataFrame, close_default=None) -> DataFrame:
    """Price levels with their day's ``start_price`` and ``end_price``, from one pass over the ticks.

    Each level keeps the places of its first and last tick, and the day's are found among its levels, ticks
    without a price included. A day without ticks that have a transaction id opens at 0 and closes at
    ``close_default``; one whose first tick has no price is left out.
    """
    levels = ticks.groupBy(*STOCK_DAY, "price").agg(
        *_level_sums(), F.min(place()).alias("first"), F.max(place()).alias("last")
    )
    day = Window.partitionBy(*STOCK_DAY)
    edges = levels.withColumns(
        {
            "has_ticks": F.min("first").over(day).isNotNull(),
            "open_price": F.min_by("price", "first").over(day),
            "close_price": F.max_by("price", "last").over(day),
        }
    )
    start = F.when(F.col("has_ticks"), F.col("open_price")).otherwise(F.lit(0)).cast("decimal(10,2)")
    end = F.when(F.col("has_ticks"), F.col("close_price")).otherwise(F.lit(close_default))
    opened = edges.where(F.col("price").isNotNull()).select(
        *STOCK_DAY,
        "price",
        "volume_sum",
        "sum",
        start.alias("start_price"),
        end.cast("decimal(10,2)").alias("end_price"),
    )
    return opened.where(F.col("start_price").isNotNull())


def open_close(ticks: DataFrame) -> DataFrame:
    """First and last price of each stock-day: one row per task and day goes over the network."""
    return with_transaction(ticks).groupBy(*STOCK_DAY).agg(
        F.min_by("price", place()).alias("open_price"), F.max_by("price", place()).alias("close_price")
    )


def first_ticks(ticks: DataFrame) -> DataFrame:
    """The whole first tick of each stock-day."""
    return ticks_at(ticks, STOCK_DAY, F.min)


def last_ticks(ticks: DataFrame) -> DataFrame:
    """The whole last tick of each stock-day."""
    return ticks_at(ticks, STOCK_DAY, F.max)


def ticks_at(ticks: DataFrame, keys: list[str], edge, *sums: Column) -> DataFrame:
    """The tick at the ``edge`` (``F.min`` or ``F.max``) of its key, with sums over the key if given.

    The whole tick is carried in the aggregate's value, so one pass finds it and one row per task and key goes
    over the network. Of ticks at one place the smallest is the first and the largest the last.
    """
    rest = [c for c in ticks.columns if c not in [*keys, *TICK_ORDER]]
    tick = edge(F.struct(*TICK_ORDER, *rest)).alias("tick")
    found = with_transaction(ticks).groupBy(*keys).agg(tick, *sums)
    extra = [c for c in found.columns if c not in [*keys, "tick"]]
    return found.select(*keys, *[F.col(f"tick.{c}").alias(c) for c in ticks.columns if c not in keys], *extra)
