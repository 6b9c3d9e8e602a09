"""Price-change events: the ticks whose price differs from the tick before."""

from pyspark.sql import Column, DataFrame, functions as F

from tickwright.functions import amount
from tickwright.operators.keys import with_transaction
from tickwright.operators.levels import TICK_ORDER, place
from tickwright.operators.previous import HOT_ROWS, with_previous
from tickwright.schemas import PRICE_CHANGES, STOCK_DAY

USED = [*STOCK_DAY, *TICK_ORDER, "order_dc", "price", "volume"]


def price_changes(
    ticks: DataFrame,
    *,
    hot_over: int = HOT_ROWS,
    before: DataFrame | None = None,
    day: Column | None = None,
) -> DataFrame:
    """Change rows: each kept tick with its own volume and amount.

    ``before`` gives a last price per stock-day from earlier data. ``day`` replaces the stock-day's
    date in the output, for instance ``F.current_date()`` to stamp the processing date.
    """
    usable = with_transaction(ticks).dropna(subset=[*STOCK_DAY, "order_time", "price"])
    seen = with_previous(usable.select(*USED), STOCK_DAY, TICK_ORDER, "price", hot_over, before)
    changed = F.col("previous").isNull() | (F.col("previous") != F.col("price"))
    rows = seen.where(changed).withColumn("sum", amount(F.col("price"), F.col("volume")))
    if day is not None:
        rows = rows.withColumn("order_date", day)
    return rows.select(*PRICE_CHANGES.names)


def last_prices(ticks: DataFrame) -> DataFrame:
    """The last price of each stock-day."""
    usable = with_transaction(ticks).where(F.col("price").isNotNull())
    return usable.groupBy(*STOCK_DAY).agg(F.max_by("price", place()).alias("price"))
