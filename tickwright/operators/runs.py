"""Running day totals that can be merged: last values, volume and amount so far."""

from pyspark.sql import Column, DataFrame, functions as F

from tickwright.functions import amount
from tickwright.operators.keys import with_transaction
from tickwright.operators.levels import TICK_ORDER
from tickwright.schemas import AMOUNT, PRICE_CHANGES, STOCK_DAY

# In this order the largest is the latest tick's.
_LAST = [*TICK_ORDER, "order_dc", "price"]


def _sums() -> list[Column]:
    return [
        F.sum("volume").alias("volume"),
        F.sum(amount(F.col("price"), F.col("volume"))).cast(AMOUNT).alias("sum"),
    ]


def run_aggregates() -> list[Column]:
    """Aggregates of one run of a stream. All last values are those of the same, latest tick."""
    return [F.max(F.struct(*_LAST)).alias("last"), *_sums()]


def accumulate(ticks: DataFrame, *also_by: Column) -> DataFrame:
    """Mergeable run rows per stock-day, or per smaller part of it when more keys are given: one pass."""
    usable = with_transaction(ticks).where(F.col("price").isNotNull())
    return usable.groupBy(*STOCK_DAY, *also_by).agg(*run_aggregates())


def merge_runs(parts: DataFrame) -> DataFrame:
    """Run rows of the same stock-day to one."""
    return parts.groupBy(*STOCK_DAY).agg(
        F.max("last").alias("last"),
        F.sum("volume").alias("volume"),
        F.sum("sum").cast(AMOUNT).alias("sum"),
    )


def run_rows(runs: DataFrame) -> DataFrame:
    """Run rows in the layout of the change rows."""
    flat = runs.select(*STOCK_DAY, "last.*", "volume", "sum")
    return flat.select(*PRICE_CHANGES.names)
