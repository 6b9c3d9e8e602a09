"""Giving price levels the opening and closing price of their day."""

from pyspark.sql import DataFrame, functions as F


def with_open_close(days: DataFrame, edges: DataFrame, keys: list[str], close_default=None) -> DataFrame:
    """``start_price`` and ``end_price`` for each row of ``days`` by its keys.

    A day without ticks opens at 0 and closes at ``close_default``. A day whose first tick has no
    price cannot be told apart into up and down, so it is left out.
    """
    marked = edges.withColumn("has_ticks", F.lit(True))
    joined = days.join(marked, keys, "left")
    close = F.when(F.col("has_ticks"), F.col("close_price")).otherwise(F.lit(close_default))
    return (
        joined.withColumns(
            {
                "start_price": F.when(F.col("has_ticks"), F.col("open_price"))
                .otherwise(F.lit(0))
                .cast("decimal(10,2)"),
                "end_price": close.cast("decimal(10,2)"),
            }
        )
        .where(F.col("start_price").isNotNull())
        .drop("has_ticks", "open_price", "close_price")
    )
