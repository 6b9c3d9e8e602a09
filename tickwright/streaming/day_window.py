"""Day totals of a tick stream in event-time windows of one day.

Windows of a day begin at midnight UTC, so the session time zone must be UTC, as ``build_session`` sets.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tickwright.operators.keys import with_transaction
from tickwright.operators.runs import run_aggregates, run_rows
from tickwright.schemas import PRICE_CHANGES, STOCK_DAY
from tickwright.streaming.drain import drain


def with_event_time(ticks: DataFrame) -> DataFrame:
    """Ticks with their event time ``ts``, from day and clock time; null where those make no time."""
    stamp = F.concat_ws(" ", F.date_format("order_date", "yyyy-MM-dd"), "order_time")
    return ticks.withColumn("ts", F.try_to_timestamp(stamp))


def day_window(ticks: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Run rows per code and day. Ticks later than ``lateness`` behind the latest go, and those without a time.

    The event time is ``ts``, or where ticks have none, it is made of day and clock time.

    In append mode a day is given once, when the watermark has passed its end; in update mode it is
    given again whenever it changes.
    """
    if "ts" not in ticks.columns:
        ticks = with_event_time(ticks)
    usable = with_transaction(ticks).where(F.col("price").isNotNull() & F.col("ts").isNotNull())
    runs = (
        usable.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 day"), *STOCK_DAY)
        .agg(*run_aggregates())
    )
    return run_rows(runs)


def stream_day_window(
    ticks: DataFrame,
    output: str,
    work_dir: str,
    *,
    lateness: str = "10 minutes",
    mode: str = "update",
    every: str | None = None,
) -> StreamingQuery:
    """Write the day rows of each micro-batch to ``output/batch=<number>``."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    return drain(
        day_window(ticks, lateness), write, f"{work_dir}/checkpoint", mode=mode, every=every
    )


def latest_rows(written: DataFrame) -> DataFrame:
    """The latest version of each day row that update mode has written."""
    names = PRICE_CHANGES.names
    newest = written.groupBy("order_code", "order_date").agg(
        F.max_by(F.struct(*names[2:]), "batch").alias("row")
    )
    return newest.select("order_code", "order_date", "row.*")
