"""Price changes of a tick stream, with the last price per stock-day kept between batches."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructType

from tickwright.operators.changes import USED, price_changes
from tickwright.operators.keys import with_transaction
from tickwright.operators.levels import TICK_ORDER, place
from tickwright.operators.previous import HOT_ROWS
from tickwright.schemas import PRICE, STOCK_DAY
from tickwright.streaming.drain import drain

#: Price, time and id are those of the day's last tick; ``batch`` is which batch wrote the day, ``slot`` one of
#: two folders that a day's versions use in turn.
STATE = (
    StructType()
    .add("order_code", StringType())
    .add("price", PRICE)
    .add("order_time", StringType())
    .add("tran_id", LongType())
    .add("batch", LongType())
    .add("slot", IntegerType())
    .add("order_date", DateType())
)


def known_days(spark: SparkSession, path: str, schema: StructType, days: list, number: int) -> DataFrame:
    """What ``path`` holds of the given days as it was before batch ``number``; other days' files aren't read."""
    if number == 0 or not days:
        return spark.createDataFrame([], schema)
    written = spark.read.schema(schema).parquet(path)
    older = written.where(F.col("order_date").isin(days) & (F.col("batch") < number))
    newest = F.max("batch").over(Window.partitionBy("order_date"))
    return older.withColumn("newest", newest).where("batch = newest").drop("newest")


def write_days(version: DataFrame, known: DataFrame, path: str, schema: StructType, number: int) -> None:
    """A version of all days in ``version``, each into the one of its two folders that ``known`` was not read from."""
    slots = known.select("order_date", "slot").distinct()
    rows = version.join(slots, "order_date", "left").withColumns(
        {"batch": F.lit(number).cast("long"), "slot": F.coalesce(1 - F.col("slot"), F.lit(0))}
    )
    writer = rows.select(*schema.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("slot", "order_date").parquet(path)


def written_once(batch: DataFrame, folder: str, number: int) -> DataFrame:
    """The batch's rows from a file of its own, so that its source is read and worked out once.

    Two folders are used in turn; what a batch before the last one has written is replaced.
    """
    path = f"{folder}/slot={number % 2}"
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def stream_price_changes(
    ticks: DataFrame,
    output: str,
    work_dir: str,
    *,
    hot_over: int = HOT_ROWS,
    every: str | None = None,
) -> StreamingQuery:
    """Write the change rows of each micro-batch to ``output/batch=<number>``.

    A keyed state function would need all ticks of a stock-day in a batch gathered and sorted in one
    Python task. Here each batch runs as the batch operator does, cut into slices where a stock-day is
    large, and only the last price of each stock-day passes from batch to batch, in a folder for each day. A
    batch reads and writes the folders of its own days only. Each day has two of them, used in turn: a
    repeated batch reads what stood before it and replaces only its own, so the result is the same after a
    failure.

    A tick that does not come after the last one known of its stock-day is late: it is not taken into the
    changes but written to ``work_dir/late/batch=<number>``. What is late is told by batches, not within one.
    """
    state = f"{work_dir}/last_price"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        ticks = with_transaction(batch.select(*USED)).dropna(subset=[*STOCK_DAY, "order_time", "price"])
        usable = written_once(ticks, f"{work_dir}/ticks", number)
        days = [r.order_date for r in usable.select("order_date").distinct().collect()]
        known = known_days(spark, state, STATE, days, number)
        kept = known.select(*STOCK_DAY, F.struct(*TICK_ORDER).alias("kept"))
        late = F.coalesce(F.struct(*TICK_ORDER) <= F.col("kept"), F.lit(False))
        placed = usable.join(kept, STOCK_DAY, "left").withColumn("late", late)
        placed.where("late").select(*USED).write.mode("overwrite").parquet(f"{work_dir}/late/batch={number}")
        fresh = placed.where("NOT late").select(*USED)
        last = fresh.groupBy(*STOCK_DAY).agg(F.max_by(F.struct("price", *TICK_ORDER), place()).alias("last"))
        latest = last.select(*STOCK_DAY, "last.*")
        before = known.select(*STOCK_DAY, "price").join(latest, STOCK_DAY, "left_semi")
        changes = price_changes(fresh, hot_over=hot_over, before=before)
        changes.write.mode("overwrite").parquet(f"{output}/batch={number}")
        rest = known.select(*latest.columns).join(latest, STOCK_DAY, "left_anti")
        write_days(latest.unionByName(rest), known, state, STATE, number)

    return drain(ticks, write, f"{work_dir}/checkpoint", every=every)
