"""Tables laid out by stock-day: rows that meet by stock-day lie in files of the same number, so no join moves them.

A table has a folder for each day and in it a file for each bucket of stock-days, in order. Tables with the same
number of buckets are joined and summed by stock-day bucket by bucket, without an exchange or a sort of the stored
rows. Work is spread over buckets: a task reads one bucket's files of all days that are asked for.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickwright.plans.updown import updown_day
from tickwright.schemas import STOCK_DAY

BUCKETS = 200
#: The folder column, which repeats ``order_date``.
DAY = "in_day"


def store_by_day(df: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Write a table of the catalog with its files under ``path``; rows are dealt out once, a bucket to a task.

    ``df`` has the columns of a stock-day. A null code or day is stored and meets nothing.
    """
    dealt = df.withColumn(DAY, F.col("order_date")).repartition(buckets, *STOCK_DAY)
    laid = dealt.write.partitionBy(DAY).bucketBy(buckets, *STOCK_DAY).sortBy(*STOCK_DAY)
    laid.format("parquet").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_by_day(spark: SparkSession, table: str, path: str, schema: StructType, buckets: int = BUCKETS) -> DataFrame:
    """Make a stored table known to a catalog that does not have it, such as another session's.

    ``schema`` is the stored rows' without the folder column; ``buckets`` must be what they were written with.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(STOCK_DAY)
    spark.sql(
        f"CREATE TABLE {table} ({columns}, {DAY} date) USING parquet PARTITIONED BY ({DAY}) "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(table)
    return spark.table(table)


def on_days_of(stored: DataFrame, work_list: DataFrame) -> DataFrame:
    """Rows of the days that a work list names: other days' folders are not opened.

    The days are broadcast, of which there are no more than in the calendar; the stored rows stay where they are.
    """
    days = work_list.select(F.col("order_date").alias(DAY)).distinct()
    return stored.join(F.broadcast(days), DAY, "left_semi").drop(DAY)


def updown_day_stored(levels: DataFrame, edges: DataFrame, work_list: DataFrame, close_default=None) -> DataFrame:
    """``updown_day`` of three stored tables. Neither joins nor sums move the stored rows.

    Where the work list is filtered, folders of other days are pruned while the query runs.
    """
    listed = on_days_of(levels, work_list)
    return updown_day(listed, on_days_of(edges, work_list), work_list.drop(DAY), close_default)
