"""Reading ticks, price levels and work lists from files or over JDBC."""

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickwright.functions import parse_day
from tickwright.schemas import STOCK_DAY, TICKS, WORK_LIST


def read_table(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    schema: StructType | None = None,
    where: str | None = None,
    **options,
) -> DataFrame:
    """Scan files. Without a schema the source's own names and types are kept.

    ``where`` is a SQL predicate; Spark pushes it into the scan together with the columns used.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.where(where) if where else df


def jdbc_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    fetchsize: int = 10_000,
    query_timeout: int = 0,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int | None = None,
    whole: bool = False,
) -> dict[str, str]:
    """Options of one JDBC read: a table or a free query, split on a column.

    A read that isn't split goes through one task, so it has to be asked for: ``whole=True``, for what is small.
    """
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    split = (partition_column, lower, upper, partitions)
    if any(x is not None for x in split) and any(x is None for x in split):
        raise ValueError("a split read needs partition_column, lower, upper and partitions")
    if whole == (partition_column is not None):
        raise ValueError("split the read on partition_column, or take it whole, in one task")
    if query is not None and partition_column is not None:
        table, query = f"({query}) split_source", None
    chosen = {
        "url": url,
        "dbtable": table,
        "query": query,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": fetchsize,
        "queryTimeout": query_timeout,
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": partitions,
    }
    return {key: str(value) for key, value in chosen.items() if value is not None}


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """A database table or query. Filters put on the result reach the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()


def read_tick_stream(
    spark: SparkSession,
    path: str,
    *,
    schema: StructType = TICKS,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Files as a stream, taken oldest first so that a stock-day's ticks come in time order."""
    reader = spark.readStream.format(fmt).schema(schema).option("latestFirst", "false")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def ticks_of_day_by_sql(ticks: DataFrame, code: str, day: str | date) -> DataFrame:
    """One stock-day by SQL text, in time order."""
    return ticks.sparkSession.sql(
        "SELECT * FROM {ticks} WHERE order_code = :code AND order_date = DATE(:day) "
        "ORDER BY order_time ASC, tran_id ASC",
        args={"code": code, "day": str(day)},
        ticks=ticks,
    )


def work_list(source: DataFrame, days: Sequence[str | date] | None = None) -> DataFrame:
    """The stock-days to work on, each once, for all days or for the given ones."""
    keys = source.select(*STOCK_DAY).where(F.col("order_code").isNotNull())
    if days is not None:
        keys = keys.where(F.col("order_date").isin([F.lit(str(d)).cast("date") for d in days]))
    return keys.distinct()


def literal_keys(spark: SparkSession, keys: Iterable[tuple[str, date]]) -> DataFrame:
    """A short work list written out by hand."""
    return spark.createDataFrame(list(keys), WORK_LIST)


def work_list_limits(source: DataFrame) -> DataFrame:
    """Stock-days with their price limits; the day may be written with or without dashes."""
    return source.select(
        "ts_code",
        parse_day(F.col("trade_date")).alias("trade_date"),
        F.col("up_limit").cast("decimal(10,2)").alias("up_limit"),
        F.col("down_limit").cast("decimal(10,2)").alias("down_limit"),
    ).distinct()
