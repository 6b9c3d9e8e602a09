"""The shared test tables seen as ticks, work lists, limits and bars."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickwright.operators.levels import open_close
from tickwright.schemas import TICKS

_EVENT_COLUMNS = {
    "order_code": "event_type",
    "order_date": "CAST(ts AS DATE)",
    "tran_id": "event_id",
    "order_time": "date_format(ts, 'HH:mm:ss.SSSSSS')",
    "order_dc": "CAST(user_id AS STRING)",
    "price": "CAST(value AS DECIMAL(10,2))",
    "volume": "CAST(get_json_object(props, '$.k') AS BIGINT)",
}


def _with_all_tick_columns(df: DataFrame) -> DataFrame:
    missing = [f for f in TICKS.fields if f.name not in df.columns]
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    extra = [c for c in df.columns if c not in TICKS.names]
    return df.select(*TICKS.names, *extra)


def event_columns(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as ticks that also carry their event time ``ts``."""
    ticks = events.select(
        *[F.expr(text).alias(name) for name, text in _EVENT_COLUMNS.items()],
        F.col("ts").cast("timestamp").alias("ts"),
    )
    return _with_all_tick_columns(ticks)


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(spark.read.parquet(f"{sf_dir}/events.parquet")).drop("ts")


def coarse(ticks: DataFrame) -> DataFrame:
    """Prices cut down to whole tens, so that neighbours are often equal."""
    price: Column = (F.floor(F.col("price") / 10) * 10).cast("decimal(10,2)")
    return ticks.withColumn("price", price)


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trades of a supplier's stock in a month. They have no unique order."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    paid, shares = "CAST(round(l_extendedprice * 100) AS BIGINT)", "CAST(l_quantity AS BIGINT)"
    columns = {
        "order_code": "CAST(l_suppkey AS STRING)",
        "order_date": "CAST(date_trunc('month', l_shipdate) AS DATE)",
        "price": f"CAST((2 * {paid} + {shares}) div (2 * {shares}) * 0.01BD AS DECIMAL(10,2))",
        "volume": shares,
    }
    return lines.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def as_listed(levels: DataFrame) -> DataFrame:
    """Price levels under the exchange's names: code with market suffix, and trade date."""
    return levels.select(
        F.concat("order_code", F.lit(".EV")).alias("ts_code"),
        F.col("order_date").alias("trade_date"),
        "price",
        "volume_sum",
        "sum",
    )


def limit_list(ticks: DataFrame) -> DataFrame:
    """A work list with limits 1.00 and 101.00; the days are written without dashes."""
    days = ticks.select("order_code", "order_date").distinct()
    return days.select(
        F.concat("order_code", F.lit(".EV")).alias("ts_code"),
        F.date_format("order_date", "yyyyMMdd").alias("trade_date"),
        F.lit("101.00").alias("up_limit"),
        F.lit("1.00").alias("down_limit"),
    )


def bars(ticks: DataFrame) -> DataFrame:
    """One bar per stock-day, from opening to closing price."""
    ids = ticks.groupBy("order_code", "order_date").agg(F.min("tran_id").alias("id"))
    return ids.join(open_close(ticks), ["order_code", "order_date"]).select(
        "id",
        F.col("order_code").alias("code"),
        F.col("order_date").alias("date"),
        F.col("open_price").cast("double").alias("start"),
        F.col("close_price").cast("double").alias("end"),
    )
