"""Fixed schemas of the tables the operators read and write."""

from pyspark.sql import types as T

STOCK_DAY = ["order_code", "order_date"]

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(28, 2)

_NAMES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "price": PRICE,
    "amount": AMOUNT,
    "ratio": T.DecimalType(12, 6),
    "average": T.DecimalType(20, 2),
}


def _schema(*columns: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _NAMES[kind]) for name, kind in columns])


TICKS = _schema(
    ("order_code", "string"),
    ("order_date", "date"),
    ("tran_id", "bigint"),
    ("order_time", "string"),
    ("order_dc", "string"),
    ("price", "price"),
    ("volume", "bigint"),
    ("sale_volume", "bigint"),
    ("buy_volume", "bigint"),
    ("type", "string"),
    ("sale_order_id", "bigint"),
    ("sale_order_price", "price"),
    ("buy_order_id", "bigint"),
    ("buy_order_price", "price"),
)

# A tick without one of these is rejected; the rest may be null.
TICK_REQUIRED = [
    "order_code",
    "order_date",
    "tran_id",
    "order_time",
    "order_dc",
    "price",
    "volume",
    "sale_volume",
    "buy_volume",
    "sale_order_id",
    "buy_order_id",
]

# Property names of a tick in a JSON message, in the order of TICKS.
TICK_JSON_NAMES = [
    "orderCode",
    "orderDate",
    "tranId",
    "orderTime",
    "orderDc",
    "price",
    "volume",
    "saleVolume",
    "buyVolume",
    "type",
    "saleOrderId",
    "saleOrderPrice",
    "buyOrderId",
    "buyOrderPrice",
]

PRICE_LEVELS = _schema(
    ("order_code", "string"),
    ("order_date", "date"),
    ("price", "price"),
    ("volume_sum", "bigint"),
    ("sum", "amount"),
)

WORK_LIST = _schema(("order_code", "string"), ("order_date", "date"))

WORK_LIST_LIMITS = _schema(
    ("ts_code", "string"), ("trade_date", "string"), ("up_limit", "price"), ("down_limit", "price")
)

PRICE_CHANGES = _schema(
    ("order_code", "string"),
    ("order_date", "date"),
    ("order_time", "string"),
    ("order_dc", "string"),
    ("price", "price"),
    ("volume", "bigint"),
    ("sum", "amount"),
)

UPDOWN = _schema(
    ("order_code", "string"),
    ("order_date", "date"),
    ("start_price", "price"),
    ("end_price", "price"),
    ("next_price", "price"),
    ("avg_price", "average"),
    ("volume", "bigint"),
    ("all_volume", "bigint"),
    ("volume_proportion", "price"),
    ("up_volume", "bigint"),
    ("up_sum", "amount"),
    ("down_volume", "bigint"),
    ("down_sum", "amount"),
    ("up_down", "string"),
    ("up_down_proportion", "price"),
    ("up_price", "average"),
    ("down_price", "average"),
    ("price_tendency", "average"),
    ("score", "bigint"),
    ("value1", "string"),
)

# Bands from the lowest price to the highest.
BANDS = [
    "volume_d5_bucket",
    "volume_d4_bucket",
    "volume_d3_bucket",
    "volume_d2_bucket",
    "volume_d1_bucket",
    "volume_u1_bucket",
    "volume_u2_bucket",
    "volume_u3_bucket",
    "volume_u4_bucket",
    "volume_u5_bucket",
]

FEATURES = _schema(
    ("ticket_code", "string"),
    ("trade_date", "date"),
    ("ticket_dc", "string"),
    ("price_start", "price"),
    ("price_end", "price"),
    ("price_mean", "average"),
    ("price_mean_up", "average"),
    ("price_mean_down", "average"),
    ("price_open30_mean", "price"),
    ("price_median", "price"),
    ("price_std", "double"),
    ("price_max", "price"),
    ("price_min", "price"),
    ("price_range", "price"),
    ("price_skewness", "double"),
    ("price_kurtosis", "double"),
    ("volume_total", "bigint"),
    ("volume_up", "bigint"),
    ("volume_down", "bigint"),
    ("volume_open30min", "bigint"),
    ("volume_u1_bucket", "ratio"),
    ("volume_u2_bucket", "ratio"),
    ("volume_u3_bucket", "ratio"),
    ("volume_u4_bucket", "ratio"),
    ("volume_u5_bucket", "ratio"),
    ("volume_d1_bucket", "ratio"),
    ("volume_d2_bucket", "ratio"),
    ("volume_d3_bucket", "ratio"),
    ("volume_d4_bucket", "ratio"),
    ("volume_d5_bucket", "ratio"),
)

BARS = _schema(
    ("id", "bigint"), ("code", "string"), ("date", "date"), ("start", "double"), ("end", "double")
)
