"""Text forms of change rows and feature rows."""

from pyspark.sql import Column, DataFrame, functions as F

from tickwright.functions import clean_text, plain_long, plain_price, plain_statistic, tab_line
from tickwright.schemas import FEATURES

_TEXT = {"ticket_code", "ticket_dc"}
_STATISTIC = {"price_std", "price_skewness", "price_kurtosis"}


def _change_line() -> Column:
    return tab_line(
        F.col("order_code"),
        F.date_format("order_date", "yyyy-MM-dd"),
        F.col("order_time"),
        F.col("order_dc"),
        F.col("price"),
        F.col("volume"),
        F.col("sum"),
    )


def change_lines(changes: DataFrame) -> DataFrame:
    """One tab-separated line per change row, in column ``value``."""
    return changes.select(_change_line().alias("value"))


def write_day_lines(changes: DataFrame, path: str) -> None:
    """Append change rows as lines, in a folder for each day; a day is gathered first, so that it is a few files."""
    lines = changes.hint("rebalance", "order_date").select(_change_line().alias("value"), "order_date")
    lines.write.mode("append").partitionBy("order_date").text(path)


def write_change_lines(changes: DataFrame, path: str, mode: str = "append") -> None:
    """Append change rows as lines, one file per task."""
    change_lines(changes).write.mode(mode).text(path)


def feature_fields(features: DataFrame) -> DataFrame:
    """Feature rows with every field written out as text: prices and shares with two decimals."""

    def written(name: str, kind: str):
        value = F.col(name)
        if name in _TEXT:
            return clean_text(value)
        if name in _STATISTIC:
            return plain_statistic(value)
        if kind == "bigint":
            return plain_long(value)
        if kind == "date":
            return F.coalesce(F.date_format(value, "yyyy-MM-dd"), F.lit("null"))
        return plain_price(value)

    return features.select(
        *[written(f.name, f.dataType.simpleString()).alias(f.name) for f in FEATURES.fields]
    )


def write_feature_csv(features: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Comma-separated files without quotes, each with a header line, one file per task."""
    (
        feature_fields(features)
        .write.mode(mode)
        .option("header", True)
        .option("quote", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
