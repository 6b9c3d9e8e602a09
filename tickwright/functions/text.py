"""Text and date columns: keys, code suffixes, day parsing and the two line formats."""

from pyspark.sql import Column, functions as F


def without_suffix(code: Column, length: int = 3) -> Column:
    """A code without its market suffix: ``000159.SZ`` becomes ``000159``."""
    return F.left(code, F.length(code) - F.lit(length))


def day_key(code: Column, day: Column) -> Column:
    """``code_yyyy-MM-dd``."""
    return F.concat_ws("_", code, F.date_format(day, "yyyy-MM-dd"))


def parse_day(text: Column, fallback: Column | None = None) -> Column:
    """A day written ``yyyy-MM-dd`` or ``yyyyMMdd``; otherwise the fallback, or null.

    Pass ``F.current_date()`` as fallback to stamp unreadable days with the processing date.
    """
    text = text.cast("string")
    days = [F.try_to_date(text, "yyyyMMdd"), F.try_to_date(text, "yyyy-MM-dd")]
    if fallback is not None:
        days.append(fallback)
    return F.coalesce(*days)


def clean_text(text: Column) -> Column:
    """Null becomes empty and commas go, so the value needs no quotes in a comma-separated line."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), ",", "")


def _two_places(value: Column, scale: int) -> Column:
    rounded = F.round(F.coalesce(value, F.lit(0)), scale)
    return F.format_string("%.2f", rounded.cast("double"))


def plain_price(value: Column) -> Column:
    """Null becomes 0; rounded to two decimals and written with two."""
    return _two_places(value, 2)


def plain_statistic(value: Column) -> Column:
    """Null becomes 0; rounded to eight decimals and written with two."""
    return _two_places(value, 8)


def plain_long(value: Column) -> Column:
    """Null becomes 0."""
    return F.format_string("%d", F.coalesce(value, F.lit(0)).cast("bigint"))


def tab_line(*columns: Column) -> Column:
    """Columns joined by tabs; a null is written as ``null``."""
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns])
