"""Carrying the end of one bar into the start of the next."""

from pyspark.sql import DataFrame, functions as F

from tickwright.operators.previous import HOT_ROWS, with_previous
from tickwright.schemas import BARS


def bars_in_order(bars: DataFrame, code: str | None = None) -> DataFrame:
    """Bars of one code, or of each, by date."""
    if code is not None:
        bars = bars.where(F.col("code") == code)
    return bars.orderBy("code", "date", "id")


def carry_forward(bars: DataFrame, *, hot_over: int = HOT_ROWS) -> DataFrame:
    """Each bar's start becomes the end of the code's bar before; the first keeps its own.

    A missing end is carried as 0.0 and stays missing where it stands; a first bar's missing start is 0.0.
    Bars of one code on one day are taken in id order. Bars without a code stay as they are.
    """
    bars = bars.select(*BARS.names)
    carried = F.coalesce("end", F.lit(0.0)).alias("carried")
    coded = bars.dropna(subset=["code"]).select("*", carried)
    seen = with_previous(coded, ["code"], ["date", "id"], "carried", hot_over)
    start = F.coalesce("previous", "start", F.lit(0.0))
    return seen.withColumn("start", start).select(*BARS.names).unionByName(bars.where(F.col("code").isNull()))


def apply_starts(bars: DataFrame, updates: DataFrame) -> DataFrame:
    """``bars`` with the ``start`` that ``updates`` gives for their id; the others stay as they are.

    Ids are unique on both sides.
    """
    new = updates.select("id", F.col("start").alias("new_start"))
    joined = bars.join(new, "id", "left")
    return joined.withColumn("start", F.coalesce("new_start", "start")).select(*bars.columns)
