"""Shares of a day's volume in ten equal price bands between its limits."""

from pyspark.sql import Column, DataFrame, functions as F

from tickwright.functions import cents, half_up_ratio
from tickwright.schemas import BANDS


def band_index(price: str, down: str, up: str) -> Column:
    """Band 0 to 9 of a price; the upper limit belongs to band 9. Null outside the limits.

    Limits that are missing or equal give no bands.
    """
    position = f"(({cents(price)} - {cents(down)}) * 10) div ({cents(up)} - {cents(down)})"
    return F.expr(
        f"CASE WHEN {up} > {down} AND {price} BETWEEN {down} AND {up} THEN least(9, {position}) END"
    )


def band_sums(index: str, volume: str) -> list[Column]:
    """Volume per band, as conditional sums named like the bands."""
    return [
        F.expr(f"sum(CASE WHEN {index} = {i} THEN coalesce({volume}, 0) ELSE 0 END)").alias(band)
        for i, band in enumerate(BANDS)
    ]


def with_band_ratios(sums: DataFrame, total: str) -> DataFrame:
    """Band volumes to shares of the whole volume, which includes prices outside the limits."""
    return sums.withColumns({b: half_up_ratio(b, total, 6, 12) for b in BANDS})


def price_bands(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Band shares per key, from levels that carry ``down_limit`` and ``up_limit``."""
    placed = levels.withColumn("band", band_index("price", "down_limit", "up_limit"))
    sums = placed.groupBy(*keys).agg(
        F.expr("sum(coalesce(volume_sum, 0))").alias("volume"), *band_sums("band", "volume_sum")
    )
    return with_band_ratios(sums, "volume")
