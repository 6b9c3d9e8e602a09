"""One row per stock-day: the 30-column feature row."""

from pyspark.sql import DataFrame, functions as F

from tickwright.functions import day_key, without_suffix
from tickwright.operators.bands import band_index, band_sums, with_band_ratios
from tickwright.operators.levels import opened_levels
from tickwright.operators.moments import moment_sums, with_moment_terms, with_moments
from tickwright.operators.totals import total_sums, with_averages
from tickwright.plans.opening import with_open_close
from tickwright.schemas import BANDS, FEATURES, STOCK_DAY

_DAY = ["ts_code", "trade_date"]


def day_features(levels: DataFrame, edges: DataFrame, limits: DataFrame) -> DataFrame:
    """Feature rows of the stock-days in ``limits`` that have price levels and traded volume.

    Levels and limits are keyed by ``ts_code`` and ``trade_date``, opening prices by the code without
    its suffix. Limits and opening prices meet first; the levels are then joined and aggregated once,
    all measures in one pass.
    """
    days = limits.select(*_DAY, "up_limit", "down_limit").distinct()
    days = days.withColumns(
        {"order_code": without_suffix(F.col("ts_code")), "order_date": F.col("trade_date")}
    )
    days = with_open_close(days, edges, STOCK_DAY).drop(*STOCK_DAY)

    return _feature_rows(with_moment_terms(levels.join(days, _DAY)), _DAY)


def day_features_of_ticks(ticks: DataFrame, limits: DataFrame) -> DataFrame:
    """The same rows straight from ticks, which are read once.

    ``limits`` is keyed as for ``day_features``; its code without the suffix is the ticks' code. Levels are
    shuffled by stock-day once, for opening price, limits and sums alike.
    """
    days = limits.select(*_DAY, "up_limit", "down_limit").distinct()
    days = days.withColumns(
        {"order_code": without_suffix(F.col("ts_code")), "order_date": F.col("trade_date")}
    )
    terms = with_moment_terms(opened_levels(ticks))
    return _feature_rows(terms.join(days, STOCK_DAY), [*STOCK_DAY, *_DAY])


def _feature_rows(opened: DataFrame, keys: list[str]) -> DataFrame:
    placed = opened.withColumn("band", band_index("price", "down_limit", "up_limit"))
    sums = placed.groupBy(*keys, "up_limit", "down_limit", "start_price", "end_price").agg(
        *total_sums(),
        *moment_sums(),
        *band_sums("band", "volume_sum"),
    )
    rows = with_moments(sums.where(~F.col("damaged")).drop("damaged"))
    rows = with_band_ratios(with_averages(rows), "volume")
    rows = rows.withColumns(
        {
            "ticket_code": F.col("ts_code"),
            "ticket_dc": day_key(F.col("ts_code"), F.col("trade_date")),
            "price_start": F.col("start_price"),
            "price_end": F.col("end_price"),
            "price_mean": F.col("avg_price"),
            "price_mean_up": F.col("up_price"),
            "price_mean_down": F.col("down_price"),
            "price_open30_mean": F.lit(0),
            "price_median": F.lit(0),
            "volume_total": F.col("volume"),
            "volume_up": F.col("up_volume"),
            "volume_down": F.col("down_volume"),
            "volume_open30min": F.lit(0),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURES.fields])


def in_table_band_order(features: DataFrame) -> DataFrame:
    """The band values as the existing feature table holds them.

    That table was filled from ``d5`` up to ``u5`` into columns that run ``u1`` to ``u5``, then ``d1``
    to ``d5``. The values here are by name; this puts them where readers of that table expect them.
    """
    filled = [f"volume_{side}{i}_bucket" for side in "ud" for i in range(1, 6)]
    return features.withColumns(
        {column: F.col(value) for column, value in zip(filled, BANDS)}
    ).select(*features.columns)
