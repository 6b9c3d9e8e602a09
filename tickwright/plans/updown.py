"""One row per stock-day: how much was traded above and below the opening price."""

from pyspark.sql import Column, DataFrame, functions as F

from tickwright.functions import cents, half_up_ratio
from tickwright.operators.levels import opened_levels
from tickwright.operators.totals import day_totals
from tickwright.plans.opening import with_open_close
from tickwright.schemas import STOCK_DAY, UPDOWN


def direction(up_sum: Column, down_sum: Column) -> Column:
    """``up``, ``balance`` or ``down``, by money traded on each side."""
    return F.when(up_sum > down_sum, "up").when(up_sum == down_sum, "balance").otherwise("down")


def updown_day(
    levels: DataFrame,
    edges: DataFrame,
    work_list: DataFrame | None = None,
    close_default=None,
) -> DataFrame:
    """The 20-column up/down row of each stock-day that has price levels and is on the work list.

    The small sides (work list, opening prices) are joined first, so the levels are joined and
    shuffled once. A day whose lowest price is 0 has no price tendency and gives no row.
    """
    if work_list is None:
        opened = with_open_close(levels, edges, STOCK_DAY, close_default)
    else:
        days = work_list.select(*STOCK_DAY).distinct()
        opened = levels.join(with_open_close(days, edges, STOCK_DAY, close_default), STOCK_DAY)
    return _updown_rows(opened)


def updown_day_of_ticks(
    ticks: DataFrame, work_list: DataFrame | None = None, close_default=None
) -> DataFrame:
    """The same rows straight from ticks, which are read once; their levels are shuffled once more, by day."""
    opened = opened_levels(ticks, close_default)
    if work_list is not None:
        opened = opened.join(work_list.select(*STOCK_DAY).distinct(), STOCK_DAY, "left_semi")
    return _updown_rows(opened)


def _updown_rows(opened: DataFrame) -> DataFrame:
    totals = day_totals(opened, [*STOCK_DAY, "start_price", "end_price"])
    rows = totals.where(F.col("price_min") != 0).withColumns(
        {
            "up_down": direction(F.col("up_sum"), F.col("down_sum")),
            "price_tendency": half_up_ratio(
                cents("avg_price", "DECIMAL(38,0)"), cents("price_min"), 2
            ),
            "all_volume": F.lit(0),
            "score": F.lit(0),
            "next_price": F.lit(None),
            "volume_proportion": F.lit(None),
            "up_down_proportion": F.lit(None),
            "value1": F.lit(None),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in UPDOWN.fields])
