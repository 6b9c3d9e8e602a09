"""The previous row's value within a key, also where one key holds much of the data.

``lag`` sorts a whole key in one task. Keys with more than ``hot_over`` rows are therefore cut into slices along
the order: Spark's range partitioning deals them to tasks by a sample of the rows themselves, and each task counts
its sorted rows off into slices. How many tasks there are follows the rows, not the slices, so small slices cost no
task and no file each. The last value before each slice is put in front of it as an extra row. The result is that
of a plain ``lag``.
"""

from math import ceil

from pyspark.sql import DataFrame, Row, Window, functions as F

from tickwright.session import shared_dir

HOT_ROWS = 2_000_000

#: A task cuts so many rows at least, also where slices are smaller.
TASK_ROWS = 100_000

#: So many keys are cut at most, the largest ones; others hold no more than that part of all rows. It bounds
#: the list that is broadcast.
MOST_HOT = 100_000


def hot_keys(df: DataFrame, keys: list[str], hot_over: int) -> list[Row]:
    """The keys with more than ``hot_over`` rows and their ``rows``, at most MOST_HOT."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > hot_over)
    return counted.orderBy(F.desc("rows")).limit(MOST_HOT).collect()


def sliced(df: DataFrame, keys: list[str], order: list[str], hot_over: int, rows: int) -> DataFrame:
    """``df`` with the number of its ``slice``, which grows along keys and order.

    A slice has the number of its first row and at most ``hot_over`` rows. Tasks cut half of that, so that the
    sample need not be exact, or ``TASK_ROWS`` where that is more. Slices are written to the shared folder: what is
    read more than once must have been cut at the same places.
    """
    path = shared_dir(df.sparkSession, "slices")
    tasks = ceil(rows / max(hot_over / 2, TASK_ROWS))
    ranges = df.repartitionByRange(tasks, *keys, *order).sortWithinPartitions(*keys, *order)
    # Numbers begin anew with each task: the task's own in the upper bits, below 2^33 that of the row.
    numbered = ranges.withColumn("slice", F.monotonically_increasing_id())
    within = F.col("slice").bitwiseAND(F.lit(2**33 - 1)) % F.lit(max(hot_over, 1))
    numbered.withColumn("slice", F.col("slice") - within).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    hot_over: int = HOT_ROWS,
    before: DataFrame | None = None,
) -> DataFrame:
    """Add ``previous``: the ``value`` of the row before, null for the first of its key.

    ``keys``, ``order`` and ``value`` hold no nulls. ``before`` may give, per key, the value that came before
    the first row (columns: the keys and ``value``). Counting the keys is a job of its own; where none is
    hot, the rest is a plain ``lag``.
    """
    hot = hot_keys(df, keys, hot_over)
    if not hot:
        return _lagged(df, before, keys, order, value)
    spark, key_fields = df.sparkSession, [df.schema[k] for k in keys]
    listed = F.broadcast(spark.createDataFrame([tuple(r[k] for k in keys) for r in hot], type(df.schema)(key_fields)))
    # Rows at one place may be dealt to two slices, so the value settles their order.
    placed = list(dict.fromkeys([*order, value]))
    cut = sliced(df.join(listed, keys, "left_semi"), keys, placed, hot_over, sum(r.rows for r in hot))
    ends = cut.groupBy(*keys, "slice").agg(F.max_by(value, F.struct(*placed)).alias(value))
    if before is not None:
        seeds = before.join(listed, keys, "left_semi").withColumn("slice", F.lit(-1).cast("long"))
        ends = ends.unionByName(seeds)
        before = before.join(listed, keys, "left_anti")
    along = Window.partitionBy(*keys).orderBy("slice")
    starts = ends.withColumn(value, F.lag(value).over(along)).where(F.col(value).isNotNull())
    rest = _lagged(df.join(listed, keys, "left_anti"), before, keys, order, value)
    return rest.unionByName(_lagged(cut, starts, [*keys, "slice"], placed, value).drop("slice"))


def _lagged(df: DataFrame, before: DataFrame | None, keys: list[str], order: list[str], value: str) -> DataFrame:
    """The plain ``lag``, with what came before as extra rows, which have no order values and so come first."""
    rows = df
    if before is not None:
        extras = before.withColumn("extra", F.lit(True))
        rows = df.withColumn("extra", F.lit(False)).unionByName(extras, allowMissingColumns=True)
    within = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    seen = rows.withColumn("previous", F.lag(value).over(within))
    return seen.where(~F.col("extra")).drop("extra") if before is not None else seen
