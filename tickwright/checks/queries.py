"""Each operator run over the shared test tables, named as in the coverage list."""

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, DecimalType

from tickwright.functions import amount, parse_day, without_suffix
from tickwright.operators.bands import price_bands
from tickwright.operators.carry import apply_starts, carry_forward
from tickwright.operators.changes import price_changes
from tickwright.operators.keys import distinct_codes, of_days, of_work_list, with_transaction
from tickwright.operators.levels import first_ticks, last_ticks, open_close, opened_levels, price_levels
from tickwright.operators.moments import weighted_moments
from tickwright.operators.runs import accumulate, merge_runs, run_rows
from tickwright.operators.totals import day_totals
from tickwright.plans import (
    day_features,
    day_features_of_ticks,
    keep_runs,
    kept_runs,
    store_by_day,
    updown_day,
    updown_day_of_ticks,
    updown_day_stored,
)
from tickwright.plans.features import in_table_band_order
from tickwright.schemas import PRICE_CHANGES, STOCK_DAY, TICK_JSON_NAMES, TICKS, UPDOWN
from tickwright.session import shared_dir
from tickwright.sinks import (
    append_rows,
    change_lines,
    create_versions,
    feature_fields,
    load_labelled,
    read_labelled,
    read_version,
    update_version,
    write_change_lines,
    write_day_lines,
    write_feature_csv,
    write_new_version,
)
from tickwright.sources import (
    decode_json,
    decode_positional,
    literal_keys,
    read_day_lines,
    read_table,
    read_tick_stream,
    split_rejected,
    ticks_of_day_by_sql,
    work_list,
    work_list_limits,
)
from tickwright.sources.events import (
    as_listed,
    bars,
    coarse,
    event_columns,
    event_ticks,
    limit_list,
    lineitem_ticks,
)
from tickwright.streaming import latest_rows, replay, stream_change_log, stream_day_window, stream_price_changes

Query = Callable[[SparkSession, str], DataFrame]

TICK_VIEW = [*STOCK_DAY, "tran_id", "order_time", "order_dc", "price", "volume"]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that both engines hand out the same values."""

    def plain(field):
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        if isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# Scans and key joins


def tick_scan(spark, sf_dir):
    ticks = with_transaction(event_ticks(spark, sf_dir)).select(*TICK_VIEW)
    return ticks.withColumn("sum", amount(F.col("price"), F.col("volume")))


def where_scan(spark, sf_dir):
    return read_table(
        spark, f"{sf_dir}/events.parquet", where="event_type = 'click' AND value >= 50"
    ).select("event_id", "user_id", "value")


def day_filter(spark, sf_dir):
    return of_days(event_ticks(spark, sf_dir), ["2024-01-05", "2024-01-06"]).select(*TICK_VIEW)


def stock_day_by_sql(spark, sf_dir):
    return ticks_of_day_by_sql(event_ticks(spark, sf_dir), "click", "2024-01-05").select(*TICK_VIEW)


def key_semijoin(spark, sf_dir):
    """The stock-days of even days, which are about half at any scale."""
    ticks = event_ticks(spark, sf_dir)
    even = work_list(ticks.where(F.dayofmonth("order_date") % 2 == 0))
    return of_work_list(ticks, even).select(*TICK_VIEW)


def literal_key_list(spark, sf_dir):
    keys = literal_keys(spark, [("click", date(2024, 1, 5)), ("view", date(2024, 1, 6)), ("none", date(2024, 1, 5))])
    return of_work_list(event_ticks(spark, sf_dir), keys).select(*TICK_VIEW)


def code_list(spark, sf_dir):
    return distinct_codes(as_listed(price_levels(event_ticks(spark, sf_dir))))


def json_ticks(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir)
    fields = [
        F.col(f.name).cast("string").alias(name) for f, name in zip(TICKS.fields, TICK_JSON_NAMES)
    ]
    messages = ticks.select(F.to_json(F.struct(*fields)).cast("binary").alias("value"))
    return decode_json(messages).select(*TICK_VIEW)


def _untyped(spark, sf_dir):
    """Ticks as arrays of text. Those with volume over 90 lack their order price and seller."""
    ticks = event_ticks(spark, sf_dir).fillna(0, ["sale_volume", "buy_volume", "buy_order_id"])
    ticks = ticks.withColumn("sale_order_id", F.when(F.col("volume") <= 90, F.col("tran_id")))
    return ticks.select(F.array(*[F.col(c).cast("string") for c in TICKS.names]).alias("fields"))


def positional_ticks(spark, sf_dir):
    accepted, _ = split_rejected(decode_positional(_untyped(spark, sf_dir)))
    return accepted.select(*TICK_VIEW, "sale_order_id", "sale_order_price")


def rejected_ticks(spark, sf_dir):
    _, rejected = split_rejected(decode_positional(_untyped(spark, sf_dir)))
    return rejected.select(*TICK_VIEW, "sale_order_id", "sale_order_price")


def day_forms(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir)
    text = (
        F.when(F.col("volume") % 3 == 0, F.date_format("order_date", "yyyyMMdd"))
        .when(F.col("volume") % 3 == 1, F.date_format("order_date", "yyyy-MM-dd"))
        .otherwise(F.date_format("order_date", "yyyy-13-dd"))
    )
    code = without_suffix(F.concat("order_code", F.lit(".EV")))
    return ticks.select("tran_id", code.alias("order_code"), parse_day(text).alias("trade_date"))


# Levels, totals, statistics, bands


def levels_of_events(spark, sf_dir):
    return price_levels(event_ticks(spark, sf_dir))


def levels_of_lineitem(spark, sf_dir):
    return price_levels(lineitem_ticks(spark, sf_dir))


def open_close_of_events(spark, sf_dir):
    return open_close(event_ticks(spark, sf_dir))


def edge_ticks(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir).select(*TICK_VIEW)
    first = first_ticks(ticks).withColumn("edge", F.lit("first"))
    return first.unionByName(last_ticks(ticks).withColumn("edge", F.lit("last")))


def edge_ticks_of_any_clock(spark, sf_dir):
    """Clock times with nanoseconds, with a zone and with a mark in front, compared as text."""
    odd = (
        F.when(F.col("volume") % 4 == 0, F.concat("order_time", F.lit("789")))
        .when(F.col("volume") % 4 == 1, F.concat("order_time", F.lit("+08:00")))
        .when(F.col("volume") % 4 == 2, F.concat(F.lit("T"), "order_time"))
        .otherwise(F.col("order_time"))
    )
    ticks = event_ticks(spark, sf_dir).withColumn("order_time", odd).select(*TICK_VIEW)
    first = first_ticks(ticks).withColumn("edge", F.lit("first"))
    return first.unionByName(last_ticks(ticks).withColumn("edge", F.lit("last")))


def totals_vwap(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir)
    return day_totals(opened_levels(ticks), [*STOCK_DAY, "start_price", "end_price"])


def moments_of_events(spark, sf_dir):
    return weighted_moments(price_levels(event_ticks(spark, sf_dir)), STOCK_DAY)


def moments_of_lineitem(spark, sf_dir):
    return weighted_moments(price_levels(lineitem_ticks(spark, sf_dir)), STOCK_DAY)


def bands_of_events(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir)
    limits = work_list_limits(limit_list(ticks))
    keys = ["ts_code", "trade_date"]
    return price_bands(as_listed(price_levels(ticks)).join(limits, keys), keys)


def bands_of_lineitem(spark, sf_dir):
    """Limits at the month's lowest and highest price; many months have one price only."""
    month = Window.partitionBy(*STOCK_DAY)
    levels = price_levels(lineitem_ticks(spark, sf_dir)).withColumns(
        {"down_limit": F.min("price").over(month), "up_limit": F.max("price").over(month)}
    )
    return price_bands(levels, STOCK_DAY)


# Day rows


def updown(spark, sf_dir):
    return updown_day_of_ticks(event_ticks(spark, sf_dir))


def updown_of_work_list(spark, sf_dir):
    """Work list of the second half of the month; the last ten days have levels but no ticks."""
    ticks = event_ticks(spark, sf_dir)
    keys = work_list(ticks.where("order_date >= DATE'2024-01-16'"))
    edges = open_close(ticks.where("order_date <= DATE'2024-01-20'"))
    return updown_day(price_levels(ticks), edges, keys, close_default=0)


def updown_stored(spark, sf_dir):
    """Up/down rows of even days from levels, edges and a work list that are stored by stock-day."""
    ticks = event_ticks(spark, sf_dir)
    tables = {"levels": price_levels(ticks), "edges": open_close(ticks), "work_list": work_list(ticks)}
    stored = {}
    for name, rows in tables.items():
        path = shared_dir(spark, name)
        stored[name] = store_by_day(rows, path.rsplit("/", 1)[1].replace("-", "_"), path, buckets=32)
    even = stored["work_list"].where(F.dayofmonth("order_date") % 2 == 0)
    return updown_day_stored(stored["levels"], stored["edges"], even)


def features(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir)
    return day_features_of_ticks(ticks, work_list_limits(limit_list(ticks)))


def features_table_order(spark, sf_dir):
    """From levels and edges as stored tables would give them."""
    ticks = event_ticks(spark, sf_dir)
    limits = work_list_limits(limit_list(ticks))
    rows = day_features(as_listed(price_levels(ticks)), open_close(ticks), limits)
    return in_table_band_order(rows)


# Sequences


def changes(spark, sf_dir):
    return price_changes(coarse(event_ticks(spark, sf_dir)))


def changes_stamped(spark, sf_dir):
    """Change rows with the processing date, here a fixed one, in place of the stock-day's date."""
    day = F.lit(date(2030, 1, 2))
    return price_changes(coarse(event_ticks(spark, sf_dir)), day=day)


def changes_sliced(spark, sf_dir):
    """The same rows with every stock-day of more than 40 ticks cut into slices."""
    return price_changes(coarse(event_ticks(spark, sf_dir)), hot_over=40)


def run_accumulator(spark, sf_dir):
    return run_rows(accumulate(event_ticks(spark, sf_dir)))


def run_merge(spark, sf_dir):
    """Runs per hour, merged to days."""
    hour = F.left(F.col("order_time"), F.lit(2)).alias("hour")
    return run_rows(merge_runs(accumulate(event_ticks(spark, sf_dir), hour)))


def run_kept(spark, sf_dir):
    """Runs kept over two loads, of which the second reads only the files that came between them."""
    work = shared_dir(spark, "kept-runs")
    ticks, late = event_ticks(spark, sf_dir), F.pmod(F.xxhash64("tran_id"), F.lit(4)) == 0
    ticks.where(~late | late.isNull()).write.parquet(f"{work}/in")
    keep_runs(spark, f"{work}/in", f"{work}/store")
    ticks.where(late).write.mode("append").parquet(f"{work}/in")
    keep_runs(spark, f"{work}/in", f"{work}/store")
    return run_rows(kept_runs(spark, f"{work}/in", f"{work}/store"))


def carried(spark, sf_dir):
    return carry_forward(bars(event_ticks(spark, sf_dir)))


def keyed_update(spark, sf_dir):
    """Only bars that closed under 50 take the carried start; written as a new version."""
    table = bars(event_ticks(spark, sf_dir))
    path = shared_dir(spark, "bars")
    write_new_version(apply_starts(table, carry_forward(table).where(F.col("end") < 50)), path)
    return read_table(spark, path)


def keyed_update_files(spark, sf_dir):
    """The same update, of the files that hold such bars alone; the newest version is read."""
    path = shared_dir(spark, "bar-versions")
    create_versions(bars(event_ticks(spark, sf_dir)), path, key=["id"], part="date")
    starts = carry_forward(read_version(spark, path)).where(F.col("end") < 50)
    update_version(starts.select("date", "id", "start"), path)
    return read_version(spark, path)


# Text and file sinks


def tsv_lines(spark, sf_dir):
    return change_lines(changes(spark, sf_dir))


def tsv_files(spark, sf_dir):
    path = shared_dir(spark, "change-lines")
    write_change_lines(changes(spark, sf_dir), path)
    return read_table(spark, path, fmt="text")


def day_lines(spark, sf_dir):
    """Lines by day, read back through a source that opens the asked days only and looks for codes in raw lines."""
    path = shared_dir(spark, "day-lines")
    write_day_lines(changes(spark, sf_dir), path)
    found = read_day_lines(spark, path).where("order_date >= DATE'2024-01-10' AND order_code IN ('click', 'view') AND price > 20")
    return found.select(*PRICE_CHANGES.names)


def labelled_load(spark, sf_dir):
    """Change rows loaded by code under a label each; the second load of a label adds nothing."""
    path = shared_dir(spark, "labelled")
    rows = changes(spark, sf_dir)
    load_labelled(rows.where("order_code <= 'click'"), path, "early")
    load_labelled(rows.where("order_code > 'click'"), path, "late")
    load_labelled(rows, path, "early")
    return read_labelled(spark, path, PRICE_CHANGES)


def csv_projection(spark, sf_dir):
    return feature_fields(features(spark, sf_dir))


def csv_files(spark, sf_dir):
    path = shared_dir(spark, "features-csv")
    write_feature_csv(features(spark, sf_dir), path)
    return read_table(spark, path, fmt="csv", header=True)


def updown_append(spark, sf_dir):
    """Up/down rows appended into one folder per day and read back."""
    path = shared_dir(spark, "updown")
    append_rows(updown(spark, sf_dir), path, by_day="order_date")
    return read_table(spark, path, schema=UPDOWN).select(*UPDOWN.names)


# Streams


def _event_stream(spark, sf_dir):
    """A stream takes a folder or a pattern, and this pattern fits one file as well as a folder."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return event_columns(read_tick_stream(spark, f"{sf_dir}/event[s].parquet", schema=schema))


def stream_changes(spark, sf_dir):
    work = shared_dir(spark, "stream-changes")
    ticks = coarse(_event_stream(spark, sf_dir))
    stream_price_changes(ticks, f"{work}/out", work).awaitTermination()
    return read_table(spark, f"{work}/out").select(*PRICE_CHANGES.names)


def _in_parts(ticks, part, folder):
    """The ticks in six parts, one after another; how many files each has. A stream takes the oldest files first.

    The input is read once, and a part has as many files as Spark has tasks at a time, so it is written and read
    in parallel.
    """
    spark = ticks.sparkSession
    ticks.withColumn("part", part.cast("int")).write.partitionBy("part").parquet(f"{folder}-parts")
    parts, files = spark.read.parquet(f"{folder}-parts"), spark.sparkContext.defaultParallelism
    for k in range(6):
        parts.where(F.col("part") == k).drop("part").repartition(files).write.mode("append").parquet(folder)
        time.sleep(1.1)  # the files' times, by which a stream orders them, are in seconds
    return files


def _time_ordered_files(spark, sf_dir, folder):
    """By ranges of the ticks' ids, which follow time."""
    ticks = coarse(event_ticks(spark, sf_dir))
    last = ticks.agg(F.max("tran_id")).first()[0] or 0
    return _in_parts(ticks, F.floor(F.col("tran_id") * 6 / (last + 1)), folder)


def stream_changes_in_batches(spark, sf_dir):
    """The same rows over several batches, each of which goes on from the last prices before it."""
    work = shared_dir(spark, "stream-batches")
    files = _time_ordered_files(spark, sf_dir, f"{work}/in")
    ticks = read_tick_stream(spark, f"{work}/in", files_per_trigger=files)
    stream_price_changes(ticks, f"{work}/out", work).awaitTermination()
    return read_table(spark, f"{work}/out").select(*PRICE_CHANGES.names)


def stream_changes_timed(spark, sf_dir):
    """The same rows by a timed trigger, stopped when all that is there has been taken."""
    work = shared_dir(spark, "stream-timed")
    files = _time_ordered_files(spark, sf_dir, f"{work}/in")
    ticks = read_tick_stream(spark, f"{work}/in", files_per_trigger=2 * files)
    query = stream_price_changes(ticks, f"{work}/out", work, every="1 second")
    query.processAllAvailable()
    query.stop()
    return read_table(spark, f"{work}/out").select(*PRICE_CHANGES.names)


def stream_changes_of_shuffled_ticks(spark, sf_dir):
    """The same rows from ticks in no order over several batches: what the log of additions and retractions leaves."""
    work = shared_dir(spark, "stream-log")
    ticks = coarse(event_ticks(spark, sf_dir))
    files = _in_parts(ticks, F.pmod(F.xxhash64("tran_id"), F.lit(6)), f"{work}/in")
    stream = read_tick_stream(spark, f"{work}/in", files_per_trigger=2 * files)
    stream_change_log(stream, f"{work}/out", work, slice_chars=2).awaitTermination()
    return replay(read_table(spark, f"{work}/out"))


def stream_days(spark, sf_dir):
    work = shared_dir(spark, "stream-days")
    stream_day_window(_event_stream(spark, sf_dir), f"{work}/out", work).awaitTermination()
    return latest_rows(read_table(spark, f"{work}/out"))


def stream_closed_days(spark, sf_dir):
    """Append mode: each day once, when it can no longer change."""
    work = shared_dir(spark, "stream-closed-days")
    ticks = _event_stream(spark, sf_dir)
    stream_day_window(ticks, f"{work}/out", work, mode="append").awaitTermination()
    return read_table(spark, f"{work}/out").select(*PRICE_CHANGES.names)


QUERIES: dict[str, Query] = {
    "tick_scan": tick_scan,
    "where_scan": where_scan,
    "day_filter": day_filter,
    "stock_day_by_sql": stock_day_by_sql,
    "key_semijoin": key_semijoin,
    "literal_key_list": literal_key_list,
    "distinct_codes": code_list,
    "json_ticks": json_ticks,
    "positional_ticks": positional_ticks,
    "rejected_ticks": rejected_ticks,
    "day_forms": day_forms,
    "price_levels": levels_of_events,
    "lineitem_levels": levels_of_lineitem,
    "open_close": open_close_of_events,
    "edge_ticks": edge_ticks,
    "edge_ticks_any_clock": edge_ticks_of_any_clock,
    "totals_vwap": totals_vwap,
    "weighted_moments": moments_of_events,
    "lineitem_moments": moments_of_lineitem,
    "price_bands": bands_of_events,
    "lineitem_bands": bands_of_lineitem,
    "updown_day": updown,
    "updown_work_list": updown_of_work_list,
    "updown_stored": updown_stored,
    "day_features": features,
    "day_features_table_order": features_table_order,
    "price_changes": changes,
    "price_changes_sliced": changes_sliced,
    "price_changes_stamped": changes_stamped,
    "run_accumulator": run_accumulator,
    "run_merge": run_merge,
    "run_kept": run_kept,
    "carry_forward": carried,
    "keyed_update": keyed_update,
    "keyed_update_files": keyed_update_files,
    "tsv_lines": tsv_lines,
    "tsv_files": tsv_files,
    "day_lines": day_lines,
    "labelled_load": labelled_load,
    "csv_projection": csv_projection,
    "csv_files": csv_files,
    "updown_append": updown_append,
    "stream_price_changes": stream_changes,
    "stream_price_changes_batches": stream_changes_in_batches,
    "stream_price_changes_timed": stream_changes_timed,
    "stream_change_log": stream_changes_of_shuffled_ticks,
    "stream_day_window": stream_days,
    "stream_closed_days": stream_closed_days,
}

