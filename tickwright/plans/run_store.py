"""Run rows that are kept from one load to the next: only files that are new or were replaced are read.

A store has two tables. ``parts`` holds a partial run for each file and stock-day, by day; ``ledger`` names the files
that a load has read, and is written last. A part counts only if the ledger names its file and load, so a load that
broke off leaves nothing that counts, and its files are read again.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickwright.operators.runs import accumulate, merge_runs
from tickwright.schemas import TICKS
from tickwright.sinks.tables import append_rows

LEDGER = "load string, file string, changed timestamp, size long"
_STATE = ["file", "changed", "size"]


def _same_form(path: Column) -> Column:
    """One slash after the scheme, as Spark's columns for paths differ there."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _file_read() -> Column:
    """The path of the file that a row was read from, which Spark hands out as encoded for an address."""
    path = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return _same_form(F.url_decode(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The folder's files as they are now, listed without being opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listed.load(path).select(
        "path", _same_form(F.col("path")).alias("file"), F.col("modificationTime").alias("changed"), F.col("length").alias("size")
    )


def _parts_of(ticks: DataFrame, load: str, file: Column) -> DataFrame:
    return accumulate(ticks.withColumn("file", file), F.col("file")).withColumn("load", F.lit(load))


def _no_parts(spark: SparkSession, schema: StructType) -> DataFrame:
    return _parts_of(spark.createDataFrame([], schema), "", F.lit(""))


def keep_runs(spark: SparkSession, path: str, store: str, schema: StructType = TICKS) -> int:
    """Take the folder's new and replaced Parquet files of ticks into the store; how many were read.

    A file is known by its path, time of change and size. The first load reads the folder as a whole; a later one is
    handed the paths of what is new.
    """
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(f"{store}/ledger")
    _no_parts(spark, schema).write.mode("ignore").partitionBy("order_date").parquet(f"{store}/parts")
    ledger = spark.read.schema(LEDGER).parquet(f"{store}/ledger")
    fresh = [r.asDict() for r in _files(spark, path).join(ledger, _STATE, "left_anti").collect()]
    if not fresh:
        return 0
    load = uuid.uuid4().hex
    paths = [f["path"] for f in fresh] if ledger.limit(1).count() else [path]
    reader = spark.read.schema(schema).option("basePath", path).option("pathGlobFilter", "*.parquet")
    ticks = reader.option("recursiveFileLookup", "true").parquet(*paths)
    append_rows(_parts_of(ticks, load, _file_read()), f"{store}/parts", by_day="order_date")
    entries = [(load, f["file"], f["changed"], f["size"]) for f in fresh]
    spark.createDataFrame(entries, LEDGER).write.mode("append").parquet(f"{store}/ledger")
    return len(fresh)


def kept_runs(spark: SparkSession, path: str, store: str, schema: StructType = TICKS) -> DataFrame:
    """Run rows over the files that the store knows and that are in the folder as they were read.

    Those removed or replaced since then no longer count; new ones count after the next ``keep_runs``. A file that
    two loads read at the same time counts once.
    """
    ledger = spark.read.schema(LEDGER).parquet(f"{store}/ledger")
    valid = ledger.join(_files(spark, path).select(*_STATE), _STATE, "left_semi")
    counted = valid.groupBy("file").agg(F.min("load").alias("load"))
    parts = spark.read.schema(_no_parts(spark, schema).schema).parquet(f"{store}/parts")
    return merge_runs(parts.join(counted, ["file", "load"], "left_semi"))
