"""A table of files that is updated by key without being rewritten: only files that hold an updated key are made anew.

``rows/`` holds the files of all loads, sorted by part and key. A manifest says for each file and part which keys lie
between which ends, and a small numbered file names the manifest of each version. That file is made last and cannot
be made twice: readers see a version whole or not at all, and of two updates of one version the later one fails. The
folder is one that all executors share.
"""

import json
import os
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

FILE_ROWS = 2_000_000
#: Columns that stand beside the table's own while it is updated.
FILE, NEW = "__file", "__new"


class VersionTaken(Exception):
    """Another update made the next version first; what it was made from is no longer the newest."""


@dataclass(frozen=True)
class Version:
    number: int
    manifest: str
    key: list[str]
    part: str
    schema: str
    file_rows: int

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))

    @property
    def places(self) -> list[str]:
        return [self.part, *self.key]


def _entry(path: str, number: int) -> str:
    return os.path.join(path, "versions", f"{number:010d}.json")


def versions(path: str) -> list[int]:
    """The numbers of the versions that were committed, in order."""
    folder = os.path.join(path, "versions")
    names = os.listdir(folder) if os.path.isdir(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def version(path: str, number: int | None = None) -> Version:
    """One version, or the newest."""
    known = versions(path)
    if not known:
        raise ValueError(f"no version in {path}")
    with open(_entry(path, known[-1] if number is None else number)) as file:
        return Version(**json.load(file))


def _commit(path: str, made: Version) -> None:
    os.makedirs(os.path.join(path, "versions"), exist_ok=True)
    aside = os.path.join(path, "versions", f".{uuid.uuid4().hex}")
    with open(aside, "w") as file:
        json.dump(asdict(made), file)
        file.flush()
        os.fsync(file.fileno())
    try:
        os.link(aside, _entry(path, made.number))
    except FileExistsError:
        raise VersionTaken(f"version {made.number} of {path} is there already") from None
    finally:
        os.unlink(aside)


def _file() -> Column:
    """Load and name of a row's file, which are the same wherever the folder is mounted."""
    return F.substring_index(F.col("_metadata.file_path"), "/", -2)


def _opened(spark: SparkSession, path: str, of: Version, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], of.columns).withColumn(FILE, F.lit(""))
    rows = spark.read.schema(of.columns).parquet(*[os.path.join(path, "rows", f) for f in files])
    return rows.select("*", _file().alias(FILE))


def _write_rows(rows: DataFrame, path: str, of: Version) -> str:
    load = uuid.uuid4().hex
    ordered = rows.sortWithinPartitions(*of.places)
    ordered.write.option("maxRecordsPerFile", of.file_rows).parquet(os.path.join(path, "rows", load))
    return load


def _ranges(spark: SparkSession, path: str, of: Version, load: str) -> DataFrame:
    """file, part, lowest, highest: the ends of the keys by file and part. Reads the key columns of one load."""
    rows = spark.read.schema(of.columns).parquet(os.path.join(path, "rows", load))
    key = F.struct(*of.key)
    return rows.groupBy(_file().alias("file"), F.col(of.part).alias("part")).agg(
        F.min(key).alias("lowest"), F.max(key).alias("highest")
    )


def _manifest(spark: SparkSession, path: str, of: Version) -> DataFrame:
    return spark.read.parquet(os.path.join(path, "manifests", of.manifest))


def _names(rows: DataFrame, column: str) -> list[str]:
    """File names, which the driver lists for any read of files."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())


def create_versions(df: DataFrame, path: str, key: list[str], part: str, file_rows: int = FILE_ROWS) -> Version:
    """Write the first version: files of at most ``file_rows`` rows in the order of part and key.

    ``part`` is a coarse column that the key decides, such as a day. Rows are cut into ranges of part and key, so a
    part that holds much of the data is many files.
    """
    spark = df.sparkSession
    if versions(path):
        raise VersionTaken(f"version 1 of {path} is there already")
    made = Version(1, uuid.uuid4().hex, list(key), part, df.schema.json(), file_rows)
    load = _write_rows(df.repartitionByRange(*made.places), path, made)
    _ranges(spark, path, made, load).write.parquet(os.path.join(path, "manifests", made.manifest))
    _commit(path, made)
    return made


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of one version, or of the newest."""
    of = version(path, number)
    return _opened(spark, path, of, _names(_manifest(spark, path, of), "file")).drop(FILE)


def update_version(updates: DataFrame, path: str, base: Version | None = None) -> tuple[Version, int]:
    """Make the next version of ``base``, or of the newest: it and how many files were made anew.

    A row whose part and key are in ``updates`` takes its other columns' values, null ones too; all other rows stay,
    as do columns that ``updates`` lacks. Of several updates for one key the one with the largest values counts; a
    null part or key meets no row, and updates add no rows. Updates that meet no row make no version.

    Files are chosen twice: by the ends of their keys, then by their keys, of which only the columns are read.
    """
    spark = updates.sparkSession
    of = base or version(path)
    values = [c for c in of.columns.names if c in updates.columns and c not in of.places]
    largest = F.max(F.struct(F.lit(True).alias("met"), *values)).alias(NEW)
    given = updates.dropna(subset=of.places).groupBy(*of.places).agg(largest)
    listed = _manifest(spark, path, of)
    key = F.struct(*of.key)
    spans = given.groupBy(F.col(of.part).alias("part")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    near = listed.join(spans, "part").where((F.col("lowest") <= F.col("high")) & (F.col("low") <= F.col("highest")))
    opened = _opened(spark, path, of, _names(near, "file"))
    touched = _names(opened.join(given, of.places, "left_semi"), FILE)
    if not touched:
        return of, 0
    met = _opened(spark, path, of, touched).join(given, of.places, "left")
    kept = {c: F.when(F.col(f"{NEW}.met"), F.col(f"{NEW}.{c}")).otherwise(F.col(c)) for c in values}
    rows = met.withColumns({c: column.cast(of.columns[c].dataType) for c, column in kept.items()})
    # A file's rows stay together, so the new files' ends are as close as the old ones' were.
    load = _write_rows(rows.hint("rebalance", FILE).select(*of.columns.names), path, of)
    made = Version(of.number + 1, uuid.uuid4().hex, of.key, of.part, of.schema, of.file_rows)
    gone = spark.createDataFrame([(f,) for f in touched], "file string")
    manifest = listed.join(gone, "file", "left_anti").unionByName(_ranges(spark, path, of, load))
    manifest.write.parquet(os.path.join(path, "manifests", made.manifest))
    _commit(path, made)
    return made, len(touched)


def forget_before(spark: SparkSession, path: str, number: int) -> int:
    """Let go of the versions before ``number``, and of files that only they name; how many files went.

    Whoever still reads such a version fails. What a broken-off update left was never named and is not touched, since
    it cannot be told from what an update is just writing. Entries go first: a call that breaks off leaves files that
    nothing names, never a version without its files.
    """
    known = versions(path)
    if number not in known:
        raise ValueError(f"no version {number} in {path}")
    old = [version(path, n) for n in known if n < number]
    if not old:
        return 0
    kept = [version(path, n) for n in known if n >= number]
    named = [spark.read.parquet(*[os.path.join(path, "manifests", v.manifest) for v in some]) for some in (old, kept)]
    gone = _names(named[0].join(named[1], "file", "left_anti"), "file")
    for v in old:
        os.unlink(_entry(path, v.number))
    for file in gone:
        os.unlink(os.path.join(path, "rows", file))
    return len(gone)
