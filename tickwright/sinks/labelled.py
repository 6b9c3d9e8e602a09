"""Loading rows into a folder under a label: once, as a whole or not at all.

A data source for Spark's writer. Each task stages one Parquet file; the commit names the files of all tasks in one
small file called after the label, which no second load can make again. Readers take the files that labels name, so
what failed or was repeated is never seen. The folder is one that all executors share.
"""

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "labelled_files"


def _ledger(path: str, label: str) -> str:
    if not label or os.path.basename(label) != label or label.startswith("."):
        raise ValueError(f"not a label: {label!r}")
    return os.path.join(path, "_labels", f"{label}.json")


@dataclass
class _Staged(WriterCommitMessage):
    file: str | None
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, label: str):
        self.path, self.label = path, label
        os.makedirs(os.path.join(path, "_labels"), exist_ok=True)
        self.known = os.path.exists(_ledger(path, label))
        self.load = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Staged:
        """One file for each task that has rows; an attempt that is repeated writes another and names only that."""
        name, rows, writer = f"{self.load}-{uuid.uuid4().hex}.parquet", 0, None
        if self.known:
            return _Staged(None, 0)
        for batch in batches:
            if writer is None:
                writer = pq.ParquetWriter(os.path.join(self.path, name), batch.schema)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is None:
            return _Staged(None, 0)
        writer.close()
        return _Staged(name, rows)

    def commit(self, messages: list[_Staged | None]) -> None:
        """The ledger entry is written aside and linked to its name, which fails if another load has it already."""
        if self.known:
            return
        done = [m for m in messages if m is not None]
        entry = {"files": [m.file for m in done if m.file], "rows": sum(m.rows for m in done)}
        aside = os.path.join(self.path, "_labels", f".{self.load}")
        with open(aside, "w") as file:
            json.dump(entry, file)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(aside, _ledger(self.path, self.label))
        except FileExistsError:
            self._remove(done)
        finally:
            os.unlink(aside)

    def abort(self, messages: list[_Staged | None]) -> None:
        self._remove([m for m in messages if m is not None])

    def _remove(self, staged: list[_Staged]) -> None:
        for message in staged:
            if message.file and os.path.exists(os.path.join(self.path, message.file)):
                os.unlink(os.path.join(self.path, message.file))


class LabelledFiles(DataSource):
    """``df.write.format("labelled_files").option("label", ...).mode("append").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        raise ValueError("read the folder with read_labelled")

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("a labelled load only adds rows")
        return _Writer(self.options["path"], self.options.get("label", ""))


def load_labelled(df: DataFrame, path: str, label: str) -> None:
    """Add rows under a label. A label that has been loaded adds nothing, whatever the rows are."""
    _ledger(path, label)
    df.sparkSession.dataSource.register(LabelledFiles)
    df.write.format(FORMAT).option("label", label).mode("append").save(path)


def read_labelled(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of all loads that were committed. Spark lists files by name anyway; a label adds one line to that."""
    files = []
    folder = os.path.join(path, "_labels")
    for entry in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
        if not entry.startswith("."):
            with open(os.path.join(folder, entry)) as file:
                files += [os.path.join(path, name) for name in json.load(file)["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
