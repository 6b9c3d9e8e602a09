"""Tab-separated lines in a folder for each day, as a source that takes filters.

A data source for Spark's reader, for lines as ``write_change_lines`` gives them, which carry no types and no
statistics. Filters on the day choose the files that are opened; filters on the code are met on the raw line,
before anything of it is decoded. Only the columns of the asked schema are decoded.
"""

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DateType, DecimalType, LongType, StructType

from tickwright.schemas import PRICE_CHANGES

FORMAT = "day_lines"
DAY = "order_date"
#: Bytes of a file that one task reads, and lines that travel at once.
SPLIT_BYTES = 64_000_000
BATCH_LINES = 20_000
#: What Spark calls the folder of rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"

_COMPARED: dict[type, Callable] = {
    EqualTo: lambda x, y: x == y,
    In: lambda x, y: x in y,
    GreaterThan: lambda x, y: x > y,
    GreaterThanOrEqual: lambda x, y: x >= y,
    LessThan: lambda x, y: x < y,
    LessThanOrEqual: lambda x, y: x <= y,
}


@dataclass
class _Split(InputPartition):
    file: str
    first: int
    after: int


def _decoder(kind) -> Callable:
    if isinstance(kind, DateType):
        return date.fromisoformat
    if isinstance(kind, LongType):
        return int
    if isinstance(kind, DecimalType):
        return Decimal
    return str


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema
        self.days: list[tuple[type, object]] = []
        self.codes: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of the day with values, and a code or a list of codes; gives the others back."""
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            if column == DAY and type(f) in _COMPARED and isinstance(f.value, (date, tuple, list)):
                self.days.append((type(f), f.value))
            elif column == "order_code" and type(f) in (EqualTo, In):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.codes = wanted if self.codes is None else self.codes & wanted
            else:
                yield f

    def partitions(self) -> list[_Split]:
        splits = []
        for folder in sorted(os.listdir(self.path)):
            if not folder.startswith(f"{DAY}="):
                continue
            text = unquote(folder.partition("=")[2])
            day = None if text == _NO_DAY else date.fromisoformat(text)
            if not all(day is not None and _COMPARED[kind](day, value) for kind, value in self.days):
                continue
            for name in sorted(os.listdir(os.path.join(self.path, folder))):
                file = os.path.join(self.path, folder, name)
                if not name.startswith((".", "_")):
                    size = os.path.getsize(file)
                    splits += [_Split(file, a, min(size, a + SPLIT_BYTES)) for a in range(0, size, SPLIT_BYTES)]
        return splits or [_Split("", 0, 0)]

    def read(self, split: _Split) -> Iterator[pa.RecordBatch]:
        """The lines that begin in the split."""
        if not split.file:
            return
        codes = None if self.codes is None else {c.encode() for c in self.codes if c is not None}
        places = [(PRICE_CHANGES.names.index(f.name), _decoder(f.dataType)) for f in self.schema]
        arrow = to_arrow_schema(self.schema)
        lines: list[list[str]] = []

        def batch() -> pa.RecordBatch:
            columns = [[None if line[k] == "null" else decode(line[k]) for line in lines] for k, decode in places]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        with open(split.file, "rb") as file:
            if split.first:
                file.seek(split.first - 1)
                file.readline()  # the rest of a line that begins before
            while file.tell() < split.after:
                raw = file.readline()
                if codes is not None and raw.partition(b"\t")[0] not in codes:
                    continue
                lines.append(raw.decode().rstrip("\r\n").split("\t"))
                if len(lines) >= BATCH_LINES:
                    yield batch()
                    lines.clear()
        if lines:
            yield batch()


class DayLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return PRICE_CHANGES

    def reader(self, schema: StructType) -> _Reader:
        unknown = [c for c in schema.names if c not in PRICE_CHANGES.names]
        if unknown:
            raise ValueError(f"no such columns: {unknown}")
        return _Reader(self.options["path"], schema)


def read_day_lines(spark: SparkSession, path: str, schema: StructType = PRICE_CHANGES) -> DataFrame:
    """Lines written by ``write_day_lines``; ``schema`` may name fewer columns, and only those are decoded.

    Spark hands filters to sources in Python only if told so; this sets it for the session. A line's word ``null``
    is a null in every column.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DayLines)
    return spark.read.format(FORMAT).schema(schema).load(path)
