"""Price changes of a tick stream in any order, as a log of rows added and taken back.

A stock-day is cut into slices by the first characters of the clock time, which follow its order. Each slice's ticks
are kept in Spark's state store as one value, a batch of Arrow columns, for every row of a list would be sent and
turned on its own. So a tick that comes late is put in its place, and the changes within the slice that it makes or
undoes are given. Whether a slice's first tick is a change depends on the slice before: only first
ticks and last prices, one row a slice, are brought together by day for that. So a stock that holds a third of all
ticks is spread over its slices.
"""

from collections import Counter
from collections.abc import Iterator
from datetime import timedelta
from decimal import Decimal

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, DateType, IntegerType, LongType, StringType, StructType

from tickwright.functions import amount, cents
from tickwright.operators.changes import USED
from tickwright.operators.keys import with_transaction
from tickwright.schemas import PRICE, PRICE_CHANGES, STOCK_DAY
from tickwright.streaming.changes import known_days, write_days, written_once
from tickwright.streaming.drain import drain

_TICK = ["order_time", "tran_id", "order_dc", "price", "volume"]
_TICK_TYPE = StructType().add("order_time", StringType()).add("tran_id", LongType()).add("order_dc", StringType()).add("price", PRICE).add("volume", LongType())
#: Ticks as Python sees them, prices in whole hundredths.
_KEPT = pa.schema([("order_time", pa.string()), ("tran_id", pa.int64()), ("order_dc", pa.string()), ("price", pa.int64()), ("volume", pa.int64())])
#: ``op`` is 1 for a row added and -1 for one taken back; 0 stands for a slice's first tick and ``last_price``.
_MADE = StructType().add("order_code", StringType()).add("order_date", DateType()).add("slice", StringType()).add("op", IntegerType())
for _field in _TICK_TYPE:
    _MADE = _MADE.add(_field.name, LongType() if _field.name == "price" else _field.dataType)
_MADE = _MADE.add("last_price", LongType())
_SLICES = StructType().add("order_code", StringType()).add("slice", StringType())
for _field in _TICK_TYPE:
    _SLICES = _SLICES.add(_field)
_SLICES = _SLICES.add("last_price", PRICE).add("batch", LongType()).add("slot", IntegerType()).add("order_date", DateType())


class _SliceChanges(StatefulProcessor):
    """The ticks of one slice in order, and what new ones change."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ticks = handle.getValueState("ticks", StructType().add("columns", BinaryType()), self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        held = self.ticks.get()
        known = _unpacked(held[0]) if held else []
        new = [t for batch in rows for t in _plain(batch)]
        ticks = sorted(known + new, key=_place)
        self.ticks.update((_packed(ticks),))
        before, after = Counter(_changes(known)), Counter(_changes(ticks))
        made = [(1, *t, None) for t in (after - before).elements()] + [(-1, *t, None) for t in (before - after).elements()]
        if not known or (known[0], known[-1][3]) != (ticks[0], ticks[-1][3]):
            made.append((0, *ticks[0], ticks[-1][3]))
        out = pd.DataFrame([(*key, *row) for row in made], columns=_MADE.names)
        yield out.astype({"volume": "Int64", "last_price": "Int64"})

    def close(self) -> None:
        pass


def _plain(batch: pd.DataFrame) -> Iterator[tuple]:
    missing = batch["volume"].isna()
    for *tick, volume, none in zip(*[batch[c].tolist() for c in _TICK], missing.tolist()):
        yield *tick, None if none else int(volume)


def _packed(ticks: list[tuple]) -> bytes:
    columns = [pa.array(column, field.type) for column, field in zip(zip(*ticks), _KEPT)]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _KEPT, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(pa.record_batch(columns, schema=_KEPT))
    return sink.getvalue().to_pybytes()


def _unpacked(columns: bytes) -> list[tuple]:
    return list(zip(*[column.to_pylist() for column in pa.ipc.open_stream(columns).read_all().columns]))


def _place(tick: tuple) -> tuple:
    # Ties by the rest, so that the order does not depend on when ticks came.
    time, serial, dc, price, volume = tick
    return time.encode(), serial, price, dc or "", -1 if volume is None else volume


def _changes(ticks: list[tuple]) -> list[tuple]:
    return [b for a, b in zip(ticks, ticks[1:]) if a[3] != b[3]]


def _first_ticks(slices: DataFrame) -> DataFrame:
    """The first ticks of slices whose price differs from the last one of the slice before."""
    before = F.lag("last_price").over(Window.partitionBy(*STOCK_DAY).orderBy("slice"))
    changed = slices.withColumn("before", before).where("before IS NULL OR before <> price")
    return changed.select(*STOCK_DAY, *_TICK)


def stream_change_log(
    ticks: DataFrame,
    output: str,
    work_dir: str,
    *,
    slice_chars: int = 5,
    keep: timedelta = timedelta(days=7),
    every: str | None = None,
) -> StreamingQuery:
    """Write what each micro-batch adds to the change rows and takes back from them to ``output/batch=<number>``.

    The rows are those of ``price_changes`` and ``op``, 1 or -1; ``replay`` gives the change rows of all ticks so
    far, in whatever order they came. Ticks of one stock-day whose times share their first ``slice_chars``
    characters are kept and sorted together, so their number bounds a task's memory. A slice is forgotten when it
    has been kept for ``keep``; ticks that come later than that start it anew. Ticks without an id, a
    time or a price are left out.

    State is kept by RocksDB with checkpoints of its change log. A batch's source is read once; a batch that comes
    again after a failure replaces what it wrote.
    """
    spark = ticks.sparkSession
    usable = with_transaction(ticks.select(*USED)).dropna(subset=[*STOCK_DAY, "order_time", "price"])
    cut = usable.withColumns({"slice": F.left("order_time", F.lit(slice_chars)), "price": F.expr(cents("price"))})
    made = cut.groupBy(*STOCK_DAY, "slice").transformWithStateInPandas(
        _SliceChanges(int(keep.total_seconds() * 1000)), _MADE, outputMode="Update", timeMode="ProcessingTime"
    )
    made = made.withColumns({name: (F.col(name) * F.lit(Decimal("0.01"))).cast(PRICE) for name in ("price", "last_price")})
    state = f"{work_dir}/slices"

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = written_once(batch, f"{work_dir}/made", number)
        new = rows.where("op = 0").select(*STOCK_DAY, "slice", *_TICK, "last_price")
        days = [r.order_date for r in new.select("order_date").distinct().collect()]
        known = known_days(session, state, _SLICES, days, number)
        before = known.select(*new.columns)
        after = before.join(new, [*STOCK_DAY, "slice"], "left_anti").unionByName(new)
        gone, come = _first_ticks(before), _first_ticks(after)
        log = rows.where("op <> 0").select(*STOCK_DAY, *_TICK, "op")
        log = log.unionByName(come.exceptAll(gone).withColumn("op", F.lit(1))).unionByName(gone.exceptAll(come).withColumn("op", F.lit(-1)))
        log = log.withColumn("sum", amount(F.col("price"), F.col("volume")))
        log.select(*PRICE_CHANGES.names, "op").write.mode("overwrite").parquet(f"{output}/batch={number}")
        write_days(after, known, state, _SLICES, number)

    with _state_store(spark):
        return drain(made, write, f"{work_dir}/checkpoint", mode="update", every=every)


class _state_store:
    """The session's settings for the state of a query that is started within."""

    WANTED = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Forgotten slices go with the next batch; without data there is nothing to do, and a query that takes all that
        # is there ends.
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self) -> None:
        self.before = {key: self.conf.get(key, None) for key in self.WANTED}
        for key, value in self.WANTED.items():
            self.conf.set(key, value)

    def __exit__(self, *error) -> None:
        for key, value in self.before.items():
            if value is None:
                self.conf.unset(key)
            else:
                self.conf.set(key, value)


def replay(log: DataFrame) -> DataFrame:
    """The change rows that a log leaves: each row as often as it was added and not taken back."""
    left = log.groupBy(*PRICE_CHANGES.names).agg(F.sum("op").cast("int").alias("times")).where("times > 0")
    return left.withColumn("times", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select(*PRICE_CHANGES.names)
