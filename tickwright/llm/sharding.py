"""Shards of near equal bytes from sampled splitters.

Records are keyed by a hash of their text, so equal texts lie side by side. A size-weighted sample gives the
quantile boundaries of many small ranges; the exact bytes of each are then known from one aggregate. Ranges
that came out too full, because of one text with many copies, are subdivided by document. The ranges are
dealt to the shards, the fullest first, each to the emptiest shard.
"""

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickwright.session import shared_dir

SHARDS = 24
RANGES_PER_SHARD = 256
SAMPLES_PER_RANGE = 8
OVERFULL = 2.0


def _splitters(keyed: DataFrame, n_ranges: int, total: int) -> np.ndarray:
    """At most about ``n_ranges`` boundaries; the sample on the driver holds SAMPLES_PER_RANGE keys for each.

    A record is drawn with a probability in proportion to its size, by a hash of its id and key, so the
    same records are drawn again if a task is repeated.
    """
    rate = n_ranges * SAMPLES_PER_RANGE / max(total, 1)
    drawn = F.pmod(F.xxhash64("doc_id", "key", F.lit("sample")), F.lit(1 << 40)) < F.col("size") * F.lit(rate * (1 << 40))
    sample = np.sort(np.array([r.key for r in keyed.where(drawn).select("key").collect()], dtype=np.int64))
    return np.unique(sample[::SAMPLES_PER_RANGE])


def _deal(totals: dict[int, int], n_shards: int) -> dict[int, int]:
    """Range to shard, the fullest range first, to the shard with the fewest bytes so far."""
    load = [(0, shard) for shard in range(n_shards)]
    dealt = {}
    for at, size in sorted(totals.items(), key=lambda x: (-x[1], x[0])):
        bytes_so_far, shard = heapq.heappop(load)
        dealt[at] = shard
        heapq.heappush(load, (bytes_so_far + size, shard))
    return dealt


def shard_documents(spark: SparkSession, docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: shards of near equal bytes.

    A record's size is its text's UTF-8 bytes plus 8. A null text is an empty one; a null doc_id is a value
    like any other; repeated rows are separate records. No rows give no rows. Other columns are left out.
    The driver holds the sample and the ranges' totals, both bounded by the number of ranges. Only what is
    identical in text and doc_id cannot be parted.
    """
    text = F.coalesce("text", F.lit(""))
    path = shared_dir(spark, "shard-keys")
    docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
    ).write.parquet(path)
    keyed = spark.read.parquet(path)
    total = keyed.agg(F.sum("size")).first()[0] or 0
    splitters = _splitters(keyed, n_shards * RANGES_PER_SHARD, total)

    @F.pandas_udf("long")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, key.to_numpy(), side="right"))

    ranged = keyed.withColumn("range", range_of("key"))
    fair = max(1.0, total / (len(splitters) + 1))
    found = {r.range: r.size for r in ranged.groupBy("range").agg(F.sum("size").alias("size")).collect()}
    parts = {at: math.ceil(size / fair) for at, size in found.items() if size > OVERFULL * fair}
    # Subdivided ranges get numbers of their own, one block after another.
    first, after = {}, len(splitters) + 1
    for at in sorted(parts):
        first[at] = after
        after += parts[at]

    @F.pandas_udf("long")
    def finer(at: pd.Series, by_doc: pd.Series) -> pd.Series:
        n, base = at.map(parts), at.map(first)
        return (base + by_doc.mod(n.fillna(1))).where(n.notna(), at).astype("int64")

    if parts:
        # 31 bits, which floats hold exactly.
        by_doc = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(1 << 31))
        ranged = ranged.withColumn("range", finer("range", by_doc))
    totals = {r.range: (r.size, r.n) for r in ranged.groupBy("range").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    dealt = _deal({at: size for at, (size, _) in totals.items()}, n_shards)
    filled = [0] * n_shards
    layout = []
    for at in sorted(totals):
        layout.append((at, dealt[at], filled[dealt[at]]))
        filled[dealt[at]] += totals[at][1]
    places = spark.createDataFrame(layout, "range long, shard int, first_slot long")
    in_range = Window.partitionBy("range").orderBy("key", "doc_id", "size")
    return (
        ranged.withColumn("row", F.row_number().over(in_range))
        .join(F.broadcast(places), "range")  # as many rows as ranges
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first_slot") + F.col("row") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
