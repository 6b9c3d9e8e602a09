"""Phrases of two and three words that are more frequent together than their parts.

First pass: every task counts the n-grams of its texts by hash and sends them, packed, to hash partitions. There
the counts of all tasks are merged into a Misra-Gries summary whose capacity exceeds the partition's mass divided
by the least count, so that every n-gram that occurs often enough survives. Second pass: the n-grams that survived
are counted exactly, by their words; a bit table of bounded size, sent to all tasks, tells which may have survived.
Where it fills up, more n-grams are counted than need be, and no count changes.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickwright.functions import whole_quotient
from tickwright.llm.hashing import BASE, Powers, mixed, word_hashes
from tickwright.session import shared_dir

LONGEST = 3
LEAST = 10
TOP = 2000
#: Bytes of text whose n-grams make up a hash partition, on average.
PARTITION_BYTES = 8_000_000
#: Characters of text counted at once, and n-grams a task gathers before it sends them on.
GROUP_CHARS = 4_000_000
GATHERED = 2_000_000
#: The bit table: bits for each survivor, and at most (32 MB).
BITS_EACH, MOST_BITS = 16, 1 << 28
#: Bits of the table in one of its pieces.
PIECE = 1 << 19
#: Parts in which each language's candidates are ranked before the best of each are ranked together.
RANK_PARTS = 64

_BREAKS = b".,;:!?\n\v\f\r"
# Upper case to lower, breaks to spaces: what is left between spaces are words.
_TO_WORDS = bytes(0x20 if c in _BREAKS or c == 0x09 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_IS_BREAK = np.isin(np.arange(256), list(_BREAKS))
_IN_WORD = np.array([c != 0x20 for c in _TO_WORDS])


class Grams:
    """The n-grams of texts of one language: distinct ones by their words' numbers, and how often each occurs."""

    def __init__(self, texts: list[str], longest: int):
        raw = "\n".join(texts).encode()
        words = raw.translate(_TO_WORDS).split(b" ")
        words = [w for w in words if w]
        ids, self.words = pd.factorize(np.array(words, dtype=object))
        self.n_words = len(words)
        data = np.frombuffer(raw, np.uint8)
        starts = np.flatnonzero(np.diff(_IN_WORD[data], prepend=False) & _IN_WORD[data])
        piece = np.cumsum(_IS_BREAK[data], dtype=np.int32)[starts] if len(starts) else starts
        #: For each size the words of the distinct n-grams (a row each) and their counts.
        self.grams, self.counts = [], []
        whole, gram = np.arange(len(ids)), ids
        shown = np.empty((0, 0), np.int64)
        for size in range(1, longest + 1):
            if size > 1:
                inside = piece[whole[: np.searchsorted(whole, len(ids) - size + 1)]]
                fits = whole[: len(inside)]
                stays = inside == piece[fits + size - 1]
                whole = fits[stays]
                key = gram[: len(inside)][stays] * len(self.words) + ids[whole + size - 1]
                gram, _ = pd.factorize(key)
            n = int(gram.max(initial=-1)) + 1
            first = np.empty(n, np.int64)
            first[gram[::-1]] = whole[::-1]
            shown = ids[first[:, None] + np.arange(size)]
            self.grams.append(shown)
            self.counts.append(np.bincount(gram, minlength=n))

    def hashes(self, language: str) -> list[np.ndarray]:
        """For each size the hashes of its distinct n-grams, the same in every task."""
        known = Powers()
        of_word = word_hashes(list(self.words), known)[0]
        seed = word_hashes([b"x" + language.encode().hex().encode()], known)[0][0]
        out = []
        for shown in self.grams:
            h = np.full(len(shown), seed, np.uint64)
            for k in range(shown.shape[1]):
                h = mixed(h * BASE + of_word[shown[:, k]])
            out.append(h)
        return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[str]]]:
    """Texts by language, about ``GROUP_CHARS`` at a time."""
    group: dict[str, list[str]] = {}
    chars = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            group.setdefault(lang, []).append(text)
            chars += len(text)
            if chars >= GROUP_CHARS:
                yield group
                group, chars = {}, 0
    if group:
        yield group


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[new], np.add.reduceat(counts[order].astype(np.int64), new) if len(new) else np.empty(0, np.int64)


def _address(hashes: np.ndarray, partitions: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash partition of each n-gram, and its key there. Two that share a key are counted as one: more survive."""
    return ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(partitions)).astype(np.int64), (hashes >> np.uint64(32)).astype(np.uint32)


def _bits(partition: np.ndarray | int, keys: np.ndarray, n_bits: int) -> np.ndarray:
    """Two places in the bit table for each n-gram."""
    h = mixed((np.asarray(partition).astype(np.uint64) << np.uint64(32)) | keys.astype(np.uint64))
    mask = np.uint64(n_bits - 1)
    return np.stack([h & mask, (h >> np.uint64(32)) & mask]).astype(np.int64)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in the smallest type that holds them, which its first byte names."""
    width = next(w for w in (1, 2, 4, 8) if counts.max(initial=0) < 1 << (8 * w - 1))
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _wide(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


class MisraGries:
    """A summary that can be merged: counters for at most ``capacity`` keys, and how much each may lack."""

    def __init__(self, capacity: int):
        self.capacity, self.lacks = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, lacks: int = 0) -> None:
        self.keys, self.counts = _summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        self.lacks += lacks
        if len(self.keys) > self.capacity:
            cut = int(np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1])
            self.counts = self.counts - cut
            self.lacks += cut
            stays = self.counts > 0
            self.keys, self.counts = self.keys[stays], self.counts[stays]

    def may_reach(self, least: int) -> np.ndarray:
        """Keys that may occur ``least`` times."""
        return self.keys[self.counts + self.lacks >= least]


def survivors(texts: DataFrame, partitions: int, longest: int, least: int) -> DataFrame:
    """First pass: for each hash partition the keys (packed) of all n-grams that may occur ``least`` times."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def sent() -> pd.DataFrame:
            packed, counts = _summed(*map(np.concatenate, zip(*held)))
            held.clear()
            home = (packed >> np.uint64(32)).astype(np.int64)
            edges = np.flatnonzero(np.diff(home, prepend=-1, append=-1))
            rows = [
                (int(home[a]), (packed[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), _narrow(counts[a:b]))
                for a, b in zip(edges[:-1], edges[1:])
            ]
            return pd.DataFrame(rows, columns=["part", "keys", "counts"])

        for group in _groups(batches):
            for language, parts in group.items():
                grams = Grams(parts, longest)
                for hashes, counts in zip(grams.hashes(language), grams.counts):
                    home, keys = _address(hashes, partitions)
                    held.append(((home.astype(np.uint64) << np.uint64(32)) | keys, counts.astype(np.uint32)))
                    size += len(hashes)
                del grams
                if size >= GATHERED:
                    yield sent()
                    size = 0
        if size:
            yield sent()

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        mass = sum(int(_wide(c).sum()) for c in rows["counts"])
        summary = MisraGries(mass // least + 1)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for keys, counts in zip(rows["keys"], rows["counts"]):
            waiting.append((np.frombuffer(keys, "<u4"), _wide(counts)))
            n += len(waiting[-1][0])
            if n >= summary.capacity:
                summary.merge(*map(np.concatenate, zip(*waiting)))
                waiting, n = [], 0
        if waiting:
            summary.merge(*map(np.concatenate, zip(*waiting)))
        kept = summary.may_reach(least)
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "n": [len(kept)], "keys": [kept.astype("<u4").tobytes()]})

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gather(batches):
            yield pa.RecordBatch.from_pandas(rows, preserve_index=False)

    packed = texts.mapInArrow(batches_of, "part long, keys binary, counts binary")
    return packed.groupBy("part").applyInPandas(merge, "part long, n long, keys binary")


def bit_table(kept: DataFrame) -> np.ndarray:
    """The survivors' bits. The table's size follows their number up to ``MOST_BITS``, 32 MB; it is made in pieces."""
    n = kept.agg(F.sum("n")).first()[0] or 0
    n_bits = PIECE
    while n_bits < min(MOST_BITS, n * BITS_EACH):
        n_bits *= 2

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, keys in zip(batch["part"], batch["keys"]):
                bits = np.unique(_bits(int(part), np.frombuffer(keys, "<u4"), n_bits))
                piece = bits // PIECE
                edges = np.flatnonzero(np.diff(piece, prepend=-1, append=-1))
                rows = [(int(piece[a]), (bits[a:b] % PIECE).astype("<u4").tobytes()) for a, b in zip(edges[:-1], edges[1:])]
                yield pd.DataFrame(rows, columns=["piece", "places"])

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        piece = np.zeros(PIECE, bool)
        for packed in rows["places"]:
            piece[np.frombuffer(packed, "<u4")] = True
        return pd.DataFrame({"piece": [int(rows["piece"].iloc[0])], "bits": [np.packbits(piece).tobytes()]})

    pieces = kept.mapInPandas(places, "piece long, places binary").groupBy("piece").applyInPandas(fill, "piece long, bits binary")
    table = np.zeros(n_bits // 8, np.uint8)
    for piece, bits in pieces.toLocalIterator():
        table[piece * PIECE // 8 : (piece + 1) * PIECE // 8] = np.frombuffer(bits, np.uint8)
    return table


def exact_counts(spark: SparkSession, texts: DataFrame, kept: DataFrame, partitions: int, longest: int, least: int) -> DataFrame:
    """Second pass: ``lang``, ``size``, ``phrase`` and ``f`` of all n-grams that occur ``least`` times, and each
    language's number of words as the empty phrase of size 0."""
    table = spark.sparkContext.broadcast(bit_table(kept))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for group in _groups(batches):
            for language, parts in group.items():
                grams = Grams(parts, longest)
                sizes, phrases, counts = [0], [""], [grams.n_words]
                for size, (shown, n, hashes) in enumerate(zip(grams.grams, grams.counts, grams.hashes(language)), 1):
                    at = _bits(*_address(hashes, partitions), len(bits) * 8)
                    hit = np.flatnonzero(((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0))
                    words = [grams.words[shown[hit, k]] for k in range(size)]
                    phrases += [b" ".join(w).decode() for w in zip(*words)]
                    sizes += [size] * len(hit)
                    counts += n[hit].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(sizes)), pa.array(sizes, pa.int32()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())],
                    names=["lang", "size", "phrase", "f"],
                )

    counted = texts.mapInArrow(count, "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("size") == 0))


def _scored(counts: DataFrame) -> DataFrame:
    """Each phrase of two or more words with its lowest-scoring cut."""
    phrases = counts.where("size > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.expr("array_join(slice(w, 1, k), ' ')").alias("left"),
        F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("right"),
    )
    parts = counts.where("size > 0").select("lang", "phrase", "f")
    of_left = parts.toDF("lang", "left", "l")
    of_right = parts.toDF("lang", "right", "r")
    measured = cuts.join(of_left, ["lang", "left"]).join(of_right, ["lang", "right"])
    wide = {name: f"CAST({name} AS DECIMAL(38,0))" for name in "alr"}
    score = whole_quotient(f"(CAST({wide['a']} * {wide['a']} AS DECIMAL(31,0)) * 1000000)", f"({wide['l']} * {wide['r']})")
    least = F.min(F.struct(F.expr(score).cast("long").alias("score"), "k", "l", "r")).alias("cut")
    return measured.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _within_longer(counts: DataFrame) -> DataFrame:
    """Phrases that lie within a longer one at least half as frequent, with the count of the most frequent such."""
    longer = counts.where("size > 2").select("lang", "f", F.split("phrase", " ").alias("w"))
    inner = longer.select("lang", "f", F.explode(F.expr(
        "flatten(transform(sequence(2, size(w) - 1), n -> transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' '))))"
    )).alias("phrase"))
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    spark: SparkSession, docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words ``[^\\x20\\x09]+``. A
    candidate is a phrase of 2 to ``longest`` words that occurs ``least`` times in its language, ``a``; cut after
    its first words into parts that occur l and r times it has the score floor(1000000 a a / (l r)), at its
    lowest-scoring cut, of equal ones the first. Candidates within a longer one at least half as frequent are left
    out. ``n`` is the number of words of the language. ``top`` is how many are reported.

    A null lang is ``und``; a null or empty text has no words; repeated rows count each time; other columns, ids
    included, are not looked at; an empty table gives no rows. Scores are exact while 1000000 a a has 38 digits.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text IS NOT NULL")
    mass = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(1, -(-mass // PARTITION_BYTES))
    kept_path, counts_path = shared_dir(spark, "survivors"), shared_dir(spark, "phrase-counts")
    survivors(texts, partitions, longest, least).write.parquet(kept_path)
    kept = spark.read.parquet(kept_path)
    exact_counts(spark, texts, kept, partitions, longest, least).write.parquet(counts_path)
    counts = spark.read.parquet(counts_path)

    n = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    left = _scored(counts).join(_within_longer(counts), ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 50 * a")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each part first, so that no task ranks all candidates of a language.
    parted = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    ranked = parted.withColumn("place", in_part).where(F.col("place") <= top).withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
