"""Periodic runs of words, found on a grammar of the texts.

Re-Pair replaces neighbouring symbols that stand together often by a new one, in rounds over many texts at
once: each round takes the pairs that are at least a quarter as frequent as the most frequent one. What is left
of a text is paired up until one symbol stands for it. Every run of a text crosses the boundary between the two
halves of exactly one symbol, the lowest that covers it. So each symbol is searched once, at its boundary, by
common extensions of words a period apart; what is found is moved to all places where the symbol was set. A run
cut short by its symbol's ends goes on in a higher symbol, which gives it whole; the interval that no neighbouring
word extends is kept.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickwright.llm.hashing import BASE, INVERSE, mixed, powers

LEAST_LENGTH = 12
#: Characters of text whose grammar is made at once, and pairs of a symbol and a period looked at together.
GROUP_CHARS = 4_000_000
CANDIDATES = 1 << 21
#: Words compared one by one before hashes of whole stretches are.
SINGLY = 4
SCHEMA = "id string, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_ROWS = pa.schema(
    [
        ("id", pa.string()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ]
)
Nodes = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element of each part its part, and its number within the part from 0."""
    part = np.repeat(np.arange(len(sizes)), sizes)
    return part, np.arange(len(part)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _every_other(places: np.ndarray) -> np.ndarray:
    """Of places in a row the first, the third and so on."""
    opens = np.diff(places, prepend=-2) > 1
    return places[(places - places[opens][np.cumsum(opens) - 1]) % 2 == 0]


def grammar(ids: np.ndarray, owner: np.ndarray) -> Iterator[Nodes]:
    """Rounds of symbols being set: where each begins, its boundary, where it ended, and its rule's number.

    ``ids`` are words and ``owner`` their texts, in order. Symbols set in a round under one number stand for the
    same words. A round that changes few places ends the search for repeated pairs; all that follows is pairing up.
    """
    symbol, begin, owner = ids.astype(np.int64), np.arange(len(ids)), owner
    end = begin + 1
    n_symbols = int(symbol.max(initial=0)) + 1
    repeats = True
    while len(symbol):
        at = np.flatnonzero(owner[1:] == owner[:-1])
        if not len(at):
            return
        if repeats:
            code, _ = pd.factorize(symbol[at] * n_symbols + symbol[at + 1])
            counts = np.bincount(code)
            frequent = counts[code] >= max(2, counts.max() // 4)
            chosen = _every_other(at[frequent])
            repeats = 400 * len(chosen) > len(symbol)
            rule = pd.factorize(code[np.searchsorted(at, chosen)])[0]
        else:
            chosen = _every_other(at)
            rule = np.arange(len(chosen))
        if not len(chosen):
            continue
        yield begin[chosen], end[chosen], end[chosen + 1], rule
        symbol[chosen] = n_symbols + rule
        n_symbols += int(rule.max()) + 1
        end[chosen] = end[chosen + 1]
        stays = np.ones(len(symbol), bool)
        stays[chosen + 1] = False
        symbol, begin, end, owner = symbol[stays], begin[stays], end[stays], owner[stays]


class Words:
    """Words of many texts in turn, and how far two stretches of them are equal."""

    def __init__(self, ids: np.ndarray, by_hash: bool = True):
        self.ids, self.by_hash = ids, by_hash
        if by_hash:
            self.down = powers(INVERSE, len(ids))
            self.sums = np.zeros(len(ids) + 1, np.uint64)
            np.cumsum(mixed(ids.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(ids))[: len(ids)], out=self.sums[1:])

    def _equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[a + length] - self.sums[a]) * self.down[a] == (self.sums[b + length] - self.sums[b]) * self.down[b]

    def extension(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words from ``at`` on, in the direction of ``step``, equal those a period later; ``most`` at most."""
        found = np.zeros(len(at), np.int64)
        alive = np.flatnonzero(most > 0)
        done = 0
        while len(alive) and (done < SINGLY or not self.by_hash):
            here = at[alive] + step * done
            alive = alive[self.ids[here] == self.ids[here + period[alive]]]
            done += 1
            found[alive] = done
            alive = alive[most[alive] > done]
        if len(alive):
            found[alive] = self._by_halves(at[alive], period[alive], most[alive], step)
        return found

    def _by_halves(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        low, high = np.full(len(at), SINGLY), most.copy()
        while (open_ := low < high).any():
            half = np.where(open_, (low + high + 1) // 2, low)
            first = at if step > 0 else at - half + 1
            same = self._equal(first, first + period, half)
            low = np.where(same, half, low)
            high = np.where(same, high, half - 1)
        return low

    def crossing(self, begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> Nodes:
        """Runs within each symbol that hold the words on both sides of its middle: symbol, first, end, period."""
        out = []
        sizes = np.minimum(np.minimum(end - middle, middle - begin) * 2, end - begin)  # not more periods than this
        parts = np.cumsum(sizes) // CANDIDATES
        for part in np.unique(parts):
            nodes = np.flatnonzero(parts == part)
            b, m, e = begin[nodes], middle[nodes], end[nodes]
            half = (e - b) // 2
            for right in (True, False):
                node, period = _spread(np.minimum(e - m if right else m - b, half))
                period = period + 1
                anchor = m[node] - 1 if right else m[node] - period
                hit = np.flatnonzero(self.ids[anchor] == self.ids[anchor + period])
                node, period, anchor = node[hit], period[hit], anchor[hit]
                before = self.extension(anchor, period, anchor - b[node] + 1, -1)
                after = self.extension(anchor + 1, period, e[node] - anchor - 1 - period, 1)
                long = before + after >= np.maximum(period, LEAST_LENGTH - period)
                out.append((nodes[node], anchor - before + 1, anchor + 1 + after + period, period, long))
        if not out:
            return (np.empty(0, np.int64),) * 4
        node, first, last, period = (np.concatenate([x[k][x[4]] for x in out]) for k in range(4))
        # Any other period of the same stretch is a multiple of the smallest.
        order = np.lexsort((period, last, first, node))
        node, first, last, period = node[order], first[order], last[order], period[order]
        new = np.ones(len(node), bool)
        new[1:] = (np.diff(node) != 0) | (np.diff(first) != 0) | (np.diff(last) != 0)
        return node[new], first[new], last[new], period[new]

    def hold(self, first: np.ndarray, end: np.ndarray, period: np.ndarray) -> bool:
        """Whether all words of all runs equal those a period later, word by word."""
        sizes = end - first - period
        parts = np.cumsum(sizes) // CANDIDATES
        for part in np.unique(parts):
            runs = np.flatnonzero(parts == part)
            run, k = _spread(sizes[runs])
            at = first[runs][run] + k
            if (self.ids[at] != self.ids[at + period[runs][run]]).any():
                return False
        return True


def find_runs(ids: np.ndarray, owner: np.ndarray, by_hash: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of all texts by place: first word, word after the last, period.

    Extensions found by hash are compared word by word at the end; should one be wrong, all is done over
    without hashes.
    """
    words = Words(ids, by_hash)
    found = []
    for begin, middle, end, rule in grammar(ids, owner):
        wide = np.flatnonzero(end - begin >= LEAST_LENGTH)
        if not len(wide):
            continue
        begin, middle, end, rule = begin[wide], middle[wide], end[wide], rule[wide]
        kinds, shown, kind = np.unique(rule, return_index=True, return_inverse=True)
        node, first, last, period = words.crossing(begin[shown], middle[shown], end[shown])
        if by_hash and not words.hold(first, last, period):
            return find_runs(ids, owner, by_hash=False)
        # To every place of the symbol.
        per_kind = np.bincount(node, minlength=len(kinds))
        place, k = _spread(per_kind[kind])
        run = (np.cumsum(per_kind) - per_kind)[kind[place]] + k
        shift = begin[place] - begin[shown][kind[place]]
        found.append(_maximal(ids, owner, first[run] + shift, last[run] + shift, period[run]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    first, end, period = (np.concatenate([x[k] for x in found]) for k in range(3))
    order = np.lexsort((period, first))
    return first[order], end[order], period[order]


def _maximal(ids: np.ndarray, owner: np.ndarray, first: np.ndarray, end: np.ndarray, period: np.ndarray):
    before, after = np.maximum(first - 1, 0), np.minimum(end, len(ids) - 1)
    grows = (first > 0) & (owner[before] == owner[first]) & (ids[before] == ids[before + period])
    grows |= (end < len(ids)) & (owner[after] == owner[first]) & (ids[after] == ids[after - period])
    return first[~grows], end[~grows], period[~grows]


def _runs_of(texts: list[str]) -> tuple[pa.Array, list[str]]:
    """Runs of each text, and each text without the words that repeat a period of a run."""
    split = [text.encode().split() for text in texts]  # at [\x20\x09-\x0D], as bytes know no other spaces
    sizes = np.array([len(w) for w in split])
    owner = np.repeat(np.arange(len(split)), sizes)
    ids = pd.factorize(np.array([w for words in split for w in words], dtype=object))[0]
    long = sizes[owner] >= LEAST_LENGTH
    of_all = np.flatnonzero(long)
    first, end, period = find_runs(ids[long], owner[long])
    # Words of short texts were left out, of whole texts: lengths stay.
    first, length = of_all[first] if len(first) else first, end - first
    opens = np.cumsum(sizes) - sizes
    text = owner[first] if len(first) else first
    change = np.zeros(len(owner) + 1, np.int64)
    np.add.at(change, first + period, 1)
    np.add.at(change, first + length, -1)
    dropped = np.cumsum(change[:-1]) > 0
    collapsed = []
    touched = np.bincount(text, minlength=len(split)) > 0
    for k, words in enumerate(split):
        if touched[k]:
            away = dropped[opens[k] : opens[k] + len(words)].tolist()
            words = [w for w, gone in zip(words, away) if not gone]
        collapsed.append(b" ".join(words).decode())
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(split)))]).astype(np.int32)
    values = [pa.array(x.astype(np.int64)) for x in (first - opens[text], length, period)]
    runs = pa.StructArray.from_arrays(values, fields=list(_ROWS.field("runs").type.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets), runs).cast(_ROWS.field("runs").type), collapsed


def periodic_runs(docs: DataFrame) -> DataFrame:
    """For each row of docs its ``doc_id``, ``runs`` (array of start, length, period) and ``collapsed`` text.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, numbered from 0. A run is a stretch of words with smallest
    period q, at least 12 words and two periods long, that no neighbouring word extends; runs are ordered by start,
    then period. ``collapsed`` has the words that no run contains after its first q words, one space between.

    A null or empty text has no words, no runs and an empty ``collapsed``. A null doc_id stays null; repeated rows
    are searched each; other columns are left out; no rows give no rows. Nothing is shuffled. Memory grows with
    ``GROUP_CHARS`` and with the longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(ids: list, texts: list[str]) -> pa.RecordBatch:
            runs, collapsed = _runs_of(texts)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), runs, pa.array(collapsed, pa.string())], schema=_ROWS)

        ids, texts, chars = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                texts.append(text)
                chars += len(text)
                if chars >= GROUP_CHARS:
                    yield found(ids, texts)
                    ids, texts, chars = [], [], 0
        if ids:
            yield found(ids, texts)

    texts = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, SCHEMA).select(F.col("id").cast("long").alias("doc_id"), "runs", "collapsed")


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where the words of about a tenth of the texts are made periodic from some place on.

    With h the CRC-32 of the decimal doc_id and g a tenth of it, texts with h divisible by 10 have each word from
    place a = g % n on replaced by word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8). A row without id or words
    stays as it is.
    """
    hashed = docs.select(F.col("doc_id").cast("long"), "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    chosen = F.col("h") % 10 == 0
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    parted = hashed.withColumn("words", F.when(chosen, words)).withColumns(
        {"n": F.size("words"), "g": F.expr("h div 10")}
    )
    placed = parted.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END")).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)")
    )
    periodic = F.expr(
        "array_join(transform(sequence(0L, n - 1L), i -> words[CAST(CASE WHEN i < a THEN i ELSE a + (i - a) % p END AS INT)]), ' ')"
    )
    return placed.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """One flat row for each of ``periodic_runs``: the longest run, and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("back"), (-r["period"]).alias("fine"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.withColumn("longest", longest)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.fine")).alias("period"),
        F.expr("1000 * longest.length div -longest.fine").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
