"""Documents that contain test items, by a BM25 index of the items and block-max WAND.

The index is over the items, which are few; every passage of every document is a query. An item's scores are
divided by what its own words would score, so one threshold holds for all items. Where documents lie, they
are searched: nothing is shuffled.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickwright.llm.hashing import Powers, word_hashes

#: Share of an item's own score that a passage must reach to be looked at.
THRESHOLD = 0.6
#: Share of the words of the question, and of the answer, that must stand in the passage in order.
OVERLAP = 0.8
#: A passage must share so many words in a row with an item; shorter items can't be told from chance.
SHINGLE = 5
#: The last part of an item is its answer.
ANSWER_SHARE = 0.25
K1, B = 1.2, 0.75
#: Neighbouring items whose postings of a term make a block; a block's largest weight is kept.
BLOCK = 16
#: Items that are searched for in one pass over the documents, and characters of them at most: the bound on
#: what is sent to every task.
ITEMS_PER_PASS = 20_000
CHARS_PER_PASS = 20_000_000
CHUNK_CHARS = 4_000_000
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(texts: list[str]) -> list[np.ndarray]:
    """Hashes of each text's words: runs of digits, letters and anything beyond ASCII, in lower case."""
    hashes, counts = word_hashes([t.lower().encode() for t in texts], Powers(), _IN_WORD)
    return np.split(hashes, np.cumsum(counts)[:-1]) if texts else []


@dataclass(frozen=True)
class Leak:
    item: int | None
    score: float
    question_overlap: float
    answer_overlap: float
    first_word: int


class Index:
    """Postings by term: item, weight as a share of the item's own score, and the largest weight by block."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], frequency: dict[int, int], n_items: int, mean_words: float):
        self.ids = [item_id for item_id, _ in items]
        self.words = [words for _, words in items]
        self.stride = max([len(w) for w in self.words], default=1)
        postings: dict[int, list[tuple[int, float]]] = {}
        for k, words in enumerate(self.words):
            terms, counts = np.unique(words, return_counts=True)
            n = np.array([frequency[int(t)] for t in terms])
            idf = np.log(1 + (n_items - n + 0.5) / (n + 0.5))
            impact = idf * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(words) / mean_words))
            for term, weight in zip(terms.tolist(), (impact / impact.sum()).tolist()):
                postings.setdefault(term, []).append((k, weight))
        self.terms = np.array(sorted(postings), np.uint64)
        lists = [postings[t] for t in self.terms.tolist()]
        self.items = [[k for k, _ in found] for found in lists]
        self.weights = [[w for _, w in found] for found in lists]
        self.blocks = [self._blocks(found) for found in lists]
        self._lay_out_bounds(len(items))
        self.shingles = [
            {tuple(w[k : k + SHINGLE].tolist()): k for k in range(len(w) - SHINGLE + 1)} for w in self.words
        ]

    @staticmethod
    def _blocks(found: list[tuple[int, float]]) -> dict[int, tuple[int, int, float]]:
        """By block of items: the postings from, to, and the largest weight among them."""
        blocks: dict[int, tuple[int, int, float]] = {}
        for at, (k, weight) in enumerate(found):
            first, _, most = blocks.get(k // BLOCK, (at, at, 0.0))
            blocks[k // BLOCK] = first, at + 1, max(most, weight)
        return blocks

    def _lay_out_bounds(self, n_items: int) -> None:
        """Largest weights by block, for telling in bulk which blocks a passage can reach the threshold in.

        Frequent terms are left out as long as no item loses more than half the threshold; what is left out
        is added to the bound as if every passage had it.
        """
        left_out = np.zeros(n_items)
        self.frequent = np.zeros(len(self.terms), bool)
        for t in sorted(range(len(self.terms)), key=lambda t: -len(self.items[t])):
            after = left_out[self.items[t]] + self.weights[t]
            if (after <= THRESHOLD / 2).all():
                left_out[self.items[t]] = after
                self.frequent[t] = True
        self.n_blocks = -(-n_items // BLOCK)
        self.block_left_out = np.array([left_out[b * BLOCK : (b + 1) * BLOCK].max() for b in range(self.n_blocks)])
        block, weight, self.block_starts = [], [], np.zeros(len(self.terms) + 1, np.int64)
        for t, blocks in enumerate(self.blocks):
            if not self.frequent[t]:
                block += blocks
                weight += [most for _, _, most in blocks.values()]
            self.block_starts[t + 1] = len(block)
        self.block_numbers, self.block_weights = np.array(block, np.int64), np.array(weight)

    def term_numbers(self, words: np.ndarray) -> np.ndarray:
        """-1 for words that no item has."""
        if not len(self.terms):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def passages(self, numbers: list[np.ndarray]) -> dict[tuple[int, int], list[int]]:
        """By (text, first word) of the passages, the blocks in which they can reach the threshold.

        A passage is two neighbouring cells of as many words as the longest item has, so that any such
        stretch lies within one. Its bound adds up the largest weights of its cells' terms.
        """
        counts = np.array([len(x) for x in numbers])
        cells = np.maximum(-(-counts // self.stride), 1)
        first_cell = np.cumsum(cells) - cells
        flat = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        cell = np.repeat(first_cell, counts) + place // self.stride
        heard = flat >= 0
        heard[heard] &= ~self.frequent[flat[heard]]
        cell, term = np.divmod(np.unique(cell[heard] * len(self.terms) + flat[heard]), max(len(self.terms), 1))
        begin, n = self.block_starts[term], self.block_starts[term + 1] - self.block_starts[term]
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        # Blocks without any such term in a cell can't reach the threshold there.
        keys, which = np.unique(np.repeat(cell, n) * self.n_blocks + self.block_numbers[at], return_inverse=True)
        found: dict[tuple[int, int], list[int]] = {}
        if not len(keys):
            return found
        sums = np.bincount(which, self.block_weights[at], minlength=len(keys))
        cell, block = np.divmod(keys, self.n_blocks)
        text = np.searchsorted(first_cell, cell, "right") - 1

        def other(step: int, inside: np.ndarray) -> np.ndarray:
            """The same block's sum in a neighbouring cell of the same text."""
            k = np.minimum(np.searchsorted(keys, keys + step * self.n_blocks), len(keys) - 1)
            return np.where(inside & (keys[k] == keys + step * self.n_blocks), sums[k], 0.0)

        bound = sums + self.block_left_out[block] + 1e-9
        has_next, has_before = cell < first_cell[text] + cells[text] - 1, cell > first_cell[text]
        as_first = bound + other(1, has_next) >= THRESHOLD
        as_second = has_before & (bound + other(-1, has_before) >= THRESHOLD)
        for flags, back in ((as_first, 0), (as_second, 1)):
            for c, k, b in zip(cell[flags] - back, text[flags], block[flags].tolist()):
                # The last cell of a long text is the second one of its last passage.
                at_cell = min(c - first_cell[k], max(cells[k] - 2, 0))
                blocks = found.setdefault((int(k), int(at_cell) * self.stride), [])
                if b not in blocks:
                    blocks.append(b)
        return found

    def retrieve(self, numbers: np.ndarray, blocks: list[int]) -> list[tuple[int, float]]:
        """All items of these blocks whose score for the passage reaches the threshold, by block-max WAND."""
        terms = np.unique(numbers[numbers >= 0]).tolist()
        found = []
        for b in sorted(blocks):
            here = [(t, *self.blocks[t][b]) for t in terms if b in self.blocks[t]]
            if sum(most for *_, most in here) + 1e-9 >= THRESHOLD:
                found += self._retrieve_in_block(here)
        return found

    def _retrieve_in_block(self, here: list[tuple[int, int, int, float]]) -> Iterator[tuple[int, float]]:
        """``here``: terms with their block's postings from, to, and largest weight."""
        cursor = {t: at for t, at, _, _ in here}
        while True:
            live = sorted((self.items[t][cursor[t]], t, most) for t, _, to, most in here if cursor[t] < to)
            total, pivot = 0.0, None
            for item, _, most in live:
                total += most
                if total + 1e-9 >= THRESHOLD:
                    pivot = item
                    break
            if pivot is None:
                return
            score = 0.0
            for t, _, to, _ in here:
                # Items before the pivot can't reach the threshold.
                while cursor[t] < to and self.items[t][cursor[t]] < pivot:
                    cursor[t] += 1
                if cursor[t] < to and self.items[t][cursor[t]] == pivot:
                    score += self.weights[t][cursor[t]]
                    cursor[t] += 1
            if score + 1e-9 >= THRESHOLD:
                yield pivot, score

    def verify(self, item: int, words: np.ndarray, first: int) -> tuple[float, float, int] | None:
        """Overlaps of question and answer where the passage shares most shingles with the item."""
        own, known = self.words[item], self.shingles[item]
        passage = words[first : first + 2 * self.stride].tolist()
        diagonals: dict[int, int] = {}
        for at in range(len(passage) - SHINGLE + 1):
            k = known.get(tuple(passage[at : at + SHINGLE]))
            if k is not None:
                diagonals[first + at - k] = diagonals.get(first + at - k, 0) + 1
        if not diagonals:
            return None
        start = min(diagonals, key=lambda d: (-diagonals[d], d))
        low = max(0, start - SHINGLE)
        matched = _in_order(own.tolist(), words[low : start + len(own) + SHINGLE].tolist())
        n_question = len(own) - max(1, round(len(own) * ANSWER_SHARE))
        question, answer = matched[:n_question], matched[n_question:]
        return sum(question) / len(question), sum(answer) / len(answer), max(start, 0)

    def leaks(self, texts: list[str]) -> Iterator[tuple[int, Leak]]:
        """(text, leak), for each text and item the leak with the best score."""
        words = words_of(texts)
        numbers = np.split(self.term_numbers(np.concatenate(words)), np.cumsum([len(w) for w in words])[:-1]) if texts else []
        best: dict[tuple[int, int], Leak] = {}
        for (text, first), blocks in self.passages(numbers).items():
            for item, score in self.retrieve(numbers[text][first : first + 2 * self.stride], blocks):
                checked = self.verify(item, words[text], first)
                if checked and checked[0] >= OVERLAP and checked[1] >= OVERLAP:
                    leak = Leak(self.ids[item], score, *checked)
                    known = best.get((text, item))
                    if known is None or (leak.score, -leak.first_word) > (known.score, -known.first_word):
                        best[text, item] = leak
        for (text, _), leak in sorted(best.items()):
            yield text, leak


def _in_order(own: list[int], other: list[int]) -> list[bool]:
    """Which of own's words a longest common subsequence keeps."""
    n, m = len(own), len(other)
    table = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = table[i], table[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if own[i] == other[j] else max(below[j], row[j + 1])
    kept, i, j = [False] * n, 0, 0
    while i < n and j < m:
        if own[i] == other[j]:
            kept[i] = True
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            i += 1
        else:
            j += 1
    return kept


def indexes(items: DataFrame) -> Iterator[Index]:
    """Indexes of all items, each of a bounded number of them.

    Items of fewer than SHINGLE words are left out; an item without an id keeps none, and items with one id are
    separate. The number of passes is told by counts; document frequencies are of all items, whatever the pass.
    """
    # The id travels as text: pandas would make a float of a long with nulls.
    texts = items.select(F.col("item_id").cast("long").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"item_id": batch["item_id"], "words": [w.view(np.int64) for w in words_of(list(batch["text"]))]})

    worded = texts.mapInPandas(run, "item_id string, words array<long>").where(F.size("words") >= SHINGLE)
    n_items, n_words, n_chars = worded.agg(
        F.count("*"), F.sum(F.size("words")), F.sum(F.size("words") * 8)
    ).first()
    if not n_items:
        return
    passes = max(-(-n_items // ITEMS_PER_PASS), -(-n_chars // CHARS_PER_PASS))
    dealt = worded.withColumn("pass", F.pmod(F.xxhash64("item_id", "words"), F.lit(passes)))
    frequency = worded.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    for k in range(passes):
        mine = dealt.where(F.col("pass") == k)
        rows = mine.collect()  # one pass's items, a bounded number
        asked = mine.select(F.explode("words").alias("term")).distinct().join(frequency, "term")
        known = {r.term % (1 << 64): r.n for r in asked.collect()}
        own = sorted(((r.item_id, tuple(r.words)) for r in rows), key=lambda x: (x[0] or "", x[1]))
        yield Index([(None if i is None else int(i), np.array(w, np.int64).view(np.uint64)) for i, w in own], known, n_items, n_words / n_items)


def _chunks(texts: pd.Series) -> Iterator[list[int]]:
    rows, chars = [], 0
    for k, text in enumerate(texts):
        rows.append(k)
        chars += len(text)
        if chars >= CHUNK_CHARS:
            yield rows
            rows, chars = [], 0
    if rows:
        yield rows


SCHEMA = "id string, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def find_leaks(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, first_word: a row for each row of docs and item found in it.

    Null or empty texts hold nothing; a null doc_id stays null, and so does an item's null id; repeated rows are
    searched each, and repeated items are found each; no items or no docs give no rows. Items of fewer than SHINGLE
    words are not searched for. Other columns are left out.
    """
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))

    def search(index: Index) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids = batch["id"].to_numpy()
                for rows in _chunks(batch["text"]):
                    found = [
                        (ids[rows[text]], str(x.item), x.score, x.question_overlap, x.answer_overlap, x.first_word)
                        for text, x in index.leaks([batch["text"].iloc[k] for k in rows])
                    ]
                    out = pd.DataFrame(found, columns=[c.split()[0] for c in SCHEMA.split(", ")])
                    items_found = [None if x == "None" else int(x) for x in out["item_id"]]
                    yield out.assign(item_id=pd.array(items_found, dtype="Int64"))

        return texts.mapInPandas(run, SCHEMA)

    found = spark.createDataFrame([], SCHEMA)
    for index in indexes(items):
        found = found.unionByName(search(index))
    return found.select(F.col("id").cast("long").alias("doc_id"), *found.columns[1:])


def _holds_leak(index: Index):
    @F.pandas_udf("boolean")
    def leaks(texts: pd.Series) -> pd.Series:
        found = np.zeros(len(texts), bool)
        for rows in _chunks(texts):
            for text, _ in index.leaks([texts.iloc[k] for k in rows]):
                found[rows[text]] = True
        return pd.Series(found)

    return leaks


def without_leaks(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, in which no item is found; items need no id for that.

    Null or empty texts hold nothing and stay, as do rows that are repeated and hold no item; without items all
    rows stay.
    """
    for index in indexes(items.select(F.lit(0).alias("item_id"), "text")):
        docs = docs.where(~_holds_leak(index)(F.coalesce("text", F.lit(""))))
    return docs
