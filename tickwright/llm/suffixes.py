"""Removal of byte strings that occur twice, by a difference cover and blocks of suffixes.

Of every ``v`` neighbouring positions a difference cover samples a few, such that any two suffixes meet a
sampled position of both at one shift below ``v``. Windows of ``length - v + 1`` bytes at the samples are
ranked bucket by bucket; only samples whose rank repeats can stand in a repeated string. Where the ranks of
three samples, ``v`` apart, repeat together, the whole stretch is settled. The other suffixes are compared
one bucket at a time by the fewer than ``v`` bytes before and after a ranked window, whose rank stands for
the long tie between them, so memory is bounded by the bucket and not by how long the ties are.

Texts lie in chunks, laid out one after another on a line on which every text begins at a multiple of ``v``;
sampled positions travel as packed numbers of a chunk and bucket. What repeats within a chunk is settled there:
its bucket gets one of it, so a passage that a third of all texts share costs a bucket a place for each chunk.

Passages of a number of words are strings over codes of words: all lengths and places are then multiples of
a code's bytes, the ``unit``. Where they are looked for beside the strings of bytes, only texts that share a mark
(``passage_marks``) with another place are searched; equal passages have equal marks.
"""

import hashlib
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickwright.llm.hashing import BASE, SEGMENT, Powers, mixed, powers, prefixes, window_hashes, word_edges, word_hashes

LENGTH = 400
#: Text of a chunk at least, and at most if no one text is larger.
CHUNK_BYTES = 2_000_000, 32_000_000
#: Text for which a bucket holds samples, on average. A task holds one bucket: this bounds its memory, at any size.
BUCKET_BYTES = 64_000_000
#: Bits of a window's hash that travel besides its bucket's number.
KEY_BITS = 40
#: Bytes of a word's hash that stand for it where passages are told by words; a wrong one needs all others to agree.
WORD_BYTES = 5

# Perfect difference sets, by their modulus. Each difference but 0 occurs once.
COVERS = {
    1: [0],
    3: [0, 1],
    7: [0, 1, 3],
    13: [0, 1, 3, 9],
    31: [0, 1, 3, 8, 12, 18],
    57: [0, 1, 3, 13, 32, 36, 43, 52],
    133: [0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109],
}

_SECOND = np.uint64(0xD6E8FEB86659FD93)


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The largest modulus up to a third of the length, and its cover."""
    v = max(m for m in COVERS if m <= max(1, length // 3))
    return v, np.array(COVERS[v])


def packed(numbers: np.ndarray, n_bytes: int) -> bytes:
    """The low bytes of each number, byte by byte: equal high bytes then compress to nothing."""
    return np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8)[:, :n_bytes].T.tobytes()


def unpacked(data: bytes, n_bytes: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(n_bytes, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :n_bytes] = planes.T
    return out.view("<u8").ravel()


def packed_places(places: np.ndarray) -> bytes:
    """Ascending places as their differences."""
    return packed(np.diff(places, prepend=0).astype(np.uint64), 5)


def unpacked_places(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, 5).astype(np.int64))


class Line:
    """A chunk's texts on one line, with at least ``v`` free places between two of them."""

    def __init__(self, chunk: pd.DataFrame, v: int):
        rows = chunk.drop_duplicates(["a", "b"]).sort_values(["a", "b"])
        unzip = zstandard.ZstdDecompressor()
        self.a, self.b = rows["a"].to_numpy(), rows["b"].to_numpy()
        texts = [unzip.decompress(z) for z in rows["z"]]
        self.sizes = np.array([len(t) for t in texts], np.int64)
        taken = -(-(self.sizes + v) // v) * v
        self.starts = np.cumsum(taken) - taken + v
        self.bytes = np.zeros(int(taken.sum()) + 2 * v, np.uint8)
        for start, text in zip(self.starts, texts):
            self.bytes[start : start + len(text)] = np.frombuffer(text, np.uint8)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1

    def samples(self, length: int, v: int, cover: np.ndarray) -> np.ndarray:
        """The cover's places whose window lies in its text, for texts that can hold a repeated string."""
        window = length - v + 1
        found = [np.zeros(0, np.int64)]
        for start, size in zip(self.starts, self.sizes):
            if size >= length:
                at = (np.arange(0, size, v)[:, None] + cover[None, :]).ravel()
                found.append(start + at[at + window <= size])
        return np.concatenate(found)

    def hashes(self, places: np.ndarray, window: int) -> np.ndarray:
        """Of the windows at ascending places, in segments of the line."""
        out = np.empty(len(places), np.uint64)
        known = Powers()
        done = 0
        while done < len(places):
            low = places[done]
            to = int(np.searchsorted(places, low + SEGMENT))
            at = places[done:to] - low
            sums = prefixes(self.bytes[low : places[to - 1] + window], known)
            out[done:to] = window_hashes(sums, at, at + window, known)
            done = to
        return out


def _by_bucket(chunk: int, bucket: np.ndarray, order: np.ndarray, **columns: Callable[[np.ndarray], bytes]) -> pd.DataFrame:
    """A row for each bucket, its columns made from the indexes of its places in ascending order."""
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    rows = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        at = order[lo:hi]
        rows.append((int(bucket[at[0]]), chunk, *[make(at) for make in columns.values()]))
    return pd.DataFrame(rows, columns=["bucket", "chunk", *columns])


def _rows(parts: list[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
    """The parts that have rows, with all columns; what a part lacks is null."""
    some = [p for p in parts if len(p)]
    return pd.concat(some).reindex(columns=columns).astype(object).where(lambda x: x.notna(), None) if some else pd.DataFrame(columns=columns)


def _per_row(rows: pd.DataFrame, counts: list[int], flags: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The chunk of each row that has flagged elements, and which."""
    after = np.cumsum(counts)
    for chunk, lo, hi in zip(rows["chunk"], after - counts, after):
        if flags[lo:hi].any():
            yield chunk, np.flatnonzero(flags[lo:hi]) + lo


def _repeats(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which elements equal another in all keys, and which are the first of their kind."""
    order = np.lexsort(keys[::-1])
    same = np.ones(len(order), bool)
    same[:1] = False
    for key in keys:
        same[1:] &= key[order][1:] == key[order][:-1]
    again, first = np.zeros(len(order), bool), np.zeros(len(order), bool)
    first[order] = ~same
    again[order] = same | np.append(same[1:], False)
    return again, first


class Blocks:
    """The steps, each a function of one chunk's or one bucket's rows.

    ``kind`` tells what a row's places are. Of those that repeat within a chunk the first goes to its bucket
    as ``several``; the others are decided and only pass through any bucket, by the chunk's number.
    """

    def __init__(self, length: int, buckets: int, unit: int = 1):
        self.length, self.buckets = length, buckets
        v, cover = cover_for(length // unit)
        self.v, self.cover = v * unit, cover * unit
        self.window = length - self.v + unit
        self.side = self.v - unit
        # A suffix k places before a ranked window shares the k bytes before it and side - k after it, so at
        # least half of the bytes on one side: those who share half before and those who share half behind
        # meet apart. For each family: first and last k, bytes sent from before and after, bytes that must agree.
        half = -(-self.side // 2)
        self.families = {
            "before": (half, self.side, self.side, self.side - half, half),
            "after": (0, half - 1, half - 1, self.side, self.side - half + 1),
        }

    def _named(self, hashes: np.ndarray) -> np.ndarray:
        """Names with their bucket in the upper bits."""
        bits = np.uint64(KEY_BITS)
        return ((hashes >> bits) % np.uint64(self.buckets)) << bits | hashes & np.uint64((1 << KEY_BITS) - 1)

    def _through(self, chunk: int, kind: str, places: np.ndarray, **columns) -> pd.DataFrame:
        """What is decided already."""
        if not len(places):
            return pd.DataFrame()
        return pd.DataFrame([{"bucket": chunk % self.buckets, "chunk": chunk, "kind": kind, "places": packed_places(places)} | columns])

    def name_samples(self, chunk: pd.DataFrame) -> pd.DataFrame:
        """Chunk to buckets: place and key of every sample."""
        line, number = Line(chunk, self.v), int(chunk["chunk"].iloc[0])
        places = np.sort(line.samples(self.length, self.v, self.cover))
        names = self._named(line.hashes(places, self.window))
        again, first = _repeats(names)
        rest = again & ~first
        rows = [self._through(number, "ranked", places[rest], keys=packed(names[rest], 8))]
        for kind, flags in (("one", ~again), ("several", again & first)):
            rows.append(self._keyed_rows(number, kind, places[flags], names[flags]))
        return _rows(rows, ["bucket", "chunk", "kind", "places", "keys"])

    def _keyed_rows(self, chunk: int, kind: str, places: np.ndarray, names: np.ndarray, **columns) -> pd.DataFrame:
        bucket = (names >> np.uint64(KEY_BITS)).astype(np.int64)
        return _by_bucket(
            chunk,
            bucket,
            np.argsort(bucket, kind="stable"),
            kind=lambda _: kind,
            places=lambda at: packed_places(places[at]),
            keys=lambda at: packed(names[at], KEY_BITS // 8),
            **columns,
        )

    def rank_samples(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Bucket to chunks: the samples whose window occurs again; their name is their rank."""
        bucket = np.uint64(rows["bucket"].iloc[0]) << np.uint64(KEY_BITS)
        through, rows = rows[rows["kind"] == "ranked"], rows[rows["kind"] != "ranked"]
        found = list(through[["chunk", "places", "keys"]].itertuples(index=False, name=None))
        if len(rows):
            places = [unpacked_places(p) for p in rows["places"]]
            keys = np.concatenate([unpacked(k, KEY_BITS // 8) for k in rows["keys"]])
            counts = [len(p) for p in places]
            again = _repeats(keys)[0] | np.repeat((rows["kind"] == "several").to_numpy(), counts)
            at = np.concatenate(places)
            found += [(chunk, packed_places(at[k]), packed(keys[k] | bucket, 8)) for chunk, k in _per_row(rows, counts, again)]
        return pd.DataFrame(found, columns=["chunk", "places", "keys"])

    def chain_ranks(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Chunk to buckets: each ranked sample with the ranks of the samples ``v`` before and after it, or 0."""
        places = np.concatenate([unpacked_places(p) for p in rows["places"]])
        names = np.concatenate([unpacked(k, 8) for k in rows["keys"]])
        order = np.argsort(places, kind="stable")
        places, names = places[order], names[order]

        def at(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            k = np.minimum(np.searchsorted(places, wanted), len(places) - 1)
            return names[k], places[k] == wanted

        (before, has_before), (after, has_after) = at(places - self.v), at(places + self.v)
        chain = mixed(mixed(before * BASE + names) * BASE + after) | np.uint64(1)
        chain[~(has_before & has_after)] = 0
        again, first = _repeats(names, chain)
        number = int(rows["chunk"].iloc[0])
        out = [
            self._through(number, "settled", places[~first & (chain > 0)]),
            self._through(number, "compare", places[~first & (chain == 0)]),
        ]
        for kind, flags in (("one", ~again), ("several", again & first)):
            chains = chain[flags]
            out.append(
                self._keyed_rows(number, kind, places[flags], names[flags], chains=lambda k, c=chains: packed(c[k], 8))
            )
        return _rows(out, ["bucket", "chunk", "kind", "places", "keys", "chains"])

    def settle(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Bucket to chunks: samples settled by their chains, and samples to compare.

        Settled ones are compared only where others of their rank are open, one for each chain.
        """
        decided = rows["kind"].isin(["settled", "compare"])
        found = list(rows[decided][["chunk", "kind", "places"]].itertuples(index=False, name=None))
        rows = rows[~decided]
        if len(rows):
            places = [unpacked_places(p) for p in rows["places"]]
            at, counts = np.concatenate(places), [len(p) for p in places]
            keys = np.concatenate([unpacked(k, KEY_BITS // 8) for k in rows["keys"]])
            chains = np.concatenate([unpacked(c, 8) for c in rows["chains"]])
            again, first = _repeats(keys, chains)
            settled = (again | np.repeat((rows["kind"] == "several").to_numpy(), counts)) & (chains > 0)
            open_ = np.isin(keys, np.unique(keys[~settled]))
            for kind, flags in (("settled", settled), ("compare", ~settled | (open_ & first))):
                found += [(chunk, kind, packed_places(at[k])) for chunk, k in _per_row(rows, counts, flags)]
        return pd.DataFrame(found, columns=["chunk", "kind", "places"])

    def contexts(self, chunk: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """Chunk to buckets: the samples to compare with the bytes around their windows, once for each family."""
        columns = ["bucket", "chunk", "kind", "family", "places", "names", "room", "around"]
        if chunk.empty or rows.empty:
            return pd.DataFrame(columns=columns)
        line, number = Line(chunk, self.v), int(chunk["chunk"].iloc[0])
        places = np.sort(np.concatenate([unpacked_places(p) for p in rows["places"]]))
        text = line.text_of(places)
        left = np.minimum(self.side, places - line.starts[text])
        right = np.minimum(self.side, line.starts[text] + line.sizes[text] - places - self.window)
        names, second = line.hashes(places, self.window), _second_hashes(line, places, self.window)
        out = []
        for family, (first_k, last_k, n_before, n_after, near) in self.families.items():
            if last_k < first_k:
                continue
            fits = np.flatnonzero((left if family == "before" else right) >= near)
            if not len(fits):
                continue
            before = line.bytes[places[fits][:, None] - 1 - np.arange(n_before)]
            after = line.bytes[places[fits][:, None] + self.window + np.arange(n_after)]
            around = np.ascontiguousarray(np.hstack([before, after]))
            room = np.minimum(left[fits], n_before), np.minimum(right[fits], n_after)
            # What is the same in all bytes shares every suffix that fits; one of it is compared with others.
            facts = np.hstack([x.astype("<u8")[:, None].view(np.uint8).reshape(len(fits), -1) for x in (names[fits], second[fits], *room)])
            whole = np.ascontiguousarray(np.hstack([facts, around]))
            _, index, same, counts = np.unique(
                whole.view(f"V{whole.shape[1]}").ravel(), return_index=True, return_inverse=True, return_counts=True
            )
            first = index[same] == np.arange(len(fits))
            start, last = places[fits] - np.minimum(room[0], last_k), places[fits] - np.maximum(self.side - room[1], first_k)
            sure = ~first & (start <= last)
            if sure.any():
                runs = packed(start[sure].astype(np.uint64), 5) + packed(last[sure].astype(np.uint64), 5)
                out.append(pd.DataFrame([{"bucket": number % self.buckets, "chunk": number, "kind": "runs", "places": runs}]))
            agreed = (before if family == "before" else after)[:, :near].astype(np.uint64) + np.uint64(1)
            met = mixed(names[fits] ^ mixed((agreed * powers(BASE, near)[:near]).sum(axis=1, dtype=np.uint64)))
            bucket = (met % np.uint64(self.buckets)).astype(np.int64)
            for kind, flags in (("one", counts[same] == 1), ("several", first & (counts[same] > 1))):
                at = np.flatnonzero(flags)
                at = at[np.argsort(bucket[at], kind="stable")]
                out.append(
                    _by_bucket(
                        number,
                        bucket,
                        at,
                        kind=lambda _, kind=kind: kind,
                        family=lambda _, family=family: family,
                        places=lambda k, fits=fits: packed_places(places[fits[k]]),
                        names=lambda k, fits=fits: packed(names[fits[k]], 8) + packed(second[fits[k]], 8),
                        room=lambda k, room=room: packed(room[0][k].astype(np.uint64), 2) + packed(room[1][k].astype(np.uint64), 2),
                        around=lambda k, around=around: around[k].tobytes(),
                    )
                )
        return _rows(out, columns)

    def compare(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Bucket to chunks: the first and last of each run of suffixes that share their string with another."""
        through = rows["kind"] == "runs"
        found = list(rows[through][["chunk", "kind", "places"]].itertuples(index=False, name=None))
        for family in self.families:
            own = rows[rows["family"] == family]
            if len(own):
                found += self._compare_family(own, *self.families[family][:4])
        return pd.DataFrame(found, columns=["chunk", "kind", "places"])

    def _compare_family(self, rows: pd.DataFrame, first_k: int, last_k: int, n_before: int, n_after: int) -> list[tuple]:
        places = [unpacked_places(p) for p in rows["places"]]
        counts = [len(p) for p in places]
        at = np.concatenate(places)
        halves = lambda column, n: [np.concatenate([unpacked(x[i * len(x) // 2 : (i + 1) * len(x) // 2], n) for x in rows[column]]) for i in (0, 1)]
        first, second = halves("names", 8)
        left, right = [x.astype(np.int64) for x in halves("room", 2)]
        several = np.repeat((rows["kind"] == "several").to_numpy(), counts)
        rank = mixed(first ^ mixed(second))
        around = np.frombuffer(b"".join(rows["around"]), np.uint8).reshape(len(at), n_before + n_after)
        shared = np.zeros((len(at), last_k - first_k + 1), bool)
        keep = np.flatnonzero(_repeats(rank)[0] | several)
        rank, left, right, several = rank[keep], left[keep], right[keep], several[keep]
        up = powers(BASE, max(n_before, n_after))
        term = lambda column, power: (around[keep, column].astype(np.uint64) + np.uint64(1)) * up[power]
        before, after = np.zeros(len(keep), np.uint64), np.zeros(len(keep), np.uint64)
        for j in range(first_k):
            before += term(j, j)
        for j in range(self.side - first_k):
            after += term(n_before + j, j)
        # The suffix ``k`` before the sample has ``k`` bytes ahead of the window and the rest behind it.
        for k in range(first_k, last_k + 1):
            fits = np.flatnonzero((left >= k) & (right >= self.side - k))
            key = mixed(rank[fits] + mixed(before[fits] * BASE + mixed(after[fits] ^ _SECOND)))
            repeats = _repeats(key)[0] | several[fits]
            shared[keep[fits[repeats]], k - first_k] = True
            if k < last_k:
                before += term(k, k)
                after -= term(n_before + self.side - 1 - k, self.side - 1 - k)
        found = []
        for chunk, k in _per_row(rows, counts, shared.any(axis=1)):
            edge = np.diff(np.pad(shared[k], ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, begin = np.nonzero(edge == 1)
            _, end = np.nonzero(edge == -1)
            last, start = at[k][row] - first_k - begin, at[k][row] - first_k - end + 1
            found.append((chunk, "runs", packed(start.astype(np.uint64), 5) + packed(last.astype(np.uint64), 5)))
        return found

    def remove(self, chunk: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """Chunk to texts: what is removed of each, and the digest of the rest."""
        columns = ["a", "b", "n_bytes", "n_removed", "kept_sha256", "spans"]
        if chunk.empty:
            return pd.DataFrame(columns=columns)
        line = Line(chunk, self.v)
        depth = np.zeros(len(line.bytes) + 1, np.int32)
        for kind, data in zip(rows["kind"], rows["places"]):
            if kind == "settled":
                places = unpacked_places(data)
                start, end = places - self.v, places + self.v + self.window
            else:
                half = len(data) // 2
                start, last = unpacked(data[:half], 5).astype(np.int64), unpacked(data[half:], 5).astype(np.int64)
                end = last + self.length
            np.add.at(depth, start, 1)
            np.add.at(depth, end, -1)
        gone = np.cumsum(depth)[:-1] > 0
        out = []
        for a, b, start, size in zip(line.a, line.b, line.starts, line.sizes):
            text, cut = line.bytes[start : start + size], gone[start : start + size]
            edge = np.flatnonzero(np.diff(cut.astype(np.int8), prepend=0, append=0))
            digest = hashlib.sha256(text[~cut].tobytes() if len(edge) else text.tobytes()).hexdigest()
            spans = [{"first": int(x), "after": int(y)} for x, y in zip(edge[::2], edge[1::2])]
            out.append((a, b, int(size), int(cut.sum()), digest, spans))
        return pd.DataFrame(out, columns=columns)


def _second_hashes(line: Line, places: np.ndarray, window: int) -> np.ndarray:
    """Sums of the window's scrambled aligned words and their order: not of the polynomial kind."""
    out = np.zeros(len(places), np.uint64)
    offsets = np.arange(0, window - 7, 8) if window >= 8 else np.arange(0)
    view = np.lib.stride_tricks.sliding_window_view(line.bytes, 8)
    for k in offsets:
        word = np.ascontiguousarray(view[places + k]).view("<u8").ravel()
        out = mixed(out + word)
    for k in range(len(offsets) * 8, window):
        out = mixed(out + line.bytes[places + k].astype(np.uint64) + np.uint64(1))
    return out


_CORPUS = "chunk long, a long, b long, z binary"
_SPANS = "array<struct<first:long,after:long>>"
RESULT = f"a long, b long, n_bytes long, n_removed long, kept_sha256 string, spans {_SPANS}"


def _text_hashes(text) -> list:
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit("again"), text).alias("b")]


def _word_codes(raw: bytes, known: Powers) -> bytes:
    """WORD_BYTES for each word."""
    hashes, _ = word_hashes([raw], known)
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()


def _sliding(best: Callable, numbers: np.ndarray, n: int) -> np.ndarray:
    """The best of each n neighbours."""
    width = 1
    while width < n:
        step = min(width, n - width)
        numbers = best(numbers[:-step], numbers[step:])
        width += step
    return numbers


def passage_marks(texts: list[bytes], words: int, known: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of the texts, each once a text, with the text's number and whether the mark stands there twice.

    Of the grams (a third of the words long) in each passage of so many words those of the smallest hash are marked.
    So passages that are equal hold the same mark at the same place, and a text whose marks stand nowhere else has no
    passage that occurs twice.
    """
    hashes, n_words = word_hashes(texts, known)
    gram = max(1, words // 3)
    run, n = words - gram + 1, len(hashes) - words + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    grams = np.zeros(len(hashes) - gram + 1, np.uint64)
    for k in range(gram):
        grams = grams * BASE + hashes[k : k + len(grams)]
    grams = mixed(grams) | np.uint64(1)
    least = _sliding(np.minimum, grams, run)
    owner = np.repeat(np.arange(len(texts)), n_words)
    least[owner[:n] != owner[words - 1 :]] = 0
    beside = np.zeros(run - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.maximum, np.concatenate([beside, least, beside]), run) == grams)
    again, first = _repeats(grams[at], owner[at].astype(np.uint64))
    return grams[at][first], owner[at][first], again[first]


def _with_shared_marks(corpus: DataFrame, words: int) -> DataFrame:
    """``a`` of the texts that have a mark which also stands elsewhere, once for each such mark."""

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unzip, known = zstandard.ZstdDecompressor(), Powers()
        seen: set[int] = set()  # all copies of a text are in one partition
        for batch in batches:
            batch = batch.drop_duplicates("a")
            batch = batch[~batch["a"].isin(seen)]
            seen.update(batch["a"])
            raw = [unzip.decompress(z) for z in batch["z"]]
            part = np.cumsum([len(t) for t in raw]) // SEGMENT
            for lo, hi in itertools.pairwise([0, *(np.flatnonzero(np.diff(part)) + 1), len(raw)]):
                keys, owner, twice = passage_marks(raw[lo:hi], words, known)
                yield pd.DataFrame({"a": batch["a"].to_numpy()[lo:hi][owner], "key": keys.view(np.int64), "twice": twice})

    marks = corpus.mapInPandas(marked, "a long, key long, twice boolean")
    of = Window.partitionBy("key")
    found = marks.select("a", (F.max("twice").over(of) | (F.min("a").over(of) < F.max("a").over(of))).alias("shared"))
    return found.where("shared").select("a")


def buckets_for(total: int, partitions: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """As many buckets as the text asks for, and no fewer than tasks that can run on them."""
    return max(16, partitions, math.ceil(total / bucket_bytes))


def repeated_in_texts(
    spark: SparkSession, texts: DataFrame, length: int, words: bool = False, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """For each different text of ``texts`` (text, a, b), RESULT: what occurs elsewhere in another place.

    With ``words``, ``length`` counts words and all of RESULT is about the texts' codes. Copies of a whole text
    are not seen here. The texts are shuffled once, compressed, and that shuffle is used by the three steps that
    read bytes. There is a bucket for every ``bucket_bytes`` of text.
    """
    corpus, _, buckets = _in_chunks(spark, texts, words, bucket_bytes)
    return _repeated_in_chunks(corpus, buckets, length, words)


def _in_chunks(spark: SparkSession, texts: DataFrame, words: bool, bucket_bytes: int) -> tuple[DataFrame, int, int]:
    """The texts, or their words' codes, compressed and dealt to chunks; how many chunks and buckets there are."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = buckets_for(total, partitions, bucket_bytes)
    least, most = CHUNK_BYTES
    chunk_bytes = min(most, max(least, total // (8 * max(16, partitions))))
    n_chunks = math.ceil(total / chunk_bytes) or 1

    def zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zip_, known = zstandard.ZstdCompressor(level=1), Powers()
        coded = (lambda t: _word_codes(t.encode(), known)) if words else str.encode
        seen: set[tuple[int, int]] = set()  # copies in this task; copies of other tasks meet in the chunk
        for batch in batches:
            fresh = []
            for key in zip(batch["a"], batch["b"]):
                fresh.append(key not in seen)
                seen.add(key)
            batch = batch[fresh]
            yield pd.DataFrame(
                {"chunk": batch["a"] % n_chunks, "a": batch["a"], "b": batch["b"], "z": [zip_.compress(coded(t)) for t in batch["text"]]}
            )

    return texts.mapInPandas(zipped, _CORPUS).repartition(buckets, "chunk"), n_chunks, buckets


def _repeated_in_chunks(corpus: DataFrame, buckets: int, length: int, words: bool) -> DataFrame:
    """RESULT for texts dealt to chunks."""
    unit = WORD_BYTES if words else 1
    blocks = Blocks(length * unit, buckets, unit)
    sampled = corpus.groupBy("chunk").applyInPandas(
        lambda rows: blocks.name_samples(rows), "bucket long, chunk long, kind string, places binary, keys binary"
    )
    ranked = sampled.groupBy("bucket").applyInPandas(
        lambda rows: blocks.rank_samples(rows), "chunk long, places binary, keys binary"
    )
    chained = ranked.groupBy("chunk").applyInPandas(
        lambda rows: blocks.chain_ranks(rows),
        "bucket long, chunk long, kind string, places binary, keys binary, chains binary",
    )
    settled = chained.groupBy("bucket").applyInPandas(
        lambda rows: blocks.settle(rows), "chunk long, kind string, places binary"
    )
    open_ = settled.where("kind = 'compare'").repartition(buckets, "chunk")
    around = corpus.groupBy("chunk").cogroup(open_.groupBy("chunk")).applyInPandas(
        lambda chunk, rows: blocks.contexts(chunk, rows),
        "bucket long, chunk long, kind string, family string, places binary, names binary, room binary, around binary",
    )
    runs = around.groupBy("bucket").applyInPandas(
        lambda rows: blocks.compare(rows), "chunk long, kind string, places binary"
    )
    found = settled.where("kind = 'settled'").unionByName(runs).repartition(buckets, "chunk")
    return corpus.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInPandas(lambda chunk, rows: blocks.remove(chunk, rows), RESULT)


def repeated_spans(
    spark: SparkSession, docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES, words: int | None = None
) -> DataFrame:
    """doc_id, n_bytes, n_removed, kept_sha256 and spans (first, after) for every row of docs.

    Removed are the bytes, of the UTF-8 text, in a string of ``length`` bytes that also starts anywhere
    else in docs; spans are in ascending order and don't touch. A null text is an empty one; a null doc_id
    stays null; repeated rows are copies of each other; no rows give no rows. Other columns are left out.

    With ``words``, n_passages and n_passage_words tell how many stretches and words of the text lie in passages of so
    many words that also occur elsewhere, however short the words are; the gaps between them may differ. They change
    nothing of what is removed.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = texts.select("doc_id", "text", *_text_hashes(F.col("text")))
    corpus, n_chunks, buckets = _in_chunks(spark, hashed.select("text", "a", "b"), False, bucket_bytes)
    found = _repeated_in_chunks(corpus, buckets, length, False)
    n_words = [] if words is None else [F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words")]
    rows = hashed.select("doc_id", F.col("a").alias("row_a"), F.col("b").alias("row_b"), *n_words)
    copied = rows.groupBy("row_a", "row_b").agg(F.count("*").alias("m"), *[F.first("n_words").alias("n_words") for _ in n_words])
    copied = copied.where("m > 1").withColumnsRenamed({"row_a": "copy_a", "row_b": "copy_b"})
    known = found.join(copied, (F.col("a") == F.col("copy_a")) & (F.col("b") == F.col("copy_b")), "left")
    passages = []
    if words is not None:
        known = known.join(_passages(corpus, n_chunks, buckets, words), ["a", "b"], "left")
        all_words = F.col("copy_a").isNotNull() & (F.col("n_words") >= words)
        in_text = lambda c: F.coalesce(c, F.lit(0)).cast("long")
        passages = [
            F.when(all_words, F.lit(1)).otherwise(in_text("n_passages")).cast("long").alias("n_passages"),
            F.when(all_words, F.col("n_words")).otherwise(in_text("n_passage_words")).alias("n_passage_words"),
        ]
    whole = F.col("copy_a").isNotNull() & (F.col("n_bytes") >= length)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_bytes").alias("after")))
    results = known.select(
        "a",
        "b",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(whole, all_of_it).otherwise(F.col("spans")).alias("spans"),
        *passages,
    )
    joined = rows.join(results, (F.col("row_a") == F.col("a")) & (F.col("row_b") == F.col("b")))
    more = [] if words is None else ["n_passages", "n_passage_words"]
    return joined.select("doc_id", "n_bytes", "n_removed", "kept_sha256", "spans", *more)


def _passages(corpus: DataFrame, n_chunks: int, buckets: int, words: int) -> DataFrame:
    """a, b, n_passages and n_passage_words of the texts that hold a passage which also occurs elsewhere."""

    def coded(chunk: pd.DataFrame, among: pd.DataFrame) -> pd.DataFrame:
        unzip, zip_, known = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1), Powers()
        rows = chunk[chunk["a"].isin(among["a"])].drop_duplicates(["a", "b"])
        return rows.assign(z=[zip_.compress(_word_codes(unzip.decompress(z), known)) for z in rows["z"]])

    among = _with_shared_marks(corpus, words).withColumn("chunk", F.pmod("a", F.lit(n_chunks))).repartition(buckets, "chunk")
    codes = corpus.groupBy("chunk").cogroup(among.groupBy("chunk")).applyInPandas(coded, _CORPUS).repartition(buckets, "chunk")
    found = _repeated_in_chunks(codes, buckets, words, True).where("n_removed > 0")
    # Whole words; a span within codes that agree by chance is narrowed to them.
    first, after = f"(s.first + {WORD_BYTES - 1}) div {WORD_BYTES}", f"s.after div {WORD_BYTES}"
    stretches = F.expr(f"filter(transform(spans, s -> {after} - {first}), n -> n >= {words})")
    return found.select("a", "b", stretches.alias("n")).select(
        "a", "b", F.size("n").alias("n_passages"), F.expr("aggregate(n, 0L, (x, y) -> x + y)").alias("n_passage_words")
    )


def without_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """docs with repeated strings cut out of ``text`` and ``n_chars`` counted anew, where docs has it.

    With ``words``, passages of so many words that occur twice go, however short they are; the gaps between the
    words may differ, and go with them. Strings of bytes are then looked for among the texts in which ``length``
    bytes somewhere hold fewer whole words: any other such string holds a passage. A span that begins or ends within
    a character is narrowed to whole characters. Rows whose text is all repeated stay with an empty text; null texts
    stay null.
    """
    # The row travels as one column, so that no name of docs can clash.
    a, b = _text_hashes(F.col("text"))
    keyed = docs.select(F.struct("*").alias("row"), a.alias("row_a"), b.alias("row_b"))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    hashed = texts.select("text", *_text_hashes(F.col("text")))

    @F.pandas_udf("boolean")
    def has_sparse_part(text: pd.Series) -> pd.Series:
        return text.map(lambda t: sparse_part(t.encode(), length, words))

    strings = hashed if words is None else hashed.where(has_sparse_part("text"))
    found = repeated_in_texts(spark, strings, length).where("n_removed > 0").select("a", "b", "spans")
    if words is None:
        found, least = found.withColumn("word_spans", F.lit(None).cast(_SPANS)), length
    else:
        passages = repeated_in_texts(spark, hashed, words, words=True).where("n_removed > 0")
        found = found.join(passages.select("a", "b", F.col("spans").alias("word_spans")), ["a", "b"], "full")
        least = min(length, 2 * words - 1)
    copied = hashed.where(F.octet_length("text") >= least).groupBy("a", "b").agg(F.count("*").alias("m"))
    cuts = found.join(copied.where("m > 1"), ["a", "b"], "full").withColumn("cut", F.lit(True))
    joined = keyed.join(cuts, (F.col("row_a") == F.col("a")) & (F.col("row_b") == F.col("b")), "left")

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series, word_spans: pd.Series, copied: pd.Series) -> pd.Series:
        rows = zip(text, spans, word_spans, copied)
        return pd.Series([t if t is None else _cut(t, s, w, c, length, words) for t, s, w, c in rows], dtype=object)

    text = F.col("row.text")
    changed = F.when(F.col("cut"), cut(text, "spans", "word_spans", F.col("m").isNotNull())).otherwise(text)
    new = {"text": changed, "n_chars": F.char_length(changed).cast("long")}
    return joined.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def sparse_part(raw: bytes, length: int, words: int) -> bool:
    """Whether ``length`` neighbouring bytes somewhere hold fewer than ``words`` whole words."""
    edges = word_edges(np.frombuffer(raw, np.uint8))
    if len(raw) < length or len(edges) < 2 * words:
        return len(raw) >= length
    # From just after a word's first byte, or the text's beginning, to a word's last byte, or the text's end.
    first = np.concatenate([[-1], edges[::2]])
    after = np.concatenate([edges[1::2], [len(raw) + 1]])
    return bool((after[words - 1 :] - first[: len(after) - words + 1] > length + 1).any())


def _cut(text: str, spans, word_spans, copied: bool, length: int, words: int | None) -> str:
    """``text`` without its spans in bytes and in codes of words; all of it goes if it is long enough and ``copied``."""
    raw = text.encode()
    if copied and len(raw) >= length:
        return ""
    gone = [] if spans is None else [(s["first"], s["after"]) for s in spans]
    if words is not None and (copied or word_spans is not None):
        edges = word_edges(np.frombuffer(raw, np.uint8))
        if copied and len(edges) >= 2 * words:
            return ""
        # Whole words; a span within codes that agree by chance is narrowed to them.
        whole = [] if word_spans is None else [(-(-s["first"] // WORD_BYTES), s["after"] // WORD_BYTES) for s in word_spans]
        gone += [(int(edges[2 * k]), int(edges[2 * m - 1])) for k, m in whole if m - k >= words]
    joined: list[dict] = []
    for first, after in sorted(gone):
        if joined and first <= joined[-1]["after"]:
            joined[-1]["after"] = max(after, joined[-1]["after"])
        else:
            joined.append({"first": first, "after": after})
    return cut_text(text, joined)


def cut_text(text: str, spans) -> str:
    raw = text.encode()
    inside = lambda at: at < len(raw) and raw[at] & 0xC0 == 0x80  # noqa: E731  within a character
    kept, at = [], 0
    for span in spans:
        first, after = span["first"], span["after"]
        while inside(first):
            first += 1
        while inside(after):
            after -= 1
        if first < after:
            kept.append(raw[at:first])
            at = after
    kept.append(raw[at:])
    return b"".join(kept).decode()
