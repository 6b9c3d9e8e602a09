"""Hashes of all words or byte windows of many texts at once, with NumPy."""

import numpy as np

#: An odd base and its inverse modulo 2**64, for polynomial hashes that can be cut out of prefix sums.
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes hashed at a time. A worker holds some sixty times that for them, and keeps much of it from task to task.
SEGMENT = 1 << 17
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n + 1, np.uint64)
    out[0] = 1
    out[1:] = base
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the base and of its inverse, made longer when needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            self.up, self.down = powers(BASE, 2 * n), powers(INVERSE, 2 * n)


def prefixes(data: np.ndarray, known: Powers) -> np.ndarray:
    """Prefix sums of byte values times powers of the base; one longer than the data."""
    known.reach(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * known.up[: len(data)], out=out[1:])
    return out


def window_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: Powers) -> np.ndarray:
    """Equal bytes have equal hashes, wherever they stand."""
    return mixed((sums[ends] - sums[starts]) * known.down[starts] ^ (ends - starts).astype(np.uint64))


def word_edges(data: np.ndarray, in_word: np.ndarray = ~_SPACE) -> np.ndarray:
    """Where words begin and where they have ended, in turn."""
    return np.flatnonzero(np.diff(in_word[data], prepend=False, append=False))


def word_hashes(texts: list[bytes], known: Powers, in_word: np.ndarray = ~_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts in turn, and how many words each text has.

    Words are runs of the bytes marked in ``in_word``, by default all but ``[\\x20\\x09-\\x0D]``; texts are
    parted by a space, which no table may mark.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(in_word[data], prepend=False))
    starts, ends = edge[::2], edge[1::2]
    hashes = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):  # in segments, so that a very long text needs no more memory than many short ones
        low = starts[done]
        to = max(done + 1, int(np.searchsorted(starts, low + SEGMENT)))
        sums = prefixes(data[low : ends[to - 1]], known)
        hashes[done:to] = window_hashes(sums, starts[done:to] - low, ends[done:to] - low, known)
        done = to
    after = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, after), prepend=0)


def distinct_shingles(texts: list[bytes], size: int, known: Powers) -> tuple[np.ndarray, np.ndarray]:
    """For each text its distinct shingle hashes in ascending order, and how many they are.

    A text with fewer words has its whole sequence as the one shingle, a text without words has none. Texts
    are taken in parts of about SEGMENT bytes: words are held for a part, not for all texts.
    """
    part = np.cumsum([len(t) for t in texts]) // SEGMENT
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(texts)]
    found = [_distinct_shingles(texts[lo:hi], size, known) for lo, hi in zip(edges[:-1], edges[1:])]
    return np.concatenate([values for values, _ in found]), np.concatenate([counts for _, counts in found])


def _distinct_shingles(texts: list[bytes], size: int, known: Powers) -> tuple[np.ndarray, np.ndarray]:
    words, n_words = word_hashes(texts, known)
    n = len(words)
    owner = np.repeat(np.arange(len(texts)), n_words)
    place = np.arange(n) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    length = np.minimum(size, n_words)[owner]
    shingle = np.full(n, 0x51, np.uint64)
    for k in range(size):
        has = k < length
        at = np.minimum(np.arange(n) + k, max(n - 1, 0))
        shingle = np.where(has, mixed(shingle * BASE + words[at]), shingle)
    whole = place + length <= n_words[owner]
    owner, shingle = owner[whole], shingle[whole]
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    return shingle[first], np.bincount(owner[first], minlength=len(texts))
