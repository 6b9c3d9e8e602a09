"""Near-duplicate components against all pairs."""

import random
import time
import tracemalloc

import numpy as np
import pytest

from tests.llm import brute
from tickwright.llm import hashing, minhash
from tickwright.llm.components import components
from tickwright.llm.minhash import near_duplicates

DOCS = "doc_id long, text string, n string, head string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS)


def _edited(rng, words, share):
    return [rng.choice(["x%d" % rng.randrange(1000), w]) if rng.random() < share else w for w in words]


def _corpus(seed):
    """Families of texts with few to many edits, one large, over shared words and a shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = [None, "", " \n\t", "one", "ONE", "one two", "Two One", "a b c", "a b c d e", "a b c d", "x a b c d e", "é É", "É é"]
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 5, 6, 8, 12, 30, 120, 400]))]
        for _ in range(40 if family == 0 else rng.randrange(1, 8)):
            texts.append(" ".join(_edited(rng, base, rng.choice([0, 0.02, 0.05, 0.1, 0.3]))))
    texts += [" ".join([*passage, *[rng.choice(vocabulary) for _ in range(10)]]) for _ in range(20)]
    texts += [texts[20]] * 7 + ["word " * 50_000]
    rng.shuffle(texts)
    return [(i * 3 + 5, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,size", [(1, 2), (2, 2), (3, 5), (4, 1)])
def test_components_equal_all_pairs(spark, seed, size):
    rows = _corpus(seed)
    expected = brute.components(rows, size)
    found = near_duplicates(spark, _frame(spark, rows), size).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    sets = {d: len(brute.shingles(t, size)) for d, t in rows}
    assert {r.doc_id: r.n_shingles for r in found} == sets


@pytest.mark.parametrize("block", [60, 300, 2000])
def test_blocks_of_a_large_neighbourhood(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    rows = _corpus(5)
    found = near_duplicates(spark, _frame(spark, rows), 2).collect()
    assert {r.doc_id: r.component_id for r in found} == brute.components(rows, 2)


@pytest.mark.parametrize("a,b", [("1 2 3 4", "1 2 3 4 5"), ("1 2 3 4 5 6", "1 2 3 4 5"), ("5 1 2 3 4", "1 2 3 4")])
def test_small_sets_are_never_missed(a, b):
    rng = random.Random(0)
    for _ in range(300):
        names = {c: "".join(rng.choices("abcdefgh", k=8)) for c in "123456"}
        texts = [" ".join(names[c] for c in t.split()) for t in (a, b)]
        assert brute.components(list(enumerate(texts)), 1)[1] == 0
        runs = []
        for t in texts:
            values, _ = minhash.distinct_shingles([t.encode()], 1, minhash.Powers())
            runs.append(set(minhash._listed(values).tolist()))
        assert runs[0] & runs[1]
        none = np.zeros(2, bool)
        assert minhash._tree_links(np.array([0, 1]), texts, np.array([0, 1]), none, 1, 80) == [(0, 1)]


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None), (2, "a b c"), (3, None), (4, "")]
    found = sorted(near_duplicates(spark, _frame(spark, rows), 2).collect(), key=str)
    by_id = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found]
    assert sorted(by_id, key=str) == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True), (None, 0, None, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True)],
        key=str,
    )


def test_no_documents(spark):
    assert near_duplicates(spark, _frame(spark, []), 2).count() == 0


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 60)] + [(100 + 2 * i, 102 + 2 * i) for i in range(30)] + [(7, 7), (5, 4)]
    rng.shuffle(chain)
    found = {r.node: r.root for r in components(spark, spark.createDataFrame(chain, "x long, y long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {100 + 2 * i: 100 for i in range(1, 31)}


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_linked_sets_share_one_of_their_rarest_shingles(percent):
    rng = np.random.default_rng(percent)
    sets = [rng.choice(40, rng.integers(1, 40), replace=False) for _ in range(150)]
    sets = [np.unique(s).astype(np.uint64) for s in sets + [s[: len(s) * 9 // 10 + 1] for s in sets]]
    own, rare = minhash._prefixes(np.concatenate(sets), np.array([len(s) for s in sets]), percent)
    early = [set(rare[own == i].tolist()) for i in range(len(sets))]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both):
                assert early[i] & early[j]


def _around_a_passage(documents):
    """Texts of 600 words, of which 400 are the same in all; the first two of every hundred are near-duplicates."""
    rng = random.Random(documents)
    passage = " ".join(f"p{rng.randrange(300)}" for _ in range(400))
    texts = [f"{passage} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) for _ in range(documents)]
    for i in range(0, documents, 100):
        texts[i + 1] = texts[i] + " more"
    return texts


def test_a_shared_passage_alone_brings_no_pair():
    seconds = []
    for documents in (1000, 4000):
        texts = _around_a_passage(documents)
        start = time.perf_counter()
        asked, joined = np.arange(documents), np.zeros(documents, bool)
        found = minhash._tree_links(np.arange(documents), texts, asked, joined, 5, 80)
        seconds.append(time.perf_counter() - start)
        assert sorted(found) == [(i, i + 1) for i in range(0, documents, 100)]
    assert seconds[1] < 10 * seconds[0]


def test_large_neighbourhood_around_a_passage(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 100_000)
    texts = _around_a_passage(500)
    found = near_duplicates(spark, _frame(spark, list(enumerate(texts)))).collect()
    expected = {i: i - 1 if i % 100 == 1 else i for i in range(500)}
    assert {r.doc_id: r.component_id for r in found} == expected


def test_shingles_of_many_texts_need_the_room_of_few():
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(10**4)}" for _ in range(rng.choice([0, 3, 300, 600]))).encode() for _ in range(2000)]
    alone = [hashing.distinct_shingles([t], 5, hashing.Powers()) for t in texts]
    room = []
    for some in (texts[:1000], texts):
        tracemalloc.start()
        values, counts = hashing.distinct_shingles(some, 5, hashing.Powers())
        room.append(tracemalloc.get_traced_memory()[1] - 2 * values.nbytes - 2 * counts.nbytes)  # in parts and as a whole
        tracemalloc.stop()
    assert (values == np.concatenate([v for v, _ in alone])).all() and counts.tolist() == [c[0] for _, c in alone]
    assert max(room) < 20_000_000 and room[1] < 1.5 * room[0], room
