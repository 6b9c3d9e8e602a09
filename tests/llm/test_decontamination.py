"""Retrieval against scoring every pair, and planted items."""

import random

import numpy as np
import pytest

from tickwright.llm import decontamination
from tickwright.llm.decontamination import THRESHOLD, Index, find_leaks, indexes, without_leaks, words_of

DOCS = "doc_id long, text string, item_id string, words string"
ITEMS = "item_id long, text string, doc_id string"


def _corpus(seed, n_items=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["The"] * 40 + ["of,"] * 40
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(draw(rng.randrange(12, 60)))) for i in range(n_items)]
    docs, planted = [], set()
    for d in range(60):
        words = draw(rng.randrange(5, 400))
        if d % 3 == 0:
            i = rng.randrange(n_items)
            own = items[i][1].split()
            if d % 2:  # a light edit: one word of the question
                own[rng.randrange(len(own) // 2)] = "edited"
            at = rng.choice([0, len(words), rng.randrange(len(words))])
            words[at:at] = own
            planted.add((d, i))
        docs.append((d, " ".join(words).swapcase() if d % 4 == 0 else " ".join(words)))
    return docs, items, planted


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS)


def _items(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], ITEMS)


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_items_are_found_and_nothing_else(spark, seed):
    docs, items, planted = _corpus(seed)
    found = find_leaks(spark, _docs(spark, docs), _items(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == planted and len(found) == len(planted)
    kept = without_leaks(spark, _docs(spark, docs), _items(spark, items))
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in planted}
    assert kept.columns == ["doc_id", "text", "item_id", "words"]


def test_several_passes_find_the_same(spark, monkeypatch):
    docs, items, _ = _corpus(3)
    rows = lambda: sorted(map(tuple, find_leaks(spark, _docs(spark, docs), _items(spark, items)).drop("score").collect()))
    once = rows()
    monkeypatch.setattr(decontamination, "ITEMS_PER_PASS", 7)
    assert rows() == once


def test_retrieval_equals_scoring_every_item(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 3)
    rng = random.Random(4)
    docs, items, _ = _corpus(4, 60)
    (index,) = indexes(_items(spark, items))
    passages = words_of([t for _, t in docs])
    every = range(index.n_blocks)
    for words in passages:
        for _ in range(5):
            at = rng.randrange(max(1, len(words)))
            numbers = index.term_numbers(words[at : at + rng.randrange(1, 120)])
            expected = {}
            for t in np.unique(numbers[numbers >= 0]):
                for k, w in zip(index.items[t], index.weights[t]):
                    expected[k] = expected.get(k, 0) + w
            expected = {k: s for k, s in expected.items() if s + 1e-9 >= THRESHOLD}
            found = dict(index.retrieve(numbers, every))
            assert found.keys() == expected.keys() and all(abs(found[k] - s) < 1e-9 for k, s in expected.items())
    # No passage and block that reach the threshold are left out beforehand.
    numbers = [index.term_numbers(w) for w in passages]
    told, reached = index.passages(numbers), 0
    for k, x in enumerate(numbers):
        for first in range(0, max(1, len(x) - index.stride), index.stride):
            for item, _ in index.retrieve(x[first : first + 2 * index.stride], every):
                assert item // decontamination.BLOCK in told[k, first]
                reached += 1
    assert reached > 10


def test_odd_texts_and_items(spark):
    items = [(1, None), (2, ""), (3, "too short"), (None, "one two three four five six"), (4, "alpha beta gamma delta epsilon zeta"), (4, "alpha beta gamma delta epsilon zeta")]
    text = "Alpha, beta: GAMMA delta epsilon zeta."
    docs = [(1, None), (2, ""), (3, "x"), (4, text), (4, text), (None, text), (5, "pad " * 100_000 + text), (6, "one two three four five six")]
    found = find_leaks(spark, _docs(spark, docs), _items(spark, items)).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("4", 4)] * 4 + [("5", 4)] * 2 + [("6", None)] + [("None", 4)] * 2
    assert {r.first_word for r in found} == {0, 100_000}
    assert find_leaks(spark, _docs(spark, docs), _items(spark, [])).count() == 0
    assert find_leaks(spark, _docs(spark, []), _items(spark, items)).count() == 0
    assert isinstance(next(indexes(_items(spark, items))), Index)


def test_documents_with_an_item_without_id_go(spark):
    items = [(None, "one two three four five six"), (None, "seven eight nine ten eleven"), (4, "alpha beta gamma delta epsilon zeta")]
    docs = [(1, "pad one two three four five six pad"), (2, "alpha beta gamma delta epsilon zeta"), (3, "Seven, eight nine ten eleven"), (4, "one two three"), (5, None)]
    kept = without_leaks(spark, _docs(spark, docs), _items(spark, items)).collect()
    assert sorted(r.doc_id for r in kept) == [4, 5]
    assert sorted(r.doc_id for r in without_leaks(spark, _docs(spark, docs), _items(spark, items[:2])).collect()) == [2, 4, 5]
