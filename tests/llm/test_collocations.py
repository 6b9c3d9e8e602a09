"""The phrase report against plain counting, and what a Misra-Gries summary promises."""

import random
from collections import Counter

import numpy as np
import pytest
from tests.llm import brute

from tickwright.llm import collocations as module
from tickwright.llm.collocations import MisraGries, collocations

DOCS = "doc_id long, lang string, text string"


def _found(spark, rows, **how):
    docs = spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(rows)], DOCS)
    return sorted(tuple(r) for r in collocations(spark, docs, **how).collect())


@pytest.mark.parametrize("seed", range(20))
def test_what_is_frequent_survives_any_merging(seed):
    rng = random.Random(seed)
    stream = [int(rng.paretovariate(0.7)) % 500 for _ in range(3000)]
    least = rng.choice([5, 10, 40])
    capacity = len(stream) // least + 1
    summary = MisraGries(capacity)
    cuts = sorted(rng.randint(0, len(stream)) for _ in range(rng.randint(0, 12)))
    for a, b in zip([0, *cuts], [*cuts, len(stream)]):
        part = MisraGries(capacity)
        part.merge(*np.unique(np.array(stream[a:b], np.uint32), return_counts=True))
        summary.merge(part.keys, part.counts, part.lacks)
    assert len(summary.keys) <= capacity and summary.lacks < least
    frequent = {x for x, n in Counter(stream).items() if n >= least}
    assert frequent <= set(summary.may_reach(least).tolist())


@pytest.mark.parametrize("parts, bits", [(8_000_000, 1 << 28), (300, 1 << 19)])
def test_report_equals_plain_counting(spark, monkeypatch, parts, bits):
    monkeypatch.setattr(module, "PARTITION_BYTES", parts)
    monkeypatch.setattr(module, "MOST_BITS", bits)
    rng = random.Random(3)
    words = ["a", "The", "de", "É", "x-y", "1", "it's"]
    rows = [
        (rng.choice(["en", "fr", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ", "]) for _ in range(rng.randint(0, 60))))
        for _ in range(150)
    ]
    rows += rows[:20] + [("en", None), ("en", ""), ("de", "...")]
    for top in (2000, 5):
        assert _found(spark, rows, least=10, top=top) == brute.phrases(rows, 10, top)


def test_counts_at_the_threshold_and_hot_phrases(spark):
    rows = [("en", "new york city hall")] * 10 + [("en", "new jersey")] * 9 + [("en", "hot pair " * 300)] * 40
    assert _found(spark, rows) == brute.phrases(rows, 10, 2000)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([], DOCS)
    assert collocations(spark, docs).collect() == []
    rows = [(None, "en", "big apple pie. " * 10, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, phrase string")
    assert [(r.phrase, r.a) for r in collocations(spark, docs).collect()] == [("big apple pie", 10)]
