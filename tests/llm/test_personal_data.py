"""Patterns as they are written, exact marginals of small fields, and what the field adds."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from tests.llm import brute

from tickwright.llm.personal_data import ALIKE, CHAIN, KINDS, OTHER, SAME, Field, Graph, learn_field, pattern_spans, personal_data, span_digests
from tickwright.llm.queries import op12_personal_data


@pytest.mark.parametrize("seed", range(40))
def test_patterns_as_written(seed):
    rng = random.Random(seed)
    signs = ["1", "4", "255", "256", "0", ".", ".", "-", " ", "@", "a", "b.c", "+", "+1", "(", ")", "é", "_", "4111111111111111", "\n"]
    for _ in range(200):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        assert [(KINDS[k], a, b) for a, k, b in pattern_spans(text)] == brute.personal_spans(text), text


def test_query_has_all_pattern_spans(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = op12_personal_data(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = brute.personal_spans(docs[r.doc_id])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in KINDS]
        spans = [(int(a), KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert spans == sorted(spans) and {(a, KINDS.index(k), b) for k, a, b in base} <= set(spans)
        assert len(spans) == len(base) + r.n_more
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 50


def _exact(field, graph):
    own = np.concatenate([(np.array(graph.mask)[:, None] >> np.arange(len(field.features) - 1)) & 1, np.ones((len(graph.mask), 1))], 1) @ field.features
    total = np.zeros((len(graph.mask), OTHER + 1))
    for labels in itertools.product(range(OTHER + 1), repeat=len(graph.mask)):
        if any(o != OTHER and o != x for o, x in zip(graph.observed, labels)):
            continue
        weight = sum(own[i, x] for i, x in enumerate(labels)) + sum(field.edges[k][labels[a], labels[b]] for k, a, b in graph.edges)
        for i, x in enumerate(labels):
            total[i, x] += np.exp(weight)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("edges, near", [([(CHAIN, 0, 1), (SAME, 1, 3), (ALIKE, 1, 2)], 1e-3), ([(CHAIN, 0, 1), (SAME, 1, 2), (ALIKE, 0, 2), (CHAIN, 2, 3)], 0.08)])
def test_messages_give_marginals(edges, near):
    rng = np.random.default_rng(2)
    field = Field(rng.normal(size=(16, OTHER + 1)), rng.normal(size=(3, OTHER + 1, OTHER + 1)) * 0.7)
    field.edges[1:] = field.edges[1:] + field.edges[1:].transpose(0, 2, 1)
    graph = Graph([0] * 4, [(i, i + 1) for i in range(4)], list(range(4)), [3, 64, 129, 5], [OTHER, OTHER, OTHER, 2], edges)
    assert np.abs(field.marginals(graph) - _exact(field, graph)).max() < near


@pytest.fixture(scope="module")
def field(spark):
    return learn_field(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def _spans(spark, field, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r.spans for r in span_digests(personal_data(docs, field)).collect()}


def test_numbers_known_from_elsewhere_are_found_again(spark, field):
    told = "Call +1 (743) 555-3824 now. "
    far = "words and words " * 500
    found = _spans(spark, field, [told + far + "Or (743) 555-3824 then.", "In 1999 and 2.0 of 12 pages.", "from 10.20.30.40 and 10.20.30.400 on"])
    start = len(told + far) + 3
    assert found[0] == f"phone:5:22,phone:{start}:{start + 14}"
    assert found[1] == "" and found[2] == "ip:5:16,ip:21:33"


def test_odd_rows(spark, field):
    mail = "x@y.z"
    rows = [(1, None), (2, ""), (None, mail), (4, mail), (4, mail), (5, "@"), (6, "9" * 5000 + "." * 5000 + "a" * 5000 + "@" * 5000), (7, "é" * 9 + mail)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS base", "2 AS more")
    found = sorted(((r.doc_id, r.spans) for r in span_digests(personal_data(docs, field)).collect()), key=str)
    assert found == sorted([(1, ""), (2, ""), (None, "email:0:5"), (4, "email:0:5"), (4, "email:0:5"), (5, ""), (6, ""), (7, "email:9:14")], key=str)
    empty = docs.limit(0)
    assert personal_data(empty).collect() == []
