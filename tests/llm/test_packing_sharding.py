"""Packing and shards: every id and record in one place, little padding, near equal shards."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tickwright.llm import packing
from tickwright.llm.packing import END_ID, TIERS, pack, pack_documents
from tickwright.llm.sharding import shard_documents

DOCS = "doc_id long, text string, size string, shard string, id string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], DOCS)


def _texts():
    rows = [(i, f"Document {i} says é {i * i}. " * (i % 60)) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "<|endoftext|> inside"), (1003, "word " * 60_000), (None, "no id"), (1, "same id, other text")]
    return rows + [(7, "copied row " * 30)] * 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=40))
def test_every_token_is_packed_once_without_gaps(lengths):
    seen = [np.zeros(n, int) for n in lengths]
    padded = 0
    for tier, pieces in pack(lengths):
        used = sum(n for _, _, n in pieces)
        assert tier in TIERS and used <= tier
        padded += used < tier and used.bit_count() != 1
        for doc, start, n in pieces:
            assert n > 0
            seen[doc][start : start + n] += 1
    assert all((x == 1).all() for x in seen)
    assert padded <= len(TIERS)


@pytest.mark.parametrize("group", [8_000_000, 3000])
def test_pieces_give_back_the_tokenizers_ids(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_CHARS", group)
    rows = _texts()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        expected.append((doc_id, ids))
    pieces = pack_documents(_frame(spark, rows)).collect()
    assert sum(p.length for p in pieces) == sum(len(ids) for _, ids in expected)
    whole = {(d, len(ids)): ids for d, ids in expected}
    for p in pieces:
        ids = whole[p.doc_id, p.doc_tokens]
        assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for found in sequences.values():
        found.sort(key=lambda p: p.offset)
        assert [p.offset for p in found] == list(np.cumsum([0, *[p.length for p in found]])[:-1])
        assert len({(p.tier, p.step_group) for p in found}) == 1 and sum(p.length for p in found) <= found[0].tier


def test_step_groups_weigh_the_same(spark):
    rows = [(i, "several words of text " * 400) for i in range(400)]
    pieces = pack_documents(_frame(spark, rows).coalesce(1)).collect()
    weight = {}
    for p in pieces:
        weight[p.step_group] = weight.get(p.step_group, 0) + p.length
    assert max(weight.values()) <= packing.STEP_TOKENS
    assert sorted(weight.values())[len(TIERS) :] and sum(w == packing.STEP_TOKENS for w in weight.values()) >= len(weight) - len(TIERS)


def _shards(spark, rows):
    found = shard_documents(spark, _frame(spark, rows)).collect()
    expected = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == expected
    slots, size = {}, {}
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 24
        slots.setdefault(r.shard, []).append(r.slot)
        size[r.shard] = size.get(r.shard, 0) + r.size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    return size


def test_shards_hold_every_record_once(spark):
    _shards(spark, _texts())
    assert shard_documents(spark, _frame(spark, [])).count() == 0
    assert _shards(spark, [(None, None)]) == {0: 8}


def test_shards_are_near_equal_with_a_third_in_one_text(spark):
    rows = [(i, "one text of many copies " * 20 if i % 3 == 0 else f"text {i} " * (1 + i % 90)) for i in range(30_000)]
    size = _shards(spark, rows)
    fair = sum(size.values()) / 24
    assert len(size) == 24 and max(abs(s - fair) for s in size.values()) < 0.005 * fair
