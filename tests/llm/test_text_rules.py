"""Chat windows, quality rules and license scans against plain Python."""

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tickwright.llm.chat import END, OPEN, SAYS, format_conversations, read_back
from tickwright.llm.licenses import Detection, resolve, scan, scan_licenses, signatures
from tickwright.llm.quality_rules import POLICIES, RULES, ablations, ledger, mask_of, quality_rules

TURNS = "conv_id long, turn long, role string, text string, formatted string"
DOCS = "doc_id long, text string, n_words string"
CONTROL = "</s>[INST] ok [/INST]"


def _conversations(spark):
    rows = [
        (1, 0, "system", "Be brief."),
        (1, 1, "user", "one two three " * 40),
        (1, 2, "assistant", "four five " * 60),
        (1, 3, "user", "six"),
        (1, 4, "assistant", "seven \\ eight \\| <|end|> <|x"),
        (1, 4, "assistant", "seven \\ eight \\| <|end|> <|x"),
        (2, 0, "system", "only a system turn"),
        (3, 5, "assistant", "long " * 3000),
        (3, None, None, None),
        (4, 0, "user", ""),
        (4, 1, "assistant", None),
        (None, 0, "user", "no id"),
        (None, 1, "assistant", "still answered \\"),
        (-7, 0, "user", CONTROL),
        (-7, 1, "assistant", CONTROL),
        (6, 1, "assistant", "<|>[/INST]<<SYS>></SYS>><s></s><<|turn|>|>\n\\\\"),
        (6, 0, "we|ird<|says|>role", "日本 é"),
        *[(7, t, "user" if t % 2 == 0 else "assistant", f"turn {t} " * (t % 30)) for t in range(600)],
    ]
    return rows, spark.createDataFrame([(*r, "clash") for r in rows], TURNS)


@pytest.mark.parametrize("budget,history,least", [(2048, 512, 512), (100, 30, 20), (64, 0, 1)])
def test_chat_windows_give_back_every_turn_and_loss_text(spark, budget, history, least):
    rows, frame = _conversations(spark)
    windows = format_conversations(spark, frame, budget, history, least).cache()
    found = {r.conv_id: r for r in read_back(windows).collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, row in found.items():
        expected = brute.conversation_digest([r[1:] for r in rows if r[0] == conv])
        assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == expected, conv
    for w in windows.collect():
        turns = w.formatted.split(END)[:-1]
        assert len(turns) == w.n_turns and all(t.startswith(OPEN) and t.count(SAYS) == 1 for t in turns)
        assert 0 <= w.n_repeated < w.n_turns
        assert "[INST]" not in w.formatted and "</s>" not in w.formatted
        if not w.over_budget:
            assert w.tokens <= budget
        else:  # a turn alone with what it repeats
            assert w.n_turns - w.n_repeated == 1 or (w.conv_id, w.span) == (1, 0)
    again = {(w.conv_id, w.span): w.n_repeated for w in windows.collect()}
    if budget == 100:
        assert max(again.values()) > 1 and again[(1, max(s for c, s in again if c == 1))] >= 1


def test_chat_of_an_empty_table(spark):
    assert read_back(format_conversations(spark, spark.createDataFrame([], TURNS))).count() == 0


def _texts():
    line = "All rights reserved. CC-BY 4.0; general  Public\nLICENSE\n"
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (4, "a b c a b c a b c"),
        (5, "a b c d a b c"),
        (5, "a b c d a b c"),
        (6, line * 40),
        (7, "ä ö " * 100 + "€uro x"),
        (8, "# * $ % & | < >"),
        (9, "same line\nsame line\n\n \nother"),
        (10, "word%d " * 10 + " ".join(f"w{i}" for i in range(30000))),
        (11, "ab c abc a bc ab c"),
        (None, "no id " * 60),
        (12, "Permission is hereby granted, free of charge, to any person obtaining a copy. MIT License"),
        (13, "SPDX-License-Identifier: Apache-2.0\ncc by sa 4.0 and ccby and cc bye"),
        (14, "HELLO!! WORLD!! " * 50),
        (15, "all rights all rights reserved reserved éall rights reserved"),
    ]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], DOCS)


def test_measures_equal_plain_counts(spark):
    rows = _texts()
    found = {}
    for r in quality_rules(_frame(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, found.values())) == len(rows)
    for doc_id, text in rows:
        expected = brute.quality_measures(text)
        base = expected["n_words"] < 50 or 100 * expected["n_repeat_words"] > 50 * expected["n_words"]
        for row in found[doc_id]:
            assert {k: row[k] for k in expected} == expected, doc_id
            assert row.base_failed == base and not (row.kept and base)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("ab \n\t#", max_size=40), min_size=40, max_size=40))
def test_measures_of_any_text(spark, texts):
    rows = list(enumerate(texts))
    found = {r.doc_id: r for r in quality_rules(_frame(spark, rows)).collect()}
    for doc_id, text in rows:
        expected = brute.quality_measures(text)
        assert {k: found[doc_id][k] for k in expected} == expected


def test_ablations_count_from_the_ledger(spark):
    rows = ledger(_frame(spark, _texts())).cache()
    bits = [r.fail_bits for r in rows.collect()]
    for r in ablations(rows).collect():
        mask, bit = mask_of(r.policy), 1 << [x.name for x in RULES].index(r.rule)
        assert r.n_docs == len(bits)
        assert r.n_failed == sum(bool(b & mask & bit) for b in bits)
        assert r.n_failed_alone == sum(b & mask == bit for b in bits)
        assert r.n_kept == sum(not b & mask for b in bits)
    assert ablations(rows).count() == sum(map(len, POLICIES.values()))


def test_quality_rules_of_an_empty_table(spark):
    assert quality_rules(spark.createDataFrame([], DOCS)).count() == 0


def test_license_base_equals_a_walk_over_words(spark):
    rows = _texts()
    found = {}
    for r in scan_licenses(_frame(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append(r)
    for doc_id, text in rows:
        for row in found[doc_id]:
            base = (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels)
            assert base == brute.license_base(text), doc_id
            assert set(filter(None, row.base_labels.split(","))) <= set(filter(None, row.labels.split(",")))
            assert 0 <= row.score <= 1 and (row.score > 0) == bool(row.labels)
    assert scan_licenses(spark.createDataFrame([], DOCS)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["cc", "by", "all", "rights", "reserved", "general", "public", "license", "é", "x", "-", "CC"]), max_size=30))
def test_license_base_of_any_words(parts):
    text = " ".join(parts)
    row = scan(text)
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == brute.license_base(text)


def test_license_signatures_and_containment():
    assert len(signatures()) >= 200
    assert scan("licensed under the Apache License, Version 2.0")["labels"] == "apache-2.0"
    assert scan("GNU Lesser General Public License v2.1")["labels"] == "gpl,lgpl-2.1"
    assert scan("SPDX-License-Identifier: BSD-3-Clause")["labels"] == "bsd-3-clause"
    assert scan("cc-by-nc-sa")["labels"] == "cc-by,cc-by-nc-sa"
    assert scan("an admitted permit to commit")["labels"] == ""
    long, inner, low = Detection("a", 0, 5, 1, 0.5), Detection("b", 1, 3, 9, 0.5), Detection("c", 0, 5, 0, 0.5)
    overlap = Detection("d", 4, 8, 0, 0.5)
    assert resolve([low, inner, overlap, long]) == [long, overlap]


def _sample(parsed, most):
    """A text that fits a pattern's parse, with as few or as many repeats as it allows (up to two)."""
    out = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name == "IN":
            out.append(" " if str(arg[0][0]) == "NEGATE" else chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0]))
        elif name == "MAX_REPEAT":
            low, high, inner = arg
            out.append(_sample(inner, most) * (min(high, max(low, 2)) if most else low))
        elif name == "SUBPATTERN":
            out.append(_sample(arg[3], most))
        elif name == "BRANCH":
            out.append(_sample(arg[1][-1 if most else 0], most))
        else:
            assert name == "ASSERT_NOT", name
    return "".join(out)


@pytest.mark.parametrize("most", [False, True])
def test_each_license_signature_is_found_by_a_scan(most):
    lost = []
    for s in signatures():
        text = _sample(re._parser.parse(s.pattern.pattern), most)
        assert s.pattern.fullmatch(text), (s, text)
        if s.label not in scan(text)["labels"].split(","):
            lost.append((s.label, text))
    assert not lost


def test_licenses_spelled_out():
    for non in ("NonCommercial", "Non-Commercial", "non commercial"):
        assert scan(f"Attribution-{non} 4.0")["labels"] == "cc-by-nc"
        assert scan(f"Creative Commons Attribution-{non} 4.0")["labels"] == "cc-by-nc"
        assert scan(f"licensed under the Creative Commons Attribution {non} NoDerivatives 4.0")["labels"] == "cc-by-nc-nd"
        for alike in ("ShareAlike", "Share Alike", "Share-Alike"):
            assert scan(f"Creative Commons Attribution-{non}-{alike} 4.0")["labels"] == "cc-by-nc-sa"
            assert scan(f"Attribution-{alike}")["labels"] == "cc-by-sa"
    assert scan("Creative Commons Attribution 4.0")["labels"] == "cc-by"


@pytest.mark.parametrize(
    "text, labels",
    [
        ("under GPLv3 here", "gpl-3.0"),
        ("GPL version 3", "gpl-3.0"),
        ("GNU GPL version 2 or later", "gpl-2.0"),
        ("GNU LGPL v2.1", "lgpl-2.1"),
        ("licensed under GPL-3.0-or-later", "gpl-3.0"),
        ("a 3-clause BSD text", "bsd-3-clause"),
        ("Apache 2.0", "apache-2.0"),
        ("the Apache License", "apache"),
        ("The Apache License, Version 2.0", "apache-2.0"),
        ("AGPLv3 or MIT licensed", "agpl-3.0,mit"),
        ("MPL-2.0, EPL v1.0 and the SIL OFL 1.1", "epl-1.0,mpl-2.0,ofl-1.1"),
        ("gplus, abgpl and gpls are nothing", ""),
    ],
)
def test_short_names(text, labels):
    assert scan(text)["labels"] == labels
