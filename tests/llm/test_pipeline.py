"""The pipeline's stages on a small corpus and on the shared tables."""

import random
import re

import pytest

import corpus_pipeline
from tests.llm import brute
from tickwright.llm.minhash import keep_one_of_each

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOCS)


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "near-duplicates",
        "repeated passages",
        "decontamination",
        "packing",
    ]


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    near = base[:]
    near[100] = "other"
    rows = [(9, " ".join(base)), (4, " ".join(near)), (5, " ".join(near)), (1, "quite another text of a few words"), (1, "quite another text of a few words"), (2, None), (3, ""), (None, " ".join(base)), (None, None)]
    kept = keep_one_of_each(spark, _docs(spark, rows))
    assert kept.columns == DOCS.replace(",", "").split()[::2]
    assert sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text) == sorted([("4", " ".join(near)), ("1", rows[3][1]), ("None", " ".join(base))])
    assert sum(not r.text for r in kept.collect()) == 3


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage returns, written and read again."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    out["documents"] = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_stages_keep_the_columns_of_documents(stages):
    first = stages["documents"].columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(stages[n].columns == first for n in names[:-1])
    counts = [stages[n].count() for n in ["documents", *names[:-1]]]
    assert all(a >= b > 0.5 * a for a, b in zip(counts, counts[1:])) and counts[0] > counts[1] > counts[2]


def test_near_duplicates_equal_all_pairs(stages):
    rows = [(r.doc_id, r.text) for r in stages["quality classifier"].collect()]
    expected = {d for d, c in brute.components(rows, 5).items() if d == c}
    assert {r.doc_id for r in stages["near-duplicates"].collect()} == expected


def test_no_item_is_left(stages, spark, sf_dir):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in stages["repeated passages"].collect()}
    after = {r.doc_id: r.text for r in stages["decontamination"].collect()}
    holding = {d for d, t in before.items() if any(i in t for i in items)}
    assert holding and not holding & set(after) and len(before) - len(after) <= 1.2 * len(holding)
    assert all(before[d] == t for d, t in after.items())


def test_run_packs_what_is_left(stages, spark, sf_dir):
    whole = corpus_pipeline.run(spark, sf_dir)
    ours = stages["packing"]
    assert sorted(whole.columns) == sorted(ours.columns)
    tokens = lambda df: sorted((r.doc_id, r.doc_tokens) for r in df.select("doc_id", "doc_tokens").distinct().collect())
    assert tokens(whole) == tokens(ours) and {d for d, _ in tokens(ours)} == {r.doc_id for r in stages["decontamination"].collect()}


def test_a_passage_of_51_short_words_goes(spark):
    rng = random.Random(7)
    draw = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("aeiou") for _ in range(n)]
    passage, shorter, within = draw(51), draw(50), draw(60)
    long_words = [f"{w}longerthaneight" for w in draw(40)]
    join = lambda *parts: " ".join(w for p in parts for w in p)
    own = [draw(200) for _ in range(8)]
    copy = join(draw(60))
    rows = [
        (1, join(["é1"], passage, own[1], ["z1"])),
        (2, join(own[2], ["y2"]) + " " + "\n".join(passage) + " é2"),  # other gaps
        (3, join(own[3], ["x3"], shorter, ["w3"])),
        (4, join(["v4"], shorter, own[4])),
        (5, join(own[5], ["u5"], within, ["t5"], own[6], ["s5"], within)),
        (6, join(own[7], long_words)),
        (7, join(["q7"], long_words)),
        (8, copy),
        (8, copy),
        (9, join(passage)),
        (10, None),
        (11, ""),
    ]
    found = sorted((r.doc_id, None if r.text is None else r.text.split()) for r in corpus_pipeline.repeated_passages(spark, _docs(spark, rows), "").collect())
    expected = [
        (1, ["é1", *own[1], "z1"]),
        (2, [*own[2], "y2", "é2"]),
        (3, rows[2][1].split()),
        (4, rows[3][1].split()),
        (5, [*own[5], "u5", "t5", *own[6], "s5"]),
        (6, own[7]),
        (7, ["q7"]),
        (8, []),
        (8, []),
        (9, []),
        (10, None),
        (11, []),
    ]
    assert found == expected


def test_byte_strings_and_word_passages_are_what_goes(stages):
    """Bytes of all texts that lie in 51 words that occur twice, or in such a string of 400 bytes where texts are sparse."""
    rows = sorted((r.doc_id, r.text or "") for r in stages["near-duplicates"].collect())
    found = {r.doc_id: r.text or "" for r in stages["repeated passages"].collect()}
    raw = [text.encode() for _, text in rows]
    words = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", b)] for b in raw]
    places = {}
    for k, spans in enumerate(words):
        own = [raw[k][a:b] for a, b in spans]
        for i in range(len(own) - 50):
            places.setdefault(b" ".join(own[i : i + 51]), []).append((k, i))
    sparse = [brute.sparse(b, spans, 400, 51) for b, spans in zip(raw, words)]
    assert 0 < sum(sparse) < len(rows)
    gone, more = brute.repeated_bytes([t if s else "" for (_, t), s in zip(rows, sparse)], 400), 0
    cut_words = [set() for _ in rows]
    for at in places.values():
        for k, i in at if len(at) > 1 else []:
            cut_words[k].update(range(i, i + 51))
    for k, cut in enumerate(cut_words):
        for i in cut:  # with the gap to the next one that is cut
            inside = range(words[k][i][0], words[k][i + 1][0] if i + 1 in cut else words[k][i][1])
            more += not gone[k].issuperset(inside)
            gone[k].update(inside)
    assert more
    for (doc_id, _), b, cut in zip(rows, raw, gone):
        kept = bytes(c for i, c in enumerate(b) if i not in cut)
        # Up to a character's bytes at a span's edges.
        assert 0 <= len(found[doc_id].encode()) - len(kept) <= 6 * (1 + len(cut) // 100)


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    rng = random.Random(5)
    draw = lambda: [f"w{rng.randrange(500)}" for _ in range(100)]
    near = lambda words: [*words[:50], "other", *words[51:]]
    a, b, c, d = draw(), draw(), draw(), draw()
    rows = [
        (1, a),
        (5, near(a)),  # goes for 1
        (5, b),  # stays, though its id's other text goes
        (6, near(b)),  # goes for 5's second text
        (7, c),
        (7, d),  # two documents
        (7, near(c)),  # one of the two near texts of 7 stays
        (8, near(d)),
        (8, near(d)),  # both go
        (None, a),
    ]
    kept = [(r.doc_id, r.text.split()) for r in keep_one_of_each(spark, _docs(spark, [(i, " ".join(t)) for i, t in rows])).collect()]
    assert (7, c) in kept or (7, near(c)) in kept
    kept = [row for row in kept if row[1] not in (c, near(c))]
    assert sorted(map(str, kept)) == sorted(map(str, [(1, a), (5, b), (7, d), (None, a)])), [k for k, _ in kept]


@pytest.mark.parametrize("before,after", [("10000", 1000), ("0", 1000), ("300", 300)])
def test_stages_send_few_texts_at_a_time(spark, before, after):
    """Also when what a stage returned is run."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)

    def sizes(batches):
        for batch in batches:
            yield batch.iloc[:1].assign(n_chars=len(batch))

    try:
        spark.conf.set(key, before)
        docs = _docs(spark, [(i, f"w{i}") for i in range(2500)]).coalesce(1)
        staying = corpus_pipeline.repeated_passages(spark, docs, "").coalesce(1)
        assert max(r.n_chars for r in staying.mapInPandas(sizes, DOCS).collect()) == after
    finally:
        spark.conf.set(key, usual)
