"""Personal data: patterns, and a skip-chain conditional random field for what patterns miss.

The field's nodes are the words of a text that hold a digit or an ``@``. Neighbours share a potential, and so do
distant words of the same text that have the same digits, or the same shape. Words in a pattern's match are
observed; loopy message passing carries their labels to the others, so that a number given once in full is known
again where it is written without its prefix or with a slip. Weights are learnt from the patterns' own matches in
all texts: a softmax of a word's features, and the log ratio of how often two labels share an edge to chance.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
#: A word is taken for personal data from this probability on.
SURE = 0.9
ROUNDS, DAMPING, SETTLED = 50, 0.5, 1e-4
PENALTY = 1.0
#: Words whose field is solved at once.
GROUP_WORDS = 200_000
CHAIN, SAME, ALIKE = range(3)

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARKED = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_CORE = re.compile(r"[A-Za-z0-9+(](?:.*[A-Za-z0-9)])?", re.S)
_SHAPE = bytes(0x39 if 0x30 <= c <= 0x39 else 0x61 if 0x41 <= (c & 0xDF) <= 0x5A else c for c in range(256))
Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[::-2]))
    return (odd + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        low = domain.end() if domain else at + 1
        at = text.find("@", low)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts = list(_NUMBER.finditer(text, *chain.span()))
        for k in range(0, len(parts) - 3, 4):  # four by four: a match is never tried again
            four = [p[0].lstrip("0") for p in parts[k : k + 4]]
            if all(len(p) < 4 and int(p or 0) <= 255 for p in four):
                yield parts[k].start(), parts[k + 3].end()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def pattern_spans(text: str) -> list[Span]:
    """(start, kind, end) of all matches, by start, then kind; in code points, the end exclusive."""
    if not _MARKED.search(text):
        return []
    finders = (_emails, _addresses, _cards, _phones)
    return sorted((start, kind, end) for kind, find in enumerate(finders) for start, end in find(text))


# Features of a word, one bit each; how many digits it has is one of five bits.
_DIGITS = np.array([1, 4, 7, 12, 20])
_FEATURES = 5 + 10


def _features(core: str, digits: int) -> int:
    bits = 1 << int(np.searchsorted(_DIGITS, digits, "right") - 1) if digits else 0
    dots = core.count(".")
    tests = (
        any(c.isalpha() for c in core), "@" in core, dots == 3, dots > 0, "-" in core, "(" in core or ")" in core,
        core.startswith("+"), core.isdigit(),
    )
    return bits | sum(1 << (5 + k) for k, holds in enumerate(tests) if holds)


@dataclass
class Graph:
    """Words of several texts and the edges among them."""

    text: list[int]
    span: list[tuple[int, int]]
    #: Number of the word in its text.
    place: list[int]
    mask: list[int]
    observed: list[int]
    edges: list[tuple[int, int, int]]

    @classmethod
    def empty(cls) -> "Graph":
        return cls([], [], [], [], [], [])

    def add(self, number: int, text: str, spans: list[Span]) -> None:
        first = len(self.span)
        latest: dict[tuple[int, str], int] = {}
        waiting = 0
        ordered = sorted(spans, key=lambda s: s[2])
        for place, m in enumerate(_WORD.finditer(text)):
            if not _MARKED.search(m[0]):
                continue
            inner = _CORE.search(m[0])
            if not inner:
                continue
            core, start = inner[0], m.start() + inner.start()
            end = start + len(core)
            while waiting < len(ordered) and ordered[waiting][2] <= start:
                waiting += 1
            label = next((kind for low, kind, _ in ordered[waiting : waiting + len(KINDS) + 1] if low < end), OTHER)
            digits = _NOT_DIGIT.sub("", core)
            node = len(self.span)
            mask = _features(core, len(digits))
            if node > first and self.place[-1] == place - 1:
                mask |= 1 << (_FEATURES - 2)
                self.mask[-1] |= 1 << (_FEATURES - 1)
                self.edges.append((CHAIN, node - 1, node))
            shape = core.encode().translate(_SHAPE).decode() if len(digits) > 6 else ""
            same = core.lower() if "@" in core else digits if len(digits) > 3 else ""
            for kind, key in ((SAME, same), (ALIKE, shape)):
                if key:
                    if (kind, key) in latest:
                        self.edges.append((kind, latest[kind, key], node))
                    latest[kind, key] = node
            self.text.append(number)
            self.span.append((start, end))
            self.place.append(place)
            self.mask.append(mask)
            self.observed.append(label)


@dataclass(frozen=True)
class Field:
    """Weights: of features for each label, and of the labels at both ends of each kind of edge."""

    features: np.ndarray
    edges: np.ndarray

    def marginals(self, graph: Graph) -> np.ndarray:
        """The probability of each label for each word, given the observed ones, by damped loopy messages."""
        mask = np.array(graph.mask, np.int64)
        observed = np.array(graph.observed)
        own = _columns(mask) @ self.features
        own -= np.logaddexp.reduce(own, axis=1, keepdims=True)
        seen = observed != OTHER
        own[seen] = -30.0
        own[seen, observed[seen]] = 0.0
        belief = own
        if graph.edges:
            kind, a, b = np.array(graph.edges).T
            source, target = np.concatenate([a, b]), np.concatenate([b, a])
            back = np.roll(np.arange(len(source)), len(a))
            weight = np.concatenate([self.edges[kind], self.edges[kind].transpose(0, 2, 1)])
            message = np.zeros((len(source), OTHER + 1))
            for _ in range(ROUNDS):
                sent = np.logaddexp.reduce((belief[source] - message[back])[:, :, None] + weight, axis=1)
                sent -= np.logaddexp.reduce(sent, axis=1, keepdims=True)
                sent = DAMPING * message + (1 - DAMPING) * sent
                change = np.abs(sent - message).max()
                message = sent
                belief = own + np.stack([np.bincount(target, message[:, k], len(own)) for k in range(OTHER + 1)], axis=1)
                if change < SETTLED:
                    break
        return np.exp(belief - np.logaddexp.reduce(belief, axis=1, keepdims=True))

    def more_spans(self, graph: Graph) -> dict[int, list[tuple[int, int, int, float]]]:
        """For each text the spans of unobserved words that are surely of a kind; neighbours of one kind are one span."""
        if not graph.span:
            return {}
        chance = self.marginals(graph)
        label = chance.argmax(axis=1)
        sure = chance.max(axis=1)
        found: dict[int, list] = {}
        before = None
        for k in np.flatnonzero((label != OTHER) & (sure >= SURE) & (np.array(graph.observed) == OTHER)).tolist():
            spans = found.setdefault(graph.text[k], [])
            (start, end), kind = graph.span[k], int(label[k])
            joins = before == k - 1 and graph.text[before] == graph.text[k] and graph.place[before] == graph.place[k] - 1
            if joins and spans[-1][1] == kind:
                start, _, _, least = spans.pop()
                spans.append((start, kind, end, min(least, float(sure[k]))))
            else:
                spans.append((start, kind, end, float(sure[k])))
            before = k
        return found


def _columns(mask: np.ndarray) -> np.ndarray:
    """A row of features for each mask; the last is always 1."""
    return np.concatenate([(mask[:, None] >> np.arange(_FEATURES)) & 1, np.ones((len(mask), 1), np.int64)], axis=1).astype(float)


def _softmax_weights(mask: np.ndarray, label: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of the features for each label by Newton's method; ``OTHER`` has none."""
    x, wanted = _columns(mask), np.eye(OTHER + 1)[label][:, :OTHER]
    d = x.shape[1]
    weights = np.zeros((d, OTHER))
    for _ in range(30):
        score = np.concatenate([x @ weights, np.zeros((len(x), 1))], axis=1)
        p = np.exp(score - np.logaddexp.reduce(score, axis=1, keepdims=True))[:, :OTHER]
        slope = x.T @ (n[:, None] * (wanted - p)) - PENALTY * weights
        curve = PENALTY * np.eye(d * OTHER)
        for j in range(OTHER):
            for k in range(OTHER):
                part = x.T @ ((n * p[:, j] * ((j == k) - p[:, k]))[:, None] * x)
                curve[j * d : (j + 1) * d, k * d : (k + 1) * d] += part
        step = np.linalg.solve(curve, slope.T.reshape(-1)).reshape(OTHER, d).T
        weights += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([weights, np.zeros((d, 1))], axis=1)


def learn_field(docs: DataFrame) -> Field:
    """Weights from the patterns' matches in all texts.

    The driver gets counts: of each set of features by label, fewer than 2 ** 15 sets, and of each pair of labels
    by kind of edge.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                graph = Graph.empty()
                graph.add(0, text, pattern_spans(text))
                seen.update((-1, mask, label) for mask, label in zip(graph.mask, graph.observed))
                seen.update((kind, graph.observed[a], graph.observed[b]) for kind, a, b in graph.edges)
            rows = [(*key, n) for key, n in seen.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=list("tabn"))

    texts = docs.select("text").where(F.col("text").rlike("[0-9@]"))
    counted = texts.mapInArrow(count, "t long, a long, b long, n long").groupBy("t", "a", "b").agg(F.sum("n").alias("n"))
    rows = np.array([tuple(r) for r in counted.collect()], np.int64).reshape(-1, 4)
    rows = rows[np.lexsort(rows.T[::-1])]
    single = rows[rows[:, 0] == -1]
    edges = np.zeros((3, OTHER + 1, OTHER + 1))
    for kind in range(3):
        pairs = np.ones((OTHER + 1, OTHER + 1))
        of_kind = rows[rows[:, 0] == kind]
        np.add.at(pairs, (of_kind[:, 1], of_kind[:, 2]), of_kind[:, 3])
        pairs = pairs + pairs.T if kind != CHAIN else pairs
        edges[kind] = np.log(pairs * pairs.sum() / (pairs.sum(axis=1, keepdims=True) * pairs.sum(axis=0)))
    return Field(_softmax_weights(single[:, 1], single[:, 2], single[:, 3].astype(float)), edges)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
_ROWS = pa.schema([("id", pa.string()), ("base", pa.list_(_SPAN)), ("more", pa.list_(_SPAN))])
_SPANS = "array<struct<kind: string, start: long, end: long, score: double>>"


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """For each row of docs its ``doc_id``, the patterns' spans ``base`` and the field's spans ``more``.

    A span has its kind, start and end in code points of the whole text, the end exclusive, and a score (1 for a
    pattern's). ``base`` is ordered by start, then kind as in ``KINDS``; spans of ``more`` overlap none of it and
    no other. Without a ``field`` one is learnt from these docs.

    A null or empty text has no spans. A null doc_id stays null; repeated rows are searched each; other columns are
    left out; no rows give no rows. Nothing but label counts is shuffled.
    """
    field = field or learn_field(docs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(ids: list, base: list[list[Span]], graph: Graph) -> pa.RecordBatch:
            more = field.more_spans(graph)
            named = [[{"kind": KINDS[k], "start": a, "end": b, "score": 1.0} for a, k, b in spans] for spans in base]
            added = [[{"kind": KINDS[k], "start": a, "end": b, "score": s} for a, k, b, s in more.get(i, ())] for i in range(len(ids))]
            return pa.RecordBatch.from_pydict({"id": ids, "base": named, "more": added}, schema=_ROWS)

        ids, base, graph = [], [], Graph.empty()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = pattern_spans(text) if text else []
                if text:
                    graph.add(len(ids), text, spans)
                ids.append(doc_id)
                base.append(spans)
                if len(graph.span) >= GROUP_WORDS or len(ids) >= 10 * GROUP_WORDS:
                    yield found(ids, base, graph)
                    ids, base, graph = [], [], Graph.empty()
        if ids:
            yield found(ids, base, graph)

    # Texts without a digit or an @ have nothing to find and stay in the JVM.
    text = F.when(F.col("text").rlike("[0-9@]"), F.col("text"))
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), text.alias("text"))
    return texts.mapInArrow(search, f"id string, base {_SPANS}, more {_SPANS}").select(
        F.col("id").cast("long").alias("doc_id"), "base", "more"
    )


def span_digests(found: DataFrame) -> DataFrame:
    """One flat row for each of ``personal_data``: counts and digest of the patterns' spans, all spans as text."""
    place = {kind: k for k, kind in enumerate(KINDS)}
    order = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])

    def number_of(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    keyed = F.transform(
        F.concat("base", "more"), lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("k"), s["kind"].alias("kind"), s["end"].alias("end"))
    )
    return found.select(
        "doc_id", *map(number_of, KINDS), F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.array_sort(keyed)).alias("spans"),
        F.size("more").cast("long").alias("n_more"),
    )
