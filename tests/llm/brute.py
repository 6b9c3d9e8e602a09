"""Plain answers over small lists, without Spark, to hold the operators against."""

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

GAP = re.compile("[\x20\x09-\x0d]+")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def ascii_lower(text):
    return (text or "").encode().lower().decode()


def conversation_digest(rows):
    """rows: (turn, role, text) of one conversation."""
    turns = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda x: (x[0] is not None, x))
    said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
    loss = "".join(x for _, r, x in turns if r == "assistant")
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), digest(said), len(loss), digest(loss)


def quality_measures(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def license_base(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text))
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    places = [
        (i, label)
        for phrase, label in phrases.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def shingles(text, size):
    w = ascii_lower(text)
    w = words(w)
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def components(docs, size, percent=80):
    """docs: (doc_id, text); {doc_id: smallest id reachable}."""
    sets = {d: shingles(t, size) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in ids}


def repeated_bytes(texts, length):
    """For each text the set of its bytes that lie in a string of ``length`` bytes starting anywhere twice."""
    raw = [(t or "").encode() for t in texts]
    places = defaultdict(list)
    for k, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            places[b[i : i + length]].append((k, i))
    out = [set() for _ in raw]
    for found in places.values():
        if len(found) > 1:
            for k, i in found:
                out[k].update(range(i, i + length))
    return out


def sparse(raw, spans, length, words):
    """Whether ``length`` neighbouring bytes somewhere hold fewer than ``words`` whole words, given the words' spans."""
    starts, ends = [a for a, _ in spans], [b for _, b in spans]
    return any(bisect_right(ends, p + length) - bisect_left(starts, p) < words for p in range(len(raw) - length + 1))


def crc(data):
    return zlib.crc32(data)


def runs(words, least=12):
    """All (start, length, smallest period) of a list of words, by trying every period."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end + period - start
            if length >= max(least, 2 * period):
                found.setdefault((start, length), period)
            start = max(end, start + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def run_row(doc_id, text):
    w = planted(doc_id, words(text))
    found = runs(w)
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    s, n, p = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return doc_id, len(found), s, n, p, n and 1000 * n // p, sha(lines), sha(kept)


def phrases(rows, least, top):
    """rows: (lang, text); the report's rows."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", ascii_lower(text)):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for size in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least:
                continue
            longer = [n for other, n in f.items() if len(other) > len(phrase) and n >= least
                      and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))]
            if any(100 * n >= 50 * a for n in longer):
                continue
            cuts = [(1000000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def _luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal_spans(text):
    """The contract's patterns as they are written, then their tests."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and _luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    found = [(m.start(), k, kind, m.end()) for k, (kind, pattern, holds) in enumerate(kinds)
             for m in re.finditer(pattern, text or "") if holds(m[0])]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]
