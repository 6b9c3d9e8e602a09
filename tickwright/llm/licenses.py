"""License scans: ordered signature rules behind a keyword prefilter.

Each licence family gives several signatures. A text is first searched once for all keywords; only the
signatures of keywords that occur are matched. Overlapping detections are resolved by containment and
priority.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Words are runs of digits, lower-case letters and anything beyond ASCII, over the bytes of the text.
_WORD = r"0-9a-z\x80-\xff"
_GAP = rf"[^{_WORD}]+"
_IS_WORD = np.zeros(256, np.int8)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1

# Phrases that every scan counts, and their labels.
BASE_PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Licence families by priority of their names, as label, keyword, name and identifier patterns. In the
# patterns a space stands for whatever parts two words, so one that may be missing is "(?: )?"; every text that a
# pattern matches holds its keyword.
FAMILIES = [
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[cs]e", r"agpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: version)? v?2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: version)? v?3", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e", r"lgpl"),
    ("lgpl-2.0", "library", r"(?:gnu )?library general public licen[cs]e", r"lgpl 2 0(?: only| or later)?"),
    ("gpl-2.0", "general", r"(?:gnu )?general public licen[cs]e(?: version)? v?2", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "general", r"(?:gnu )?general public licen[cs]e(?: version)? v?3", r"gpl 3 0(?: only| or later)?"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[cs]e", r"gfdl 1 [123](?: only| or later)?"),
    ("apache-2.0", "apache", r"apache licen[cs]e(?: version)? v?2(?: 0)?", r"apache 2 0"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e(?: version)? v?1 1", r"apache 1 1"),
    ("mit", "mit", r"mit licen[cs]e", r"mit"),
    ("mit-0", "attribution", r"mit no attribution(?: licen[cs]e)?", r"mit 0"),
    ("bsd-2-clause", "bsd", r"(?:2|two) clause bsd licen[cs]e", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:3|three) clause bsd licen[cs]e", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:4|four) clause bsd licen[cs]e", r"bsd 4 clause"),
    ("0bsd", "bsd", r"(?:0|zero) clause bsd licen[cs]e", r"0bsd"),
    ("bsd", "bsd", r"(?:modified |simplified |new )?bsd licen[cs]e", r"bsd"),
    ("isc", "isc", r"isc licen[cs]e", r"isc"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: version)? v?1 1", r"mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: version)?(?: v?2(?: 0)?)?", r"mpl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?: version)? v?1(?: 0)?", r"epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: version)? v?2(?: 0)?", r"epl 2 0"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[cs]e", r"edl 1 0"),
    ("cddl-1.0", "distribution", r"common development and distribution licen[cs]e", r"cddl 1 [01]"),
    ("cpl-1.0", "common", r"common public licen[cs]e", r"cpl 1 0"),
    ("eupl-1.2", "european", r"european union public licen[cs]e", r"eupl 1 [12]"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version)?(?: v?2(?: 0)?)?", r"artistic 2 0"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e", r"bsl 1 0"),
    ("busl-1.1", "business", r"business source licen[cs]e", r"busl 1 1"),
    ("sspl-1.0", "server", r"server side public licen[cs]e", r"sspl 1 0"),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e", r"elastic 2 0"),
    ("unlicense", "unlicense", r"the unlicense", r"unlicense"),
    ("wtfpl", "want", r"do what the fuck you want to public licen[cs]e", r"wtfpl"),
    ("zlib", "zlib", r"zlib licen[cs]e", r"zlib"),
    ("libpng", "libpng", r"libpng licen[cs]e", r"libpng 2 0"),
    ("ncsa", "illinois", r"university of illinois ncsa open source licen[cs]e", r"ncsa"),
    ("python-2.0", "python", r"python software foundation licen[cs]e", r"python 2 0|psf 2 0"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", r"postgresql"),
    ("openssl", "openssl", r"openssl licen[cs]e", r"openssl"),
    ("php-3.01", "php", r"php licen[cs]e", r"php 3 01"),
    ("ruby", "ruby", r"ruby licen[cs]e", r"ruby"),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[cs]e", r"ofl 1 1"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0(?: universal)?)?", r"cc0 1 0"),
    ("cc-by-nc-nd", "nc", r"cc by nc nd", r"cc by nc nd [1234] 0"),
    ("cc-by-nc-sa", "nc", r"cc by nc sa", r"cc by nc sa [1234] 0"),
    ("cc-by-nc", "nc", r"cc by nc", r"cc by nc [1234] 0"),
    ("cc-by-nd", "nd", r"cc by nd", r"cc by nd [1234] 0"),
    ("cc-by-sa", "sa", r"cc by sa", r"cc by sa [1234] 0"),
    ("cc-by-nc-nd", "attribution", r"(?:creative commons )?attribution non(?: )?commercial no(?: )?deriv(?:ative)?s", r"cc by nc nd"),
    ("cc-by-nc-sa", "attribution", r"(?:creative commons )?attribution non(?: )?commercial share(?: )?alike", r"cc by nc sa"),
    ("cc-by-nc", "attribution", r"(?:creative commons )?attribution non(?: )?commercial", r"cc by nc"),
    ("cc-by-sa", "attribution", r"(?:creative commons )?attribution share(?: )?alike", r"cc by sa"),
    ("cc-by", "commons", r"creative commons attribution", r"cc by [1234] 0"),
    ("odbl-1.0", "database", r"open (?:data commons )?(?:open )?database licen[cs]e", r"odbl 1 0"),
    ("pddl-1.0", "dedication", r"public domain dedication and licen[cs]e", r"pddl 1 0"),
    ("public-domain", "domain", r"(?:in|into|to) the public domain", r"public domain"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", r"ms rl"),
    ("osl-3.0", "open", r"open software licen[cs]e", r"osl 3 0"),
    ("afl-3.0", "academic", r"academic free licen[cs]e", r"afl 3 0"),
    ("ecl-2.0", "educational", r"educational community licen[cs]e", r"ecl 2 0"),
    ("upl-1.0", "universal", r"universal permissive licen[cs]e", r"upl 1 0"),
    ("proprietary", "proprietary", r"proprietary and confidential", r"proprietary"),
]

# Short names as people write them, as label, keyword and pattern.
SHORT_NAMES = [
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl(?: licen[cs]e)?(?: version)?(?: )?v?3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl(?: licen[cs]e)?(?: version)?(?: )?v?2 1(?: only| or (?:any )?later(?: version)?)?"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl(?: licen[cs]e)?(?: version)?(?: )?v?3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl(?: licen[cs]e)?(?: version)?(?: )?v?2(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl(?: licen[cs]e)?(?: version)?(?: )?v?3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("gfdl", "gfdl", r"(?:gnu )?gfdl"),
    ("apache-2.0", "apache", r"apache(?: (?:software )?licen[cs]e)?(?: version)?(?: )?v?2(?: 0)?"),
    ("apache", "apache", r"apache (?:software )?licen[cs]ed?"),
    ("bsd-2-clause", "bsd", r"(?:2|two) clause bsd|bsd (?:2|two) clause"),
    ("bsd-3-clause", "bsd", r"(?:3|three) clause bsd|bsd (?:3|three) clause|(?:new|modified|revised) bsd"),
    ("bsd-4-clause", "bsd", r"(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd"),
    ("bsd", "bsd", r"bsd (?:style )?licen[cs]ed?"),
    ("mit", "mit", r"mit (?:style )?licen[cs]ed?|mit x11 licen[cs]e"),
    ("mit", "expat", r"expat licen[cs]e"),
    ("isc", "isc", r"isc licen[cs]ed"),
    ("mpl-1.1", "mpl", r"mpl(?: version)?(?: )?v?1 1"),
    ("mpl-2.0", "mpl", r"mpl(?: version)?(?: )?v?2(?: 0)?"),
    ("epl-1.0", "epl", r"epl(?: version)?(?: )?v?1(?: 0)?"),
    ("epl-2.0", "epl", r"epl(?: version)?(?: )?v?2(?: 0)?"),
    ("cddl-1.0", "cddl", r"cddl(?: version)?(?: )?v?1(?: [01])?"),
    ("eupl-1.2", "eupl", r"eupl(?: version)?(?: )?v?1 [12]"),
    ("sspl-1.0", "sspl", r"sspl(?: version)?(?: )?v?1(?: 0)?"),
    ("busl-1.1", "busl", r"busl(?: version)?(?: )?v?1 1"),
    ("bsl-1.0", "boost", r"boost licen[cs]e(?: version)?(?: )?v?1(?: 0)?"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ofl-1.1", "ofl", r"sil ofl(?: version)?(?: )?(?:v?1 1)?"),
]

# Sentences of licence texts, as label, keyword and pattern.
SENTENCES = [
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "purpose", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "contributors", r"neither the name of (?:[%s]+ ){1,8}nor the names of its contributors" % _WORD),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu"),
    ("zlib", "misrepresented", r"subject to the following restrictions the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("bsl-1.0", "obtaining", r"obtaining a copy of the software and accompanying documentation covered by this license"),
    ("mpl-2.0", "subject", r"subject to the terms of the mozilla public license"),
]

# Places where licence texts are published, as label, keyword and pattern.
ADDRESSES = [
    ("apache-2.0", "apache", r"apache org licenses license 2 0"),
    ("gpl", "gnu", r"gnu org (?:licenses|copyleft) gpl"),
    ("lgpl", "gnu", r"gnu org (?:licenses|copyleft) lgpl"),
    ("agpl-3.0", "gnu", r"gnu org licenses agpl"),
    ("mit", "opensource", r"opensource org licenses mit"),
    ("mpl-2.0", "mozilla", r"mozilla org mpl 2 0"),
    ("cc-by", "creativecommons", r"creativecommons org licenses by [1234] 0"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1234] 0"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1234] 0"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licenses by nc sa [1234] 0"),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("ofl-1.1", "scripts", r"scripts sil org ofl"),
    ("unlicense", "unlicense", r"unlicense org"),
]

# Ways in which a name stands in a text, as kind, priority, confidence and the words before it.
FORMS = [
    ("identifier", 5, 0.95, r"spdx licen[cs]e identifier (?:%(id)s)"),
    ("grant", 4, 0.9, r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:%(name)s)"),
    ("field", 3, 0.7, r"licen[cs]e(?:d)? (?:%(id)s)"),
    ("name", 2, 0.5, r"(?:%(name)s)"),
]
_SENTENCE, _ADDRESS, _BASE = (6, 0.9), (4, 0.8), (1, 0.3)


@dataclass(frozen=True)
class Signature:
    label: str
    keyword: str
    pattern: re.Pattern
    priority: int
    confidence: float


@dataclass(frozen=True)
class Detection:
    """Words ``first`` to ``last`` of a text, both included."""

    label: str
    first: int
    last: int
    priority: int
    confidence: float


def _whole_words(pattern: str) -> re.Pattern:
    return re.compile(rf"(?<![{_WORD}])(?:{pattern.replace(' ', _GAP)})(?![{_WORD}])")


@cache
def signatures() -> list[Signature]:
    """In order of priority; within one, in the order of the tables."""
    made = []
    for label, keyword, name, identifier in FAMILIES:
        for kind, priority, confidence, form in FORMS:
            by_id = kind in ("identifier", "field")
            pattern = form % {"id": identifier, "name": name}
            made.append(Signature(label, "licen" if by_id else keyword, _whole_words(pattern), priority, confidence))
    granted = {kind: (priority, confidence, form) for kind, priority, confidence, form in FORMS}
    for label, keyword, name in SHORT_NAMES:
        for kind in ("grant", "name"):
            priority, confidence, form = granted[kind]
            made.append(Signature(label, keyword, _whole_words(form % {"name": name}), priority, confidence))
    made += [Signature(label, keyword, _whole_words(p), *_SENTENCE) for label, keyword, p in SENTENCES]
    made += [Signature(label, keyword, _whole_words(p), *_ADDRESS) for label, keyword, p in ADDRESSES]
    return sorted(made, key=lambda s: -s.priority)


@cache
def _base() -> list[tuple[str, str, re.Pattern]]:
    return [(phrase.split()[0], label, _whole_words(phrase)) for phrase, label in BASE_PHRASES]


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for keyword in {s.keyword for s in signatures()} | {key for key, _, _ in _base()}:
        found.add_word(keyword, keyword)
    found.make_automaton()
    return found


def resolve(detections: list[Detection]) -> list[Detection]:
    """Leaves out what lies within a longer detection, or in an equal one of higher priority.

    Of equal places and priorities the first given stays. What overlaps without containment stays.
    """
    kept: list[Detection] = []
    reach = -1
    # A container starts no later and, starting at the same word, ends no earlier: it was seen before.
    for d in sorted(detections, key=lambda d: (d.first, -d.last, -d.priority)):
        if d.last > reach:
            kept.append(d)
            reach = d.last
    return kept


def scan(text: str) -> dict:
    """The scan's columns for one whole text."""
    raw = text.encode().lower()
    word = _IS_WORD[np.frombuffer(raw, np.uint8)]
    starts = np.flatnonzero(np.diff(word, prepend=0) == 1)
    low = raw.decode("latin-1")  # a character for each byte
    keywords = {keyword for _, keyword in _automaton().iter(low)}

    def places(pattern: re.Pattern) -> list[tuple[int, int]]:
        spans = [m.span() for m in pattern.finditer(low)]
        return [
            (int(np.searchsorted(starts, a, "right")) - 1, int(np.searchsorted(starts, b - 1, "right")) - 1)
            for a, b in spans
        ]

    base = [(label, *at) for key, label, pattern in _base() if key in keywords for at in places(pattern)]
    found = [Detection(label, first, last, *_BASE) for label, first, last in base]
    for s in signatures():
        if s.keyword in keywords:
            found += [Detection(s.label, first, last, s.priority, s.confidence) for first, last in places(s.pattern)]
    kept = resolve(found)
    base_labels = {label for label, _, _ in base}
    best: dict[str, float] = {}
    for d in kept:
        best[d.label] = max(best.get(d.label, 0.0), d.confidence)
    doubt = 1.0
    for label in sorted(best):
        doubt *= 1.0 - best[label]
    return {
        "n_words": len(starts),
        "n_base": len(base),
        "first_word": min((first for _, first, _ in base), default=None),
        "last_word": max((first for _, first, _ in base), default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | set(best))),
        "score": round(1.0 - doubt, 6),
        "n_detections": len(kept),
    }


SCHEMA = (
    "id string, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_detections long"
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id and what ``scan`` finds in the whole text.

    A null or empty text has no words, no labels and a score of 0. A null doc_id stays null; repeated rows
    are scanned each; other columns are left out. Nothing is shuffled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([scan(text) for text in batch["text"]], columns=[c.split()[0] for c in SCHEMA.split(", ")][1:])
            out.insert(0, "id", batch["id"].to_numpy())
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    # The id travels as text: pandas would make a float of a long with nulls.
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    scanned = texts.mapInPandas(run, SCHEMA)
    return scanned.select(F.col("id").cast("long").alias("doc_id"), *scanned.columns[1:])
