"""Archives and their index, by round trips."""

import hashlib
import zlib

import pytest

from tickwright.llm import warc
from tickwright.llm.warc import archive_and_read, captures, clean_url, key_columns, lookup, members, parsed, record, search_key, write_archives, write_index
from tickwright.session import shared_dir

PAGES = "page_id long, url string, html string, digest string, size string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


def _pages():
    tricky = "x" * 2000 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n\0\x1f\x8b"
    rows = [(i, f"http://www.h{i % 7}.example.org/p/{i % 50}?q={i}#top", f"<p>{i % 90}</p>" * (10 + 3 * (i % 90))) for i in range(700)]
    rows += [
        (1000, None, None),
        (1001, "", ""),
        (1002, "ftp://user@Host.ORG:21/a b\r\nc\té", tricky),
        (1003, "no scheme at all", tricky),
        (1003, "no scheme at all", tricky),
        (None, "http://null.id/", "short"),
        (None, "http://null.id/", "long " * 400),
        (1004, "http://null.id/", "long " * 400),
        (1005, "http://same.org/", "é" * 500),
        (1006, "http://same.org/", "é" * 500),
        (1007, "http://same.org/", "é" * 499 + "x"),
        (1008, "http://same.org/", "é" * 499 + "x"),
        (1009, "http://big.org/", "big " * 500_000),
    ]
    return rows


def _expected(rows):
    best = {}
    for page_id, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000 and page_id is not None:
            best[raw] = max(page_id, best.get(raw, page_id))
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        first = best.get(raw)
        refers = first if first is not None and first != page_id else None
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("block,shard", [(1000, 50), (7, 3)])
def test_every_page_comes_back(spark, monkeypatch, block, shard):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", block)
    monkeypatch.setattr(warc, "SHARD_BLOCKS", shard)
    rows = _pages()
    found = sorted((tuple(r) for r in archive_and_read(spark, _frame(spark, rows)).collect()), key=str)
    assert found == _expected(rows)


def test_lookup_finds_what_a_scan_finds(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 4)
    monkeypatch.setattr(warc, "SHARD_BLOCKS", 2)
    pages = _frame(spark, _pages())
    path, index = shared_dir(spark, "w"), shared_dir(spark, "i")
    write_archives(pages, path)
    scanned = captures(spark, path)
    write_index(spark, scanned, index)
    wanted = key_columns(pages.where("page_id % 9 = 1")).union(spark.createDataFrame([("org,nowhere)/", "<urn:page:5>")], "key string, record_id string"))
    found = sorted(tuple(r) for r in lookup(spark, index, wanted).collect())
    keys = {tuple(r) for r in wanted.collect()}
    assert found == sorted((r.archive, r.offset, r.length) for r in scanned.collect() if (r.key, r.record_id) in keys)
    assert spark.read.parquet(index).select("shard").distinct().count() > 10


def test_no_pages(spark):
    assert archive_and_read(spark, _frame(spark, [])).count() == 0


def test_members_are_plain_gzip():
    two = [record(1, "u", "d", 3, None, b"abc"), record(2, "u", "d", 3, 1, b"abc")]
    places = list(members(b"".join(two) + b"\0\0"))
    assert places == [(0, len(two[0])), (len(two[0]), len(two[1]))]
    assert zlib.decompress(two[0], 31).endswith(b"\r\n\r\nabc\r\n\r\n")
    assert parsed(two[1])[0]["WARC-Refers-To"] == "<urn:page:1>" and parsed(two[1])[1] == b""
    with pytest.raises(ValueError):
        list(members(two[0][:-3]))


def test_search_keys():
    assert search_key("https://www.A.example.org:8080/x/?y#z") == "org,example,a:8080)/x/?y"
    assert search_key("http://a.org?q=1") == "org,a)/?q=1"
    assert search_key(None) == search_key("") == ")/"
    assert clean_url(clean_url("a b\n")) == clean_url("a b\n") == "a%20b%0A"
