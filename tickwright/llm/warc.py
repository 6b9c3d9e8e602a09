"""WARC archives of pages and a two-level index of their captures.

Records are gzip members of their own, so one can be read by its place alone. The index sorts captures by
reversed host and path into compressed blocks; a directory keeps the first key of each block, and the first
key of each shard of blocks is all that a lookup holds besides one shard. A lookup searches the shards, then
a shard's directory, then one block, and the record is cut out of its archive by offset and length.

Archives are written and read by Spark alone, so any storage will do that Spark can reach.
"""

import bisect
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickwright.session import shared_dir

#: Compressed bytes after which an archive is closed.
ARCHIVE_BYTES = 4_000_000
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Captures of an index block and blocks of a shard.
BLOCK_CAPTURES = 1000
SHARD_BLOCKS = 50
#: A lookup keeps a first key for each shard; with more captures than this holds, shards grow.
MOST_SHARDS = 10_000
_VERSION = "WARC/1.1"


def search_key(url: str | None) -> str:
    """Reversed host, port, then the path as it is: ``http://www.a.org:80/x?y`` gives ``org,a:80)/x?y``.

    Scheme, user, a leading ``www.`` and fragment don't count; a null URL is an empty one; what has no host is
    taken as it is. Control characters are written as %XX, as in the record.
    """
    text = clean_url(url)
    rest = text.split("://", 1)[-1].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    if not slash:
        host, mark, query = rest.partition("?")
        path = mark + query
    host = host.rsplit("@", 1)[-1].lower()
    name, colon, port = host.partition(":")
    name = name.removeprefix("www.")
    return ",".join(reversed(name.split("."))) + colon + port + ")/" + path


def clean_url(url: str | None) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url or "")


def _urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _id(urn: str) -> int | None:
    name = urn.strip("<>").rsplit(":", 1)[-1]
    return None if name == "none" else int(name)


def record(page_id, url: str, digest: str, size: int, refers_to, payload: bytes) -> bytes:
    """One record as a gzip member."""
    head = [
        _VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Target-URI: {clean_url(url)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_urn(refers_to)}")
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join([*head, "", ""]).encode() + payload + b"\r\n\r\n") + pack.flush()


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != _VERSION:
        raise ValueError(f"not a record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def members(archive: bytes) -> Iterator[tuple[int, int]]:
    """Offset and length of each gzip member; zeros between members are padding."""
    at, view, step = 0, memoryview(archive), 1 << 16
    while at < len(archive):
        if not archive[at]:
            at += 1
            continue
        unpack, read = zlib.decompressobj(31), at
        while not unpack.eof and read < len(archive):
            unpack.decompress(view[read : read + step])
            read += step
        if not unpack.eof:
            raise ValueError(f"member at {at} ends early")
        end = min(read, len(archive)) - len(unpack.unused_data)
        yield at, end - at
        at = end


def _revisits(pages: DataFrame) -> DataFrame:
    """Adds ``refers_to``. The join is on digests; adaptive execution splits one that many pages share."""
    first = (
        pages.where(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("m"))
        .where("m > 1 AND first IS NOT NULL")
        .select(F.col("digest").alias("d"), F.col("size").alias("s"), "first")
    )
    same = (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return pages.join(first, same, "left").withColumn("refers_to", F.when(F.col("first").isNotNull(), refers)).drop("d", "s", "first")


def write_archives(pages: DataFrame, path: str) -> None:
    """A record for each row of pages (page_id, url, html) in archives under ``path``.

    Of equal payloads of REVISIT_BYTES or more the largest page_id is stored, the others refer to it; rows
    that repeat that id are stored too, and rows without an id refer to it. A null html is an empty payload,
    a null url an empty address. Other columns are left out.
    """
    html = F.coalesce("html", F.lit(""))

    def zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            batch["html"] = [pack.compress(h.encode()) for h in batch["html"]]
            yield batch

    small = pages.select(
        F.col("page_id").cast("long").cast("string").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        html.alias("html"),
        F.sha1(F.encode(html, "UTF-8")).alias("digest"),
        F.octet_length(html).cast("long").alias("size"),
    ).mapInPandas(zipped, "page_id string, url string, html binary, digest string, size long")
    rows = _revisits(small.withColumn("page_id", F.col("page_id").cast("long")))
    ids = [F.col(c).cast("string").alias(c) for c in ("page_id", "refers_to")]

    def archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, parts, size = zstandard.ZstdDecompressor(), [], 0
        for batch in batches:
            for page_id, url, digest, n, refers_to, html in batch.itertuples(index=False):
                parts.append(record(page_id, url, digest, n, refers_to, unpack.decompress(html)))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield pd.DataFrame({"archive": [b"".join(parts)]})
                    parts, size = [], 0
        if parts:
            yield pd.DataFrame({"archive": [b"".join(parts)]})

    made = rows.select(ids[0], "url", "digest", "size", ids[1], "html").mapInPandas(archives, "archive binary")
    # Spark's text writer puts out the bytes as they are, an archive to a file, and a zero after it, which
    # gzip takes as padding.
    raw = made.select(F.col("archive").cast("string"))
    raw.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """key, page_id, archive, offset, length of every record, by reading the archives from end to end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["archive"], batch["content"]):
                rows = []
                for offset, length in members(content):
                    fields, _ = parsed(content[offset : offset + length])
                    rows.append((search_key(fields["WARC-Target-URI"]), fields["WARC-Record-ID"], name, offset, length))
                yield pd.DataFrame(rows, columns=["key", "record_id", "archive", "offset", "length"])

    return _archives(spark, path).mapInPandas(run, "key string, record_id string, archive string, offset long, length long")


def write_index(spark: SparkSession, found: DataFrame, path: str) -> None:
    """Blocks of captures in order of key and record id: shard, block, first key, compressed lines."""
    kept = shared_dir(spark, "captures")
    found.write.parquet(kept)
    rows = spark.read.parquet(kept)
    shards = min(MOST_SHARDS, 1 + rows.count() // (BLOCK_CAPTURES * SHARD_BLOCKS))
    order = ["key", "record_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, block, lines, first = TaskContext.get().partitionId(), 0, [], None

        def closed() -> pd.DataFrame:
            data = zlib.compress("\n".join(lines).encode())
            return pd.DataFrame([(shard, block, *first, len(lines), data)], columns=["shard", "block", *order, "n", "data"])

        for batch in batches:
            for row in batch.itertuples(index=False):
                first = first or (row.key, row.record_id)
                lines.append("\t".join(map(str, row)))
                if len(lines) == BLOCK_CAPTURES:
                    yield closed()
                    block, lines, first = block + 1, [], None
        if lines:
            yield closed()

    sorted_ = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    schema = "shard long, block long, key string, record_id string, n long, data binary"
    sorted_.select(*order, "archive", "offset", "length").mapInPandas(run, schema).write.parquet(path)


class _Shard:
    """The blocks of one shard, unpacked when a search comes to them."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("block")
        self.firsts = list(zip(rows["key"], rows["record_id"]))
        self.data = list(rows["data"])
        self.open: dict[int, tuple[list, list]] = {}

    def block(self, k: int) -> tuple[list, list]:
        if k not in self.open:
            lines = [line.split("\t") for line in zlib.decompress(self.data[k]).decode().split("\n")]
            self.open = {k: ([(x[0], x[1]) for x in lines], lines)}  # queries come in order: one block is enough
        return self.open[k]

    def find(self, key: tuple[str, str]) -> Iterator[list[str]]:
        """The captures of a key, which may go on in the next blocks."""
        k = max(bisect.bisect_left(self.firsts, key) - 1, 0)
        while k < len(self.firsts) and self.firsts[k] <= key:
            keys, lines = self.block(k)
            yield from lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
            k += 1


def lookup(spark: SparkSession, index_path: str, wanted: DataFrame) -> DataFrame:
    """archive, offset, length of the captures of each different (key, record_id) in ``wanted``."""
    blocks = spark.read.parquet(index_path)
    tops = sorted(
        (r.top.key, r.top.record_id, r.shard)
        for r in blocks.groupBy("shard").agg(F.min(F.struct("key", "record_id")).alias("top")).collect()  # a row for each shard
    )
    keys, shards = [t[:2] for t in tops], np.array([t[2] for t in tops] or [0])

    @F.pandas_udf("long")
    def shard_of(key: pd.Series, record_id: pd.Series) -> pd.Series:
        at = [max(bisect.bisect_right(keys, x) - 1, 0) for x in zip(key, record_id)]
        return pd.Series(shards[at] if at else [], dtype="int64")

    asked = wanted.select("key", "record_id").distinct().withColumn("shard", shard_of("key", "record_id"))

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        shard = _Shard(rows)
        found = [x[2:] for key in sorted(zip(queries["key"], queries["record_id"])) for x in shard.find(key)]
        out = pd.DataFrame(found, columns=["archive", "offset", "length"])
        return out.astype({"offset": "int64", "length": "int64"})

    return asked.groupBy("shard").cogroup(blocks.groupBy("shard")).applyInPandas(search, "archive string, offset long, length long")


def read_records(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records at the places given.

    The digest of a stored payload is taken from the payload; a revisit has that of what it refers to.
    """
    ranges = places.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("ranges"))
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content, wanted in zip(batch["content"], batch["ranges"]):
                rows = []
                for place in wanted:
                    fields, payload = parsed(content[place["offset"] : place["offset"] + place["length"]])
                    kind, refers_to = fields["WARC-Type"], None
                    size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "revisit":
                        refers_to = str(_id(fields["WARC-Refers-To"]))
                    else:
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    page_id = _id(fields["WARC-Record-ID"])
                    rows.append((None if page_id is None else str(page_id), size, digest, kind, refers_to))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    files = _archives(spark, path).join(ranges, "archive")
    read = files.select("content", "ranges").mapInPandas(run, schema)
    ids = {c: F.col(c).cast("long") for c in ("page_id", "refers_to")}
    return read.withColumns(ids)


def key_columns(pages: DataFrame) -> DataFrame:
    """The index key of each page."""

    @F.pandas_udf("string")
    def key(url: pd.Series) -> pd.Series:
        return pd.Series([search_key(u) for u in url], dtype=object)

    urn: Column = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("long").cast("string"), F.lit("none")), F.lit(">"))
    return pages.select(key("url").alias("key"), urn.alias("record_id"))


def archive_and_read(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes and indexes all pages, looks each up and reads its record back."""
    path, index = shared_dir(spark, "warc"), shared_dir(spark, "warc-index")
    write_archives(pages, path)
    write_index(spark, captures(spark, path), index)
    return read_records(spark, path, lookup(spark, index, key_columns(pages)))
