"""Near-duplicates by bottom-k sketches of word shingles.

One hash function orders all shingles; a document retains its smallest values. Inverted lists of runs of
retained values bring together documents that overlap, the union sketch estimates how much, and whole
shingle sets decide. Where a neighbourhood is compared, only documents that share one of their rarest
shingles are: a passage that all of them hold brings no pair.
"""

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickwright.llm.components import components
from tickwright.llm.hashing import BASE, Powers, distinct_shingles, mixed
from tickwright.session import shared_dir

SHINGLE = 5
PERCENT = 80
#: Retained values. Two sets that share 80 % have no run in common with a chance of about 1e-10.
RETAINED = 64
#: A run is so many neighbouring retained values: single ones that half the corpus has would bring all together.
RUN = 3
#: Up to so many shingles, runs of two are listed too: a set of four and one of five may share no run of three.
FEW = 8
#: Links are looked for where the estimate is at most so far below the threshold, six deviations at 64 values.
MARGIN = 0.3
#: Shingles that one task compares at once; larger neighbourhoods are dealt out in blocks.
BLOCK_SHINGLES = 1_000_000
CHUNK_CHARS = 1_000_000
#: Texts that go to Python at a time: a batch stands in memory on both sides of the pipe.
BATCH_ROWS = 1_000
_SKETCH = "doc_id long, n long, class_a long, class_b long, runs array<long>"


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """For what is run within: at most BATCH_ROWS rows in a batch for Python, or what the session has, if fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(n for n in (int(before), BATCH_ROWS) if n > 0)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches cut to about CHUNK_CHARS characters."""
    for batch in batches:
        if len(batch):
            chunk = batch["text"].str.len().cumsum() // CHUNK_CHARS
            for _, part in batch.groupby(chunk.to_numpy(), sort=True):
                yield part


def _runs(retained: np.ndarray, size: int) -> np.ndarray:
    n = len(retained) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.full(n, size, np.uint64)
    for k in range(size):
        key = mixed(key * BASE + retained[k : k + n])
    return key


def _listed(shingles: np.ndarray) -> np.ndarray:
    retained = shingles[:RETAINED]
    few = _runs(retained, RUN - 1) if len(shingles) <= FEW else np.zeros(0, np.uint64)
    return np.unique(np.concatenate([_runs(retained, RUN), few])).view(np.int64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, shingle count, two hashes of the whole set and the keys of its runs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Powers()
        for chunk in _chunks(batches):
            values, counts = distinct_shingles([t.encode().lower() for t in chunk["text"]], size, known)
            sets = np.split(values, np.cumsum(counts)[:-1])
            # Sums over the values, scrambled anew: equal for equal sets.
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values ^ salt))]) for salt in (BASE, ~BASE)]
            after = np.cumsum(counts)
            a, b = [(s[after] - s[after - counts]).view(np.int64) for s in sums]
            listed = [_listed(s) for s in sets]
            yield pd.DataFrame({"doc_id": chunk["doc_id"].to_numpy(), "n": counts, "class_a": a, "class_b": b, "runs": listed})

    return docs.select("doc_id", "text").mapInPandas(run, _SKETCH)


def _prefixes(values: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, shingle), in order of owners: the rarest shingles of each set, of which linked sets share one at least.

    All shingles are ranked alike, the rarest first. A link leaves at most ``n - percent * n`` of a set's ``n``
    shingles outside the other set, so among one more than that, of either set, there is a common one.
    """
    kinds, which, met = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.empty(len(kinds), np.int64)
    rank[np.lexsort((kinds, met))] = np.arange(len(kinds))
    owner, ranked = np.repeat(np.arange(len(counts)), counts), rank[which]
    order = np.lexsort((ranked, owner))
    place = np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)
    most = counts + (-percent * counts) // 100 + 1
    early = place < np.repeat(most, counts)
    return owner[order][early], ranked[order][early]


def _tree_links(
    ids: np.ndarray, texts: list[str], asked: np.ndarray, joined: np.ndarray, size: int, percent: int
) -> list[tuple[int, int]]:
    """Links that connect what is linked with the documents ``asked``, a tree for each component.

    Those asked are numbers of documents, in turn compared with all that they aren't connected with yet.
    ``joined`` marks documents that are known to be connected with each other; another one that comes to be
    connected with them is not asked any more.
    """
    values, counts = distinct_shingles([t.encode().lower() for t in texts], size, Powers())
    after = np.cumsum(counts)
    sets = np.split(values, after[:-1])
    m = len(ids)
    parent = np.arange(m)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sketch = [s[:RETAINED] for s in sets]
    table = np.full((m, RETAINED), np.iinfo(np.uint64).max, np.uint64)
    for row, s in zip(table, sketch):
        row[: len(s)] = s
    # Up to here a document retains all its values.
    complete = np.array([s[-1] if len(whole) > RETAINED else np.iinfo(np.uint64).max for s, whole in zip(sketch, sets)], np.uint64)
    own, rare = _prefixes(values, counts, percent)
    begins = np.searchsorted(own, np.arange(m + 1))
    by_rank = np.argsort(rare, kind="stable")
    holder, listed = own[by_rank], rare[by_rank]

    def candidates(x: int) -> np.ndarray:
        """Documents of a fitting size that share one of their rarest shingles with x and aren't connected with it yet."""
        prefix = rare[begins[x] : begins[x + 1]]
        low, high = np.searchsorted(listed, prefix, "left"), np.searchsorted(listed, prefix, "right")
        met = np.zeros(m, bool)
        for first, after in zip(low, high):
            if after - first > 1:
                met[holder[first:after]] = True
        met &= 100 * np.minimum(counts, counts[x]) >= percent * np.maximum(counts, counts[x])
        near = np.flatnonzero(met)
        tops = parent[near]
        while (tops != parent[tops]).any():
            tops = parent[tops]
        return near[tops != root(x)]

    def linked(x: int) -> list[int]:
        """Documents that reach the threshold with x."""
        near = candidates(x)
        if not len(near):
            return []
        reach = np.minimum(complete[near], complete[x])
        theirs = table[near]
        within = (theirs <= reach[:, None]) & (np.arange(RETAINED) < counts[near, None])
        at = np.minimum(np.searchsorted(sketch[x], theirs), len(sketch[x]) - 1)
        shared = (within & (sketch[x][at] == theirs)).sum(axis=1)  # lie within both sketches, so within reach
        union = np.searchsorted(sketch[x], reach, "right") + within.sum(axis=1) - shared
        estimate = shared / np.maximum(union, 1)
        found = []
        for y in near[estimate >= percent / 100 - MARGIN]:
            both = np.intersect1d(sets[x], sets[y], assume_unique=True).size
            if 100 * both >= percent * (counts[x] + counts[y] - both):
                found.append(y)
        return found

    known = np.flatnonzero(joined)
    parent[known] = known[0] if len(known) else 0
    edges = []
    for x in asked:
        if counts[x] and (joined[x] or not len(known) or root(x) != root(known[0])):
            for y in linked(x):
                a, b = sorted((root(x), root(y)))
                if a != b:
                    parent[b] = a
                    edges.append((int(ids[x]), int(ids[y])))
    return edges


def _blocks(weight) -> "F.Column":
    return F.ceil(weight / BLOCK_SHINGLES).cast("long")


def _every(blocks: str) -> "F.Column":
    return F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)


def near_links(spark: SparkSession, docs: DataFrame, lists: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) that connect all that is linked; ``lists`` has a row (run, doc_id, n) for each listed run.

    Whoever shares a run with another shares the run's head with it, its smallest id. So documents are
    compared around their heads, in blocks that a task can hold: first all with the head, then those that
    aren't linked to it with all. A neighbourhood of one block does both at once.
    """
    heads = lists.groupBy("run").agg(F.min("doc_id").alias("head"), F.count("*").alias("m")).where("m > 1").drop("m")
    path = shared_dir(spark, "heads")
    lists.join(heads, "run").groupBy("head", "doc_id").agg(F.max("n").alias("n")).write.parquet(path)
    stars = spark.read.parquet(path)
    weights = stars.groupBy("head").agg(F.sum("n").alias("weight"), F.count("*").alias("m")).where("m > 1")
    sized = weights.select("head", _blocks(F.col("weight")).alias("blocks"))
    members = stars.join(sized, "head").withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks"))
    texts = docs.select(F.col("doc_id").alias("id"), "text")

    def with_texts(tasks: DataFrame) -> DataFrame:
        # Members grow with the corpus: they are joined alike at every size, not broadcast at a small one.
        return texts.join(tasks.hint("merge"), F.col("id") == F.col("doc_id")).drop("id")

    def around_head(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["doc_id", "text"])
        ids, large = group["doc_id"].to_numpy(), group["blocks"].iloc[0] > 1
        is_head = ids == group["head"].iloc[0]
        asked = np.flatnonzero(is_head) if large else np.concatenate([np.flatnonzero(is_head), np.flatnonzero(~is_head)])
        found = _tree_links(ids, list(group["text"]), asked, is_head, size, percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64").assign(large=large)

    is_head = F.col("head") == F.col("doc_id")
    in_blocks = members.withColumn("block", F.explode(F.when(is_head, _every("blocks")).otherwise(F.array("block"))))
    first_path = shared_dir(spark, "links-with-heads")
    with_texts(in_blocks).groupBy("head", "block").applyInPandas(
        around_head, "a long, b long, large boolean"
    ).write.parquet(first_path)
    first = spark.read.parquet(first_path)
    links = first.select("a", "b")
    if not sized.where("blocks > 1").limit(1).count():
        return links

    def among_members(group: pd.DataFrame) -> pd.DataFrame:
        # Who is asked may also be a member of this block.
        group = group.sort_values("asked", ascending=False).drop_duplicates(["doc_id", "text"])
        asked = np.flatnonzero(group["asked"].to_numpy())
        found = _tree_links(group["doc_id"].to_numpy(), list(group["text"]), asked, group["joined"].to_numpy(), size, percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    direct = first.where("large").select(F.col("a").alias("head"), F.col("b").alias("doc_id"), F.lit(True).alias("direct"))
    large = members.where((F.col("blocks") > 1) & ~is_head).join(direct, ["head", "doc_id"], "left")
    large = large.withColumn("joined", F.col("direct").isNotNull())
    open_weights = large.where(~F.col("joined")).groupBy("head").agg(F.sum("n").alias("open_weight"))
    asked = large.join(open_weights.select("head", _blocks(F.col("open_weight")).alias("open_blocks")), "head")
    columns = ["doc_id", "head", "part", "block", "asked", "joined"]
    searched = asked.select("*", F.explode(_every("open_blocks")).alias("part"), F.lit(False).alias("asked"))
    own_part = F.pmod(F.xxhash64("doc_id", F.lit("open")), "open_blocks").alias("part")
    asking = asked.where(~F.col("joined")).drop("block").select("*", own_part, F.lit(True).alias("asked"), F.explode(_every("blocks")).alias("block"))
    tasks = searched.select(*columns).unionByName(asking.select(*columns))
    return links.unionByName(
        with_texts(tasks).groupBy("head", "part", "block").applyInPandas(among_members, "a long, b long")
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row for each row of docs.

    Documents whose sets of ``size``-word shingles share ``percent`` of their union are linked; a component
    is named by its smallest doc_id, the one that is kept. Fewer words are one shingle. Documents without
    words (null, empty or blank texts) and rows without an id are linked with nothing and kept. Rows with
    one id are judged by their own texts. Other columns are left out.

    Equal sets are one class, of which the smallest id is compared for all.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    path = shared_dir(spark, "sketches")
    with _small_batches(spark):
        sketches(rows.where("doc_id IS NOT NULL"), size).write.parquet(path)
    sketched = spark.read.parquet(path)
    classes_path = shared_dir(spark, "classes")
    sketched.where("n > 0").groupBy("class_a", "class_b", "n").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("m"), F.min_by("runs", "doc_id").alias("runs")
    ).write.parquet(classes_path)
    classes = spark.read.parquet(classes_path)
    links_path = shared_dir(spark, "near-links")
    lists = classes.select(F.col("rep").alias("doc_id"), "n", F.explode("runs").alias("run"))
    near_links(spark, rows, lists, size, percent).write.parquet(links_path)
    roots = components(spark, spark.read.parquet(links_path))
    copied = classes.join(roots, F.col("rep") == F.col("node"), "left").where("m > 1 OR root IS NOT NULL")
    component = copied.select(
        F.col("class_a").alias("a"), F.col("class_b").alias("b"), F.col("n").alias("c"), F.coalesce("root", "rep").alias("component")
    )
    same = (F.col("class_a") == F.col("a")) & (F.col("class_b") == F.col("b")) & (F.col("n") == F.col("c"))
    named = sketched.select("doc_id", "n", "class_a", "class_b").join(component, same, "left")
    judged = named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    nameless = sketches(rows.where("doc_id IS NULL").withColumn("doc_id", F.lit(0).cast("long")), size)
    nothing = F.lit(None).cast("long")
    judged = judged.unionByName(
        nameless.select(nothing.alias("doc_id"), F.col("n").alias("n_shingles"), nothing.alias("component_id"))
    )
    return judged.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _numbered(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """Each different (id, a, b) with a ``number`` of its own, in the order of ids.

    The rows are written in ranges: all numbers must come from the same cuts.
    """
    path = shared_dir(spark, "numbers")
    ranged = texts.select("id", "a", "b").distinct().repartitionByRange("id", "a", "b")
    ranged.withColumn("part", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # a row for each range
    before, starts = 0, []
    for size in sizes:
        starts.append((size.part, before))
        before += size.n
    offsets = spark.createDataFrame(starts, "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy("id", "a", "b"))
    placed = rows.withColumn("place", place).join(F.broadcast(offsets), "part")
    return placed.select("id", "a", "b", (F.col("before") + F.col("place")).alias("number"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all their columns, of the smallest id of each component.

    Rows that share an id but not their text are documents of their own, each judged by its text; of equal or
    near-duplicate rows of one id one stays, if that id does. Rows without an id all stay.
    """
    # The row travels as one column, so that no name of docs can clash.
    text = F.coalesce("text", F.lit(""))
    hashes = F.xxhash64(text).alias("a"), F.xxhash64(F.lit("again"), text).alias("b")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), *hashes)
    named, nameless = rows.where("id IS NOT NULL"), rows.where("id IS NULL").select("row")
    differing = named.groupBy("id").agg(
        F.min("a").alias("a"), F.max("a").alias("most_a"), F.min("b").alias("b"), F.max("b").alias("most_b")
    ).where("a != most_a OR b != most_b")
    if differing.limit(1).count():
        # Members and links are told by a number for each id and text.
        numbers = _numbered(spark, named).select(F.col("id").alias("n_id"), F.col("a").alias("n_a"), F.col("b").alias("n_b"), "number")
        same = (F.col("id") == F.col("n_id")) & (F.col("a") == F.col("n_a")) & (F.col("b") == F.col("n_b"))
        path = shared_dir(spark, "numbered")
        named.join(numbers.hint("merge"), same).select("row", F.col("number").alias("id")).write.parquet(path)
        named = spark.read.parquet(path)
    judged = named.select(F.col("id").alias("doc_id"), F.col("row.text").alias("text"))
    staying = near_duplicates(spark, judged, size, percent).groupBy("doc_id").agg(F.max("kept").alias("stays")).where("stays")
    found = named.select("row", "id").join(staying.hint("merge"), F.col("id") == F.col("doc_id"))
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.col("row.text")))
    one = found.withColumn("first", first).where("first = 1").select("row")
    return one.unionByName(nameless).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
