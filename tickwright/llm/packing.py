"""Hierarchical packing of tokenised documents into sequences of several lengths.

Every task packs what it reads, so nothing is shuffled. Documents are taken in groups of about ``GROUP_CHARS``
characters; a group's last window is the only one that may need padding.
"""

from collections.abc import Iterator

import base64
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_TOKENS = 16 * 2048
GROUP_CHARS = 8_000_000
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)


class Encoder:
    """Ids as the tokenizer file gives them.

    The rank file holds the same merges and is several times faster; texts that spell out a special token,
    which the tokenizer file knows and the ranks don't, go to the tokenizer itself.
    """

    def __init__(self, json_path: str, rank_path: str):
        with open(rank_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.full = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            found = self.full.encode(text, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(text)
        return np.array([*found, END_ID], dtype="<u4")


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences as (tier, [(document, start, length), ...]).

    A document gives whole windows of the longest tier first; its rest goes to the shortest tier that holds
    it. From the longest tier down, each rest opens a window, whose gap is filled from the shorter tiers,
    the longest first, and then from its own tier; what doesn't fit is cut and goes on in its tier.
    """
    top = tiers[-1]
    waiting: list[list[tuple[int, int, int]]] = [[] for _ in tiers]
    sequences = []

    def wait(doc: int, start: int, length: int) -> None:
        waiting[next(k for k, tier in enumerate(tiers) if length <= tier)].append((doc, start, length))

    for doc, length in enumerate(lengths):
        whole = length // top * top
        sequences += [(top, [(doc, start, top)]) for start in range(0, whole, top)]
        if length > whole:
            wait(doc, whole, length - whole)
    for k in reversed(range(len(tiers))):
        while waiting[k]:
            pieces, gap = [waiting[k].pop()], tiers[k]
            gap -= pieces[0][2]
            for shorter in [*reversed(range(k)), k]:
                while gap and waiting[shorter]:
                    doc, start, length = waiting[shorter].pop()
                    taken = min(gap, length)
                    pieces.append((doc, start, taken))
                    gap -= taken
                    if taken < length:
                        wait(doc, start + taken, length - taken)
            # Only a group's last window has a gap here: nothing waits in this tier or below.
            sequences.append((tiers[k] if not gap else top, pieces))
    return sequences


def pack_documents(
    docs: DataFrame,
    json_path: str | None = None,
    rank_path: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Pieces of all documents in sequences of the lengths in ``tiers``, full but for the last of a group.

    ``step_group`` gathers sequences of one tier and task up to ``step_tokens`` tokens, so that all steps
    weigh the same. A null text is an empty one: its only id is ``END_ID``. A null doc_id stays null; equal
    ids and repeated rows are separate documents. Other columns are left out. Sequence ids are unique, not
    gapless: the task's number is in their upper bits.
    """
    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
    rank_path = rank_path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(json_path, rank_path)
        serial = TaskContext.get().partitionId() << 33
        opened = {tier: 0 for tier in tiers}

        def packed(group: list[tuple]) -> pd.DataFrame:
            nonlocal serial
            ids = [encoder.ids(text) for _, text in group]
            rows = []
            for tier, pieces in pack([len(x) for x in ids], tiers):
                step = opened[tier] * tier // step_tokens
                opened[tier] += 1
                offset = 0
                for doc, start, length in pieces:
                    crc = zlib.crc32(ids[doc][start : start + length].tobytes())
                    rows.append((doc, start, length, crc, len(ids[doc]), serial, offset, tier, step))
                    offset += length
                serial += 1
            out = pd.DataFrame(
                rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step"]
            )
            base = TaskContext.get().partitionId() << 33
            out["step_group"] = base + out.pop("step") * len(tiers) + out["tier"].map({t: k for k, t in enumerate(tiers)})
            out["doc_id"] = pd.array([group[d][0] for d in out["doc_id"]], dtype="Int64")
            return out

        group, chars = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].array, batch["text"]):
                group.append((doc_id, text))
                chars += len(text)
                if chars >= GROUP_CHARS:
                    yield packed(group)
                    group, chars = [], 0
        if group:
            yield packed(group)

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # A nullable id becomes a float in pandas; as text it stays exact.
    exact = texts.withColumn("doc_id", F.col("doc_id").cast("string"))

    def run_exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def whole(batch: pd.DataFrame) -> pd.DataFrame:
            ids = [None if x is None else int(x) for x in batch["doc_id"]]
            return pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "text": batch["text"]})

        return run(map(whole, batches))

    return exact.mapInPandas(run_exact, SCHEMA)
