"""Encoding of a corpus with a public byte-level tokenizer, in two tiers.

First tier: a minimal perfect hash over the vocabulary resolves every pre-token that is a token itself (hash,
displacement, slot, and a comparison with the stored bytes). Second tier: the other pre-tokens are merged by a heap
of candidate pairs over linked bytes. The hash is built once on the driver (its size is that of the vocabulary) and
broadcast; workers remember a bounded number of second-tier results.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

# Fixed value: the public pattern that splits text before the merges of the 50k byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
REMEMBERED = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: bytes -> id; the id is also the rank of the merge."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PerfectHash:
    """A minimal perfect hash by displacement: n keys, n slots, one displacement for each bucket of about four keys."""

    def __init__(self, keys: list[bytes], values: list[int]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 4)
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        taken = np.zeros(n, bool)
        slot_of = np.empty(n, np.int64)
        self.move = np.zeros(self.buckets, np.int64)
        single = []
        for b in np.argsort(-np.diff(edges), kind="stable"):
            own = order[edges[b] : edges[b + 1]]
            if len(own) <= 1:
                single += [(b, own[0])] if len(own) else []
                continue
            for low in range(1, 1 << 24, 128):  # displacements are tried in blocks
                tries = np.arange(low, low + 128, dtype=np.uint64)
                slots = self._slots(hashes[own][None, :], tries[:, None])
                ordered = np.sort(slots, 1)
                free = ~taken[slots].any(1) & (ordered[:, 1:] != ordered[:, :-1]).all(1)
                if free.any():
                    s, d = slots[k := int(free.argmax())], int(tries[k])
                    break
            else:
                raise ValueError("two keys have the same hash")
            taken[s], slot_of[own], self.move[b] = True, s, d
        for (b, k), s in zip(single, np.flatnonzero(~taken)):
            slot_of[k], self.move[b] = s, -1 - s  # a lone key goes straight to a free slot
        inverse = np.empty(n, np.int64)
        inverse[slot_of] = np.arange(n)
        self.keys = [keys[k] for k in inverse]
        self.values = [values[k] for k in inverse]

    def _slots(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        x = (h ^ h >> np.uint64(32)) * (d * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))
        return ((x ^ x >> np.uint64(29)) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int | None]:
        """The value of each key, None for one that isn't there."""
        if not keys:
            return []
        h = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        move = self.move[(h % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(move < 0, -1 - move, self._slots(h, np.maximum(move, 0).astype(np.uint64)))
        return [self.values[s] if self.keys[s] == k else None for s, k in zip(slot.tolist(), keys)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the pair of the lowest rank merges first, the leftmost among equals; bytes are a linked list."""
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that begins here ends; 0: it was merged into another
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (k := before[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
            heapq.heappush(heap, (r, k, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


_SPLIT = regex.compile(PATTERN)
_known: dict[str, dict[str, list[int]]] = {}


def encode_batch(texts: list[str | None], table: PerfectHash, ranks: dict[bytes, int], known: dict[str, list[int]]) -> list[list[int]]:
    split = [_SPLIT.findall(t) if t else [] for t in texts]
    if len(known) > REMEMBERED:
        known.clear()
    new = list({p for parts in split for p in parts if p not in known})
    raw = [p.encode("utf-8", "surrogatepass") for p in new]
    for p, b, i in zip(new, raw, table.find(raw)):
        known[p] = [i] if i is not None else merge(b, ranks)
    return [[i for p in parts for i in known[p]] for parts in split]


def encode(df: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): the ids of each text of (doc_id, text) by a rank file, without special tokens.

    A null and an empty text have an empty list. Every row gives a row (repeated rows too); special tokens' strings are ordinary
    text; other columns of ``df`` are ignored.
    """
    spark = df.sparkSession
    ranks = read_ranks(vocabulary)
    shared = spark.sparkContext.broadcast((PerfectHash(list(ranks), list(ranks.values())), ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, merges = shared.value
        known = _known.setdefault(vocabulary, {})
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                ids = encode_batch(part.column("text").to_pylist(), table, merges, known)
                edges = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.fromiter((i for x in ids for i in x), np.int32, int(edges[-1]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))], ["doc_id", "ids"])

    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(c.table(spark, sf_dir, "documents"))
