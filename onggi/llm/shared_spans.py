"""Long exact spans shared between records, by prefix-partitioned suffix trees.

Not every suffix is needed to find the groups: of each piece of ``span`` characters the suffix of which the first half
hashes lowest is taken (the same one in every record that holds the piece), about one suffix in fifty. Suffixes whose
prefix of that length is found in one record only cannot branch and are dropped. The rest are split by variable-length
prefixes: a quarter of the sampled length, longer where the group would exceed ``group`` suffixes, so that each group fits
in memory. Hashes only bring suffixes together; what is equal is decided by characters.

A group's subtree is built over all suffixes around the sampled ones, as their suffix array by prefix doubling: ranks
of short prefixes are joined to ranks of prefixes twice as long, which are the nodes of the tree at depths 5, 10, 20 ... up
to ``span``. A node below which lies one record only is cut off with all its suffixes. The internal nodes at depth
``span`` are the repeats; touching ones are joined to maximal stretches. Equal surroundings of several records are one
leaf, and equal texts are one record with several owners from the start.

A prefix that stays too frequent at its full length (a text block in a third of all records) is no group of one task: its
distinct surroundings are counted by aggregation, a surrounding of two records is shared as a whole, and of the distinct ones
the pieces are compared by 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c
from .near_duplicates import _groups
from .repetition import rolling


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def sampled(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the lowest hash, the leftmost among equals, of some ``window`` neighbouring ones."""
    n = len(hashes)
    if n <= window:
        return np.array([hashes.argmin()]) if n == window else np.empty(0, np.int64)

    def slide(x: np.ndarray, size: int, best) -> np.ndarray:
        step = 1
        while step * 2 <= size:
            x = best(x[:-step], x[step:])
            step *= 2
        return best(x[: len(x) - (size - step)], x[size - step :]) if size > step else x

    if len(np.unique(hashes)) == n:
        least = slide(hashes, window, np.minimum)
        pad = np.zeros(window - 1, np.uint64)
        return np.flatnonzero(slide(np.concatenate([pad, least, pad]), window, np.maximum) == hashes)
    view = np.lib.stride_tricks.sliding_window_view(hashes, window)
    picks = [view[k : k + 4096].argmin(1) + np.arange(k, min(k + 4096, len(view))) for k in range(0, len(view), 4096)]
    return np.unique(np.concatenate(picks))


def _suffixes(span: int):
    half, quarter, eighth = span // 2, span // 4, span // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for unit, text in zip(batch.column("unit").to_pylist(), batch.column("text").to_pylist()):
                points = _points(text)
                h = rolling(points, half)
                at = sampled(h, span - half + 1)
                if len(at):
                    for x, v in zip(out, (np.full(len(at), unit), at, rolling(points, eighth)[at], rolling(points, quarter)[at], h[at])):
                        x.append(v.astype(np.int32 if x is out[1] else np.int64) if v.dtype != np.uint64 else v.view(np.int64))
            cols = [pa.array(np.concatenate(x) if x else [], t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["unit", "pos", "h1", "h2", "h3"])

    return run


def _contexts(span: int):
    """(unit, text, ats) -> each suffix's part of the tree and the text around it that a piece with it can reach."""
    half = span // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for unit, text, ats in zip(*(batch.column(k).to_pylist() for k in ("unit", "text", "ats"))):
                for at in ats:
                    low = max(0, at["pos"] - (span - half))
                    rows.append((at["part"], unit, low, text[low : at["pos"] + span]))
                if len(rows) > 20_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.string()))], ["part", "unit", "low", "around"])

    return run


def _leaves(around: list[str], unit: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct surroundings, the place of each row among them, and the lowest and highest record of each."""
    known: dict[str, int] = {}
    leaf = np.array([known.setdefault(x, len(known)) for x in around])
    low, high = np.full(len(known), np.iinfo(np.int64).max), np.full(len(known), np.iinfo(np.int64).min)
    np.minimum.at(low, leaf, unit)
    np.maximum.at(high, leaf, unit)
    return list(known), leaf, low, high


def repeats(texts: list[str], low: np.ndarray, high: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, offset) of each suffix whose first ``depth`` characters are also those of a suffix of another record.

    low, high: the lowest and highest record that holds each text. By prefix doubling over the characters themselves.
    """
    sizes = np.array([len(x) for x in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))  # characters from here to the end of the text
    letters, rank = np.unique(_points("".join(texts)), return_inverse=True)
    bits = max(1, int(len(letters)).bit_length())
    length, at = 1, np.flatnonzero(left >= 1)
    base, wide = rank.astype(np.int64), min(depth, 62 // bits, 8)
    while length < wide:  # the first characters fit into one number
        at = at[left[at] > length]
        rank[at] = rank[at] << bits | base[at + length]
        length += 1
    at = np.flatnonzero(left >= length)
    key, where = rank[at], np.full(len(owner), -1)
    while True:
        order = np.argsort(key, kind="stable")
        new = np.r_[True, key[order][1:] != key[order][:-1]] if len(order) else np.empty(0, bool)
        start = np.flatnonzero(new)
        if not len(start):
            return at, at
        inner = np.minimum.reduceat(low[owner[at[order]]], start) != np.maximum.reduceat(high[owner[at[order]]], start)
        node = np.cumsum(new) - 1
        keep = inner[node]
        at, node = at[order[keep]], node[keep]
        if length == depth:
            return owner[at], at - (np.cumsum(sizes) - sizes)[owner[at]]
        where[:] = -1
        where[at] = node
        step = min(length, depth - length)
        at = at[left[at] >= length + step]
        at = at[where[at + step] >= 0]
        key = where[at] * (len(start) + 1) + where[at + step]
        length += step


def _subtrees(span: int, chunk: int = 3000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for t in _groups(batches, ["part"]):
            parts = t.column("part").to_numpy()
            edges = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1], True])
            low = 0
            for e in edges[1:]:  # whole groups together, a few thousand suffixes at a time
                if e - low >= chunk or e == len(parts):
                    waiting.append(t.slice(low, e - low))
                    low = e
                    if sum(x.num_rows for x in waiting) >= chunk:
                        yield from _evaluate(pa.concat_tables(waiting))
                        waiting = []
        if waiting:
            yield from _evaluate(pa.concat_tables(waiting))

    def _evaluate(t: pa.Table) -> Iterator[pa.RecordBatch]:
        unit, low = t.column("unit").to_numpy(), t.column("low").to_numpy().astype(np.int64)
        texts, leaf, first, last = _leaves(t.column("around").to_pylist(), unit)
        text, offset = repeats(texts, first, last, span)
        # back to the rows of each leaf
        order = np.argsort(leaf, kind="stable")
        begin, many = np.searchsorted(leaf[order], np.arange(len(texts))), np.bincount(leaf, minlength=len(texts))
        row = np.repeat(begin[text] - np.cumsum(many[text]) + many[text], many[text]) + np.arange(int(many[text].sum()))
        row, offset = order[row], np.repeat(offset, many[text])
        yield from _stretches(unit[row], low[row] + offset, span)

    return run


def _stretches(unit: np.ndarray, start: np.ndarray, span: int) -> Iterator[pa.RecordBatch]:
    """Pieces -> stretches of touching pieces of a record."""
    if not len(unit):
        return
    order = np.lexsort((start, unit))
    unit, start = unit[order], start[order]
    new = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]) | (start[1:] > start[:-1] + span)])
    last = np.r_[new[1:], len(unit)] - 1
    yield pa.RecordBatch.from_arrays([pa.array(unit[new]), pa.array(start[new].astype(np.int64)), pa.array(start[last].astype(np.int64) + span)], ["unit", "low", "high"])


def _pieces(span: int):
    """(leaf, around) -> (leaf, x, y, offset): 128-bit hashes of all pieces of ``span`` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                leaf, around = batch.column("leaf").slice(k, 500), batch.column("around").slice(k, 500).to_pylist()
                sizes = np.array([len(x) for x in around])
                points = _points("".join(around))
                many = np.maximum(sizes - span + 1, 0)
                owner = np.repeat(np.arange(len(around)), many)
                offset = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
                at = (np.cumsum(sizes) - sizes)[owner] + offset
                x, y = (rolling(p, span)[at].view(np.int64) if len(at) else at for p in (points, points * np.uint64(0xD1342543DE82EF95) + np.uint64(11)))
                yield pa.RecordBatch.from_arrays([leaf.take(pa.array(owner)), pa.array(x), pa.array(y), pa.array(offset.astype(np.int32))], ["leaf", "x", "y", "offset"])

    return run


def shared_spans(df: DataFrame, *, span: int = 200, group: int = 4096) -> DataFrame:
    """(doc_id, span_start, span_end): stretches of each text of (doc_id, text) covered by ``span``-character pieces that another doc_id has too.

    Null texts and texts under ``span`` characters have none; equal texts share all of themselves; an empty table gives an empty
    result; other columns are ignored. doc_id is expected to be unique.
    """
    spark = df.sparkSession
    texts = df.where(F.length("text") >= span).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    keys = texts.select("doc_id", F.unhex(F.md5("text")).alias("key"), F.length("text").alias("size"))
    owners = c.cut(keys.join(keys.groupBy("key").agg(F.min("doc_id").alias("unit"), F.count("*").alias("copies")), "key").select("doc_id", "unit", "copies", "size"))
    units = c.cut(texts.join(owners.where("doc_id = unit").select("doc_id"), "doc_id").select(F.col("doc_id").alias("unit"), "text").repartition(c.width(spark), "unit"))
    suffixes = c.cut(units.mapInArrow(_suffixes(span), "unit bigint, pos int, h1 bigint, h2 bigint, h3 bigint"))
    branching = suffixes.groupBy("h3").agg(F.min("unit").alias("a"), F.max("unit").alias("b"), F.count("*").alias("m")).where("a <> b").select("h3", "m")
    live = c.cut(suffixes.join(branching, "h3"))
    small = live.where(F.col("m") <= group)
    # prefixes that are too frequent, first at the shortest, then at the next length
    wide1 = small.groupBy("h1").count().where(F.col("count") > group).select("h1", F.lit(True).alias("wide1"))
    wide2 = small.join(wide1, "h1", "left_semi").groupBy("h2").count().where(F.col("count") > group).select("h2", F.lit(True).alias("wide2"))
    parted = small.join(wide1, "h1", "left").join(wide2, "h2", "left").select("unit", "pos", F.expr("CASE WHEN wide1 IS NULL THEN h1 WHEN wide2 IS NULL THEN h2 ELSE h3 END").alias("part"))
    around = "part bigint, unit bigint, low int, around string"

    def contexts(of: DataFrame) -> DataFrame:
        ats = of.groupBy("unit").agg(F.collect_list(F.struct("pos", "part")).alias("ats"))
        return units.join(ats, "unit").mapInArrow(_contexts(span), around)

    trees = contexts(parted).repartition(c.width(spark), "part").sortWithinPartitions("part")
    found = trees.mapInArrow(_subtrees(span), "unit bigint, low bigint, high bigint")
    # a prefix that is too frequent: a surrounding of several records is shared as a whole, the others by pieces
    hot = c.cut(contexts(live.where(F.col("m") > group).select("unit", "pos", F.col("h3").alias("part"))).withColumn("leaf", F.unhex(F.md5("around"))))
    leaves = hot.groupBy("leaf").agg(F.min("unit").alias("a"), F.max("unit").alias("b"), F.first("around").alias("around"))
    pieces = c.cut(leaves.select("leaf", "around").mapInArrow(_pieces(span), "leaf binary, x bigint, y bigint, offset int").join(leaves.select("leaf", "a", "b"), "leaf"))
    several = pieces.groupBy("x", "y").agg(F.min("a").alias("a"), F.max("b").alias("b")).where("a <> b").select("x", "y")
    common = pieces.join(several, ["x", "y"]).select("leaf", "offset").distinct()
    # a run of touching offsets is one stretch of its leaf; the rows of the leaf come last
    by_leaf = Window.partitionBy("leaf").orderBy("offset")
    runs = common.withColumn("new", (F.col("offset") > F.coalesce(F.lag("offset").over(by_leaf), F.lit(-2 * span)) + span).cast("int")).withColumn("run", F.sum("new").over(by_leaf))
    runs = runs.groupBy("leaf", "run").agg(F.min("offset").alias("from"), F.max("offset").alias("to"))
    found = found.unionByName(hot.join(runs, "leaf").select("unit", (F.col("low") + F.col("from")).cast("bigint").alias("low"), (F.col("low") + F.col("to") + span).cast("bigint").alias("high")))
    # stretches that touch or overlap become one
    by = Window.partitionBy("unit").orderBy("low", "high")
    marked = found.withColumn("reach", F.max("high").over(by.rowsBetween(Window.unboundedPreceding, -1))).withColumn("new", F.when(F.col("low") <= F.col("reach"), 0).otherwise(1))
    joined = marked.withColumn("island", F.sum("new").over(by)).groupBy("unit", "island").agg(F.min("low").alias("span_start"), F.max("high").alias("span_end")).drop("island")
    partly = owners.where("copies = 1").select("doc_id", "unit").join(joined, "unit").select("doc_id", "span_start", "span_end")
    copies = owners.where("copies > 1").select("doc_id", F.lit(0).cast("bigint").alias("span_start"), F.col("size").cast("bigint").alias("span_end"))
    return partly.unionByName(copies)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(c.table(spark, sf_dir, "documents"))


def p9_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, shared_chars, n_chars, share) of each document with a shared stretch."""
    docs = c.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    total = p9_found(spark, sf_dir).groupBy("doc_id").agg(F.sum(F.expr("span_end - span_start")).alias("shared_chars"))
    return total.join(docs, "doc_id").select("doc_id", "shared_chars", "n_chars", F.round(F.col("shared_chars") / F.col("n_chars"), 6).alias("share"))
