"""Near-duplicate records with small edits, by signature trees.

A record becomes a set of 5-letter pieces; its signature is a bitmap of the hashed pieces (about one and a half bits for
each, a power of two wide) and the set's size. A signature tree's node holds the OR of the bitmaps below it and the range
of their sizes. A dual traversal starts with the pair (root, root) and opens a pair of nodes only while the largest
overlap that any two records below them can have would still reach the similarity; the pairs of leaves that are left are
compared exactly.

One tree over a huge collection would have saturated upper nodes, so the forest is sharded, exactly: with all pieces in
one order from rare to frequent, two sets at the similarity share one of the first n - ceil(s n) + 1 pieces of each. A
record is a leaf of the tree of each of these pieces, so no pair is lost, at any similarity. How rare a piece is comes from counts by hash
bucket (a table of fixed size); a piece whose bucket was met once has no second record and needs no tree. A tree's leaves
come sorted by size. A tree of more than ``block`` leaves is cut into blocks, which are size ranges; every pair of blocks
that may hold similar sizes is a task, so no task grows with the collection. Equal texts are one leaf from the start and
are expanded last. No candidate is dropped anywhere.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .repetition import rolling

PIECE, FANOUT = 5, 4  # letters of a piece; children of a node
NARROW, WIDE = 4, 256  # 64-bit words of the narrowest and widest bitmap
PART = 4096  # buckets of the counts that travel together


def pieces(texts: list[str], seeds: list[int]) -> list[np.ndarray]:
    """Sorted distinct 56-bit hashes of the 5-letter pieces of texts of letters, of all texts in one pass."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = rolling(points, PIECE)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    out, at = [], 0
    for text, seed in zip(texts, seeds):
        own = (h[at : at + max(0, len(text) - PIECE + 1)] ^ np.uint64(seed)) >> np.uint64(8)
        own.sort()
        new = np.ones(len(own), bool)
        np.not_equal(own[1:], own[:-1], out=new[1:])
        out.append(own[new])
        at += len(text)
    return out


def _seed(src: str) -> int:
    return int.from_bytes(hashlib.blake2b(src.encode(), digest_size=8).digest(), "big")


def words_for(n: int) -> int:
    """64-bit words of the bitmap of a set of n pieces: a power of two, at least 4/3 bits for each piece up to the widest."""
    w = NARROW
    while w < WIDE and w * 48 < n:
        w *= 2
    return w


def jaccard_at_least(a: set, b: set, num: int, den: int) -> bool:
    both = len(a & b)
    return both * den >= (len(a) + len(b) - both) * num


class Forest:
    """Signature trees over many groups of records at once, level by level in numpy."""

    def __init__(self, group: np.ndarray, size: np.ndarray, bits: np.ndarray, fanout: int = FANOUT):
        """group: the tree of each record, ascending; within a group records lie in the order of their sizes."""
        spare = size - np.bitwise_count(bits).sum(1, dtype=np.int64)  # pieces that share a bit with another one
        self.levels = [(bits, size, size, spare, None)]
        self.seen: Counter = Counter()  # (level, kept or not) -> pairs of nodes, besides a node with itself
        while True:
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            if len(first) == len(group):
                return
            at = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
            start = np.flatnonzero(at % fanout == 0)
            bits, low, high, spare, _ = self.levels[-1]
            self.levels.append((np.bitwise_or.reduceat(bits, start), np.minimum.reduceat(low, start), np.maximum.reduceat(high, start), np.maximum.reduceat(spare, start), np.r_[start, len(group)]))
            group = group[start]

    def _open(self, level: int, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
        """Which pairs of nodes may hold a pair of records at the similarity num/den: sizes first, then bitmaps."""
        bits, low, high, spare, _ = self.levels[level]
        keep = (high[i] * den >= low[j] * num) & (high[j] * den >= low[i] * num)
        if (at := np.flatnonzero(keep & (i != j))).size:
            i, j = i[at], j[at]
            most = np.bitwise_count(bits[i] & bits[j]).sum(1, dtype=np.int64) + np.minimum(spare[i], spare[j])
            most = np.minimum(most, np.minimum(high[i], high[j]))
            keep[at] = most * den >= (np.maximum(low[i], most) + np.maximum(low[j], most) - most) * num
        return keep

    def pairs(self, num: int, den: int, across: np.ndarray | None = None, chunk: int = 60_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of records (i < j) of one group that may reach num/den; with ``across`` (0 or 1 for each record) only pairs of both kinds."""
        top = len(self.levels) - 1
        n = len(self.levels[top][1])
        todo = [(top, np.arange(n), np.arange(n))]
        while todo:
            level, i, j = todo.pop()
            if len(i) > chunk:
                todo += [(level, i[k : k + chunk], j[k : k + chunk]) for k in range(0, len(i), chunk)]
                continue
            if not level:
                i, j = i[k := i != j], j[k]
            keep = self._open(level, i, j, num, den)
            self.seen[level, True] += int((keep & (i != j)).sum())
            self.seen[level, False] += int((~keep).sum())
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            if level == 0:
                if across is not None:
                    i, j = i[k := across[i] != across[j]], j[k]
                yield i, j
                continue
            start = self.levels[level][4]
            ni, nj = start[i + 1] - start[i], start[j + 1] - start[j]
            many = ni * nj
            of = np.repeat(np.arange(len(i)), many)
            at = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            a, b = start[i][of] + at // nj[of], start[j][of] + at % nj[of]
            keep = a <= b
            todo.append((level - 1, a[keep], b[keep]))


def _words(bits: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 64-bit words of all bitmaps, and of each bitmap where it begins and how many it has."""
    whole = bits.combine_chunks() if isinstance(bits, pa.ChunkedArray) else bits
    _, offsets, data = whole.buffers()
    edges = np.frombuffer(offsets, np.int32)[whole.offset : whole.offset + len(whole) + 1].astype(np.int64)
    words = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]].view(np.uint64)
    start = (edges - edges[0]) // 8
    return words, start[:-1], np.diff(start)


def similar(group: np.ndarray, unit: np.ndarray, n: np.ndarray, bits: pa.Array | pa.ChunkedArray, num: int, den: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of units of one group that may reach num/den. Bitmaps of two widths meet folded to the narrower one; similar sets differ by one step at most.

    side: 0 or 1 for each row; in a group with both only pairs of both kinds count.
    """
    if len(group) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    words, start, width = _words(bits)
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if side is not None:
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        mixed = np.repeat(np.maximum.reduceat(side, first) > np.minimum.reduceat(side, first), np.diff(np.r_[first, len(group)]))
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(((width == w) | (width == 2 * w)) & np.isin(group, group[width == w]))
        g, many = np.unique(group[rows], return_counts=True)
        rows = rows[np.isin(group[rows], g[many > 1])]
        if not len(rows):
            continue
        rows = rows[np.lexsort((n[rows], group[rows]))]
        flat = np.zeros((len(rows), w), np.uint64)
        for wide in (w, 2 * w):
            if len(at := np.flatnonzero(width[rows] == wide)):
                own = words[start[rows[at]][:, None] + np.arange(wide)]
                flat[at] = own[:, :w] | own[:, w:] if wide > w else own
        across = None if side is None else np.where(mixed[rows], side[rows], -1 - np.arange(len(rows)))
        for i, j in Forest(group[rows], n[rows], flat).pairs(num, den, across):
            i, j = i[k := (width[rows[i]] == w) | (width[rows[j]] == w)], j[k]
            found_a.append(unit[rows[i]])
            found_b.append(unit[rows[j]])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    a, b = np.minimum(a, b)[k := a != b], np.maximum(a, b)[k]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


_RECORD = "src string, rec_id bigint, form binary, full binary, unit bigint, letters string, part int, counts binary"


def _records(buckets: int):
    """(src, rec_id, text) -> digests of the one form and of the letters of each record; then how many records hold a piece of each bucket, in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int32)
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.binary())
        names = ["src", "rec_id", "form", "full", "unit", "letters", "part", "counts"]
        for batch in batches:
            src, rec = batch.column("src").to_pylist(), batch.column("rec_id")
            forms = c.canon_all(batch.column("text").to_pylist())
            plain = c.letters_all(forms)
            form = [hashlib.blake2b(f.encode(errors="surrogatepass"), digest_size=16).digest() for f in forms]
            full = [hashlib.blake2b(f"{s}\0{p}".encode(errors="surrogatepass"), digest_size=16).digest() for s, p in zip(src, plain)]
            unit = np.frombuffer(b"".join(full), np.int64)[::2]  # a short name for the trees; the full digest is the unit
            seeds = {s: _seed(s or "") for s in set(src)}
            if len(src):
                own = np.concatenate(pieces(plain, [seeds[s] for s in src]))
                np.add.at(counts, (own % np.uint64(buckets)).astype(np.int64), 1)
            none = pa.nulls(len(src))
            yield pa.RecordBatch.from_arrays([pa.array(src, kinds[0]), rec, pa.array(form, kinds[2]), pa.array(full, kinds[3]), pa.array(unit), pa.array(plain, kinds[5]), none.cast(kinds[6]), none.cast(kinds[7])], names)
        parts = counts.reshape(-1, PART)
        at = np.flatnonzero(parts.any(1))
        packed = [_packed(x) for x in parts[at]]
        none = pa.nulls(len(at))
        yield pa.RecordBatch.from_arrays([*(none.cast(k) for k in kinds[:6]), pa.array(at.astype(np.int32)), pa.array(packed, kinds[7])], names)

    return run


def _packed(counts: np.ndarray) -> bytes:
    """A part of the counts: which are not 0, each as a byte, and the large ones behind."""
    some = counts > 0
    x = counts[some]
    return np.packbits(some).tobytes() + np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].astype(np.int32).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    some = np.unpackbits(np.frombuffer(data, np.uint8, PART // 8)).astype(bool)
    x = np.frombuffer(data, np.uint8, n := int(some.sum()), PART // 8).astype(np.int64)
    x[x == 255] = np.frombuffer(data[PART // 8 + n :], np.int32)
    out = np.zeros(PART, np.int64)
    out[some] = x
    return out


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of counts added up; a count comes out as a byte on a logarithmic scale, 16 for one."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            x = _unpacked(counts)
            total[part] = total[part] + x if part in total else x
    scaled = [np.minimum(16 * np.log2(1.0 + x), 255).astype(np.uint8).tobytes() for x in total.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(scaled, pa.binary())], ["part", "counts"])


def _leaves(rarity, num: int, den: int):
    """(src, unit, letters) -> the trees of each unit: a row for each of its rarest pieces that another record may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = rarity.value
        buckets, last = np.uint64(len(scale)), np.uint64(56)
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                src, units = batch.column("src").to_pylist(), batch.column("unit").to_numpy()
                seeds = {s: _seed(s or "") for s in set(src)}
                tokens, owner, size, maps = [], [], [], []
                for at, h in enumerate(pieces(batch.column("letters").to_pylist(), [seeds[s] for s in src])):
                    n = len(h)
                    first = n - -(-n * num // den) + 1
                    key = scale[(h % buckets).astype(np.int64)].astype(np.uint64) << last | h
                    key = np.partition(key, first - 1)[:first] if n else key
                    key = key[key >> last > 16]  # a piece met once has no other record
                    if not len(key):
                        continue
                    bits = np.zeros(words_for(n) * 64, bool)
                    bits[(h % np.uint64(len(bits))).astype(np.int64)] = True
                    tokens.append(key & np.uint64((1 << 56) - 1))
                    owner.append(np.full(len(key), at))
                    size.append(np.full(len(key), n, np.int32))
                    maps.append((np.packbits(bits).tobytes(), len(key)))
                if tokens:
                    own = np.concatenate(owner)
                    index = np.repeat(np.arange(len(maps)), [m for _, m in maps])
                    signature = pa.array([b for b, _ in maps], pa.binary()).take(pa.array(index))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(units[own]), pa.array(np.concatenate(size)), signature], ["tree", "unit", "n", "bits"])

    return run


_GROWN = "a bigint, b bigint, tree bigint, own int, n int, bits binary"


def _grow(num: int, den: int, block: int):
    """Rows sorted by tree and size -> pairs (a, b) of small trees; the leaves of a tree of more than ``block`` come out as they are, with their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        hot, place = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            if hot is not None:
                same = int(np.searchsorted(t.column("tree").to_numpy(), hot, "right"))
                if same:
                    yield _passed(t.slice(0, same), place)
                    place += same
                t = t.slice(same)
                if not t.num_rows:
                    continue
                hot = None
            whole = pa.concat_tables([rest, t]) if rest is not None else t
            trees = whole.column("tree").to_numpy()
            edge = int(np.searchsorted(trees, trees[-1]))
            if edge:
                yield _paired(whole.slice(0, edge))
            rest = whole.slice(edge)
            if rest.num_rows > block:
                hot, place = int(trees[-1]), rest.num_rows
                yield _passed(rest, 0)
                rest = None
        if rest is not None and rest.num_rows:
            yield _paired(rest)

    def _passed(t: pa.Table, place: int) -> pa.RecordBatch:
        t = t.combine_chunks()
        own = pa.array(((np.arange(t.num_rows) + place) // block).astype(np.int32))
        cols = [t.column("unit"), pa.nulls(t.num_rows, pa.int64()), t.column("tree"), own, t.column("n"), t.column("bits")]
        return pa.Table.from_arrays(cols, ["a", "b", "tree", "own", "n", "bits"]).combine_chunks().to_batches()[0]

    def _paired(t: pa.Table) -> pa.RecordBatch:
        tree = t.column("tree").to_numpy()
        alone = np.r_[True, tree[1:] != tree[:-1]] & np.r_[tree[1:] != tree[:-1], True]
        t = t.filter(pa.array(~alone))
        a, b = similar(t.column("tree").to_numpy(), t.column("unit").to_numpy(), t.column("n").to_numpy().astype(np.int64), t.column("bits"), num, den)
        none = pa.nulls(len(a))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.binary())], ["a", "b", "tree", "own", "n", "bits"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Batches that come sorted by key, cut so that no key is in two of them."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        whole = pa.concat_tables([rest, new]) if rest is not None else new
        last = {k: whole.column(k)[whole.num_rows - 1].as_py() for k in key}
        same = np.ones(whole.num_rows, bool)
        for k in key:
            same &= whole.column(k).to_numpy(zero_copy_only=False) == last[k]
        edge = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if edge:
            yield whole.slice(0, edge)
        rest = whole.slice(edge)
    if rest is not None and rest.num_rows:
        yield rest


def _traverse(num: int, den: int):
    """Pairs of blocks of large trees, sorted by (tree, x, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ["tree", "x", "y"]):
            keys = [t.column(k).to_numpy().astype(np.int64) for k in ("tree", "x", "y")]
            new = np.zeros(t.num_rows, bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            a, b = similar(np.cumsum(new), t.column("a").to_numpy(), t.column("n").to_numpy().astype(np.int64), t.column("bits"), num, den, t.column("side").to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _exact(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict = {}
            keep = []
            for x, y in zip(batch.column("la").to_pylist(), batch.column("lb").to_pylist()):
                for t in (x, y):
                    if t not in known:
                        known[t] = {t[k : k + PIECE] for k in range(len(t) - PIECE + 1)}
                keep.append(jaccard_at_least(known[x], known[y], num, den))
            yield batch.select(["full_a", "full_b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(df: DataFrame, *, num: int = 3, den: int = 5, min_chars: int = 120, block: int = 2048, buckets: int = 1 << 23) -> DataFrame:
    """(src, id_a, id_b), id_a < id_b: pairs of (src, rec_id, text) whose sets of 5-letter pieces reach num/den; every such pair.

    Only texts of at least ``min_chars`` characters take part. Pairs with the same text, or that differ only in
    characters that look the same, are no near copies. Null, empty and letterless texts have no pairs; an empty table
    gives an empty result; other columns of ``df`` are ignored; a row that comes again counts once. ``buckets`` (a multiple of
    4096) is the size of the table of counts, a byte each, that is sent to all tasks.
    """
    assert den <= 2 * num <= 2 * den and not buckets % PART
    spark = df.sparkSession
    long = df.where(F.length("text") >= min_chars).select("src", F.col("rec_id").cast("bigint").alias("rec_id"), "text")
    records = c.cut(long.mapInArrow(_records(buckets), _RECORD))
    scale = np.zeros(buckets, np.uint8)
    for part, counts in records.where("part is not null").select("part", "counts").repartition(c.width(spark), "part").mapInArrow(_added, "part int, counts binary").collect():  # ``buckets`` bytes in all
        scale[part * PART : (part + 1) * PART] = np.frombuffer(counts, np.uint8)
    rarity = spark.sparkContext.broadcast(scale)
    ids = c.cut(records.where("part is null").select("src", "rec_id", "form", "full", F.length("letters").alias("size")).distinct())
    units = c.cut(records.where("part is null").select("src", "full", "unit", "letters").dropDuplicates(["full"]))
    leaves = units.mapInArrow(_leaves(rarity, num, den), "tree bigint, unit bigint, n int, bits binary")
    grown = c.cut(leaves.repartition(c.width(spark), "tree").sortWithinPartitions("tree", "n").mapInArrow(_grow(num, den, block), _GROWN))
    # blocks of a large tree are size ranges; only those that may hold similar sizes meet
    large = grown.where("tree is not null")
    ranges = large.groupBy("tree", "own").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    x, y = (ranges.withColumnsRenamed({"own": k, "low": f"low_{k}", "high": f"high_{k}"}) for k in "xy")
    meet = x.join(y, "tree").where(f"x <= y and high_x * {den} >= low_y * {num}").select("tree", "x", "y")
    routes = meet.select("tree", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("own"))
    routed = large.join(routes, ["tree", "own"]).select("a", "tree", "x", "y", (F.col("own") != F.col("x")).cast("int").alias("side"), "n", "bits")
    across = routed.repartition(c.width(spark), "tree", "x", "y").sortWithinPartitions("tree", "x", "y").mapInArrow(_traverse(num, den), "a bigint, b bigint")
    found = grown.where("tree is null").select("a", "b").unionByName(across).distinct()
    la, lb = (units.select(F.col("unit").alias(k), F.col("full").alias(f"full_{k}"), F.col("letters").alias(f"l{k}")) for k in "ab")
    near = found.join(la, "a").join(lb, "b").mapInArrow(_exact(num, den), "full_a binary, full_b binary")
    one, two = (ids.select("src", F.col("rec_id").alias(f"id_{k}"), F.col("full").alias(f"full_{k}")) for k in "ab")
    pairs = near.join(one, "full_a").join(two.drop("src"), "full_b").select("src", "id_a", "id_b")
    # the same letters in several forms: the distinct forms meet, ids come last
    forms = ids.where(f"size >= {PIECE}").select("src", "full", "form").distinct()
    f, g = (forms.withColumnRenamed("form", k) for k in ("form_a", "form_b"))
    other = f.join(g.drop("src"), "full").where("form_a < form_b")
    one, two = (ids.select("full", F.col("form").alias(f"form_{k}"), F.col("rec_id").alias(f"id_{k}")) for k in "ab")
    same = other.join(one, ["full", "form_a"]).join(two, ["full", "form_b"]).select("src", "id_a", "id_b")
    return pairs.unionByName(same).select("src", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(c.paragraphs_and_answers(spark, sf_dir, "exemplars_qa_hapsyo", "단락", deliveries=True))
