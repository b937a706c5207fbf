"""Evaluation texts leaking into training text, by latent semantic retrieval.

1. Weights: in how many documents each hashed 5-letter piece stands, over the whole corpus.
2. Latent space: a distributed randomised SVD. The passages of at most ``sample`` documents, the lowest by a hash of
   their ids, and of the items are TF-IDF rows; each task adds its rows, with random signs, to a small sketch (a sparse
   sign embedding of the row space), sketches are summed by Spark, and the right singular vectors of the sum span the
   latent space. Only the axes come from the sample: weights, windows and search cover everything.
3. Index: the items' windows lie in cells around centroids, each with its radius. A window of a document asks the cells that can
   hold a vector within the wanted angle by the triangle inequality, so cells lose nothing.
4. Search: overlapping windows of every document, one scan for all items of a block, are compared by cosine with the
   windows in the cells they ask. For verbatim passages the index holds the items' windows at every offset: a run of ``run`` letters
   always holds a whole window, whose vector is that of the item's window, so the cosine is 1 but for rounding and no such run is
   lost. For paraphrases the cosine is measured: edited copies of the items must be found.
5. Check of each candidate (document, item): the longest verbatim run; for paraphrases the longest common subsequence of
   words (syllables in Hangul and Han) around the window that fits best, bit-parallel, and the item's checkable answers:
   its numbers, or where it has none its longest words.

``paraphrases`` is the plain form without the search: every pair judged by the longest common subsequence of letters.

The items are the stated query set: they are collected, in blocks, and compared with all documents.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .repetition import rolling

FEATURES, SKETCH = 1 << 14, 128
WINDOW, STEP = 45, 15  # letters of a window; between windows of a document


@dataclass(frozen=True)
class Shape:
    """Letters of a piece and of a window, and between windows of a document and of an item."""

    piece: int
    window: int
    step: int
    stride: int
    rank: int


VERBATIM, REWORDED = Shape(5, WINDOW, STEP, 1, 32), Shape(3, 60, 15, 5, 64)
SAME = 1 - 1e-5  # the cosine of windows with the same letters, but for rounding


def _features(text: str, shape: Shape) -> np.ndarray:
    """Hashed pieces of a text of letters, one for each position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return (rolling(points, shape.piece) >> np.uint64(40)).astype(np.int64) % FEATURES


def _joined(texts: list[str], shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of many texts at once, one after the other: (features, where each text begins, how many it has)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    many = np.maximum(sizes - shape.piece + 1, 0)
    every = _features("".join(texts), shape)
    owner = np.repeat(np.arange(len(texts)), many)
    starts = np.cumsum(many) - many
    return every[(np.cumsum(sizes) - sizes)[owner] + np.arange(len(owner)) - starts[owner]], starts, many


def _plain(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return c.letters_all(c.canon_all([t or "" for t in batch.column(column).to_pylist()]))


def _frequencies(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FEATURES + 1, np.int64)
    for batch in batches:
        texts = _plain(batch)
        for k in range(0, len(texts), 1000):
            f, _, many = _joined(texts[k : k + 1000], shape)
            key = np.sort(np.repeat(np.arange(len(many)), many) * FEATURES + f)
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            total[:FEATURES] += np.bincount(key[first] % FEATURES, minlength=FEATURES)
        total[FEATURES] += len(texts)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["feature", "n"])


def _add_sketch(sketch: np.ndarray, texts: list[str], ids: list[int], idf: np.ndarray, shape: Shape) -> None:
    """Adds the TF-IDF rows of passages of 60 pieces (the last of a text is shorter) to the sketch: each to four of its rows with random signs."""
    f, starts, many = _joined(texts, shape)
    if not len(f):
        return
    owner = np.repeat(np.arange(len(texts)), many)
    within = (np.arange(len(f)) - starts[owner]) // 60
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (within[1:] != within[:-1])])
    passage = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(f)]))
    weight = idf[f]
    weight = weight / np.maximum(np.sqrt(np.bincount(passage, weight * weight))[passage], 1e-9)
    seed = (np.array(ids, np.uint64)[owner[first]] * np.uint64(1_000_003) + within[first].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(4):
        h = (seed ^ np.uint64((k + 1) * 0xD6E8FEB86659FD93 & 2**64 - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(33)
        row = (h % np.uint64(SKETCH)).astype(np.int64)
        sign = 1.0 - 2.0 * ((h >> np.uint64(20)) & np.uint64(1)).astype(np.float64)
        np.add.at(sketch.reshape(-1), row[passage] * FEATURES + f, weight * sign[passage])


def _sketches(idf: np.ndarray, shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((SKETCH, FEATURES))
        for batch in batches:
            ids, texts = [(x or 0) & 0x7FFFFFFFFFFF for x in batch.column("doc_id").to_pylist()], _plain(batch)
            for k in range(0, len(texts), 200):
                _add_sketch(sketch, texts[k : k + 200], ids[k : k + 200], idf, shape)
        rows = np.flatnonzero(sketch.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array([x.astype(np.float32).tobytes() for x in sketch[rows]], pa.binary())], ["row", "values"])

    return run


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, values in zip(batch.column("row").to_pylist(), batch.column("values").to_pylist()):
            x = np.frombuffer(values, np.float32).astype(np.float64)
            total[row] = total[row] + x if row in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in total.values()], pa.binary())], ["row", "values"])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)


def _vectors(f: np.ndarray, starts: np.ndarray, space: np.ndarray, shape: Shape) -> np.ndarray:
    """Unit vectors of the windows that begin at these places: sums by running totals, in blocks that keep them small."""
    wide = shape.window - shape.piece + 1
    out = np.empty((len(starts), space.shape[1]), np.float32)
    for k in range(0, len(starts), 256):
        s = starts[k : k + 256]
        total = np.zeros((s[-1] + wide - s[0] + 1, space.shape[1]))
        np.cumsum(space[f[s[0] : s[-1] + wide]], 0, dtype=np.float64, out=total[1:])
        sums = total[s - s[0] + wide] - total[s - s[0]]
        out[k : k + 256] = _unit(sums)
    return out


def windows(text: str, space: np.ndarray, step: int, shape: Shape) -> np.ndarray:
    """Unit vectors in the latent space of the windows of a text of letters, one every ``step`` letters."""
    f = _features(text, shape)
    return _vectors(f, np.arange(0, max(len(f) - (shape.window - shape.piece), 0), step), space, shape)


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over whole integers."""
    at: dict[str, int] = {}
    for k, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        x = row & at.get(ch, 0)
        row = (row + x | row - x) & full
    return len(a) - row.bit_count()


def longest_run(item: str, text: str, least: int) -> int:
    """Length of the longest verbatim run of the item in the text if it has ``least`` letters, else 0."""
    best = 0
    half = least // 2
    for k in range(0, len(item) - half + 1, half):  # a run of that length holds one of these blocks
        block, at = item[k : k + half], -1
        while (at := text.find(block, at + 1)) >= 0:
            i, j = k, at
            while i and j and item[i - 1] == text[j - 1]:
                i, j = i - 1, j - 1
            u, v = k + half, at + half
            while u < len(item) and v < len(text) and item[u] == text[v]:
                u, v = u + 1, v + 1
            best = max(best, u - i)
    return best if best >= least else 0


_NUMBERS = re.compile(r"\d{2,}")
_WORDS = re.compile(r"[A-Za-z\u00c0-\u024f]+|\d+|[^\W_]")


def spoken(text: str) -> tuple[list[str], list[int]]:
    """Words of a text in lower case, a syllable or sign of other scripts for itself, and where the letters of each begin."""
    words = [w.lower() for w in _WORDS.findall(c.canon(text))]
    return words, np.cumsum([0, *map(len, words)]).tolist()


def answers(text: str) -> set[str]:
    """What can be checked of an item: its numbers, or where it has none its three longest words."""
    form = c.canon(text)
    if numbers := set(_NUMBERS.findall(form)):
        return numbers
    words = sorted({c.letters_of(w) for w in form.split()}, key=lambda w: (-len(w), w))
    return {w for w in words[:3] if w}


def words_in_order(item: list[str], words: list[str]) -> float:
    """The longest common subsequence of two lists of words, as the share of the item's letters."""
    at: dict[str, int] = {}
    for k, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << k
    full = row = (1 << len(item)) - 1
    for w in words:
        if m := at.get(w):
            x = row & m
            row = (row + x | row - x) & full
    return sum(len(w) for k, w in enumerate(item) if not row >> k & 1) / max(1, sum(map(len, item)))


class Index:
    """Windows of items in cells around centroids; a cell is asked only if it can hold a vector at the wanted cosine."""

    def __init__(self, items: list[tuple[int, str]], space: np.ndarray, shape: Shape, near: float):
        own = [windows(c.letters(t), space, shape.stride, shape) for _, t in items]
        vectors = np.concatenate(own) if own else np.empty((0, space.shape[1]), np.float32)
        owner = np.repeat(np.arange(len(items)), [len(x) for x in own])
        self.items, self.near, self.shape = items, near, shape
        k = max(1, int(len(vectors) ** 0.5))
        centre = vectors[np.linspace(0, len(vectors) - 1, k).astype(np.int64)] if len(vectors) else vectors
        for _ in range(4):
            cell = self._nearest(vectors, centre)
            sums = np.zeros((len(centre), space.shape[1]))
            np.add.at(sums, cell, vectors)
            centre = np.where(np.bincount(cell, minlength=len(centre))[:, None] > 0, _unit(sums), centre).astype(np.float32)
        cell = self._nearest(vectors, centre)
        order = np.argsort(cell, kind="stable")
        self.vectors, self.owner, self.centre = vectors[order], owner[order], centre
        self.edges = np.searchsorted(cell[order], np.arange(len(centre) + 1))
        radius = np.zeros(len(centre))
        np.maximum.at(radius, cell, np.arccos(np.clip((vectors * centre[cell]).sum(1), -1, 1)) if len(vectors) else np.empty(0))
        self.reach = np.arccos(near) + 1e-3
        self.least = np.cos(np.minimum(np.pi, radius + self.reach)).astype(np.float32)

    @staticmethod
    def _nearest(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.concatenate([(vectors[k : k + 4096] @ centre.T).argmax(1) for k in range(0, len(vectors), 4096)]) if len(vectors) else np.empty(0, np.int64)

    def search(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of asked, item, cosine) of all pairs of windows at the cosine ``near`` or above."""
        if not len(self.vectors) or not len(asked):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        rows, items, values = [], [], []
        for low in range(0, len(asked), 8192):
            part = asked[low : low + 8192]
            to = part @ self.centre.T
            # the cell of a vector is its nearest: none further than the nearest one by twice the angle can hold it
            bound = np.cos(np.minimum(np.pi, np.arccos(np.clip(to.max(1), -1, 1)) + 2 * self.reach))
            cell, row = np.nonzero(((to >= self.least) & (to >= bound[:, None])).T)
            edges = np.searchsorted(cell, np.arange(len(self.centre) + 1))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                own = row[edges[k] : edges[k + 1]]
                at = slice(self.edges[k], self.edges[k + 1])
                cosine = part[own] @ self.vectors[at].T
                i, j = np.nonzero(cosine >= self.near)
                rows.append(own[i] + low)
                items.append(self.owner[at][j])
                values.append(cosine[i, j])
        return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows, items, values))


_KIND = "doc_id bigint, item_id bigint, run int, cosine double, lcs double, answers boolean"


def _search(index: Index, space: np.ndarray, run_length: int, similar: bool):
    plain = [c.letters(t) for _, t in index.items]
    said = [spoken(t)[0] for _, t in index.items]
    keys = [answers(t) for _, t in index.items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            rows: list[tuple] = []
            for low in range(0, len(texts), 400):
                rows += _hits(docs[low : low + 400], texts[low : low + 400])
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], ["doc_id", "item_id", "run", "cosine", "lcs", "answers"])

    def _hits(docs: list, stored: list[str]) -> list[tuple]:
        texts, shape = c.letters_all(c.canon_all(stored)), index.shape
        f, starts, many = _joined(texts, shape)
        count = np.maximum(many - (shape.window - shape.piece) + shape.step - 1, 0) // shape.step
        which = np.repeat(np.arange(len(texts)), count)
        if not len(which):
            return []
        place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        w, item, cosine = index.search(_vectors(f, starts[which] + place * shape.step, space, shape))
        key = which[w] * len(index.items) + item
        order = np.lexsort((-cosine, key))
        edges = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1], True]) if len(key) else np.zeros(1, np.int64)
        out: list[tuple] = []
        known: dict[int, tuple] = {}
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):  # the windows that fit of each document and item, the best one first
            k = order[first]
            n, i = int(which[w[k]]), int(item[k])
            whole = longest_run(plain[i], texts[n], run_length)
            share, met = 0.0, False
            if similar and not whole and all(x in texts[n] for x in keys[i]):
                for at in sorted({int(place[w[x]]) for x in order[first:last]}):
                    low, high = max(0, at * shape.step - len(plain[i])), at * shape.step + shape.window + len(plain[i])
                    if all(x in texts[n][low:high] for x in keys[i]):
                        if n not in known:
                            known[n] = spoken(stored[n])
                        words, begin = known[n]
                        met, share = True, max(share, words_in_order(said[i], words[bisect_left(begin, low) : bisect_left(begin, high)]))
            out.append((docs[n], index.items[i][0], whole, round(float(cosine[k]), 6), round(share, 6), met))
        return out

    return run


def latent_space(docs: DataFrame, items: list[tuple[int, str]], sample: int, shape: Shape) -> np.ndarray:
    """FEATURES x rank: weights, from all documents, times right singular vectors, from the sample and the items."""
    spark = docs.sparkSession
    counted = docs.mapInArrow(lambda batches: _frequencies(batches, shape), "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    df = np.zeros(FEATURES + 1)
    for feature, n in counted.collect():  # at most FEATURES + 1 rows
        df[feature] = n
    idf = np.log((df[FEATURES] + 2) / (df[:FEATURES] + 1))
    share = min(1.0, sample / max(1.0, df[FEATURES]))
    few = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    parts = few.mapInArrow(_sketches(idf, shape), "row int, `values` binary")
    summed = parts.repartition(c.width(spark), "row").mapInArrow(_sum_rows, "row int, `values` binary")
    sketch = np.zeros((SKETCH, FEATURES))
    for row, values in summed.collect():  # at most SKETCH rows of fixed size
        sketch[row] += np.frombuffer(values, np.float32)
    _add_sketch(sketch, [c.letters(t) for _, t in items], [n & 0x7FFFFFFFFFFF for n, _ in items], idf, shape)
    # right singular vectors from the small Gram matrix
    values, left = np.linalg.eigh(sketch @ sketch.T)
    top = np.argsort(-values)[: shape.rank]
    right = sketch.T @ left[:, top] / np.sqrt(np.maximum(values[top], 1e-12))
    return (idf[:, None] * right).astype(np.float32)


def threshold(items: list[tuple[int, str]], space: np.ndarray, share: float, shape: Shape = REWORDED, lost: float = 0.02) -> float:
    """The cosine at which all but ``lost`` of edited copies of the items, every k-th word replaced, find their own item."""
    rng = np.random.default_rng(11)
    said = [c.canon(t).split() for _, t in items]
    best = []
    for k, words in enumerate(said):
        own = windows(c.letters(items[k][1]), space, shape.stride, shape)
        for every in (3, 4, 5, 7):
            other = said[int(rng.integers(len(said)))] or ["가"]
            copy = " ".join(other[int(rng.integers(len(other)))] if n % every == every - 1 else w for n, w in enumerate(words))
            if words_in_order(spoken(items[k][1])[0], spoken(copy)[0]) >= share and len(own):
                around = other + copy.split() + other  # the copy stands within other text
                w = windows(c.letters(" ".join(around))[int(rng.integers(shape.step)) :], space, shape.step, shape)
                best.append(float((w @ own.T).max()))
    return float(np.quantile(best, lost)) - 1e-4 if best else SAME


def leaks(docs: DataFrame, items: DataFrame, *, run: int = 60, share: float | None = None, near: float | None = None, sample: int = 20_000, block: int = 5000) -> DataFrame:
    """(doc_id, item_id, run, cosine, lcs, answers): candidates of the latent search among (doc_id, text) x (item_id, text), checked.

    run: letters of the longest verbatim run, 0 under ``run``. Without ``share`` only verbatim passages are searched. With it the search
    is as wide as edited copies of the items that keep this share of their words need it (or as ``near`` says), and for candidates
    without a verbatim run answers says whether all checkable answers stand around a window that fits, and lcs, where they
    do, is the share of the item's letters in words that stand there in the same order, else 0. Null, empty and short texts give no rows; repeated documents give a
    row each; an empty table gives an empty result; other columns are ignored. The items are the query set and are collected in blocks,
    each of which is one scan.
    """
    assert run >= VERBATIM.window + VERBATIM.step, "a run must hold a whole window"
    long = docs.where("text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    asked = sorted((n, t) for n, t in items.where("item_id is not null and text is not null").select("item_id", "text").collect())
    asked = [(n, t) for n, t in asked if len(c.letters(t)) >= run]
    if not asked:
        return docs.sparkSession.createDataFrame([], _KIND)
    shape = VERBATIM if share is None else REWORDED
    space = latent_space(long, asked, sample, shape)
    sc = docs.sparkSession.sparkContext
    out = None
    for k in range(0, len(asked), block):
        part = asked[k : k + block]
        wide = SAME if share is None else min(SAME, threshold(part, space, share)) if near is None else near
        shared = sc.broadcast((Index(part, space, shape, wide), space))

        def search(batches, shared=shared):
            return _search(*shared.value, run, share is not None)(batches)

        found = long.mapInArrow(search, _KIND)
        out = found if out is None else out.unionByName(found)
    return out


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(c.table(spark, sf_dir, "documents"), c.table(spark, sf_dir, "eval_items"))
    return found.where("run > 0").select("doc_id", "item_id").distinct()


def p8_reworded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, cosine, lcs): no long verbatim run, but found by the latent search, most words in order, all answers there."""
    found = leaks(c.table(spark, sf_dir, "documents"), c.table(spark, sf_dir, "eval_items"), share=0.7)
    return found.where("run = 0 and lcs >= 0.7 and answers").select("doc_id", "item_id", "cosine", "lcs")


def _packed(texts: list[str]) -> tuple[dict[str, int], int, list[tuple[int, int]]]:
    """Texts side by side in one integer, a free bit behind each for its carry: (bits of each letter, all bits, (place, length) of each)."""
    at: dict[str, int] = {}
    full, base, spans = 0, 0, []
    for t in texts:
        for k, ch in enumerate(t, base):
            at[ch] = at.get(ch, 0) | 1 << k
        full |= ((1 << len(t)) - 1) << base
        spans.append((base, len(t)))
        base += len(t) + 1
    return at, full, spans


def _subsequences(at: dict[str, int], full: int, spans: list[tuple[int, int]], text: str) -> list[int]:
    """Length of the longest common subsequence of each packed text and this one."""
    row = full
    for ch in text:
        if m := at.get(ch):
            x = row & m
            row = (row + x | row - x) & full
    return [n - (row >> base & (1 << n) - 1).bit_count() for base, n in spans]


def _best_stretch(item: str, text: str, numbers: set[str], said: list[tuple[str, int, int]]) -> int:
    """The longest common subsequence of the item and a window of the text with an item's length before and after it, where all numbers stand."""
    n, stretches = len(item), []
    for k in range(0, max(len(text) - WINDOW, 0) + STEP, STEP):
        low, high = max(0, k - n), min(len(text), k + WINDOW + n)
        if not numbers or numbers <= {x for x, a, b in said if low <= a and b <= high}:
            stretches.append((low, high))
    whole: dict[str, int] = {}
    for k, ch in enumerate(text):
        whole[ch] = whole.get(ch, 0) | 1 << k
    at, full, spans = dict.fromkeys(set(item) & whole.keys(), 0), 0, []
    wide = 2 * n + WINDOW + 1
    for k, (low, high) in enumerate(stretches):
        ones = (1 << high - low) - 1
        full |= ones << k * wide
        spans.append((k * wide, high - low))
        for ch in at:
            at[ch] |= (whole[ch] >> low & ones) << k * wide
    return max(_subsequences(at, full, spans, item), default=0)


def paraphrases(docs: DataFrame, items: DataFrame, *, share: float = 0.7, run: int = 60, block: int = 500) -> DataFrame:
    """(doc_id, item_id, lcs) of (doc_id, text) x (item_id, text): no verbatim run of ``run`` letters, but ``share`` of the item in order, with its numbers.

    lcs: the longest common subsequence of the item and a window of the document with an item's length before and after
    it, where all the item's numbers stand, as a share of the item's letters. Every pair is judged by it: the numbers and
    the subsequence with the whole document, which is never shorter, only spare work. Null, empty and short texts give no
    rows; repeated documents give a row each; other columns are ignored. The items are collected in blocks.
    """
    long = docs.where("text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    asked = sorted((n, c.letters(t)) for n, t in items.where("item_id is not null and text is not null").select("item_id", "text").collect())
    asked = [(n, t) for n, t in asked if len(t) >= run]
    kind = "doc_id bigint, item_id bigint, lcs double"
    out = docs.sparkSession.createDataFrame([], kind)
    for low in range(0, len(asked), block):
        found = long.mapInArrow(_paraphrased(asked[low : low + block], share, run), kind)
        out = found if not low else out.unionByName(found)
    return out


def _paraphrased(items: list[tuple[int, str]], share: float, run_length: int):
    numbers = [set(_NUMBERS.findall(t)) for _, t in items]
    always = [k for k, x in enumerate(numbers) if not x]
    numbered = [k for k, x in enumerate(numbers) if x]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _packed([items[k][1] for k in always])
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), _plain(batch)):
                said = [(m.group(), *m.span()) for m in _NUMBERS.finditer(text)]
                values = {x for x, _, _ in said}
                whole = list(zip(always, _subsequences(*pack, text)))
                whole += [(k, common_subsequence(items[k][1], text)) for k in numbered if numbers[k] <= values]
                for k, most in whole:
                    n, item = items[k]
                    if most >= share * len(item) and (best := _best_stretch(item, text, numbers[k], said)) >= share * len(item) and not longest_run(item, text, run_length):
                        rows.append((doc, n, round(best / len(item), 6)))
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], ["doc_id", "item_id", "lcs"])

    return run


def p8_paraphrased(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, lcs): no long verbatim run, but most of the item in order, with its numbers."""
    return paraphrases(c.table(spark, sf_dir, "documents"), c.table(spark, sf_dir, "eval_items"))
