"""Repetition inside a document: rolling hashes of several n-gram lengths in numpy.

For each length n the characters inside n-grams that began earlier in the same text are marked and counted;
the same is done with whole lines. Everything is one pass over each text, no shuffle but of the ids found.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

_BASE, _MASK = 0x100000001B3, 2**64 - 1


def rolling(points: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all n-grams: windows are doubled and joined, so a length n takes about log2 n passes."""
    if len(points) < n:
        return np.empty(0, np.uint64)
    out: np.ndarray | None = None
    power, span, left, done = points * np.uint64(0x9E3779B97F4A7C15) ^ points >> np.uint64(7), 1, n, 0
    base = _BASE
    while left:
        if left & 1:
            part = power[done:]
            out = part if out is None else out[: len(part)] * np.uint64(base) + part[: len(out)]
            done += span
        left >>= 1
        if left:
            power = power[:-span] * np.uint64(base) + power[span:]
            base = (base * base + 2) & _MASK
            span *= 2
    out = out[: len(points) - n + 1]
    return (out ^ out >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)


def covered(hashes: np.ndarray, n: int, length: int) -> int:
    """Characters inside n-grams that already began earlier."""
    if len(hashes) < 2:
        return 0
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return 0
    edge = np.zeros(length + 1, np.int32)
    again = order[1:][same]
    np.add.at(edge, again, 1)
    np.add.at(edge, again + n, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _repeated_lines(text: str) -> tuple[int, int]:
    seen, total, again = set(), 0, 0
    for line in text.split("\n"):
        if plain := line.strip():
            total += len(plain)
            if plain in seen:
                again += len(plain)
            seen.add(plain)
    return again, total


def _measure(lengths: Sequence[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(len(lengths) + 3)]
            texts = batch.column("text").to_pylist()
            for text, plain in zip(texts, c.letters_all(c.canon_all(texts))):
                points = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
                for x, n in zip(out, lengths):
                    x.append(covered(rolling(points, n), n, len(points)))
                again, total = _repeated_lines(text)
                for x, v in zip(out[len(lengths) :], (len(points), again, total)):
                    x.append(v)
            names = [*(f"rep_{n}" for n in lengths), "n_letters", "rep_line_chars", "line_chars"]
            rest = [k for k in batch.schema.names if k != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in rest), *(pa.array(x, pa.int64()) for x in out)], [*rest, *names])

    return run


def repetition(df: DataFrame, lengths: Sequence[int] = (12, 24, 48)) -> DataFrame:
    """(src, rec_id, rep_<n>..., n_letters, rep_line_chars, line_chars) of each non-null text of (src, rec_id, text).

    rep_<n> counts the letters inside n-letter pieces that began earlier in the text. Empty and blank texts have zeros, texts
    shorter than n have rep_<n> = 0; several texts of one rec_id give several rows; other columns are ignored.
    """
    counts = ", ".join(f"{k} bigint" for k in [*(f"rep_{n}" for n in lengths), "n_letters", "rep_line_chars", "line_chars"])
    return df.where("text is not null").select("src", F.col("rec_id").cast("bigint").alias("rec_id"), "text").mapInArrow(_measure(lengths), f"src string, rec_id bigint, {counts}")


def repeating(df: DataFrame, *, n: int = 12, num: int = 1, den: int = 3) -> DataFrame:
    """(src, rec_id) of the records of which a text has at least num/den of its letters inside repeated n-letter pieces."""
    return repetition(df, (n,)).where(f"n_letters > 0 and rep_{n} * {den} >= n_letters * {num}").select("src", "rec_id").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeating(c.outputs_and_answers(spark, sf_dir))


def p6_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, rec_id, n_letters, share_12, share_24, share_48, share_lines): shares of repeated content of every output and answer; 0 of a text without letters."""
    m = repetition(c.outputs_and_answers(spark, sf_dir)).distinct()  # deliveries of a record have the same measures
    part = lambda x, whole: F.when(F.col(whole) > 0, F.round(F.col(x) / F.col(whole), 4)).otherwise(0.0)
    return m.select("src", "rec_id", "n_letters", *(part(f"rep_{n}", "n_letters").alias(f"share_{n}") for n in (12, 24, 48)), part("rep_line_chars", "line_chars").alias("share_lines"))


def p6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, rec_id, rep_line_chars, line_chars): characters of lines that stood before in the same text, and of all lines."""
    return repetition(c.outputs_and_answers(spark, sf_dir), ()).select("src", "rec_id", "rep_line_chars", "line_chars").distinct()
