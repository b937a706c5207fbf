"""Vocabularies, merges and embedding rows as relations: vocab(token, id), merges(rank, left, right), rows(id, embedding)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ColumnLike, col, stable_hash
from .common import numbered

def byte_alphabet() -> dict[str, int]:
    """Printable character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b}
    others = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(others)): b for b in range(256)}


def token_class(token: ColumnLike, low: int = 0xAC00, high: int = 0xD7A3) -> Column:
    """korean, other or invalid: by the strictly decoded bytes; a part of a character is other."""

    @F.pandas_udf("string")
    def run(tokens: pd.Series) -> pd.Series:
        alphabet = byte_alphabet()

        def kind(t: str) -> str:
            if any(ch not in alphabet for ch in t):
                return "invalid"
            try:
                decoded = bytes(alphabet[ch] for ch in t).decode("utf-8")
            except UnicodeDecodeError:
                return "other"
            return "korean" if any(low <= ord(ch) <= high for ch in decoded) else "other"

        return tokens.map(kind, na_action="ignore")

    return run(col(token))


def vocab_union(base: DataFrame, extra: DataFrame, most: int | None = None) -> DataFrame:
    """The base vocabulary and the tokens it lacks, in the order of their ids, with fresh ids after the largest."""
    new = extra.join(base, "token", "left_anti")
    rows, _ = numbered(new, "id", "token", name="_n")
    if most is not None:
        rows = rows.where(F.col("_n") < most)
    top = base.agg(F.max("id")).first()[0]
    return base.select("token", F.col("id").cast("bigint").alias("id")).unionByName(rows.select("token", (F.col("_n") + (top if top is not None else -1) + 1).cast("bigint").alias("id")))


def merge_union(base: DataFrame, extra: DataFrame, vocab: DataFrame) -> DataFrame:
    """(source, rank, left, right): base merges, then unseen ones whose parts and result are all tokens, in their order."""
    known = vocab.select("token").distinct()
    new = extra.groupBy("left", "right").agg(F.min("rank").alias("rank")).join(base.select("left", "right"), ["left", "right"], "left_anti").withColumn("joined", F.concat("left", "right"))
    for name in ("left", "right", "joined"):
        new = new.join(known.withColumnRenamed("token", name), name, "left_semi")
    return base.select(F.lit(0).alias("source"), F.col("rank").cast("bigint").alias("rank"), "left", "right").unionByName(new.select(F.lit(1).alias("source"), F.col("rank").cast("bigint").alias("rank"), "left", "right"))


def merge_filter(merges: DataFrame, removed: DataFrame) -> DataFrame:
    """Merges whose result was not removed."""
    return merges.withColumn("_t", F.concat("left", "right")).join(removed.select(F.col("token").alias("_t")).distinct(), "_t", "left_anti").drop("_t")


def vocab_replace(base: DataFrame, extra: DataFrame, special: DataFrame, kind: Column | None = None) -> DataFrame:
    """(token, id, section): base tokens but Korean and special ones in their order, then new tokens, then special ones; ids from 0.

    section: kept, new, special. ``kind`` overrides the classes (a column over base with the value korean for what leaves).
    """
    specials = special.select("token", "id")
    kept = base.where((kind if kind is not None else token_class("token")) != "korean").join(specials.select("token"), "token", "left_anti")
    new = extra.join(kept.select("token"), "token", "left_anti").join(specials.select("token"), "token", "left_anti")
    parts = kept.select("token", F.col("id").alias("old"), F.lit(0).alias("s")).unionByName(new.select("token", F.col("id").alias("old"), F.lit(1).alias("s"))).unionByName(specials.select("token", F.col("id").alias("old"), F.lit(2).alias("s")))
    rows, _ = numbered(parts, "s", "old", "token", name="id")
    return rows.select("token", F.col("id").cast("bigint").alias("id"), F.element_at(F.array(*map(F.lit, ("kept", "new", "special"))), F.col("s") + 1).alias("section"))


def section_stats(vocab: DataFrame) -> DataFrame:
    """(section, tokens, first, last) of a replaced vocabulary."""
    return vocab.groupBy("section").agg(F.count("*").alias("tokens"), F.min("id").alias("first"), F.max("id").alias("last"))


def embedding_plan(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, old_id): the row to copy for each new token, null for a fresh one."""
    return new.join(old.select("token", F.col("id").alias("old_id")), "token", "left").select("id", "old_id")


def fill_rows(plan: DataFrame, rows: DataFrame, dim: int, *, sigma: float = 0.02, seed: int = 0) -> DataFrame:
    """(id, embedding): copied rows, and normal ones drawn from hashes of (seed, id, place), so every run gives the same."""

    def normal(i: Column) -> Column:
        u = lambda k: (F.pmod(stable_hash(seed, F.lit(k), "id", i), F.lit(1 << 52)) + 1) / float((1 << 52) + 1)
        return F.sqrt(-2 * F.log(u(1))) * F.cos(2 * F.pi() * u(2)) * sigma

    fresh = F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: normal(i).cast("float"))
    return plan.join(rows.select(F.col("id").alias("old_id"), "embedding"), "old_id", "left").select("id", F.coalesce("embedding", fresh).alias("embedding"))


def mean_rows(pieces: DataFrame, rows: DataFrame, fallback: list[float] | None = None) -> DataFrame:
    """(id, embedding): the mean of the rows of each token's piece ids (id, pieces array); ``fallback`` (else null) for no pieces."""
    parts = pieces.select("id", F.explode("pieces").alias("piece")).join(rows.select(F.col("id").alias("piece"), "embedding"), "piece")
    each = parts.select("id", F.posexplode("embedding").alias("k", "v")).groupBy("id", "k").agg(F.avg("v").alias("v"))
    means = each.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"].cast("float")).alias("mean"))
    spare = F.array(*map(F.lit, fallback)).cast("array<float>") if fallback else F.lit(None).cast("array<float>")
    return pieces.select("id").join(means, "id", "left").select("id", F.coalesce("mean", spare).alias("embedding"))
