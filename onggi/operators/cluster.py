"""Duplicates by token sets, leader clusters of answers, majorities."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .common import cut


def similar_pairs(sets: DataFrame, threshold: float, *, id: str = "id", tokens: str = "tokens") -> DataFrame:
    """(a, b), a < b: rows whose sets' Jaccard similarity reaches the threshold.

    Prefix filtering: with tokens ordered from rare to frequent, two similar sets share one among the first few of each;
    only rows that share such a rare token and have fitting sizes meet. Every similar pair is found.
    """
    each = sets.select(id, F.explode(tokens).alias("t"))
    ranked = each.join(each.groupBy("t").agg(F.count("*").alias("df")), "t")
    ordered = ranked.groupBy(id).agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("o"))
    need = F.size("o") - F.ceil(F.lit(threshold) * F.size("o") - 1e-9).cast("int") + 1
    prefix = ordered.select(id, F.size("o").alias("n"), F.explode(F.transform(F.slice("o", F.lit(1), need), lambda x: x["t"])).alias("t"))
    a, b = (prefix.select(F.col(id).alias(k), F.col("n").alias(f"n{k}"), "t") for k in "ab")
    met = a.join(b, "t").where((F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb") - 1e-9)).select("a", "b").distinct()
    x, y = (sets.select(F.col(id).alias(k), F.col(tokens).alias(f"t{k}")) for k in "ab")
    return met.join(x, "a").join(y, "b").where(text.jaccard(F.col("ta"), F.col("tb")) >= threshold - 1e-12).select("a", "b")


def greedy_distinct(df: DataFrame, column: str, *, id: str = "id", threshold: float = 0.7, pool: DataFrame | None = None) -> DataFrame:
    """Rows in the order of ``id`` that are not similar to a row of ``pool`` or to an earlier row that was itself kept.

    "Earlier kept" is not "earlier": each round keeps the undecided rows without an undecided earlier neighbour and drops
    their later neighbours, until none is left. Rows without tokens are similar to nothing; equal sets are one row.
    """
    sets = cut(df.select(F.col(id).alias("id"), text.token_set(column).alias("tokens")))
    if pool is not None:
        known = pool.select(F.lit(None).cast("bigint").alias("id"), text.token_set(column).alias("tokens")).where(F.size("tokens") > 0)
        both = sets.where(F.size("tokens") > 0).unionByName(known.select((-F.monotonically_increasing_id() - 1).alias("id"), "tokens"))
        near = similar_pairs(cut(both), threshold).where("a < 0 and b >= 0").select(F.col("b").alias("id")).distinct()
        sets = cut(sets.join(near, "id", "left_anti"))
    first = sets.withColumn("key", F.array_sort("tokens")).groupBy("key").agg(F.min("id").alias("id")).where(F.size("key") > 0)
    edges = cut(similar_pairs(first.select("id", F.col("key").alias("tokens")), threshold))
    kept, open_ = first.select("id"), edges
    dropped: DataFrame | None = None
    while open_.limit(1).count():
        heads = open_.select(F.col("a").alias("id")).distinct().join(open_.select(F.col("b").alias("id")).distinct(), "id", "left_anti")
        gone = cut(open_.join(heads.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct())
        dropped = gone if dropped is None else cut(dropped.unionByName(gone))
        settled = heads.unionByName(gone)
        open_ = cut(open_.join(settled.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti"))
    if dropped is not None:
        kept = kept.join(dropped, "id", "left_anti")
    kept = kept.unionByName(sets.where(F.size("tokens") == 0).select("id"))
    return df.join(kept.withColumnRenamed("id", id), id, "left_semi")


def duplicate_audit(df: DataFrame, column: str, *, id: str = "id", threshold: float = 0.6, min_hangul: float = 0.7) -> DataFrame:
    """One row: exact duplicates, similar pairs, rows with little Hangul."""
    sets = df.select(F.col(id).alias("id"), text.token_set(column).alias("tokens")).where(F.size("tokens") > 0)
    counts = df.agg((F.count("*") - F.count_distinct(column)).alias("exact"), F.count_if(text.hangul_fraction(column) < min_hangul).alias("low_hangul"))
    return counts.crossJoin(similar_pairs(sets, threshold).agg(F.count("*").alias("near_pairs")))  # two tables of one row


def exact_distinct(df: DataFrame, column: str, *, id: str, min_chars: int = 15, min_hangul: float = 0.5) -> DataFrame:
    """The first row of each distinct text (white space at the ends aside) that is long and Korean enough."""
    clean = df.withColumn("_t", text.strip(column)).where((F.length("_t") >= min_chars) & (text.hangul_fraction("_t") >= min_hangul))
    return df.join(clean.groupBy("_t").agg(F.min(id).alias(id)).select(id), id, "left_semi")


def leaders(samples: DataFrame, *, key: str = "prompt_id", order: str = "sample_id", column: str = "response", threshold: float = 0.4) -> DataFrame:
    """(key, order, leader): each answer joins the first leader, in order, whose conclusion is similar enough, or leads a cluster.

    A prompt has a fixed number of samples (K), so a group is small; content sets are made by built-in expressions first.
    """
    sets = samples.select(key, order, text.content_words(text.final_span(column), hangul_only=False).alias("tokens"))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, found = object(), []
        for batch in batches:  # sorted by prompt and sample: a prompt's leaders are all that is remembered
            out = []
            for prompt, sample, tokens in zip(batch[key], batch[order], batch["tokens"]):
                if prompt != at:
                    at, found = prompt, []
                own = set(tokens)
                leader = next((n for n, s in found if own and s and len(own & s) / len(own | s) >= threshold), None)
                if leader is None:
                    leader = sample
                    found.append((sample, own))
                out.append(leader)
            yield pd.DataFrame({key: batch[key], order: batch[order], "leader": out})

    kinds = dict(samples.dtypes)
    return sets.repartition(key).sortWithinPartitions(key, order).mapInPandas(assign, f"`{key}` {kinds[key]}, `{order}` {kinds[order]}, leader {kinds[order]}")


def majority(clusters: DataFrame, k: int, *, key: str = "prompt_id", least: float = 0.5) -> DataFrame:
    """(key, leader, size): the largest cluster of each prompt, the first among equals, if it holds ``least`` of the K requested samples."""
    sizes = clusters.groupBy(key, "leader").agg(F.count("*").alias("size"))
    best = sizes.groupBy(key).agg(F.max_by(F.struct("leader", "size"), F.struct("size", -F.col("leader"))).alias("b")).select(key, "b.leader", "b.size")
    return best.where(F.col("size") / k >= least)


def shortest(samples: DataFrame, clusters: DataFrame, best: DataFrame, *, keep: int = 1, key: str = "prompt_id", order: str = "sample_id", column: str = "response") -> DataFrame:
    """The shortest answers of the majority cluster, in their order among equals."""
    inside = samples.join(clusters, [key, order]).join(best.select(key, "leader"), [key, "leader"])
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.length(column), order))
    return inside.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank", "leader")


def shingles(x: str | Column, n: int = 5) -> Column:
    """Distinct n-grams of lower-cased words."""
    return F.array_distinct(text.ngrams(text.words(F.lower(text.col(x))), n))


def excluded(df: DataFrame, held_out: DataFrame, *, id: str, column: str = "text", n: int = 5) -> DataFrame:
    """(id, n_shared) of rows that share an n-word shingle with held-out texts. Only digests are shuffled, counted once for each row."""
    key = lambda d, *c: d.select(*c, F.explode(shingles(column, n)).alias("g")).select(*c, F.xxhash64("g").alias("h"))
    return key(df, id).join(key(held_out).distinct(), "h").groupBy(id).agg(F.count("*").alias("n_shared"))


def passage_pool(df: DataFrame, held_out: DataFrame, *, id: str = "id", column: str = "text", least: int = 100, most: int = 2000, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """Adds ``reason``: length (outside ``least`` to ``most`` characters), copy (an earlier row has the same text), near_copy (an earlier row's
    n-word shingles are as similar as the threshold), leak (it shares a shingle with a held-out text); the first that holds."""
    sized = df.withColumn("_key", F.md5(F.col(column)))
    inside = sized.where(F.length(column).between(least, most))
    first = inside.groupBy("_key").agg(F.min(id).alias("_first"))
    distinct = inside.join(first, (inside[id] == first["_first"]) & (inside["_key"] == first["_key"]), "left_semi")
    sets = cut(distinct.select(F.col(id).alias("id"), shingles(column, n).alias("tokens")).where(F.size("tokens") > 0))
    near = similar_pairs(sets, threshold).select(F.col("b").alias(id)).distinct().withColumn("_near", F.lit(True))
    leak = excluded(distinct, held_out, id=id, column=column, n=n).select(id, F.lit(True).alias("_leak"))
    out = sized.join(first, "_key", "left").join(near, id, "left").join(leak, id, "left")
    reason = F.when(~F.coalesce(F.length(column).between(least, most), F.lit(False)), "length").when(F.col(id) != F.col("_first"), "copy").when(F.col("_near"), "near_copy").when(F.col("_leak"), "leak")
    return out.withColumn("reason", reason).drop("_key", "_first", "_near", "_leak")
