"""Diversity, agreement and significance statistics; samples are drawn by hash, so results repeat."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import ColumnLike, col
from .common import cut, ranked


def type_token_ratio(df: DataFrame, column: ColumnLike) -> DataFrame:
    w = df.select(F.explode(text.words(F.lower(col(column)))).alias("w"))
    return w.agg(F.count("*").alias("tokens"), F.count_distinct("w").alias("types")).withColumn("ratio", F.when(F.col("tokens") > 0, F.round(F.col("types") / F.col("tokens"), 6)))


def ngram_coverage(df: DataFrame, column: ColumnLike, n: int = 5) -> DataFrame:
    """(total, distinct, coverage): distinct n-grams of words among all."""
    g = df.select(F.explode(text.ngrams(text.words(F.lower(col(column))), n)).alias("g"))
    return g.groupBy("g").agg(F.count("*").alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count("*").alias("distinct")).withColumn("coverage", F.when(F.col("total") > 0, F.round(F.col("distinct") / F.col("total"), 6)))


def self_bleu(df: DataFrame, column: str, *, id: str, n: int = 4) -> DataFrame:
    """One row: the mean over texts of the geometric mean of clipped n-gram precisions against all other texts.

    The other texts' largest count of an n-gram is the largest, or second largest where the text itself has the largest; so
    no pair of texts ever meets.
    """
    grams = None
    for k in range(1, n + 1):
        part = df.select(id, F.lit(k).alias("k"), F.explode(text.ngrams(text.words(F.lower(column)), k)).alias("g"))
        grams = part if grams is None else grams.unionByName(part)
    counts = grams.groupBy(id, "k", "g").agg(F.count("*").alias("c"))
    best = counts.groupBy("k", "g").agg(F.max("c").alias("m1"))
    ties = counts.join(best, ["k", "g"]).groupBy("k", "g", "m1").agg(F.count_if(F.col("c") == F.col("m1")).alias("at_top"), F.max(F.when(F.col("c") < F.col("m1"), F.col("c"))).alias("m2"))
    others = F.when((F.col("c") < F.col("m1")) | (F.col("at_top") > 1), F.col("m1")).otherwise(F.coalesce("m2", F.lit(0)))
    each = counts.join(ties, ["k", "g"]).groupBy(id, "k").agg((F.sum(F.least("c", others)) / F.sum("c")).alias("precision"))
    score = each.groupBy(id).agg(F.count("*").alias("orders"), F.min("precision").alias("low"), F.avg(F.log(F.greatest("precision", F.lit(1e-12)))).alias("mean"))
    return score.where(F.col("orders") == n).agg(F.round(F.avg(F.when(F.col("low") > 0, F.exp("mean")).otherwise(0.0)), 6).alias("self_bleu"), F.count("*").alias("texts"))


def mean_cosine(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    """One row: the mean cosine over all pairs, from the sum of unit vectors: (|sum|^2 - n) / (n (n - 1)). No pair is formed."""
    norm = F.sqrt(F.aggregate(embedding, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = df.withColumn("_n", norm).where("_n > 0").select(F.posexplode(F.transform(embedding, lambda x: x.cast("double") / F.col("_n"))).alias("k", "v"))
    total = unit.groupBy("k").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    return total.agg(F.max("n").alias("rows"), F.sum(F.col("s") * F.col("s")).alias("q")).select("rows", F.when(F.col("rows") > 1, F.round((F.col("q") - F.col("rows")) / (F.col("rows") * (F.col("rows") - 1)), 6)).alias("mean_cosine"))


def confusion(df: DataFrame, score: ColumnLike, gold: ColumnLike, cuts: list[int]) -> DataFrame:
    """(cut, tp, fp, fn, tn, precision, recall, f1) of ``score >= cut`` for each cut, in one pass."""
    hit, true = col(score), col(gold)
    rows = df.select(hit.alias("s"), true.alias("t")).withColumn("cut", F.explode(F.array(*map(F.lit, cuts))))
    said = F.col("s") >= F.col("cut")
    out = rows.groupBy("cut").agg(F.count_if(said & F.col("t")).alias("tp"), F.count_if(said & ~F.col("t")).alias("fp"), F.count_if(~said & F.col("t")).alias("fn"), F.count_if(~said & ~F.col("t")).alias("tn"))
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 6))
    tp, fp, fn = (F.col(x) for x in ("tp", "fp", "fn"))
    return out.withColumn("precision", ratio(tp, tp + fp)).withColumn("recall", ratio(tp, tp + fn)).withColumn("f1", ratio(2 * tp, 2 * tp + fp + fn))


def leave_one_out(df: DataFrame, fired: ColumnLike, gold: ColumnLike, names: list[str], least: int = 3) -> DataFrame:
    """(left_out, f1): F1 of the composite flag without each feature, and with all ("none")."""
    rows = df.select(col(fired).alias("fired"), col(gold).alias("t")).withColumn("left_out", F.explode(F.array(*map(F.lit, ["none", *names]))))
    said = F.size(F.filter("fired", lambda x: x != F.col("left_out"))) >= least
    out = rows.groupBy("left_out").agg(F.count_if(said & F.col("t")).alias("tp"), F.count_if(said & ~F.col("t")).alias("fp"), F.count_if(~said & F.col("t")).alias("fn"))
    return out.select("left_out", F.when(F.col("tp") + F.col("fp") + F.col("fn") > 0, F.round(2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn")), 6)).alias("f1"))


def bootstrap(df: DataFrame, a: ColumnLike, b: ColumnLike, *, key: str, rounds: int = 1000, seed: int = 0) -> DataFrame:
    """One row: mean paired difference a - b with the 2.5 and 97.5 floor percentiles over Poisson resamples.

    A row's weights in all rounds are drawn from a hash of its key, so they don't depend on where the row lies; a task gives a sum
    for each round, not rows. Null differences are left out.
    """
    diff = (col(a) - col(b)).cast("double")
    rows = df.select(text.stable_hash(seed, key).alias("h"), diff.alias("d")).where("d is not null")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, rounds))
        for batch in batches:
            h, d = batch.column("h").to_numpy(), batch.column("d").to_numpy()
            for k in range(0, len(h), 1000):
                weights = np.stack([np.random.default_rng(x).poisson(1.0, rounds) for x in h[k : k + 1000].tolist()])
                total += weights.sum(0), d[k : k + 1000] @ weights
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rounds)), pa.array(total[0]), pa.array(total[1])], ["r", "w", "wd"])

    sums = rows.mapInArrow(draw, "r bigint, w double, wd double").groupBy("r").agg(F.sum("w").alias("w"), F.sum("wd").alias("wd"))
    sorted_ = sums.agg(F.array_sort(F.collect_list(F.when(F.col("w") > 0, F.col("wd") / F.col("w")))).alias("m"))  # one number for each round
    at = lambda q: F.round(F.get("m", F.floor(F.lit(q) * (F.size("m") - 1)).cast("int")), 6)
    return sorted_.select(at(0.025).alias("low"), at(0.975).alias("high")).crossJoin(df.agg(F.round(F.avg(diff), 6).alias("difference"), F.count(diff).alias("rows")))  # two tables of one row


def mcnemar(df: DataFrame, a: ColumnLike, b: ColumnLike) -> DataFrame:
    """One row: discordant counts and the continuity-corrected statistic."""
    x, y = col(a), col(b)
    out = df.agg(F.count_if(x & ~y).alias("only_a"), F.count_if(~x & y).alias("only_b"))
    n = F.col("only_a") + F.col("only_b")
    return out.withColumn("chi2", F.when(n > 0, F.round(F.pow(F.greatest(F.abs(F.col("only_a") - F.col("only_b")) - 1, F.lit(0)), 2) / n, 6)))


def kappa(df: DataFrame, a: ColumnLike, b: ColumnLike) -> DataFrame:
    """One row: observed and expected agreement of two annotators and Cohen's kappa; from a table of label pairs."""
    pairs = df.where(col(a).isNotNull() & col(b).isNotNull()).groupBy(col(a).alias("x"), col(b).alias("y")).agg(F.count("*").alias("c"))
    total = pairs.agg(F.sum("c").alias("n"), F.sum(F.when(F.col("x") == F.col("y"), F.col("c")).otherwise(0)).alias("same"))
    side = lambda k: pairs.groupBy(F.col(k).alias("l")).agg(F.sum("c").alias(f"n{k}"))
    chance = side("x").join(side("y"), "l").agg(F.coalesce(F.sum(F.col("nx") * F.col("ny")), F.lit(0)).alias("cross"))
    out = total.crossJoin(chance).withColumn("observed", F.col("same") / F.col("n")).withColumn("expected", F.col("cross") / (F.col("n") * F.col("n")))
    return out.select("n", F.round("observed", 6).alias("observed"), F.round("expected", 6).alias("expected"), F.when(F.col("expected") < 1, F.round((F.col("observed") - F.col("expected")) / (1 - F.col("expected")), 6)).alias("kappa"))


def bradley_terry(wins: DataFrame, rounds: int = 50) -> DataFrame:
    """(name, strength): strengths that sum to 1 from (winner, loser) rows, by the minorise-maximise iteration over pair counts."""
    games = cut(wins.groupBy("winner", "loser").agg(F.count("*").alias("c")))
    both = cut(games.select(F.col("winner").alias("a"), F.col("loser").alias("b"), "c").unionByName(games.select(F.col("loser").alias("a"), F.col("winner").alias("b"), "c")).groupBy("a", "b").agg(F.sum("c").alias("n")))
    won = both.select("a").distinct().join(games.groupBy(F.col("winner").alias("a")).agg(F.sum("c").alias("w")), "a", "left").fillna(0, ["w"])
    now = cut(won.select("a", F.lit(1.0).alias("s")))
    for _ in range(rounds):
        t = both.join(now, "a").join(now.withColumnsRenamed({"a": "b", "s": "sb"}), "b").groupBy("a").agg(F.sum(F.col("n") / (F.col("s") + F.col("sb"))).alias("d"))
        raw = won.join(t, "a").select("a", (F.col("w") / F.col("d")).alias("s"))
        now = cut(raw.crossJoin(F.broadcast(raw.agg(F.sum("s").alias("z")))).select("a", (F.col("s") / F.col("z")).alias("s")))  # one row of totals
    return now.select(F.col("a").alias("name"), F.round("s", 6).alias("strength"))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: groups, rows and the one-way F statistic, from per-group sums."""
    g = df.where(F.col(value).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.sum(F.col(value).cast("double")).alias("s"), F.sum(F.col(value).cast("double") * F.col(value)).alias("q"))
    t = g.agg(F.count("*").alias("groups"), F.sum("n").alias("rows"), (F.sum(F.col("s") * F.col("s") / F.col("n")) - F.pow(F.sum("s"), 2) / F.sum("n")).alias("between"), (F.sum("q") - F.sum(F.col("s") * F.col("s") / F.col("n"))).alias("within"))
    return t.select("groups", "rows", F.when((F.col("within") > 0) & (F.col("groups") > 1), F.round(F.col("between") / (F.col("groups") - 1) / (F.col("within") / (F.col("rows") - F.col("groups"))), 6)).alias("f"))


def adjudicated(df: DataFrame, *, item: str = "item", label: str = "label", majority: int = 2) -> DataFrame:
    """(item, n, label, status): the label that ``majority`` annotators gave; split where none has that many."""
    votes = df.groupBy(item, label).agg(F.count("*").alias("c"))
    best = votes.groupBy(item).agg(F.sum("c").alias("n"), F.max_by(F.struct("c", F.col(label).alias("l")), F.struct("c", F.col(label))).alias("b"))
    won = F.col("b.c") >= majority
    return best.select(item, "n", F.when(won, F.col("b.l")).alias("label"), F.when(F.col("b.c") == F.col("n"), "unanimous").when(won, "majority").otherwise("escalate").alias("status"))


def rated(df: DataFrame, *, item: str = "item", rating: str = "rating", span: int = 2) -> DataFrame:
    """(item, rating, status): the mean rating, or escalate where ratings lie ``span`` or more apart."""
    g = df.groupBy(item).agg(F.round(F.avg(rating), 6).alias("mean"), (F.max(rating) - F.min(rating)).alias("gap"))
    return g.select(item, F.when(F.col("gap") < span, F.col("mean")).alias("rating"), F.when(F.col("gap") < span, "average").otherwise("escalate").alias("status"))


def gold_bands(df: DataFrame, *, annotator: str = "annotator", label: str = "label", gold: str = "gold", good: float = 0.90, fair: float = 0.85) -> DataFrame:
    """(annotator, n, agreement, band): agreement with hidden gold labels, in three bands."""
    g = df.groupBy(annotator).agg(F.count("*").alias("n"), F.round(F.avg((F.col(label) == F.col(gold)).cast("double")), 6).alias("agreement"))
    return g.withColumn("band", F.when(F.col("agreement") >= good, "good").when(F.col("agreement") >= fair, "watch").otherwise("retrain"))


def quota(df: DataFrame, quotas: DataFrame, *keys: str, by: str, seed: int = 0) -> DataFrame:
    """Rows of each category up to its quota(by, quota), in hash order; a category without quota leaves."""
    return ranked(df.join(quotas, by), by, text.stable_hash(seed, *keys), *keys).where("_rank <= quota").drop("_rank", "_rows", "quota")


def wide(df: DataFrame, labels: list[str], *, item: str = "item", annotator: str = "annotator", label: str = "label") -> DataFrame:
    """A column for each annotator."""
    return df.groupBy(item).pivot(annotator, labels).agg(F.first(label))
