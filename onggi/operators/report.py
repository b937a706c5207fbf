"""Reports: slices of an evaluation, retrieval grids, thresholds and how often features fire, fertility of a tokenizer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import profiles as p
from ..functions import text
from ..functions.text import ColumnLike, col


def scored(df: DataFrame, response: ColumnLike, *, verified: Column | None = None, min_hangul: float = 0.6, max_latin: float = 0.15, threshold: float = 0.8, least: int = 2) -> DataFrame:
    """Adds _hangul, _latin, _switched, _register (score, dominant, n), _consistent and _verified to each row."""
    body = F.coalesce(col(response), F.lit(""))
    out = df.withColumn("_hangul", text.hangul_fraction(body, empty=1.0)).withColumn("_latin", text.latin_fraction(body)).withColumn("_switched", text.code_switched(body, min_hangul, max_latin))
    out = out.withColumn("_register", text.register_summary(text.registers(body)))
    return out.withColumn("_consistent", text.register_consistent(F.col("_register"), threshold, least)).withColumn("_verified", verified if verified is not None else F.lit(None).cast("boolean"))


def eval_slices(rows: DataFrame, *, lang: str = "lang", default: str = "ko", least: int = 2) -> DataFrame:
    """One row for each language and one for all: counts, accuracy, Hangul share, code switching, speech levels.

    Two grouping sets in one aggregation. Language measures cover rows expected in the default language; a measure over no
    rows is null.
    """
    named = rows.withColumn("lang", F.coalesce(lang, F.lit(default)))
    expected = F.col("lang") == default
    judged = expected & (F.col("_register.n") >= least)
    mean = lambda flag, value: F.round(F.avg(F.when(flag, value)), 6)
    counts = [F.count_if(judged & (F.col("_register.dominant") == level)).alias(f"n_{name}") for level, name in zip(p.REGISTERS, ("hapsyo", "haeyo", "muneo", "hae"))]
    measures = [
        F.count("*").alias("n"),
        F.round(F.avg(F.col("_verified").cast("double")), 6).alias("accuracy"),
        F.count("_verified").alias("n_graded"),
        mean(expected, F.col("_hangul")).alias("mean_hangul"),
        mean(expected, F.col("_switched").cast("double")).alias("code_switch_rate"),
        F.count_if(judged).alias("n_register_judged"),
        mean(judged, F.col("_register.score")).alias("mean_register_score"),
        mean(judged, (~F.col("_consistent")).cast("double")).alias("register_mix_rate"),
        *counts,
    ]
    out = named.rollup("lang").agg(F.grouping("lang").alias("_all"), *measures)
    return out.withColumn("lang", F.when(F.col("_all") == 1, "all").otherwise(F.col("lang"))).drop("_all")


def retrieval_grid(df: DataFrame, *, prediction: ColumnLike = "prediction", answer: ColumnLike = "answer", lang: str = "lang", tokens: ColumnLike = "context_tokens", depth: ColumnLike = "depth") -> DataFrame:
    """(lang, bucket, depth, n, accuracy): each cell, and each language as a whole where bucket and depth are null."""
    cells = df.select(F.coalesce(col(lang), F.lit("ko")).alias("lang"), text.nearest_bucket(tokens).alias("bucket"), F.round(col(depth), 2).alias("depth"), text.retrieved(F.coalesce(col(prediction), F.lit("")), answer).cast("double").alias("hit"))
    out = cells.groupingSets([["lang", "bucket", "depth"], ["lang"]], "lang", "bucket", "depth").agg(F.count("*").alias("n"), F.round(F.avg("hit"), 6).alias("accuracy"))
    return out


def grid_table(grid: DataFrame) -> DataFrame:
    """A row for each language and length, a column for each depth."""
    return grid.where("bucket is not null").groupBy("lang", "bucket").pivot("depth").agg(F.first("accuracy"))


def long_features(df: DataFrame, column: ColumnLike, *keep: str) -> DataFrame:
    """(keep..., feature, value): the nine features of each non-empty text, one to a row."""
    f = df.where(F.coalesce(col(column), F.lit("")) != "").select(*keep, text.translation_features(column).alias("f"))
    return f.select(*keep, F.explode(F.create_map(*(x for name in p.THRESHOLDS for x in (F.lit(name), F.col(f"f.{name}"))))).alias("feature", "value"))


def floor_percentile(df: DataFrame, share: float, *by: str, value: str = "value", name: str = "value") -> DataFrame:
    """The value of rank floor(share x (n - 1)) in each group: not interpolated, and below percentile_disc's.

    Values are counted first, so a group's sort holds its distinct values, not its rows.
    """
    counted = df.groupBy(*by, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by)
    upto = F.sum("_c").over(w.orderBy(value))
    ranked = counted.withColumn("_upto", upto).withColumn("_at", F.floor(F.lit(share) * (F.sum("_c").over(w) - 1)) + 1)
    return ranked.where(F.col("_upto") >= F.col("_at")).groupBy(*by).agg(F.min(value).alias(name))


def calibrate(native: DataFrame, translated: DataFrame, column: str = "text", share: float = 0.95) -> DataFrame:
    """(feature, threshold, median, separation): each feature's threshold from native texts, and how far translated ones lie above."""
    low = floor_percentile(long_features(native, column), share, "feature", name="p")
    mid = floor_percentile(long_features(translated, column), 0.5, "feature", name="median")
    sep = F.when((F.col("p") > 0) & (F.col("median") > 2 * F.col("p")), "STRONG").when(F.col("median") > F.col("p"), "weak").otherwise("NONE")
    return low.join(mid, "feature").select("feature", F.bround("p", 4).alias("threshold"), F.round("median", 6).alias("median"), sep.alias("separation"))


def fire_counts(df: DataFrame, column: ColumnLike, thresholds: dict[str, float] | None = None) -> DataFrame:
    """(feature, rows): in how many texts each feature is above its threshold."""
    hit = df.where(F.coalesce(col(column), F.lit("")) != "").select(F.explode(text.fired(text.translation_features(column), thresholds)).alias("feature"))
    return hit.groupBy("feature").agg(F.count("*").alias("rows"))


def fertility(df: DataFrame, column: ColumnLike, pieces: ColumnLike, *, other: ColumnLike | None = None, limit: float = 1.4) -> DataFrame:
    """One row: characters, Hangul, words, tokens, tokens to a word and character, share of pieces of two characters or less; with another
    tokenizer's pieces the ratio of both and whether to extend."""
    words, sizes = F.sum(text.word_count(column)), F.sum(F.size(col(pieces)))
    short = F.sum(F.size(F.filter(col(pieces), lambda x: F.length(x) <= 2)))
    least = lambda c: F.greatest(c, F.lit(1))
    out = [F.sum(F.length(col(column))).alias("chars"), F.sum(text.hangul_chars(column)).alias("hangul"), words.alias("words"), sizes.alias("tokens")]
    out += [F.round(sizes / least(words), 6).alias("tokens_per_word"), F.round(sizes / least(F.sum(F.length(col(column)))), 6).alias("tokens_per_char"), F.round(short / least(sizes), 6).alias("short_share")]
    if other is not None:
        ratio = sizes / least(F.sum(F.size(col(other))))
        out += [F.round(ratio, 6).alias("ratio"), (ratio > limit).alias("extend")]
    return df.agg(*out)
