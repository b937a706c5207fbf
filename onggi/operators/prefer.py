"""Preference pairs, verdicts of judges, rejection sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.chat import agreed
from ..functions.text import ColumnLike, col


def quality(response: ColumnLike, kind: ColumnLike, source: ColumnLike) -> Column:
    """struct of five signals, the most important first: language, speech level, format, faithfulness, health. Structs compare in this order."""
    levels = text.register_summary(text.registers(response))
    return F.struct(
        (text.hangul_fraction(response, empty=1.0) >= 0.6).cast("int").alias("language"),
        text.register_consistent(levels).cast("int").alias("register"),
        text.follows_format(response, kind).cast("int").alias("format"),
        text.grounded(response, source).cast("int").alias("faithful"),
        (~text.repeats_ngram(response)).cast("int").alias("health"),
    )


def preferred(df: DataFrame, a: ColumnLike = "response_a", b: ColumnLike = "response_b", kind: ColumnLike | None = None, source: ColumnLike | None = None) -> DataFrame:
    """Adds ``chosen`` and ``rejected``; pairs that tie in every signal leave."""
    none = F.lit(None).cast("string")
    k, s = (none if x is None else col(x) for x in (kind, source))
    scored = df.withColumn("_a", quality(a, k, s)).withColumn("_b", quality(b, k, s)).where("_a <> _b")
    return scored.withColumn("chosen", F.when(F.col("_a") > F.col("_b"), col(a)).otherwise(col(b))).withColumn("rejected", F.when(F.col("_a") > F.col("_b"), col(b)).otherwise(col(a))).drop("_a", "_b")


def judged(df: DataFrame, first: ColumnLike = "verdict_1", swapped: ColumnLike = "verdict_2", a: ColumnLike = "response_a", b: ColumnLike = "response_b") -> DataFrame:
    """Adds ``chosen`` and ``rejected`` where the verdict is the same in both orders of showing; other rows leave."""
    winner = agreed(first, swapped)
    return df.where(winner.isNotNull()).withColumn("chosen", F.when(winner == "A", col(a)).otherwise(col(b))).withColumn("rejected", F.when(winner == "A", col(b)).otherwise(col(a)))


def accepted(samples: DataFrame, keep: int = 2, *, key: str = "problem_id", order: str = "sample_id", correct: str = "correct") -> DataFrame:
    """The first ``keep`` correct samples of each problem. Spark stops ranking at the limit, so a hot problem isn't sorted whole."""
    ranked = samples.where(correct).withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    return ranked.where(F.col("_rank") <= keep).drop("_rank")


def sample_pairs(samples: DataFrame, *, key: str = "problem_id", order: str = "sample_id", correct: str = "correct", response: str = "response") -> DataFrame:
    """(key, chosen, rejected): the first correct and the first incorrect sample of each problem that has both; one partial aggregation."""
    first = lambda flag: F.min_by(F.when(flag, F.struct(response)), F.when(flag, F.col(order)))
    both = samples.groupBy(key).agg(first(F.col(correct)).alias("good"), first(~F.col(correct)).alias("bad"))
    return both.where("good is not null and bad is not null").select(key, F.col(f"good.{response}").alias("chosen"), F.col(f"bad.{response}").alias("rejected"))


def unsolved(problems: DataFrame, samples: DataFrame, *, key: str = "problem_id", correct: str = "correct") -> DataFrame:
    """Problems without a correct sample: the input of a second pass."""
    return problems.join(samples.where(correct).select(key).distinct(), key, "left_anti")


def solve_rate(samples: DataFrame, *, key: str = "problem_id", correct: str = "correct") -> DataFrame:
    """One row: problems, solved, rate (0 for no problems)."""
    each = samples.groupBy(key).agg(F.max(F.col(correct).cast("int")).alias("s"))
    total = each.agg(F.count("*").alias("problems"), F.coalesce(F.sum("s"), F.lit(0)).alias("solved"))
    return total.withColumn("rate", F.when(F.col("problems") == 0, 0.0).otherwise(F.round(F.col("solved") / F.col("problems"), 6)))
