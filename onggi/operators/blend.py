"""Blends of pools, reproducible draws, generated problems and haystacks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import profiles as p
from ..functions import templates, text
from .common import numbered, ranked


def weights(df: DataFrame, weight: str = "weight") -> DataFrame:
    """Weights divided by their sum."""
    return df.withColumn(weight, F.col(weight) / F.sum(weight).over(Window.partitionBy(F.lit(1))))  # a row for each source


def budget(df: DataFrame, total: float, *, size: str = "tokens_b", weight: str = "weight") -> DataFrame:
    """Adds seen tokens, epochs and whether a source repeats more than four times, for a token budget; weights are normalised first."""
    out = weights(df, weight).withColumn("seen", F.lit(total) * F.col(weight))
    return out.withColumn("epochs", F.col("seen") / F.col(size)).withColumn("high", F.col("epochs") > 4)


def blend(pools: dict[str, tuple[DataFrame, str]], shares: dict[str, float], total: int, seed: int = 0) -> DataFrame:
    """(pool, draw, place, ...): int(total x share) rows of each pool, drawn with replacement, in a shuffled order by ``place``.

    A draw is a hash of (seed, pool, number) into the numbered pool and reaches its row by an equi-join; an empty pool gives
    no rows. The same on every run and cluster.
    """
    out = None
    for name, (df, order) in pools.items():
        rows, n = numbered(df, order, name="_row")
        wanted = int(total * shares[name]) if n else 0
        draws = df.sparkSession.range(wanted).withColumnRenamed("id", "draw").withColumn("_row", F.pmod(text.stable_hash(seed, F.lit(name), "draw"), F.lit(max(n, 1))))
        part = draws.join(rows, "_row").drop("_row").select(F.lit(name).alias("pool"), "draw", text.stable_hash(f"{seed}-place", F.lit(name), "draw").alias("place"), *df.columns)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def draw(df: DataFrame, k: int, *keys: str, seed: int = 0) -> DataFrame:
    """k rows without replacement: the lowest hashes of their keys; Spark keeps k rows in each task, not the table."""
    return df.withColumn("_h", text.stable_hash(seed, *keys)).orderBy("_h", *keys).limit(k).drop("_h")


def draw_each(df: DataFrame, k, *keys: str, by: str, seed: int = 0) -> DataFrame:
    """The same within each value of ``by``; ``k`` a number, where Spark stops ranking at it, or a column (a quota)."""
    if isinstance(k, int):
        rank = F.row_number().over(Window.partitionBy(by).orderBy(text.stable_hash(seed, *keys), *keys))
        return df.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")
    return ranked(df, by, text.stable_hash(seed, *keys), *keys).where(F.col("_rank") <= k).drop("_rank", "_rows")


def split(df: DataFrame, share: float, *keys: str, by: str, seed: int = 0) -> DataFrame:
    """Adds ``part``: calibration for the first ``share`` of each stratum in hash order, test for the rest."""
    rows = ranked(df, by, text.stable_hash(seed, *keys), *keys)
    place = F.when(F.col("_rows") > 1, (F.col("_rank") - 1) / (F.col("_rows") - 1)).otherwise(0.0)
    return rows.withColumn("part", F.when(place < share, "calibration").otherwise("test")).drop("_rank", "_rows")


def sweep(df: DataFrame, **axes: list[str]) -> DataFrame:
    """Each row with each combination of short lists of settings."""
    for name, values in axes.items():
        df = df.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return df


def pair_documents(df: DataFrame, *, en: str = "en", ko: str = "ko", key: str, seed: int = 0) -> DataFrame:
    """(key, text): each pair in one of five templates chosen by hash; pairs with a blank side leave."""
    return df.select(key, templates.pair_document(en, ko, text.stable_hash(seed, key)).alias("text")).where("text is not null")


def haystacks(spark: SparkSession, filler: list[str], *, lang: str = "ko", lengths: tuple[int, ...] = p.LENGTH_BUCKETS, depths: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0), per_cell: int = 1, seed: int = 0) -> DataFrame:
    """(prompt, answer, lang, context_tokens, depth): a needle at each depth of each length, filler cycled under the word budget."""
    needle, question = p.NEEDLES[lang]
    count = lambda s: len(s.split())
    cell = spark.createDataFrame([(n,) for n in lengths], "context_tokens int").withColumn("depth", F.explode(F.array(*map(F.lit, depths)))).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(per_cell))))
    cell = cell.withColumn("answer", (F.pmod(text.stable_hash(seed, F.lit(lang), "context_tokens", "depth", "n"), F.lit(90_000)) + 10_000).cast("string"))
    sizes = [count(s) for s in filler]
    fixed = count(p.HAYSTACK_PREAMBLE) + count(needle) + count(question)

    def cycle(budget: int, start: int) -> list[str]:
        used, out = 0, []
        while budget > 0 and used < budget:
            k = (start + len(out)) % len(filler)
            if out and used + sizes[k] > budget:
                break
            out.append(filler[k])
            used += sizes[k]
        return out

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            prompts = []
            for tokens, depth, answer in zip(b["context_tokens"], b["depth"], b["answer"]):
                room = max(tokens - fixed, 0)
                before = cycle(round(depth * room), 0)
                after = cycle(room - round(depth * room), len(before))
                prompts.append("\n".join([p.HAYSTACK_PREAMBLE, *before, needle.format(value=answer), *after, "", question]))
            yield pd.DataFrame({"prompt": prompts, "answer": b["answer"], "lang": lang, "context_tokens": b["context_tokens"], "depth": b["depth"]})

    return cell.mapInPandas(build, "prompt string, answer string, lang string, context_tokens int, depth double")


def solved_grid(rng: np.random.Generator) -> np.ndarray:
    """A random solved sudoku: the open cell with the fewest digits left is filled next, by a digit drawn at random; dead ends go back."""
    cells = np.arange(81)
    unit = np.stack([cells // 9, 9 + cells % 9, 18 + cells // 27 * 3 + cells % 9 // 3], 1)
    value, free = np.zeros(81, np.int64), np.full(27, 0b111111111)
    trail: list[tuple[int, list[int]]] = []
    while len(trail) < 81:
        open_ = np.flatnonzero(value == 0)
        left = free[unit[open_]]
        left = left[:, 0] & left[:, 1] & left[:, 2]
        at = int(np.bitwise_count(left).argmin())
        cell, digits = int(open_[at]), [d for d in rng.permutation(9).tolist() if left[at] >> d & 1]
        while not digits:  # back to the last cell with another choice
            cell, digits = trail.pop()
            free[unit[cell]] |= 1 << int(value[cell]) - 1
            value[cell] = 0
        digit = digits.pop()
        value[cell] = digit + 1
        free[unit[cell]] &= ~(1 << digit)
        trail.append((cell, digits))
    return value.reshape(9, 9)


def sudokus(spark: SparkSession, n: int, *, level: str = "medium", blanks: int | None = None, seed: int = 0) -> DataFrame:
    """(id, problem, puzzle, solution): a solved grid with as many cells cleared as the level says, or ``blanks``; puzzle and solution as JSON. By row id, so reproducible."""
    blanks = p.SUDOKU_BLANKS[level] if blanks is None else blanks

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            problems, puzzles, solutions = [], [], []
            for k in b["id"]:
                rng = np.random.default_rng((seed, int(k)))
                grid = solved_grid(rng)
                hidden = grid.copy()
                hidden.reshape(-1)[rng.permutation(81)[:blanks]] = 0
                shown = "\n".join(" ".join(str(x) if x else "." for x in row) for row in hidden.tolist())
                problems.append(p.SUDOKU_PROBLEM.replace("{grid}", shown))
                puzzles.append(str(hidden.tolist()))
                solutions.append(str(grid.tolist()))
            yield pd.DataFrame({"id": b["id"], "problem": problems, "puzzle": puzzles, "solution": solutions})

    return spark.range(n).mapInPandas(make, "id bigint, problem string, puzzle string, solution string")


def format_prompts(entities: DataFrame, forms: list[tuple[str, str]], *, entity: str = "entity", seed: int = 0, each: int = 1) -> DataFrame:
    """(prompt, gold): ``each`` forms for each entity, chosen by hash; a form is (template with {e}, gold JSON). The first number in a prompt is its list's length."""
    table = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(g).alias("g")) for t, g in forms))
    chosen = entities.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(each - 1)))).withColumn("_f", F.element_at(table, (F.pmod(text.stable_hash(seed, entity, "_k"), F.lit(len(forms))) + 1).cast("int")))
    prompt = F.replace(F.col("_f.t"), F.lit("{e}"), F.col(entity))
    count = F.regexp_extract(prompt, r"(\d+)", 1)
    return chosen.select(prompt.alias("prompt"), F.replace(F.col("_f.g"), F.lit('"{n}"'), F.when(count == "", "1").otherwise(count)).alias("gold"))
