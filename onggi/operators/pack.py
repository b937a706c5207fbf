"""Packing short documents of a group into long ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import ColumnLike, col


def pack(df: DataFrame, *, target: int = 28_000, least: int | None = None, key: str | None = None, order: str = "doc_id", column: str = "text", tokens: Column | None = None, separator: str = "\n\n", separator_tokens: int = 0) -> DataFrame:
    """(key, pack, n_docs, tokens, text): documents of a group, in their order, packed greedily up to ``target`` tokens.

    A document of ``least`` tokens or more stands alone and closes the pack before it; another closes it first if it would
    exceed the target, and closes its own on reaching it. The order makes this sequential within a group, so only
    (order, tokens) goes through the sequential step, streamed and never held; texts are gathered in parallel.
    Blank texts leave; a missing key is the group "_all".
    """
    group = F.coalesce(F.col(key).cast("string"), F.lit("_all")) if key else F.lit("_all")
    docs = df.where(F.coalesce(text.strip(column), F.lit("")) != "").select(group.alias("key"), F.col(order).alias("at"), (tokens if tokens is not None else text.word_count(column)).cast("bigint").alias("n"), F.col(column).alias("text"))
    kind = dict(docs.dtypes)["at"]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, number, held, filled = None, 0, 0, 0  # group, open pack, tokens and documents in it
        for batch in batches:
            out = np.empty(len(batch), np.int64)
            for i, (g, n) in enumerate(zip(batch["key"], batch["n"])):
                if g != now:
                    now, number, held, filled = g, 0, 0, 0
                alone = least is not None and n >= least
                cost = n + (separator_tokens if filled else 0)
                if filled and (alone or held + cost > target):
                    number, held, filled, cost = number + 1, 0, 0, n
                out[i] = number
                held, filled = held + cost, filled + 1
                if alone or held >= target:
                    number, held, filled = number + 1, 0, 0
            yield pd.DataFrame({"key": batch["key"], "at": batch["at"], "pack": out})

    placed = docs.select("key", "at", "n").repartition("key").sortWithinPartitions("key", "at").mapInPandas(place, f"key string, at {kind}, pack bigint")
    joined = F.concat_ws(separator, F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]))
    gathered = docs.join(placed, ["key", "at"]).groupBy("key", "pack").agg(F.count("*").alias("n_docs"), F.sum("n").alias("doc_tokens"), joined.alias("text"))
    return gathered.select("key", "pack", "n_docs", (F.col("doc_tokens") + separator_tokens * (F.col("n_docs") - 1)).alias("tokens"), "text")


def sizes(df: DataFrame, tokens: ColumnLike) -> DataFrame:
    """One row: documents, their mean and largest number of tokens."""
    return df.agg(F.count("*").alias("docs"), F.round(F.avg(col(tokens)), 6).alias("mean_tokens"), F.max(col(tokens)).cast("bigint").alias("max_tokens"))
