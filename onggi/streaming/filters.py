"""Filters on streams. The row-local ones are the batch functions themselves; what needs memory keeps it in watermarked state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import filters


def filtered_stream(stream: DataFrame, response: str, **options) -> DataFrame:
    """The pool filter on a stream: the same plan as in batch, without state."""
    return filters.pool_filter(stream, response, **options)


def reason_counts(stream: DataFrame, time: str, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(window, reason, rows): kept and dropped rows in each window; rows later than the watermark are ignored."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


def first_copies(stream: DataFrame, column: str, time: str, late: str = "1 hour") -> DataFrame:
    """Rows whose text did not come within the watermark before; the state holds digests, not texts."""
    keyed = stream.withColumn("_k", F.md5(text.strip(F.col(column)))).withWatermark(time, late)
    return keyed.dropDuplicatesWithinWatermark(["_k"]).drop("_k")
