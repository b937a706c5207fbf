"""Lineage cuts and numbering that hold at any size."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder that the cluster names in spark.checkpoint.dir; own folder only where none is set, in local tests."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = f"/tmp/onggi-checkpoints-{os.getpid()}"
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def spread(table: DataFrame) -> DataFrame:
    """A scan with fewer splits than there are cores is spread over the cores; a larger one is read as it lies."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def numbered(df: DataFrame, *order: Column | str, name: str = "row") -> tuple[DataFrame, int]:
    """The rows with their place (from 0) in a total order, and how many there are.

    A window without partitions would sort everything in one task: rows are range-partitioned and sorted instead, and each
    partition adds the counts of those before it (one number for each partition comes to the driver).
    """
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    counts = dict(placed.groupBy("_part").count().collect())
    total, starts = 0, []
    for part in sorted(counts):
        starts.append((part, total))
        total += counts[part]
    if not starts:
        return placed.drop("_part", "_at").withColumn(name, F.lit(0).cast("bigint")), 0
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start bigint")
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start"), total


def ranked(df: DataFrame, by: str, hash: Column, *keys: str, ranges: int = 1024) -> DataFrame:
    """Adds _rank (from 1) by (hash, keys) within each value of ``by``, and _rows, how many it has.

    A hash below 2^60 is cut into ranges: counts of the ranges before (a small table) are added to the place inside the
    range, so a value that a third of all rows share is sorted in many tasks.
    """
    cut_ = df.withColumn("_h", hash).withColumn("_range", F.shiftrightunsigned("_h", 60 - ranges.bit_length() + 1))
    counts = cut_.groupBy(by, "_range").agg(F.count("*").alias("_c"))
    before = counts.withColumn("_before", F.sum("_c").over(Window.partitionBy(by).orderBy("_range")) - F.col("_c")).withColumn("_rows", F.sum("_c").over(Window.partitionBy(by)))
    inside = cut_.withColumn("_at", F.row_number().over(Window.partitionBy(by, "_range").orderBy("_h", *keys)))
    joined = inside.alias("i").join(before.select(F.col(by).alias("_by"), F.col("_range").alias("_r2"), "_before", "_rows"), F.col(f"i.{by}").eqNullSafe(F.col("_by")) & (F.col("i._range") == F.col("_r2")))
    return joined.withColumn("_rank", F.col("_before") + F.col("_at")).drop("_h", "_range", "_by", "_r2", "_before", "_at")
