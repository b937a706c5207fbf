"""Readers with declared schemas and writers: nothing is inferred by a second pass, and outputs carry their flags."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.common import cut

MESSAGES = "array<struct<role: string, content: string>>"
PREDICTIONS = "prediction string, response string, output string, text string, lang string, gold string, n_options int, verifier string"


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object to a line."""
    return spark.read.schema(schema).json(path)


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_pairs(spark: SparkSession, path: str, left: str = "en", right: str = "ko") -> DataFrame:
    """Pairs from JSON lines, or from lines of two or more fields between tabs."""
    if path.endswith(".jsonl"):
        return read_rows(spark, path, f"{left} string, {right} string")
    fields = F.split("value", "\t")
    return spark.read.text(path).where(F.size(fields) >= 2).select(F.get(fields, F.lit(0)).alias(left), F.get(fields, F.lit(1)).alias(right))


def read_units(spark: SparkSession, path: str, default: list[str]) -> DataFrame:
    """Lines without white space at the ends, blank ones left out; the default lines if none is left."""
    lines = spark.read.text(path).select(strip("value").alias("value")).where("value <> ''")
    return lines if lines.limit(1).count() else spark.createDataFrame([(x,) for x in default], "value string")


def head_of_corpus(df: DataFrame, max_chars: int, *, order: str, column: str = "text") -> DataFrame:
    """The first ``max_chars`` characters of the rows in their order; the last row is cut. A feature for samples, never a substitute for whole texts.

    Rows lie in ranges of the order; the characters of the ranges before (a number for each range comes to the driver) say where one
    begins, and ranges behind the end are not looked at again.
    """
    size = F.coalesce(F.length(column), F.lit(0))
    placed = cut(df.withColumn("_n", size).repartitionByRange(order).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id()))
    total, starts = 0, []
    for part, n in sorted(tuple(r) for r in placed.groupBy("_part").agg(F.sum("_n")).collect()):
        if total < max_chars:
            starts.append((part, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start bigint")
    by = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.join(F.broadcast(offsets), "_part")  # a row for each range
    sized = inside.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_n").over(by), F.lit(0))).where(F.col("_before") < max_chars)
    return sized.withColumn(column, F.left(F.col(column), (F.lit(max_chars) - F.col("_before")).cast("int"))).select(*df.columns)


def read_dataset(spark: SparkSession, root: str, schema: str, convert: Callable[[DataFrame], DataFrame], *, split: str = "train", subset: str | None = None, limit: int | None = None) -> DataFrame:
    """A split of a dataset folder (``root``/[``subset``/]``split``, JSON lines or Parquet), converted; the limit counts converted rows, in no order."""
    path = "/".join(x for x in (root, subset, split) if x)
    kinds = {"parquet": lambda p: spark.read.schema(schema).parquet(p), "jsonl": lambda p: read_rows(spark, p, schema), "json": lambda p: read_array(spark, p, schema)}
    for end, read in kinds.items():
        if Path(f"{path}.{end}").exists():
            rows = convert(read(f"{path}.{end}"))
            return rows if limit is None else rows.limit(limit)
    raise FileNotFoundError(f"{path}: none of {', '.join(kinds)}")


def register(spark: SparkSession, folder: str, *names: str) -> None:
    """Views by name over the Parquet tables of a folder, for queries in SQL."""
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)


def write_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_flagged(df: DataFrame, path: str, reason: str = "reason") -> None:
    """Kept and rejected rows side by side, in folders kept=true and kept=false, with the reason; one pass."""
    df.withColumn("kept", F.col(reason).isNull()).write.mode("overwrite").partitionBy("kept").json(path)


def write_verdicts(df: DataFrame, path: str, verified: Column, extracted: Column) -> None:
    write_rows(df.withColumn("verified", verified).withColumn("extracted", extracted), path)


def write_blend(budget: DataFrame, path: str, total: float, seq_length: int) -> None:
    """A few rows (source, path, weight) as YAML: weights, a flat list and a structured one."""
    rows = budget.select("source", "path", "weight").orderBy("source").collect()  # one row for each source
    lines = [f"total_tokens_b: {total}", f"seq_length: {seq_length}", "weights:", *(f"  {r.source}: {r.weight}" for r in rows), "data_path:"]
    lines += [x for r in rows for x in (f"- {round(r.weight, 4)}", f"- {json.dumps(r.path, ensure_ascii=False)}")]
    lines += ["blend:", *(x for r in rows for x in (f"- - {json.dumps(r.path, ensure_ascii=False)}", f"  - {r.weight}"))]
    Path(path).write_text("\n".join(lines) + "\n", encoding="utf-8")


def save_thresholds(thresholds: dict[str, float], path: str) -> None:
    Path(path).write_text(json.dumps(thresholds, ensure_ascii=False, indent=2), encoding="utf-8")


def load_thresholds(path: str) -> dict[str, float]:
    return {k: float(v) for k, v in json.loads(Path(path).read_text(encoding="utf-8")).items()}


def read_tokenizer(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """vocab(token, id), merges(rank, left, right) and added(token, id, special) of a tokenizer file; merges may be strings or pairs."""
    doc = spark.read.text(path, wholetext=True)
    get = lambda where: F.get_json_object("value", where)
    vocab = doc.select(F.explode(F.from_json(get("$.model.vocab"), "map<string,bigint>")).alias("token", "id"))
    listed = doc.select(F.posexplode(F.from_json(get("$.model.merges"), "array<string>")).alias("rank", "m"))
    pair = F.when(F.col("m").startswith("["), F.from_json("m", "array<string>")).otherwise(F.split("m", " ", 2))
    merges = listed.withColumn("p", pair).where(F.size("p") == 2).select(F.col("rank").cast("bigint").alias("rank"), F.col("p")[0].alias("left"), F.col("p")[1].alias("right"))
    added = doc.select(F.explode(F.from_json(get("$.added_tokens"), "array<struct<content:string,id:bigint,special:boolean>>")).alias("a")).select(F.col("a.content").alias("token"), "a.id", F.coalesce("a.special", F.lit(False)).alias("special"))
    return vocab, merges, added


def write_tokenizer(base_path: str, path: str, vocab: DataFrame, merges: DataFrame) -> None:
    """The base file with this vocabulary and these merges (both of vocabulary size); added tokens get their new ids."""
    doc = json.loads(Path(base_path).read_text(encoding="utf-8"))
    ids = {r.token: r.id for r in vocab.select("token", "id").orderBy("id").collect()}
    doc["model"]["vocab"] = ids
    keys = [k for k in ("source", "rank") if k in merges.columns]
    doc["model"]["merges"] = [f"{r.left} {r.right}" for r in merges.orderBy(*keys).collect()]
    doc["added_tokens"] = [t | {"id": ids[t["content"]]} for t in doc.get("added_tokens", []) if t["content"] in ids]
    Path(path).write_text(json.dumps(doc, ensure_ascii=False, indent=2), encoding="utf-8")
