"""Model calls: a batch callable is run over Arrow batches, so any client, local model or test double fits.

A hook's calls may cost more than anything else, so its results should be written (or checkpointed) before they are used twice.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.verify import code_block

Complete = Callable[[list[str]], list]


def with_model(df: DataFrame, column: str, model: Callable[[], Complete], *, name: str = "output", kind: str = "string", batch: int = 256) -> DataFrame:
    """Adds ``name``: what the model gives for ``column``. ``model`` is called once in each task and returns a function from a list of
    values to a list of results (strings, lists of K samples, numbers), ``batch`` at a time."""
    arrow = {"string": pa.string(), "double": pa.float64(), "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()), "boolean": pa.bool_(), "bigint": pa.int64()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = model()
        for b in batches:
            values = b.column(column).to_pylist()
            out = [y for k in range(0, len(values), batch) for y in call(values[k : k + batch])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, arrow)], [*b.schema.names, name])

    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    return df.mapInArrow(run, f"{schema}, `{name}` {kind}")


def fake_model(replies: list[str], k: int | None = None) -> Callable[[], Complete]:
    """A test double: replies chosen by the digest of the prompt, the same on every run; lists of ``k`` samples if given."""

    def model() -> Complete:
        def one(prompt, n: int) -> str:
            return replies[int.from_bytes(hashlib.md5(f"{prompt}|{n}".encode()).digest()[:6], "big") % len(replies)]

        return lambda prompts: [one(x, 0) if k is None else [one(x, n) for n in range(k)] for x in prompts]

    return model


def fake_scorer() -> Callable[[], Complete]:
    """A test double for log-probabilities: of each (prompt, continuation) in a JSON list, minus a digest of the prompt and continuation below 10."""

    def model() -> Complete:
        def one(asks: str) -> list[float]:
            return [-float(int(hashlib.md5(f"{p}|{x}".encode()).hexdigest()[:6], 16) % 1000) / 100 for p, x in ((a["prompt"], a["continuation"]) for a in json.loads(asks))]

        return lambda values: [one(v) for v in values]

    return model


def run_code(df: DataFrame, output: str, tests: str, runner: Callable[[], Complete]) -> DataFrame:
    """Adds ``verified``: what a sandbox says of the code in ``output`` and its tests. Nothing is run here: ``runner`` gets JSON {code, tests} and returns booleans."""
    asked = df.withColumn("_job", F.to_json(F.struct(code_block(output).alias("code"), F.col(tests).alias("tests"))))
    return with_model(asked, "_job", runner, name="verified", kind="boolean").drop("_job")
