"""Filters that name their reason, and converters of benchmark rows. A row is never dropped silently: ``reason`` is null for kept rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import profiles as p
from ..functions import templates, text, verify
from ..functions.chat import first_filled, low_language_turn
from ..functions.text import ColumnLike, col


def pool_filter(df: DataFrame, response: ColumnLike, *, target: str | None = None, threshold: float = 0.8, least: int = 2, min_signals: int = 3) -> DataFrame:
    """Adds ``reason``: register_mix, then register_target, then translationese; the first that holds. Empty texts are kept."""
    summary, body = text.register_summary(text.registers(response)), col(response)
    off = ~text.register_is(summary, target) if target else F.lit(False)
    reason = (
        F.when(F.coalesce(body, F.lit("")) == "", None)
        .when(~text.register_consistent(summary, threshold, least), "register_mix")
        .when(off, "register_target")
        .when(text.translated(text.translation_features(body), min_signals), "translationese")
    )
    return df.withColumn("reason", reason)


def translation_filter(df: DataFrame, response: ColumnLike, *, min_signals: int = 3, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Adds ``fired``; empty texts are skipped (neither kept nor counted), so they leave."""
    fired = text.fired(text.translation_features(response), thresholds)
    return df.where(F.coalesce(col(response), F.lit("")) != "").withColumn("fired", fired).withColumn("reason", F.when(F.size("fired") >= min_signals, "translationese"))


def register_filter(df: DataFrame, response: ColumnLike, *, target: str | None = None, threshold: float = 0.8, least: int = 2) -> DataFrame:
    """Adds ``register`` (score, dominant, n) and ``reason``; texts without any level are kept, with a target too."""
    out = df.withColumn("register", text.register_summary(text.registers(F.coalesce(col(response), F.lit("")))))
    r = F.col("register")
    off = (r["n"] > 0) & (r["dominant"] != target) if target else F.lit(False)
    return out.withColumn("reason", F.when(~text.register_consistent(r, threshold, least), "mixed").when(off, "off_target"))


def grounded_filter(df: DataFrame, task: str, completion: ColumnLike, passage: ColumnLike, *, min_hangul: float = 0.7, register: str | None = None) -> DataFrame:
    """Adds ``parsed`` and ``reason``: unparsed, language, unfaithful (not for titles), off_register; the first that holds."""
    out = df.withColumn("parsed", templates.parsed_completion(task, completion))
    pairs = F.concat_ws("\n", F.transform(F.col("parsed.pairs"), lambda x: x["a"]))
    out = out.withColumn("answer", F.coalesce(F.col("parsed.answer"), pairs))
    faithful = F.lit(True) if task in p.UNGROUNDED_TASKS else text.grounded("answer", passage)
    levels = text.register_summary(text.registers("answer"))
    off = ~text.register_is(levels, register) if register else F.lit(False)
    reason = F.when(F.col("parsed").isNull(), "unparsed").when(text.hangul_fraction("answer") < min_hangul, "language").when(~faithful, "unfaithful").when(off, "off_register")
    return out.withColumn("reason", reason)


def language_gate(df: DataFrame, messages: ColumnLike = "messages", *, least: float = 0.6) -> DataFrame:
    """Adds ``flagged``: some assistant turn has too little Hangul; turns without letters pass."""
    return df.withColumn("flagged", low_language_turn(messages, least, lambda x: text.hangul_fraction(x, empty=1.0)))


def drop_blank(df: DataFrame, column: ColumnLike = "text") -> DataFrame:
    return df.where(text.strip(column) != "")


def reasons(df: DataFrame, *by: str) -> DataFrame:
    """How many rows each reason took, and their share of the pool."""
    counted = df.groupBy(*by, F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))
    pools = df.groupBy(*by).agg(F.count("*").alias("pool"))
    joined = counted.join(pools, list(by)) if by else counted.crossJoin(F.broadcast(pools))  # one row of totals
    return joined.withColumn("share", F.round(F.col("rows") / F.col("pool"), 6))


def from_worked_answers(df: DataFrame, question: ColumnLike = "question", answer: ColumnLike = "answer") -> DataFrame:
    """(problem, gold): the number after the last "####"."""
    gold = F.regexp_replace(text.strip(F.element_at(F.split(col(answer), "####"), -1)), ",", "")
    return df.where((col(question) != "") & F.contains(col(answer), F.lit("####"))).select(text.strip(question).alias("problem"), gold.alias("gold")).where(F.col("gold").rlike(r"^-?\d+(?:\.\d+)?$"))


def from_boxed_solutions(df: DataFrame, problem: ColumnLike = "problem", solution: ColumnLike = "solution") -> DataFrame:
    """(problem, gold): what the last box holds, braces balanced."""
    return df.select(text.strip(problem).alias("problem"), verify.boxed_answer(col(solution)).alias("gold")).where("problem <> '' and gold is not null")


def from_plain_answers(df: DataFrame, problem: ColumnLike = "problem", answer: ColumnLike = "answer") -> DataFrame:
    return df.select(text.strip(problem).alias("problem"), text.strip(col(answer).cast("string")).alias("gold")).where("problem <> '' and gold is not null")


def from_function_tests(df: DataFrame, prompt: ColumnLike = "prompt", test: ColumnLike = "test", entry: ColumnLike = "entry_point", timeout: float = 5.0) -> DataFrame:
    """(problem, gold struct(tests, timeout)) of a function to complete and its check."""
    whole = (first_filled(prompt) != "") & (first_filled(test) != "") & (first_filled(entry) != "")
    problem = F.concat(F.lit("Complete the following Python function:\n\n```python\n"), col(prompt), F.lit("```"))
    tests = F.concat(col(test), F.lit("\n\ncheck("), col(entry), F.lit(")"))
    return df.where(whole).select(problem.alias("problem"), F.struct(tests.alias("tests"), F.lit(timeout).alias("timeout")).alias("gold"))


def from_assertions(df: DataFrame, task: ColumnLike = "text", tests: ColumnLike = "test_list", setup: ColumnLike = "test_setup_code", timeout: float = 5.0) -> DataFrame:
    """(problem, gold struct(tests, timeout)) of a task and its assertions; the first is shown."""
    shown = F.concat(text.strip(task), F.lit("\n\n다음은 실례 테스트입니다:\n```python\n"), F.get(col(tests), F.lit(0)), F.lit("\n```"))
    code = F.concat_ws("\n", F.nullif(col(setup), F.lit("")), col(tests))
    return df.where((text.strip(F.coalesce(col(task), F.lit(""))) != "") & (F.size(F.coalesce(col(tests), F.array())) > 0)).select(shown.alias("problem"), F.struct(code.alias("tests"), F.lit(timeout).alias("timeout")).alias("gold"))


def from_choices(df: DataFrame, question: ColumnLike = "question", choices: ColumnLike = "choices", answer: ColumnLike = "answer", *, one_based: bool = False) -> DataFrame:
    """(problem, gold letter, n_options). answer: an index from 0, or from 1 with ``one_based`` (where 0 counts as 1), or a label."""
    options, raw = col(choices), text.strip(col(answer).cast("string"))
    letters = F.split(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "")
    index = raw.try_cast("int") - (F.when(raw.try_cast("int") > 0, 1).otherwise(0) if one_based else 0)
    label = verify.option_letter(F.left(raw, F.lit(1)))
    letter = F.when(raw.rlike(r"^-?\d+$"), F.get(letters, index)).otherwise(label) if one_based else F.get(letters, index)
    shown = F.concat_ws("\n", F.transform(options, lambda x, i: F.concat(F.get(letters, i), F.lit(") "), x)))
    rows = df.where((text.strip(F.coalesce(col(question), F.lit(""))) != "") & F.size(F.coalesce(options, F.array())).between(2 if one_based else 1, 26) & raw.isNotNull())
    out = rows.select(F.concat(text.strip(question), F.lit("\n\n"), shown).alias("problem"), letter.alias("gold"), F.size(options).alias("n_options"))
    return out.where(F.col("gold").rlike("^[A-Z]$") & (F.ascii("gold") - 65 < F.col("n_options")))
