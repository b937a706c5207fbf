"""Columns over messages: which turn, which field, numbered lists and verdicts in a reply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, any_of, col, strip


def first_assistant(messages: ColumnLike = "messages") -> Column:
    """Content of the first assistant message, or an empty string."""
    said = F.filter(col(messages), lambda m: m["role"] == "assistant")
    return F.coalesce(F.get(said, F.lit(0))["content"], F.lit(""))


def response_text(text: ColumnLike | None = None, messages: ColumnLike | None = None, mode: str = "auto") -> Column:
    """The text to judge: a flat text, or the first assistant message, as ``mode`` (auto, text, assistant) says."""
    flat = col(text) if text is not None else F.lit(None).cast("string")
    said = first_assistant(messages) if messages is not None else F.lit("")
    if mode == "text":
        return F.coalesce(flat, F.lit(""))
    return said if mode == "assistant" else F.coalesce(flat, said)


def first_filled(*columns: ColumnLike) -> Column:
    """The first of the columns that is neither null nor empty, else an empty string."""
    return F.coalesce(*(F.nullif(col(x).cast("string"), F.lit("")) for x in columns), F.lit(""))


def numbered_lines(x: ColumnLike) -> Column:
    """What stands after "1." or "1)" in each line that has it."""
    found = F.transform(F.split(col(x), r"\R"), lambda s: F.regexp_extract(s, r"^(?U:\s)*\d+[.)](?U:\s)+(.*(?U:\S))", 1))
    return F.filter(found, lambda s: s != "")


def verdict(x: ColumnLike) -> Column:
    """A or B after a marker, or in a JSON object's winner, else null."""
    text = col(x)
    marked = F.upper(F.regexp_extract(text, f"{any_of(('판정', '승자', 'winner', 'verdict'))}(?U:\\s)*[:：](?U:\\s)*\"?([ABab])", 1))
    doc = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    named = F.upper(strip(F.coalesce(F.nullif(F.get_json_object(doc, "$.winner"), F.lit("")), F.get_json_object(doc, "$.판정"))))
    return F.when(marked != "", marked).when(named.isin("A", "B"), named)


def agreed(first: ColumnLike, swapped: ColumnLike) -> Column:
    """The response that wins in either order of showing, else null."""
    other = F.when(col(swapped) == "A", "B").when(col(swapped) == "B", "A")
    return F.when(col(first) == other, col(first))


def low_language_turn(messages: ColumnLike, least: float, measure) -> Column:
    """Whether some assistant turn has less than ``least`` of the wanted script."""
    return F.exists(F.filter(col(messages), lambda m: m["role"] == "assistant"), lambda m: measure(m["content"]) < least)
