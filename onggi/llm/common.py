"""What the operators of this subpackage share: one form of text, its letters, loading and lineage cuts.

One form (``canon``): full-width and half-width forms become ordinary ones, every space separator becomes a
plain space, invisible characters vanish, composed and decomposed letters are composed, look-alike letters of
other alphabets become Latin, doubly encoded Han characters become the unified ones. Accents, case and
raised digits stay as they are.
"""

from __future__ import annotations

import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters of other alphabets that look like Latin ones.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ӏ": "I", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "γ": "y", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
    "օ": "o", "ս": "u", "ո": "n", "հ": "h", "ɑ": "a", "ɡ": "g",
}

_RANGES = ((0, 0x10000), (0x11000, 0x12000), (0x1D100, 0x1D800), (0x2F800, 0x2FA20), (0xE0000, 0xE01F0))
_WIDTHS = ("<wide>", "<narrow>", "<font>")


@lru_cache(1)
def fold_table() -> dict[int, str | None]:
    """Code point -> its ordinary form, None for an invisible one; built from the Unicode data by rule."""
    table: dict[int, str | None] = {}
    for low, high in _RANGES:
        for point in range(low, high):
            ch = chr(point)
            kind = unicodedata.category(ch)
            if (kind == "Cf" and not 0x600 <= point < 0x900 and not 0x11000 <= point < 0x12000) or 0xFE00 <= point <= 0xFE0F or point >= 0xE0100 or point == 0x34F:
                table[point] = None
            elif kind == "Zs":
                table[point] = " "
            elif parts := unicodedata.decomposition(ch):
                head, *rest = parts.split()
                if head in _WIDTHS or (head == "<compat>" and 0x2E80 <= point <= 0x2FDF):
                    table[point] = "".join(chr(int(x, 16)) for x in rest)
    table.pop(0x20, None)
    return table | {ord(k): v for k, v in LOOKALIKES.items()}


@lru_cache(1)
def unusual() -> re.Pattern:
    """Matches a character that may change in ``canon``; a text without any is already in the one form."""
    table, points = fold_table(), []
    parts = (unicodedata.decomposition(chr(p)) for low, high in _RANGES for p in range(low, high))
    second = {int(x.split()[1], 16) for x in parts if " " in x and x[0] != "<"}  # vowel signs that compose are no combining marks
    for low, high in _RANGES:
        for p in range(low, high):
            ch = chr(p)
            if 0xD800 <= p <= 0xDFFF:
                continue
            jamo = 0x1100 <= p <= 0x11FF or 0xA960 <= p <= 0xA97F or 0xD7B0 <= p <= 0xD7FF
            if p in table or jamo or p in second or unicodedata.combining(ch):
                points.append(p)
            elif unicodedata.decomposition(ch) and not 0xAC00 <= p <= 0xD7A3 and _fold(ch) != ch:
                points.append(p)
    spans: list[list[int]] = []
    for p in points:
        if spans and spans[-1][1] == p - 1:
            spans[-1][1] = p
        else:
            spans.append([p, p])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]")


def _fold(text: str) -> str:
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(fold_table()))


def canon(text: str) -> str:
    """The text in its one form."""
    return _fold(text) if unusual().search(text) else text


_NOT_LETTERS = re.compile(r"[\W_]+")


def letters(text: str) -> str:
    """Letters and digits only, in lower case, of the text in its one form."""
    return letters_of(canon(text))


def letters_of(form: str) -> str:
    """The same of a text that is in its one form."""
    return _NOT_LETTERS.sub("", form.lower())


def points(texts: list[str]) -> np.ndarray:
    """Code points of all texts, one after the other."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(1)
def _unusual_points() -> np.ndarray:
    pattern, out = unusual(), np.zeros(0x110000, bool)
    for low, high in _RANGES:
        out[low:high] = [pattern.match(chr(p)) is not None for p in range(low, high)]
    return out


@lru_cache(1)
def _letter_points() -> np.ndarray:
    return np.array([chr(p).isalnum() for p in range(0x110000)])


def canon_all(texts: list[str]) -> list[str]:
    """``canon`` of many texts: only those with an unusual character are folded, which is looked up for all at once."""
    if not texts:
        return []
    met = np.r_[0, np.cumsum(_unusual_points()[points(texts)])]
    ends = np.cumsum([len(t) for t in texts])
    odd = met[ends] > met[np.r_[0, ends[:-1]]]
    return [_fold(t) if o else t for t, o in zip(texts, odd.tolist())]


def letters_all(forms: list[str]) -> list[str]:
    """``letters_of`` of many texts."""
    if not forms:
        return []
    low = [t.lower() for t in forms]
    every = points(low)
    keep = _letter_points()[every]
    kept = every[keep].tobytes().decode("utf-32-le", "surrogatepass")
    ends = np.r_[0, np.cumsum(keep)][np.cumsum([len(t) for t in low])].tolist()
    return [kept[a:b] for a, b in zip([0, *ends], ends)]


#: The same test in Java syntax, a little wider: text that may need ``canon``. The most common characters are passed over first.
UNUSUAL_JAVA = (
    r"[[^\x00-\x7f\uac00-\ud7a3\u4e00-\u9fff\u3041-\u3096\u30a1-\u30fa]&&[\p{Cf}\p{M}\u00a0\u0251\u0261\u0370-\u058f\u1100-\u11ff\u1680\u1f00-\u1fff\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2100-\u214f"
    r"\u2e80-\u2fdf\u3000\ua960-\ua97f\ud7b0-\ud7ff\uf900-\ufaff\ufe00-\ufe0f\uff01-\uffef\x{1d400}-\x{1d7ff}\x{2f800}-\x{2fa1f}\x{e0000}-\x{e01ef}"
    # letters and brackets that are always decomposed, and marks that Java's Unicode data may lack
    r"\u0958-\u095f\u09dc\u09dd\u09df\u0a33\u0a36\u0a59-\u0a5b\u0a5e\u0b5c\u0b5d\u0f43\u0f4d\u0f52\u0f57\u0f5c\u0f69\u2329\u232a\u2adc\ufb1d-\ufb4f"
    r"\u0898-\u089f\u08ca-\u08d2\u0c3c\u1715\u1ac1-\u1ace\u1dfa\x{1d15e}-\x{1d164}\x{1d1bb}-\x{1d1c0}]]"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by name; one with fewer splits than there are cores is spread over the cores, a larger one is read as it lies."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def once(df: DataFrame, key: str) -> DataFrame:
    """Each id once; later deliveries of a row hold the same values."""
    return df.dropDuplicates([key])


def first_answer(messages: str = "messages"):
    """Content of the first message with role assistant; null if there is none."""
    return F.expr(f"get(filter({messages}, m -> m.role = 'assistant'), 0).content")


def paragraphs_and_answers(spark: SparkSession, sf_dir: str, exemplars: str, column: str, deliveries: bool = False) -> DataFrame:
    """(src, rec_id, text) of one exemplar table and of the first answers of chats; null texts left out.

    Each id once, or with ``deliveries`` as often as it came, so that texts needn't be shuffled where ids are made distinct later.
    """
    a = table(spark, sf_dir, exemplars).select("exemplar_id", F.col(f"`{column}`").alias("text"))
    b = table(spark, sf_dir, "chats").select("chat_id", first_answer().alias("text"))
    if not deliveries:
        a, b = once(a, "exemplar_id"), once(b, "chat_id")
    return (
        a.select(F.lit(exemplars).alias("src"), F.col("exemplar_id").alias("rec_id"), "text")
        .unionByName(b.select(F.lit("chats").alias("src"), F.col("chat_id").alias("rec_id"), "text"))
        .where("text is not null")
    )


def outputs_and_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, rec_id, text, source) of predictions and of every assistant message of chats; null texts left out.

    Deliveries come as they are, so that texts needn't be shuffled: who reports ids makes them distinct in the end.
    """
    p = table(spark, sf_dir, "predictions")
    said = F.explode(F.expr("transform(filter(messages, m -> m.role = 'assistant'), m -> m.content)"))
    return (
        p.select(F.lit("predictions").alias("src"), F.col("pred_id").alias("rec_id"), F.col("prediction").alias("text"), "source")
        .unionByName(table(spark, sf_dir, "chats").select(F.lit("chats").alias("src"), F.col("chat_id").alias("rec_id"), said.alias("text"), "source"))
        .where("text is not null")
    )


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a reliable checkpoint in the folder the cluster names; sets one only where none is set."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = f"/tmp/onggi-checkpoints-{os.getpid()}"
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
