"""Text cut off by field limits.

1. Lengths: every text's length is computed anew under other encodings (code points, UTF-8 and UTF-16 units, HTML-escaped,
   JSON-escaped, with CRLF line ends), without what may follow a cut (a mark, a broken character or escape), and counted
   by source and encoding. Where the lengths of a source pile up at one value far above the values before it and hardly any
   are longer, a storage limit shows; the encoding with the highest pile is the one the store counts in.
2. Endings: what follows the last whole sentence is inspected. Which words close sentences and list entries is counted
   over the whole corpus into a table of fixed size (hashed), not listed; the end of a text, which may be a cut, isn't
   counted. Shares of a word's own occurrences decide, so the size of the corpus doesn't.
3. A text is cut if it ends in a broken character or escape, within a quotation or bracket, within a number, word or
   sentence; a doubtful ending (a short phrase, a word that closes sentences only sometimes) is a cut at its source's
   limit and none elsewhere. Labels, short answers, list entries and sentences that only lack their mark are whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c
from .sentences import _LABEL, ABBREVIATIONS, CLOSERS, verb_ending

BUCKETS = 1 << 16
KINDS = {"word": 0, "entry": 1, "thai": 2, "part": 3}  # part: beginnings of the words of list entries

_BROKEN = re.compile(r"(?:\ufffd+|\\u[0-9a-fA-F]{0,3}|\\[a-zA-Z]*|&#?[a-zA-Z0-9]{0,6})\s*$")
_TAIL = re.compile(r"(?:\s|\ufffd|…|\.{2,}|\\u[0-9a-fA-F]{0,3}$|\\[a-zA-Z]?$|&#?[a-zA-Z0-9]{0,6}$|[​‌‍⁠\ufeff])+$")
_TAILS = frozenset(" \t\n\r\u00a0\u3000\ufffd….\u200b\u200c\u200d\u2060\ufeff")
_ELLIPSIS = re.compile(r"(?:…|\.{2,})\s*$")
_SENTENCE_MARK = re.compile(r"[.!?…。！？।॥]")
_BREAK = re.compile(r"[.!?…。।](?:\s?\^\^|~)?[\"”’」』)]*\s+")
_LATIN_WORDS = re.compile(r"[A-Za-z]{3},? [a-z]{2}")
_THAI = re.compile(r"[\u0e00-\u0e7f]{2,}(\s+(?=[\u0e00-\u0e7f])|\s*$)?")
_PARTICLE = re.compile(r"(?:[은는이가을를]|에서|에는|에도|에게|으로|까지|부터|보다|마다|처럼)[,…]?$")
_ANSWER = re.compile(r"(?:(?:최종|정)?\s?답(?:변)?\s*[:은]|####|answer\s*:)\s*(.*)$", re.I)
_OPTION = re.compile(r"\(?[A-Ja-e가나다라마①-⑩]\)?[.)]?$")
_EQUATION = re.compile(r"^[\d,.]+(?: ?[-+×*/÷] ?(?:[\d,.]+)?)+(?: ?=(?: ?[\d,.]*)?)?$")
_RESULT = re.compile(r"= ?([\d,.]+?)(?:입니다|이다|예요|이에요|\s|$)")
_NUMBER = re.compile(r"^(?:약 )?[-+]?[\d,.]+(?: ?[^\d\s은는을를에]{1,6}(?: 원)?)?$")


ENCODINGS = ("chars", "utf8", "utf16", "html", "html8", "json", "json8", "crlf", "crlf8")


def lengths(texts: list[str]) -> np.ndarray:
    """Length of each text under each encoding that a store may count in: texts x ENCODINGS."""
    every = c.points(texts)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
    starts = np.r_[0, ends[:-1]] if texts else ends

    def count(hits: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(hits)]
        return total[ends] - total[starts]

    beyond, astral = count(every > 0x7F), count(every > 0xFFFF)
    points, utf8 = ends - starts, ends - starts + beyond + count(every > 0x7FF) + astral
    low = np.where(every < 0x7F, every, 0).astype(np.uint8)
    lines, quotes = count(low == 10), count(low == 34)
    html = 4 * count(low == 38) + 3 * count((low == 60) | (low == 62)) + 5 * quotes
    escapes = quotes + count(low == 92) + lines + count((low == 9) | (low == 13))
    return np.stack([points, utf8, points + astral, points + html, utf8 + html, points + escapes + 5 * beyond + 6 * astral, utf8 + escapes, points + lines, utf8 + lines], 1)


def without_tail(text: str) -> str:
    """The text without what may follow a cut: white space, an ellipsis, broken characters and escapes."""
    if not text or not (text[-1] in _TAILS or "\\" in text[-6:] or "&" in text[-8:]):
        return text
    return _TAIL.sub("", text)


def _bucket(word: str) -> int:
    return xxhash.xxh32_intdigest(word) % BUCKETS


def _key(word: str) -> str:
    """What is counted of a word: its last two characters if Korean, itself otherwise."""
    return word[-2:] if "가" <= word[-1:] <= "힣" else word.lower()


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, source, key, a, b): counts of closing and other words by bucket, and of lengths by source and encoding."""
    closing = np.zeros((len(KINDS), BUCKETS, 2), np.int64)
    sizes: Counter = Counter()
    for batch in batches:
        texts, sources = batch.column("text").to_pylist(), batch.column("source").to_pylist()
        bare = [without_tail(t) for t in texts]
        if len(sizes) > 500_000:  # what is kept in memory is bounded
            yield _counted(np.zeros((0, 0, 0)), sizes)
            sizes.clear()
        latin, last, other, thai, within = (Counter() for _ in range(5))
        for source in set(sources) - {None}:
            own = lengths([t for t, s in zip(bare, sources) if s == source])
            for k, name in enumerate(ENCODINGS):
                for n, many in zip(*(x.tolist() for x in np.unique(own[:, k], return_counts=True))):
                    sizes[source, name, n] += many
        for form in c.canon_all(texts):
            lines = form.rstrip().split("\n")
            for k, line in enumerate(lines, 1):
                label, final = _LABEL.match(line), k == len(lines)  # the end of the text may be a cut: nothing is learned from it
                if label and not _SENTENCE_MARK.search(line, label.end()):
                    if not _ANSWER.match(line) and (parts := line[label.end() :].split()):
                        end = parts.pop()
                        last[end] += not final
                        other.update(parts)
                elif _LATIN_WORDS.search(line):
                    latin.update(line.split()[: -1 if final else None])
                elif _THAI.search(line):
                    for m in _THAI.finditer(line):
                        run = m.group().rstrip()
                        within.update(run[max(0, j - 4) : j] for j in range(2, len(run)))
                        thai[run[-4:]] += m.group(1) is not None and not (final and m.end() == len(line))
        _add(closing, latin, last, other, thai, within)
    yield _counted(closing, sizes)


def _add(closing: np.ndarray, latin: Counter, last: Counter, other: Counter, thai: Counter, within: Counter) -> None:
    """Words counted in one batch, to their buckets: closing ones at 0, others at 1."""
    for w, n in latin.items():
        if bare := w.strip(".,!?…" + CLOSERS + "“‘「"):
            closes = w.rstrip(CLOSERS)[-1:] in ".!?" and bare.lower() not in ABBREVIATIONS
            closing[KINDS["word"], _bucket(_key(bare)), 0 if closes else 1] += n
    for side, counted in ((0, last), (1, other)):
        for w, n in counted.items():
            closing[KINDS["entry"], _bucket(w), side] += n
            for k in range(1, len(w)):
                closing[KINDS["part"], _bucket(w[:k]), 1] += n
    for side, counted in ((0, thai), (1, within)):
        for w, n in counted.items():
            closing[KINDS["thai"], _bucket(w), side] += n


def _counted(closing: np.ndarray, sizes: Counter) -> pa.RecordBatch:
    names = list(KINDS)
    rows = [(names[k], "", str(b), *closing[k, b].tolist()) for k, b in np.argwhere(closing.any(2)).tolist()] if closing.size else []
    rows += [("len", s, f"{name} {n}", count, 0) for (s, name, n), count in sizes.items()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 5, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))], ["kind", "source", "key", "a", "b"])


def _last_sentence(line: str) -> str:
    """What stands after the last end of a sentence inside the line."""
    for m in reversed(list(_BREAK.finditer(line))):
        before = line[: m.start()].rsplit(None, 1)[-1] if m.start() else ""
        if m.group()[0] in ".…" and (before.lower() in ABBREVIATIONS or re.fullmatch(r"[\d.,]*|(?:[A-Za-z]\.)*[A-Za-z]", before)):
            continue
        if "가" <= before[-1:] <= "힣" and not verb_ending(before):
            continue
        if any(ch.isalnum() for ch in line[m.end() :]):
            return line[m.end() :]
    return line


class Endings:
    """Decides by its ending whether a text lost its end. closing: counts [kind, bucket, closing or not] over the corpus."""

    def __init__(self, closing: np.ndarray):
        self.closing = closing

    def _closes(self, kind: str, word: str, share: float) -> bool | None:
        """Whether it closes at least this share of its own occurrences; None if it never occurred."""
        yes, no = self.closing[KINDS[kind], _bucket(word)].tolist()
        return yes >= share * (yes + no) if yes + no else None

    def _closes_entry(self, word: str, at_limit: bool) -> bool:
        closes = self._closes("entry", word, 0.9 if at_limit else 0.5)
        return not at_limit and self._closes("part", word, 0.5) is None if closes is None else closes

    def cut(self, text: str | None, at_limit: bool = False) -> bool:
        """True if the text stops within a word or a sentence. Null, blank and letterless texts, labels and short answers are whole."""
        if not text or not (bare := text.strip()):
            return False
        line = bare[bare.rfind("\n") + 1 :]
        if bare[-1] in ".!" and bare[-2:-1] in "다요" and verb_ending(bare[-6:-1]) >= 2 and not any(ch in line for ch in "“\"‘「『"):
            return False  # the common case: a Korean sentence with its mark
        if _BROKEN.search(bare[-12:]) and bare[-1] != "}":
            return any(ch.isalnum() for ch in bare)
        alone = len(line) == len(bare)
        bare, line = c.canon(bare) if alone else bare, c.canon(line).strip()
        body, whole = _ELLIPSIS.sub("", bare).rstrip(), _ELLIPSIS.sub("", line).rstrip()
        marked = whole != line
        if not any(ch.isalnum() for ch in whole):
            return not alone and bool(whole) and any(ch.isalnum() for ch in body)
        if body[0] in "{[" and not _LABEL.match(body):
            return body.count("{") != body.count("}") or body.count("[") != body.count("]") or body.count('"') % 2 == 1
        line = whole if _OPTION.fullmatch(whole) or _ANSWER.match(whole) else _last_sentence(whole)
        alone = alone and len(line) == len(whole)
        value = _ANSWER.match(line)
        if _OPTION.fullmatch(line) or (value and _OPTION.fullmatch(value.group(1).strip())):
            return False
        label = _LABEL.match(line)
        rest = line[label.end() :] if label else line
        if not any(ch.isalnum() for ch in rest):
            return not alone  # a label without what it should label
        boxed = re.search(r"\\boxed\{([^}]*)(\}?)$", line)
        if boxed and not boxed.group(2):
            return True
        number = boxed.group(1) if boxed else (value.group(1).strip() if value else None)
        if number is not None and re.fullmatch(r"[\d,.]+", number):
            result = _RESULT.findall(body)
            return bool(result) and result[-1] != number and result[-1].startswith(number)
        if boxed:
            return False
        if "\\" in line and re.search(r"\\[a-zA-Z]*$|\{[^}]*$", line):
            return True
        if _EQUATION.match(rest):
            return not (_NUMBER.match(rest) and not re.search(r"[-+×*/÷=]", rest))
        return self._sentence(body, rest, bool(label), value is not None, alone, marked, at_limit)

    def _sentence(self, body: str, rest: str, label: bool, answer: bool, alone: bool, marked: bool, at_limit: bool) -> bool:
        words = rest.split()
        last = words[-1]
        stem = last.rstrip(CLOSERS)
        final = bool(stem) and stem[-1] in ".!?。।॥~" and not marked
        open_quote = rest.count('"') % 2 or any(rest.count(o) > rest.count(x) for o, x in ("“”", "「」", "『』", "()"))
        if final or (re.search(r"\^[_\-.]?\^$", last) and not marked):
            word = stem.rstrip(".!?。।॥~").lstrip("\"'“‘「『([{")
            if open_quote:
                return True
            if stem != last and last[-1] in "\"'”’」』":  # a quotation that its verb should follow
                opener = {"”": "“", "’": "‘", "」": "「", "』": "『"}.get(last[-1], last[-1])
                return not body.startswith(opener) and not answer
            if stem[-1] == ".":
                low = word.lower()
                if low in ABBREVIATIONS or re.fullmatch(r"(?:[a-z]\.)*[a-z]", low) and not answer and len(words) > 2:
                    return True
                if re.fullmatch(r"[\d.,]+", word) and not answer:
                    return len(words) > 2 or label
            if re.fullmatch(".*[가-힣]", word) and not verb_ending(word) and len(words) > 3 and not answer:
                return any(_PARTICLE.search(w) for w in words[:-1]) and not re.search("[음함됨임]$", word)
            return False
        if open_quote:
            return True
        if "가" <= stem[-1:] <= "힣":
            if verb_ending(stem) >= 1:
                return False  # a sentence that only lacks its mark
            sentence = any(_PARTICLE.search(w) for w in words[:-1] if len(w) > 1)
            short = len(words) <= 3 and len(rest) <= 24 and not (marked and sentence) or bool(_NUMBER.match(rest))
            if label and not answer:
                return sentence or not (self._closes_entry(stem, at_limit) or re.search("[음함됨임]$", stem))
            if answer or alone:
                return (not short and (sentence or len(words) > 4)) or at_limit
            return True
        if re.search(r"[฀-๿]", stem[-1:]):
            run = re.search(r"[฀-๿]+$", stem).group()[-4:]
            closes = self._closes("thai", run, 0.9 if at_limit else 0.5)
            return at_limit if closes is None else not closes
        if re.search(r"[぀-ヿ一-鿿ऀ-ॿ]", stem[-1:]):
            return not (alone and len(rest) <= 6)
        short = len(words) <= 3 and len(rest) <= 24 or bool(_NUMBER.match(rest))
        if (answer or alone) and short:
            return at_limit
        if label and not answer and self._closes_entry(stem, at_limit) and not any(_PARTICLE.search(w) for w in words[:-1]):
            return False
        word = _key(stem)
        if re.search("[가-힣]", rest) and not re.search("[a-z]{2,} [a-z]{2,}", rest):
            return True
        return not self._closes("word", word, 0.9 if at_limit else 0.4)


def learned(texts: DataFrame) -> tuple[np.ndarray, DataFrame]:
    """The counts of closing words, and (source, encoding, most): the storage limits that the lengths show."""
    counts = c.cut(texts.mapInArrow(_learn, "kind string, source string, key string, a bigint, b bigint").groupBy("kind", "source", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    closing = np.zeros((len(KINDS), BUCKETS, 2), np.int64)
    for kind, key, a, b in counts.where("kind <> 'len'").select("kind", "key", "a", "b").collect():  # at most 4 x BUCKETS rows
        closing[KINDS[kind], int(key)] = a, b
    size = counts.where("kind = 'len'").select("source", F.split("key", " ")[0].alias("encoding"), F.split("key", " ")[1].cast("int").alias("n"), F.col("a").alias("rows"))
    by = Window.partitionBy("source", "encoding").orderBy("n")
    here, before, beyond = (F.coalesce(F.sum("rows").over(by.rangeBetween(a, b)), F.lit(0)) for a, b in ((-2, 0), (-42, -3), (1, Window.unboundedFollowing)))
    piled = size.select("source", "encoding", F.col("n").alias("most"), here.alias("here"), before.alias("before"), beyond.alias("beyond"))
    piled = piled.where("here >= 5 and here >= 0.3 * before + 1 and beyond <= here")
    first = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("here"), F.array_position(F.array(*map(F.lit, ENCODINGS)), F.col("encoding")), F.desc("most")))
    return closing, c.cut(piled.withColumn("first", first).where("first = 1").select("source", "encoding", "most"))


def truncated(df: DataFrame, *, small: int = 20_000) -> DataFrame:
    """(src, rec_id, source, truncated) of each non-null text of (src, rec_id, text, source).

    Null texts give no rows, empty and blank ones are whole; a null source has no limit; several texts of a rec_id give
    several rows; other columns are ignored. The limits are broadcast up to ``small`` rows and joined beyond.
    """
    texts = df.where("text is not null").select("src", F.col("rec_id").cast("bigint").alias("rec_id"), "text", "source")
    closing, limits = learned(texts.distinct())  # each delivery once
    shared = df.sparkSession.sparkContext.broadcast(closing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings(shared.value)
        for batch in batches:
            texts, encodings, most = (batch.column(k).to_pylist() for k in ("text", "encoding", "most"))
            hit = [False] * len(texts)
            if known := [k for k, x in enumerate(encodings) if x is not None]:
                n = lengths([without_tail(texts[k]) for k in known])
                for k, own in zip(known, n.tolist()):
                    hit[k] = most[k] - 3 < own[ENCODINGS.index(encodings[k])] <= most[k]
            out = [endings.cut(t, h) for t, h in zip(texts, hit)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("src", "rec_id", "source")), pa.array(out, pa.bool_())], ["src", "rec_id", "source", "truncated"])

    side = F.broadcast(limits) if limits.count() <= small else limits
    return texts.join(side, "source", "left").mapInArrow(run, "src string, rec_id bigint, source string, truncated boolean")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(c.outputs_and_answers(spark, sf_dir)).where("truncated").select("src", "rec_id").distinct()


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, source, records, truncated, rate): how often each source truncates, each id once."""
    tables = [c.table(spark, sf_dir, n).select(F.lit(n).alias("src"), F.col(k).cast("bigint").alias("rec_id"), "source") for n, k in (("predictions", "pred_id"), ("chats", "chat_id"))]
    ids = tables[0].unionByName(tables[1]).dropDuplicates(["src", "rec_id"])  # records without a text count too
    ids = ids.join(p5_found(spark, sf_dir).withColumn("t", F.lit(True)), ["src", "rec_id"], "left")
    return ids.groupBy("src", "source").agg(F.count("*").alias("records"), F.count_if("t").alias("truncated")).withColumn("rate", F.round(F.col("truncated") / F.col("records"), 6))
