"""Sentence boundaries across languages and scripts, by semi-Markov dynamic programming.

A line break always ends a sentence; within a line every place that could end one is a candidate (after a final mark with its
closing quotes, brackets and emoticons; after a Korean final verb ending without a mark; at a space between Thai
letters). The best segmentation of a line maximises the sum of the scores of its whole spans: how the span closes,
how it opens, its length, and whether its quotations and brackets are balanced. Labels, abbreviations, numbers, dates
and quoted speech that goes on lose by these scores, not by exceptions. Texts are read in one form, positions are those
of the stored string.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

# Words, marks and endings that the scores know.
ABBREVIATIONS = frozenset(
    "dr prof mr mrs ms st sr jr no nos vs e.g i.e eg ie cf etc approx fig figs eq vol pp ed est dept gov gen sen rep inc ltd co corp al "
    "a.m p.m jan feb mar apr jun jul aug sep sept oct nov dec mt ft min max ave blvd".split()
)
CONNECTIVES = (
    "그러나 그리고 그래서 그런데 그러므로 그러면 따라서 또한 한편 반면 다만 특히 결국 우선 먼저 실제로 당시 나아가 더구나 이에 이 그 즉 하지만 "
    "처음에는 마지막으로 결론적으로 예를 다음으로 However Therefore Moreover The In At Because Nobody Several Dr But And"
).split()
QUOTING = ("라고", "이라고", "라며", "이라며", "라는", "이라는", "라면서", "하고", "하며", "라 ", "고 ", "하더", "해도")
FINAL_MARKS = ".!?…。।॥؟"
CLOSERS = "\"'”’」』)]}»›》〉】〕"
PAIRS = (("“", "”"), ("‘", "’"), ("「", "」"), ("『", "』"), ("(", ")"), ("[", "]"), ("《", "》"), ("〈", "〉"), ("【", "】"), ("«", "»"))

_MARKS = re.compile(f"[{re.escape(FINAL_MARKS)}]+")
_EMOTICON = re.compile(r"(?:\s?(?:\^[_\-.]?\^;*|[:;=]-?[)(DP]+(?!\w)|ㅋ+|ㅎ+|[ㅠㅜ]+|T_T|[♡♥☀-➿\U0001F300-\U0001FAFF]+)|~+)+")
_LABEL = re.compile(r"\s*(?:[-*·•—–▪○●]|\(?\d{1,3}[.)](?!\d)|\[\d{1,3}\]|\(?[A-Za-z가-힣①-⑳][.)](?=\s|$)|[①-⑳]|(?:단계|step)\s*\d+\s*[:.)]|#+|(?:정답|답|최종답|질문|문제|풀이|해설|답변|사용자|도우미|english|korean|한국어|영어|answer|question|q|a)\s*[:.])\s*", re.I)
_DATE = re.compile(r"\d+\.\s*\d+\.$|\d{4}\.$")
_THAI_SPACE = re.compile(r"(?<=[฀-๿])\s+(?=\S)")
_WORD_END = re.compile(r"\S+")
_CLUSTER = re.compile(r"[ᄀ-ᅟ][ᅠ-ᆧ][ᆨ-ᇿ]?|[^\W\d_][̀-ͯ]+")


_BREAKS = re.compile(r"\s+|[。！？।॥]+")
_FIRST_WORD = re.compile(r"\s*([^\s。！？।॥]*)")
_WAVES = re.compile("~*")
_ALNUM = re.compile(r"[^\W_]")
_OPEN_OR_CLOSE = re.compile("[" + re.escape("".join(a + b for a, b in PAIRS)) + '"]')
_OPEN_OF, _CLOSE_OF = ({pair[side]: k for k, pair in enumerate(PAIRS)} for side in (0, 1))
VERB_ENDS = tuple("다까요오죠")  # every ending that verb_ending knows closes with one of these


def _batchim(ch: str) -> int:
    """Index of a Hangul syllable's final consonant; -1 for other characters."""
    return (ord(ch) - 0xAC00) % 28 if "가" <= ch <= "힣" else -1


def verb_ending(word: str) -> float:
    """How surely a Korean word is a final verb form: 0 no, 1 maybe, 2 likely, 3 surely."""
    if len(word) < 2:
        return 0
    last, two = word[-1], word[-2:]
    if last in "다까":
        if two in ("니다", "니까") and len(word) > 2 and _batchim(word[-3]) == 17:
            return 3
        if last == "다" and _batchim(word[-2]) == 20:
            return 2.5
        if last == "다" and (two in ("한다", "된다", "이다", "있다", "없다", "같다") or word.endswith("아니다")):
            return 1.5 if len(word) > 2 or two in ("있다", "없다") else 0
        if last == "까" and (two in ("을까", "일까", "는가", "할까", "될까")):
            return 2
        if two == "시다" and len(word) > 2 and _batchim(word[-3]) == 17:
            return 2.5
        return 0
    if last == "요" and word[-2] in "어아해예에돼세네데져여워와봐까죠지려게군나줘래":
        return 2.5
    if two in ("시오", "세요") or last == "죠":
        return 2.5
    return 0


def aligned(text: str) -> tuple[str, list[int] | None]:
    """The text in one form and, for each of its characters, the end of what it stands for in the stored text (None: the same places)."""
    if not c.unusual().search(text):
        return text, None
    table = c.fold_table()
    chars, ends = [], []
    for k, ch in enumerate(text):
        looks = table.get(ord(ch), ch)
        if looks is None:
            continue
        chars.append(looks)
        ends += [k + 1] * len(looks)
    plain = "".join(chars)
    out, at, places = [], 0, []
    for m in _CLUSTER.finditer(plain):
        out.append(plain[at : m.start()])
        places += ends[at : m.start()]
        joined = unicodedata.normalize("NFC", m.group())
        out.append(joined)
        places += [ends[m.end() - 1]] * len(joined)
        at = m.end()
    out.append(plain[at:])
    return "".join(out), places + ends[at:]


def _first_word(s: str, at: int) -> str:
    return _FIRST_WORD.match(s, at).group(1)


def _mark_score(s: str, word: int, begin: int, stop: int, after: int, quote: bool) -> float:
    """How likely the mark s[begin:stop], behind a word from ``word`` on and closed up to ``after``, ends a sentence."""
    mark = s[begin:stop]
    before = s[word:begin]
    bare = before.lstrip("\"'“‘「『([{")
    following = _first_word(s, after)
    head = following.lstrip("\"'“‘「『([{")[:1]
    tight = after < len(s) and not s[after].isspace()
    hangul = "가" <= bare[-1:] <= "힣"
    if quote and (tight and (s[after].isalnum()) or head.islower() or following.startswith(QUOTING)):
        return -8
    if not bare and not quote:
        return -4
    if "…" in mark or len(mark) > 1 and set(mark) == {"."}:
        if hangul:
            return 3 if verb_ending(bare) else -4
        if bare.isascii() and bare.isupper() and len(bare) > 1 and head.isupper() and following[:2].isupper():
            return -3
        return -5 if head.islower() else (2 if head.isupper() or not head.isascii() else -3)
    if mark == ".":
        low = bare.lower()
        if low in ABBREVIATIONS or re.fullmatch(r"(?:[a-z]\.)*[a-z]", low):
            return -6
        if re.fullmatch(r"[\d.,]+", bare):
            if _LABEL.fullmatch(s[:stop]) or _DATE.search(s[max(0, begin - 14) : stop]) or head.isdigit() or "가" <= head <= "힣":
                return -6
            return 1 if head.isupper() and not tight and not re.search("[가-힣]", following) else -5
        if tight:
            return 1 if hangul and verb_ending(bare) else -5
        if head.islower() and head.isascii():
            return -3
        return 3
    if mark[0] in "!?" and head.islower() and head.isascii():
        return -3
    if tight and s[after] in ",;:、，":
        return -6
    return 4 if mark[0] in "。।॥" else 3


def candidates(s: str) -> dict[int, float]:
    """Places inside a line that could end a sentence, each with the score of closing there."""
    found: dict[int, float] = {}
    n, word, seen = len(s), 0, 0
    quotes = {ch: [m.start() for m in re.finditer(ch, s)] for ch in "\"'" if ch in s}
    for m in _MARKS.finditer(s):
        i, j = m.span()
        for b in _BREAKS.finditer(s, seen, i):  # the word before the mark begins behind the last space or full stop of a script without spaces
            word = b.end()
        seen = i
        if m.group() == "." and i and j < n and s[j].isalnum() and s[i - 1].isalnum() and (s[j].isascii() or s[i - 1].isdigit()):
            continue
        k, quote = j, False
        while k < n and s[k] in CLOSERS:
            if s[k] in "\"'" and bisect_left(quotes[s[k]], k) % 2 == 0:
                break
            quote |= s[k] in "\"'”’」』"
            k += 1
        if e := _EMOTICON.match(s, k):
            k = e.end()
        if k < n:
            found[k] = max(found.get(k, -9.0), _mark_score(s, word, i, j, k, quote))
    for m in _WORD_END.finditer(s):
        if m.end() == n:
            break
        word = m.group().rstrip("~")
        closed = word.rstrip("\"'”’」』)")
        if closed[-1:] not in VERB_ENDS or not (sure := verb_ending(closed)):
            continue
        e = _EMOTICON.match(s, m.end()) or (_WAVES.match(s, m.end() - len(m.group()) + len(word)) if m.group() != word else None)
        k = e.end() if e else m.end()
        if k >= n or k in found:
            continue
        following = _first_word(s, k)
        if following.startswith(QUOTING) or word[-1] in "\"'”’」』":
            found[k] = -6.0
        elif e or sure >= 2:
            found[k] = 3.0 if e else sure
        else:
            found[k] = 1.5 if following.rstrip(",") in CONNECTIVES else -1.0
    for m in _THAI_SPACE.finditer(s):
        nxt = s[m.end()]
        found[m.start()] = max(found.get(m.start(), -9.0), 3.0 if "ก" <= nxt <= "ๅ" or "가" <= nxt <= "힣" or nxt in "“‘\"" else -1.0)
    return found


def _balances(s: str, places: list[int]) -> list[tuple[int, ...]]:
    """For each of the ascending places, how many quotations and brackets of each kind are open before it."""
    depth = [0] * (len(PAIRS) + 1)
    now, out, at = tuple(depth), [], 0
    for m in _OPEN_OR_CLOSE.finditer(s):
        k, ch = m.start(), m.group()
        while at < len(places) and places[at] <= k:
            out.append(now)
            at += 1
        if ch in _OPEN_OF:
            depth[_OPEN_OF[ch]] += 1
        elif ch == '"':
            depth[-1] ^= 1
        else:
            apostrophe = ch == "’" and 0 < k < len(s) - 1 and s[k - 1].isascii() and s[k - 1].isalpha() and s[k + 1].isalpha()
            label = ch in ")]" and depth[_CLOSE_OF[ch]] <= 0
            if not apostrophe and not label:
                depth[_CLOSE_OF[ch]] -= 1
        now = tuple(depth)
    return out + [now] * (len(places) - at)


MOST = 1.0  # of a span's score: a connective or label before, a verb ending behind


def _span_score(s: str, i: int, j: int, opened: tuple[int, ...], closed: tuple[int, ...], first: bool) -> float:
    span = s[i:j].strip()
    letters = sum(1 for _ in islice(_ALNUM.finditer(span), 4))
    if not letters:
        return -6.0
    score = -5.0 * sum(a != b for a, b in zip(opened, closed)) if opened != closed else 0.0
    if _LABEL.fullmatch(span):
        return score - 8.0
    score += 0.0 if letters > 3 else -1.0
    score -= 0.002 * max(0, len(span) - 300)
    opening = span.split(None, 1)[0]
    if opening.rstrip(",") in CONNECTIVES or _LABEL.match(span):
        score += 0.5
    if not first and (opening[0].islower() or opening.startswith(QUOTING)):
        score -= 1.5
    if verb_ending(span.rstrip(FINAL_MARKS + CLOSERS + "~^ ")[-6:]):
        score += 0.5
    return score


def segment(line: str) -> list[int]:
    """Ends of the sentences of one line (in one form). Looks back until no earlier begin can score higher: a span scores MOST at most."""
    found = candidates(line)
    if not found:
        return [len(line)]
    places = [0, *sorted(found), len(line)]
    depth = _balances(line, places)
    best, back, highest = [0.0], [0], [0.0]
    for j in range(1, len(places)):
        close = found.get(places[j], 0.0)
        top, at = float("-inf"), j - 1
        for i in range(j - 1, -1, -1):
            if highest[i] + MOST < top:
                break
            x = best[i] + _span_score(line, places[i], places[j], depth[i], depth[j], i == 0)
            if x > top:
                top, at = x, i
        best.append(top + close)
        highest.append(max(highest[-1], best[-1]))
        back.append(at)
    ends, j = [], len(places) - 1
    while j:
        ends.append(places[j])
        j = back[j]
    return ends[::-1]


def sentence_ends(text: str | None) -> list[int]:
    """Position after the last character of each sentence of a text; none for a null or blank text."""
    if not text:
        return []
    plain, places = aligned(text)
    out, start = [], 0
    for line in re.split(r"[\n\r\x0b\x0c\x1c-\x1e\x85  ]", plain):
        low = 0
        if line.strip():
            for high in segment(line):
                piece = line[low:high].rstrip()
                if any(ch.isalnum() for ch in piece):
                    last = start + low + len(piece)
                    out.append(last if places is None else places[last - 1])
                low = high
        start += len(line) + 1
    return out


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        src, rec, end = [], [], []
        for s, r, text in zip(*(batch.column(k).to_pylist() for k in ("src", "rec_id", "text"))):
            for e in sentence_ends(text):
                src.append(s)
                rec.append(r)
                end.append(e)
        yield pa.RecordBatch.from_arrays([pa.array(src, pa.string()), pa.array(rec, pa.int64()), pa.array(end, pa.int64())], ["src", "rec_id", "sent_end"])


def sentences(df: DataFrame) -> DataFrame:
    """(src, rec_id, sent_end): the end of each sentence of (src, rec_id, text), in code points of the stored text.

    Null, empty and blank texts give no rows; repeated rows give their sentences again; other columns are ignored.
    """
    return df.select("src", F.col("rec_id").cast("bigint").alias("rec_id"), "text").mapInArrow(_run, "src string, rec_id bigint, sent_end bigint")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences(c.paragraphs_and_answers(spark, sf_dir, "exemplars_reasoned_qa_hapsyo", "풀이와 답"))
