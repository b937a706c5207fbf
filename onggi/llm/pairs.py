"""Broken prompt and response pairs: ordered rules that name every defect of an answer.

Rules in their order: ``empty`` (missing, null, blank, a placeholder or a label only), ``copy`` (the question again, but for
labels, marks and spacing, or the question once more), ``refusal`` (every sentence declines, apologises or takes leave, and one declines),
``language`` (mostly in another language than the question, which didn't ask for it), ``truncated`` (as the truncation
operator decides, with its corpus counts). Every rule that fires is emitted by ``defects``; the query keeps the first.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .sentences import sentence_ends
from .truncation import ENCODINGS, Endings, learned, lengths, without_tail

ORDER = ("empty", "copy", "refusal", "language", "truncated")

# What stands for no answer, labels, and how answers decline, apologise and take leave.
PLACEHOLDERS = frozenset(
    "없음 답변없음 내용없음 응답없음 해당없음 정답없음 미정 미작성 미입력 공란 빈칸 비어있음 생략 null none nil na nan undefined tbd todo empty blank noanswer noresponse notavailable "
    "无 無 なし 回答なし ไม่มี".split()
)
LABELS = "최종답 정답 답변 응답 대답 답 질문 문제 물음 해설 풀이 설명 결론 사용자 도우미 비서 assistant user answer response question prompt output reply solution a q 回答 答え 答案 質問 问题 คำตอบ คำถาม".split()
DECLINING = (
    r"답변?(?:드릴|을 드릴|해 드릴|할) ?수(?:는|가)? ?없",
    r"(?:답|답변|설명|정보|안내)(?:은|는|을|를)? ?(?:드리지|제공하지|하지) ?(?:않|못)",
    r"대답할 ?수(?:는|가)? ?없",
    r"답변은? ?(?:곤란|어렵|불가|거절)",
    r"답하지 ?(?:않|못)",
    r"답할 ?수(?:는|가)? ?없",
    r"도와 ?드(?:리기|릴 ?수|리지) ?(?:어렵|힘들|없|않|못|는 ?어렵)",
    r"도움을? ?드(?:리기|릴 ?수) ?(?:어렵|없)",
    r"다룰 ?수(?:는|가)? ?없는 ?(?:주제|내용|질문|요청)",
    r"(?:권한|허가)이? ?없",
    r"허용되지 ?않",
    r"말씀드(?:릴|리기) ?(?:수 ?없|어렵|곤란)",
    r"(?:알려|설명해|제공해) ?드릴 ?수(?:는|가)? ?없",
    r"제공(?:할|해 드릴) ?수(?:는|가)? ?없",
    r"응(?:할|하기) ?(?:수 ?없|어렵)",
    r"\b(?:can(?:'|’)?t|cannot|can not|could not|couldn(?:'|’)t|won(?:'|’)t|will not|unable to|not able to|decline to|refuse to|not (?:allowed|permitted) to|(?:do(?:es)? not|don(?:'|’)t) allow me|prevents? me)\b.{0,30}?\b(?:answer|help|assist|provid|discuss|comment|respond|reply|share|tell|talk|speak|explain|giv|say|address|advis|support|disclos|reveal|fulfil|comply|engag|describ|offer|do (?:that|this|so)|continu|go into)",
    r"(?:お答え|回答|お手伝い|お応え)(?:することは)?(?:でき|いたしかね|致しかね)|できません|対応でき",
    r"(?:无法|不能|無法|拒绝|拒絕|不便)(?:回答|提供|协助|協助|讨论|討論|帮助|评论|满足)",
    r"ไม่สามารถ(?:ตอบ|ให้|ช่วย)",
    r"(?:उत्तर|जवाब|मदद|सहायता|जानकारी).{0,12}(?:नहीं)",
)
COURTESY = (
    r"죄송|미안|유감|안타깝|양해|송구|전문가|문의|다른 ?질문|다른 ?주제|감사합니다|이해해 ?주|참고해 ?주|너그",
    r"\b(?:sorry|apologi[sz]e|apologies|unfortunately|regret|thank you|thanks|please ask|please consult|please contact|something else|another question|understanding)\b",
    r"申し訳|ご了承|すみません|ご理解|別の質問|抱歉|对不起|對不起|很遗憾|谅解|其他问题|ขออภัย|ขอโทษ|क्षमा|खेद|माफ़",
)
# One of these stands in every text that declines in one of these ways.
SIGNS = "없 않 못 곤란 어렵 불가 거절 힘들 n't n’t cant not unable decline refuse prevent でき かね 无法 不能 無法 拒绝 拒絕 不便 ไม่สามารถ नहीं".split()
# How a question asks for a language.
ASKED = {
    "ko": r"한국어|한글|국문|korean|韓国語|韩语|韩文|朝鲜语",
    "en": r"영어|영문|english|英語|英语|英文",
    "ja": r"일본어|일어|japanese|日本語|日语|日文",
    "zh": r"중국어|중문|chinese|中国語|中文|汉语",
    "hi": r"힌디|hindi|हिन्दी|हिंदी|ヒンディー|印地语",
    "th": r"태국어|타이어|thai|ไทย|タイ語|泰语",
    "cyrillic": r"러시아어|노어|russian|ロシア語|俄语|русск",
    "greek": r"그리스어|희랍어|greek|ギリシャ語|希腊语",
    "arabic": r"아랍어|arabic|アラビア語|阿拉伯语|عرب",
    "hebrew": r"히브리어|hebrew|ヘブライ語|希伯来语",
}
TRANSLATING = re.compile(r"번역|통역|옮겨|translat|翻訳|翻译|翻譯", re.I)

_LABEL = re.compile(r"^[\s\"'“‘「『(\[*#>-]*(?:" + "|".join(map(re.escape, LABELS)) + r")\s*[:：)\].-]\s*", re.I)
_LABELS_ONLY = frozenset(c.letters(x) for x in LABELS)
_DECLINE = re.compile("|".join(DECLINING), re.I)
_COURTEOUS = re.compile("|".join(COURTESY), re.I)
_ASKED = {k: re.compile(x, re.I) for k, x in ASKED.items()}
_CLASSES = ("", "ko", "kana", "han", "th", "hi", "en", "cyrillic", "greek", "arabic", "hebrew")
_CODES = tuple({"kana": "ja", "han": "zh"}.get(x, x) for x in _CLASSES)
# First words of the Unicode names of letters, by the language or script they count for.
_NAMED = {"HANGUL": 1, "HIRAGANA": 2, "KATAKANA": 2, "CJK": 3, "THAI": 4, "DEVANAGARI": 5, "LATIN": 6, "CYRILLIC": 7, "GREEK": 8, "ARABIC": 9, "HEBREW": 10}
_WIDE = ("FULLWIDTH", "HALFWIDTH")


@lru_cache(1)
def _class_of() -> np.ndarray:
    """The class of each code point of the two lowest planes and of compatible ideographs, by its name."""
    out = np.zeros(0x110000, np.uint8)
    for point in (*range(0x20000), *range(0x2F800, 0x2FA20)):
        ch = chr(point)
        if ch.isalpha() or unicodedata.category(ch) in ("Mc", "Mn"):
            words = unicodedata.name(ch, "").split()
            if words and words[0] in _WIDE:
                words = words[1:]
            out[point] = _NAMED.get(words[0], 0) if words else 0
    out[0x20000:0x2F800] = 3
    return out


def languages(texts: list[str], least: int = 12) -> list[str | None]:
    """The language or script in which most of each text is written: a word of an alphabet counts as much as two other letters. None: too little text.

    Letters are classed as they are stored; in a word with Latin letters look-alikes of other alphabets count as Latin.
    """
    if not texts:
        return []
    k = len(_CLASSES)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    kinds = _class_of()[c.points(texts)].astype(np.int64)
    n = np.bincount(owner * k + kinds, minlength=len(texts) * k).reshape(-1, k)
    if (mixed := np.flatnonzero((n[:, 7:].sum(1) > 0) & (n[:, 6] > 0))).size:
        texts = list(texts)
        for i in mixed.tolist():
            texts[i] = "".join(c.canon(w) if any(_class_of()[ord(ch)] == 6 for ch in w) else w for w in re.split(r"(\s+)", texts[i]))
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        kinds = _class_of()[c.points(texts)].astype(np.int64)
        n = np.bincount(owner * k + kinds, minlength=len(texts) * k).reshape(-1, k)
    same = np.r_[False, (kinds[1:] == kinds[:-1]) & (owner[1:] == owner[:-1]), False]
    words = np.flatnonzero((kinds >= 6) & same[1:] & ~same[:-1])  # where a word of two letters or more begins
    n[:, 0] = 0
    n[:, 6:] = 2 * np.bincount(owner[words] * k + kinds[words], minlength=len(texts) * k).reshape(-1, k)[:, 6:]
    kana = n[:, 2] > 0
    n[kana, 2], n[kana, 3] = n[kana, 2] + n[kana, 3], 0
    top, total = n.argmax(1), n.sum(1)
    sure = (total >= least) & (n.max(1) * 2 > total)
    return [_CODES[t] if s else None for t, s in zip(top.tolist(), sure.tolist())]


def language(text: str, least: int = 12) -> str | None:
    return languages([text], least)[0]


def _unlabelled(form: str) -> str:
    """A text in one form behind its labels."""
    while m := _LABEL.match(form):
        form = form[m.end() :]
    return form


def _bare(form: str, plain: str | None = None) -> str:
    """Letters behind the labels; ``plain``: the letters of the whole."""
    rest = _unlabelled(form)
    return plain if plain is not None and rest is form else c.letters_of(rest)


def is_empty(answer: str | None) -> bool:
    return answer is None or _is_empty(form := c.canon(answer), c.letters_of(form))


def _is_empty(form: str, plain: str) -> bool:
    if not plain or plain in PLACEHOLDERS or plain in _LABELS_ONLY:
        return True
    bare = _bare(form + " ", "-")
    return not bare or bare in PLACEHOLDERS


def is_copy(question: str | None, answer: str) -> bool:
    return bool(question) and _is_copy(form := c.canon(question), c.letters_of(form), own := c.canon(answer), c.letters_of(own))


def _is_copy(asked: str, asked_plain: str, said: str, said_plain: str) -> bool:
    """Whether the answer, behind its labels, begins with the question and goes on with nothing but labels or the question again."""
    if not asked_plain or len(said_plain) < len(bare := _bare(asked, asked_plain)):
        return False
    own = _bare(said, said_plain)
    for prefix in (asked_plain, bare):
        if prefix and own.startswith(prefix):
            rest = own[len(prefix) :]
            return not rest or rest in _LABELS_ONLY or not rest.replace(prefix, "")
    return False


def is_refusal(answer: str) -> bool:
    return _is_refusal(c.canon(answer))


def _is_refusal(form: str) -> bool:
    """Whether every sentence declines, apologises or takes leave, and one declines; of any length."""
    if not any(x in form for x in SIGNS) or not _DECLINE.search(form):
        return False
    low, declined = 0, False
    for high in sentence_ends(form):
        part = form[low:high]
        low = high
        if _DECLINE.search(part):
            declined = True
        elif not _COURTEOUS.search(part):
            return False
    return declined


def other_language(question: str | None, answer: str) -> bool:
    return bool(question) and _other_language(c.canon(question), language(question, 4), language(answer))


def _other_language(form: str, asked: str | None, said: str | None) -> bool:
    if said is None or asked is None or asked == said:
        return False
    return not ((said in _ASKED and _ASKED[said].search(form)) or (TRANSLATING.search(form) and not any(p.search(form) for p in _ASKED.values())))


def defects(question: str | None, answer: str | None, endings: Endings, at_limit: bool = False) -> list[str]:
    """Every defect of an answer, in the order of the rules."""
    return all_defects([question], [answer], endings, [at_limit])[0]


def all_defects(questions: list[str | None], answers: list[str | None], endings: Endings, at_limit: list[bool]) -> list[list[str]]:
    asked, said = [q or "" for q in questions], [a or "" for a in answers]
    spoken = zip(languages(asked, 4), languages(said))
    asked, said = c.canon_all(asked), c.canon_all(said)
    out = []
    for q, a, ql, al, (qs, as_), answer, limit in zip(asked, said, c.letters_all(asked), c.letters_all(said), spoken, answers, at_limit):
        if _is_empty(a, al):
            out.append(["empty"])
            continue
        found = (("copy", bool(q) and _is_copy(q, ql, a, al)), ("refusal", _is_refusal(a)), ("language", bool(q) and _other_language(q, qs, as_)), ("truncated", endings.cut(answer, limit)))
        out.append([k for k, hit in found if hit])
    return out


def turn_defects(chats: DataFrame, *, small: int = 20_000) -> DataFrame:
    """(chat_id, turn, defects) of each answer of (chat_id, messages, source) with a defect; defects is an array in the rules' order.

    A turn is a user message and the assistant message after it; a final question without an answer counts as a missing
    one. Null and empty messages have no turns, a null question is no copy and has no language; repeated rows give
    their turns again; other columns are ignored.
    """
    said = c.once(chats.select("chat_id", "source", "messages"), "chat_id").select("source", F.explode(F.expr("transform(filter(messages, m -> m.role = 'assistant'), m -> m.content)")).alias("text")).where("text is not null")
    closing, limits = learned(said)
    turns = F.explode(
        F.expr(
            "filter(transform(messages, (m, i) -> struct(i + 1 as turn, m.role as role, m.content as question, get(messages, i + 1).role as next, get(messages, i + 1).content as answer, i + 1 = size(messages) as final)),"
            " t -> t.role = 'user' and (t.next = 'assistant' or t.final))"
        )
    )
    flat = chats.select(F.col("chat_id").cast("bigint").alias("chat_id"), "source", turns.alias("t")).select("chat_id", "source", F.col("t.turn").cast("bigint").alias("turn"), "t.question", "t.answer")
    shared = chats.sparkSession.sparkContext.broadcast(closing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings(shared.value)
        for batch in batches:
            chat, turn, question, answer, encoding, most = (batch.column(k).to_pylist() for k in ("chat_id", "turn", "question", "answer", "encoding", "most"))
            own = lengths([without_tail(a or "") for a in answer]) if len(answer) else None
            limit = [x is not None and most[k] - 3 < own[k, ENCODINGS.index(x)] <= most[k] for k, x in enumerate(encoding)]
            found = all_defects(question, answer, endings, limit)
            out = list(zip(*((chat[k], turn[k], x) for k, x in enumerate(found) if x))) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.list_(pa.string())))], ["chat_id", "turn", "defects"])

    side = F.broadcast(limits) if limits.count() <= small else limits
    return flat.join(side, "source", "left").mapInArrow(run, "chat_id bigint, turn bigint, defects array<string>")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = turn_defects(c.table(spark, sf_dir, "chats"))
    return found.select("chat_id", "turn", F.col("defects")[0].alias("defect")).distinct()
