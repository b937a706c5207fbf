"""Sentences, answer defects, truncation and encoding."""

import os
import random

import pytest

from onggi.llm import encoding, pairs, sentences, truncation


def cut(text):
    low, out = 0, []
    for high in sentences.sentence_ends(text):
        out.append(text[low:high].strip())
        low = high
    return out


@pytest.mark.parametrize(
    "parts",
    [
        ["값은 3.14와 v2.10.1에서 정해졌습니다.", "Dr. 김은 No. 7을 보았습니다!", "왜 그랬습니까?"],
        ["그는 “비가 옵니다.”라고 말했습니다.", "2031. 4. 5. 새 값을 적었다."],
        ["원리는… 이 경우를 빼면 맞습니다.", "표(그림 3. 참조)를 12 vs. 15로 비교했습니다…", "다음을 보십시오."],
        ["표시가 없어도 문장은 끝납니다", "또한 다음 문장도 끝났습니다.", "정말 그래요 ^^", "그리고 이어집니다~"],
        ["“Is it late?” asked the clerk at 9:15 a.m. near the gate.", "Nobody expected it… at least not today.", "It did!"],
        ["负责人说：“温度已经比较。”随后离开了。", "为什么需要？", "担当者は「終わりました。」と述べた。", "次の文です。"],
        ["जब बाँध बढ़ता है तब जाँच होती है।", "क्या यह स्थिर है?"],
        ["เมื่อระดับน้ำเพิ่มขึ้นต้องปรับใหม่", "อุปกรณ์ถูกตรวจวัด"],
    ],
)
def test_sentences_of_many_scripts(parts):
    assert cut(" ".join(parts)) == parts


def test_labels_belong_to_what_follows_and_lines_end_sentences():
    assert cut("단계 1: 첫째를 합니다.\n2. 둘째를 합니다.\n- 셋째 확인\n정답: 12 kg") == ["단계 1: 첫째를 합니다.", "2. 둘째를 합니다.", "- 셋째 확인", "정답: 12 kg"]


def test_ends_are_those_of_the_stored_text():
    text = "ＡＢ​는 한다고 했습니다. 다음입니다."
    assert [text[:e][-1] for e in sentences.sentence_ends(text)] == [".", "."] and sentences.sentence_ends(text)[-1] == len(text)
    assert sentences.sentence_ends(None) == sentences.sentence_ends("") == sentences.sentence_ends(" \n…\n") == []
    assert len(sentences.sentence_ends("끝났습니다. " * 20_000)) == 20_000


def test_sentences_of_a_table(spark):
    df = spark.createDataFrame([("a", 1, "하나입니다. 둘입니다.", 0), ("a", 2, None, 0), ("a", 3, " ", 0), ("b", 1, "끝", 0)], "src string, rec_id bigint, text string, sent_end int")
    assert sorted(map(tuple, sentences.sentences(df).collect())) == [("a", 1, 6), ("a", 1, 12), ("b", 1, 1)]
    assert sentences.sentences(df.limit(0)).count() == 0


CORPUS = ["The gauge was sorted in most years. The signal was mapped under heavy load."] * 20 + ["- 관측소의 수온 점검\n- 기술원의 유량 분류\n- 학당의 낱말 확인"] * 10


def endings(spark):
    df = spark.createDataFrame([("c", k, t, None) for k, t in enumerate(CORPUS)], "src string, rec_id bigint, text string, source string")
    return truncation.Endings(truncation.learned(df)[0])


def test_endings(spark):
    e = endings(spark)
    whole = ["값을 확인했습니다.", "값을 확인했습니다", "답: D", "(가)", "145.58회", "Vené 장치, 나루 학당", "- 학당의 낱말 점검", '{"값": 12}', "12 + 3 = 15입니다.\n#### 15", "The gauge was sorted in most years", "예, 2050년입니다", "", " ", "…", "확인했습니다…"]
    lost = ["값을 확인하려면 먼저 관측소의", "값을 확인했습니다. 그 이후 수온", "12 + 3", "12 + 3 = 15입니다.\n#### 1", "- 학당의 낱", "The gauge was sorted in mo", "The gauge was sorted in most", '{"값": 12', "이것은 그림 3과�", "이것은 값이 \\ub3", "그는 “비가 옵니다.", "표를 12 vs.", "값을 확인하려면…", "확인했습니다.\n2)"]
    assert [t for t in whole if e.cut(t)] == [] and [t for t in lost if not e.cut(t)] == []
    assert not e.cut(None)


@pytest.mark.parametrize("times", [1, 40])
def test_endings_are_judged_by_shares_at_any_size(spark, times):
    thai = "เมื่อระดับน้ำเพิ่มขึ้นต้องปรับใหม่ อุปกรณ์ถูกตรวจวัด เมื่ออุปกรณ์ถูกใช้ต้องปรับใหม่ อุปกรณ์ ถูกใช้"
    corpus = [thai, "1. 수온 점검\n2. 유량 점검\n3. 결"] * times
    df = spark.createDataFrame([("c", k, t, None) for k, t in enumerate(corpus)], "src string, rec_id bigint, text string, source string")
    e = truncation.Endings(truncation.learned(df)[0])
    assert not e.cut("อุปกรณ์ถูกใช้ต้องปรับใหม่") and not e.cut("1. 유량 점검\n2. 수온 점검")
    assert e.cut("เมื่อระดับน้ำเพิ่มขึ้นต้อง") and e.cut("1. 수온 점검\n2. 유")
    for unseen in ("ข้อความนี้ไม่มีที่ไหน", "1. 수온 점검\n2. 결"):  # an ending that was never seen is a cut at a limit only
        assert e.cut(unseen, True) and not e.cut(unseen)


def test_a_storage_limit_shows(spark):
    rng = random.Random(1)
    full = ["".join(rng.choice("가나다라마바사 ") for _ in range(rng.randrange(60, 400))) + " 했습니다." for _ in range(300)]
    rows = [("t", k, t[:200], "short") for k, t in enumerate(full)] + [("t", 1000 + k, t, "long") for k, t in enumerate(full)] + [("t", 5000, None, "short"), ("t", 5001, "", None)]
    df = spark.createDataFrame(rows, "src string, rec_id bigint, text string, source string")
    assert [tuple(r) for r in truncation.learned(df.where("text is not null"))[1].collect()] == [("short", "chars", 200)]
    found = {r.rec_id for r in truncation.truncated(df).where("truncated").collect()}
    whole = (".", "습니다")  # a cut behind the final verb leaves a sentence that only lacks its mark
    assert found == {k for k, t in enumerate(full) if len(t) > 200 and not t[:200].endswith(whole)}
    assert truncation.truncated(df.limit(0)).count() == 0


def test_lengths_under_other_encodings():
    t = 'a<b>&"한\n😀'
    import html
    import json

    n = dict(zip(truncation.ENCODINGS, truncation.lengths([t])[0].tolist()))
    assert n["utf8"] == len(t.encode()) and n["utf16"] == len(t.encode("utf-16-le")) // 2 and n["html"] == len(html.escape(t))
    assert n["json"] == len(json.dumps(t)) - 2 and n["json8"] == len(json.dumps(t, ensure_ascii=False).encode()) - 2 and n["crlf"] == len(t) + 1


def test_answer_defects(spark):
    e = endings(spark)
    q = "나루 학당은 수온을 어떻게 점검합니까?"
    cases = [
        (None, ["empty"]), ("​ \n", ["empty"]), ("정답: ", ["empty"]), ("N/A", ["empty"]), ("(없음)", ["empty"]),
        ("답: 나루  학당은 수온을 어떻게 점검합니까", ["copy"]), ("죄송합니다. 그 내용은 대답할 수 없어요. 양해 부탁드립니다.", ["refusal"]),
        ("늦어서 죄송합니다. 수온을 먼저 점검했습니다.", []), ("The gauge at the old gate was sorted in most years.", ["language"]),
        ("수온을 점검했습니다. 그 이후 나루 학당에서", ["truncated"]), ("수온을 점검했습니다.", []), ("약 30회", []),
    ]
    assert [(a, d) for a, _ in cases if (d := pairs.defects(q, a, e)) != dict(cases)[a]] == []
    assert pairs.defects("나루에 관한 글을 영어로 써 주세요.", "The gauge at the old gate was sorted in most years.", e) == []
    assert pairs.defects(None, "수온을 점검했습니다.", e) == []


def test_turns(spark):
    m = lambda *x: [{"role": r, "content": t} for r, t in x]
    rows = [
        (1, m(("system", "s"), ("user", "무엇입니까?"), ("assistant", "값을 확인했습니다."), ("user", "왜입니까?")), "a"),
        (2, m(("user", "무엇입니까?"), ("assistant", None)), None),
        (3, [], "a"), (4, None, "a"),
    ]
    df = spark.createDataFrame(rows, "chat_id bigint, messages array<struct<role string, content string>>, source string")
    assert sorted((r.chat_id, r.turn, r.defects) for r in pairs.turn_defects(df).collect()) == [(1, 4, ["empty"]), (2, 1, ["empty"])]
    assert pairs.turn_defects(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.exists(encoding.VOCABULARY), reason="no vocabulary files here")
def test_encoding_is_that_of_the_public_library(spark):
    import tiktoken

    ranks = encoding.read_ranks(encoding.VOCABULARY)
    own = tiktoken.Encoding("own", pat_str=encoding.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    texts = ["", None, " ", "<|endoftext|>", "a" * 3000, "한국어 문장입니다.  다음\n\n줄", "​ＡＢ", "don't  we'll"] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xAC00, 0xD7A3), 32])) for _ in range(80)) for _ in range(50)]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in encoding.encode(df).collect()}
    assert got == {k: own.encode_ordinary(t) if t else [] for k, t in enumerate(texts)}
    table = encoding.PerfectHash(list(ranks), list(ranks.values()))
    assert table.find(list(ranks)) == list(ranks.values()) and table.find([b"no such token"]) == [None]
    assert encoding.encode(df.limit(0)).count() == 0


def test_a_long_refusal_is_one():
    text = "죄송합니다. 그 내용은 대답할 수 없어요. " * 40
    assert len(text) > 600 and pairs.is_refusal(text)


def test_rates_count_records_without_a_text(spark, tmp_path):
    rows = [(1, "값을 확인했습니다.", "a"), (1, "값을 확인했습니다.", "a"), (2, None, "a"), (3, "값을 확인하려면 먼저 관측소의 수온을 다시", "a"), (4, "", None)]
    spark.createDataFrame(rows, "pred_id bigint, prediction string, source string").write.parquet(f"{tmp_path}/predictions.parquet")
    chats = [(1, [], "a"), (2, None, "b")]
    spark.createDataFrame(chats, "chat_id bigint, messages array<struct<role string, content string>>, source string").write.parquet(f"{tmp_path}/chats.parquet")
    got = {(r.src, r.source): (r.records, r.truncated, r.rate) for r in truncation.p5_rates(spark, str(tmp_path)).collect()}
    assert got == {("predictions", "a"): (3, 1, 0.333333), ("predictions", None): (1, 0, 0.0), ("chats", "a"): (1, 0, 0.0), ("chats", "b"): (1, 0, 0.0)}


def test_a_sentence_may_run_over_any_number_of_marks():
    authors = "The report by " + ", ".join(f"{chr(65 + k % 26)}. Kim" for k in range(60)) + " was read in most years."
    assert cut(authors + " It was good.") == [authors, "It was good."]
    exclaimed = "He said “" + "no! " * 60 + "” and left."
    assert cut(exclaimed + " It was good.") == [exclaimed, "It was good."]


def test_a_span_of_many_abbreviations_is_one_sentence():
    assert cut("See " + "e.g. " * 45 + "here") == ["See " + "e.g. " * 45 + "here"]


@pytest.mark.parametrize("unit", ["The gauge was sorted in most years. He said “it is.” and left. ", "温度已经比较。随后离开了。为什么？", "값을 확인했습니다. 또한 점검했다 그리고 ", "เมื่อระดับน้ำ ต้องปรับ "])
def test_long_lines_take_time_in_proportion(unit):
    import time

    took = []
    for n in (20_000, 160_000):
        text = unit * (n // len(unit))
        began = time.process_time()
        sentences.sentence_ends(text)
        took.append(time.process_time() - began)
    assert took[1] < 24 * max(took[0], 0.02)


def test_answers_in_other_scripts(spark):
    e = endings(spark)
    q = "나루 학당은 수온을 어떻게 점검합니까?"
    assert pairs.defects(q, "Температура воды измеряется каждый день на старом мосту.", e) == ["language"] and pairs.language("ثابت في كل يوم وفي كل شهر هنا") == "arabic"
    assert "language" in pairs.defects("How is the water temperature checked here?", "Температура воды измеряется каждый день на старом мосту.", e)
    assert "language" not in pairs.defects("How is the water temperature checked here?", "The wаter temperаture is checked dаily.", e)  # Cyrillic look-alikes
    assert pairs.defects("나루에 관한 글을 러시아어로 써 주세요.", "Температура воды измеряется каждый день на старом мосту.", e) == []


def test_copies_and_refusals_of_any_form(spark):
    e = endings(spark)
    q = "나루 학당은 수온을 어떻게 점검합니까?"
    assert pairs.defects(q, q + " 답:", e)[0] == "copy" and pairs.defects(q, f"{q} {q}", e)[0] == "copy"
    assert "copy" not in pairs.defects(q, q + " 매일 아침 점검합니다.", e)
    assert pairs.is_refusal("I'm sorry, but I can't help with that.") and pairs.is_refusal("I am unable to comment on this request.")
    assert not pairs.is_refusal("The valve cannot open below zero.") and not pairs.is_refusal("늦어서 죄송합니다. 수온을 먼저 점검했습니다.")


def test_a_short_storage_limit_shows(spark):
    rng = random.Random(2)
    rows = [("t", k, "".join(rng.choice("가나다라마바사 ") for _ in range(rng.randrange(20, 90)))[:30].ljust(1, "가"), "tiny") for k in range(200)]
    df = spark.createDataFrame(rows, "src string, rec_id bigint, text string, source string")
    assert [(r.source, r.most) for r in truncation.learned(df)[1].collect()] == [("tiny", 30)]
