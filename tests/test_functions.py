"""Column functions on small tables of their own."""

import json

import pytest
from pyspark.sql import functions as F

from onggi.functions import chat, markdown, templates, text, verify


def values(spark, texts, make, kind="string"):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], f"k int, t {kind}")
    return [r.v for r in df.select("k", make(F.col("t")).alias("v")).orderBy("k").collect()]


def test_scripts(spark):
    assert values(spark, ["한글 abc", "123", "", None], text.hangul_fraction) == [2 / 5, 0.0, 0.0, None]
    assert values(spark, ["123"], lambda c: text.hangul_fraction(c, empty=1.0)) == [1.0]
    assert values(spark, ["한글 abc", "한글한글한글한글", "12"], text.code_switched) == [True, False, False]
    assert values(spark, ["책", "나무", "b", ""], text.has_final_consonant) == [True, False, False, False]
    assert values(spark, ["책", "나무"], lambda c: text.with_particle(c, "은", "는")) == ["책은", "나무는"]


def test_words(spark):
    assert values(spark, ["조선은", "조선에서는", "수도", "회의", "나무입니다"], text.without_particle) == ["조선", "조선", "수도", "회의", "나무"]
    assert values(spark, ["  조선은 (강물이) 12 그리고 abc  "], text.content_words) == [["조선", "강물"]]
    assert values(spark, ["조선은 128 그리고"], lambda c: text.content_words(c, hangul_only=False)) == [["조선", "128"]]
    assert values(spark, ["a bb. cc bb."], text.token_set) == [["bb", "cc"]]
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], ["b"])], "a array<string>, b array<string>")
    assert [tuple(r) for r in df.select(text.overlap(F.col("a"), F.col("b")), text.jaccard(F.col("a"), F.col("b"))).collect()] == [(0.5, 1 / 3), (1.0, 0.0)]


def test_speech_levels(spark):
    cases = {"갑니다": "합쇼체", "가세요.": "해요체", "간다!": "문어체", "가거든": "해체", "네": "해요체", "응": "해체", "- 갑니다": "neutral", "abc": "neutral", "1) 갑니다": "neutral"}
    assert values(spark, list(cases), text.sentence_register) == list(cases.values())
    assert values(spark, ['"가자"라고 말했습니다. `code` 끝났습니다.'], text.registers) == [["합쇼체", "합쇼체"]]
    summary = values(spark, ["갑니다. 간다.", "갑니다. 갑니다. 갑니다. 갑니다. 가요.", "abc", "1. 값", ""], lambda c: text.register_summary(text.registers(c)))
    assert [tuple(s) for s in summary] == [(0.5, "합쇼체", 2), (0.8, "합쇼체", 5), (1.0, None, 0), (1.0, None, 0), (1.0, None, 0)]
    assert values(spark, ["갑니다. 간다.", "갑니다.", "갑니다. 갑니다. 갑니다. 갑니다. 가요."], lambda c: text.register_consistent(text.register_summary(text.registers(c)))) == [False, True, True]
    assert values(spark, ["abc", "갑니다."], lambda c: text.register_is(text.register_summary(text.registers(c)), "합쇼체")) == [False, True]


def test_signs_of_translation(spark):
    got = values(spark, ["그는 갔다. 그녀가 왔다.", "법에 의해 정했다.", "사람들이 왔다.", "그러나 갔다. 그리고 왔다. 끝.", "중요한 것이다. 끝이다.", "이 것은 크다.", "나라의 사람의 집의 문", "말\n그리고 갔다", ""], text.translation_features)
    assert got[0].pronoun_per_100c == pytest.approx(200 / 14) and got[1].passive_per_100c > 0 and got[2].deul_per_100c > 0
    assert got[3].connective_per_sent == pytest.approx(2 / 3) and got[4].thing_end_ratio == 0.5 and got[5].dem_dep_per_100c > 0
    assert got[6].chain_deep_count == 1.0 and got[6].chain_med_per_100c > 0
    assert got[7].connective_per_sent == 0.0  # a new line alone doesn't open a sentence here
    assert all(v == 0 for v in got[8])
    assert values(spark, ["가" * 80 + ".", "가" * 81 + "."], lambda c: F.size(text.fired(text.translation_features(c)))) == [0, 1]


def test_predicates(spark):
    assert values(spark, ["a b c d " * 3, "a b c d a b c d", "a b c d x a b c d y a b c d", "", "a b c d e f g h i j k l m"], text.repeats_ngram) == [True, False, True, False, False]
    assert values(spark, ['{"a": 1}', "x", "- a"], lambda c: text.follows_format(c, F.lit("json"))) == [True, False, False]
    assert values(spark, ["[1] 2.", "1] [2", '1} {"a": 2', "1, 2", "", " 12 ", "null"], text.is_json) == [False, False, False, False, False, True, True]
    assert values(spark, ["x", "말\n 1) 가", "-가"], lambda c: text.follows_format(c, F.lit("list"))) == [False, True, False]
    assert values(spark, ["먼저 하고 따라서 끝", "1. 가\n2. 나", "한 줄 따라서", "가\n나\n결론", None], text.step_structure) == [True, True, False, True, False]
    assert values(spark, ["짧다", "이 답은 문제가 없고 아주 잘 된 답이라고 할 수 있으니 더 고칠 것이 없다고 본다", "이 답은 둘째 물음에 답하지 않았으며 수치도 틀렸으므로 다시 써야 한다고 본다"], text.useful_critique) == [False, False, True]
    df = spark.createDataFrame([("가나 다라 마바", "가나 다라 마바"), ("가나 다라 마바", "사아 자차 마바"), ("", "가나"), (None, "가나")], "a string, b string")
    assert [r[0] for r in df.select(text.meaningful_revision("a", "b")).collect()] == [False, True, False, False]
    assert values(spark, ["앞. 따라서 가. 결론 나", "표시 없음", "", None], text.final_span) == ["결론 나", "표시 없음", "", ""]
    assert values(spark, [4000, 6000, 6001, 99999], text.nearest_bucket, "int") == [4000, 4000, 8000, 32000]
    assert values(spark, ["The code is 12 34."], lambda c: text.retrieved(c, F.lit("1234"))) == [True]
    df = spark.createDataFrame([(0.05, 2.0, 0.0), (0.05, 1.9, 0.5), (0.04, 9.0, 9.0), (0.5, 1.0, 0.4)], "l double, p double, n double")
    assert [r[0] for r in df.select(text.strictly_faithful("l", "p", "n")).collect()] == [True, True, False, False]


def test_chat(spark):
    m = "array<struct<role string, content string>>"
    turns = [[("user", "q"), ("assistant", "a"), ("assistant", "b")], [("user", "q")], [], None]
    assert values(spark, turns, chat.first_assistant, m) == ["a", "", "", ""]
    assert values(spark, ["1. 하나\n 2) 둘\n셋"], chat.numbered_lines) == [["하나", "둘"]]
    assert values(spark, ["판정: a", 'x {"winner": "b"} y', '{"판정": "A"}', "없음", None], chat.verdict) == ["A", "B", "A", None, None]
    df = spark.createDataFrame([(a, b) for a in ("A", "B", None) for b in ("A", "B", None)], "a string, b string")
    assert [r[0] for r in df.select(chat.agreed("a", "b")).collect()] == [None, "A", None, "B", None, None, None, None, None]
    df = spark.createDataFrame([("", None, "c"), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(chat.first_filled("a", "b", "c")).collect()] == ["c", ""]


def test_numbers(spark):
    outputs = {"답: 3\n\\boxed{4}": "3", "#### 5 답: 6": "5", "The answer is 7. 정답: 8": "7", "1 + 2 = 3 그리고 9": "3", "값은 12 그리고 13": "13", "\\boxed{\\frac{1}{2}}": "\\frac{1", "없음": None, "최종 답: 1,200": "1,200"}
    assert values(spark, list(outputs), verify.final_answer) == list(outputs.values())
    assert values(spark, ["답: 3\n\\boxed{4}"], lambda c: verify.final_answer(c, strict_priority=True)) == ["4"]
    assert values(spark, ["1,200원", "1/4", "-2.5", "1/0", "abc", "", None, ".5"], verify.number) == [1200.0, 0.25, -2.5, None, None, None, None, 0.5]
    df = spark.createDataFrame([("#### 0.25", "1/4"), ("답: 3", "4"), ("x", "1"), (None, "1")], "o string, g string")
    assert [r[0] for r in df.select(verify.verify_number("o", "g")).collect()] == [True, False, False, False]


def test_options(spark):
    outputs = {"정답: ②": "B", "답은 다": "C", "\\boxed{A} 답: B": "A", "(D)": "D", "(E) 가": "A", "답: 3번": "C", "그냥 B": "B", "3": None, "": None, "답: A 답: D": "D"}
    assert values(spark, list(outputs), verify.chosen_option) == list(outputs.values())
    assert values(spark, ["(E)"], lambda c: verify.chosen_option(c, 5)) == ["E"]
    df = spark.createDataFrame([("답: 나", "B."), ("답: 나", "나"), ("답: A", ""), ("답: A", None)], "o string, g string")
    assert [r[0] for r in df.select(verify.verify_option("o", "g")).collect()] == [True, True, False, False]


def test_structured_answers(spark):
    assert values(spark, ["말\n```python\na = 1\n```\n```\nb\n```", "```\nx\n```\n```js\ny\n```", "  z ", None], verify.code_block) == ["a = 1", "x", "z", ""]
    got = values(spark, ["- 가: 1.\n나 = 둘\n가: 3", "가: 1"], lambda c: verify.assignment(c, ["가", "나"]))
    assert got == [{"가": "1", "나": "둘"}, None]
    df = spark.createDataFrame([({"a": "3", "b": "x"},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(verify.satisfies(F.col("m"), [("a", ">", 2), ("b", "!=", "a")])).collect()] == [True, False]
    assert values(spark, ['말 {"a": [1, 2]} 끝', "```json\n[1]\n```", "{bad", None], verify.extracted_json) == ['{"a": [1, 2]}', "[1]", None, None]
    golds = [("json", {"schema": {"required": ["a"], "types": {"a": "int"}}}, '{"a": true}', True), ("json", {"schema": {"types": {"a": "str"}}}, '{"a": 1}', False), ("list", {"min_items": 2}, "- 가\n2. 나", True), ("regex", {"pattern": "^가"}, "나", False), ("md_table", {"columns": ["이름"], "min_rows": 1}, "|이름|값|\n|---|---|\n|가|1|", True), ("other", {}, "x", False)]
    df = spark.createDataFrame([(o, json.dumps({"type": k} | g)) for k, g, o, _ in golds], "o string, g string")
    assert [r[0] for r in df.select(verify.verify_format("o", "g")).collect()] == [w for *_, w in golds]
    schema = {"types": {"n": "number", "l": "list", "d": "object", "z": "null", "f": "float"}}
    said = ['{"n": 1.5, "l": [], "d": {}, "z": null, "f": 0.5}', '{"n": "1"}', '{"l": {}}', '{"z": 0}', '{"f": 1}', '["n"]', "{}"]
    df = spark.createDataFrame([(o, json.dumps({"type": "json", "schema": schema})) for o in said], "o string, g string")
    assert [r[0] for r in df.select(verify.verify_format("o", "g")).collect()] == [True, False, False, False, False, False, True]
    assert values(spark, ["a|b\n---|---\n1|2\n3\n4|5", "a\n---|---\n1|2", "", None], verify.extracted_table) == ['{"columns": ["a", "b"], "rows": [["1", "2"]]}', None, None, None]
    grid = [[(3 * (r % 3) + r // 3 + c) % 9 + 1 for c in range(9)] for r in range(9)]
    shown = "\n".join("|".join(map(str, r)) for r in grid)
    puzzle = json.dumps([[0] * 9 for _ in range(8)] + [grid[8]])
    df = spark.createDataFrame([(shown, puzzle), (shown.replace("1", "2"), puzzle), ("", puzzle)], "o string, g string")
    assert [r[0] for r in df.select(verify.verify_sudoku("o", "g")).collect()] == [True, False, False]
    assert values(spark, ["\\boxed{\\frac{1}{2}} x", "\\boxed{1", None], verify.boxed_answer) == ["\\frac{1}{2}", None, None]


def test_templates(spark):
    df = spark.createDataFrame([("단락이다", "용어")], "p string, t string")
    one = lambda c: df.select(c).first()[0]
    ex = [{"단락": "가", "질문": "나", "답": "다"}]
    assert one(templates.few_shot_prompt("qa", ex, "p")) == "단락: 가\n질문: 나\n답: 다\n---\n단락: 단락이다\n질문:"
    assert one(templates.few_shot_prompt("definition", [], "p", "t", register="문어체")).endswith("\n\n용어: 용어\n단락: 단락이다\n정의:")
    assert values(spark, ["무엇인가?\n답: 그것이다\n---\n단락: x", "없음"], lambda c: templates.parsed_completion("qa", c)) == [("무엇인가?", "그것이다", None), None]
    got = values(spark, ["질문 1: 가\n답 1: 나\n질문 2: 다\n답 2: 라"], lambda c: templates.parsed_completion("multi_qa", c))[0]
    assert [tuple(x) for x in got.pairs] == [("가", "나"), ("다", "라")]
    assert values(spark, ["제목\n남은 줄"], lambda c: templates.parsed_completion("title", c))[0].answer == "제목"
    m = df.withColumn("x", templates.parsed_completion("qa", F.lit("무엇?\n답: 그것"))).select(templates.grounded_chat("qa", "p", "x", audience="일반").alias("m")).first().m
    assert m[0].content == "일반 성인을 대상으로 다음 단락을 읽고 질문에 답하시오.\n\n단락: 단락이다\n\n질문: 무엇?" and m[1].content == "그것"
    assert values(spark, [0, 3, 7], lambda c: templates.pair_document(F.lit(" a "), F.lit("나"), c), "int") == ["a\n나", "다음의 영어문장을 조선어로 번역하시오.\na\n\n나", "Translate to Korean:\na\n\n나"]
    assert values(spark, [0], lambda c: templates.pair_document(F.lit(" "), F.lit("나"), c), "int") == [None]
    assert values(spark, ["풀이다\n문제: 다음", "x\n\n###\n\ny"], templates.first_solution) == ["풀이다", "x"]


def test_markdown(spark):
    doc = "# Head `x`\n\n- item [label](http://a.b/c)\n> quote **bold** $a+b$\n\n| a | `b|c` |\n|---|---|\n| d | $|x|$ |\n```\ncode | here\n```\n$$\nmath\n$$\n\\begin{align}\nz\n\\end{align}\nplain <b>tag</b> http://u.v/w costs $5 to $10"
    assert markdown.map_markdown(doc, lambda t: t) == doc
    upper = markdown.map_markdown(doc, str.upper)
    assert "# HEAD `x`" in upper and "- ITEM [LABEL](http://a.b/c)" in upper and "> QUOTE **BOLD** $a+b$" in upper
    assert "| A | `b|c` |\n|---|---|\n| D | $|x|$ |" in upper and "code | here" in upper and "\nmath\n" in upper and "\nz\n" in upper
    assert "PLAIN <b>TAG</b> http://u.v/w COSTS $5 TO $10" in upper
    pieces = {"**a `x**` b**": "**A `x**` B**", "a * b": "A * B", "[x": "[X", "x](y)": "X](Y)", "snake_case_name": "SNAKE_CASE_NAME", "**a *b* c**": "**A *B* C**", "〔0〕 `c`": "〔0〕 `c`", "_a_ b": "_A_ B"}
    assert {k: markdown.map_prose(k, str.upper) for k in pieces if "〔" not in k} == {k: v for k, v in pieces.items() if "〔" not in k}
    assert values(spark, ["a `b`", None, ""], lambda c: markdown.mapped_markdown(c, str.upper)) == ["A `b`", None, ""]
    assert values(spark, ["![i](x) `c` [l](u) http://z <b>"], markdown.masked_spans)[0].asDict() == {"image": 1, "code": 1, "display": 0, "math": 0, "paren": 0, "bracket": 0, "html": 1, "link": 1, "url": 1}
