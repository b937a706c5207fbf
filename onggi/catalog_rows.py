"""Queries of row functions, converters, prompts, flows with fake models and vocabularies, each with its SQL over the same whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import A, P, Q, WS, _answers, _content, _docs, _features, _hash, _N_FIRED, _outputs, _passages, _share, _strip, _summary, _table, _words, query
from .functions import chat, templates, text, verify
from .functions import profiles as p
from .operators import blend, cluster, filters, pack, prefer, report, stats, vocab
from .operators.common import numbered
from .plans import flows, hooks
from .sources import io

EXEMPLAR = {"단락": "강은 바다로 흐른다.", "질문": "강은 어디로 흐르는가?", "답": "바다로 흐른다."}
WORKED = {"problem": "2 + 3은 얼마인가?", "solution": "2에 3을 더하면 5이다. 최종답: 5"}
SUPPORT = [{"passage": "강은 길다.", "claim": "강은 짧다.", "label": "아니"}]
_LINES = "string_split_regex({}, '\\r\\n|[\\n\\x0b\\x0c\\r\\x{{85}}\\x{{2028}}\\x{{2029}}]')"


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _lit(x: str) -> str:
    """A SQL literal of a text with line ends."""
    return " || chr(10) || ".join(_q(y) for y in x.split("\n"))


# --- prompts, completions, chats -------------------------------------------------------------------------------------

_BLOCK = "\n".join(f"{k}: {v}" for k, v in EXEMPLAR.items())


@query(f"SELECT exemplar_id, {_lit(_BLOCK + p.DELIMITER)} || '단락: ' || passage || {_lit(chr(10) + '질문:')} AS prompt FROM {Q} WHERE passage IS NOT NULL")
def few_shot_prompts(spark, sf):
    return _passages(spark, sf).where("passage is not null").select("exemplar_id", templates.few_shot_prompt("qa", [EXEMPLAR], "passage").alias("prompt"))


_COMPLETION = f"{_strip('split_part(question || chr(10) || ' + _q('답: ') + ' || answer, chr(10) || ' + _q('---') + ', 1)')}"
_PARSE = rf"'(?s)^(.*?)\n{WS}*답{WS}*:{WS}*(.*)$'"
_PARSED = f"(SELECT exemplar_id, passage, {_strip(f'regexp_extract(c, {_PARSE}, 1)')} AS q, {_strip(f'regexp_extract(c, {_PARSE}, 2)')} AS a FROM (SELECT *, {_COMPLETION} AS c FROM {Q} WHERE question IS NOT NULL AND answer IS NOT NULL) WHERE regexp_matches(c, {_PARSE}))"


def _parsed(spark, sf):
    whole = _passages(spark, sf).where("question is not null and answer is not null")
    return whole.withColumn("parsed", templates.parsed_completion("qa", F.concat("question", F.lit("\n답: "), "answer")))


@query(f"SELECT exemplar_id, q AS question, a AS answer FROM {_PARSED}")
def parsed_completions(spark, sf):
    return _parsed(spark, sf).where("parsed is not null").select("exemplar_id", "parsed.question", "parsed.answer")


@query(f"SELECT exemplar_id, {_lit('일반 성인을 대상으로 다음 단락을 읽고 질문에 답하시오.' + chr(10) + chr(10) + '단락: ')} || passage || {_lit(chr(10) + chr(10) + '질문: ')} || q AS asked, a AS said FROM {_PARSED}")
def grounded_chats(spark, sf):
    m = _parsed(spark, sf).where("parsed is not null").select("exemplar_id", templates.grounded_chat("qa", "passage", "parsed", audience="일반").alias("m"))
    return m.select("exemplar_id", F.col("m")[0]["content"].alias("asked"), F.col("m")[1]["content"].alias("said"))


_SOLVED = f"문제: {WORKED['problem']}\n풀이:\n{WORKED['solution']}"


@query(f"SELECT exemplar_id, {_lit(_SOLVED + p.STEP_DELIMITER + '문제: ')} || question || {_lit(chr(10) + '정답이 ')} || answer || {_lit('임을 알고있습니다. 이 답이 어떻게 나오는지 단계별로 설명하시오:' + chr(10) + '풀이:' + chr(10))} AS prompt FROM {Q} WHERE question IS NOT NULL AND answer IS NOT NULL")
def solution_prompts(spark, sf):
    return _passages(spark, sf).where("question is not null and answer is not null").select("exemplar_id", templates.solution_prompt([WORKED], "question", "answer").alias("prompt"))


@query(f"SELECT pred_id, {_strip('split_part(split_part(prediction, ' + _lit(p.STEP_DELIMITER) + ', 1), chr(10) || ' + _q('문제:') + ', 1)')} AS solution FROM {P} WHERE prediction IS NOT NULL")
def first_solutions(spark, sf):
    return _outputs(spark, sf).where("prediction is not null").select("pred_id", templates.first_solution("prediction").alias("solution"))


_ASKS = "주장이 단락에서 뒤받침됩니까? 답:"
_SUPPORTED = f"단락: {SUPPORT[0]['passage']}\n주장: {SUPPORT[0]['claim']}\n{_ASKS} {SUPPORT[0]['label']}{p.DELIMITER}단락: "


@query(f"SELECT exemplar_id, {_lit(_SUPPORTED)} || passage || {_lit(chr(10) + '주장: ')} || answer || {_lit(chr(10) + _ASKS)} AS prompt FROM {Q} WHERE passage IS NOT NULL AND answer IS NOT NULL")
def support_prompts(spark, sf):
    return _passages(spark, sf).where("passage is not null and answer is not null").select("exemplar_id", templates.support_prompt(SUPPORT, "passage", "answer").alias("prompt"))


@query(f"SELECT pred_id, CASE verifier {' '.join(f'WHEN {_q(k)} THEN {_q(v)}' for k, v in p.SYSTEMS.items())} ELSE {_q(p.SYSTEMS['math'])} END AS system, prediction AS problem FROM {P}")
def problem_messages(spark, sf):
    m = _outputs(spark, sf).select("pred_id", templates.problem_messages("prediction", "verifier").alias("m"))
    return m.select("pred_id", F.col("m")[0]["content"].alias("system"), F.col("m")[1]["content"].alias("problem"))


_JUDGED = ("아래에 질문 하나와 두개의 답이 있습니다. 다음의 기준에 따라 어느 답이 더 나은지 판단하시오: 정확성.\n\n질문: ", "\n\n답 A:\n", "\n\n답 B:\n", "\n\n마지막에 정확히 이 형식으로 판정을 내리시오 — '판정: A' 또는 '판정: B'.")


@query(f"SELECT exemplar_id, {_lit(_JUDGED[0])} || question || {_lit(_JUDGED[1])} || answer || {_lit(_JUDGED[2])} || passage || {_lit(_JUDGED[3])} AS said FROM {Q} WHERE passage IS NOT NULL AND question IS NOT NULL AND answer IS NOT NULL")
def judge_prompts(spark, sf):
    df = _passages(spark, sf).where("passage is not null and question is not null and answer is not null")
    return df.select("exemplar_id", templates.judge_messages("question", "answer", "passage", "정확성")[0]["content"].alias("said"))


@query(f"SELECT pred_id, array_to_string(list_filter(list_transform({_LINES.format('prediction')}, lambda s: regexp_extract(s, '^{WS}*\\d+[.)]{WS}+(.*[^\\s\\x0b\\x{{85}}\\p{{Z}}])', 1)), lambda s: s <> ''), '|') AS items FROM {P} WHERE prediction IS NOT NULL")
def numbered_items(spark, sf):
    return _outputs(spark, sf).where("prediction is not null").select("pred_id", F.array_join(chat.numbered_lines("prediction"), "|").alias("items"))


_SAID = "CASE pred_id % 5 WHEN 0 THEN '판정: ' || chr((65 + run % 2)::INT) WHEN 1 THEN '근거 {\"winner\": \"' || chr((97 + run % 2)::INT) || '\"} 끝' WHEN 2 THEN 'Verdict : b' WHEN 3 THEN prediction ELSE '{\"판정\": \"A\"}' END"
_MARKED = "upper(regexp_extract(s, '(?:판정|승자|winner|verdict)" + WS + "*[:：]" + WS + "*\"?([ABab])', 1))"
_JSON = "CASE WHEN regexp_matches(s, '(?s)\\{.*\\}') AND json_valid(regexp_extract(s, '(?s)(\\{.*\\})', 1)) THEN regexp_extract(s, '(?s)(\\{.*\\})', 1) END"


@query(f"SELECT pred_id, CASE WHEN m <> '' THEN m WHEN n IN ('A', 'B') THEN n END AS verdict FROM (SELECT pred_id, {_MARKED} AS m, upper({_strip('coalesce(nullif(j ->> ' + _q('$.winner') + ', ' + chr(39) * 2 + '), j ->> ' + _q('$.판정') + ')')}) AS n FROM (SELECT pred_id, s, {_JSON} AS j FROM (SELECT pred_id, {_SAID} AS s FROM (SELECT *, length(run_id) AS run FROM {P}) WHERE run_id IS NOT NULL) WHERE s IS NOT NULL))")
def verdicts(spark, sf):
    run = F.length("run_id") % 2
    k = F.col("pred_id") % 5
    said = (
        F.when(k == 0, F.concat(F.lit("판정: "), F.char(65 + run)))
        .when(k == 1, F.concat(F.lit('근거 {"winner": "'), F.char(97 + run), F.lit('"} 끝')))
        .when(k == 2, "Verdict : b")
        .when(k == 3, F.col("prediction"))
        .otherwise('{"판정": "A"}')
    )
    df = _outputs(spark, sf).where("run_id is not null").select("pred_id", said.alias("s")).where("s is not null")
    return df.select("pred_id", chat.verdict("s").alias("verdict"))


# --- text functions --------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, length(regexp_replace(text, '[^\\p{{Hangul}}]', '', 'g'))::INT AS hangul, len({_words('text')})::INT AS words, regexp_matches(text, '[가-힣]') AS syllable, CASE WHEN regexp_matches(right(text, 1), '^[가-힣]$') THEN (unicode(right(text, 1)) - 44032) % 28 <> 0 ELSE false END AS batchim FROM documents WHERE text IS NOT NULL")
def text_counts(spark, sf):
    return _docs(spark, sf).where("text is not null").select("doc_id", text.hangul_chars("text").alias("hangul"), text.word_count("text").alias("words"), text.has_syllable("text").alias("syllable"), text.has_final_consonant("text").alias("batchim"))


_EDGE = r"[。.,?!\"''()\[\]{}:;…·]"


def _tokens(x: str) -> str:
    return f"list_distinct(list_transform(list_filter({_words(x)}, lambda w: length(w) > 1), lambda w: regexp_replace(w, '^{_EDGE}+|{_EDGE}+$', '', 'g')))"


@query(f"SELECT exemplar_id, array_to_string(list_sort({_tokens('question')}), '|') AS tokens FROM {Q} WHERE question IS NOT NULL")
def token_sets(spark, sf):
    return _passages(spark, sf).where("question is not null").select("exemplar_id", F.array_join(F.array_sort(text.token_set("question")), "|").alias("tokens"))


def _jaccard(a: str, b: str, empty: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN {empty} ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"


@query(f"SELECT exemplar_id, round({_jaccard('x', 'y', '0.0')}, 6) AS similar FROM (SELECT exemplar_id, {_tokens('passage')} AS x, {_tokens('question')} AS y FROM {Q} WHERE passage IS NOT NULL AND question IS NOT NULL)")
def jaccard_similarity(spark, sf):
    df = _passages(spark, sf).where("passage is not null and question is not null")
    return df.select("exemplar_id", F.round(text.jaccard(text.token_set("passage"), text.token_set("question")), 6).alias("similar"))


def _overlap(s: str, a: str) -> str:
    return f"CASE WHEN len({s}) = 0 THEN 1.0 ELSE len(list_intersect({s}, {a}))::DOUBLE / len({s}) END"


@query(f"SELECT exemplar_id, {_overlap('s', 'a')} > 0.1 AS grounded FROM (SELECT exemplar_id, {_content('passage')} AS s, {_content('answer')} AS a FROM (SELECT exemplar_id, coalesce(passage, '') AS passage, answer FROM {Q} WHERE answer IS NOT NULL))")
def grounded_answers(spark, sf):
    return _passages(spark, sf).where("answer is not null").select("exemplar_id", text.grounded("answer", "passage").alias("grounded"))


_HITS = " + ".join(f"contains(prediction, {_q(m)})::INT" for m in p.STEP_MARKERS)
_STEPS = f"(({_HITS}) >= 2 OR len(regexp_extract_all(prediction, '(?m)^{WS}*(?:\\d+[.)]|[-*•]){WS}+[^\\s\\x0b\\x{{85}}\\p{{Z}}]')) >= 2 OR (len(list_filter({_LINES.format('prediction')}, lambda s: {_strip('s')} <> '')) >= 3 AND ({_HITS}) >= 1))"


@query(f"SELECT pred_id, {_STEPS} AS steps, length(prediction) BETWEEN 60 AND 6000 AND {_share('prediction', 'Hangul')} >= 0.7 AND {_STEPS} AS acceptable FROM {P} WHERE prediction IS NOT NULL")
def step_answers(spark, sf):
    return _outputs(spark, sf).where("prediction is not null").select("pred_id", text.step_structure("prediction").alias("steps"), text.acceptable_steps("prediction").alias("acceptable"))


@query(f"SELECT pred_id, CASE k WHEN 0 THEN json_valid({_strip('prediction')}) WHEN 1 THEN regexp_matches(prediction, '(?:^|\\n){WS}*(?:-|•|\\d+[.)]){WS}+') ELSE true END AS follows FROM (SELECT *, pred_id % 3 AS k FROM {P}) WHERE prediction IS NOT NULL AND (k <> 0 OR {_strip('prediction')} <> '')")
def format_adherence(spark, sf):
    kind = F.when(F.col("pred_id") % 3 == 0, "json").when(F.col("pred_id") % 3 == 1, "list").otherwise("free")
    df = _outputs(spark, sf).where("prediction is not null").where((F.col("pred_id") % 3 != 0) | (text.strip("prediction") != ""))  # engines differ on an empty JSON text
    return df.select("pred_id", text.follows_format("prediction", kind).alias("follows"))


@query(f"SELECT exemplar_id, len({_words('answer')}) >= 2 AND length(answer) <= 4000 AND {_share('answer', 'Hangul')} >= 0.7 AND {_share('question', 'Hangul')} >= 0.7 AS accepted FROM {Q} WHERE question IS NOT NULL AND answer IS NOT NULL")
def accepted_outputs(spark, sf):
    return _passages(spark, sf).where("question is not null and answer is not null").select("exemplar_id", text.acceptable_output("question", "answer").alias("accepted"))


_USEFUL = f"(length(passage) >= 30 AND NOT regexp_matches(passage, '{'|'.join(p.EMPTY_CRITIQUES)}'))"
_CHANGED = f"({_strip('question')} <> {_strip('answer')} AND 1 - {_jaccard(_tokens('question'), _tokens('answer'), '2.0')} >= 0.15)"


@query(f"SELECT exemplar_id, {_USEFUL} AS useful, {_CHANGED} AS changed, {_share('answer', 'Hangul')} >= 0.7 AND {_USEFUL} AND {_CHANGED} AS accepted FROM {Q} WHERE passage IS NOT NULL AND question IS NOT NULL AND answer IS NOT NULL")
def revisions(spark, sf):
    df = _passages(spark, sf).where("passage is not null and question is not null and answer is not null")
    return df.select("exemplar_id", text.useful_critique("passage").alias("useful"), text.meaningful_revision("question", "answer").alias("changed"), text.acceptable_revision("question", "passage", "answer").alias("accepted"))


@query(f"SELECT pred_id, coalesce(prediction, '') AS auto, coalesce(nullif(gold, ''), nullif(prediction, ''), '') AS first FROM {P}")
def response_fields(spark, sf):
    return _outputs(spark, sf).select("pred_id", F.coalesce(chat.response_text("prediction"), F.lit("")).alias("auto"), chat.first_filled("gold", "prediction").alias("first"))


# --- verifiers -------------------------------------------------------------------------------------------------------

_FENCE = "'(?s)```(\\w*)" + WS + "*\\n(.*?)```'"
_ANY = "SELECT pred_id, CASE pred_id % 4 WHEN 0 THEN '앞' || chr(10) || '```python' || chr(10) || coalesce(prediction, '') || chr(10) || '```' WHEN 1 THEN '```' || chr(10) || coalesce(prediction, '') || chr(10) || '```' || chr(10) || '```js' || chr(10) || 'x' || chr(10) || '```' ELSE prediction END AS t FROM " + P


@query(f"""SELECT pred_id, {_strip("coalesce(list_extract(list_filter(b, lambda x: x.tag IN ('python', 'py')), -1).body, list_extract(list_filter(b, lambda x: x.tag = ''), -1).body, list_extract(b, -1).body, t)")} AS code
    FROM (SELECT pred_id, t, list_transform(list_zip(regexp_extract_all(t, {_FENCE}, 1), regexp_extract_all(t, {_FENCE}, 2)), lambda z: {{'tag': lower(z[1]), 'body': z[2]}}) AS b FROM (SELECT pred_id, coalesce(t, '') AS t FROM ({_ANY})))""")  # fmt: skip
def code_blocks(spark, sf):
    k, said = F.col("pred_id") % 4, F.coalesce("prediction", F.lit(""))
    t = F.when(k == 0, F.concat(F.lit("앞\n```python\n"), said, F.lit("\n```"))).when(k == 1, F.concat(F.lit("```\n"), said, F.lit("\n```\n```js\nx\n```"))).otherwise(F.col("prediction"))
    return _outputs(spark, sf).select("pred_id", verify.code_block(t).alias("code"))


@query(f"""SELECT pred_id, a AS left_value, b AS right_value, coalesce(try_cast(a AS DOUBLE) > try_cast(b AS DOUBLE), false) AS met FROM (SELECT pred_id, pred_id::VARCHAR AS a, length(coalesce(prediction, ''))::VARCHAR AS b FROM {P})""")
def assignments(spark, sf):
    said = F.concat(F.lit("- 가: "), F.col("pred_id").cast("string"), F.lit(".\n나 = "), F.length(F.coalesce("prediction", F.lit(""))).cast("string"), F.lit("\n가: 0"))
    df = _outputs(spark, sf).select("pred_id", verify.assignment(said, ["가", "나"]).alias("m"))
    return df.select("pred_id", F.col("m")["가"].alias("left_value"), F.col("m")["나"].alias("right_value"), (verify.number(F.col("m")["가"]) > verify.number(F.col("m")["나"])).alias("met"))


@query(f"SELECT pred_id, CASE pred_id % 3 WHEN 0 THEN true WHEN 1 THEN regexp_matches(coalesce(prediction, ''), '(?s)[0-9]+') ELSE coalesce(len(regexp_extract_all(prediction, '(?m)^{WS}*(?:[-*•]|[0-9]+[.)]){WS}+[^\\s\\x0b\\x{{85}}\\p{{Z}}]')), 0) >= 2 END AS met FROM {P}")
def format_verdicts(spark, sf):
    k = F.col("pred_id") % 3
    gold = F.when(k == 0, '{"type": "json", "schema": {"required": ["a"], "types": {"a": "int", "b": "str"}}}').when(k == 1, '{"type": "regex", "pattern": "[0-9]+"}').otherwise('{"type": "list", "min_items": 2}')
    said = F.when(k == 0, F.concat(F.lit('값은 {"a": '), F.col("pred_id").cast("string"), F.lit(', "b": "x"}'))).otherwise(F.col("prediction"))
    return _outputs(spark, sf).select("pred_id", verify.verify_format(said, gold).alias("met"))


# --- filters and converters ------------------------------------------------------------------------------------------


@query(f"SELECT source, CASE WHEN {_N_FIRED} >= 3 THEN 'translationese' ELSE 'kept' END AS reason, count(*) AS rows, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY source), 6) AS share FROM ({_features(f'(SELECT * FROM {A} WHERE answer <> {chr(39) * 2} AND source IS NOT NULL)', 'answer')}) GROUP BY 1, 2")
def translation_filter_reasons(spark, sf):
    judged = filters.translation_filter(_answers(spark, sf).where("source is not null"), "answer")
    return filters.reasons(judged, "source").select("source", "reason", "rows", "share")


@query(f"SELECT CASE WHEN n >= 2 AND score < 0.8 THEN 'mixed' WHEN n > 0 AND dominant <> '합쇼체' THEN 'off_target' ELSE 'kept' END AS reason, count(*) AS rows FROM ({_summary(A, 'chat_id', 'answer')}) GROUP BY 1")
def register_filter_reasons(spark, sf):
    return filters.register_filter(_answers(spark, sf), "answer", target="합쇼체").groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


@query(f"""SELECT reason, count(*) AS rows FROM (SELECT CASE WHEN g.exemplar_id IS NULL THEN 'unparsed' WHEN {_share('g.a', 'Hangul')} < 0.7 THEN 'language' WHEN NOT {_overlap(_content('q.passage'), _content('g.a'))} > 0.1 THEN 'unfaithful' ELSE 'kept' END AS reason
    FROM (SELECT * FROM {Q} WHERE question IS NOT NULL AND answer IS NOT NULL AND passage IS NOT NULL) q LEFT JOIN {_PARSED} g ON g.exemplar_id = q.exemplar_id) GROUP BY reason""")
def grounded_filter_reasons(spark, sf):
    whole = _passages(spark, sf).where("question is not null and answer is not null and passage is not null").select("passage", F.concat("question", F.lit("\n답: "), "answer").alias("said"))
    return filters.grounded_filter(whole, "qa", "said", "passage").groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


@query(f"SELECT {_strip('question')} AS problem, replace({_strip('gold')}, ',', '') AS gold FROM (SELECT DISTINCT ON (pred_id) pred_id::VARCHAR AS question, gold FROM predictions) WHERE question <> '' AND gold IS NOT NULL AND regexp_matches(replace({_strip('gold')}, ',', ''), '^-?[0-9]+(?:\\.[0-9]+)?$')")
def converted_worked(spark, sf):
    df = _outputs(spark, sf).select(F.col("pred_id").cast("string").alias("question"), F.concat(F.coalesce("prediction", F.lit("")), F.lit(" #### "), "gold").alias("answer"))
    return filters.from_worked_answers(df)


@query(f"SELECT {_strip('prediction')} AS problem, {_strip('gold')} AS gold FROM {P} WHERE {_strip('prediction')} <> '' AND gold IS NOT NULL")
def converted_plain(spark, sf):
    return filters.from_plain_answers(_outputs(spark, sf), "prediction", "gold")


@query(f"SELECT pred_id::VARCHAR AS problem, '\\frac{{' || {_strip('gold')} || '}}{{2}}' AS gold FROM {P} WHERE gold IS NOT NULL")
def converted_boxed(spark, sf):
    said = F.concat(F.lit("\\boxed{1} 따라서 \\boxed{ \\frac{"), text.strip("gold"), F.lit("}{2} }입니다"))
    return filters.from_boxed_solutions(_outputs(spark, sf).select(F.col("pred_id").cast("string").alias("problem"), said.alias("solution")))


@query(f"SELECT 'Complete the following Python function:' || chr(10) || chr(10) || '```python' || chr(10) || prediction || '```' AS problem, 'def check(f): pass' || chr(10) || chr(10) || 'check(' || run_id || ')' AS tests FROM {P} WHERE prediction <> '' AND run_id <> ''")
def converted_functions(spark, sf):
    df = _outputs(spark, sf).withColumn("test", F.lit("def check(f): pass"))
    return filters.from_function_tests(df, "prediction", "test", "run_id").select("problem", "gold.tests")


@query(f"SELECT {_strip('prediction')} || chr(10) || chr(10) || '다음은 실례 테스트입니다:' || chr(10) || '```python' || chr(10) || 'assert ' || run_id || chr(10) || '```' AS problem, 'import x' || chr(10) || 'assert ' || run_id || chr(10) || 'assert 1' AS tests FROM {P} WHERE {_strip('prediction')} <> '' AND run_id IS NOT NULL")
def converted_assertions(spark, sf):
    df = _outputs(spark, sf).where("run_id is not null").withColumn("tests", F.array(F.concat(F.lit("assert "), "run_id"), F.lit("assert 1"))).withColumn("setup", F.lit("import x"))
    return filters.from_assertions(df, "prediction", "tests", "setup").select("problem", "gold.tests")


@query(f"SELECT {_strip('question')} || chr(10) || chr(10) || 'A) ' || passage || chr(10) || 'B) ' || answer AS problem, chr((65 + exemplar_id % 2)::INT) AS gold, 2 AS n_options FROM {Q} WHERE {_strip('question')} <> '' AND passage IS NOT NULL AND answer IS NOT NULL")
def converted_choices(spark, sf):
    df = _passages(spark, sf).where("passage is not null and answer is not null").withColumn("choices", F.array("passage", "answer"))
    return filters.from_choices(df.withColumn("label", F.col("exemplar_id") % 2 + 1), "question", "choices", "label", one_based=True)


@query(f"SELECT doc_id FROM documents WHERE {_strip('text')} <> ''")
def blank_drop(spark, sf):
    return filters.drop_blank(_docs(spark, sf)).select("doc_id")


# --- preferences, majorities, flows ----------------------------------------------------------------------------------


@query(f"SELECT pred_id, CASE WHEN a = 'A' THEN 'x' ELSE 'y' END AS chosen, CASE WHEN a = 'A' THEN 'y' ELSE 'x' END AS rejected FROM (SELECT pred_id, CASE pred_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END AS a, CASE pred_id % 2 WHEN 0 THEN 'B' ELSE 'A' END AS b FROM {P}) WHERE a IS NOT NULL AND a <> b")
def judged_pairs(spark, sf):
    df = _outputs(spark, sf).select("pred_id", F.when(F.col("pred_id") % 3 == 0, "A").when(F.col("pred_id") % 3 == 1, "B").alias("verdict_1"), F.when(F.col("pred_id") % 2 == 0, "B").otherwise("A").alias("verdict_2"), F.lit("x").alias("response_a"), F.lit("y").alias("response_b"))
    return prefer.judged(df).select("pred_id", "chosen", "rejected")


_CLUSTERS = f"(SELECT run_id AS prompt_id, pred_id AS sample_id, first_value(pred_id) OVER (PARTITION BY run_id, gold ORDER BY pred_id) AS leader, prediction AS response FROM {P} WHERE run_id IS NOT NULL AND gold IS NOT NULL AND prediction IS NOT NULL)"


def _clusters(spark, sf):
    df = _outputs(spark, sf).where("run_id is not null and gold is not null and prediction is not null")
    lead = df.groupBy("run_id", "gold").agg(F.min("pred_id").alias("leader"))
    rows = df.join(lead, ["run_id", "gold"])
    return rows.select(F.col("run_id").alias("prompt_id"), F.col("pred_id").alias("sample_id"), "leader"), rows.select(F.col("run_id").alias("prompt_id"), F.col("pred_id").alias("sample_id"), F.col("prediction").alias("response"))


_BEST = f"(SELECT prompt_id, leader, size FROM (SELECT prompt_id, leader, count(*) AS size, row_number() OVER (PARTITION BY prompt_id ORDER BY count(*) DESC, leader) AS k FROM {_CLUSTERS} GROUP BY prompt_id, leader) WHERE k = 1 AND size / 8.0 >= 0.5)"


@query(f"SELECT prompt_id, leader, size FROM {_BEST}")
def majorities(spark, sf):
    return cluster.majority(_clusters(spark, sf)[0], 8)


@query(f"SELECT prompt_id, sample_id FROM (SELECT c.prompt_id, sample_id, row_number() OVER (PARTITION BY c.prompt_id ORDER BY length(response), sample_id) AS k FROM {_CLUSTERS} c JOIN {_BEST} b ON b.prompt_id = c.prompt_id AND b.leader = c.leader) WHERE k = 1")
def shortest_of_majority(spark, sf):
    clusters, samples = _clusters(spark, sf)
    return cluster.shortest(samples, clusters, cluster.majority(clusters, 8)).select("prompt_id", "sample_id")


REPLIES = ["먼저 물을 잰다. 따라서 값은 셋이다. 결론은 이 값이 언제나 알맞다는 것이며 다음 날에도 같은 방법으로 다시 재어 보면 된다.", "모른다", "1. 물을 잰다\n2. 값을 적는다\n3. 값을 견준다. 그러므로 최종답은 넷이며 이는 앞에서 적은 모든 값과 잘 맞는다는 것을 누구나 다시 확인할 수 있다."]
SYSTEM = "단계별로 답하시오."


def _fake(prompt: str, n: str = "0") -> str:
    cases = " ".join(f"WHEN {k} THEN {_lit(x)}" for k, x in enumerate(REPLIES))
    return f"CASE ('0x' || substr(md5({prompt} || '|{n}'), 1, 12))::BIGINT % {len(REPLIES)} {cases} END"


@query(f"SELECT prompt, said, CASE WHEN length(said) BETWEEN 60 AND 6000 AND {_share('said', 'Hangul')} >= 0.7 AND {_STEPS.replace('prediction', 'said')} THEN NULL ELSE 'no_steps' END AS reason FROM (SELECT prompt, {_fake('ask')} AS said FROM (SELECT question AS prompt, '[{{\"role\":\"system\",\"content\":\"{SYSTEM}\"}},{{\"role\":\"user\",\"content\":' || to_json(question) || '}}]' AS ask FROM {Q} WHERE question IS NOT NULL AND NOT regexp_matches(question, '[\\x00-\\x1f\\\\/\\x7f-\\x{{9f}}\\x{{2028}}\\x{{2029}}\\x{{feff}}]')))")
def distilled_steps(spark, sf):
    plain = _passages(spark, sf).where("question is not null").where(~F.col("question").rlike("[\\x00-\\x1f\\\\\\\\/\\x7f-\\x{9f}\\x{2028}\\x{2029}\\x{feff}]"))  # engines escape these differently
    out = flows.distilled(plain.select(F.col("question").alias("prompt")), hooks.fake_model(REPLIES), SYSTEM)
    return out.select("prompt", F.col("messages")[1]["content"].alias("said"), "reason")


@query(f"SELECT exemplar_id, lex, round(pmi, 6) AS pmi, CASE WHEN {_share('answer', 'Hangul')} >= 0.7 AND lex >= 0.05 AND (pmi >= 2.0 OR margin >= 0.5) THEN NULL ELSE 'unfaithful' END AS reason FROM (SELECT exemplar_id, answer, round({_overlap('s', 'a')}, 6) AS lex, w - o AS pmi, y - n AS margin FROM (SELECT exemplar_id, answer, {_content('passage').replace(chr(39) + '위해' + chr(39), chr(39) + '위하여' + chr(39)).replace(chr(39) + '대해' + chr(39), chr(39) + '대하여' + chr(39))} AS s, {_content('answer').replace(chr(39) + '위해' + chr(39), chr(39) + '위하여' + chr(39)).replace(chr(39) + '대해' + chr(39), chr(39) + '대하여' + chr(39))} AS a, " + ", ".join(f"-(('0x' || substr(md5({ask}), 1, 6))::BIGINT % 1000)::DOUBLE / 100 AS {name}" for name, ask in {
    "w": f"'단락: ' || passage || {_lit(chr(10) + '답: ')} || '|' || answer", "o": "'답: |' || answer",
    "y": f"{_lit(_SUPPORTED)} || passage || {_lit(chr(10) + '주장: ')} || answer || {_lit(chr(10) + _ASKS)} || '| 예'", "n": f"{_lit(_SUPPORTED)} || passage || {_lit(chr(10) + '주장: ')} || answer || {_lit(chr(10) + _ASKS)} || '| 아니'",
}.items()) + f" FROM {Q} WHERE passage IS NOT NULL AND answer IS NOT NULL))")
def faithful_answers(spark, sf):
    df = _passages(spark, sf).where("passage is not null and answer is not null")
    out = flows.faithfulness(df, hooks.fake_scorer(), SUPPORT)
    return out.select("exemplar_id", F.round("lex", 6).alias("lex"), F.round("pmi", 6).alias("pmi"), "reason")


@query(f"SELECT chat_id, n, reason FROM (SELECT chat_id, len(messages)::INT AS n, CASE WHEN len(list_filter(messages, lambda m: m.role = 'assistant' AND ({_share('m.content', 'Hangul', '1.0')}) < 0.6)) > 0 THEN 'low_language' END AS reason FROM (SELECT DISTINCT ON (chat_id) * FROM chats WHERE messages IS NOT NULL))")
def translated_chats(spark, sf):
    """With a mapper that changes nothing: Markdown must come through whole, so the language check is that of the source."""
    chats = _table(spark, sf, "chats", None, "chat_id", "messages").where("messages is not null")
    out = flows.translated_chats(chats, lambda t: t)
    return out.select("chat_id", F.size("messages").alias("n"), "reason").dropDuplicates(["chat_id"])


@query("SELECT doc_id, text AS mapped FROM documents WHERE text IS NOT NULL")
def markdown_identity(spark, sf):
    """A mapper that changes nothing gives the document back."""
    return flows.translated_problems(_docs(spark, sf).where("text is not null").select("doc_id", F.col("text").alias("mapped")), lambda t: t, column="mapped")


@query("SELECT kind, count(*) AS docs, count(text) AS texts FROM documents GROUP BY kind")
def sql_views(spark, sf):
    io.register(spark, sf, "documents")
    return spark.sql("SELECT kind, count(*) AS docs, count(text) AS texts FROM documents GROUP BY kind")


# --- vocabularies, quotas, reports -----------------------------------------------------------------------------------

_MERGES = "SELECT DISTINCT substr(w, 1, 1) AS l, substr(w, 2) AS r FROM (SELECT unnest({}) AS w FROM documents WHERE kind = '{}' AND text IS NOT NULL) WHERE length(w) BETWEEN 2 AND 4"


def _merges_sql(kind: str) -> str:
    return f"(SELECT row_number() OVER (ORDER BY l, r) - 1 AS rank, l, r FROM ({_MERGES.format(_words('text'), kind)}))"


def _merges(spark, sf, kind: str):
    w = _docs(spark, sf).where((F.col("kind") == kind) & F.col("text").isNotNull()).select(F.explode(text.words("text")).alias("w")).where(F.length("w").between(2, 4))
    pairs = w.select(F.left("w", F.lit(1)).alias("left"), F.substr("w", F.lit(2)).alias("right")).distinct()
    return numbered(pairs, "left", "right", name="rank")[0].select("rank", "left", "right")


_KNOWN = f"(SELECT DISTINCT unnest({_words('text')}) AS t FROM documents WHERE kind IN ('qa', 'cot', 'passage') AND text IS NOT NULL)"


def _known(spark, sf):
    return _docs(spark, sf).where("kind in ('qa', 'cot', 'passage') and text is not null").select(F.explode(text.words("text")).alias("token")).distinct()


@query(f"WITH b AS {_merges_sql('qa')}, e AS {_merges_sql('cot')} SELECT 0 AS source, rank, l AS \"left\", r AS \"right\" FROM b UNION ALL SELECT 1, rank, l, r FROM e WHERE (l, r) NOT IN (SELECT (l, r) FROM b) AND l IN (SELECT t FROM {_KNOWN}) AND r IN (SELECT t FROM {_KNOWN}) AND l || r IN (SELECT t FROM {_KNOWN})")
def merge_union(spark, sf):
    return vocab.merge_union(_merges(spark, sf, "qa"), _merges(spark, sf, "cot"), _known(spark, sf))


@query(f"WITH b AS {_merges_sql('qa')}, e AS {_merges_sql('cot')} SELECT rank, l AS \"left\", r AS \"right\" FROM b WHERE l || r NOT IN (SELECT l || r FROM e)")
def merge_filter(spark, sf):
    removed = _merges(spark, sf, "cot").select(F.concat("left", "right").alias("token"))
    return vocab.merge_filter(_merges(spark, sf, "qa"), removed)


@query(f"SELECT kind, doc_id FROM (SELECT kind, doc_id, row_number() OVER (PARTITION BY kind ORDER BY {_hash('0', 'doc_id')}, doc_id) AS k, CASE kind WHEN 'qa' THEN 25 WHEN 'cot' THEN 10 END AS q FROM documents) WHERE k <= q")
def quota_rows(spark, sf):
    quotas = spark.createDataFrame([("qa", 25), ("cot", 10)], "kind string, quota int")
    return stats.quota(_docs(spark, sf).select("doc_id", "kind"), quotas, "doc_id", by="kind").select("kind", "doc_id")


_VOTES = f"(SELECT length(prediction)::BIGINT AS item, coalesce(verifier, 'none') AS label, pred_id % 5 + 1 AS rating, run_id AS annotator FROM {P} WHERE prediction IS NOT NULL)"


def _votes(spark, sf):
    df = _outputs(spark, sf).where("prediction is not null")
    return df.select(F.length("prediction").cast("bigint").alias("item"), F.coalesce("verifier", F.lit("none")).alias("label"), (F.col("pred_id") % 5 + 1).alias("rating"), F.col("run_id").alias("annotator"))


@query(f"SELECT item, n, CASE WHEN c >= 2 THEN label END AS label, CASE WHEN c = n THEN 'unanimous' WHEN c >= 2 THEN 'majority' ELSE 'escalate' END AS status FROM (SELECT item, label, count(*) AS c, sum(count(*)) OVER (PARTITION BY item)::BIGINT AS n, row_number() OVER (PARTITION BY item ORDER BY count(*) DESC, label DESC) AS k FROM {_VOTES} GROUP BY item, label) WHERE k = 1")
def adjudicated_labels(spark, sf):
    return stats.adjudicated(_votes(spark, sf))


@query(f"SELECT item, CASE WHEN max(rating) - min(rating) < 2 THEN round(avg(rating), 6) END AS rating, CASE WHEN max(rating) - min(rating) < 2 THEN 'average' ELSE 'escalate' END AS status FROM {_VOTES} GROUP BY item")
def rated_items(spark, sf):
    return stats.rated(_votes(spark, sf))


@query(f"SELECT annotator, n, agreement, CASE WHEN agreement >= 0.9 THEN 'good' WHEN agreement >= 0.85 THEN 'watch' ELSE 'retrain' END AS band FROM (SELECT annotator, count(*) AS n, round(avg((label = 'math')::INT::DOUBLE), 6) AS agreement FROM {_VOTES} GROUP BY annotator)")
def gold_bands(spark, sf):
    return stats.gold_bands(_votes(spark, sf).withColumn("gold", F.lit("math")))


@query(f"SELECT sum(length(text))::BIGINT AS chars, sum(length(regexp_replace(text, '[^\\p{{Hangul}}]', '', 'g')))::BIGINT AS hangul, sum(len(w))::BIGINT AS words, sum(len(w))::BIGINT AS tokens, round(1.0, 6)::DOUBLE AS tokens_per_word, round(sum(len(w))::DOUBLE / sum(length(text)), 6) AS tokens_per_char, round(sum(len(list_filter(w, lambda x: length(x) <= 2)))::DOUBLE / sum(len(w)), 6) AS short_share FROM (SELECT text, {_words('text')} AS w FROM documents WHERE text IS NOT NULL)")
def fertility(spark, sf):
    return report.fertility(_docs(spark, sf).where("text is not null"), "text", text.words("text"))


@query(f"SELECT exemplar_id, audience, register FROM {Q}, (SELECT unnest(['일반', '전문가']) AS audience), (SELECT unnest(['합쇼체', '해요체', '문어체']) AS register)")
def setting_sweep(spark, sf):
    return blend.sweep(_passages(spark, sf).select("exemplar_id"), audience=["일반", "전문가"], register=["합쇼체", "해요체", "문어체"])


@query("SELECT count(*) AS docs, round(avg(n), 6) AS mean_tokens, max(n)::BIGINT AS max_tokens FROM (SELECT len(" + _words("text") + ") AS n FROM documents WHERE text IS NOT NULL)")
def corpus_sizes(spark, sf):
    return pack.sizes(_docs(spark, sf).where("text is not null"), text.word_count("text"))


_AUDIT = f"SELECT (SELECT count(*) - count(DISTINCT question) FROM {Q} WHERE question IS NOT NULL) AS exact, (SELECT count(*) FILTER ({_share('question', 'Hangul')} < 0.7) FROM {Q} WHERE question IS NOT NULL) AS low_hangul"


@query(_AUDIT)
def seed_audit(spark, sf):
    return cluster.duplicate_audit(_passages(spark, sf).where("question is not null"), "question", id="exemplar_id").select("exact", "low_hangul")


@query("SELECT doc_id, CASE WHEN text IS NULL OR length(text) NOT BETWEEN 100 AND 2000 THEN 'length' WHEN doc_id <> min(doc_id) FILTER (length(text) BETWEEN 100 AND 2000) OVER (PARTITION BY text) THEN 'copy' ELSE 'other' END AS reason FROM documents")
def passage_pool(spark, sf):
    items = spark.read.parquet(f"{sf}/eval_items.parquet").select("text").where("text is not null")
    out = cluster.passage_pool(_docs(spark, sf).select("doc_id", "text"), items, id="doc_id")
    return out.select("doc_id", F.when(F.col("reason").isin("length", "copy"), F.col("reason")).otherwise("other").alias("reason"))
