"""Queries of the core operators over whole test tables, and their equivalents in plain SQL.

A delivery may come twice: every query counts an id of chats, predictions and exemplars once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import chat, markdown, text, verify
from .functions import profiles as p
from .operators import blend, cluster, filters, pack, prefer, report, stats, vocab
from .operators.common import numbered, spread

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def _counts(sql: str) -> str:
    """count_if as a filtered count, which is a BIGINT in any engine."""
    while (at := sql.find("count_if(")) >= 0:
        depth, end = 0, at + len("count_if")
        while True:
            depth += (sql[end] == "(") - (sql[end] == ")")
            end += 1
            if not depth:
                break
        sql = f"{sql[:at]}count(*) FILTER {sql[at + len('count_if') : end]}{sql[end:]}"
    return sql


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = _counts(sql)
        return f

    return add


def queries() -> dict[str, Query]:
    from . import catalog_rows  # noqa: F401  (adds its queries)

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    from . import catalog_rows  # noqa: F401

    return dict(_sql)


def _table(spark: SparkSession, sf: str, name: str, key: str | None = None, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    df = df.select(*columns) if columns else df
    return df.dropDuplicates([key]) if key else spread(df)


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents", None, "doc_id", "text", "lang", "source", "kind", "n_chars")


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """First answers; deliveries are made distinct after all but the answer is left out."""
    return _table(spark, sf, "chats", None, "chat_id", "messages", "source").select("chat_id", "source", chat.first_assistant().alias("answer")).dropDuplicates(["chat_id"])


def _outputs(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "predictions", "pred_id", "pred_id", "run_id", "prediction", "lang", "gold", "n_options", "verifier", "source")


def _passages(spark: SparkSession, sf: str) -> DataFrame:
    df = _table(spark, sf, "exemplars_qa_hapsyo", "exemplar_id", "exemplar_id", "`단락`", "`질문`", "`답`")
    return df.withColumnsRenamed({"단락": "passage", "질문": "question", "답": "answer"})


# --- the same building blocks in SQL; its regular expressions know no Unicode \s and no lookaround -------------------

WS = r"[\s\x0b\x{85}\p{Z}]"
A = r"(SELECT chat_id, messages, source, coalesce(list_filter(messages, lambda m: m.role = 'assistant')[1].content, '') AS answer FROM (SELECT DISTINCT ON (chat_id) * FROM chats))"
P = "(SELECT DISTINCT ON (pred_id) * FROM predictions)"
Q = '(SELECT exemplar_id, "단락" AS passage, "질문" AS question, "답" AS answer FROM (SELECT DISTINCT ON (exemplar_id) * FROM exemplars_qa_hapsyo))'


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> '')"


def _letters(x: str) -> str:
    return rf"length(regexp_replace({x}, '[^\p{{L}}]', '', 'g'))"


def _share(x: str, script: str, empty: str = "0.0") -> str:
    return rf"CASE WHEN {_letters(x)} = 0 THEN {empty} ELSE length(regexp_replace(regexp_replace({x}, '[^\p{{L}}]', '', 'g'), '[^\p{{{script}}}]', '', 'g'))::DOUBLE / {_letters(x)} END"


def _sentences(x: str) -> str:
    return rf"list_filter(list_transform(string_split_regex({x}, '[.!?。…\n]+'), lambda s: {_strip('s')}), lambda s: s <> '')"


def _scrub(x: str) -> str:
    for pattern in ("(?s)```.*?```", "`[^`]*`", "「[^」]*」", "『[^』]*』", r'"[^"\n]{1,200}"', r"''[^''\n]{1,200}''"):
        x = f"regexp_replace({x}, '{pattern}', ' ', 'g')"
    return x


def _level(s: str) -> str:
    body = rf"regexp_replace({s}, '[。.?!…」』\"'')~]+$', '')"
    item = rf"({s} = '' OR (regexp_matches({s}, '^(?:[-*•]{WS}|\p{{Nd}}+[.)]{WS}|[①-⑳])') AND length({s}) < 60))"
    alone = " ".join(f"WHEN {body} = '{k}' THEN '{v}'" for k, v in p.REGISTER_ALONE.items())
    ends = " ".join(f"WHEN regexp_matches({body}, '(?:{'|'.join(p.REGISTER_ENDINGS[k])})$') THEN '{k}'" for k in p.REGISTERS)
    return f"CASE WHEN {body} = '' OR {item} THEN 'neutral' {alone} {ends} ELSE 'neutral' END"


def _summary(source: str, key: str, x: str) -> str:
    """SELECT key, score, dominant, n of a text."""
    counts = ", ".join(f"len(list_filter(l, lambda v: v = '{k}')) AS c{i}" for i, k in enumerate(p.REGISTERS))
    dominant = " ".join(f"WHEN c{i} = greatest(c0, c1, c2, c3) THEN '{k}'" for i, k in enumerate(p.REGISTERS))
    return f"""SELECT *, CASE WHEN n = 0 THEN 1.0 ELSE greatest(c0, c1, c2, c3)::DOUBLE / n END AS score, CASE WHEN n = 0 THEN NULL {dominant} END AS dominant FROM (
        SELECT *, c0 + c1 + c2 + c3 AS n FROM (SELECT *, {counts} FROM (SELECT *, list_transform({_sentences(_scrub(x))}, lambda s: {_level("s")}) AS l FROM {source})))"""


def _features(source: str, x: str) -> str:
    """SELECT *, and the nine features of a text; the character after a word is matched, not looked at, so spaces are doubled where one may also open a match."""
    after = r"(?:[^\p{L}\p{N}_]|$)"
    uni = lambda s: s.replace(r"\s", WS)
    word = {name: f"len(regexp_extract_all({x}, '{uni(body)}{after}'))" for name, body in {
        "pronoun_per_100c": f"{text.any_of(p.PRONOUNS)}{text.any_of(p.PRONOUN_PARTICLES)}",
        "passive_per_100c": text.any_of(p.PASSIVES),
        "deul_per_100c": f"들{text.any_of(p.PLURAL_PARTICLES)}",
    }.items()}
    doubled = rf"regexp_replace({x}, '({WS}|\()', '\1\1', 'g')"
    word["dem_dep_per_100c"] = rf"len(regexp_extract_all({doubled}, '(?:^|{WS}|\()[이그저]{WS}+{text.any_of(p.DEPENDENT_NOUNS)}{text.any_of(p.DEPENDENT_PARTICLES)}?{after}'))"
    chain = rf"[가-힣]{{1,8}}의{WS}+[가-힣]{{1,8}}의"
    word["chain_med_per_100c"] = f"len(regexp_extract_all({x}, '{chain}'))"
    per = ", ".join(f"100.0 * {body} / greatest(length({x}), 1) AS {name}" for name, body in word.items())
    connective = uni(rf"(?:^|[.!?。…]\s*){text.any_of(p.CONNECTIVES)}")
    thing = f"len(list_filter(sents, lambda s: regexp_matches(s || '.', '것{text.any_of(p.THING_ENDINGS)}[.?!]?{WS}*$')))"
    return f"""SELECT *, {per}, len(regexp_extract_all({x}, '{connective}'))::DOUBLE / greatest(len(sents), 1) AS connective_per_sent, {thing}::DOUBLE / greatest(len(sents), 1) AS thing_end_ratio,
        len(regexp_extract_all({x}, '{chain}{WS}+[가-힣]{{1,8}}의'))::DOUBLE AS chain_deep_count, coalesce(list_sum(list_transform(sents, lambda s: length(s))), 0)::DOUBLE / greatest(len(sents), 1) AS sent_len_mean
        FROM (SELECT *, {_sentences(x)} AS sents FROM {source})"""


_N_FIRED = " + ".join(f"({name} > {limit})::INT" for name, limit in p.THRESHOLDS.items())


def _hash(seed: str, *keys: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(f'({k})::VARCHAR' for k in keys)})), 1, 15))::BIGINT"


def _content(x: str, hangul: bool = True) -> str:
    edge = r"[。.,?!\"''()\[\]{}:;…·]"
    stem = f"regexp_replace(regexp_replace(w, '^{edge}+|{edge}+$', '', 'g'), '^(.{{2,}}?)(?:{'|'.join(p.PARTICLES)})$', '\\1')"
    stop = ", ".join(f"'{w}'" for w in p.STOP_WORDS)
    return f"list_distinct(list_filter(list_transform({_words(x)}, lambda w: {stem}), lambda w: length(w) >= 2 AND w NOT IN ({stop})" + (f" AND {_share('w', 'Hangul')} > 0.5" if hangul else "") + "))"


_D = r"\p{Nd}"
_NUM = rf"-?{_D}+(?:[,{_D}]*{_D})?(?:\.{_D}+)?(?:/-?{_D}+)?"


def _last(x: str, pattern: str) -> str:
    return f"list_extract(regexp_extract_all({x}, '{pattern}', 1), -1)"


def _final_answer(x: str) -> str:
    marks = [m.replace(verify.NUMBER, _NUM).replace(r"\s", WS).replace("'", "''") for m in verify.ANSWER_MARKS]
    found = ", ".join(_last(x, m) for m in [*marks[::-1], rf"={WS}*({_NUM})", f"({_NUM})"])
    return _strip(f"coalesce({found})")


def _number(x: str) -> str:
    s = rf"regexp_replace(regexp_replace({x}, '[, ]', '', 'g'), '[^0-9./\-]', '', 'g')"
    part = lambda k: f"try_cast(split_part({s}, '/', {k}) AS DOUBLE)"
    return rf"CASE WHEN regexp_matches({s}, '^-?[0-9]+/[0-9]+$') THEN CASE WHEN {part(2)} <> 0 THEN {part(1)} / {part(2)} END WHEN regexp_matches({s}, '^-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)$') THEN try_cast({s} AS DOUBLE) END"


def _option(x: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in p.OPTIONS.items())
    return f"CASE {x} {cases} ELSE upper({x}) END"


def _choice(x: str, n: str) -> str:
    def possible(label: str) -> str:
        letter = _option(label)
        return f"CASE WHEN regexp_matches({letter}, '^[A-Z]$') AND ascii({letter}) - 65 < {n} THEN {letter} END"

    marks = [m.replace(r"\s", WS) for m in verify.OPTION_MARKS]
    doubled = rf"regexp_replace({x}, '([^A-Za-z가-힣])', '\1\1', 'g')"
    lone = f"regexp_extract_all({doubled}, '(?:^|[^A-Za-z가-힣])({verify.LABEL_WITHOUT_DIGITS})(?:$|[^A-Za-z가-힣])', 1)"
    alone = f"list_extract(list_filter(list_transform({lone}, lambda v: {possible('v')}), lambda v: v IS NOT NULL), -1)"
    return f"CASE WHEN {n} BETWEEN 1 AND 26 THEN coalesce({', '.join(possible(_last(x, m)) for m in marks)}, {alone}) END"


_GRADED = f"""(SELECT *, CASE verifier WHEN 'math' THEN coalesce(abs({_number("fin")} - {_number("gold")}) <= 0.0001, false) WHEN 'mcq' THEN coalesce(g1 <> '' AND choice = {_option("g1")}, false) END AS verified FROM (
    SELECT *, {_final_answer("prediction")} AS fin, {_choice("prediction", "coalesce(n_options, 4)")} AS choice, left({_strip("gold")}, 1) AS g1 FROM {P}))"""


# --- text features ------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, round({_share('text', 'Hangul')}, 6) AS hangul, round({_share('text', 'Latin')}, 6) AS latin FROM documents WHERE text IS NOT NULL")
def script_fraction(spark, sf):
    return _docs(spark, sf).where("text is not null").select("doc_id", F.round(text.hangul_fraction("text"), 6).alias("hangul"), F.round(text.latin_fraction("text"), 6).alias("latin"))


@query(f"SELECT source, count(*) AS docs, count_if({_letters('text')} > 0 AND ({_share('text', 'Hangul')} < 0.6 OR {_share('text', 'Latin')} > 0.15)) AS switched FROM documents WHERE text IS NOT NULL GROUP BY source")
def code_switch(spark, sf):
    return _docs(spark, sf).where("text is not null").groupBy("source").agg(F.count("*").alias("docs"), F.count_if(text.code_switched("text")).alias("switched"))


@query(f"SELECT chat_id, answer FROM {A}")
def assistant_first_turn(spark, sf):
    return _answers(spark, sf).select("chat_id", "answer")


@query(f"SELECT chat_id, round(score, 6) AS score, dominant, n::INT AS n FROM ({_summary(A, 'chat_id', 'answer')})")
def register_dominant(spark, sf):
    return _answers(spark, sf).select("chat_id", text.register_summary(text.registers("answer")).alias("r")).select("chat_id", F.round("r.score", 6).alias("score"), "r.dominant", "r.n")


@query("SELECT doc_id, " + ", ".join(f"round({name}, 6) AS {name}" for name in p.THRESHOLDS) + f" FROM ({_features('(SELECT doc_id, text FROM documents WHERE text IS NOT NULL)', 'text')})")
def surface_features(spark, sf):
    f = _docs(spark, sf).where("text is not null").select("doc_id", text.translation_features("text").alias("f"))
    return f.select("doc_id", *(F.round(f"f.{name}", 6).alias(name) for name in p.THRESHOLDS))


_LONG = f"SELECT * FROM (UNPIVOT (SELECT chat_id, source, {', '.join(p.THRESHOLDS)} FROM ({_features(f'(SELECT * FROM {A} WHERE answer <> {chr(39) * 2})', 'answer')})) ON {', '.join(p.THRESHOLDS)} INTO NAME feature VALUE value)"


@query(f"SELECT feature, count(*) AS rows FROM ({_LONG}) WHERE value > CASE feature {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {v}' for k, v in p.THRESHOLDS.items())} END GROUP BY feature")
def feature_fires(spark, sf):
    return report.fire_counts(_answers(spark, sf), "answer")


_NATIVE, _TRANSLATED = ("source = 'sft_native'", "source = 'sft_translated'")


@query(f"""WITH f AS ({_LONG}), r AS (SELECT feature, source, value, row_number() OVER (PARTITION BY feature, source ORDER BY value) AS k, count(*) OVER (PARTITION BY feature, source) AS n FROM f),
    t AS (SELECT a.feature, a.value AS p, b.value AS m FROM r a JOIN r b ON a.feature = b.feature WHERE a.{_NATIVE} AND b.{_TRANSLATED} AND a.k = floor(0.95 * (a.n - 1)) + 1 AND b.k = floor(0.5 * (b.n - 1)) + 1)
    SELECT feature, round_even(p, 4) AS threshold, round(m, 6) AS median, CASE WHEN p > 0 AND m > 2 * p THEN 'STRONG' WHEN m > p THEN 'weak' ELSE 'NONE' END AS separation FROM t""")  # fmt: skip
def calibrate_thresholds(spark, sf):
    a = _answers(spark, sf)
    return report.calibrate(a.where(_NATIVE), a.where(_TRANSLATED), "answer")


@query(f"""SELECT source, CASE WHEN answer = '' THEN 'kept' WHEN n >= 2 AND score < 0.8 THEN 'register_mix' WHEN {_N_FIRED} >= 3 THEN 'translationese' ELSE 'kept' END AS reason, count(*) AS rows
    FROM ({_features("(" + _summary(A, "chat_id", "answer") + ")", "answer")}) GROUP BY 1, 2""")  # fmt: skip
def pool_filter_reasons(spark, sf):
    return filters.pool_filter(_answers(spark, sf), "answer").groupBy("source", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


@query(f"SELECT source, count(*) AS chats, count_if(len(list_filter(messages, lambda m: m.role = 'assistant' AND ({_share('m.content', 'Hangul', '1.0')}) < 0.6)) > 0) AS flagged FROM {A} GROUP BY source")
def language_gate(spark, sf):
    flags = filters.language_gate(_table(spark, sf, "chats", None, "chat_id", "messages", "source")).select("chat_id", "source", "flagged").dropDuplicates(["chat_id"])
    return flags.groupBy("source").agg(F.count("*").alias("chats"), F.count_if("flagged").alias("flagged"))


@query(f"""SELECT exemplar_id, round(CASE WHEN len(s) = 0 THEN 1.0 ELSE len(list_intersect(s, a))::DOUBLE / len(s) END, 6) AS overlap FROM (
    SELECT exemplar_id, {_content("passage")} AS s, {_content("answer")} AS a FROM {Q} WHERE passage IS NOT NULL AND answer IS NOT NULL)""")  # fmt: skip
def lexical_overlap(spark, sf):
    return _passages(spark, sf).where("passage is not null and answer is not null").select("exemplar_id", F.round(text.overlap(text.content_words("passage"), text.content_words("answer")), 6).alias("overlap"))


@query(f"""WITH w AS (SELECT doc_id, {_words("text")} AS t FROM documents WHERE text IS NOT NULL), g AS (SELECT doc_id, list_slice(t, i, i + 3) AS g FROM (SELECT doc_id, t, unnest(range(1, len(t) - 2)) AS i FROM w WHERE len(t) >= 12)),
    r AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) >= 3)) SELECT doc_id FROM r""")  # fmt: skip
def repetition_flag(spark, sf):
    return _docs(spark, sf).where("text is not null").where(text.repeats_ngram("text")).select("doc_id")


@query(f"SELECT pred_id, coalesce({_strip('CASE WHEN f <> ' + chr(39) * 2 + ' THEN f ELSE right(prediction, 300) END')}, '') AS span FROM (SELECT pred_id, prediction, regexp_extract(prediction, '(?s)^.*((?:{'|'.join(p.FINAL_MARKERS)}).*)$', 1) AS f FROM {P})")
def final_spans(spark, sf):
    return _outputs(spark, sf).select("pred_id", text.final_span("prediction").alias("span"))


@query(f"SELECT pred_id, coalesce(len(regexp_extract_all(prediction, '(?m)^{WS}*(?:[-*•]|[0-9]+[.)]){WS}+[^\\s\\x0b\\x{{85}}\\p{{Z}}]')), 0)::INT AS items FROM {P}")
def list_items(spark, sf):
    return _outputs(spark, sf).select("pred_id", verify.list_items("prediction").alias("items"))


@query()
def masked_spans(spark, sf):
    return _docs(spark, sf).where("text is not null").select("doc_id", markdown.masked_spans("text").alias("m")).select("doc_id", "m.*")


@query("SELECT n_chars = length(text) AS same, count(*) AS docs FROM documents WHERE text IS NOT NULL GROUP BY 1")
def code_points(spark, sf):
    return _docs(spark, sf).where("text is not null").groupBy((F.col("n_chars") == F.length("text")).alias("same")).agg(F.count("*").alias("docs"))


# --- verification, preference, evaluation -------------------------------------------------------------------------


def _graded(spark, sf) -> DataFrame:
    return _outputs(spark, sf).withColumn("verified", verify.verify("prediction", "gold", "verifier", "n_options"))


@query(f"SELECT pred_id, fin AS answer, verified FROM {_GRADED} WHERE verifier = 'math'")
def extract_number(spark, sf):
    df = _outputs(spark, sf).where("verifier = 'math'")
    return df.select("pred_id", verify.final_answer("prediction").alias("answer"), verify.verify_number("prediction", "gold").alias("verified"))


@query(f"SELECT pred_id, choice, verified FROM {_GRADED} WHERE verifier = 'mcq'")
def extract_choice(spark, sf):
    df = _outputs(spark, sf).where("verifier = 'mcq'")
    return df.select("pred_id", verify.chosen_option("prediction", "n_options").alias("choice"), verify.verify_option("prediction", "gold", "n_options").alias("verified"))


_SLICES = f"""SELECT coalesce(lang, 'ko') AS lang, verified, n AS k, score, dominant, {_share("body", "Hangul", "1.0")} AS h, {_letters("body")} > 0 AND ({_share("body", "Hangul")} < 0.6 OR {_share("body", "Latin")} > 0.15) AS sw
    FROM ({_summary(f"(SELECT *, coalesce(prediction, {chr(39) * 2}) AS body FROM {_GRADED})", "pred_id", "body")})"""


@query(f"""SELECT CASE WHEN grouping(lang) = 1 THEN 'all' ELSE lang END AS lang, count(*) AS n, round(avg(verified::INT::DOUBLE), 6) AS accuracy, count(verified) AS n_graded, round(avg(h) FILTER (lang = 'ko'), 6) AS mean_hangul,
    round(avg(sw::INT::DOUBLE) FILTER (lang = 'ko'), 6) AS code_switch_rate, count_if(lang = 'ko' AND k >= 2) AS n_register_judged, round(avg(score) FILTER (lang = 'ko' AND k >= 2), 6) AS mean_register_score,
    round(avg((score < 0.8)::INT::DOUBLE) FILTER (lang = 'ko' AND k >= 2), 6) AS register_mix_rate, {", ".join(f"count_if(lang = 'ko' AND k >= 2 AND dominant = '{level}') AS n_{name}" for level, name in zip(p.REGISTERS, ("hapsyo", "haeyo", "muneo", "hae")))}
    FROM ({_SLICES}) GROUP BY ROLLUP (lang)""")  # fmt: skip
def eval_slices(spark, sf):
    every = _table(spark, sf, "predictions", None, "pred_id", "prediction", "lang", "gold", "n_options", "verifier")
    scored = report.scored(every, "prediction", verified=verify.verify("prediction", "gold", "verifier", "n_options")).drop("prediction", "gold", "n_options", "verifier")
    return report.eval_slices(scored.dropDuplicates(["pred_id"]))


def _samples(spark, sf) -> DataFrame:
    g = _graded(spark, sf).where("verified is not null")
    return g.select(F.col("run_id").alias("problem_id"), F.col("pred_id").alias("sample_id"), F.col("verified").alias("correct"), F.coalesce("prediction", F.lit("")).alias("response"))


_SAMPLES = f"(SELECT run_id AS problem_id, pred_id AS sample_id, verified AS correct, coalesce(prediction, '') AS response FROM {_GRADED} WHERE verified IS NOT NULL)"


@query(f"SELECT problem_id, sample_id FROM (SELECT *, row_number() OVER (PARTITION BY problem_id ORDER BY sample_id) AS k FROM {_SAMPLES} WHERE correct) WHERE k <= 2")
def rejection_topk(spark, sf):
    return prefer.accepted(_samples(spark, sf)).select("problem_id", "sample_id")


@query(f"""SELECT problem_id, chosen, rejected FROM (SELECT problem_id, arg_min(response, sample_id) FILTER (correct) AS chosen, arg_min(response, sample_id) FILTER (NOT correct) AS rejected, count_if(correct) AS a, count_if(NOT correct) AS b
    FROM {_SAMPLES} GROUP BY problem_id) WHERE a > 0 AND b > 0""")  # fmt: skip
def dpo_pairs(spark, sf):
    return prefer.sample_pairs(_samples(spark, sf))


@query(f"SELECT problem_id FROM {_SAMPLES} GROUP BY problem_id HAVING count_if(correct) = 0")
def unsolved_anti(spark, sf):
    s = _samples(spark, sf)
    return prefer.unsolved(s.select("problem_id").distinct(), s)


@query(f"SELECT count(*) AS problems, sum(s)::BIGINT AS solved, round(sum(s)::DOUBLE / count(*), 6) AS rate FROM (SELECT problem_id, max(correct::INT) AS s FROM {_SAMPLES} GROUP BY problem_id)")
def solve_rate(spark, sf):
    return prefer.solve_rate(_samples(spark, sf))


@query(f"""WITH c AS (SELECT coalesce(lang, 'ko') AS lang, length(coalesce(prediction, '')) * 60 AS t, (pred_id % 5) * 0.25::DOUBLE AS depth, lower(regexp_replace(coalesce(prediction, ''), '{WS}+', '', 'g')) AS o, lower(regexp_replace(gold, '{WS}+', '', 'g')) AS g FROM {P} WHERE gold IS NOT NULL),
    h AS (SELECT lang, CASE WHEN t <= 6000 THEN 4000 WHEN t <= 12000 THEN 8000 WHEN t <= 24000 THEN 16000 ELSE 32000 END AS bucket, depth, contains(o, g)::INT::DOUBLE AS hit FROM c)
    SELECT lang, bucket, depth, count(*) AS n, round(avg(hit), 6) AS accuracy FROM h GROUP BY GROUPING SETS ((lang, bucket, depth), (lang))""")  # fmt: skip
def niah_grid(spark, sf):
    df = _outputs(spark, sf).where("gold is not null").withColumn("context_tokens", F.length(F.coalesce("prediction", F.lit(""))) * 60).withColumn("depth", (F.col("pred_id") % 5) * 0.25)
    return report.retrieval_grid(df, answer="gold")


@query(f"""WITH s AS (SELECT {_N_FIRED} AS s, source = 'sft_translated' AS t FROM ({_features(f"(SELECT * FROM {A} WHERE source IS NOT NULL)", "answer")})), c AS (SELECT unnest([1, 2, 3, 4]) AS cut),
    k AS (SELECT cut, count_if(s >= cut AND t) AS tp, count_if(s >= cut AND NOT t) AS fp, count_if(s < cut AND t) AS fn, count_if(s < cut AND NOT t) AS tn FROM s, c GROUP BY cut)
    SELECT *, CASE WHEN tp + fp > 0 THEN round(tp::DOUBLE / (tp + fp), 6) END AS precision, CASE WHEN tp + fn > 0 THEN round(tp::DOUBLE / (tp + fn), 6) END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN round(2.0 * tp / (2 * tp + fp + fn), 6) END AS f1 FROM k""")  # fmt: skip
def confusion_sweep(spark, sf):
    df = _answers(spark, sf).where("source is not null")
    return stats.confusion(df, F.size(text.fired(text.translation_features("answer"))), F.col("source") == "sft_translated", [1, 2, 3, 4])


@query(f"""WITH r AS (SELECT coalesce(verifier, 'none') AS x, CASE WHEN n_options IS NOT NULL THEN 'mcq' WHEN gold IS NOT NULL THEN 'math' ELSE 'none' END AS y FROM {P}), n AS (SELECT count(*)::DOUBLE AS n, count_if(x = y) AS s FROM r),
    e AS (SELECT sum(a.c * b.c)::DOUBLE AS e FROM (SELECT x, count(*) AS c FROM r GROUP BY x) a JOIN (SELECT y, count(*) AS c FROM r GROUP BY y) b ON a.x = b.y)
    SELECT n::BIGINT AS n, round(s / n, 6) AS observed, round(e / (n * n), 6) AS expected, round((s / n - e / (n * n)) / (1 - e / (n * n)), 6) AS kappa FROM n, e""")  # fmt: skip
def cohen_kappa(spark, sf):
    df = _outputs(spark, sf)
    return stats.kappa(df, F.coalesce("verifier", F.lit("none")), F.when(F.col("n_options").isNotNull(), "mcq").when(F.col("gold").isNotNull(), "math").otherwise("none"))


@query(f"SELECT count_if(a AND NOT b) AS only_a, count_if(NOT a AND b) AS only_b, CASE WHEN count_if(a <> b) > 0 THEN round(pow(greatest(abs(count_if(a AND NOT b) - count_if(NOT a AND b)) - 1, 0), 2)::DOUBLE / count_if(a <> b), 6) END AS chi2 FROM (SELECT verified AS a, length(prediction) > 100 AS b FROM {_GRADED} WHERE verified IS NOT NULL AND prediction IS NOT NULL)")
def mcnemar_test(spark, sf):
    df = _graded(spark, sf).where("verified is not null and prediction is not null")
    return stats.mcnemar(df, F.col("verified"), F.length("prediction") > 100)


@query("""WITH g AS (SELECT event_type, count(*) AS n, sum(value) AS s, sum(value * value) AS q FROM events WHERE value IS NOT NULL GROUP BY event_type)
    SELECT count(*) AS groups, sum(n)::BIGINT AS rows, round(((sum(s * s / n) - sum(s) * sum(s) / sum(n)) / (count(*) - 1)) / ((sum(q) - sum(s * s / n)) / (sum(n) - count(*))), 6) AS f FROM g""")
def anova_events(spark, sf):
    return stats.anova(spark.read.parquet(f"{sf}/events.parquet"), "event_type", "value")


# --- duplicates, packing, blending, diversity ----------------------------------------------------------------------


@query(f"SELECT min(doc_id) AS doc_id FROM (SELECT doc_id, {_strip('text')} AS t FROM documents WHERE text IS NOT NULL) WHERE length(t) >= 15 AND {_share('t', 'Hangul')} >= 0.5 GROUP BY t")
def exact_dedup(spark, sf):
    return cluster.exact_distinct(_docs(spark, sf).where("text is not null"), "text", id="doc_id").select("doc_id")


@query()
def near_dup_greedy(spark, sf):
    """Questions that are unlike every earlier kept one; held against a loop in the tests."""
    return cluster.greedy_distinct(_passages(spark, sf).where("question is not null"), "question", id="exemplar_id", threshold=0.7).select("exemplar_id", "question")


def _shingles(source: str, key: str) -> str:
    return f"SELECT DISTINCT {key} lower(array_to_string(list_slice(t, i, i + 4), ' ')) AS g FROM (SELECT *, unnest(range(1, len(t) - 3)) AS i FROM (SELECT *, {_words('lower(text)')} AS t FROM {source} WHERE text IS NOT NULL) WHERE len(t) >= 5)"


@query(f"SELECT d.doc_id, count(*) AS n_shared FROM ({_shingles('documents', 'doc_id,')}) d JOIN ({_shingles('eval_items', '')}) e ON d.g = e.g GROUP BY d.doc_id")
def shingle_leak(spark, sf):
    items = spark.read.parquet(f"{sf}/eval_items.parquet").select("text").where("text is not null")
    return cluster.excluded(_docs(spark, sf).select("doc_id", "text").where("text is not null"), items, id="doc_id")


_N = f"len({_words('text')})"


@query(f"""WITH RECURSIVE d AS (SELECT coalesce(source, '_all') AS key, doc_id, {_N}::BIGINT AS n, row_number() OVER (PARTITION BY coalesce(source, '_all') ORDER BY doc_id) AS k FROM documents WHERE text IS NOT NULL AND {_strip("text")} <> ''),
    r AS (SELECT key, k, n, 0::BIGINT AS pack, n AS held, n >= 300 OR n >= 1000 AS closed FROM d WHERE k = 1 UNION ALL
        SELECT d.key, d.k, d.n, r.pack + (r.closed OR d.n >= 300 OR r.held + d.n > 1000)::INT::BIGINT, CASE WHEN r.closed OR d.n >= 300 OR r.held + d.n > 1000 THEN d.n ELSE r.held + d.n END,
        d.n >= 300 OR CASE WHEN r.closed OR r.held + d.n > 1000 THEN d.n ELSE r.held + d.n END >= 1000 FROM r JOIN d ON d.key = r.key AND d.k = r.k + 1)
    SELECT r.key, pack, count(*) AS n_docs, sum(r.n)::BIGINT AS tokens, md5(string_agg(t.text, chr(10) || chr(10) ORDER BY r.k)) AS digest
    FROM r JOIN d ON d.key = r.key AND d.k = r.k JOIN documents t ON t.doc_id = d.doc_id GROUP BY r.key, pack""")  # fmt: skip
def pack_docs(spark, sf):
    return pack.pack(_docs(spark, sf), target=1000, least=300, key="source").select("key", "pack", "n_docs", "tokens", F.md5("text").alias("digest"))


_POOLS = "WITH a AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents WHERE kind = 'passage'), b AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents WHERE kind = 'qa')"


def _draws(pool: str, table: str, n: int) -> str:
    return f"SELECT '{pool}' AS pool, draw, t.doc_id, md5(t.text) AS digest FROM (SELECT unnest(range(0, {n})) AS draw) JOIN {table} t ON t.k = {_hash('7', chr(39) + pool + chr(39), 'draw')} % (SELECT count(*) FROM {table})"


@query(f"{_POOLS} {_draws('passages', 'a', 700)} UNION ALL {_draws('questions', 'b', 300)}")
def blend_sample(spark, sf):
    d = _docs(spark, sf).select("doc_id", "kind", "text")
    pools = {"passages": (d.where("kind = 'passage'"), "doc_id"), "questions": (d.where("kind = 'qa'"), "doc_id")}
    return blend.blend(pools, {"passages": 0.7, "questions": 0.3}, 1000, seed=7).select("pool", "draw", "doc_id", F.md5("text").alias("digest"))


@query("""WITH s AS (SELECT kind, sum(n_chars)::DOUBLE AS size, count(*)::DOUBLE AS w FROM documents WHERE n_chars IS NOT NULL GROUP BY kind)
    SELECT kind, round(w / sum(w) OVER (), 6) AS weight, round(1000000.0 * w / sum(w) OVER () / size, 6) AS epochs, 1000000.0 * w / sum(w) OVER () / size > 4 AS high FROM s""")
def blend_budget(spark, sf):
    s = _docs(spark, sf).where("n_chars is not null").groupBy("kind").agg(F.sum("n_chars").cast("double").alias("size"), F.count("*").cast("double").alias("weight"))
    return blend.budget(s, 1_000_000.0, size="size").select("kind", F.round("weight", 6).alias("weight"), F.round("epochs", 6).alias("epochs"), "high")


@query(f"SELECT exemplar_id, CASE {_hash('0', 'exemplar_id')} % 5 WHEN 0 THEN e || chr(10) || k WHEN 1 THEN k || chr(10) || e WHEN 2 THEN 'Translate to Korean:' || chr(10) || e || chr(10) || chr(10) || k WHEN 3 THEN '다음의 영어문장을 조선어로 번역하시오.' || chr(10) || e || chr(10) || chr(10) || k ELSE 'Translate to English:' || chr(10) || k || chr(10) || chr(10) || e END AS text FROM (SELECT exemplar_id, {_strip('question')} AS e, {_strip('answer')} AS k FROM {Q}) WHERE e <> '' AND k <> ''")
def template_docs(spark, sf):
    return blend.pair_documents(_passages(spark, sf), en="question", ko="answer", key="exemplar_id")


@query(f"SELECT doc_id, CASE WHEN percent_rank() OVER (PARTITION BY kind ORDER BY {_hash('0', 'doc_id')}, doc_id) < 0.3 THEN 'calibration' ELSE 'test' END AS part FROM documents")
def stratified_split(spark, sf):
    return blend.split(_docs(spark, sf), 0.3, "doc_id", by="kind").select("doc_id", "part")


@query(f"SELECT kind, doc_id FROM (SELECT kind, doc_id, row_number() OVER (PARTITION BY kind ORDER BY {_hash('0', 'doc_id')}, doc_id) AS k FROM documents) WHERE k <= 20")
def hash_draw(spark, sf):
    return blend.draw_each(_docs(spark, sf), 20, "doc_id", by="kind").select("kind", "doc_id")


@query(f"SELECT count(*) AS tokens, count(DISTINCT w) AS types, round(count(DISTINCT w)::DOUBLE / count(*), 6) AS ratio FROM (SELECT unnest({_words('lower(text)')}) AS w FROM documents WHERE text IS NOT NULL)")
def type_token_ratio(spark, sf):
    return stats.type_token_ratio(_docs(spark, sf).where("text is not null"), "text")


@query(f"SELECT count(*) AS total, count(DISTINCT g) AS \"distinct\", round(count(DISTINCT g)::DOUBLE / count(*), 6) AS coverage FROM (SELECT list_slice(t, i, i + 4) AS g FROM (SELECT t, unnest(range(1, len(t) - 3)) AS i FROM (SELECT {_words('lower(text)')} AS t FROM documents WHERE text IS NOT NULL) WHERE len(t) >= 5))")
def ngram_coverage(spark, sf):
    return stats.ngram_coverage(_docs(spark, sf).where("text is not null"), "text")


@query()
def self_bleu(spark, sf):
    """Held against a plain computation in the tests."""
    return stats.self_bleu(_passages(spark, sf).where("question is not null"), "question", id="exemplar_id")


@query("""WITH u AS (SELECT list_transform(embedding, lambda x: x::DOUBLE / n) AS u FROM (SELECT embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings) WHERE n > 0),
    s AS (SELECT k, sum(u[k]) AS s FROM u, (SELECT unnest(range(1, (SELECT max(len(u)) FROM u) + 1)) AS k) GROUP BY k)
    SELECT (SELECT count(*) FROM u) AS rows, round((sum(s * s) - (SELECT count(*) FROM u)) / ((SELECT count(*) FROM u) * ((SELECT count(*) FROM u) - 1.0)), 6) AS mean_cosine FROM s""")
def pairwise_cosine(spark, sf):
    return stats.mean_cosine(spark.read.parquet(f"{sf}/embeddings.parquet"))


# --- vocabularies --------------------------------------------------------------------------------------------------


def _vocab(spark, sf, kind: str) -> DataFrame:
    """Words of a kind of documents, numbered in the order of their first occurrence."""
    w = _docs(spark, sf).where((F.col("kind") == kind) & F.col("text").isNotNull()).select("doc_id", F.posexplode(text.words("text")).alias("at", "token"))
    first = w.groupBy("token").agg(F.min(F.struct("doc_id", "at")).alias("first"))
    return numbered(first, "first", name="id")[0].select("token", "id")


def _vocab_sql(kind: str) -> str:
    return f"(SELECT token, row_number() OVER (ORDER BY doc_id, i) - 1 AS id FROM (SELECT token, min(doc_id) AS doc_id, arg_min(i, (doc_id, i)) AS i FROM (SELECT doc_id, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS i FROM (SELECT doc_id, {_words('text')} AS t FROM documents WHERE kind = '{kind}' AND text IS NOT NULL)) GROUP BY token))"


@query(f"WITH b AS {_vocab_sql('qa')}, e AS {_vocab_sql('cot')} SELECT token, id FROM b UNION ALL SELECT token, (SELECT max(id) FROM b) + row_number() OVER (ORDER BY id, token) AS id FROM e WHERE token NOT IN (SELECT token FROM b)")
def vocab_union(spark, sf):
    return vocab.vocab_union(_vocab(spark, sf, "qa"), _vocab(spark, sf, "cot"))


@query(f"WITH o AS {_vocab_sql('qa')}, n AS {_vocab_sql('cot')} SELECT n.id, o.id AS old_id FROM n LEFT JOIN o ON n.token = o.token")
def embedding_plan(spark, sf):
    return vocab.embedding_plan(_vocab(spark, sf, "qa"), _vocab(spark, sf, "cot"))


@query("""WITH p AS (SELECT vec_id AS id, unnest([vec_id, vec_id + 1]) AS piece FROM embeddings), m AS (SELECT p.id, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS k FROM p JOIN embeddings e ON e.vec_id = p.piece)
    SELECT id, k::INT AS k, round(avg(v::DOUBLE)::FLOAT::DOUBLE, 4) + 0.0 AS x FROM m GROUP BY id, k""")
def mean_rows(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    m = vocab.mean_rows(e.select("id", F.array(F.col("id"), F.col("id") + 1).alias("pieces")), e)
    return m.select("id", F.posexplode("embedding").alias("k", "v")).select("id", "k", (F.round(F.col("v").cast("double"), 4) + 0.0).alias("x"))
