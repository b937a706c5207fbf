"""Prompts, completions and chats as columns. Templates are literals, so Catalyst folds all but the row's own text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import profiles as p
from .text import ColumnLike, col, strip


def pair_document(en: ColumnLike, ko: ColumnLike, choice: Column) -> Column:
    """One of the five parallel templates by ``choice`` (any integer); null if a side is blank."""
    e, k = strip(en), strip(ko)
    texts = F.array(*(F.concat_ws("", F.array(*_pieces(t, {"{en}": e, "{ko}": k}))) for t in p.PAIR_TEMPLATES))
    return F.when((e != "") & (k != ""), F.element_at(texts, (F.pmod(choice, F.lit(len(p.PAIR_TEMPLATES))) + 1).cast("int")))


def _pieces(template: str, values: dict[str, Column]) -> list[Column]:
    for slot, value in values.items():
        if slot in template:
            head, _, tail = template.partition(slot)
            return [*_pieces(head, values), value, *_pieces(tail, values)]
    return [F.lit(template)] if template else []


def _fields(labels: tuple[str, ...], values: list[Column]) -> Column:
    """Lines "label: value"; a label without a value stands alone and open."""
    named = [F.concat(F.lit(f"{label}: "), v) for label, v in zip(labels, values)]
    return F.concat_ws("\n", *named, *(F.lit(f"{label}:") for label in labels[len(values) : len(values) + 1]))


def few_shot_prompt(task: str, exemplars: list[dict[str, str]], passage: ColumnLike, term: ColumnLike | None = None, audience: str | None = None, register: str | None = None) -> Column:
    """Exemplar blocks, then the open block up to the first field to generate; instructions become a header."""
    labels, inputs = p.TASKS[task]
    given = {"passage": passage, "term": term}
    shown = [_fields(labels, [F.lit(e[label]) for label in labels]) for e in exemplars]
    body = F.concat_ws(p.DELIMITER, *shown, _fields(labels, [col(given[name]) for name in inputs]))
    header = " ".join(table[key][0] for table, key in ((p.AUDIENCES, audience), (p.STYLES, register)) if key)
    return F.concat(F.lit(f"다음 실례들을 참고하여, {header}\n\n"), body) if header else body


def taken(completion: ColumnLike) -> Column:
    """The completion up to the delimiter."""
    return strip(F.split_part(col(completion), F.lit("\n---"), F.lit(1)))


def parsed_completion(task: str, completion: ColumnLike) -> Column:
    """struct(question, answer, pairs) of a completion; null if it lacks a field that the task needs."""
    text = taken(completion)
    none = F.lit(None).cast("string")
    pairs = F.lit(None).cast("array<struct<q:string,a:string>>")
    if task in ("qa", "reasoned_qa"):
        label = p.TASKS[task][0][2]
        pattern = rf"(?s)^(.*?)\n(?U:\s)*{label}(?U:\s)*:(?U:\s)*(.*)$"
        return F.when(text.rlike(pattern), F.struct(strip(F.regexp_extract(text, pattern, 1)).alias("question"), strip(F.regexp_extract(text, pattern, 2)).alias("answer"), pairs.alias("pairs")))
    if task == "multi_qa":
        pattern = F.lit(r"(?s)질문(?U:\s)*\d*(?U:\s)*[:.](?U:\s)*(.*?)(?U:\s)*\n(?U:\s)*답(?U:\s)*\d*(?U:\s)*[:.](?U:\s)*(.*?)(?=\n(?U:\s)*질문|\z)")
        found = F.zip_with(F.regexp_extract_all(text, pattern, 1), F.regexp_extract_all(text, pattern, 2), lambda q, a: F.struct(strip(q).alias("q"), strip(a).alias("a")))
        return F.when(F.size(found) > 0, F.struct(none.alias("question"), none.alias("answer"), found.alias("pairs")))
    answer = strip(F.split_part(text, F.lit("\n"), F.lit(1))) if task == "title" else text
    return F.when(text != "", F.struct(none.alias("question"), answer.alias("answer"), pairs.alias("pairs")))


# What the user asks in each task; {q}, {n}, {p} and {t} are the question, the number of pairs, the passage and the term.
_ASKS = {
    "qa": "다음 단락을 읽고 질문에 답하시오.\n\n단락: {p}\n\n질문: {q}",
    "reasoned_qa": "다음 단락을 바탕으로 이 질문을 단계별로 분석하여 대답하시오.\n\n단락: {p}\n\n질문: {q}",
    "multi_qa": "다음 단락을 바탕으로 질문-대답 {n}개를 만드시오.\n\n단락: {p}",
    "summary": "다음 단락을 요약하시오.\n\n{p}",
    "title": "다음 단락에 어울리는 제목을 제안하시오.\n\n{p}",
    "fact_extraction": "다음 단락에서 핵심사실을 뽑아 목록으로 만드시오.\n\n{p}",
    "explain_simply": "다음 단락을 쉬운 조선어로 설명하시오.\n\n{p}",
    "outline": "다음 단락의 구조적개요를 작성하시오.\n\n{p}",
    "definition": "다음 단락을 바탕으로 '{t}'의 정의를 쓰시오.\n\n{p}",
}


def chat(*turns: tuple[str, ColumnLike]) -> Column:
    return F.array(*(F.struct(F.lit(role).alias("role"), (F.lit(text) if isinstance(text, str) else text).alias("content")) for role, text in turns))


def grounded_chat(task: str, passage: ColumnLike, parsed: ColumnLike, term: ColumnLike | None = None, audience: str | None = None, register: str | None = None) -> Column:
    """The user and assistant messages of a parsed completion; requests for an audience and a style lead the question."""
    got = col(parsed)
    asked = " ".join(x for x in (p.AUDIENCES[audience][1] if audience else "", p.STYLES[register][1] if register else "") if x)
    values = {"{p}": col(passage), "{q}": got["question"], "{n}": F.size(got["pairs"]).cast("string"), "{t}": col(term) if term is not None else F.lit("")}
    user = F.concat(F.lit(asked + " " if asked else ""), *_pieces(_ASKS[task], values))
    answer = got["answer"]
    if task == "multi_qa":
        answer = F.concat_ws("\n", F.transform(got["pairs"], lambda x, i: F.concat(F.lit("질문 "), (i + 1).cast("string"), F.lit(": "), x["q"], F.lit("\n대답 "), (i + 1).cast("string"), F.lit(": "), x["a"])))
    return chat(("user", user), ("assistant", answer))


def solution_prompt(exemplars: list[dict[str, str]], problem: ColumnLike, gold: ColumnLike | None = None) -> Column:
    """Worked examples, then the open problem; with ``gold`` the model is told the answer and explains it."""
    blocks = [f"문제: {e['problem']}\n풀이:\n{e['solution']}" for e in exemplars]
    hint = F.lit("") if gold is None else F.concat(F.lit("정답이 "), col(gold).cast("string"), F.lit("임을 알고있습니다. 이 답이 어떻게 나오는지 단계별로 설명하시오:\n"))
    return F.concat_ws(p.STEP_DELIMITER, *map(F.lit, blocks), F.concat(F.lit("문제: "), col(problem), F.lit("\n"), hint, F.lit("풀이:\n")))


def first_solution(completion: ColumnLike) -> Column:
    """The completion up to the next problem."""
    return strip(F.split_part(F.split_part(col(completion), F.lit(p.STEP_DELIMITER), F.lit(1)), F.lit("\n문제:"), F.lit(1)))


def support_prompt(exemplars: list[dict[str, str]], passage: ColumnLike, answer: ColumnLike) -> Column:
    """Asks whether a passage supports a claim."""
    asks = "주장이 단락에서 뒤받침됩니까? 답:"
    blocks = [f"단락: {e['passage']}\n주장: {e['claim']}\n{asks} {e['label']}" for e in exemplars]
    return F.concat_ws(p.DELIMITER, *map(F.lit, blocks), F.concat(F.lit("단락: "), col(passage), F.lit("\n주장: "), col(answer), F.lit(f"\n{asks}")))


def judge_messages(prompt: ColumnLike, first: ColumnLike, second: ColumnLike, rubric: str) -> Column:
    return chat(("user", F.concat(F.lit(f"아래에 질문 하나와 두개의 답이 있습니다. 다음의 기준에 따라 어느 답이 더 나은지 판단하시오: {rubric}.\n\n질문: "), col(prompt), F.lit("\n\n답 A:\n"), col(first), F.lit("\n\n답 B:\n"), col(second), F.lit("\n\n마지막에 정확히 이 형식으로 판정을 내리시오 — '판정: A' 또는 '판정: B'."))))


def critique_messages(prompt: ColumnLike, answer: ColumnLike, rubric: str) -> Column:
    return chat(("user", F.concat(F.lit(f"아래에 질문 하나와 그 답이 있습니다. 다음의 기준에 따라 답의 부족한 점을 지적하시오.\n\n기준:\n{rubric}\n\n질문: "), col(prompt), F.lit("\n\n답:\n"), col(answer), F.lit("\n\n검토: 이 답은 어떤 점에서 더 개선될수 있습니까? 짧고 명확한 목록으로 제시하시오."))))


def revision_messages(prompt: ColumnLike, answer: ColumnLike, critique: ColumnLike) -> Column:
    return chat(("user", F.concat(F.lit("아래에 질문과 초기답, 그리고 그에 대한 검토가 있습니다. 검토에서 제기된 모든 문제를 반영하여 더 나은 답을 작성하시오.\n\n질문: "), col(prompt), F.lit("\n\n초기 답:\n"), col(answer), F.lit("\n\n검토:\n"), col(critique), F.lit("\n\n더 나은 답:"))))


def new_task_messages(seeds: ColumnLike, n: int = 8) -> Column:
    """Asks for n new instructions unlike an array of seeds."""
    listed = F.concat_ws("\n", F.transform(col(seeds), lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), s)))
    return chat(("user", F.concat(F.lit("아래에 몇가지 작업(지시)이 있습니다:\n"), listed, F.lit(f"\n\n이와 다르고 다양한 {n}개의 새로운 작업을 조선어로 작성하시오. 매 작업을 번호와 함께 새 줄에 작성하시오. 작업은 명확하고 다양한 주제에서 나오도록 하시오."))))


def problem_messages(problem: ColumnLike, verifier: ColumnLike, systems: dict[str, str] | None = None) -> Column:
    """The system message of a row's verifier (that of mathematics for an unknown one) and the problem."""
    known = F.create_map(*(F.lit(x) for kv in (systems or p.SYSTEMS).items() for x in kv))
    return chat(("system", F.coalesce(F.try_element_at(known, col(verifier)), F.lit(p.SYSTEMS["math"]))), ("user", col(problem)))
