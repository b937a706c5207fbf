"""Whole flows: a fine-tuning blend, verified solutions, evaluation of a checkpoint, growing a pool of instructions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markdown, profiles, templates, text
from ..functions.chat import first_filled, numbered_lines, response_text
from ..operators import blend, cluster, filters, prefer, report
from ..operators.common import cut
from .hooks import Complete, with_model


def fine_tuning_blend(native: DataFrame, translated: DataFrame, replay: DataFrame, *, order: str, shares: tuple[float, float, float] = (0.70, 0.20, 0.10), total: int = 300_000, seed: int = 0, target: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(blend, reasons): both Korean pools filtered, replay as it is, drawn by exact shares into one shuffled order."""
    judged = {name: filters.pool_filter(df.withColumn("_r", response_text(messages="messages")), "_r", target=target) for name, df in (("native", native), ("translated", translated))}
    stats = None
    for name, df in judged.items():
        part = filters.reasons(df).withColumn("source_pool", F.lit(name))
        stats = part if stats is None else stats.unionByName(part)
    pools = {name: (df.where("reason is null").drop("_r", "reason"), order) for name, df in judged.items()} | {"replay": (replay, order)}
    return blend.blend(pools, dict(zip(("native", "translated", "replay"), shares)), total, seed), stats


def verified_solutions(problems: DataFrame, sampler: Callable[[], Complete], verifier: Callable[[Column, Column], Column], prompt: Column, *, keep: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, pairs, rate) from K samples to a problem (problem_id, problem, gold): the first correct ones, preference pairs, solve rate."""
    asked = problems.withColumn("_prompt", prompt)
    out = cut(with_model(asked, "_prompt", sampler, name="_samples", kind="array<string>"))
    samples = out.select("problem_id", "problem", "gold", F.posexplode("_samples").alias("sample_id", "response"))
    graded = cut(samples.withColumn("correct", verifier(F.col("response"), F.col("gold"))))
    return prefer.accepted(graded, keep), prefer.sample_pairs(graded), prefer.solve_rate(graded)


def bootstrapped_solutions(problems: DataFrame, sampler: Callable[[], Complete], verifier: Callable[[Column, Column], Column], exemplars: list[dict[str, str]], *, keep: int = 2) -> DataFrame:
    """Forward solutions first; problems without one are asked again with their answer. The whole sample is verified, its first solution stored."""
    first = verified_solutions(problems, sampler, verifier, templates.solution_prompt(exemplars, "problem"), keep=keep)[0].withColumn("mode", F.lit("forward"))
    rest = problems.join(first.select("problem_id").distinct(), "problem_id", "left_anti")
    second = verified_solutions(rest, sampler, verifier, templates.solution_prompt(exemplars, "problem", "gold"), keep=keep)[0].withColumn("mode", F.lit("rationalised"))
    return first.unionByName(second).withColumn("response", templates.first_solution("response"))


def evaluation(predictions: DataFrame, verified: Column | None = None) -> DataFrame:
    """Slices of a checkpoint's predictions; the text is the first filled of prediction, response, output and text."""
    names = [n for n in ("prediction", "response", "output", "text") if n in predictions.columns]
    return report.eval_slices(report.scored(predictions.withColumn("_p", first_filled(*names)), "_p", verified=verified))


def grown_instructions(seeds: DataFrame, proposer: Callable[[], Complete], answerer: Callable[[], Complete], *, rounds: int = 5, per_prompt: int = 8, shown: int = 6, prompts: int = 64, target: int = 50_000, similar: float = 0.7, seed: int = 0) -> DataFrame:
    """(instruction, output): proposed from drawn seeds, kept if unlike the pool and earlier ones, answered, kept if acceptable; until the target or the last round."""
    pool = cut(seeds.select("instruction"))
    made: DataFrame | None = None
    for k in range(rounds):
        groups = pool.withColumn("n", F.pmod(text.stable_hash(f"{seed}-{k}", "instruction"), F.lit(prompts)))
        drawn = blend.draw_each(groups, shown, "instruction", by="n", seed=seed + k).groupBy("n").agg(F.sort_array(F.collect_list("instruction")).alias("seeds"))
        asked = drawn.select(F.to_json(templates.new_task_messages("seeds", per_prompt)).alias("prompt"))
        new = with_model(asked, "prompt", proposer, name="reply").select(F.explode(numbered_lines("reply")).alias("instruction")).distinct()
        fresh = cluster.greedy_distinct(cut(new.withColumn("id", text.stable_hash(seed, "instruction"))), "instruction", threshold=similar, pool=pool.select("instruction"))
        kept = cut(with_model(fresh.select("instruction"), "instruction", answerer, name="output").where(text.acceptable_output("instruction", "output")))
        made = kept if made is None else cut(made.unionByName(kept))
        pool = cut(pool.unionByName(kept.select("instruction")))
        if made.count() >= target:
            break
    return made


def translated_chats(chats: DataFrame, mapper: Callable[[str], str], *, messages: str = "messages", roles: tuple[str, ...] = ("user", "assistant"), least: float | None = 0.6) -> DataFrame:
    """Messages of these roles translated (Markdown stays), in one pass without a shuffle; ``reason`` low_language where an assistant turn then has
    less than ``least`` Hangul, for the sink of kept and rejected rows. None switches the check off."""

    @F.pandas_udf("array<struct<role:string,content:string>>")
    def run(chats: pd.Series) -> pd.Series:
        say = lambda m: markdown.map_markdown(m["content"], mapper) if m["role"] in roles and m["content"] else m["content"]
        return chats.map(lambda turns: [{"role": m["role"], "content": say(m)} for m in turns], na_action="ignore")

    out = chats.withColumn(messages, run(messages))
    if least is None:
        return out.withColumn("reason", F.lit(None).cast("string"))
    return filters.language_gate(out, messages, least=least).withColumn("reason", F.when(F.col("flagged"), "low_language")).drop("flagged")


def translated_problems(problems: DataFrame, mapper: Callable[[str], str], *, column: str = "problem") -> DataFrame:
    """Only the problem is translated; the answer and every other column stay as they are."""
    return problems.withColumn(column, markdown.mapped_markdown(column, mapper))


def distilled(prompts: DataFrame, teacher: Callable[[], Complete], system: str, *, column: str = "prompt") -> DataFrame:
    """(prompt, messages, reason) of a teacher's step-by-step answers; unacceptable ones carry a reason."""
    asked = prompts.withColumn("_ask", F.to_json(templates.chat(("system", system), ("user", F.col(column)))))
    said = with_model(asked, "_ask", teacher, name="_reply").drop("_ask")
    good = F.coalesce(text.acceptable_steps("_reply"), F.lit(False))
    return said.select(column, templates.chat(("user", F.col(column)), ("assistant", text.strip("_reply"))).alias("messages"), F.when(~good, "no_steps").alias("reason"))


def sampled_preferences(prompts: DataFrame, sampler: Callable[[], Complete], *, column: str = "prompt", kind: str | None = None, source: str | None = None) -> DataFrame:
    """(prompt, chosen, rejected) from two samples to each prompt; ties leave."""
    drawn = with_model(prompts, column, sampler, name="_two", kind="array<string>").withColumns({"_a": F.get("_two", F.lit(0)), "_b": F.get("_two", F.lit(1))})
    return prefer.preferred(drawn.withColumnsRenamed({"_a": "response_a", "_b": "response_b"}), kind=kind, source=source).select(column, "chosen", "rejected")


def faithfulness(df: DataFrame, scorer: Callable[[], Complete], exemplars: list[dict[str, str]], *, passage: str = "passage", answer: str = "answer", min_hangul: float = 0.7, **gates: float) -> DataFrame:
    """Adds lex, pmi, nli_margin and ``reason``: how much the passage helps the answer (log-probability with and without it), and whether the model says it supports it."""
    ask = lambda prompt, continuation: F.struct(prompt.alias("prompt"), continuation.alias("continuation"))
    claim = templates.support_prompt(exemplars, passage, answer)
    asks = F.array(
        ask(F.concat(F.lit("단락: "), F.col(passage), F.lit("\n답: ")), F.col(answer)),
        ask(F.lit("답: "), F.col(answer)),
        ask(claim, F.lit(" 예")),
        ask(claim, F.lit(" 아니")),
    )
    scored = with_model(df.withColumn("_asks", F.to_json(asks)), "_asks", scorer, name="_p", kind="array<double>").drop("_asks")
    out = scored.withColumn("lex", text.overlap(*(text.content_words(x, stop=profiles.STRICT_STOP_WORDS) for x in (passage, answer))))
    out = out.withColumn("pmi", F.get("_p", F.lit(0)) - F.get("_p", F.lit(1))).withColumn("nli_margin", F.get("_p", F.lit(2)) - F.get("_p", F.lit(3))).drop("_p")
    good = (text.hangul_fraction(answer) >= min_hangul) & text.strictly_faithful("lex", "pmi", "nli_margin", **gates)
    return out.withColumn("reason", F.when(~F.coalesce(good, F.lit(False)), "unfaithful"))
