"""Operators, sources, flows and streams on small tables of their own."""

import json
import random

import pytest
from pyspark.sql import functions as F

from onggi.functions import text, verify
from onggi.operators import blend, cluster, filters, pack, prefer, report, stats, vocab
from onggi.plans import flows, hooks
from onggi.sources import io
from onggi.streaming import filters as streams


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_filters_name_the_first_reason(spark):
    df = spark.createDataFrame([(1, "갑니다. 간다."), (2, "갑니다. 왔습니다."), (3, ""), (4, None), (5, "그는 갔다. 그녀는 그것을 법에 의해 정했다. 사람들은 그들의 것이다."), (6, "abc")], "id int, t string")
    assert [(r.id, r.reason) for r in filters.pool_filter(df, "t").orderBy("id").collect()] == [(1, "register_mix"), (2, None), (3, None), (4, None), (5, "translationese"), (6, None)]
    assert {r.id for r in filters.pool_filter(df, "t", target="합쇼체").where("reason = 'register_target'").collect()} == {5, 6}
    assert {r.id for r in filters.register_filter(df, "t", target="합쇼체").where("reason is null").collect()} == {2, 3, 4, 6}
    assert filters.translation_filter(df, "t").count() == 4
    assert sorted(rows(filters.reasons(filters.pool_filter(df, "t")))) == [("kept", 4, 6, 0.666667), ("register_mix", 1, 6, 0.166667), ("translationese", 1, 6, 0.166667)]
    assert filters.pool_filter(df.limit(0), "t").count() == 0


def test_grounded_filter(spark):
    df = spark.createDataFrame([(1, "강물은 깊고 푸르다", "강물은?\n답: 강물이 깊습니다"), (2, "강물은 깊다", "what?\n답: deep water"), (3, "강물은 깊다", "없음"), (4, "강물은 깊다", "무엇?\n답: 하늘이 높습니다")], "id int, p string, c string")
    assert [(r.id, r.reason) for r in filters.grounded_filter(df, "qa", "c", "p").orderBy("id").collect()] == [(1, None), (2, "language"), (3, "unparsed"), (4, "unfaithful")]
    m = spark.createDataFrame([([("assistant", "좋은 답"), ("assistant", "bad")],), ([("user", "x"), ("assistant", "12")],)], "messages array<struct<role string, content string>>")
    assert [r.flagged for r in filters.language_gate(m).collect()] == [True, False]


def test_converters(spark):
    q = spark.createDataFrame([("q ", "a #### 1 #### 1,200"), ("q", "none"), ("q", "#### NaN"), (None, "#### 1")], "question string, answer string")
    assert rows(filters.from_worked_answers(q)) == [("q", "1200")]
    b = spark.createDataFrame([("p", "\\boxed{\\frac{1}{2}}"), ("p", "x"), (" ", "\\boxed{1}")], "problem string, solution string")
    assert rows(filters.from_boxed_solutions(b)) == [("p", "\\frac{1}{2}")]
    c = spark.createDataFrame([("q", ["x", "y"], "1"), ("q", ["x", "y"], "2"), ("q", [], "0"), ("q", None, "0")], "question string, choices array<string>, answer string")
    assert rows(filters.from_choices(c)) == [("q\n\nA) x\nB) y", "B", 2)]
    assert [r.gold for r in filters.from_choices(c, one_based=True).orderBy("gold").collect()] == ["A", "B"]
    k = spark.createDataFrame([("q", ["x", "y"], "나"), ("q", ["x", "y"], "0"), ("q", ["x", "y"], "c")], "question string, choices array<string>, answer string")
    assert sorted(r.gold for r in filters.from_choices(k, one_based=True).collect()) == ["A", "B"]
    assert rows(filters.from_choices(c).select(verify.verify_option(F.lit("답: 나"), "gold", "n_options"))) == [(True,)]
    f = spark.createDataFrame([("def f():", "def check(f): ...", "f"), ("p", None, "f")], "prompt string, test string, entry_point string")
    assert filters.from_function_tests(f).first().gold.tests.endswith("check(f)") and filters.from_function_tests(f).count() == 1
    a = spark.createDataFrame([(" t ", ["assert 1", "assert 2"], ""), ("t", [], "")], "text string, test_list array<string>, test_setup_code string")
    assert filters.from_assertions(a).first().gold.tests == "assert 1\nassert 2" and filters.from_assertions(a).count() == 1


def test_preferences(spark):
    df = spark.createDataFrame([("좋은 답을 씁니다.", "english only"), ("같습니다.", "같습니다."), ("갑니다. 간다.", "갑니다. 옵니다.")], "response_a string, response_b string")
    assert sorted((r.chosen, r.rejected) for r in prefer.preferred(df).collect()) == [("갑니다. 옵니다.", "갑니다. 간다."), ("좋은 답을 씁니다.", "english only")]
    j = spark.createDataFrame([("A", "B", "x", "y"), ("A", "A", "x", "y"), ("B", "A", "x", "y"), (None, "A", "x", "y")], "verdict_1 string, verdict_2 string, response_a string, response_b string")
    assert sorted(r.chosen for r in prefer.judged(j).collect()) == ["x", "y"]
    s = spark.createDataFrame([(1, 0, False, "a"), (1, 1, True, "b"), (1, 2, True, "c"), (1, 3, True, "d"), (2, 0, False, "e"), (3, 0, True, "f")], "problem_id int, sample_id int, correct boolean, response string")
    assert sorted(r.response for r in prefer.accepted(s).collect()) == ["b", "c", "f"]
    assert rows(prefer.sample_pairs(s)) == [(1, "b", "a")]
    assert [r.problem_id for r in prefer.unsolved(s.select("problem_id").distinct(), s).collect()] == [2]
    assert rows(prefer.solve_rate(s)) == [(3, 2, 0.666667)] and rows(prefer.solve_rate(s.limit(0))) == [(0, 0, 0.0)]


def greedy(texts, threshold, pool=()):
    def tokens(t):
        return {w.strip("。.,?!\"'()[]{}:;…·") for w in t.split() if len(w) > 1}

    kept = [tokens(t) for t in pool]
    out = []
    for k, t in enumerate(texts):
        own = tokens(t)
        if not any(own and s and len(own & s) / len(own | s) >= threshold for s in kept):
            kept.append(own)
            out.append(k)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_distinct_is_that_of_a_loop(spark, seed):
    rng = random.Random(seed)
    words = [f"낱말{k}" for k in range(9)]
    texts = [" ".join(rng.sample(words, rng.randrange(1, 6))) for _ in range(120)] + ["", " ", "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string").repartition(4)
    pool = spark.createDataFrame([(t,) for t in texts[:3]], "t string")
    for threshold in (0.5, 0.7):
        assert sorted(r.id for r in cluster.greedy_distinct(df, "t", threshold=threshold).collect()) == greedy(texts, threshold)
        assert sorted(r.id for r in cluster.greedy_distinct(df, "t", threshold=threshold, pool=pool).collect()) == greedy(texts, threshold, texts[:3])
    assert cluster.greedy_distinct(df.limit(0), "t").count() == 0


def test_leaders_and_majorities(spark):
    data = [(1, 0, "결론 가나다 라마"), (1, 1, "결론 가나다 라마 바사"), (1, 2, "결론 하하 호호"), (2, 0, "결론 하나 둘셋"), (2, 1, "결론 넷넷 다섯"), (3, 0, ""), (3, 1, "")]
    df = spark.createDataFrame(data, "prompt_id int, sample_id int, response string")
    led = cluster.leaders(df)
    assert rows(led, "prompt_id", "sample_id") == [(1, 0, 0), (1, 1, 0), (1, 2, 2), (2, 0, 0), (2, 1, 1), (3, 0, 0), (3, 1, 1)]
    best = cluster.majority(led, 3)
    assert rows(best) == [(1, 0, 2)]
    assert [r.response for r in cluster.shortest(df, led, best).collect()] == ["결론 가나다 라마"]
    x = spark.createDataFrame([(1, "a b c d e f"), (2, "x y z"), (3, None)], "id int, text string")
    assert rows(cluster.excluded(x, spark.createDataFrame([("b C d e f g",)], "text string"), id="id")) == [(1, 1)]
    assert rows(cluster.duplicate_audit(spark.createDataFrame([(1, "가나 다라"), (2, "가나 다라"), (3, "abc def")], "id int, t string"), "t")) == [(1, 1, 1)]


def packed(docs, target, least, sep):
    out, now, held = [], [], 0
    for d, n in docs:
        alone = least is not None and n >= least
        cost = n + (sep if now else 0)
        if now and (alone or held + cost > target):
            out.append(now)
            now, held, cost = [], 0, n
        now.append(d)
        held += cost
        if alone or held >= target:
            out.append(now)
            now, held = [], 0
    return out + ([now] if now else [])


def test_packs_are_those_of_a_loop(spark):
    rng = random.Random(3)
    docs = [(k, "s" + str(k % 3) if k % 7 else None, " ".join(["w"] * rng.randrange(0, 12))) for k in range(90)]
    df = spark.createDataFrame(docs, "doc_id int, source string, text string").repartition(5)
    got = pack.pack(df, target=20, least=10, key="source", separator_tokens=1).collect()
    for key in ("s0", "s1", "s2", "_all"):
        own = [(d, len(t.split())) for d, s, t in docs if (s or "_all") == key and t]
        assert [r.n_docs for r in sorted(got, key=lambda r: r.pack) if r.key == key] == [len(x) for x in packed(own, 20, 10, 1)]
    assert sum(r.n_docs for r in got) == sum(1 for *_, t in docs if t) and pack.pack(df.limit(0), key="source").count() == 0
    assert rows(pack.sizes(df.where("text <> ''"), text.word_count("text")))[0][0] == sum(1 for *_, t in docs if t)


def test_blends_draw_exact_numbers(spark):
    a = spark.createDataFrame([(k, f"a{k}") for k in range(50)], "id int, t string").repartition(3)
    b = spark.createDataFrame([(k, f"b{k}") for k in range(7)], "id int, t string")
    made = blend.blend({"a": (a, "id"), "b": (b, "id"), "none": (b.limit(0), "id")}, {"a": 0.7, "b": 0.25, "none": 0.05}, 100, seed=3)
    assert sorted(rows(made.groupBy("pool").count())) == [("a", 70), ("b", 25)]
    assert sorted(rows(made)) == sorted(rows(blend.blend({"a": (a.repartition(7), "id"), "b": (b, "id")}, {"a": 0.7, "b": 0.25}, 100, seed=3)))
    w = spark.createDataFrame([("k", 20.0, 0.9), ("e", 400.0, 0.9), ("p", 1.2, 0.2)], "source string, tokens_b double, weight double")
    assert rows(blend.budget(w, 60.0).select("source", F.round("epochs", 4), "high"), "source") == [("e", 0.0675, False), ("k", 1.35, False), ("p", 5.0, True)]
    assert blend.draw(a, 5, "id").count() == 5 and rows(blend.draw(a, 5, "id"), "id") == rows(blend.draw(a.repartition(9), 5, "id"), "id")
    assert rows(blend.split(a.withColumn("g", F.col("id") % 2), 0.3, "id", by="g").groupBy("part").count(), "part") == [("calibration", 16), ("test", 34)]
    assert blend.sweep(b, x=["1", "2"], y=["3", "4", "5"]).count() == 42
    p = spark.createDataFrame([(1, "a", "가"), (2, " ", "나"), (3, None, "다")], "id int, en string, ko string")
    assert [r.id for r in blend.pair_documents(p, key="id").collect()] == [1]


def test_generated_problems(spark):
    made = blend.sudokus(spark, 4, blanks=40)
    shown = F.concat_ws("\n", F.transform(F.from_json("solution", "array<array<int>>"), lambda r: F.concat_ws(" ", F.transform(r, lambda x: x.cast("string")))))
    for r in made.select("*", verify.solved(F.from_json("solution", "array<array<int>>")).alias("whole"), verify.verify_sudoku(shown, "puzzle").alias("solves")).collect():
        assert r.whole and sum(x == 0 for y in json.loads(r.puzzle) for x in y) == 40
        assert r.solves and r.problem.count(".") >= 40
    assert made.select("solution").distinct().count() == 4 and blend.sudokus(spark, 1, level="hard").first().puzzle.count("0") == 55
    h = blend.haystacks(spark, ["one two three four.", "five six seven."], lang="en", lengths=(40, 100), depths=(0.0, 0.5, 1.0))
    got = h.collect()
    assert len(got) == 6 and all(r.answer in r.prompt and len(r.prompt.split()) <= r.context_tokens + 4 for r in got)
    f = blend.format_prompts(spark.createDataFrame([("강",), ("산",)], "entity string"), [("{e}의 좋은 점 3가지를 쓰시오.", '{"type": "list", "min_items": "{n}"}')])
    assert [json.loads(r.gold)["min_items"] for r in f.collect()] == [3, 3]


def test_vocabularies(spark):
    base = spark.createDataFrame([("a", 0), ("b", 1), ("íķľ", 2), ("<s>", 3)], "token string, id bigint")
    extra = spark.createDataFrame([("b", 0), ("c", 1), ("bc", 2)], "token string, id bigint")
    assert rows(vocab.vocab_union(base, extra), "id")[-2:] == [("c", 4), ("bc", 5)] and vocab.vocab_union(base, extra, 1).count() == 5
    merges = spark.createDataFrame([(0, "a", "b")], "rank bigint, left string, right string")
    more = spark.createDataFrame([(0, "a", "b"), (1, "b", "c"), (2, "b", "x")], "rank bigint, left string, right string")
    assert rows(vocab.merge_union(merges, more, vocab.vocab_union(base, extra)), "source", "rank") == [(0, 0, "a", "b"), (1, 1, "b", "c")]
    assert rows(vocab.merge_filter(more, spark.createDataFrame([("bc",)], "token string")).select("rank"), "rank") == [(0,), (2,)]
    special = base.where("token = '<s>'")
    new = vocab.vocab_replace(base, extra, special)
    assert rows(new, "id") == [("a", 0, "kept"), ("b", 1, "kept"), ("c", 2, "new"), ("bc", 3, "new"), ("<s>", 4, "special")]
    assert rows(vocab.section_stats(new), "first") == [("kept", 2, 0, 1), ("new", 2, 2, 3), ("special", 1, 4, 4)]
    assert [r[0] for r in base.orderBy("id").select(vocab.token_class("token")).collect()] == ["other", "other", "korean", "other"]
    assert len(vocab.byte_alphabet()) == 256 and sorted(vocab.byte_alphabet().values()) == list(range(256))
    mat = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "id bigint, embedding array<float>")
    plan = vocab.embedding_plan(base.where("id < 2"), extra)
    filled = {r.id: r.embedding for r in vocab.fill_rows(plan, mat, 2).collect()}
    assert filled[0] == [3.0, 4.0] and all(abs(x) < 0.2 for x in filled[1]) and filled == {r.id: r.embedding for r in vocab.fill_rows(plan.repartition(3), mat, 2).collect()}
    pieces = spark.createDataFrame([(7, [0, 1]), (8, []), (9, [0, 0])], "id bigint, pieces array<bigint>")
    assert rows(vocab.mean_rows(pieces, mat, [9.0, 9.0]), "id") == [(7, [2.0, 3.0]), (8, [9.0, 9.0]), (9, [1.0, 2.0])]


def test_reports(spark):
    df = spark.createDataFrame([("갑니다. 왔습니다.", "ko", True), ("갑니다. 간다.", None, None), ("hello there", "en", False), (None, "ja", None)], "p string, lang string, ok boolean")
    got = {r.lang: r for r in report.eval_slices(report.scored(df, "p", verified=F.col("ok"))).collect()}
    assert set(got) == {"ko", "en", "ja", "all"} and got["ko"].n == 2 and got["ko"].accuracy == 1.0 and got["all"].n_graded == 2
    assert got["ko"].n_register_judged == 2 and got["ko"].register_mix_rate == 0.5 and got["ko"].n_hapsyo == 2 and got["en"].mean_hangul is None
    n = spark.createDataFrame([("12 34", "1234", "ko", 3900, 0.0), ("x", "1", "ko", 4100, 0.0), ("5", "5", None, 9000, 0.5)], "prediction string, answer string, lang string, context_tokens int, depth double")
    assert sorted(rows(report.retrieval_grid(n)), key=str) == [("ko", 4000, 0.0, 2, 0.5), ("ko", 8000, 0.5, 1, 1.0), ("ko", None, None, 3, 0.666667)]
    assert report.grid_table(report.retrieval_grid(n)).count() == 2
    v = spark.createDataFrame([("a", float(x)) for x in (5, 1, 4, 2, 3)], "g string, value double")
    assert rows(report.floor_percentile(v, 0.95, "g")) == [("a", 4.0)] and rows(report.floor_percentile(v, 0.5, "g")) == [("a", 3.0)]
    native = spark.createDataFrame([("짧다.",), ("좋다. 가자.",)], "text string")
    far = spark.createDataFrame([("그는 그것을 보았다. 그녀는 갔다.",)] * 3, "text string")
    cal = {r.feature: r for r in report.calibrate(native, far).collect()}
    assert len(cal) == 9 and cal["pronoun_per_100c"].separation == "weak" and cal["sent_len_mean"].separation in ("STRONG", "weak")
    assert {r.feature for r in report.fire_counts(far, "text").collect()} >= {"pronoun_per_100c"}
    f = spark.createDataFrame([("가나 다", ["가나", " ", "다a"], ["가나다"])], "t string, p array<string>, q array<string>")
    assert report.fertility(f, "t", "p", other="q").first().extend is True


def test_statistics(spark):
    t = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, "v w x y z")], "id int, t string")
    assert rows(stats.type_token_ratio(t, "t")) == [(15, 10, 0.666667)] and rows(stats.ngram_coverage(t, "t")) == [(3, 2, 0.666667)]
    assert rows(stats.self_bleu(t, "t", id="id")) == [(0.666667, 3)]
    e = spark.createDataFrame([([1.0, 0.0],), ([0.0, 1.0],), ([1.0, 0.0],), ([0.0, 0.0],)], "embedding array<float>")
    assert rows(stats.mean_cosine(e)) == [(3, 0.333333)]
    s = spark.createDataFrame([(3, True), (2, True), (3, False), (0, False)], "s int, g boolean")
    assert rows(stats.confusion(s, "s", "g", [3]))[0] == (3, 1, 1, 1, 1, 0.5, 0.5, 0.5)
    l = spark.createDataFrame([(["a", "b", "c"], True), (["a"], False)], "f array<string>, g boolean")
    assert rows(stats.leave_one_out(l, "f", "g", ["a"]), "left_out") == [("a", 0.0), ("none", 1.0)]
    k = spark.createDataFrame([("x", "x"), ("x", "y"), ("y", "y"), ("y", "y"), (None, "y")], "a string, b string")
    assert rows(stats.kappa(k, "a", "b")) == [(4, 0.75, 0.5, 0.5)]
    m = spark.createDataFrame([(True, False)] * 9 + [(False, True)], "a boolean, b boolean")
    assert rows(stats.mcnemar(m, "a", "b")) == [(9, 1, 4.9)]
    b = spark.createDataFrame([(i, float(i % 2), 0.0) for i in range(100)], "id int, a double, b double")
    r = stats.bootstrap(b, "a", "b", key="id", rounds=200).first()
    assert r.low < 0.5 < r.high and r.difference == 0.5 and r.rows == 100
    w = spark.createDataFrame([("x", "y")] * 3 + [("y", "x")], "winner string, loser string")
    assert rows(stats.bradley_terry(w, 6), "name") == [("x", 0.75), ("y", 0.25)]
    g = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 7.0)], "g string, v double")
    assert rows(stats.anova(g, "g", "v")) == [(2, 4, 8.0)]
    v = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x"), (2, "y"), (2, "z")], "item int, label string")
    assert rows(stats.adjudicated(v).select("item", "label", "status"), "item") == [(1, "x", "majority"), (2, None, "escalate")]
    q = spark.createDataFrame([(1, 3), (1, 4), (2, 1), (2, 3)], "item int, rating int")
    assert rows(stats.rated(q), "item") == [(1, 3.5, "average"), (2, None, "escalate")]
    a = spark.createDataFrame([("p", "x", "x")] * 9 + [("p", "y", "x")], "annotator string, label string, gold string")
    assert rows(stats.gold_bands(a)) == [("p", 10, 0.9, "good")]
    d = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)], "id int, c string")
    assert rows(stats.quota(d, spark.createDataFrame([("a", 2)], "c string, quota int"), "id", by="c").groupBy("c").count()) == [("a", 2)]


def test_sources(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("a\t가\tx\nb\n", encoding="utf-8")
    assert rows(io.read_pairs(spark, str(tmp_path / "p.tsv"))) == [("a", "가")]
    (tmp_path / "p.jsonl").write_text('{"en": "a", "ko": "나"}\n', encoding="utf-8")
    assert rows(io.read_pairs(spark, str(tmp_path / "p.jsonl"))) == [("a", "나")]
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]', encoding="utf-8")
    assert io.read_array(spark, str(tmp_path / "a.json"), "x int").count() == 2
    (tmp_path / "u.txt").write_text(" a \n\n", encoding="utf-8")
    assert rows(io.read_units(spark, str(tmp_path / "u.txt"), ["z"])) == [("a",)]
    df = spark.createDataFrame([(1, "abc", None), (2, "def", "bad")], "id int, text string, reason string")
    io.write_flagged(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).where("kept = 'true'").count() == 1
    assert rows(io.head_of_corpus(df, 4, order="id").select("text"), "text") == [("abc",), ("d",)]
    io.save_thresholds({"a": 0.5}, str(tmp_path / "t.json"))
    assert io.load_thresholds(str(tmp_path / "t.json")) == {"a": 0.5}
    w = spark.createDataFrame([("k", "/d/k", 0.5), ("e", "/d/e", 0.5)], "source string, path string, weight double")
    io.write_blend(w, str(tmp_path / "b.yaml"), 60.0, 4096)
    assert "- - \"/d/k\"\n  - 0.5" in (tmp_path / "b.yaml").read_text()
    doc = {"model": {"vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b"]}, "added_tokens": [{"content": "ab", "id": 2, "special": True}]}
    (tmp_path / "tok.json").write_text(json.dumps(doc))
    v, m, added = io.read_tokenizer(spark, str(tmp_path / "tok.json"))
    assert rows(v, "id") == [("a", 0), ("b", 1), ("ab", 2)] and rows(m) == [(0, "a", "b")] and rows(added) == [("ab", 2, True)]
    io.write_tokenizer(str(tmp_path / "tok.json"), str(tmp_path / "new.json"), v, m)
    assert json.loads((tmp_path / "new.json").read_text()) == doc


def test_flows(spark):
    m = "id int, messages array<struct<role string, content string>>"
    native = spark.createDataFrame([(k, [("assistant", "갑니다. 왔습니다.")]) for k in range(5)] + [(9, [("assistant", "갑니다. 간다.")])], m)
    made, why = flows.fine_tuning_blend(native, native.where("id < 3"), native.limit(2), order="id", total=50)
    assert sorted(rows(made.groupBy("pool").count())) == [("native", 35), ("replay", 5), ("translated", 10)]
    assert {(r.source_pool, r.reason) for r in why.collect()} == {("native", "kept"), ("native", "register_mix"), ("translated", "kept")}
    problems = spark.createDataFrame([(1, "1+1", "2"), (2, "1+2", "3")], "problem_id int, problem string, gold string")
    model = hooks.fake_model(["답: 2", "답: 3", "모름"], k=6)
    kept, pairs, rate = flows.verified_solutions(problems, model, lambda o, g: verify.verify_number(o, g), F.col("problem"))
    assert all(r.correct for r in kept.collect()) and rate.first().problems == 2 and kept.groupBy("problem_id").count().where("count > 2").count() == 0
    assert flows.bootstrapped_solutions(problems, model, lambda o, g: verify.verify_number(o, g), []).count() >= kept.count()
    seeds = spark.createDataFrame([("강을 설명하시오 짧게",), ("산을 그리시오 크게",)], "instruction string")
    grown = flows.grown_instructions(seeds, hooks.fake_model(["1. 바다를 설명하시오 길게\n2. 나무를 세어 보시오 천천히"]), hooks.fake_model(["좋은 답을 길게 씁니다"]), rounds=2, prompts=2)
    assert sorted(r.instruction for r in grown.collect()) == ["나무를 세어 보시오 천천히", "바다를 설명하시오 길게"]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [{"t": x, "at": f"2031-01-01T00:0{k}:00"} for k, x in enumerate(["갑니다. 간다.", "갑니다. 옵니다.", "갑니다. 옵니다."])]
    (tmp_path / "in/a.json").write_text("\n".join(map(json.dumps, lines)), encoding="utf-8")
    stream = spark.readStream.schema("t string, at timestamp").json(str(tmp_path / "in"))

    def run(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    assert sorted(str(r.reason) for r in run(streams.filtered_stream(stream, "t"), "filtered", "append")) == ["None", "None", "register_mix"]
    assert len(run(streams.first_copies(stream, "t", "at"), "copies", "append")) == 2
    assert sum(r.rows for r in run(streams.reason_counts(streams.filtered_stream(stream, "t"), "at"), "counts", "complete")) == 3


def test_flows_with_models(spark):
    from onggi.plans import flows, hooks

    chats = spark.createDataFrame([(1, [("user", "a `b`"), ("assistant", "한국어 **c**")]), (2, [("assistant", "plain words")]), (3, None)], "id int, m array<struct<role string, content string>>")
    out = {r.id: r for r in flows.translated_chats(chats, str.upper, messages="m").collect()}
    assert [t.content for t in out[1].m] == ["A `b`", "한국어 **C**"] and out[1].reason is None and out[2].reason == "low_language" and out[3].m is None
    p = spark.createDataFrame([(1, "말 `x`", "g")], "id int, problem string, gold string")
    assert rows(flows.translated_problems(p, lambda t: t.replace("말", "글"))) == [(1, "글 `x`", "g")]
    prompts = spark.createDataFrame([(f"물음 {k}",) for k in range(12)], "prompt string")
    got = flows.sampled_preferences(prompts, hooks.fake_model(["갑니다. 갑니다.", "abc def"], 2)).collect()
    assert got and all(r.chosen == "갑니다. 갑니다." and r.rejected == "abc def" for r in got)
    jobs = spark.createDataFrame([("```python\nx = 1\n```", "assert x"), ("y", "assert")], "output string, tests string")
    ran = hooks.run_code(jobs, "output", "tests", lambda: lambda batch: [json.loads(j)["code"] == "x = 1" for j in batch])
    assert sorted(r.verified for r in ran.collect()) == [False, True]


def test_ranks_and_heads_do_without_one_task(spark, tmp_path):
    from onggi.operators.common import ranked
    from onggi.sources import io

    df = spark.range(500).withColumn("g", F.when(F.col("id") % 3 > 0, F.col("id") % 3)).withColumn("t", F.repeat(F.lit("가"), F.col("id").cast("int") % 7))
    h = text.stable_hash(0, "id")
    want = df.withColumn("h", h).toPandas().sort_values(["h", "id"])
    want["r"] = want.groupby("g", dropna=False).cumcount() + 1
    got = ranked(df, "g", h, "id", ranges=16).toPandas()
    assert dict(zip(got.id, got._rank)) == dict(zip(want.id, want.r)) and set(got._rows) == set(want.groupby("g", dropna=False).size())
    head = io.head_of_corpus(df, 100, order="id", column="t").orderBy("id").collect()
    assert "".join(r.t for r in head) == "".join("가" * (k % 7) for k in range(500))[:100]
    spark.range(20).selectExpr("cast(id as string) AS q").write.json(f"{tmp_path}/a/train.jsonl")
    assert io.read_dataset(spark, str(tmp_path), "q string", lambda d: d.where("q > '1'"), subset="a", limit=5).count() == 5
    with pytest.raises(FileNotFoundError):
        io.read_dataset(spark, str(tmp_path), "q string", lambda d: d, split="none")


def test_passages_of_a_pool(spark):
    base = " ".join(f"낱말{k}" for k in range(60))
    near = base.replace("낱말30", "다른말")
    texts = ["짧다", base, base, near, " ".join(f"글{k}" for k in range(60)), None, " ".join(f"새{k}" for k in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    held = spark.createDataFrame([("글3 글4 글5 글6 글7",)], "text string")
    got = {r.id: r.reason for r in cluster.passage_pool(df, held).collect()}
    assert got == {0: "length", 1: None, 2: "copy", 3: "near_copy", 4: "leak", 5: "length", 6: None}
