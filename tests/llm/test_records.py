"""Near copies, look-alikes, repetition, shared spans and leaks, each against brute force on small fixtures."""

import random

import pytest

from onggi.llm import common as c
from onggi.llm import leakage, lookalikes, near_duplicates, repetition, shared_spans

WORDS = [f"{a}{b}" for a in ("가람", "나루", "다온", "마루", "바람", "사이", "orbit", "ledger", "Sotaro", "Vené") for b in ("", "는", "의", "에서", "를")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(900)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = [sentence(rng, rng.randrange(30, 60)) for _ in range(60)]
    for k in range(30):
        words = out[k].split()
        for _ in range(rng.randrange(1, 12)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        out.append(" ".join(words))
    return out + [out[0], out[1], "", " ", "짧은 글", "a" * 5000, out[2].replace("orbit", "оrbit").replace(" ", " "), out[3].replace("a", "ａ")]


def rows(texts, src="t"):
    return [(src, k, t, "x") for k, t in enumerate(texts)] + [(src, 10_000, None, "x")]


def frame(spark, texts):
    return spark.createDataFrame(rows(texts), "src string, rec_id bigint, text string, form string").repartition(3)


EMPTY = "src string, rec_id bigint, text string, form string"


def test_one_form_of_text():
    assert c.canon("Ｌｉａ​ｔо é") == "Liato é"
    assert c.canon("²É") == "²É" and c.canon("金") == c.canon("金")
    assert c.letters("Ａ-b_c ².​가") == "abc²가"
    assert c.canon("한") == "한"


def test_near_copies_are_those_of_brute_force(spark, texts):
    sets, forms = [], [c.canon(t) for t in texts]
    for t in texts:
        plain = c.letters(t)
        sets.append({plain[k : k + 5] for k in range(len(plain) - 4)} if len(t) >= 120 else set())
    want = {("t", a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if sets[a] and sets[b] and forms[a] != forms[b] and len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 3}
    assert want
    for block, buckets in ((2048, 1 << 20), (4, 4096)):  # small trees, and trees cut into blocks; counts alone in their bucket, and many in one
        assert {tuple(r) for r in near_duplicates.near_duplicates(frame(spark, texts), block=block, buckets=buckets).collect()} == want
    assert near_duplicates.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


def test_equal_texts_are_one_leaf(spark):
    text = sentence(random.Random(6), 40)
    other = text[:100] + "거너더러머버서어저처커터퍼허" + text[100:]
    rows = [("t", k, text, "x") for k in range(6000)] + [("t", 9000, other, "x"), ("t", 9001, text.replace(" ", ". "), "x")] * 2
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, EMPTY))
    assert got.count() == got.distinct().count() == 6000 * 2 + 1  # 9000 with all others, 9001 (the same letters) with all others
    got = lookalikes.lookalike_pairs(spark.createDataFrame(rows[:6000] + [("t", 9002, text.replace(" ", "\u00a0"), "x")], EMPTY))
    assert got.count() == 6000


def test_forest_loses_no_pair():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = [frozenset(rng.integers(0, 400, rng.integers(5, 60)).tolist()) for _ in range(200)]
    sets += [frozenset(list(s)[2:] + [999]) for s in sets[:50]]
    sets.sort(key=len)
    bits = np.zeros((len(sets), 2048), bool)
    for k, s in enumerate(sets):
        bits[k, list(s)] = True
    packed = np.packbits(bits, axis=1).view(np.uint64)
    size = np.array([len(s) for s in sets])
    forest = near_duplicates.Forest(np.zeros(len(sets), np.int64), size, packed)
    found = {(int(i), int(j)) for a, b in forest.pairs(3, 5, chunk=100) for i, j in zip(a, b)}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(sets[i] & sets[j]) * 5 >= 3 * len(sets[i] | sets[j])}
    assert want and want <= found and len(found) < len(sets) ** 2 / 4
    assert len(forest.levels) > 3 and all(forest.seen[k, False] for k in range(3))  # pairs of nodes are pruned at every level


def test_bitmaps_of_two_widths_meet():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 50, n)) for n in rng.integers(100, 500, 60)]
    sets += [np.unique(np.r_[s[: int(len(s) * 0.9)], rng.integers(0, 1 << 50, int(len(s) * k))]) for s in sets[:40] for k in (0.05, 0.3)]
    maps = []
    for s in sets:
        bits = np.zeros(near_duplicates.words_for(len(s)) * 64, bool)
        bits[s % len(bits)] = True
        maps.append(np.packbits(bits).tobytes())
    n = np.array([len(s) for s in sets])
    group, unit = np.arange(len(sets)) % 3 * 0, np.arange(len(sets))
    a, b = near_duplicates.similar(group, unit, n, pa.array(maps, pa.binary()), 3, 5)
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(np.intersect1d(sets[i], sets[j])) * 5 >= 3 * len(np.union1d(sets[i], sets[j]))}
    assert want and want <= set(zip(a.tolist(), b.tolist())) and len({len(m) for m in maps}) > 1 and len(a) < len(sets) ** 2 / 4


def test_lookalikes_are_those_of_the_table(spark, texts):
    forms = [c.canon(t) for t in texts]
    want = {("t", a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if len(texts[a]) >= 120 <= len(texts[b]) and forms[a] == forms[b] and texts[a] != texts[b]}
    assert len(want) >= 2
    assert {tuple(r) for r in lookalikes.lookalike_pairs(frame(spark, texts)).collect()} == want
    assert lookalikes.lookalike_pairs(spark.createDataFrame([], EMPTY)).count() == 0
    assert {(r.rec_id, r.form) for r in lookalikes.one_form(frame(spark, texts)).collect()} == set(enumerate(forms))


def test_trie_pays_for_edits():
    trie = lookalikes.Trie()
    for w, n in (("orbit", 5), ("orbits", 2), ("café", 1), ("한글", 3)):
        trie.add(w, n)
    assert trie.match("оr​bit") == "orbit" and trie.match("ｃａｆé") == "café" and trie.match("한글") == "한글"
    assert trie.match("orbid") is None and trie.match("orbid", budget=1) == "orbit" and trie.match("cafe", budget=0) is None
    assert trie.match("cafe", budget=1) == "café"


def test_half_an_edit_finds_lookalikes_that_the_table_lacks(spark):
    trie = lookalikes.Trie()
    trie.add("CAFE", 3)
    assert trie.match("CᎪFE", 0.5) == "CAFE" and trie.match("CᎪFE") is None and trie.match("CXFE", 0.5) is None and trie.match("C가FE", 0.5) is None
    assert lookalikes.own_script("Температура") == "Температура" and lookalikes.own_script("оrbit") == "orbit"


@pytest.mark.parametrize("budget", [0.0, 0.5])
def test_a_hot_branch_is_split(spark, budget):
    usual = [f"http://site{k}.example/page" for k in range(60)] + ["orbit", "온도"]
    odd = [f"http://sitе{k}.example/page" for k in range(0, 60, 7)] + ["оrbit", "температура", "​온도"]
    df = spark.createDataFrame(rows([" ".join(usual), " ".join(odd), "", " "]), EMPTY)
    got = [{r.word: (r.spelling, r.form, r.matched) for r in lookalikes.spellings(df, budget=budget, most=most).collect()} for most in (50_000, 8)]
    assert got[0] == got[1] and len(got[0]) >= len(odd)
    assert all(got[0][w] == (c.canon(w), c.canon(w), True) for w in odd if w != "температура")
    assert got[0]["температура"] == ("температура", c.canon("температура"), False)
    assert lookalikes.spellings(df.limit(0), budget=budget).count() == 0


@pytest.mark.parametrize("budget", [0.0, 0.5, 1.0, 1.5])
def test_paid_edits_are_found_in_every_place(spark, budget):
    usual = ["CAFE", "ledger", "ledgers", "orbit", "on", "a", "café", "온도", "온도계", "\u1ec7x"]
    mixed = ["ᎪFE", "ᏟAFE", "CᎪFE", "CAFᎬ", "ᎪAFE", "Ꮎrbit", "Ꮎn"]  # unusual only where edits are paid
    odd = ["l\u0435dger", "l\u0435dgrs", "\u0435dger", "\u043eᎡbit", "\u0430", "β", "\u200b도", "\u200b온돠", "cafe\u200b", "e\u0302\u200b\u0323x", "\u200b", "температура"] + (mixed if budget else [])
    df = spark.createDataFrame(rows([" ".join(usual * 2), " ".join(odd + mixed), " \u00a0", None]), EMPTY)
    trie = lookalikes.Trie()
    for w in usual:
        trie.add(w, 2)
    want = {w: trie.match(w, budget) for w in odd} | {" \u00a0": None}  # blanks are no spelling of a word
    assert want["e\u0302\u200b\u0323x"] == "\u1ec7x"
    assert budget != 0.5 or [want[w] for w in mixed] == [None, "CAFE", "CAFE", "CAFE", "CAFE", "orbit", "on"]
    assert budget != 1 or (want["\u0435dger"], want["\u200b온돠"], want["ᎪFE"]) == ("ledger", "온도", None)
    for most in (50_000, 2):
        got = lookalikes.spellings(df, budget=budget, most=most).collect()
        assert sorted(r.word for r in got) == sorted(want)
        assert {r.word: r.spelling if r.matched else None for r in got} == want


def test_a_spelling_that_asks_several_blocks_comes_once(spark):
    usual = " ".join("x" * 70 + str(k) for k in range(40))
    df = spark.createDataFrame(rows([usual, usual.replace("x", "х", 1), usual.replace("x7", "х7")]), EMPTY)
    got = lookalikes.spellings(df, most=8).collect()
    assert len(got) == len({r.word for r in got}) and all(r.matched for r in got)


def test_letters_without_a_composed_form_are_seen(spark):
    tail = "0123456789 " * 12
    alike = [("\u0958", "\u0915\u093c"), ("\u09cb", "\u09c7\u09be"), ("\u2329", "\u3008"), ("\ufb4b", "\u05d5\u05b9"), ("\U0001d15e", "\U0001d157\U0001d165"), ("\U0001109a", "\U00011099\U000110ba")]
    df = frame(spark, [x + f"{k} " + tail for k, pair in enumerate(alike) for x in pair])
    assert {tuple(r) for r in lookalikes.lookalike_pairs(df).collect()} == {("t", 2 * k, 2 * k + 1) for k in range(len(alike))}


def test_shares_of_texts_without_letters_are_zero(spark, tmp_path):
    texts = ["", "!!!", "\n", "줄\n줄", None]
    spark.createDataFrame([(k, t, "a") for k, t in enumerate(texts)], "pred_id bigint, prediction string, source string").write.parquet(f"{tmp_path}/predictions.parquet")
    spark.createDataFrame([(1, [("assistant", "?")], "a")], "chat_id bigint, messages array<struct<role: string, content: string>>, source string").write.parquet(f"{tmp_path}/chats.parquet")
    got = {(r.src, r.rec_id): r for r in repetition.p6_measures(spark, str(tmp_path)).collect()}
    assert len(got) == 5 and all(got["predictions", k].share_12 == 0 for k in range(4)) and got["predictions", 3].share_lines == 0.5 and got["predictions", 0].share_lines == 0


def test_repetition_is_that_of_a_plain_loop(spark):
    rng = random.Random(5)
    texts = [sentence(rng, 40), "같은 말을 또 합니다. " * 9, "a" * 200, "", " ", "짧다", "x" * 30_000, sentence(rng, 20) + "\n" + "줄이 같다\n" * 6]

    def share(t, n):
        plain, seen = c.letters(t), set()
        cover = bytearray(len(plain))
        for k in range(len(plain) - n + 1):
            if plain[k : k + n] in seen:
                cover[k : k + n] = b"\1" * n
            seen.add(plain[k : k + n])
        return sum(cover)

    got = {r.rec_id: r for r in repetition.repetition(frame(spark, texts)).collect()}
    assert {k: (r.rep_12, r.rep_24, r.n_letters) for k, r in got.items()} == {k: (share(t, 12), share(t, 24), len(c.letters(t))) for k, t in enumerate(texts)}
    assert got[7].rep_line_chars == 5 * 5
    assert repetition.repeating(spark.createDataFrame([], EMPTY)).count() == 0


def spans(texts, n):
    owners = {}
    for d, t in texts.items():
        for k in range(len(t) - n + 1):
            owners.setdefault(t[k : k + n], set()).add(d)
    out = set()
    for d, t in texts.items():
        now = None
        for k in range(len(t) - n + 1):
            if len(owners[t[k : k + n]]) > 1:
                if now and k <= now[1]:
                    now[1] = k + n
                else:
                    if now:
                        out.add((d, *now))
                    now = [k, k + n]
        if now:
            out.add((d, *now))
    return out


def test_shared_spans_are_those_of_brute_force(spark):
    rng = random.Random(9)
    block = [sentence(rng, 12) for _ in range(4)]
    texts = {}
    for d in range(60):
        parts = [sentence(rng, rng.randrange(1, 12)) for _ in range(3)]
        if d % 3:
            parts.insert(rng.randrange(4), rng.choice(block)[rng.randrange(20) :])
        texts[d] = " ".join(parts)
    texts |= {100: texts[0], 101: texts[0], 102: "z" * 900, 103: "y" + "z" * 700, 104: "", 105: "short", 106: block[0] * 3}
    df = spark.createDataFrame([(d, t, 0) for d, t in texts.items()] + [(200, None, 0)], "doc_id bigint, text string, unit int")
    want = spans(texts, 40)
    for group in (4096, 3):  # groups in memory, and prefixes that are too frequent
        assert {tuple(r) for r in shared_spans.shared_spans(df, span=40, group=group).collect()} == want
    assert shared_spans.shared_spans(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_leaks_are_those_of_brute_force(spark):
    rng = random.Random(2)
    items = {k: sentence(rng, 14) for k in range(25)}
    docs = {}
    for d in range(80):
        text = sentence(rng, 40)
        if d % 2:
            item = items[rng.randrange(25)]
            low = rng.randrange(len(item) // 3)
            at = rng.randrange(len(text))
            text = text[:at] + item[low : low + rng.randrange(40, 130)] + text[at:]
        docs[d] = text
    docs |= {100: "", 101: "w" * 3000, 102: docs[1]}

    def leaked(doc, item, n=60):
        a, b = c.letters(doc), c.letters(item)
        return any(b[k : k + n] in a for k in range(len(b) - n + 1))

    want = {(d, k) for d, t in docs.items() for k, i in items.items() if leaked(t, i)}
    assert want
    left = spark.createDataFrame([(d, t, 1) for d, t in docs.items()] + [(103, None, 1)], "doc_id bigint, text string, run int")
    right = spark.createDataFrame([*items.items(), (99, None), (98, "")], "item_id bigint, text string")
    found = leakage.leaks(left, right).where("run > 0")
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    assert leakage.leaks(left, right.where("item_id > 1000")).count() == 0
    assert leakage.leaks(left.where("doc_id < 0"), right).count() == 0


def test_reworded_items_are_found_and_answers_count(spark):
    rng = random.Random(21)
    items = {k: sentence(rng, 14) for k in range(20)} | {k: " ".join(rng.choice(WORDS) for _ in range(18)) for k in range(20, 30)}
    docs, other = {}, {}
    for d in range(90):
        words = items[d % 30].split()
        for k in range(rng.randrange(4), len(words), 4 + d % 3):  # words are replaced, numbers and the longest words stay
            if not leakage.answers(items[d % 30]) & {c.letters(words[k])}:
                words[k] = rng.choice(WORDS) + "".join(x for x in words[k] if x.isdigit())
        docs[d] = sentence(rng, rng.randrange(5, 30)) + " " + " ".join(words) + " " + sentence(rng, rng.randrange(5, 30))
        other[1000 + d] = docs[d].translate(str.maketrans("0123456789", "3456789012"))  # the same words with other numbers
    sh = leakage.REWORDED

    def best(doc, item):
        a, n = c.letters(doc), len(c.letters(item))
        words, begin = leakage.spoken(doc)
        cuts = [(max(0, k - n), k + sh.window + n) for k in range(0, max(1, len(a) - sh.window + 1), sh.step)]
        cuts = [(i, j) for i, j in cuts if all(x in a[i:j] for x in leakage.answers(item))]
        return max((leakage.words_in_order(leakage.spoken(item)[0], [w for w, b in zip(words, begin) if i <= b < j]) for i, j in cuts), default=0)

    def verbatim(doc, item, n=60):
        a, b = c.letters(doc), c.letters(item)
        return any(b[k : k + n] in a for k in range(len(b) - n + 1))

    every = docs | other | {5000: "", 5001: "w" * 300}
    want = {(d, k) for d, t in every.items() for k, i in items.items() if best(t, i) >= 0.7 and not verbatim(t, i)}
    left = spark.createDataFrame([*every.items(), (5002, None)], "doc_id bigint, text string")
    right = spark.createDataFrame([*items.items(), (99, None), (98, "")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(left, right, share=0.7).where("run = 0 and lcs >= 0.7 and answers").collect()}
    planted = {(d, d % 30) for d in docs} & want  # others meet the bar by chance, in a fixture of fifty words
    assert got <= want and len(planted) > 60 and len(got & planted) >= 0.9 * len(planted)
    assert not any(d >= 1000 and d - 1000 in docs and k < 20 and leakage.answers(items[k]) for d, k in got)


def test_cells_lose_no_window():
    import numpy as np

    rng = np.random.default_rng(3)
    items = [(k, "".join(chr(0xAC00 + int(x)) for x in rng.integers(0, 900, 90))) for k in range(30)]
    space = rng.normal(size=(leakage.FEATURES, 16)).astype(np.float32)
    asked = np.concatenate([leakage.windows(t[7:], space, 15, leakage.VERBATIM) for _, t in items] + [leakage._unit(rng.normal(size=(200, 16))).astype(np.float32)])
    for near in (leakage.SAME, 0.9, 0.5):
        index = leakage.Index(items, space, leakage.VERBATIM, near)
        row, item, cosine = index.search(asked)
        full = asked @ index.vectors.T
        assert len(row) == (full >= near).sum() >= 30 * 3 and sorted(zip(row.tolist(), item.tolist())) == sorted((int(a), int(index.owner[b])) for a, b in zip(*np.nonzero(full >= near)))


def test_common_subsequence():
    assert leakage.common_subsequence("abcde", "xaxcxe") == 3 and leakage.common_subsequence("가나다", "") == 0
    assert leakage.longest_run("0123456789" * 2, "ab0123456789c", 8) == 10


def test_paraphrases_are_those_of_brute_force(spark, tmp_path):
    rng = random.Random(12)
    items = {k: sentence(rng, 14) for k in range(12)} | {k: " ".join(rng.choice(WORDS) for _ in range(26)) for k in range(12, 20)}
    docs = {}
    for d in range(60):
        words = items[d % 20].split()
        for k in range(rng.randrange(4), len(words), 3 + d % 3):  # a changed word in most windows, the numbers kept
            words[k] = "".join(chr(rng.randrange(0xAC00, 0xD7A3)) for _ in range(3)) + "".join(x for x in words[k] if x.isdigit())
        docs[d] = sentence(rng, rng.randrange(1, 30)) + " " + " ".join(words) + " " + sentence(rng, rng.randrange(1, 30))
    docs |= {100: items[0], 101: "", 102: "w" * 300, 103: docs[1]}

    def best(doc, item):
        a, b = c.letters(doc), c.letters(item)
        said = [(m.group(), m.start(), m.end()) for m in leakage._NUMBERS.finditer(a)]
        low_high = [(max(0, k - len(b)), k + leakage.WINDOW + len(b)) for k in range(0, max(1, len(a)), leakage.STEP)]
        stretches = [(i, j) for i, j in low_high if set(leakage._NUMBERS.findall(b)) <= {x for x, u, v in said if i <= u and v <= j}]
        return max((leakage.common_subsequence(b, a[i:j]) for i, j in stretches), default=0) / len(b)

    def verbatim(doc, item, n=60):
        a, b = c.letters(doc), c.letters(item)
        return any(b[k : k + n] in a for k in range(len(b) - n + 1))

    want = {(d, k, round(x, 6)) for d, t in docs.items() for k, i in items.items() if (x := best(t, i)) >= 0.7 and not verbatim(t, i)}
    assert len({d for d, _, _ in want}) > 30
    spark.createDataFrame([*docs.items(), (104, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*items.items(), (99, None), (98, "")], "item_id bigint, text string").write.parquet(f"{tmp_path}/eval_items.parquet")
    assert {tuple(r) for r in leakage.p8_paraphrased(spark, str(tmp_path)).collect()} == want
    left, right = (spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in ("documents", "eval_items"))
    assert {tuple(r) for r in leakage.paraphrases(left, right, block=7).collect()} == want
    assert leakage.paraphrases(left.limit(0), right).count() == leakage.paraphrases(left, right.limit(0)).count() == 0
