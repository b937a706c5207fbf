"""Text features as columns: scripts, words, sentences, speech levels, signs of translation. No Python runs per row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import profiles as p

ColumnLike = Column | str


def col(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def quote(chars: Iterable[str]) -> str:
    """A regular expression's character class of these characters."""
    return "[" + "".join("\\" + ch if ch in "\\]^-[&'\"" else ch for ch in chars) + "]"


def any_of(words: Iterable[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def let(value: Column, body) -> Column:
    """body(value) with the value evaluated once: inside a lambda an outer expression would be evaluated for every element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def strip(x: ColumnLike) -> Column:
    """Without white space at the ends, of any kind."""
    return F.regexp_replace(col(x), r"(?U)^\s+|\s+$", "")


def words(x: ColumnLike) -> Column:
    """Words between white space, none empty."""
    return F.filter(F.split(col(x), r"(?U)\s+"), lambda w: w != "")


def word_count(x: ColumnLike) -> Column:
    return F.size(words(x))


def letter_count(x: ColumnLike) -> Column:
    return F.length(F.regexp_replace(col(x), r"[^\p{L}]", ""))


def _share(x: ColumnLike, script: str, empty: float) -> Column:
    n = letter_count(x)
    return F.when(n == 0, F.lit(empty)).otherwise(F.length(F.regexp_replace(col(x), rf"[^\p{{L}}]|[^\p{{Is{script}}}]", "")) / n)


def hangul_fraction(x: ColumnLike, empty: float = 0.0) -> Column:
    """Share of Hangul among the letters; ``empty`` for a text without letters (callers differ, so it is a parameter)."""
    return _share(x, "Hangul", empty)


def latin_fraction(x: ColumnLike) -> Column:
    return _share(x, "Latin", 0.0)


def code_switched(x: ColumnLike, min_hangul: float = 0.6, max_latin: float = 0.15) -> Column:
    return (letter_count(x) > 0) & ((hangul_fraction(x) < min_hangul) | (latin_fraction(x) > max_latin))


def hangul_chars(x: ColumnLike) -> Column:
    return F.length(F.regexp_replace(col(x), r"[^\p{IsHangul}]", ""))


def has_syllable(x: ColumnLike) -> Column:
    return col(x).rlike("[가-힣]")


def has_final_consonant(x: ColumnLike) -> Column:
    """Whether the last character is a Hangul syllable with a final consonant; decides between forms of a particle."""
    last = F.right(col(x), F.lit(1))
    return F.when(last.rlike("^[가-힣]$"), (F.ascii(last) - 0xAC00) % 28 != 0).otherwise(False)


def with_particle(x: ColumnLike, after_consonant: str, after_vowel: str) -> Column:
    return F.concat(col(x), F.when(has_final_consonant(x), after_consonant).otherwise(after_vowel))


def without_particle(word: Column) -> Column:
    """The longest particle that leaves two characters is taken off: the shortest stem of two or more, in one pattern."""
    return F.regexp_replace(word, f"^(.{{2,}}?){any_of(p.PARTICLES)}$", "$1")


def bare(word: Column) -> Column:
    edge = quote(p.WORD_EDGES)
    return F.regexp_replace(word, f"^{edge}+|{edge}+$", "")


def content_words(x: ColumnLike, *, hangul_only: bool = True, stop: Iterable[str] = p.STOP_WORDS) -> Column:
    """Distinct words without marks and particles, of two characters or more, no stop words; numbers stay unless ``hangul_only``."""
    stems = F.transform(words(x), lambda w: without_particle(bare(w)))
    stops = F.array(*map(F.lit, stop))
    keep = lambda w: (F.length(w) >= 2) & ~F.array_contains(stops, w) & ((hangul_fraction(w) > 0.5) if hangul_only else F.lit(True))
    return F.array_distinct(F.filter(stems, keep))


def token_set(x: ColumnLike) -> Column:
    """Distinct words longer than one character, then without marks."""
    return F.array_distinct(F.transform(F.filter(words(x), lambda w: F.length(w) > 1), bare))


def overlap(source: Column, answer: Column) -> Column:
    """Share of the source's set that the answer has; 1 for an empty source."""
    return let(source, lambda s: F.when(F.size(s) == 0, 1.0).otherwise(F.size(F.array_intersect(s, answer)) / F.size(s)))


def jaccard(a: Column, b: Column, empty: float = 0.0) -> Column:
    share = lambda x, y: F.when((F.size(x) == 0) | (F.size(y) == 0), empty).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))
    return let(F.struct(a.alias("a"), b.alias("b")), lambda v: share(v["a"], v["b"]))


def sentences(x: ColumnLike) -> Column:
    return F.filter(F.transform(F.split(col(x), f"{quote(p.SENTENCE_BREAKS)}+"), strip), lambda s: s != "")


def scrubbed(x: ColumnLike) -> Column:
    """Without code and quoted speech, whose speech level isn't that of the text."""
    out = col(x)
    for pattern in ("(?s)```.*?```", "`[^`]*`", "「[^」]*」", "『[^』]*』", '"[^"\n]{1,200}"', "'[^'\n]{1,200}'"):
        out = F.regexp_replace(out, pattern, " ")
    return out


def list_item(s: Column) -> Column:
    return (s == "") | (s.rlike(r"(?U)^(?:[-*•]\s|\d+[.)]\s|[①-⑳])") & (F.length(s) < 60))


def sentence_register(s: Column) -> Column:
    """Speech level of a sentence, or neutral."""
    body = F.regexp_replace(s, f"{quote(p.SENTENCE_TAIL)}+$", "")
    out = F.when((body == "") | list_item(s), "neutral")
    for alone, level in p.REGISTER_ALONE.items():
        out = out.when(body == alone, level)
    for level in p.REGISTERS:
        out = out.when(body.rlike(f"{any_of(p.REGISTER_ENDINGS[level])}$"), level)
    return out.otherwise("neutral")


def registers(x: ColumnLike) -> Column:
    """Speech level of each sentence of a text, code and quotations left out."""
    return F.transform(sentences(scrubbed(x)), sentence_register)


def _occurrences(values: Column, value: str) -> Column:
    return F.size(F.filter(values, lambda v: v == value))


def register_counts(levels: Column) -> Column:
    return F.struct(*(_occurrences(levels, k).alias(k) for k in (*p.REGISTERS, "neutral")))


def register_summary(levels: Column) -> Column:
    """struct(score, dominant, n): the first most frequent level, its share, and how many sentences have a level."""

    def summary(counts: Column) -> Column:
        n, most = F.aggregate(counts, F.lit(0), lambda a, c: a + c), F.array_max(counts)
        dominant = F.get(F.array(*map(F.lit, p.REGISTERS)), (F.array_position(counts, most) - 1).cast("int"))
        return F.struct(F.when(n == 0, 1.0).otherwise(most / n).alias("score"), F.when(n > 0, dominant).alias("dominant"), n.alias("n"))

    return let(levels, lambda v: let(F.array(*(_occurrences(v, k) for k in p.REGISTERS)), summary))


def register_consistent(summary: Column, threshold: float = 0.8, least: int = 2) -> Column:
    return let(summary, lambda r: (r["n"] < least) | (r["score"] >= threshold))


def register_is(summary: Column, target: Column | str) -> Column:
    return F.coalesce(let(summary, lambda r: (r["n"] > 0) & (r["dominant"] == target)), F.lit(False))


_AFTER = r"(?![\p{L}\p{N}_])"  # the end of a word
TRANSLATION_PATTERNS = {
    "pronoun_per_100c": f"{any_of(p.PRONOUNS)}{any_of(p.PRONOUN_PARTICLES)}{_AFTER}",
    "passive_per_100c": f"{any_of(p.PASSIVES)}{_AFTER}",
    "deul_per_100c": f"들{any_of(p.PLURAL_PARTICLES)}{_AFTER}",
    "connective_per_sent": rf"(?:^|[.!?。…]\s*){any_of(p.CONNECTIVES)}",
    "thing_end_ratio": rf"것{any_of(p.THING_ENDINGS)}[.?!]?\s*$",
    "dem_dep_per_100c": rf"(?:^|[\s(])[이그저]\s+{any_of(p.DEPENDENT_NOUNS)}{any_of(p.DEPENDENT_PARTICLES)}?{_AFTER}",
    "chain_deep_count": r"[가-힣]{1,8}의\s+[가-힣]{1,8}의\s+[가-힣]{1,8}의",
    "chain_med_per_100c": r"[가-힣]{1,8}의\s+[가-힣]{1,8}의",
}


def translation_features(x: ColumnLike) -> Column:
    """struct of the nine features of translated text; zeros for an empty one."""
    text = col(x)
    chars = F.greatest(F.length(text), F.lit(1))
    count = lambda name: F.regexp_count(text, F.lit("(?U)" + TRANSLATION_PATTERNS[name]))
    thing = lambda s: F.concat(s, F.lit(".")).rlike("(?U)" + TRANSLATION_PATTERNS["thing_end_ratio"])

    def features(split: Column) -> Column:
        n = F.greatest(F.size(split), F.lit(1))
        out = {name: 100.0 * count(name) / chars for name in p.THRESHOLDS if name.endswith("_100c")}
        out |= {
            "connective_per_sent": count("connective_per_sent") / n,
            "thing_end_ratio": F.size(F.filter(split, thing)) / n,
            "chain_deep_count": count("chain_deep_count").cast("double"),
            "sent_len_mean": F.aggregate(split, F.lit(0), lambda a, s: a + F.length(s)) / n,
        }
        return F.struct(*(out[name].alias(name) for name in p.THRESHOLDS))

    return let(sentences(text), features)


def fired(features: Column, thresholds: dict[str, float] | None = None) -> Column:
    """Names of the features above their thresholds."""
    limits = thresholds or p.THRESHOLDS
    return let(features, lambda f: F.filter(F.array(*(F.when(f[name] > limits[name], F.lit(name)) for name in p.THRESHOLDS)), lambda v: v.isNotNull()))


def translated(features: Column, least: int = 3, thresholds: dict[str, float] | None = None) -> Column:
    return F.size(fired(features, thresholds)) >= least


def ngrams(tokens: Column, n: int) -> Column:
    grams = lambda t: F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(t, i, n)))
    return let(tokens, lambda t: F.when(F.size(t) >= n, grams(t)).otherwise(F.array().cast("array<string>")))


def repeats_ngram(x: ColumnLike, n: int = 4, times: int = 3) -> Column:
    """Whether some n-gram of words stands ``times`` times: in sorted order it then meets itself; short texts never do."""
    met = lambda g: F.size(F.filter(F.zip_with(g, F.slice(g, F.lit(times), F.greatest(F.size(g), F.lit(1))), lambda a, b: a == b), lambda e: e)) > 0
    return let(words(x), lambda t: (F.size(t) >= n * times) & let(F.array_sort(ngrams(t, n)), met))


def is_json(x: ColumnLike) -> Column:
    """Whether a text is one JSON value and nothing else. The engine's parser stops behind the first value, so the text must also be whole inside a list and an object."""
    listed, named = F.concat(F.lit("["), strip(x), F.lit("]")), F.concat(F.lit('{"v":'), strip(x), F.lit("}"))
    return F.try_parse_json(listed).isNotNull() & F.try_parse_json(named).isNotNull() & (F.json_array_length(listed) == 1)


def follows_format(x: ColumnLike, kind: ColumnLike) -> Column:
    """Whether a text parses as JSON or has a list line, as ``kind`` asks; anything else is fine."""
    text, k = col(x), col(kind)
    return F.when(k == "json", is_json(text)).when(k == "list", text.rlike(r"(?:^|\n)(?U:\s)*(?:-|•|\d+[.)])(?U:\s)+")).otherwise(True)


def squeezed(x: ColumnLike) -> Column:
    return F.lower(F.regexp_replace(col(x).cast("string"), r"(?U)\s+", ""))


def retrieved(prediction: ColumnLike, answer: ColumnLike) -> Column:
    """Whether the answer stands in the prediction, white space and case aside."""
    return F.contains(squeezed(prediction), squeezed(answer))


def nearest_bucket(n: ColumnLike, buckets: Iterable[int] = p.LENGTH_BUCKETS) -> Column:
    """The nearest of the buckets, the smaller one of two as near."""
    return F.array_min(F.array(*(F.struct(F.abs(col(n) - b).alias("far"), F.lit(b).alias("bucket")) for b in sorted(buckets))))["bucket"]


def final_span(x: ColumnLike, fallback: int = 300) -> Column:
    """From the last mark of a conclusion on, else the last characters."""
    text = col(x)
    found = F.regexp_extract(text, f"(?s)^.*({any_of(p.FINAL_MARKERS)}.*)$", 1)
    return strip(F.coalesce(F.when(found != "", found).otherwise(F.right(text, F.lit(fallback))), F.lit("")))


def step_structure(x: ColumnLike, markers: int = 2, lines: int = 3) -> Column:
    """Whether a text looks like reasoning in steps."""
    text = F.coalesce(col(x), F.lit(""))
    hits = sum((F.contains(text, F.lit(m)).cast("int") for m in p.STEP_MARKERS), F.lit(0))
    numbered = F.regexp_count(text, F.lit(r"(?m)^(?U:\s)*(?:\d+[.)]|[-*•])(?U:\s)+(?U:\S)"))
    filled = F.size(F.filter(F.split(text, r"\R"), lambda s: strip(s) != ""))
    return (hits >= markers) | (numbered >= 2) | ((filled >= lines) & (hits >= 1))


def acceptable_steps(x: ColumnLike, min_hangul: float = 0.7, least: int = 60, most: int = 6000) -> Column:
    return F.length(col(x)).between(least, most) & (hangul_fraction(x) >= min_hangul) & step_structure(x)


def acceptable_output(instruction: ColumnLike, output: ColumnLike, min_hangul: float = 0.7, least_words: int = 2, most: int = 4000) -> Column:
    return (word_count(output) >= least_words) & (F.length(col(output)) <= most) & (hangul_fraction(output) >= min_hangul) & (hangul_fraction(instruction) >= min_hangul)


def useful_critique(x: ColumnLike, least: int = 30) -> Column:
    text = F.coalesce(col(x), F.lit(""))
    return (F.length(text) >= least) & ~text.rlike(any_of(p.EMPTY_CRITIQUES))


def meaningful_revision(first: ColumnLike, revised: ColumnLike, far: float = 0.15) -> Column:
    changed = jaccard(token_set(first), token_set(revised), empty=2.0)  # an empty side is never far enough
    return F.coalesce((strip(first) != strip(revised)) & (1 - changed >= far), F.lit(False))


def acceptable_revision(first: ColumnLike, critique: ColumnLike, revised: ColumnLike, min_hangul: float = 0.7) -> Column:
    return (hangul_fraction(revised) >= min_hangul) & useful_critique(critique) & meaningful_revision(first, revised)


def grounded(answer: ColumnLike, source: ColumnLike, above: float = 0.1) -> Column:
    """Whether more than that share of the source's content words stands in the answer; an empty source is no obstacle."""
    return overlap(content_words(F.coalesce(col(source), F.lit(""))), content_words(answer)) > above


def strictly_faithful(lex: ColumnLike, pmi: ColumnLike, nli_margin: ColumnLike, tau_lex: float = 0.05, tau_pmi: float = 2.0, margin: float = 0.5) -> Column:
    return (col(lex) >= tau_lex) & ((col(pmi) >= tau_pmi) | (col(nli_margin) >= margin))


def stable_hash(seed: int | str, *keys: ColumnLike) -> Column:
    """A reproducible number below 2^60 from a seed and keys; the same in any SQL engine with md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *(col(k).cast("string") for k in keys))), 1, 15), 16, 10).cast("bigint")
