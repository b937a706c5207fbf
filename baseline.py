"""Plain single-process Python loops over the same rows, to hold bench.py's seconds against: one JSON line, the median of three runs."""

from __future__ import annotations

import json
import os
import re
import statistics
import time
import unicodedata

import pyarrow.parquet as pq

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def column(table: str, name: str) -> list:
    return pq.read_table(f"{SF}/{table}.parquet", columns=[name]).column(name).to_pylist()


def script_fraction() -> int:
    out = 0
    for text in column("documents", "text"):
        if text is not None:
            kinds = [unicodedata.name(ch, "") for ch in text if ch.isalpha()]
            if kinds:
                out += round(sum("HANGUL" in k for k in kinds) / len(kinds), 6) + round(sum("LATIN" in k for k in kinds) / len(kinds), 6) > 0
    return out


def ngram_coverage() -> int:
    grams = set()
    for text in column("documents", "text"):
        words = (text or "").lower().split()
        grams.update(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    return len(grams)


def surface_features() -> int:
    import onggi.functions.text as t

    patterns = [re.compile(re.sub(r"\\p\{[LN]\}", r"\\w", x)) for x in t.TRANSLATION_PATTERNS.values()]
    return sum(len(p.findall(text)) for text in column("documents", "text") if text for p in patterns)


def pairwise_cosine() -> float:
    rows = [x for x in column("embeddings", "embedding") if x]
    unit = [[v / n for v in x] for x in rows if (n := sum(v * v for v in x) ** 0.5)]
    total = [sum(c) for c in zip(*unit)]
    return sum(s * s for s in total)


def p6_found() -> int:
    texts = column("predictions", "prediction") + [m["content"] for x in column("chats", "messages") for m in x or [] if m["role"] == "assistant"]
    found = 0
    for text in texts:
        plain = re.sub(r"[\W_]", "", unicodedata.normalize("NFKC", text or "").lower())
        seen, cover = set(), bytearray(len(plain))
        for k in range(len(plain) - 11):
            piece = plain[k : k + 12]
            if piece in seen:
                cover[k : k + 12] = b"\1" * 12
            seen.add(piece)
        found += bool(plain) and 3 * sum(cover) >= len(plain)
    return found


def main() -> None:
    seconds = {}
    for f in (script_fraction, surface_features, ngram_coverage, pairwise_cosine, p6_found):
        took = []
        for _ in range(3):
            began = time.time()
            f()
            took.append(time.time() - began)
        seconds[f.__name__] = round(statistics.median(took), 3)
    print(json.dumps({"metric": "plain Python, one process", "unit": "sec", "queries": seconds, "sf": SF}))


if __name__ == "__main__":
    main()
