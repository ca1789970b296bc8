"""Source divergence against all shares of all terms, and skybands on their own."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from parley.llm import source_divergence as sd
from tests.llm import brute

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
EXTRA = "term string, n string, docs string, part string, rank string, value string, v string"


def plain(rows, min_docs, top):
    """{(lang, source, part, item): (value, rank)} of (lang, source, text)."""
    counts, lang_counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall((text or "").translate(brute.LOWER))
        counts[lang, source].update(terms)
        lang_counts[lang].update(terms)
        docs[lang].update(set(terms))
    out = {}
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        shares = {}
        for name, count in [*((s, counts[lang, s]) for s in sources), (None, lang_counts[lang])]:
            total = sum(count[t] for t in kept)
            shares[name] = {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}
        for s in sources:
            pairs = [(-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(shares[None][t] - shares[s][t], t.encode()) for t in kept if counts[lang, s][t] and shares[s][t] > shares[None][t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item.decode()): (-value, rank) for rank, (value, item) in enumerate(found, 1)}
    return out


def awkward():
    rows = []
    texts = [t for _, t in brute.awkward()] + ["Éclair ÉCLAIR éclair", "don't x_y z9z", "日本語 日本語テキスト, 𝒳 ｚ"] * 4
    for i, text in enumerate(texts):
        rows.append(([None, "en", "de"][i % 3], ["src0", "a", None, "日", "src0"][i % 5], text))
    rows += [("fr", "only", "un deux"), ("", "", "empty names"), ("xx", "a", None), ("xx", "b", "12 34"), ("en", "bare", None)]
    return rows + rows[:20]


@pytest.mark.parametrize("min_docs,top,terms,cells,width", [(2, 50, 1 << 17, 1 << 22, 256), (3, 4, 40, 60, 2), (1, 2, 10, 10, 1)])
def test_as_all_shares(spark, monkeypatch, min_docs, top, terms, cells, width):
    for name, value in {"BAND_TERMS": terms, "CELLS": cells, "SLICE": width, "COUNT_BYTES": 4000, "STEP": 16}.items():
        monkeypatch.setattr(sd, name, value)
    rows = awkward()
    docs = spark.createDataFrame([(*r, *"abcdefg") for r in rows], f"lang string, source string, text string, {EXTRA}").repartition(3)
    got = {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"]) for r in sd.source_divergence(docs, min_docs, top).collect()}
    want = plain(rows, min_docs, top)
    assert got == want
    assert len(want) > 50 and ("xx", "a", "pair", "b") in want


def test_empty(spark):
    schema = "lang string, source string, text string"
    assert sd.source_divergence(spark.createDataFrame([], schema)).count() == 0
    assert sd.source_divergence(spark.createDataFrame([("en", "a", None)], schema)).count() == 0
    rows = sd.source_divergence(spark.createDataFrame([("en", "b", None), ("en", "a", "x"), ("en", "c", "")], schema)).collect()
    assert sorted((r["source"], r["item"], r["value"], r["rank"]) for r in rows) == [("a", "b", 0, 1), ("a", "c", 0, 2), ("b", "a", 0, 1), ("b", "c", 0, 2), ("c", "a", 0, 1), ("c", "b", 0, 2)]


def test_shares_are_exact_for_large_counts(spark):
    n, total, v = 7_000_000_000_001, 9_000_000_000_000_007, 12_345
    row = spark.range(1).selectExpr(f"{n} as n", f"{total} as t", f"{v} as v").select(sd.exact_share("n", "t", "v").alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 5) // (total + 5 * v)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband(monkeypatch, k):
    monkeypatch.setattr(sd, "STEP", 8)
    rng = np.random.default_rng(k)
    high, low, name = rng.integers(0, 12, 200), rng.integers(0, 12, 200), rng.permutation(200)
    beaten = [sum((high[j] >= high[i]) and (low[j] <= low[i]) and (name[j] < name[i]) for j in range(200)) for i in range(200)]
    assert sd.skyband(high, low, name, k).tolist() == [i for i in range(200) if beaten[i] < k]
