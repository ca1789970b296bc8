"""Near duplicates by sketches against brute force, and the sketches on their own."""

import numpy as np
import pytest

from parley.llm import chunks, fast_similarity as fs
from tests.llm import brute


@pytest.fixture(autouse=True)
def small(monkeypatch):
    """Many chunks, also for few rows."""
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 6000)
    monkeypatch.setattr(fs, "SKETCH_BYTES", 2000)


def got(docs):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in fs.near_duplicates(docs).collect()), key=brute.sort_key)


def wanted(rows):
    found, links = brute.jaccard_components(rows, percent=85)
    assert links > 20
    return sorted(((*r, r[0] == r[2]) for r in found), key=brute.sort_key)


@pytest.mark.parametrize("rows,shingles", [(2048, 1 << 20), (16, 3000)])
def test_components(spark, monkeypatch, rows, shingles):
    monkeypatch.setattr(fs, "SHARE_ROWS", rows)
    monkeypatch.setattr(fs, "SHARE_SHINGLES", shingles)
    table = brute.awkward()
    assert got(brute.frame(spark, table).repartition(3)) == wanted(table)


def test_opened_buckets_alone_lose_no_link(spark, monkeypatch):
    """Without first links, all have to come from buckets that are opened."""
    monkeypatch.setattr(fs, "first_links", lambda members, *_: members.selectExpr("node as a", "node as b").limit(0))
    table = brute.awkward()
    assert got(brute.frame(spark, table)) == wanted(table)


def test_near_the_threshold(spark):
    """Links and non-links of the size next to the threshold, in families that share most of their words."""
    base = [f"w{i}" for i in range(104)]  # 100 shingles
    table, at = [], 0
    for family in range(10):
        for changed in range(4):  # each change in the middle replaces five shingles
            text = [f"{x}f{family}" for x in base]
            for c in range(changed):
                text[10 + 20 * c] = f"new{at}"
            table.append((at, " ".join(text)))
            at += 1
        for left in (84, 85):  # shingles: 85 of 100 is the threshold itself
            table.append((at, " ".join(f"{x}f{family}" for x in base[: left + 4])))
            at += 1
    assert got(brute.frame(spark, table)) == wanted(table)


def test_empty_and_other_ids(spark):
    assert got(brute.frame(spark, [])) == []
    docs = spark.createDataFrame([("b", "one two"), ("a", "One two"), (None, None)], "doc_id string, text string")
    assert got(docs) == sorted([("a", 1, "a", True), ("b", 1, "a", False), (None, 0, None, True)], key=brute.sort_key)


def sets_of(*sizes, seed=1):
    rng = np.random.default_rng(seed)
    return [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in sizes]


def sketch(sets):
    return fs.sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))


def test_every_bin_fills_whatever_the_size():
    sets = sets_of(1, 2, 3, 40, 5000)
    drawn = sketch([*sets, np.zeros(0, np.uint64)])
    assert (drawn[:5] > 0).all() and (drawn[5] == 0).all()
    # A sketch depends on its set alone.
    for one, row in zip(sets, drawn[:5], strict=True):
        assert (sketch([one[::-1]])[0] == row).all()


@pytest.mark.parametrize("n", [7, 60, 900])
def test_agreement_is_the_similarity(n):
    """The mean over many pairs is the similarity, the deviation no larger than that of independent draws."""
    shared, own = int(n * 0.85), n - int(n * 0.85)
    want, rates = shared / (shared + own), []
    for seed in range(60):
        both, left = sets_of(shared, own, seed=seed)
        a, b = sketch([both, np.concatenate([both, left])])
        rates.append((a == b).mean())
    error = (want * (1 - want) / fs.COORDINATES) ** 0.5
    assert abs(np.mean(rates) - want) < 4 * error / 60**0.5
    assert np.std(rates) < 1.3 * error
    assert min(rates) * fs.COORDINATES > fs.LEAST_AGREED


def test_a_link_shares_a_bucket():
    missed = 0
    for seed in range(200):
        both, left = sets_of(85, 15, seed=seed)
        keys = fs.buckets_of(sketch([both, np.concatenate([both, left])]))
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0
    keys = fs.buckets_of(sketch(sets_of(100, 100)))
    assert not (keys[0] == keys[1]).any()
