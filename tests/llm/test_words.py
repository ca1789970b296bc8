import numpy as np
import pyarrow as pa
import pytest

from parley.llm import chunks, text
from tests.llm import brute


@pytest.mark.parametrize("lower", [False, True])
def test_words_and_hashes(lower):
    texts = [t for _, t in brute.awkward()]
    found = text.words_of(pa.array(texts), lower)
    seen = {}
    hashes = found.hashes()
    for d, t in enumerate(texts):
        want = [w.encode() for w in brute.words((t or "").translate(brute.LOWER) if lower else t)]
        own = range(found.first[d], found.first[d + 1])
        assert [found.word(i) for i in own] == want
        for i in own:
            assert seen.setdefault(int(hashes[i]), found.word(i)) == found.word(i)
    assert len(set(seen.values())) == len(seen)


def test_no_texts():
    assert len(text.words_of(pa.array([], pa.string())).hashes()) == 0
    assert len(text.words_of(pa.array([None, None], pa.null())).hashes()) == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 12, 35])
def test_grams_tell_sequences_apart(n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 3, 400).astype(np.uint64)
    found = text.grams(values, n)
    by = {}
    for i, h in enumerate(found):
        assert by.setdefault(int(h), tuple(values[i : i + n])) == tuple(values[i : i + n])
    assert len(set(by.values())) == len(by)


def test_packed_numbers():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    assert (chunks.unpack_sorted(chunks.pack_sorted(keys)) == keys).all()
    for kind in (np.uint8, np.int32, np.int64):
        values = np.arange(-5, 50).astype(kind)
        assert (chunks.unpack_numbers(chunks.pack_numbers(values)) == values).all()


def test_totals_over_chunks(spark, monkeypatch):
    """Every chunk learns, for each of its keys, how often it occurs in all chunks."""
    sets = {c: np.unique(np.random.default_rng(c).integers(0, 50, 30).astype(np.uint64) << np.uint64(58)) for c in range(5)}
    rows = [r for c, k in sets.items() for r in chunks.key_rows(c, k, np.full(len(k), c + 1), 4).to_pylist()]
    frame = spark.createDataFrame([(r["part"], r["chunk_id"], r["keys"], r["counts"]) for r in rows], chunks.KEY_SCHEMA)
    told = {r["chunk_id"]: chunks.answers_of([x.asDict() for x in r["answers"]]) for r in chunks.totals(frame, lambda t: t).collect()}
    for c, keys in sets.items():
        want = [sum(d + 1 for d, other in sets.items() if k in other) for k in keys]
        assert told[c].tolist() == want
