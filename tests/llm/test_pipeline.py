"""The stages against brute force, on the given documents."""

import pytest

import corpus_pipeline
from parley.llm.queries import table
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    docs, out = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns(spark, stages):
    columns = table(spark, SF_DIR, "documents").columns
    assert all(s.columns == columns for s in stages[:-1])


def test_clean_documents_stay(spark, stages):
    label = {r["doc_id"]: r["quality"] for r in table(spark, SF_DIR, "labels").collect()}
    before, after = rows(table(spark, SF_DIR, "documents")), rows(stages[0])
    long_ = [d for d, t in before.items() if len(brute.words(t)) >= 10]
    clean = [d for d in long_ if label.get(d) == 1]
    assert sum(d in after for d in clean) > 0.97 * len(clean)
    junk = [d for d in long_ if label.get(d) == 0]
    assert sum(d in after for d in junk) < 0.1 * len(junk)
    assert all(before[d] == t for d, t in after.items())


def test_one_document_of_each_group(stages):
    before = list(rows(stages[0]).items())
    want, _ = brute.jaccard_components(before)
    assert sorted(rows(stages[1])) == sorted({c for _, _, c in want})


def test_repeats_are_gone(stages):
    before = list(rows(stages[1]).items())
    want = {}
    for (d, t), (w, gone) in zip(before, brute.repeated(before), strict=True):
        want[d] = " ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else t
    assert rows(stages[2]) == want


def test_leaks_are_gone(spark, stages):
    before, after = rows(stages[2]), rows(stages[3])
    items = [" ".join(brute.words(r["text"])) for r in table(spark, SF_DIR, "benchmark").collect()]
    holds = {d for d, t in before.items() if any(i in " ".join(brute.words(t)) for i in items)}
    assert not holds & set(after)
    assert len(before) - len(after) <= len(holds) + 2


def test_every_document_is_packed(spark, stages):
    assert {r["doc_id"] for r in stages[4].collect()} == set(rows(stages[3]))
    final = corpus_pipeline.run(spark, SF_DIR)
    assert final.count() == stages[4].count()
