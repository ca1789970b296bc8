"""The forest's limits and threshold come from all labelled rows."""

import numpy as np

from parley.llm import quality_rules as qr
from tests.llm import brute


def test_all_labelled_rows_count(spark, monkeypatch):
    """More rows than the trees draw from: the limits are quantiles of all accepted rows of a half, the threshold counts the rest."""
    monkeypatch.setattr(qr, "TREE_ROWS", 4)
    monkeypatch.setattr(qr, "TREES", 5)
    monkeypatch.setattr(qr, "BAD_ROWS", 1)
    texts = [(i, " ".join(f"w{i}x{j}" + "a" * (i % 90) for j in range(12))) for i in range(400)]
    texts += [(1000 + i, " ".join(f"#{i}${j}%" for j in range(30))) for i in range(40)]
    docs = brute.frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in texts], "doc_id long, quality int")
    calls = []
    monkeypatch.setattr(qr.Forest, "calibrate", lambda self, s, g, b: calls.append((g.sum(), b.sum())))
    rows = qr.measured(docs)
    forest = qr.fit(rows, labels)
    ((good, bad),) = calls
    assert 150 < good < 250 and 8 < bad < 32
    longest = np.array([r["features"] for r in rows.where("doc_id < 1000").collect()]).max(0)
    assert forest.limits[0] >= longest[0] - 3, "not the quantile of the twenty rows that the trees draw from"


def test_threshold_by_counts():
    forest = qr.Forest.__new__(qr.Forest)
    forest.calibrate(np.array([0.1, 0.3, 0.5, 0.8]), np.array([95, 3, 2, 0]), np.array([1, 0, 5, 20]))
    assert forest.threshold == 0.3
