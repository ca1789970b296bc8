"""Quality rules with an isolation forest over their statistics.

One pass computes rule statistics of each whole text. Limits, units and threshold come from all labelled rows; a forest of
random splits is grown on rows drawn from them, a few for each tree; the average path of a document's statistics through it tells how soon random splits set it
apart. The threshold on that score is calibrated on labelled rows.

Trees are grown on accepted rows with a few rejected ones among them (``CONTAMINATION``): a statistic that is the
same in every accepted row would else never be split on.

Defined results: a null text has no words; a text that fails the base rules is not kept; without labelled rows of
both kinds the forest has no threshold and only the base rules decide; rows repeat as often as they come in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import settled
from parley.llm.text import covered, gram_places, grams, mix, slices, tidied, words_of

TREES, TREE_ROWS, CONTAMINATION, SEED = 100, 256, 0.02, 7
BAD_ROWS = max(1, round(TREE_ROWS * CONTAMINATION))
ROUTINE = 0.999
#: Of the quantile sketch; up to as many rows it is exact.
ACCURACY = 100_000
#: Different scores; bounds what the calibration gathers.
GRID = 1 << 16
#: Share of accepted calibration rows that the threshold keeps at least.
KEEP_CLEAN = 0.998
#: Accepted calibration rows that may be mislabelled however few there are.
STRAY_ROWS = 3
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_CODE_POINT = (np.arange(256) & 0xC0) != 0x80  # the first byte of one, blanks left out
_CODE_POINT[[0x20, *range(0x09, 0x0E)]] = False
_MARK = np.zeros(256, dtype=bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "echoes", "uppercase", "digits", "marks"]


def statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base statistics (whole numbers) of each text and the features derived from them and a few more."""
    words = words_of(texts)
    n, first, hashes = len(words.first) - 1, words.first, words.hashes()
    counts = words.counts
    doc = words.documents()

    # Within a text: bytes that start a code point, minus blanks, and classes of bytes.
    edges = np.append(words.text_starts, len(words.data))

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[edges])

    word_chars = per_text(_CODE_POINT[words.data])
    n_symbols = per_text(_SYMBOLS[words.data])

    # A line is what lies between two breaks: equal lines have equal bytes, blanks included.
    breaks = np.flatnonzero(words.data == 10)
    line_starts = np.unique(np.concatenate([edges[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(words.data)]
    line_doc = np.searchsorted(edges, line_starts, side="right") - 1
    line_ends = np.minimum(np.append(breaks, len(words.data))[np.searchsorted(breaks, line_starts)], edges[line_doc + 1])
    worded = np.searchsorted(words.starts, line_starts) < np.searchsorted(words.starts, line_ends)
    line_starts, line_ends, line_doc = line_starts[worded], line_ends[worded], line_doc[worded]
    raw = words.data.tobytes()
    seen: set = set()
    again = np.zeros(len(line_starts), dtype=bool)
    for i, (d, a, b) in enumerate(zip(line_doc.tolist(), line_starts.tolist(), line_ends.tolist(), strict=True)):
        size = len(seen)
        seen.add((d, raw[a:b]))
        again[i] = len(seen) == size
    n_dup_lines = np.bincount(line_doc[again], minlength=n)
    n_lines = np.bincount(line_doc, minlength=n)

    places = gram_places(first, 5)
    twice = np.zeros(0, dtype=np.int64)
    if len(places):
        key = grams(hashes, 5)[places] ^ mix(doc[places].astype(np.uint64) + np.uint64(1))
        which, kinds = pd.factorize(key)
        twice = places[np.bincount(which, minlength=len(kinds))[which] > 1]

    def per_doc(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=n)

    n_repeat = per_doc(covered(twice, 5, len(doc)))
    echo = np.zeros(len(doc), dtype=bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])

    base = dict(zip(BASE, (counts, word_chars, n_symbols, n_dup_lines, n_repeat), strict=True))
    some, chars = np.maximum(counts, 1), np.maximum(word_chars, 1)
    features = np.column_stack(
        [
            word_chars / some, n_symbols / chars, n_dup_lines / np.maximum(n_lines, 1), n_repeat / some, per_doc(echo) / some,
            per_text(_UPPER[words.data]) / chars, per_text(_DIGIT[words.data]) / chars, per_text(_MARK[words.data]) / chars,
        ]
    )
    return {k: v.astype(np.int64) for k, v in base.items()}, features


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])


def expected_path(n: float) -> float:
    """Average path of an unsuccessful search in a random binary tree of n rows."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(rows: np.ndarray, rng: np.random.Generator) -> list[tuple[int, float, int, int, float]]:
    """A tree as a list of (feature or -1, cut, left, right, path length at a leaf)."""
    limit = int(np.ceil(np.log2(max(2, len(rows))))) + 4
    nodes: list[tuple[int, float, int, int, float]] = []

    def node(part: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, 0, 0, depth + expected_path(len(part))))
        low, high = part.min(axis=0), part.max(axis=0)
        open_ = np.flatnonzero(high > low)
        if len(part) > 1 and depth < limit and len(open_):
            f = int(rng.choice(open_))
            cut = float(rng.uniform(low[f], high[f]))
            left = part[:, f] < cut
            if left.any() and not left.all():
                nodes[at] = (f, cut, node(part[left], depth + 1), node(part[~left], depth + 1), 0.0)
        return at

    node(rows, 0)
    return nodes


class Forest:
    """Anomaly scores in [0, 1], a whole number of GRIDths: the shorter the average path, the higher.

    Statistics enter as their excess over what accepted rows have (the quantile ROUTINE, ``limits``), in units of what the
    fitting rows reach: differences among ordinary documents do not set any of them apart. ``good`` and ``bad`` are what the
    trees draw their rows from.
    """

    def __init__(self, good: np.ndarray, bad: np.ndarray, limits: np.ndarray, highest: np.ndarray):
        self.limits = limits
        reach = highest - limits
        self.units = np.where(reach > 0, reach, 1.0)
        good, bad = self.excess(good), self.excess(bad)
        rng = np.random.default_rng(SEED)
        self.trees = []
        n_bad = BAD_ROWS if len(bad) else 0
        for _ in range(TREES):
            rows = good[rng.choice(len(good), min(len(good), TREE_ROWS - n_bad), replace=False)]
            if n_bad:
                rows = np.concatenate([rows, bad[rng.choice(len(bad), min(len(bad), n_bad), replace=False)]])
            nodes = grow(rows, rng)
            self.trees.append(tuple(np.array(x) for x in zip(*nodes, strict=True)))
        self.usual = expected_path(min(TREE_ROWS, len(good) + len(bad)))
        self.threshold = np.inf

    def excess(self, features: np.ndarray) -> np.ndarray:
        return np.maximum(features - self.limits, 0.0) / self.units

    def scores(self, features: np.ndarray) -> np.ndarray:
        features = self.excess(features)
        total = np.zeros(len(features))
        rows = np.arange(len(features))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(features), dtype=np.int64)
            while True:
                f = feature[at]
                going = f >= 0
                if not going.any():
                    break
                step = np.where(features[rows, np.maximum(f, 0)] < cut[at], left[at], right[at])
                at = np.where(going, step, at)
            total += path[at]
        return np.floor(2.0 ** (-total / len(self.trees) / max(self.usual, 1e-9)) * GRID) / GRID

    def calibrate(self, scores: np.ndarray, good: np.ndarray, bad: np.ndarray) -> None:
        """The threshold that best separates labelled rows, among those that keep KEEP_CLEAN of the accepted ones, or all but
        STRAY_ROWS. Given are the different scores, ascending, and how many accepted and rejected rows have each."""
        n_good = good.sum()
        allowed = max(STRAY_ROWS, int((1 - KEEP_CLEAN) * n_good))
        # Rows above each score.
        good_above, bad_above = n_good - np.cumsum(good), bad.sum() - np.cumsum(bad)
        least = np.flatnonzero((good_above <= allowed) | (np.arange(len(scores)) == len(scores) - 1))[0]
        gain = (bad_above / max(1, bad.sum()) - good_above / max(1, n_good))[least:]
        best = np.flatnonzero(gain >= gain.max() - 1e-12)
        self.threshold = float(scores[least:][best[-1]])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed and the features of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            base, features = statistics(batch.column(1))
            every = {"doc_id": batch.column(0)} | {k: pa.array(v) for k, v in base.items()} | {"base_failed": base_failed(base)}
            yield pa.RecordBatch.from_pydict(every | {"features": pa.array(list(features), pa.list_(pa.float64()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{k} long" for k in BASE) + ", base_failed boolean, features array<double>"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(tidied(measure), schema)


def fit(rows: DataFrame, labels: DataFrame) -> Forest | None:
    """Forest and threshold from all labelled rows that pass the base rules; ``rows`` are ``measured`` ones.

    One half gives the trees, the other half the threshold. Limits, reach and threshold are aggregates over all of them: limits by
    a quantile sketch of rank error 1/ACCURACY, the threshold by counts for each score. Only what the trees draw
    from reaches the driver, at most the rows of all trees, as an isolation tree grows on TREE_ROWS rows by its method.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg((F.min("quality") == 1).alias("good"))
    labelled = rows.where("not base_failed").join(known, F.col("doc_id") == F.col("label_id")).select("label_id", "good", "features")
    # Equal ids have one label and lie in either half, by what they are.
    drawn = F.xxhash64("label_id", "features")
    labelled = settled(labelled.withColumn("drawn", drawn).withColumn("grows", F.pmod(F.shiftright("drawn", 32), F.lit(2)) == 0))
    counts = {(r["good"], r["grows"]): r["n"] for r in labelled.groupBy("good", "grows").agg(F.count("*").alias("n")).collect()}
    has = {kind: counts.get((kind, True), 0) + counts.get((kind, False), 0) for kind in (True, False)}
    if not has[True] or not has[False]:
        return None

    def half(kind: bool, grows: bool) -> DataFrame:
        """Rows of a kind; a half without any is stood in for by the other."""
        chosen = labelled.where(F.col("good") == kind)
        return chosen.where(F.col("grows") == grows) if counts.get((kind, grows)) else chosen

    good, bad = half(True, True), half(False, True)
    places = range(len(FEATURES))
    limits = good.agg(*[F.percentile_approx(F.col("features")[i], F.lit(ROUTINE), F.lit(ACCURACY)).alias(f"f{i}") for i in places]).first()
    highest = good.unionByName(bad).agg(*[F.max(F.col("features")[i]).alias(f"f{i}") for i in places]).first()

    def pool(kind: DataFrame, of_tree: int) -> np.ndarray:
        found = kind.orderBy("drawn", "features").limit(TREES * of_tree).select("features").toPandas()
        return np.array(found["features"].tolist())

    forest = Forest(pool(good, TREE_ROWS), pool(bad, BAD_ROWS), np.array(limits), np.array(highest))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                features = np.array(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_pydict({"good": batch.column(0), "score": forest.scores(features)})

    rest = half(True, False).unionByName(half(False, False)).select("good", "features")
    by_score = rest.mapInArrow(tidied(score), "good boolean, score double").groupBy("score")
    found = by_score.agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).toPandas().sort_values("score")
    forest.calibrate(*(found[c].to_numpy() for c in ("score", "good", "bad")))
    return forest


def quality_rules(docs: DataFrame, labels: DataFrame, with_columns: bool = False) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and anomaly of every row; with_columns: the columns of docs and kept."""
    if with_columns:
        forest = fit(measured(docs), labels)
        at = docs.columns.index("text")

        def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in slices(whole, at)):
                base, features = statistics(batch.column(at))
                yield batch.filter(pa.array(~base_failed(base) & ~unusual(forest, features)[0]))

        return docs.mapInArrow(tidied(accept), docs.schema)

    rows = settled(measured(docs))  # texts are read once
    forest = fit(rows, labels)
    names = ["doc_id", *BASE, "base_failed"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = np.array(batch.column("features").to_pylist()).reshape(-1, len(FEATURES))
            odd, anomaly = unusual(forest, features)
            kept = ~batch.column("base_failed").to_numpy(zero_copy_only=False) & ~odd
            yield pa.RecordBatch.from_pydict({k: batch.column(k) for k in names} | {"kept": kept, "anomaly": anomaly})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{k} long" for k in BASE) + ", base_failed boolean, kept boolean, anomaly double"
    return rows.mapInArrow(tidied(judge), schema)


def unusual(forest: Forest | None, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows the forest sets apart, and their scores; without a forest none."""
    if forest is None or not len(features):
        return np.zeros(len(features), dtype=bool), np.zeros(len(features))
    anomaly = forest.scores(features)
    return anomaly > forest.threshold, anomaly
