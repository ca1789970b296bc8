"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its distinct words, pairs of neighbours and pairs around one word, lower-cased, without marks at
the ends of words, hashed to 2**BITS coordinates. Learning uses a bounded sample of labelled rows, dealt to tasks of about SHARD_ROWS;
each runs the per-coordinate FTRL updates over its part, and the states (z, n) are averaged, so that L1 decides on the
average. The few weights that stay travel with the scoring tasks. Probabilities are calibrated on rows that were not learnt
from: every task also learns without a third of its rows, three times, and the margins of the rows left out give slope and
offset of the logistic curve.

L1 grows with the fourth root of the rows of a task, which did best on parts of 286 and of 2,636 labelled rows that were left
out. A toxic text moves a word by 0.9 at most in each of EPOCHS passes, so the rarest words that get a weight are those of
about L1 / 2.7 toxic texts: 3 of 286 rows, 5 of 2,636, 6 of 5,000.

Defined results: a null or empty text has the score of the bias alone; rows without a label, or with a null id, are only
scored; without labelled rows every score is one half; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import pack_numbers, settled, unpack_numbers
from parley.llm.maxent_lm import folds
from parley.llm.text import first_of, joined, mix, slices, tidied, words_of

BITS = 20
#: Labelled rows that are learnt from at most: those with the lowest hashes.
SAMPLE_ROWS = 20_000
#: Texts that one task learns from, about.
SHARD_ROWS, EPOCHS, BATCH_TEXTS = 5_000, 3, 64
ALPHA, BETA, L2 = 1.0, 1.0, 1.0
#: L1 by the fourth root of the rows: what a few copies of one mislabelled text teach stays below it.
L1_SCALE = 1.8
#: Parts of a shard that are left out in turn to calibrate.
PARTS = 3
BIAS = 0
BLOCKS = 16


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(coordinate, text) of all occurrences."""
    words = words_of(texts, lower=True)
    words.trim()
    hashes, doc = words.hashes(), words.documents()
    found, owner = [hashes], [doc]
    for far in (1, 2):
        if len(hashes) > far:
            same = doc[far:] == doc[:-far]
            found.append(mix(joined(hashes[:-far], hashes[far:]) + np.uint64(far))[same])
            owner.append(doc[far:][same])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64) | 1, np.concatenate(owner)


def distinct(coordinate: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each coordinate of a text once, text by text."""
    codes, kinds = pd.factorize((owner << BITS) | coordinate)
    one = np.sort(first_of(codes, len(kinds)))
    coordinate, owner = coordinate[one], owner[one]
    order = np.argsort(owner, kind="stable")
    return coordinate[order], owner[order]


def weights_of(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    """The proximal solution for a coordinate's state; zero while |z| is within l1."""
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def learn(texts: pa.Array, labels: np.ndarray, l1: float) -> tuple[np.ndarray, np.ndarray]:
    """(z, n) after EPOCHS passes in batches of BATCH_TEXTS."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    coordinate, owner = distinct(*features(texts))
    first = np.searchsorted(owner, np.arange(len(labels) + 1))
    for _ in range(EPOCHS):
        for a in range(0, len(labels), BATCH_TEXTS):
            b = min(a + BATCH_TEXTS, len(labels))
            own, doc = coordinate[first[a] : first[b]], owner[first[a] : first[b]] - a
            own, doc = np.append(own, np.full(b - a, BIAS)), np.append(doc, np.arange(b - a))
            at, which = np.unique(own, return_inverse=True)
            w = weights_of(z[at], n[at], l1)
            error = sigmoid(np.bincount(doc, weights=w[which], minlength=b - a)) - labels[a:b]
            gradient = np.bincount(which, weights=error[doc], minlength=len(at))
            more = n[at] + np.bincount(which, weights=error[doc] ** 2, minlength=len(at))
            z[at] += gradient - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
    return z, n


def l1_for(rows: int) -> float:
    return L1_SCALE * rows**0.25


def margins_left_out(texts: pa.Array, labels: np.ndarray) -> np.ndarray:
    """The log-odds that each row has from learning without its part."""
    out, part = np.zeros(len(labels)), np.arange(len(labels)) % PARTS
    coordinate, owner = distinct(*features(texts))
    for k in range(PARTS):
        rest = np.flatnonzero(part != k)
        l1 = l1_for(len(rest))
        w = weights_of(*learn(texts.take(pa.array(rest)), labels[rest], l1), l1)
        own = part == k
        out[own] = w[BIAS] + np.bincount(owner, weights=w[coordinate], minlength=len(labels))[own]
    return out


def calibration(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make probabilities of margins: Platt's logistic fit with smoothed targets, by Newton steps."""
    slope, offset, held = 1.0, 0.0, 1e-3
    if not len(labels):
        return slope, offset
    positive = (labels == 1).sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    for _ in range(100):
        p = sigmoid(slope * margins + offset)
        error, weight = p - target, p * (1 - p) + 1e-9
        g = np.array([(error * margins).sum() + held * (slope - 1), error.sum()])
        h = np.array([[(weight * margins**2).sum() + held, (weight * margins).sum()], [(weight * margins).sum(), weight.sum()]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, offset = slope - step[0], offset - step[1]
    return max(slope, 0.05), offset


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds_: int, held_out: int, rows: int) -> DataFrame:
    """(label_id, label, text) of the labelled rows outside the held-out fold with the lowest hashes, rows of them at most."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .where(F.pmod(F.crc32(F.col("label_id").cast("string").cast("binary")), F.lit(folds_)) != held_out)
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(rows)
    )
    # At most rows ids and labels: a few hundred kB. Copies of an id count once, by the first text.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).groupBy("label_id").agg(F.first("label").alias("label"), F.min(F.col("text").cast("string")).alias("text"))
    # Equal texts teach once.
    return found.groupBy("text").agg(F.min(F.struct("label_id", "label")).alias("one")).select("one.label_id", "one.label", "text")


def fit(docs: DataFrame, labels: DataFrame, folds_: int, held_out: int, label: str = "toxic") -> tuple[np.ndarray, np.ndarray, tuple[float, float]]:
    """Coordinates and weights that are not zero, and the calibration."""
    sample = labelled(docs, labels, label, folds_, held_out, SAMPLE_ROWS)

    def states(table: pa.Table) -> pa.Table:
        table = table.sort_by("label_id")
        l1 = l1_for(table.num_rows)
        z, n = learn(table.column("text"), table.column("label").to_numpy(), l1)
        cut = (1 << BITS) // BLOCKS
        parts = [(pack_numbers(x[k * cut : (k + 1) * cut].view(np.int64))) for k in range(BLOCKS) for x in (z, n)]
        return pa.table({"block": np.arange(BLOCKS), "l1": np.full(BLOCKS, l1), "z": pa.array(parts[::2], pa.binary()), "n": pa.array(parts[1::2], pa.binary())})

    def average(table: pa.Table) -> pa.Table:
        z, n = (sum(unpack_numbers(x.as_py()).view(np.float64) for x in table.column(c)) / table.num_rows for c in ("z", "n"))
        w = weights_of(z, n, float(np.mean(table.column("l1"))))
        at = np.flatnonzero(w)
        block = table.column("block")[0].as_py()
        return pa.table({"coordinate": at + block * ((1 << BITS) // BLOCKS), "weight": w[at]})

    def left_out(table: pa.Table) -> pa.Table:
        table = table.sort_by("label_id")
        label = table.column("label").to_numpy()
        return pa.table({"margin": margins_left_out(table.column("text").combine_chunks(), label), "label": pa.array(label, pa.int32())})

    sample = settled(sample)  # SAMPLE_ROWS texts at most
    shards = -(-sample.count() // SHARD_ROWS)
    dealt = sample.withColumn("shard", F.pmod(F.xxhash64("label_id", F.lit(3)), F.lit(max(1, shards))))
    kept = dealt.groupBy("shard").applyInArrow(states, "block long, l1 double, z binary, n binary").groupBy("block").applyInArrow(average, "coordinate long, weight double").toPandas()
    kept = kept.sort_values("coordinate")  # 2**BITS rows at most, after L1 some hundreds
    seen = dealt.groupBy("shard").applyInArrow(left_out, "margin double, label int").toPandas()  # SAMPLE_ROWS numbers at most
    seen = seen.sort_values(["margin", "label"])
    return kept["coordinate"].to_numpy(), kept["weight"].to_numpy(), calibration(seen["margin"].to_numpy(), seen["label"].to_numpy())


def toxicity(docs: DataFrame, labels: DataFrame, folds_: int = 3, held_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    coordinates, weights, (slope, offset) = fit(docs, labels, folds_, held_out)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS)
        table[coordinates] = weights
        for batch in (part for whole in batches for part in slices(whole, 1)):
            at, owner = features(batch.column(1))
            some = table[at] != 0
            at, owner = distinct(at[some], owner[some])
            value = sigmoid(slope * (table[BIAS] + np.bincount(owner, weights=table[at], minlength=batch.num_rows)) + offset)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "held_out": folds(batch.column(0), folds_) == held_out, "score": value, "predicted": pa.array((value >= threshold).astype(np.int32))}
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(tidied(score), f"doc_id {kind}, held_out boolean, score double, predicted int")
