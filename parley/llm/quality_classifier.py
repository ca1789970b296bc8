"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Every word has a sparse random index vector (its hash chooses NONZERO of DIM places and signs) and a context vector, the
sum of the index vectors of the words within REACH of it, over all documents. Context vectors are kept for 2**BITS hashed
words, so their table has one size whatever the corpus; tasks add up their part and the sums meet block by block. A
document is the mean and the spread of its words' unit vectors, with how like its neighbours are and how many words differ. A two-layer network is fitted on a bounded sample of
labelled rows; a temperature, found on rows that the network has not seen, makes its scores probabilities.

Defined results: null and empty texts are the zero vector and have the network's score of it; rows without a label or
with a null id are only scored; with labels of one kind or none the score is the share of label 1 (one half of none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import pack_numbers, unpack_numbers
from parley.llm.maxent_lm import folds
from parley.llm.text import first_of, mix, slices, tidied, words_of
from parley.llm.toxicity import labelled, sigmoid

BITS, DIM, NONZERO, REACH = 14, 48, 4, 2
#: Neighbours whose likeness is pooled; columns of a pooled document.
NEAR = 3
POOLED = 2 * DIM + NEAR + 2
BLOCKS, FAN_IN = 8, 16
SAMPLE_ROWS = 20_000
HIDDEN, EPOCHS, BATCH_ROWS, RATE, DECAY, SEED = 32, 40, 128, 2e-3, 1e-4, 11


def index_vectors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, sign) of the NONZERO entries of each word's index vector."""
    draws = np.column_stack([mix(hashes + np.uint64(k + 1)) for k in range(NONZERO)])
    return ((draws >> np.uint64(8)) % np.uint64(DIM)).astype(np.int64), np.where(draws & np.uint64(1), 1, -1).astype(np.int64)


def add_contexts(table: np.ndarray, texts: pa.Array) -> None:
    words = words_of(texts)
    hashes, doc = words.hashes(), words.documents()
    row = (hashes >> np.uint64(64 - BITS)).astype(np.int64) * DIM
    place, sign = index_vectors(hashes)
    flat = table.reshape(-1)
    for far in range(1, REACH + 1):
        if len(hashes) <= far:
            break
        same = np.flatnonzero(doc[far:] == doc[:-far])
        for word, near in ((same, same + far), (same + far, same)):
            at = (row[word][:, None] + place[near]).ravel()
            flat += np.bincount(at, weights=sign[near].ravel(), minlength=flat.size).astype(np.int64)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of the 2**BITS hashed words, from all documents."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1 << BITS, DIM), dtype=np.int64)
        for batch in (part for whole in batches for part in slices(whole, 0)):
            add_contexts(table, batch.column(0))
        share = TaskContext.get().partitionId() // FAN_IN
        parts = [pack_numbers(np.ascontiguousarray(x).ravel()) for x in np.split(table, BLOCKS)]
        yield pa.RecordBatch.from_pydict({"block": np.arange(BLOCKS), "share": np.full(BLOCKS, share), "sums": pa.array(parts, pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(unpack_numbers(x.as_py()) for x in table.column("sums"))
        return pa.table({"block": table.column("block")[:1], "share": pa.array([table.column("share")[0].as_py() // FAN_IN]), "sums": pa.array([pack_numbers(total)], pa.binary())})

    texts = docs.select(F.col("text").cast("string"))
    schema = "block long, share long, sums binary"
    sums, tasks = texts.mapInArrow(tidied(collect), schema), max(2, texts.rdd.getNumPartitions())
    while tasks > 1:
        sums, tasks = sums.groupBy("block", "share").applyInArrow(add, schema), -(-tasks // FAN_IN)
    got = {r["block"]: unpack_numbers(r["sums"]) for r in sums.collect()}  # a table of fixed size
    if not got:
        return np.zeros((1 << BITS, DIM), dtype=np.float32)
    table = np.concatenate([got[k] for k in range(BLOCKS)]).reshape(-1, DIM).astype(np.float64)
    # Random indexing keeps what all words share in one direction; without it vectors tell words apart.
    share = table.sum(axis=0) / max(1.0, np.abs(table).sum())
    table -= np.abs(table).sum(axis=1, keepdims=True) * share
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(length, 1e-9)).astype(np.float32)


def pooled(vectors: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Mean and spread of the word vectors of each text, the mean likeness of neighbours, and the share of distinct words."""
    words = words_of(texts)
    counts, out = words.counts, np.zeros((len(words.counts), POOLED), dtype=np.float32)
    some = counts > 0
    if some.any():
        hashes = words.hashes()
        rows = vectors[(hashes >> np.uint64(64 - BITS)).astype(np.int64)]
        at, doc = words.first[:-1][some], words.documents()
        for k in range(NEAR):
            same = np.flatnonzero(doc[k + 1 :] == doc[: len(doc) - k - 1])
            likeness = np.einsum("ij,ij->i", rows[same], rows[same + k + 1])
            out[:, 2 * DIM + k] = np.bincount(doc[same], weights=likeness, minlength=len(counts)) / np.maximum(counts - k - 1, 1)
        codes, kinds = pd.factorize(hashes ^ mix(doc.astype(np.uint64) + np.uint64(1)))
        distinct = np.bincount(doc[first_of(codes, len(kinds))], minlength=len(counts))
        out[:, -2], out[:, -1] = distinct / np.maximum(counts, 1), np.log1p(counts)
        mean = np.add.reduceat(rows, at, axis=0) / counts[some, None]
        square = np.add.reduceat(rows * rows, at, axis=0) / counts[some, None]
        out[some, :DIM], out[some, DIM : 2 * DIM] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
    return out


class Network:
    """Two layers, fitted with Adam; scores are calibrated by a temperature."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.centre, self.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
        self.temperature = 1.0
        x, y = self.standard(rows), labels.astype(np.float64)
        part = np.arange(len(x)) % 5 == 4  # for the temperature
        if not part.any():
            part[:] = False
        a, b = rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN)
        share = np.clip(y.mean(), 0.01, 0.99)
        self.layers = [a, np.zeros(HIDDEN), b, np.array([np.log(share / (1 - share))])]
        first, second, step = [np.zeros_like(p) for p in self.layers], [np.zeros_like(p) for p in self.layers], 0
        fit = np.flatnonzero(~part)
        for _ in range(EPOCHS):
            for own in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH_ROWS)):
                step += 1
                hidden = np.maximum(x[own] @ self.layers[0] + self.layers[1], 0)
                error = (sigmoid(hidden @ self.layers[2] + self.layers[3]) - y[own]) / len(own)
                back = np.outer(error, self.layers[2]) * (hidden > 0)
                gradients = [x[own].T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
                for k, g in enumerate(gradients):
                    g = g + DECAY * self.layers[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.layers[k] = self.layers[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        if part.any():
            logits = self.logits(rows[part])
            loss = {t: -np.mean(np.log(np.where(y[part] > 0, sigmoid(logits / t), 1 - sigmoid(logits / t)) + 1e-12)) for t in np.geomspace(0.25, 8, 41)}
            self.temperature = float(min(loss, key=loss.get))

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.centre) / self.scale, -8, 8).astype(np.float64)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.standard(rows) @ self.layers[0] + self.layers[1], 0) @ self.layers[2] + self.layers[3]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(rows) / self.temperature)


def quality_classifier(docs: DataFrame, labels: DataFrame, folds_: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)  # a table of fixed size
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            rows = pooled(shared.value, batch.column(2))
            yield pa.RecordBatch.from_pydict({"label_id": batch.column(0), "label": batch.column(1), "row": pa.array([r.tobytes() for r in rows], pa.binary())})

    sample = labelled(docs, labels, "quality", folds_, held_out, SAMPLE_ROWS)
    got = sample.select("label_id", "label", "text").mapInArrow(tidied(pool), f"label_id {kind}, label int, row binary").toPandas().sort_values("label_id")
    rows = np.frombuffer(b"".join(got["row"]), dtype=np.float32).reshape(-1, POOLED)
    known = got["label"].to_numpy()
    network = Network(rows, known) if len(set(known)) == 2 else None
    share = float(known.mean()) if len(known) else 0.5
    packed = cloudpickle.dumps(network)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(packed)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            value = own.scores(pooled(shared.value, batch.column(1))) if own else np.full(batch.num_rows, share)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "held_out": folds(batch.column(0), folds_) == held_out, "score": value, "predicted": pa.array((value >= threshold).astype(np.int32))}
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(tidied(score), f"doc_id {kind}, held_out boolean, score double, predicted int")
