"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) P(word | class, history). The HEAD_WORDS most frequent words are dealt by rank to
classes of SLOTS words; both factors are softmaxes over hashed n-gram and skip features of the three words before. Every
other word belongs to one of TAIL classes by its ending; within such a class it has its add-half share of the class's
count over the whole corpus, and words never seen in training share one further place. All probabilities sum to one.

Corpus counts of all words come from the chunk exchange (``chunks``) and grow with the corpus; nothing of them
but the head words and sums by class reaches the driver. Training is one pass over all training texts in ROUNDS
synchronous rounds: each task descends on its part from the shared weights and returns its change; the changes are
averaged row by row, by how often each task saw the row. Scoring is a second pass in numpy batches.

Defined results: a null text is empty and consists of the end alone; a null id counts as the empty text for the split;
an empty corpus or one without training texts leaves every word unknown.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import KEY_SCHEMA, answered, answers_of, chunked, key_rows, pack_numbers, pack_sorted, parts_for, rows_of, settled, totals, unpack_batch, unpack_numbers, unpack_sorted
from parley.llm.text import Words, mix, tidied, words_of

FOLDS, HELD_OUT = 5, 1
HEAD_WORDS, SLOTS, TAIL_BITS = 1024, 32, 4
TAIL = 1 << TAIL_BITS
BUCKET_BITS, ROUNDS, BATCH = 14, 4, 16384
#: Step size, and the squared gradient that a row has before its first step: rows rarely seen move little.
RATE, CAUTION = 1.0, 50.0
#: Tasks' changes that one task adds up at a time.
FAN_IN = 16
#: Times a batch meets a row up to which its gradients are added place by place.
FEW = 8
END = np.uint64(2**64 - TAIL)
_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b".,;:!?\"')(")] = True


def folds(ids: pa.Array, folds_: int) -> np.ndarray:
    """crc32 of each id as text, modulo folds_."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % folds_ for i in ids.to_pylist()], dtype=np.int64)


def word_keys(words: Words) -> np.ndarray:
    """A word's hash with its ending's class in the low bits."""
    last = words.ends - 1
    last = last - (_MARKS[words.data[last]] & (last > words.starts))
    before = np.where(last > words.starts, words.data[np.maximum(last - 1, 0)], 0)
    ending = mix(before.astype(np.uint64) * np.uint64(256) + words.data[last]) >> np.uint64(64 - TAIL_BITS)
    keys = (words.hashes() & np.uint64(2**64 - TAIL)) | ending
    return np.where(keys >= END, keys - np.uint64(2 * TAIL), keys)


class Tokens:
    """The words of a batch of texts, each text with the end after it, as places in the sorted distinct keys."""

    def __init__(self, keys: np.ndarray, token: np.ndarray, first: np.ndarray):
        self.keys, self.token, self.first = keys, token, first
        self.doc = np.repeat(np.arange(len(first) - 1), np.diff(first))

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        words = words_of(texts, lower=True)
        n = len(words.first) - 1
        codes, kinds = pd.factorize(np.insert(word_keys(words), words.first[1:], END))
        keys = np.sort(kinds)
        return cls(keys, np.searchsorted(keys, kinds)[codes], words.first + np.arange(n + 1))

    @classmethod
    def stored(cls, row: dict) -> tuple[pa.Array, Tokens]:
        """Ids and tokens of a chunk that tokenised has made."""
        table = unpack_batch(row["payload"])
        tokens = table.column("tokens").combine_chunks()
        return table.column("doc_id").combine_chunks(), cls(unpack_sorted(row["more"]), tokens.values.to_numpy().astype(np.int64), tokens.offsets.to_numpy().astype(np.int64))


def tokenised(table: pa.Table) -> tuple[pa.Table, bytes]:
    """A chunk's ids and tokens in place of its texts, and its keys: texts are read once."""
    tokens = Tokens.of(table.column("text"))
    lists = pa.ListArray.from_arrays(pa.array(tokens.first.astype(np.int32)), pa.array(tokens.token.astype(np.int32)))
    return pa.table({"doc_id": table.column("doc_id"), "tokens": lists}), pack_sorted(tokens.keys)


class Model:
    """Weights and counts; small whatever the corpus: HEAD_WORDS words, sums by class and two hashed tables."""

    def __init__(self, head: np.ndarray, head_counts: np.ndarray, tail_counts: np.ndarray, tail_kinds: np.ndarray):
        # head: keys by descending count; the end is always among them.
        self.head_classes = -(-len(head) // SLOTS)
        self.classes = self.head_classes + TAIL
        order = np.argsort(head)
        self.sorted_head, self.rank = head[order], order
        self.tail_room = tail_counts + 0.5 * (tail_kinds + 1)
        padded = np.full(self.head_classes * SLOTS, -np.inf)
        padded[: len(head)] = np.log(head_counts + 0.5)
        self.slot_bias = padded.reshape(self.head_classes, SLOTS).astype(np.float32)
        self.class_bias = np.log(np.concatenate([np.exp(padded).reshape(self.head_classes, SLOTS).sum(axis=1), self.tail_room])).astype(np.float32)
        self.class_weights = np.zeros((1 << BUCKET_BITS, self.classes), dtype=np.float32)
        self.slot_weights = np.zeros((1 << BUCKET_BITS, SLOTS), dtype=np.float32)

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        """Rank of a head word, or HEAD_WORDS + class of another word."""
        at = np.minimum(np.searchsorted(self.sorted_head, keys), len(self.sorted_head) - 1)
        return np.where(self.sorted_head[at] == keys, self.rank[at], HEAD_WORDS + (keys & np.uint64(TAIL - 1)).astype(np.int64))


def _bucket(kind: int, value: np.ndarray) -> np.ndarray:
    return (mix(value.astype(np.uint64) + np.uint64(kind << 56)) >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)


class Events:
    """What the model predicts at each token: its class, its slot, and the feature rows of its history."""

    def __init__(self, model: Model, tokens: Tokens):
        symbols = model.symbols(tokens.keys)
        symbol, key = symbols[tokens.token], tokens.keys[tokens.token]
        place = np.arange(len(symbol)) - tokens.first[tokens.doc]
        none = HEAD_WORDS + TAIL

        def back(values: np.ndarray, by: int, empty: int) -> np.ndarray:
            out = np.full(len(values), empty, dtype=values.dtype)
            out[by:] = values[:-by] if by < len(values) else values[:0]
            out[place < by] = empty
            return out

        one, two, three = (back(symbol, k, none) for k in (1, 2, 3))
        self.histories = [one, two * 2048 + one, two, three, back(key, 1, 0)]  # n-grams, skips, and the very word before
        self.rows = [_bucket(k, h) for k, h in enumerate(self.histories)]
        self.head = symbol < HEAD_WORDS
        self.classes = np.where(self.head, symbol // SLOTS, model.head_classes + symbol - HEAD_WORDS)
        self.slots = symbol % SLOTS

    def slot_rows(self, chosen: np.ndarray) -> list[np.ndarray]:
        classes = self.classes[chosen].astype(np.uint64)
        return [_bucket(8 + k, mix(h[chosen].astype(np.uint64)) + classes) for k, h in enumerate(self.histories[:4])]


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return logits


def _logits(bias: np.ndarray, table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    out = table.take(rows[0], axis=0)
    for r in rows[1:]:
        out += table.take(r, axis=0)
    out += bias
    return out


class Descent:
    """Steps on one of the tables, each row at its own rate."""

    def __init__(self, table: np.ndarray):
        self.table, self.start = table, table.copy()
        self.squares = np.full(len(table), CAUTION, dtype=np.float64)
        self.seen = np.zeros(len(table), dtype=np.float32)

    def step(self, rows: list[np.ndarray], gradient: np.ndarray) -> None:
        for r in rows:
            order = np.argsort(r, kind="stable")
            sorted_ = r.take(order)
            first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
            times = np.diff(np.append(first, len(order)))
            # Rows met FEW times or less, which are most, are added up place by place; the others run by run.
            for k in range(1, FEW + 1):
                own = first[times == k]
                total = gradient.take(order.take(own), axis=0)
                for j in range(1, k):
                    total += gradient.take(order.take(own + j), axis=0)
                self.move(sorted_[own], total, k)
            many = times > FEW
            if many.any():
                runs = np.repeat(first[many], times[many])
                starts = np.cumsum(times[many]) - times[many]
                part = gradient.take(order.take(runs + np.arange(len(runs)) - np.repeat(starts, times[many])), axis=0)
                self.move(sorted_[first[many]], np.add.reduceat(part, starts, axis=0), times[many])

    def move(self, touched: np.ndarray, total: np.ndarray, times: np.ndarray | int) -> None:
        self.squares[touched] += np.einsum("ij,ij->i", total, total)
        self.table[touched] -= (RATE / np.sqrt(self.squares[touched])).astype(np.float32)[:, None] * total
        self.seen[touched] += times

    def change(self) -> tuple[np.ndarray, np.ndarray]:
        """seen * change of each row, and seen."""
        return (self.table - self.start) * self.seen[:, None], self.seen


def descend(model: Model, events: Events, classes: Descent, slots: Descent, chosen: np.ndarray) -> None:
    """One pass over the chosen tokens."""
    for at in range(0, len(chosen), BATCH):
        part = chosen[at : at + BATCH]
        rows, target = [r[part] for r in events.rows], events.classes[part]
        gradient = np.exp(_log_softmax(_logits(model.class_bias, classes.table, rows)))
        gradient[np.arange(len(part)), target] -= 1
        classes.step(rows, gradient)
        part = part[events.head[part]]
        if len(part):
            rows = events.slot_rows(part)
            gradient = np.exp(_log_softmax(_logits(model.slot_bias.take(events.classes[part], axis=0), slots.table, rows)))
            gradient[np.arange(len(part)), events.slots[part]] -= 1
            slots.step(rows, gradient)


def log_probabilities(model: Model, events: Events, counts: np.ndarray) -> np.ndarray:
    """log10 of the probability of each token; counts: its training count."""
    out = np.empty(len(counts))
    for at in range(0, len(counts), BATCH):
        part = np.arange(at, min(at + BATCH, len(counts)))
        logs = _log_softmax(_logits(model.class_bias, model.class_weights, [r[part] for r in events.rows]))
        out[part] = logs[np.arange(len(part)), events.classes[part]]
        head = part[events.head[part]]
        if len(head):
            logs = _log_softmax(_logits(model.slot_bias.take(events.classes[head], axis=0), model.slot_weights, events.slot_rows(head)))
            out[head] += logs[np.arange(len(head)), events.slots[head]]
        tail = part[~events.head[part]]
        out[tail] += np.log((counts[tail] + 0.5) / model.tail_room[events.classes[tail] - model.head_classes])
    return out / np.log(10)


def word_counts(chunks: DataFrame, total_bytes: int) -> DataFrame:
    """Key rows of all chunks; each key with its count in the chunk's training texts, which may be 0."""
    bits = parts_for(total_bytes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            ids, tokens = Tokens.stored(row)
            learned = folds(ids, FOLDS) != HELD_OUT
            counts = np.bincount(tokens.token[learned[tokens.doc]], minlength=len(tokens.keys))
            yield key_rows(row["chunk_id"], tokens.keys, counts, bits)

    return settled(chunks.mapInArrow(tidied(count), KEY_SCHEMA))


def summed(keys: DataFrame) -> Model:
    """The untrained model: head words and class sums, over all training texts."""

    def summarise(table: pa.Table) -> pa.Table:
        sets = [unpack_sorted(b.as_py()) for b in table.column("keys")]
        counts = np.concatenate([unpack_numbers(b.as_py()) for b in table.column("counts")])
        codes, kinds = pd.factorize(np.concatenate(sets))
        sums = np.bincount(codes, weights=counts, minlength=len(kinds)).astype(np.int64)
        kinds, sums = kinds[sums > 0], sums[sums > 0]
        best = np.lexsort((kinds, -sums))[:HEAD_WORDS]
        ending = (kinds & np.uint64(TAIL - 1)).astype(np.int64)
        classes = np.concatenate([np.bincount(ending, weights=sums, minlength=TAIL).astype(np.int64), np.bincount(ending, minlength=TAIL)])
        # Rows below zero are sums by class (counts, then kinds); the rest are candidates for the head.
        return pa.table({"what": np.concatenate([np.full(len(best), -1), np.arange(2 * TAIL)]), "word": np.concatenate([kinds[best].view(np.int64), np.zeros(2 * TAIL, np.int64)]), "count": np.concatenate([sums[best], classes])})

    found = settled(keys.groupBy("part").applyInArrow(summarise, "what long, word long, count long"))
    by_class = {r["what"]: r["count"] for r in found.where("what >= 0").groupBy("what").agg(F.sum("count").alias("count")).collect()}
    top = found.where("what < 0").orderBy(F.desc("count"), "word").limit(HEAD_WORDS).collect()
    sums = np.array([by_class.get(k, 0) for k in range(2 * TAIL)], dtype=np.float64)
    head = [(np.int64(r["word"]).view(np.uint64), r["count"]) for r in top]
    if END not in {w for w, _ in head}:
        head = [*head[: HEAD_WORDS - 1], (END, 0)]
    words, counts = np.array([w for w, _ in head], dtype=np.uint64), np.array([c for _, c in head], dtype=np.float64)
    ending = (words & np.uint64(TAIL - 1)).astype(np.int64)
    model = Model(words, counts, sums[:TAIL] - np.bincount(ending, weights=counts, minlength=TAIL), sums[TAIL:] - np.bincount(ending[counts > 0], minlength=TAIL))
    model.tokens, model.kinds = int(sums[:TAIL].sum()), int(sums[TAIL:].sum())
    return model


def train(chunks: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """One pass over all training texts, a share of the chunks each round."""
    context = chunks.sparkSession.sparkContext

    def round_(number: int) -> list:
        shared = context.broadcast(cloudpickle.dumps(model))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = classes = slots = None
            for row in rows_of(batches):
                if own is None:
                    own = cloudpickle.loads(shared.value)
                    classes, slots = Descent(own.class_weights.copy()), Descent(own.slot_weights.copy())
                ids, tokens = Tokens.stored(row)
                learned = folds(ids, FOLDS) != HELD_OUT
                descend(own, Events(own, tokens), classes, slots, np.flatnonzero(learned[tokens.doc]))
            if own is not None:
                share = TaskContext.get().partitionId() // FAN_IN
                for which, table in enumerate((classes, slots)):
                    change, seen = table.change()
                    yield pa.RecordBatch.from_pydict({"which": [which], "share": [share], "change": [pack_numbers(change.view(np.int32).ravel())], "seen": [pack_numbers(seen.view(np.int32))]})

        def add(table: pa.Table) -> pa.Table:
            change = seen = 0
            for a, b in zip(table.column("change"), table.column("seen"), strict=True):
                change = change + unpack_numbers(a.as_py()).view(np.float32)
                seen = seen + unpack_numbers(b.as_py()).view(np.float32)
            return pa.table({"which": table.column("which")[:1], "share": pa.array([table.column("share")[0].as_py() // FAN_IN]), "change": pa.array([pack_numbers(change.view(np.int32))], pa.binary()), "seen": pa.array([pack_numbers(seen.view(np.int32))], pa.binary())})

        schema = "which long, share long, change binary, seen binary"
        mine = chunks.where(F.pmod(F.xxhash64("chunk_id"), F.lit(rounds)) == number).select("chunk_id", "payload", "more")
        changes, tasks = mine.mapInArrow(tidied(learn), schema), chunks.rdd.getNumPartitions()
        while tasks > 1:
            changes, tasks = changes.groupBy("which", "share").applyInArrow(add, schema), -(-tasks // FAN_IN)
        got = changes.collect()  # two tables of fixed size
        shared.unpersist()
        return got

    for number in range(rounds):
        for r in round_(number):
            table = model.slot_weights if r["which"] else model.class_weights
            seen = unpack_numbers(r["seen"]).view(np.float32)
            table += unpack_numbers(r["change"]).view(np.float32).reshape(table.shape) / np.maximum(seen, 1)[:, None]
    return model


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks, total_bytes = chunked(docs.select("doc_id", "text"), prepare=tokenised)
    keys = word_counts(chunks, total_bytes)
    model = train(chunks, summed(keys))
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    told = totals(keys, lambda total: total)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(shared.value)
        for row in rows_of(batches):
            ids, tokens = Tokens.stored(row)
            counts = answers_of(row["answers"])
            base = np.log10((counts + 0.5) / (own.tokens + 0.5 * (own.kinds + 1)))
            log = log_probabilities(own, Events(own, tokens), counts[tokens.token])

            def per_text(values: np.ndarray) -> np.ndarray:
                return np.add.reduceat(values, tokens.first[:-1])

            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": ids,
                    "held_out": folds(ids, FOLDS) == HELD_OUT,
                    "n_tokens": np.diff(tokens.first),
                    "n_known": per_text((counts > 0)[tokens.token].astype(np.int64)),
                    "train_tokens": np.full(len(ids), own.tokens, dtype=np.int64),
                    "base_score": per_text(base[tokens.token]),
                    "score": per_text(log),
                }
            )

    both = answered(chunks, told).select("chunk_id", "payload", "more", "answers")
    return both.mapInArrow(tidied(score), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
