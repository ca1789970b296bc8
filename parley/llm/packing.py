"""Best-fit packing planned over a histogram of lengths.

Documents become token ids, cut into pieces of at most ``capacity``. The plan sees only how many pieces each
length has, at most ``capacity`` numbers: best fit, longest first, moves whole counts of equal pieces into
whole groups of equally filled sequences. The pieces then take their slots by a join on their rank within
their length. Ranks come from row numbers within (length, bucket) and running sums over buckets, so no
length, however common, meets in one task.

Defined results: a null text is an empty one and has the end token only; null and repeated ids are rows like any
other; an empty table gives no pieces; extra columns are not read.
"""

from __future__ import annotations

import os
import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain
from math import isqrt
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.chunks import settled
from parley.llm.text import Words, first_of, slices, tidied, words_of

CAPACITY = 4096
END_ID = 1
#: Distinct words that a worker process keeps the ids of before it starts over (some 30 bytes each).
KNOWN_WORDS = 1_000_000
#: Plan rows up to which the plan is broadcast (48 bytes each); beyond it Spark chooses the join.
BROADCAST_ROWS = 200_000


class Encoder:
    """Token ids of texts. The tokenizer breaks at white space, so a word is encoded once and then looked up by its hash."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each task has one core
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.small = self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.forget()

    def forget(self) -> None:
        # Words known for longer and those of late, both by ascending hash, with their places in ends.
        self.known = [(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32))] * 2
        self.count, self.used = 0, 0
        self.flat, self.ends = np.zeros(1 << 16, dtype=np.uint16), np.zeros(1 << 14, dtype=np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of words, -1 for unknown ones."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        for have, place in self.known:
            if len(have):
                at = np.minimum(np.searchsorted(have, hashes), len(have) - 1)
                out = np.where(have[at] == hashes, place[at], out)
        return out

    def learn(self, words: Words, place: np.ndarray, hashes: np.ndarray) -> None:
        encoded = [x.ids for x in self.tokenizer.encode_batch_fast([words.word(i).decode("utf-8", "replace") for i in place], add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(encoded), dtype=np.uint16 if self.small else np.uint32)
        self.flat = self.flat.astype(ids.dtype, copy=False)
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.ends) < self.count + len(encoded) + 1:
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.ends[self.count + 1 : self.count + 1 + len(encoded)] = self.used + np.cumsum([len(x) for x in encoded])
        self.used += len(ids)
        old, late = self.known
        late = self.merged(late, (hashes, (self.count + np.arange(len(hashes))).astype(np.int32)))
        self.count += len(hashes)
        if 4 * len(late[0]) > len(old[0]):
            old, late = self.merged(old, late), self.merged((late[0][:0], late[1][:0]), (late[0][:0], late[1][:0]))
        self.known = [old, late]

    @staticmethod
    def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, places = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
        order = np.argsort(keys, kind="stable")
        return keys[order], places[order]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id after it, and where each text starts (one more for the end)."""
        words = words_of(texts)
        which, kinds = pd.factorize(words.hashes())
        if self.count > KNOWN_WORDS:
            self.forget()
        at = self.find(kinds)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = self.count + np.arange(len(new))
            self.learn(words, first_of(which, len(kinds))[new], kinds[new])
        from_, sizes = np.append(self.ends[at], 0).astype(np.int64), np.append(self.ends[at + 1] - self.ends[at], 1)
        order = np.insert(which, words.first[1:], len(kinds))
        size = sizes[order]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(from_[order] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].astype(np.uint32)
        last = words.first[1:] + np.arange(len(words.first) - 1)
        ids[ends[last] - 1] = end_id
        return ids, np.concatenate([[0], ends[last]]).astype(np.int64)


def encoder_for(tokenizer_file: str) -> Encoder:
    """One encoder for each worker process and file, with the words it knows, over all the tasks that the process runs."""
    held = sys.modules.setdefault("parley_encoders", ModuleType("parley_encoders")).__dict__
    if tokenizer_file not in held:
        held[tokenizer_file] = Encoder(tokenizer_file)
    return held[tokenizer_file]


def pieces_of(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; the tokenizer file is read on the executors."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            ids, first = encoder_for(tokenizer_file).encode(batch.column(1), end_id)
            pieces = -(-np.diff(first) // capacity)
            row = np.repeat(np.arange(batch.num_rows), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(np.diff(first)[row] - start, capacity)
            a = first[row] + start
            digests = [zlib.crc32(ids[x : x + n].astype("<u4").tobytes()) for x, n in zip(a, length, strict=True)]
            columns = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(digests, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(a, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(tidied(cut), schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts: rows (length, from rank, to rank, first sequence, pieces per sequence, offset).

    The piece of rank r goes to sequence first + (r - from) // per, at offset + (r - from) % per * length.
    """
    groups: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, how many) of equally filled ones
    rooms: list[int] = []  # the keys of groups, ascending
    rows, made = [], 0

    def put(room: int, first: int, many: int) -> None:
        if not room or not many:
            return
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((first, many))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first, many = capacity, made, -(-left // (capacity // length))
                made += many
            per = room // length
            placed = min(left, per * many)
            rows.append((length, rank, rank + placed, first, per, capacity - room))
            full, over = divmod(placed, per)
            put(room - per * length, first, full)
            if over:
                put(room - over * length, first + full, 1)
            put(room, first + full + bool(over), many - full - bool(over))
            rank, left = rank + placed, left - placed
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """All columns of pieces (doc_id, piece, length, ids_crc32 and more) with sequence_id and offset.

    Pieces should be written already (settled): they are read twice and must come back the same.
    """
    spark = pieces.sparkSession
    per_length = pieces.groupBy("length").count().collect()  # at most capacity rows
    slots = plan({r["length"]: r["count"] for r in per_length}, capacity)
    # As many buckets as each then has pieces: neither a bucket of a length nor the sums over its buckets is large.
    buckets = isqrt(sum(r["count"] for r in per_length)) + 1
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = (
        dealt.groupBy("length", "bucket")
        .count()
        .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("within", F.row_number().over(within) - 1)
        .join(before, ["length", "bucket"])
        .withColumn("rank", F.col("within") + F.col("before"))
        .drop("bucket", "within", "before")
    )
    planned = spark.createDataFrame(slots, "slot_length long, from_rank long, to_rank long, first_sequence long, per long, base long")
    if len(slots) <= BROADCAST_ROWS:
        planned = F.broadcast(planned)
    ahead = F.col("rank") - F.col("from_rank")
    return (
        ranked.join(planned, (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
        .withColumn("sequence_id", F.col("first_sequence") + F.floor(ahead / F.col("per")).cast("long"))
        .withColumn("offset", F.col("base") + F.pmod(ahead, F.col("per")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def best_fit_packing(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces with their place; with_ids also carries the token ids, from which sequences are written."""
    return pack(settled(pieces_of(docs, tokenizer_file, capacity, end_id, with_ids)), capacity)
