"""Substring deduplication: seeds from winnowed anchors, extended both ways to whole repeats.

1. Seeds. Of every run of WINDOW - ANCHOR + 1 neighbouring ANCHOR-word sequences, the least hash is an anchor. Two
   equal windows of WINDOW words choose the same anchor at the same place in them, so an anchor that occurs once in
   the corpus rules out all windows that chose it.
2. Extension. A seed that does occur elsewhere is extended left and right to every window that chose it, and the
   windows, not the pairs of their places, are counted over the corpus. Neighbouring repeated windows join to
   maximal repeats; these are all at least WINDOW words long.
3. Words in a repeat go. Windows are judged on the input, so every copy of a passage goes, the first included.

All counts run over chunks (``chunks``): one passage in a third of all documents is one key for each chunk.
Windows are told apart by 64-bit hashes: two different ones are taken for equal with a chance of 2**-64 a pair.

Defined results: a null text has no words, is kept as it is and has an empty digest text; rows with equal or null ids
are separate documents; a text without repeats comes back unchanged, one with repeats as its kept words with
one space between them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import KEY_SCHEMA, answered, answers_of, chunked, key_rows, parts_for, rows_of, settled, totals, unpack_batch
from parley.llm.text import Words, covered, give_back, gram_places, grams, tidied, words_of

WINDOW = 35
ANCHOR = 12
#: Documents that leave a task at once.
EMIT_ROWS = 500


def least_places(values: np.ndarray, span: int) -> np.ndarray:
    """For each place with span values from it on: where the least of them is, the leftmost one of equals."""
    size = len(values) - span + 1
    if size <= 0:
        return np.zeros(0, dtype=np.int32)
    at, have = np.arange(len(values), dtype=np.int32), 1
    while have < span:
        step = min(have, span - have)
        right, left = at[step:], at[: len(at) - step]
        at = np.where(values[right] < values[left], right, left)
        have += step
    return at[:size]


class Seeds:
    """Windows of the documents of a chunk and the anchors that they chose."""

    def __init__(self, words: Words, window: int = WINDOW, anchor: int = ANCHOR):
        hashes = words.hashes()
        self.places = gram_places(words.first, window).astype(np.int32)  # a chunk has fewer words than that
        self.windows = grams(hashes, window)[self.places] if len(self.places) else np.zeros(0, dtype=np.uint64)
        anchors = grams(hashes, anchor)
        del hashes
        chosen = least_places(anchors, window - anchor + 1)[self.places] if len(self.places) else self.places
        is_chosen = np.zeros(len(anchors) + 1, dtype=bool)
        is_chosen[chosen] = True
        occurs = np.flatnonzero(is_chosen)  # places of anchors
        rank = np.cumsum(is_chosen, dtype=np.int32)
        self.which = rank[chosen] - 1  # for each window, which of them
        self.keys, self.key_of, self.counts = np.unique(anchors[occurs], return_inverse=True, return_counts=True)

    def extended(self, repeated: np.ndarray) -> np.ndarray:
        """Which windows chose an anchor that is repeated; repeated: for each key."""
        if not len(self.places):
            return np.zeros(0, dtype=bool)
        return repeated.astype(bool)[self.key_of][self.which]


def _again(total: np.ndarray) -> np.ndarray:
    return (total > 1).astype(np.uint8)


def repeats(chunks: DataFrame, total_bytes: int, text: str, window: int = WINDOW) -> DataFrame:
    """Chunks with the answers for their anchors (answers) and for their extended windows (window_answers)."""
    bits = parts_for(total_bytes)

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            own = Seeds(words_of(unpack_batch(row["payload"]).column(text)), window)
            keys, counts = own.keys, own.counts
            del own
            give_back()
            if len(keys):
                yield key_rows(row["chunk_id"], keys, counts, bits)

    def extensions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            own = Seeds(words_of(unpack_batch(row["payload"]).column(text)), window)
            keys, counts = np.unique(own.windows[own.extended(answers_of(row["answers"]))], return_counts=True)
            del own
            give_back()
            if len(keys):
                yield key_rows(row["chunk_id"], keys, counts, bits)

    seeded = answered(chunks, settled(totals(chunks.mapInArrow(tidied(seeds), KEY_SCHEMA), _again)))
    told = totals(seeded.select("chunk_id", "payload", "answers").mapInArrow(tidied(extensions), KEY_SCHEMA), _again)
    return answered(seeded, told.withColumnRenamed("answers", "window_answers"))


def maximal(words: Words, row: dict, window: int = WINDOW) -> np.ndarray:
    """Which words of a chunk lie in a repeat."""
    own = Seeds(words, window)
    open_ = own.extended(answers_of(row["answers"]))
    which, keys = pd.factorize(own.windows[open_], sort=True)
    again = answers_of(row["window_answers"])[: len(keys)].astype(bool)
    return covered(own.places[open_][again[which]], window, len(words.starts)) if len(which) else np.zeros(len(words.starts), dtype=bool)


def substring_dedup(docs: DataFrame, text: str = "text", window: int = WINDOW, with_columns: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, kept_sha256 and spans (first word, words) of the repeats of every row.

    With with_columns: the columns of docs, the text being what is kept.
    """
    chunks, total = chunked(docs if with_columns else docs.select("doc_id", text), text)
    both = repeats(chunks, total, text, window).select("chunk_id", "payload", "answers", "window_answers")

    def kept_words(words: Words, gone: np.ndarray, d: int) -> bytes:
        a, b = words.first[d], words.first[d + 1]
        here = np.flatnonzero(~gone[a:b]) + a
        raw = memoryview(words.data)
        return b" ".join([raw[x:y] for x, y in zip(words.starts[here].tolist(), words.ends[here].tolist(), strict=True)])

    def judged(row: dict) -> Iterator[tuple[pa.Table, Words, np.ndarray, np.ndarray]]:
        """Runs of a chunk's documents with their words: which go, and how many of each document."""
        table = unpack_batch(row["payload"])
        gone = maximal(words_of(table.column(text)), row, window)
        give_back()
        at = 0
        for part in table.to_batches(max_chunksize=EMIT_ROWS):
            words = words_of(part.column(text))
            own = gone[at : at + len(words.starts)]
            at += len(own)
            yield pa.Table.from_batches([part]), words, own, np.diff(np.concatenate([[0], np.cumsum(own)])[words.first])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents as they came; a text is made anew only where words go."""
        for row in rows_of(batches):
            for table, words, gone, removed in judged(row):
                hit = np.flatnonzero(removed)
                texts = pa.array([kept_words(words, gone, d).decode("utf-8", "replace") for d in hit], pa.string())
                column = pc.replace_with_mask(table.column(text).combine_chunks(), pa.array(removed > 0), texts)
                yield from table.set_column(table.schema.get_field_index(text), text, column).to_batches()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            for table, words, gone, removed in judged(row):
                kept, spans = [], []
                for d, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                    kept.append(kept_words(words, gone, d))
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8))) if removed[d] else []
                    spans.append([{"first": int(x), "words": int(y - x)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
                out = pa.table(
                    {
                        "doc_id": table.column("doc_id"),
                        "n_words": pa.array(words.counts, pa.int64()),
                        "n_removed": pa.array(removed, pa.int64()),
                        "kept_text": pa.array([x.decode("utf-8", "replace") for x in kept], pa.string()),
                        "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept],
                        "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))),
                    }
                )
                yield from out.to_batches()

    if with_columns:
        return both.mapInArrow(tidied(cut), docs.withColumn(text, F.col(text).cast("string")).schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(tidied(digests), f"doc_id {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string, spans array<struct<first: long, words: long>>")


def oracle_sql(window: int = WINDOW) -> str:
    """doc_id, n_words, n_removed and kept_sha256 over the table documents as DuckDB SQL."""
    return f"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
win AS MATERIALIZED (SELECT r, i, array_to_string(words[i + 1:i + {window}], ' ') AS key FROM (SELECT *, unnest(range(0, len(words) - {window} + 1)) AS i FROM doc)),
twice AS (SELECT key FROM win GROUP BY key HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {window})) AS place FROM win JOIN twice USING (key)),
word AS (SELECT r, unnest(words) AS word, unnest(range(0, len(words))) AS place FROM doc),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text FROM word ANTI JOIN gone USING (r, place) GROUP BY r)
SELECT doc_id, CAST(len(words) AS bigint) AS n_words, CAST(len(words) - coalesce(n, 0) AS bigint) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)"""
