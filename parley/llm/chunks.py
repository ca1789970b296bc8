"""Documents in chunks, and exact corpus-wide counts of what the chunks hold.

A chunk is a bounded run of neighbouring documents, kept as one compressed Arrow batch in the checkpoint
folder. Counting hashed keys (words, shingles, windows) over the corpus then takes two small shuffles
instead of one row per occurrence: every chunk sends its distinct keys, sorted and delta-coded, to ranges
of the key space (map-side combine); every range adds them up and sends each chunk the totals of its own
keys, in their order. A chunk holds a key once however often it occurs there, so a key in every document
costs a row for each chunk, never one for each occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from parley.llm.text import give_back, tidied

#: Text bytes of a chunk, as soon as reached; one longer document is a chunk of its own size.
CHUNK_BYTES = 8 << 20
#: Documents of a chunk at most; a row's number is its chunk's id, then so many bits for its place.
PLACE_BITS = 16
#: Keys that one range of the key space should hold.
RANGE_KEYS = 2_000_000
BYTES_PER_KEY = 6
CHUNK_SCHEMA = "chunk_id long, n_rows long, n_bytes long, payload binary, more binary"
KEY_SCHEMA = "part int, chunk_id long, keys binary, counts binary"


def _squeeze(raw: bytes | memoryview) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _stretch(blob: bytes) -> bytes:
    return pa.Codec("zstd", 1).decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit keys; differences, plane by plane, so that the empty high bytes vanish."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _squeeze(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(_stretch(blob), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers of any integer type, in any order."""
    width = values.dtype.itemsize
    return values.dtype.char.encode() + _squeeze(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes())


def unpack_numbers(blob: bytes) -> np.ndarray:
    kind = np.dtype(blob[:1].decode())
    planes = np.frombuffer(_stretch(blob[1:]), dtype=np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_batch(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_batch(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def checkpoint_ready(df: DataFrame) -> DataFrame:
    """Sees to it that a checkpoint folder is set: the one the cluster names, else one in the warehouse."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return df


def settled(df: DataFrame) -> DataFrame:
    """The rows written to the checkpoint folder; later work, also after a lost executor, starts there."""
    return checkpoint_ready(df).checkpoint(eager=True)


def settled_with_sum(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """As settled, with the sum of a column, taken while writing."""
    seen = Observation()
    out = settled(df.observe(seen, F.coalesce(F.sum(column), F.lit(0)).cast("long").alias("total")))
    return out, int(seen.get["total"])


def chunked(docs: DataFrame, text: str = "text", prepare: Callable[[pa.Table], tuple[pa.Table, bytes]] | None = None) -> tuple[DataFrame, int]:
    """Chunks of all columns of docs, and the bytes of text in all. Each row is in one chunk, at one place.

    prepare: makes of a chunk's rows what is kept instead, and further bytes, which become the column more.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size, made = [], 0, 0, 0
        partition = TaskContext.get().partitionId()

        def emit() -> pa.RecordBatch:
            nonlocal held, rows, size, made
            table, more = pa.Table.from_batches(held).combine_chunks(), None
            if prepare:
                table, more = prepare(table)
            row = pa.RecordBatch.from_pydict(
                {"chunk_id": [(partition << 24) + made], "n_rows": [rows], "n_bytes": [size], "payload": [pack_batch(table)], "more": [more]},
                schema=pa.schema([("chunk_id", pa.int64()), ("n_rows", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.binary()), ("more", pa.binary())]),
            )
            held, rows, size, made = [], 0, 0, made + 1
            return row

        for batch in batches:
            lengths = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < len(lengths):
                reach = np.cumsum(lengths[at:])
                take = min(int(np.searchsorted(reach, CHUNK_BYTES - size)) + 1, len(lengths) - at, (1 << PLACE_BITS) - rows)
                held.append(batch.slice(at, take))
                rows, size, at = rows + take, size + int(reach[take - 1]), at + take
                if size >= CHUNK_BYTES or rows == 1 << PLACE_BITS:
                    yield emit()
        if rows:
            yield emit()

    # Rows of a text column of another type than string would have no byte length.
    cast = docs.withColumn(text, F.col(text).cast("string"))
    chunks, total = settled_with_sum(cast.mapInArrow(tidied(pack), CHUNK_SCHEMA), "n_bytes")
    return (chunks if prepare else chunks.drop("more")), total


def parts_for(total_bytes: int) -> int:
    """Bits of the key by which it is dealt to ranges: so many ranges that each holds a bounded number of keys."""
    ranges = max(1, total_bytes // (BYTES_PER_KEY * RANGE_KEYS))
    return max(4, int(ranges - 1).bit_length())


def key_rows(chunk_id: int, keys: np.ndarray, counts: np.ndarray | None, bits: int) -> pa.RecordBatch:
    """The rows of a chunk's distinct keys, which ascend; counts: None where each counts as one."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(edges[1:], len(keys))
    return pa.RecordBatch.from_pydict(
        {
            "part": part[edges].astype(np.int32),
            "chunk_id": np.full(len(edges), chunk_id, dtype=np.int64),
            "keys": pa.array([pack_sorted(keys[a:b]) for a, b in zip(edges, ends, strict=True)], type=pa.binary()),
            "counts": pa.array([None if counts is None else pack_numbers(counts[a:b]) for a, b in zip(edges, ends, strict=True)], type=pa.binary()),
        }
    )


def totals(keys: DataFrame, shape: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """For key rows of all chunks: (chunk_id, answers), where an answer holds, in the order of the chunk's keys of a
    range, shape(total) of each. Totals are over all chunks."""

    def merge(table: pa.Table) -> pa.Table:
        # Lists by column: one row holds the keys of one chunk.
        sets = [unpack_sorted(b.as_py()) for b in table.column("keys")]
        sizes = np.array([len(s) for s in sets])
        counts = np.concatenate([np.ones(n, dtype=np.int64) if b is None else unpack_numbers(b).astype(np.int64) for n, b in zip(sizes, table.column("counts").to_pylist(), strict=True)])
        every = np.concatenate(sets)
        del sets
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        sums = np.add.reduceat(counts[order], first)
        told = np.empty(len(every), dtype=np.int64)
        told[order] = np.repeat(sums, np.diff(np.append(first, len(every))))
        told = shape(told)
        ends = np.cumsum(sizes)
        del counts, every, order
        give_back()
        return pa.table(
            {
                "chunk_id": table.column("chunk_id"),
                "part": table.column("part"),
                "answer": pa.array([pack_numbers(told[e - n : e]) for n, e in zip(sizes, ends, strict=True)], type=pa.binary()),
            }
        )

    told = keys.groupBy("part").applyInArrow(merge, "chunk_id long, part int, answer binary")
    return told.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("part", "answer"))).alias("answers"))


def answered(chunks: DataFrame, told: DataFrame) -> DataFrame:
    """Chunks with the answers to their keys; a chunk without keys has null."""
    return chunks.join(told, "chunk_id", "left")


def answers_of(row_answers: list[dict] | None) -> np.ndarray:
    """All answers of a chunk, in the order of its keys."""
    if not row_answers:
        return np.zeros(0, dtype=np.int64)
    return np.concatenate([unpack_numbers(x["answer"]) for x in row_answers])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: each holds a whole chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
