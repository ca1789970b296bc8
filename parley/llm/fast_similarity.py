"""Near duplicates by fast similarity sketching, banding and exact verification.

1. Equal sets of shingles become one class (by size and a 128-bit fingerprint).
2. Sketches. A set fills COORDINATES bins in rounds: in round i each shingle goes to one hashed bin with a hashed value, and a
   bin that is still empty keeps the least one that came; from round COORDINATES on, round COORDINATES + j puts all shingles
   into bin j, so every bin fills. Large sets need one round, small ones some more. Two sets agree in a bin with the
   probability of their similarity, and the share of bins in which they agree is as concentrated about it as with
   independent draws at least.
3. Bands of ROWS bins each make a bucket. A link at the threshold of 85 % shares none of BANDS buckets with a chance of
   (1 - 0.85**ROWS)**BANDS, 7e-9; a closer one with less.
4. First links: of every bucket the member that shares most buckets with others is its centre, and the members are
   verified against centres. What a family of copies was made from is such a centre.
5. The rest. Buckets that still hold several components are opened: their members, dealt to bounded shares, are compared by
   sketches first (a pair that agrees in less than LEAST_AGREED of the bins, nine standard deviations below the threshold, is no
   link), then the members that have such a partner are verified. Members of one component are never compared.

Links are confirmed on full sets of 64-bit shingle hashes. Tasks return at most a link for a set and component that it meets:
a family of n copies gives n links, not n squared. Families whose members agree almost to the threshold without reaching it
are compared member by member, in shares; no row is made for such pairs.

Defined results: null and empty texts have no shingles and stay alone; a text shorter than a shingle has one, its whole
word sequence; rows are told apart by their place, so equal and null ids are separate documents, and of equal ids in
different components each is judged by its own; a component without any id has the id null, and its documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import PLACE_BITS, chunked, pack_sorted, rows_of, settled, unpack_batch, unpack_sorted
from parley.llm.components import components
from parley.llm.jaccard_join import shingle_sets
from parley.llm.text import mix, slices, tidied

SHINGLE, PERCENT = 5, 85
ROWS, BANDS = 5, 32
COORDINATES = ROWS * BANDS
#: Bins that a link agrees in at least: at 85 % the mean is 136 and the standard deviation 4.5.
LEAST_AGREED = 96
#: Members of a bucket, or shingles of its members, in one share.
SHARE_ROWS, SHARE_SHINGLES = 2048, 1 << 20
#: Texts that are sketched at once; bounds working arrays.
SKETCH_BYTES = 2 << 20


def sketches(found: np.ndarray, first: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """Sketches of sets (shingle hashes, and where each set's begin), one a row; of an empty set all bins are 0."""
    n_sets = len(first) - 1
    full = np.uint64(2**64 - 1)
    out = np.zeros((n_sets, size), dtype=np.uint64)
    filled = np.zeros((n_sets, size), dtype=bool)
    open_ = np.flatnonzero(np.diff(first) > 0)
    owner_of = np.repeat(np.arange(n_sets), np.diff(first))
    shingles, owner = found, owner_of
    for turn in range(2 * size):
        drawn = mix(shingles ^ mix(np.array([turn + 1], dtype=np.uint64)))
        if turn < size:
            # The upper bits give the bin, all bits the value: within a bin the value is as good as uniform.
            bins = ((drawn >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            bins = np.full(len(drawn), turn - size)
        values = np.full((len(open_), size), full)
        place = np.empty(n_sets, dtype=np.int64)
        place[open_] = np.arange(len(open_))
        np.minimum.at(values.ravel(), place[owner] * size + bins, mix(drawn))
        new = ~filled[open_] & (values < full)
        kept = out[open_]
        kept[new] = values[new]
        out[open_] = kept
        filled[open_] |= new
        still = ~filled[open_].all(1)
        if not still.any():
            break
        if not still.all():
            stays = np.zeros(n_sets, dtype=bool)
            stays[open_[still]] = True
            here = stays[owner]
            shingles, owner, open_ = shingles[here], owner[here], open_[still]
    return out


def buckets_of(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key a band for each sketch."""
    bands = sketch.reshape(len(sketch), -1, rows)
    out = np.full(bands.shape[:2], np.uint64(0)) + np.arange(1, bands.shape[1] + 1, dtype=np.uint64)
    for r in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) ^ bands[:, :, r])
    return out


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])[first])


def sketched(chunks: DataFrame, text: str, size: int, kind: str) -> DataFrame:
    """(node, doc_id, n, one, two, sketch, buckets) of every row: its number, id, size, fingerprint, sketch (a byte a bin)
    and keys."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            node = row["chunk_id"] << PLACE_BITS
            for part in unpack_batch(row["payload"]).combine_chunks().to_batches():
                for batch in slices(part, text, SKETCH_BYTES):
                    found, first = shingle_sets(batch.column(text), size)
                    drawn = sketches(found, first)
                    keys = buckets_of(drawn).view(np.int64)
                    short = drawn.astype(np.uint8)  # the low bits: the high ones of a least value are mostly zero
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(node + np.arange(batch.num_rows)),
                            batch.column("doc_id"),
                            pa.array(np.diff(first), pa.int64()),
                            pa.array(_sums(found, first).view(np.int64)),
                            pa.array(_sums(mix(found ^ np.uint64(0xA5A5A5A5)), first).view(np.int64)),
                            pa.array([x.tobytes() for x in short], pa.binary()),
                            pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel())),
                        ],
                        names=["node", "doc_id", "n", "one", "two", "sketch", "buckets"],
                    )
                    node += batch.num_rows

    return chunks.mapInArrow(tidied(measure), f"node long, doc_id {kind}, n long, one long, two long, sketch binary, buckets array<long>")


def agreed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each sketch of a in how many bins it agrees with each sketch of b."""
    out = np.empty((len(a), len(b)), dtype=np.int32)
    for i, one in enumerate(a):
        out[i] = (b == one).sum(1)
    return out


def sketch_rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES)


def full_sets(chunks: DataFrame, nodes: DataFrame, text: str, size: int) -> DataFrame:
    """(node, tokens) for the nodes: all shingle hashes, ascending and packed."""
    by_chunk = nodes.groupBy(F.shiftright("node", PLACE_BITS).alias("chunk_id")).agg(F.collect_list(F.col("node").bitwiseAND((1 << PLACE_BITS) - 1)).alias("places"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            places = np.sort(np.array(row["places"]))
            found, first = shingle_sets(unpack_batch(row["payload"]).column(text).combine_chunks().take(pa.array(places)), size)
            packed = [pack_sorted(np.sort(found[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"node": (row["chunk_id"] << PLACE_BITS) + places, "tokens": pa.array(packed, pa.binary())})

    return chunks.join(by_chunk, "chunk_id").select("chunk_id", "payload", "places").mapInArrow(tidied(pack), "node long, tokens binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def first_links(members: DataFrame, marks: DataFrame, chunks: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Links (a, b) between members of a bucket and its centre."""
    scores = members.groupBy("node").agg(F.sum("held").alias("score"))
    centres = members.join(scores, "node").groupBy("key").agg(F.max(F.struct("score", -F.col("node"))).alias("best")).select("key", (-F.col("best.col2")).alias("other"))
    pairs = members.join(centres, "key").where("node <> other").select("node", "other").distinct()
    marked = marks.select("node", "n", "sketch")
    both = pairs.join(marked, "node").join(marked.toDF("other", "other_n", "other_sketch"), "other")
    fits = (F.col("n") * 100 >= F.col("other_n") * percent) & (F.col("other_n") * 100 >= F.col("n") * percent)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (sketch_rows(batch.column("sketch")) == sketch_rows(batch.column("other_sketch"))).sum(1)
                yield batch.select(["node", "other"]).filter(pa.array(same >= LEAST_AGREED))

    close = settled(both.where(fits).select("node", "other", "sketch", "other_sketch").mapInArrow(tidied(near), "node long, other long"))
    needed = close.select("node").union(close.select("other")).distinct()
    sets = settled(full_sets(chunks, needed, text, size))
    held = close.join(sets, "node").join(sets.toDF("other", "other_tokens"), "other").select("node", "tokens", "other", "other_tokens")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, theirs = None, None
        for batch in batches:
            a, b = [], []
            for node, tokens, other, other_tokens in zip(*(batch.column(i) for i in range(4)), strict=True):
                if other.as_py() != last:
                    last, theirs = other.as_py(), unpack_sorted(other_tokens.as_py())
                if linked(unpack_sorted(tokens.as_py()), theirs, percent):
                    a.append(node.as_py())
                    b.append(last)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return settled(held.mapInArrow(tidied(verify), "a long, b long"))


def dealt(asking: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides (key, node, n, …) of each bucket dealt to shares (key, low, high): every row of one side meets every row of
    the other in one share, and a side's part of a share is bounded in rows and shingles."""

    def shares(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / SHARE_ROWS), F.ceil(F.sum("n") / SHARE_SHINGLES), F.lit(1)).alias(name))

    sizes = shares(asking, "lows").join(shares(asked, "highs"), "key")
    place = {"low": F.pmod(F.xxhash64("node"), "lows"), "high": F.pmod(F.xxhash64("node", F.lit(3)), "highs")}

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    left = asking.join(sizes, "key").withColumn("low", place["low"]).withColumn("high", every("highs"))
    right = asked.join(sizes, "key").withColumn("high", place["high"]).withColumn("low", every("lows"))
    left, right = left.drop("lows", "highs"), right.drop("lows", "highs")
    return left, right.toDF(*right.columns)


SHARE = ["key", "low", "high"]


def further_links(members: DataFrame, marks: DataFrame, labels: DataFrame, chunks: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """A link (a, b), by their names, between any two components of labels (node, component) that have one and share a bucket."""
    placed = members.select("key", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Rank: the size of the component, then its name; of two sets the one of lower rank asks the other.
    sizes = placed.select("node", "component").distinct().groupBy("component").agg(F.count("*").alias("members"))
    ranked = settled(placed.join(sizes, "component").select("key", "node", "members", "component"))
    ranked = ranked.select("key", "node", F.struct("members", "component").alias("rank"))
    mixed = ranked.groupBy("key").agg(F.min("rank").alias("least"), F.max("rank").alias("most"), F.bit_xor(F.xxhash64("node")).alias("same"), F.count("*").alias("rows")).where("least < most")
    # Of buckets with the same members one is opened.
    mixed = mixed.groupBy("same", "rows").agg(F.min(F.struct("key", "least", "most")).alias("one")).select("one.*")
    opened = ranked.join(mixed, "key").join(marks.select("node", "n", "sketch"), "node")
    opened = settled(opened.select("key", "node", "n", "sketch", "rank.members", "rank.component", (F.col("rank") < F.col("most")).alias("asks"), (F.col("rank") > F.col("least")).alias("is_asked")))

    def above(x: pa.Table, y: pa.Table) -> np.ndarray:
        """Which pairs may be a link that is not known: the second of a higher rank, of a size that fits."""
        n, m = x.column("n").to_numpy()[:, None], y.column("n").to_numpy()[None]
        a, b = x.column("members").to_numpy()[:, None], y.column("members").to_numpy()[None]
        c, d = x.column("component").to_numpy()[:, None], y.column("component").to_numpy()[None]
        return ((a < b) | ((a == b) & (c < d))) & (100 * n >= percent * m) & (100 * m >= percent * n)

    def partners(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return pa.table({"key": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})
        near = above(x, y) & (agreed(sketch_rows(x.column("sketch")), sketch_rows(y.column("sketch"))) >= LEAST_AGREED)
        both = np.concatenate([x.column("node").to_numpy()[near.any(1)], y.column("node").to_numpy()[near.any(0)]])
        return pa.table({"key": pa.array(np.full(len(both), x.column("key")[0].as_py()), pa.int64()), "node": both})

    asking, asked = dealt(opened.where("asks").drop("asks", "is_asked"), opened.where("is_asked").drop("asks", "is_asked"))
    live = asking.groupBy(*SHARE).cogroup(asked.groupBy(*SHARE)).applyInArrow(partners, "key long, node long")
    live = settled(opened.drop("sketch").join(live.distinct(), ["key", "node"]))
    sets = settled(full_sets(chunks, live.select("node").distinct(), text, size))

    def verify(x: pa.Table, y: pa.Table) -> pa.Table:
        a, b = [], []
        if x.num_rows and y.num_rows:
            may = above(x, y)
            theirs = [unpack_sorted(t.as_py()) for t in y.column("tokens")]
            n = np.array([len(t) for t in theirs])
            flat, owner = np.concatenate(theirs), np.repeat(np.arange(len(theirs)), n)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            component = y.column("component").to_numpy()
            for i, (name, tokens) in enumerate(zip(x.column("component").to_pylist(), x.column("tokens"), strict=True)):
                if not may[i].any():
                    continue
                own = unpack_sorted(tokens.as_py())
                low, high = np.searchsorted(flat, own), np.searchsorted(flat, own, side="right")
                many = high - low
                shared = np.bincount(owner[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())], minlength=len(theirs))
                # One link for each component that has one.
                met = np.unique(component[may[i] & (100 * shared >= percent * (len(own) + n - shared))])
                a += [name] * len(met)
                b += met.tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    asking, asked = dealt(live.where("asks").drop("asks", "is_asked"), live.where("is_asked").drop("asks", "is_asked"))
    asking, asked = asking.join(sets, "node"), asked.join(sets.toDF("node", "tokens"), "node")
    return settled(asking.groupBy(*SHARE).cogroup(asked.toDF(*asked.columns).groupBy(*SHARE)).applyInArrow(verify, "a long, b long"))


def near_duplicates(docs: DataFrame, text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks, _ = chunked(docs.select("doc_id", text), text)
    rows = settled(sketched(chunks, text, size, kind))
    mark = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    classes = rows.where("n > 0").groupBy("n", "one", "two").agg(F.min_by(F.struct("node", "sketch", "buckets"), "node").alias("head"), F.min(mark).alias("least"))
    classes = settled(classes.select("n", "one", "two", "head.*", "least"))
    keyed = classes.select("node", F.explode("buckets").alias("key"))
    several = keyed.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    members = settled(keyed.join(several, "key"))
    links = first_links(members, classes, chunks, text, size, percent)
    labels = components(links)
    joined = components(further_links(members, classes, labels, chunks, text, size, percent)).toDF("first", "joined")
    placed = classes.select("n", "one", "two", "node", "least").join(labels, "node", "left").withColumn("first", F.coalesce("component", "node"))
    placed = placed.join(joined, "first", "left").withColumn("component", F.coalesce("joined", "first")).drop("first")
    leasts = placed.groupBy("component").agg(F.min("least").alias("id"))
    known = placed.join(leasts, "component").select("n", "one", "two", F.col("id.doc_id").alias("component_id"))
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    every = rows.select("doc_id", "n", "one", "two").join(known, ["n", "one", "two"]).select("doc_id", "n", "component_id").unionByName(alone)
    return every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def oracle_sql(size: int = SHINGLE, percent: int = PERCENT) -> str:
    """near_duplicates over the table documents as DuckDB SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
shingle AS MATERIALIZED (SELECT DISTINCT r, words[i + 1:i + {size}] AS s
  FROM (SELECT *, unnest(range(0, CASE WHEN len(words) = 0 THEN 0 ELSE greatest(len(words) - {size} + 1, 1) END)) AS i FROM doc)),
sized AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM shingle a JOIN shingle b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM shared JOIN sized x ON x.r = a JOIN sized y ON y.r = b WHERE 100 * k >= {percent} * (x.n + y.n - k)),
reach AS (SELECT r AS a, r AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
least AS (SELECT a, min(doc_id) AS component_id FROM reach JOIN doc ON doc.r = reach.b GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS bigint) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM doc LEFT JOIN sized USING (r) JOIN least ON least.a = doc.r"""
