"""Centroid clustering over zone maps along a Hilbert curve.

1. Vectors of whole numbers are put in the order of a Hilbert curve over the CURVE_DIMS components that vary most, and cut
   into blocks of neighbours. A block keeps, besides its vectors, the least and greatest value of every component (its
   box), and the sums of its components. Blocks are written once.
2. In every round each block is held against all centroids by its box: a centroid is a candidate unless another one is
   nearer to every point of the box (the bound on the difference of the two distances is exact, as the difference is linear
   in the point). A block with one candidate goes there as a whole, by its sums, and its vectors are not looked at.
3. Vectors of the other blocks are compared exactly with the block's candidates.

Tasks return a row for each centroid and component; the driver sees the centroids, never a vector. The curve decides how
many candidates a block has, never what comes out. Equal vectors have equal keys, so rows carry a number that lets Spark
cut between them: a vector in a third of all rows fills many partitions.

Defined results: a vector of another length, or with a component that is null, NaN or infinite, is left out; so is a null
vector. Rows are told apart by their place: equal and null ids are separate vectors, of which the ones with the least
components start first; null ids start last. Fewer vectors than centroids make fewer centroids; no vectors give no rows.
Components of LIMIT / SCALE or more raise a ValueError, as their distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import settled
from parley.llm.text import tidied

DIMS, CLUSTERS, ROUNDS, SCALE = 64, 8, 10, 1024
#: Whole components are smaller than this, so that squared distances fit a long.
LIMIT = 1 << 27
#: The curve runs over so many components, in steps of 2**-CURVE_BITS of their range; both make a 64-bit key.
CURVE_DIMS, CURVE_BITS = 16, 4
BLOCK_ROWS = 256


def whole_vectors(vectors: DataFrame, vector: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, q): the vectors that count, as whole numbers floor(scale * x)."""
    typed = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is above infinity
    return typed.where((F.size("x") == dims) & finite).select("vec_id", F.transform("x", lambda x: F.floor(x * float(scale))).alias("q"))


def matrix(column: pa.Array, dims: int, kind: type = np.int64) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dims)


def hilbert_keys(places: np.ndarray, bits: int) -> np.ndarray:
    """The place along the Hilbert curve, as unsigned 64-bit numbers, of points with components below 2**bits.

    Rotations are undone bit by bit for all points at once, then the Gray code, then the bits are interleaved.
    """
    x = places.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    for bit in [top >> b for b in range(bits - 1)]:
        below = bit - 1
        for row in x:
            swap = np.where(row & bit, 0, (x[0] ^ row) & below)
            x[0] ^= np.where(row & bit, below, swap)
            row ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    for bit in [top >> b for b in range(bits - 1)]:
        turn ^= np.where(x[-1] & bit, bit - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for b in reversed(range(bits)):
        for row in x:
            key = (key << np.uint64(1)) | ((row >> b) & 1).astype(np.uint64)
    return key


def spread(whole: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value, greatest value and variance of every component."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column("q"), dims)
            if len(q):
                near = q.astype(float)
                yield pa.RecordBatch.from_pydict(
                    {"dim": np.arange(dims), "low": q.min(0), "high": q.max(0), "n": np.full(dims, float(len(q))), "s": near.sum(0), "ss": (near * near).sum(0)}
                )

    parts = whole.mapInArrow(tidied(measure), "dim long, low long, high long, n double, s double, ss double")
    rows = parts.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high"), (F.sum("ss") / F.sum("n") - F.pow(F.sum("s") / F.sum("n"), 2)).alias("v")).orderBy("dim").collect()
    return tuple(np.array([r[c] for r in rows]) for c in ("low", "high", "v"))


def blocks(whole: DataFrame, low: np.ndarray, high: np.ndarray, variance: np.ndarray, dims: int) -> DataFrame:
    """Neighbours along the curve: (ids, q, low, high, sums) with up to BLOCK_ROWS vectors a row, settled."""
    kind = whole.schema["vec_id"].dataType.simpleString()
    chosen = np.argsort(-variance, kind="stable")[:CURVE_DIMS]
    step = np.maximum(high - low + 1, 1)[chosen]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            q = matrix(batch.column("q"), dims)
            places = ((q[:, chosen] - low[chosen]) << CURVE_BITS) // step
            key = (hilbert_keys(places, CURVE_BITS) ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(seen + np.arange(len(q))), *batch.columns], names=["key", "row", "vec_id", "q"])
            seen += len(q)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = np.append(np.arange(0, batch.num_rows, BLOCK_ROWS), batch.num_rows)
            q = matrix(batch.column("q"), dims, np.int32)
            firsts = edges[:-1]

            def lists(rows: np.ndarray, each: int) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(np.arange(len(firsts) + 1, dtype=np.int32) * each), pa.array(rows.ravel()))

            if len(firsts):
                ids = batch.column("vec_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), ids),
                        pa.ListArray.from_arrays(pa.array(edges * dims, pa.int32()), pa.array(q.ravel())),
                        lists(np.minimum.reduceat(q, firsts), dims),
                        lists(np.maximum.reduceat(q, firsts), dims),
                        lists(np.add.reduceat(q, firsts, dtype=np.int64), dims),
                    ],
                    names=["ids", "q", "low", "high", "sums"],
                )

    along = whole.mapInArrow(tidied(keyed), f"key long, row long, vec_id {kind}, q array<long>")
    along = along.repartitionByRange("key", "row").sortWithinPartitions("key", "row").select("vec_id", "q")
    return settled(along.mapInArrow(tidied(cut), f"ids array<{kind}>, q array<int>, low array<int>, high array<int>, sums array<long>"))


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each box which centroids can be the nearest of one of its points; of two as near the first counts."""
    lengths = (centroids * centroids).sum(1)
    middle = low + high  # twice the middle of the box
    best = (4 * lengths[None] - 4 * middle @ centroids.T).argmin(1)
    out = np.empty((len(low), len(centroids)), dtype=bool)
    for k, centroid in enumerate(centroids):
        away = centroid - centroids[best]
        # The greatest value over the box of: squared distance to the best one less that to this one.
        lead = 2 * np.where(away > 0, high * away, low * away).sum(1) + lengths[best] - lengths[k]
        out[:, k] = (lead > 0) | ((lead == 0) & (k <= best))
    return out


def nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid, the first of equals, and its squared distance."""
    apart = np.stack([np.square(q - c).sum(1) for c in centroids])
    which = apart.argmin(0)
    return which, apart[which, np.arange(len(q))]


def placed(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, dims: int) -> Iterator[tuple[pa.Scalar, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: its ids, its vectors, the sums of its components, and the numbers of its candidates."""
    for batch in batches:
        low, high, sums = (matrix(batch.column(c), dims) for c in ("low", "high", "sums"))
        open_ = candidates(low, high, centroids)
        for i in range(batch.num_rows):
            q = batch.column("q")[i].values.to_numpy(zero_copy_only=False).reshape(-1, dims)
            yield batch.column("ids")[i].values, q, sums[i], np.flatnonzero(open_[i])


def next_centroids(cut: DataFrame, centroids: np.ndarray, dims: int) -> np.ndarray:
    """One round: each centroid becomes the floor of the mean of its vectors; one without vectors stays."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(centroids), dims + 1), dtype=np.int64)
        for _, q, sums, few in placed(batches, centroids, dims):
            if len(few) == 1:
                totals[few[0]] += np.append(sums, len(q))
                continue
            which, _ = nearest(q.astype(np.int64), centroids[few])
            for k, centroid in enumerate(few):
                own = which == k
                totals[centroid] += np.append(q[own].sum(0, dtype=np.int64), own.sum())
        yield pa.RecordBatch.from_pydict({"cluster": np.repeat(np.arange(len(centroids)), dims + 1), "dim": np.tile(np.arange(dims + 1), len(centroids)), "total": totals.ravel()})

    parts = cut.mapInArrow(tidied(tally), "cluster long, dim long, total long")
    found = {(r["cluster"], r["dim"]): int(r["total"]) for r in parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    out = centroids.copy()
    for k in range(len(centroids)):
        if n := found[k, dims]:
            out[k] = [found[k, d] // n for d in range(dims)]
    return out


def centroid_clustering(
    vectors: DataFrame, vector: str = "embedding", seed: str = "3", dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[np.ndarray, DataFrame]:
    """The centroids, and (vec_id, cluster, distance) for every vector that counts; distances are squared."""
    whole = whole_vectors(vectors, vector, dims, scale)
    kind = whole.schema["vec_id"].dataType.simpleString()
    first = whole.withColumn("draw", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    centroids = np.array([r["q"] for r in first.orderBy(F.asc_nulls_last("draw"), "q").limit(clusters).collect()], dtype=np.int64).reshape(-1, dims)
    if not len(centroids):
        return centroids, whole.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    low, high, variance = spread(whole, dims)
    if max(-low.min(), high.max()) >= LIMIT:
        raise ValueError(f"components of {LIMIT // scale} or more have no exact squared distance as a long; leave such vectors out")
    cut = blocks(whole, low, high, variance, dims)
    for _ in range(rounds):
        after = next_centroids(cut, centroids, dims)
        if (after == centroids).all():
            break  # no later round would change anything
        centroids = after
    last = centroids

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, q, _, few in placed(batches, last, dims):
            which, distance = nearest(q.astype(np.int64), last[few])
            yield pa.RecordBatch.from_arrays([ids, pa.array(few[which].astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return centroids, settled(cut.mapInArrow(tidied(assign), f"vec_id {kind}, cluster int, distance long"))


def with_inertia(centroids: np.ndarray, assigned: DataFrame) -> DataFrame:
    """Assigned vectors with cluster_inertia, inertia and centroid_sha256; one row a centroid is broadcast."""
    spark = assigned.sparkSession
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(k, inertia.get(k, 0), sum(inertia.values()), digest) for k, digest in enumerate(digests)]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = "3") -> str:
    """with_inertia over the table embeddings as DuckDB SQL: plain rounds, every vector against every centroid."""
    steps = []
    for i in range(1, rounds + 2):
        steps.append(f"""near{i} AS MATERIALIZED (SELECT r, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT r, k, CAST(sum((q - c) * (q - c)) AS bigint) AS d FROM v JOIN c{i - 1} USING (dim) GROUP BY r, k) GROUP BY r)""")
        if i <= rounds:
            steps.append(f"""m{i} AS (SELECT k, dim, sum(q) AS s, count(*) AS n FROM v JOIN near{i} USING (r) GROUP BY k, dim),
c{i} AS MATERIALIZED (SELECT k, dim, CAST(CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS bigint) AS c FROM c{i - 1} LEFT JOIN m{i} USING (k, dim))""")
    chain, last = ",\n".join(steps), rounds + 1
    return f"""
WITH long AS (SELECT r, vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim FROM (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings) WHERE len(embedding) = {dims}),
kept AS (SELECT r FROM long GROUP BY r HAVING count(*) FILTER (x IS NOT NULL AND isfinite(x)) = {dims}),
v AS MATERIALIZED (SELECT r, vec_id, dim, CAST(floor({scale} * CAST(x AS double)) AS bigint) AS q FROM long JOIN kept USING (r)),
start AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || CAST(any_value(vec_id) AS varchar)) NULLS LAST, list(q ORDER BY dim)) - 1 AS k, r FROM v GROUP BY r),
c0 AS MATERIALIZED (SELECT k, dim, q AS c FROM v JOIN start USING (r) WHERE k < {clusters}),
{chain},
digest AS (SELECT k, sha256(string_agg(CAST(c AS varchar), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY k),
one AS (SELECT r, any_value(vec_id) AS vec_id FROM v GROUP BY r)
SELECT vec_id, CAST(k AS integer) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS bigint) AS cluster_inertia, CAST(sum(d) OVER () AS bigint) AS inertia, centroid_sha256
FROM near{last} JOIN one USING (r) JOIN digest USING (k)"""
