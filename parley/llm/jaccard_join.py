"""Exact Jaccard join of word shingles with a token-group matrix.

1. Equal sets become one class (by size and a 128-bit fingerprint).
2. Document frequencies of all shingles are counted over the classes. In the order (frequency, hash), a set of n
   shingles that shares at least ceil(t n) with another shares one of its first n - ceil(t n) + 1; sets whose
   first ones occur nowhere else are done. This is most of a corpus.
3. Sets that share one of a few keys (their shingles of least hash, and those that most sets have) are held against one
   set of theirs, the one with the fewest shingles of its own. The links found give first components.
4. Similar sets form groups: equal commonest shingle, sizes within a tenth, and bounded by a hash where they are many. The
   token-group matrix holds, for each group, the union of its members' first shingles. A set queries the groups that
   share one, whose sizes fit and that hold sets of other components; a larger component never queries a smaller one.
5. Only qualifying groups are opened: the overlap of a query with the union of all shingles of the group bounds
   every member from above; members are compared where that bound suffices.

Two sets of one component are never compared, so a family of many near copies costs a link for each member, not one
for each pair. Frequencies are counted under the upper KEY_BITS bits of a shingle's hash: they only order shingles. Sets are
compared by 64-bit hashes of shingles.

Defined results: null and empty texts have no shingles and stay alone; a text shorter than a shingle has one, its whole
word sequence; rows are told apart by their place, so equal and null ids are separate documents; a component without
any id has the id null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import KEY_SCHEMA, PLACE_BITS, answers_of, chunked, key_rows, pack_sorted, parts_for, rows_of, settled, totals, unpack_batch, unpack_sorted
from parley.llm.components import components
from parley.llm.text import first_of, gram_places, grams, mix, runs, texts_of, tidied, words_of

SHINGLE, PERCENT = 5, 75
KEY_BITS = 44
#: Bytes of text, about, that are made into sets at once.
RUN_BYTES = 1 << 20
#: Shingles of a group's members in all, about, and queries that one task opens it for.
GROUP_SHINGLES, OPEN_ROWS = 1 << 20, 2048
#: Shingles by which sets look for a set like them: those of least hash, and those that most sets have.
ROUNDS, COMMON = 2, 3


def need(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of n must share with any set at the threshold: at least percent of the larger one's."""
    return -(-n * percent // 100)


def shingle_sets(texts: pa.Array | pa.ChunkedArray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, text by text, and where each text's begin (one more for the end). Made run by run, as
    the working arrays take some 20 times the bytes of the texts."""
    texts = texts_of(texts)
    found, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in runs(texts, RUN_BYTES):
        own, first = sets_of_run(texts.slice(a, b - a), size)
        found.append(own)
        sizes.append(np.diff(first))
    return np.concatenate(found), np.cumsum(np.concatenate(sizes))


def sets_of_run(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As shingle_sets, of all texts at once."""
    words = words_of(texts, lower=True)
    hashes, counts = words.hashes(), words.counts
    doc = words.documents()
    places = gram_places(words.first, size)
    found, owner = grams(hashes, size)[places] if len(places) else np.zeros(0, np.uint64), doc[places]
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = [grams(hashes[words.first[d] : words.first[d + 1]], int(counts[d]))[0] for d in short]
    found, owner = np.concatenate([found, np.array(whole, dtype=np.uint64)]), np.concatenate([owner, short])
    which, kinds = pd.factorize(found ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    one = first_of(which, len(kinds))
    found, owner = found[one], owner[one]
    order = np.argsort(owner, kind="stable")
    return found[order], np.searchsorted(owner[order], np.arange(len(words.first)))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])[first])


def _masked(hashes: np.ndarray) -> np.ndarray:
    return hashes & np.uint64((2**64 - 1) ^ (2 ** (64 - KEY_BITS) - 1))


def _rarity(total: np.ndarray) -> np.ndarray:
    """0 for shingles of one set, then ascending; exact up to 16 sets, from there in eighths of a doubling."""
    return np.where(total <= 16, total - 1, 16 + np.floor((np.log2(np.maximum(total, 16)) - 4) * 8)).clip(0, 255).astype(np.uint8)


def numbered(chunks: DataFrame, text: str, size: int) -> DataFrame:
    """(node, doc_id, n, one, two) of every row: its number, its id, its set's size and fingerprint."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            table = unpack_batch(row["payload"])
            found, first = shingle_sets(table.column(text), size)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array((row["chunk_id"] << PLACE_BITS) + np.arange(table.num_rows)),
                    "doc_id": table.column("doc_id").cast(pa.int64()).combine_chunks(),
                    "n": pa.array(np.diff(first), pa.int64()),
                    "one": _sums(found, first).view(np.int64),
                    "two": _sums(mix(found ^ np.uint64(0xA5A5A5A5)), first).view(np.int64),
                }
            )

    return chunks.mapInArrow(tidied(measure), "node long, doc_id long, n long, one long, two long")


def survivors(chunks: DataFrame, heads: DataFrame, total_bytes: int, text: str, size: int, percent: int) -> DataFrame:
    """Classes that may have a link: (node, n, own, tokens, prefix, least); own: shingles of no other class; tokens: the rest, packed;
    prefix: those of them among the first; least: the keys under which like sets may meet."""
    bits = parts_for(total_bytes)
    by_chunk = heads.groupBy(F.shiftright("head", PLACE_BITS).alias("chunk_id")).agg(F.collect_list(F.col("head").bitwiseAND((1 << PLACE_BITS) - 1)).alias("places"))
    chosen = chunks.join(by_chunk, "chunk_id").select("chunk_id", "payload", "places")

    def sets(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        places = np.sort(np.array(row["places"]))
        texts = unpack_batch(row["payload"]).column(text).combine_chunks().take(pa.array(places))
        found, first = shingle_sets(texts, size)
        return places, found, first

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            _, found, _ = sets(row)
            own, counts = np.unique(_masked(found), return_counts=True)
            yield key_rows(row["chunk_id"], own, counts, bits)

    def first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            places, found, first = sets(row)
            masked = _masked(found)
            rare = answers_of(row["answers"])[np.searchsorted(np.unique(masked), masked)]
            n = np.diff(first)
            owner = np.repeat(np.arange(len(n)), n)
            own = np.bincount(owner[rare == 0], minlength=len(n))
            reach = n - need(n, percent) + 1
            out = []
            for d in np.flatnonzero(own < reach):
                tokens, classes = found[first[d] : first[d + 1]], rare[first[d] : first[d + 1]]
                order = np.lexsort((tokens, classes))[: reach[d]]
                shared = tokens[classes > 0]
                # What a family of copies has in common is in many sets; what one of them changed is in few.
                common = np.lexsort((shared, -classes[classes > 0].astype(np.int64)))[:COMMON]
                out.append(
                    {
                        "node": (row["chunk_id"] << PLACE_BITS) + int(places[d]),
                        "n": int(n[d]),
                        "own": int(own[d]),
                        "tokens": pack_sorted(np.sort(shared)),
                        "prefix": tokens[order][classes[order] > 0].view(np.int64).tolist(),
                        "least": [int(mix(shared ^ np.uint64(r + 1)).min().view(np.int64)) for r in range(ROUNDS)] + shared[common].view(np.int64).tolist(),
                    }
                )
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("node", pa.int64()), ("n", pa.int64()), ("own", pa.int64()), ("tokens", pa.binary()), ("prefix", pa.list_(pa.int64())), ("least", pa.list_(pa.int64()))]))

    told = totals(chosen.mapInArrow(tidied(keys), KEY_SCHEMA), _rarity)
    kept = chosen.join(told, "chunk_id").select("chunk_id", "payload", "places", "answers")
    return kept.mapInArrow(tidied(first_ones), "node long, n long, own long, tokens binary, prefix array<long>, least array<long>")


def similar(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (n_a + n_b - shared)


def star_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between sets and, for each of their keys, the one set with that key that has the fewest shingles of its own."""
    keyed = sets.select("node", "n", "own", F.explode(F.array_distinct("least")).alias("hash"))
    centres = keyed.groupBy("hash").agg(F.min(F.struct((F.col("own") / F.col("n")).alias("rate"), "node")).alias("centre"), F.count("*").alias("sets")).where("sets > 1")
    centres = settled(centres.select("hash", "centre.node")).withColumnRenamed("node", "other")
    pairs = keyed.join(centres, "hash").select("node", "other").where("node <> other").distinct()
    full = sets.select("node", "n", "tokens")
    both = pairs.join(full, "node").join(full.select(F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("tokens").alias("other_tokens")), "other")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            a, b = [], []
            for x in batch.to_pylist():
                if x["other"] != last:
                    last, held = x["other"], unpack_sorted(x["other_tokens"])
                if similar(unpack_sorted(x["tokens"]), x["n"], held, x["other_n"], percent):
                    a.append(x["node"])
                    b.append(last)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return both.select("node", "n", "tokens", "other", "other_n", "other_tokens").mapInArrow(tidied(verify), "a long, b long")


def group_links(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """At least one link between any two components of labels (node, component) that have one."""
    members = sets.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    members = members.select("node", "n", "prefix", "component", F.element_at("least", ROUNDS + 1).alias("family"))
    # Rank: the size of the component, then its name; of two sets the one of lower rank queries the other's group.
    sizes = members.groupBy("component").agg(F.count("*").alias("members"))
    # A step of the sizes spans a tenth, so that a group's members can have one bound.
    members = members.join(sizes, "component").withColumn("step", F.floor(F.log("n") / F.log(F.lit(1.1))))
    weights = members.groupBy("family", "step").agg(F.ceil(F.sum("n") / GROUP_SHINGLES).alias("subs"))
    members = members.join(weights, ["family", "step"]).withColumn("sub", F.pmod(F.xxhash64("node"), "subs")).withColumn("rank", F.struct("members", "component"))
    members = settled(members)
    group = ["family", "step", "sub"]
    every = members.select("node", "n", "rank", *group, F.explode("prefix").alias("token"))
    meets = every.groupBy("token").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).where("low < high")
    matrix = every.groupBy("token", *group).agg(F.min("n").alias("low_n"), F.max("n").alias("high_n"), F.max("rank").alias("top")).join(meets.select("token"), "token")
    asking = every.join(meets, "token").where("rank < high").select("token", "node", "n", "rank")
    fits = (F.col("rank") < F.col("top")) & (F.col("low_n") * percent <= F.col("n") * 100) & (F.col("high_n") * 100 >= F.col("n") * percent)
    candidates = settled(asking.join(matrix, "token").where(fits).select("node", *group).distinct())
    shares = candidates.groupBy(*group).agg(F.ceil(F.count("*") / OPEN_ROWS).alias("shares"))
    asked = candidates.join(shares, group).withColumn("share", F.pmod(F.xxhash64("node", F.lit(7)), "shares")).drop("shares")
    full = members.select("node", "component", "members").join(sets.select("node", "n", "tokens"), "node")
    queries = asked.join(full, "node").select(*group, "share", "node", "n", "component", "members", "tokens")
    opened = (
        members.select("node", *group)
        .join(shares, group)
        .select("node", *group, F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"))
        .join(full, "node")
        .select(*group, "share", "node", "n", "component", "members", "tokens")
    )

    def open_group(asked: pa.Table, group: pa.Table) -> pa.Table:
        a, b = [], []
        if asked.num_rows and group.num_rows:
            held = [unpack_sorted(x.as_py()) for x in group.column("tokens")]
            nodes, n, component, members = (group.column(c).to_numpy() for c in ("node", "n", "component", "members"))
            flat, owner = np.concatenate(held), np.repeat(np.arange(len(held)), [len(x) for x in held])
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            union = np.unique(flat)
            for x in asked.select(["node", "n", "component", "members", "tokens"]).to_pylist():
                query = unpack_sorted(x["tokens"])
                known = query[np.isin(query, union, assume_unique=True)]
                if 100 * len(known) < percent * max(x["n"], int(n.min())):
                    continue  # no member can reach the threshold
                low, high = np.searchsorted(flat, known), np.searchsorted(flat, known, side="right")
                many = high - low
                hits = owner[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())]
                shared = np.bincount(hits, minlength=len(held))
                above = (members > x["members"]) | ((members == x["members"]) & (component > x["component"]))
                linked = np.flatnonzero(above & (100 * shared >= percent * (x["n"] + n - shared)))
                # One link for each component of the group that has one.
                _, first = np.unique(component[linked], return_index=True)
                a += [x["node"]] * len(first)
                b += nodes[linked[first]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    key = [*group, "share"]
    queries, opened = queries.toDF(*queries.columns), opened.toDF(*opened.columns)  # columns of its own for each side
    return queries.groupBy(*key).cogroup(opened.groupBy(*key)).applyInArrow(open_group, "a long, b long")


def jaccard_components(docs: DataFrame, text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(chunks, rows): rows has node, doc_id, n, component_id and head (the row of its component that has the least id) for
    every row; node is the row's place in the chunks."""
    chunks, total = chunked(docs, text)
    rows = settled(numbered(chunks, text, size))
    mark = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    classes = settled(rows.where("n > 0").groupBy("n", "one", "two").agg(F.min("node").alias("head"), F.min(mark).alias("least")))
    sets = settled(survivors(chunks, classes.select("head"), total, text, size, percent))
    stars = settled(star_links(sets, percent))
    labels = components(stars)
    more = settled(group_links(sets, labels, percent))
    joined = components(stars.unionByName(more))
    placed = classes.join(joined, F.col("head") == F.col("node"), "left").withColumn("component", F.coalesce("component", "head")).drop("node")
    leasts = placed.groupBy("component").agg(F.min("least").alias("least"))
    known = placed.drop("least", "head").join(leasts, "component").select("n", "one", "two", F.col("least.doc_id").alias("component_id"), F.col("least.node").alias("first_row"))
    alone = rows.where("n = 0").select("node", "doc_id", "n", F.col("doc_id").alias("component_id"), F.col("node").alias("first_row"))
    return chunks, rows.join(known, ["n", "one", "two"]).select("node", "doc_id", "n", "component_id", "first_row").unionByName(alone)


def first_of_each(docs: DataFrame, text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The columns of docs, of one row of each component: the one with the least id. Rows without words all stay."""
    chunks, rows = jaccard_components(docs, text, size, percent)
    kept = rows.where("node = first_row").groupBy(F.shiftright("node", PLACE_BITS).alias("chunk_id")).agg(F.collect_list(F.col("node").bitwiseAND((1 << PLACE_BITS) - 1)).alias("places"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield from unpack_batch(row["payload"]).take(pa.array(sorted(row["places"]))).to_batches(max_chunksize=2000)

    return chunks.join(kept, "chunk_id").select("payload", "places").mapInArrow(tidied(choose), docs.withColumn(text, F.col(text).cast("string")).schema)


def oracle_sql(size: int = SHINGLE, percent: int = PERCENT) -> str:
    """doc_id, n_shingles and component_id over the table documents as DuckDB SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
shingle AS MATERIALIZED (SELECT DISTINCT r, words[i + 1:i + {size}] AS s
  FROM (SELECT *, unnest(range(0, CASE WHEN len(words) = 0 THEN 0 ELSE greatest(len(words) - {size} + 1, 1) END)) AS i FROM doc)),
sized AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM shingle a JOIN shingle b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM shared JOIN sized x ON x.r = a JOIN sized y ON y.r = b WHERE 100 * k >= {percent} * (x.n + y.n - k)),
reach AS (SELECT r AS a, r AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT d.doc_id, CAST(coalesce(n, 0) AS bigint) AS n_shingles, least.doc_id AS component_id
FROM doc d LEFT JOIN sized USING (r) JOIN (SELECT a, min(doc_id) AS doc_id FROM reach JOIN doc ON doc.r = reach.b GROUP BY a) least ON least.a = d.r"""
