"""Source divergence audit: what sets the sources of a language apart, by exact smoothed shares of terms.

1. Counts. Tasks count terms in blocks of texts (occurrences, and texts that hold the term), Spark adds them up by
   (lang, source, term). A language keeps its terms that occur in MIN_DOCS of its texts.
2. Dominance skyband. Of two terms of a source the one with the higher count there, the lower count in the language
   and the earlier UTF-8 form ranks first whatever the totals are. So a term that k others dominate is not among the
   first k, and partitions of the terms of a source keep only those that fewer than k others dominate: the k-skyband.
   Skybands of partitions are merged the same way; what is left, some thousand terms, gets its exact shares and rank.
3. Pairs. Sources of a language are compared over all kept terms: partitions of the terms hold the shares of a slice of the
   sources and of all sources as a matrix, and give a row for each pair, which Spark adds up.

A share p is 1 + floor(UNIT * (count + SMOOTH) / (N + SMOOTH * V)), in decimals. A term in every text costs a row for each
block of texts before the shuffle, and one for each source after it; no task holds more than one block, one partition of
the terms, or one source's skybands.

Defined results: null text, lang and source are empty ones, so rows with a null lang and an empty one are one language; a
group without terms compares with the others (its shares are those of no occurrence); a language without kept terms has
pairs of value 0 and no terms; a language with one source has no pairs; repeated rows count as often as they occur; an
empty table has no groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.chunks import settled
from parley.llm.text import Words, first_of, mix, slices, texts_of, tidied, words_of

MIN_DOCS, TOP, SMOOTH, UNIT = 30, 50, 5, 10**9
#: Text bytes that are counted at once.
COUNT_BYTES = 8 << 20
#: Terms of one source in a partition for the skyband; cells of a matrix of shares; sources of a slice.
BAND_TERMS, CELLS, SLICE = 1 << 17, 1 << 17, 256
#: Terms that are held against a skyband at once.
STEP = 512

#: Bytes of a term as they count (A-Z in lower case), all others as blanks.
_TERM = np.full(256, 0x20, dtype=np.uint8)
_TERM[0x80:] = np.arange(0x80, 256)
_TERM[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_TERM[ord("A") : ord("Z") + 1] = _TERM[ord("a") : ord("z") + 1]


def terms_of(column: pa.Array | pa.ChunkedArray) -> Words:
    """Runs of letters a to z and of bytes from 0x80 on."""
    texts = texts_of(column)
    if not len(texts) or texts.buffers()[2] is None:
        return words_of(texts)
    data = pa.py_buffer(_TERM[np.frombuffer(texts.buffers()[2], dtype=np.uint8)])
    return words_of(pa.Array.from_buffers(pa.binary(), len(texts), [None, texts.buffers()[1], data], offset=texts.offset))


def strings(words: Words, which: np.ndarray) -> pa.Array:
    """Some of the words, as an array of strings."""
    starts, lengths = words.starts[which], words.ends[which] - words.starts[which]
    edges = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(edges[-1]) + np.repeat(starts - edges[:-1], lengths)
    return pa.Array.from_buffers(pa.string(), len(which), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(words.data[place])])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of documents (lang, source, text): occurrences, and texts with the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", COUNT_BYTES):
                names = pa.table({c: batch.column(c) for c in ("lang", "source")}).to_pandas()
                group = names.groupby(["lang", "source"], sort=False).ngroup().to_numpy()
                lead = first_of(group, int(group.max()) + 1)
                words = terms_of(batch.column("text"))
                doc = words.documents()
                if not len(doc):
                    continue
                code, kinds = pd.factorize(words.hashes() ^ mix(group[doc].astype(np.uint64) + np.uint64(1)))
                holds = pd.unique(code * len(group) + doc) // len(group)
                one = first_of(code, len(kinds))
                of = lead[group[doc[one]]]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).take(pa.array(of)) for c in ("lang", "source")],
                        strings(words, one),
                        pa.array(np.bincount(code, minlength=len(kinds))),
                        pa.array(np.bincount(holds, minlength=len(kinds))),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )

    parts = docs.mapInArrow(tidied(count), "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def skyband(high: np.ndarray, low: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Which points fewer than k others dominate: by high at least as high, low at most as low, and an earlier name.

    Points come in an order in which no later one dominates an earlier one, and are held against the band so far only:
    a point with k dominators has k of them in the band.
    """
    order = np.lexsort((name, low, -high))
    low, name = low[order], name[order]
    band = np.zeros(0, dtype=np.int64)
    for at in range(0, len(order), STEP):
        here = np.arange(at, min(at + STEP, len(order)))
        beaten = ((low[band] <= low[here, None]) & (name[band] < name[here, None])).sum(1)
        beaten += np.tril((low[here] <= low[here, None]) & (name[here] < name[here, None]), -1).sum(1)
        band = np.append(band, here[beaten < k])
    return np.sort(order[band])


def skybands(kept: DataFrame, top: int) -> DataFrame:
    """Of (lang, source, term, n, lang_n): rows that can be among the first ``top`` of their source, whatever the totals."""

    def band(table: pa.Table) -> pa.Table:
        terms = texts_of(table.column("term"))
        name = np.empty(len(terms), dtype=np.int64)
        name[pc.array_sort_indices(terms).to_numpy()] = np.arange(len(terms))  # by bytes, as UTF-8 orders code points
        return table.take(pa.array(skyband(table.column("n").to_numpy(), table.column("lang_n").to_numpy(), name, top)))

    shape = "lang string, source string, part long, term string, n long, lang_n long"
    columns = [c.split()[0] for c in shape.split(", ")]
    parts = kept.withColumn("part", F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / F.lit(BAND_TERMS)))).select(columns)
    first = parts.groupBy("lang", "source", "part").applyInArrow(band, shape)
    merged = first.withColumn("part", F.lit(0).cast("long")).groupBy("lang", "source").applyInArrow(band, shape)
    return merged.drop("part")


def exact_share(count: str, n: str, v: str) -> Column:
    """1 + floor(UNIT * (count + SMOOTH) / (N + SMOOTH * V)), without rounding."""
    return F.expr(f"1 + (cast({UNIT} as decimal(10,0)) * cast({count} + {SMOOTH} as decimal(20,0))) div cast({n} + {SMOOTH} * {v} as decimal(20,0))")


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language: the sum of the differences of their shares.

    kept: lang, source, term, p; groups: lang, source, n, v, zero (the share of no occurrence).
    """
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.first("v").alias("v"))
    sizes = sizes.select("lang", F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("sources") / CELLS)).alias("parts"), F.ceil(F.col("sources") / SLICE).alias("slices"))

    def each(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(name) - 1))

    numbered = groups.join(sizes, "lang").withColumn("own", F.pmod(F.xxhash64("source"), "slices"))
    columns = numbered.select("lang", each("parts").alias("part"), "slices", "own", "source", "zero").select("lang", "part", each("slices").alias("slice"), "own", "source", "zero")
    cells = kept.join(sizes, "lang").select("lang", F.pmod(F.xxhash64("term"), "parts").alias("part"), each("slices").alias("slice"), "term", "source", "p")

    def compare(cells: pa.Table, columns: pa.Table) -> pa.Table:
        names = columns.column("source").combine_chunks()
        zero = columns.column("zero").to_numpy()
        own = np.flatnonzero(columns.column("own").to_numpy() == columns.column("slice").to_numpy())
        where = pc.index_in(cells.column("source"), value_set=names).to_numpy()
        code, kinds = pd.factorize(cells.column("term").to_numpy())
        order = np.argsort(code, kind="stable")
        code, where, p = code[order], where[order], cells.column("p").to_numpy()[order]
        sums = np.zeros((len(own), len(names)), dtype=np.int64)
        step = max(1, CELLS // max(1, len(names)))
        for at in range(0, len(kinds), step):
            rows = slice(*np.searchsorted(code, [at, at + step]))
            shares = np.tile(zero, (min(step, len(kinds) - at), 1))
            shares[code[rows] - at, where[rows]] = p[rows]
            for i, a in enumerate(own):
                sums[i] += np.abs(shares - shares[:, [a]]).sum(0)
        a, b = np.repeat(own, len(names)), np.tile(np.arange(len(names)), len(own))
        two = a != b
        lang = columns.column("lang")[0].as_py() if columns.num_rows else ""
        return pa.table({"lang": pa.array([lang] * int(two.sum()), pa.string()), "source": names.take(pa.array(a[two])), "item": names.take(pa.array(b[two])), "value": sums.ravel()[two]})

    key = ["lang", "part", "slice"]
    found = cells.groupBy(*key).cogroup(columns.toDF(*columns.columns).groupBy(*key)).applyInArrow(compare, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: every other source of the language (pair), and the first ``top`` terms
    that the source has more of than its language (term)."""
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    of_lang = Window.partitionBy("lang", "term")  # a row for each source
    counts = term_counts(filled).withColumn("lang_n", F.sum("n").over(of_lang)).withColumn("lang_docs", F.sum("docs").over(of_lang))
    kept = settled(counts.where(F.col("lang_docs") >= min_docs).drop("docs", "lang_docs"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("found"))
    langs = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("v"))
    every = filled.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["found", "v"])
    every = settled(every.withColumn("lang_found", F.sum("found").over(Window.partitionBy("lang"))).withColumn("none", F.lit(0)))
    groups = every.withColumn("zero", F.when(F.col("v") > 0, exact_share("none", "found", "v")).otherwise(0)).toDF(*every.columns, "zero")

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", exact_share("n", "found", "v"))
    pairs = pair_values(shares.select("lang", "source", "term", "p"), groups)
    band = skybands(kept.join(langs, "lang"), top).join(groups, ["lang", "source"])
    p, q = exact_share("n", "found", "v"), exact_share("lang_n", "lang_found", "v")
    found = band.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").unionByName(found).withColumn("rank", F.row_number().over(best))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))


def oracle_sql(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """source_divergence over the table documents as DuckDB SQL: every share of every term and source."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def share(count: str, n: str) -> str:
        return f"1 + (CAST({UNIT} AS hugeint) * ({count} + {SMOOTH})) // ({n} + {SMOOTH} * v)"

    return f"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
word AS (SELECT r, lang, source, unnest(words) AS term FROM doc),
known AS MATERIALIZED (SELECT lang, term, CAST(count(*) AS hugeint) AS lang_c FROM word GROUP BY lang, term HAVING count(DISTINCT r) >= {min_docs}),
c AS MATERIALIZED (SELECT lang, source, term, CAST(count(*) AS hugeint) AS c FROM word SEMI JOIN known USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, count(*) AS v, sum(lang_c) AS lang_n FROM known GROUP BY lang),
grp AS MATERIALIZED (SELECT g.lang, g.source, coalesce(any_value(v), 0) AS v, coalesce(any_value(lang_n), 0) AS lang_n, coalesce(sum(c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM doc) g LEFT JOIN c USING (lang, source) LEFT JOIN size ON size.lang = g.lang GROUP BY g.lang, g.source),
share AS MATERIALIZED (SELECT grp.lang, grp.source, known.term, coalesce(c, 0) AS c, {share("coalesce(c, 0)", "n")} AS p, {share("lang_c", "lang_n")} AS q
  FROM grp JOIN known USING (lang) LEFT JOIN c ON c.lang = grp.lang AND c.source = grp.source AND c.term = known.term),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS bigint) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN share x ON x.lang = a.lang AND x.source = a.source LEFT JOIN share y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
part AS (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS bigint) FROM share WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS integer) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM part)
WHERE part = 'pair' OR rank <= {top}"""
