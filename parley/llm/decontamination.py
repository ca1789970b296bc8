"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become templates: numbers, names (capitalised words within a sentence) and units after numbers give way to typed
placeholders, the rest is lower-cased and loses its punctuation. Windows of WINDOW template words of the benchmark are
hash-joined with every window of the documents, which meets every common run of WINDOW words wherever it stands. Each
match fixes how an item would lie in a document; along it all words are compared, and the values behind equal placeholders
must correspond: one value of the item, one value of the document. So a question whose numbers or names were exchanged
throughout is found, and chance likeness of templates is not. An item that stands there almost word for word (VERBATIM) is found
too where one of its numbers was changed at one of its places.

Windows with fewer than TELLING words that are not placeholders are no evidence. Items without a window that is, from their
second word on (the first may be read as a name within a document), are short or mostly placeholders. They are joined
as a whole: by all their words, values included, and, if TELLING words from the second on are no placeholders, by their
template. All their words must agree. Each distinct length of such items costs one more hash for each word of a document.

Documents are read twice; the second time only those with a match are made into templates.

Defined results: null and empty texts match nothing; rows with equal ids and texts give one result; a null id is a document
like any other; an empty benchmark finds nothing. The SQL looks up every window too, but joins no whole items: what it
finds, matches() finds too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import settled

WINDOW, TELLING = 8, 5
#: Words along the item that must agree: half of it, RUN at most, WINDOW at least.
RUN = 13
#: Percent of an item's words, RUN words at least, whose literal agreement makes a leak whatever the slots hold.
VERBATIM = 80
#: Benchmark windows up to which they are broadcast, 24 bytes each.
BROADCAST_WINDOWS = 500_000
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
#: Kinds of keys of whole items.
LITERAL, LOOSE = "literal", "loose"
BLANK = r"[ \t\n\x0B\f\r]"
# Units of measure and currency that may follow a number.
UNITS = "mm|cm|m|km|mg|g|kg|ml|l|s|h|hz|w|kw|v|in|ft|mi|lb|lbs|oz|inch|inches|foot|feet|yard|yards|mile|miles|meter|meters|metre|metres|kilometer|kilometers|kilometre|kilometres|gram|grams|kilogram|kilograms|pound|pounds|liter|liters|litre|litres|gallon|gallons|second|seconds|minute|minutes|hour|hours|day|days|week|weeks|month|months|year|years|degree|degrees|percent|dollar|dollars|cent|cents|euro|euros"


def marked(text: Column) -> Column:
    """The text in lower case without punctuation, each value behind the mark of its type."""
    # Rare characters come first in a pattern and what must stand around them after, so most places fail at one comparison.
    text = F.regexp_replace(text, r" (?=\p{Lu}\p{L})(?<=[\p{Ll}\p{Nd},;:)] )", " " + NAME)
    # A number starts at a digit that continues none; it is not matched as a whole, for it may have any length.
    text = F.regexp_replace(text, r"[0-9](?<![0-9].)(?<![0-9][.,:/].)", NUMBER + "$0")
    text = F.lower(F.regexp_replace(text, r"[^\p{L}\p{Nd}\x01-\x03 \t\n\x0B\f\r]+", ""))
    return F.regexp_replace(text, r"(\x02[^ \x02\t\n\x0B\f\r]* )(" + UNITS + r")([ \t\n\x0B\f\r]|$)", "$1" + UNIT + "$2$3")


def template(text: Column) -> Column:
    """A marked text without the values: of a word with marks the last one stays. Only marks are looked for, so long words take
    no longer."""
    for _ in range(2):  # what stands before the last mark, then what stands behind it
        text = F.regexp_replace(F.reverse(text), r"([\x01-\x03])[^ \t\n\x0B\f\r]+", "$1")
    return text


def word_list(text: Column) -> Column:
    """The words of a text; none for an empty one."""
    return F.array_remove(F.split(text, BLANK + "+"), "")


def key_at(words: Column, at: Column, size: int = WINDOW, *kind: Column) -> Column:
    """The key of the window of so many words at a place; keys of another kind are other keys."""
    return F.xxhash64(F.slice(words, at + 1, F.lit(size)), *kind)


def plain(text: Column) -> Column:
    """A marked text, or a word of it, without marks."""
    return F.translate(text, NAME + NUMBER + UNIT, "")


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_values, item_words) of the benchmark."""
    values = benchmark.where("text is not null").distinct().select("item_id", marked(F.col("text").cast("string")).alias("marked"))
    return values.select("item_id", word_list(F.col("marked")).alias("item_values"), word_list(template(F.col("marked"))).alias("item_words"))


def places(texts: DataFrame, exact_sizes: list[int], loose_sizes: list[int]) -> DataFrame:
    """doc_id, text_key, at and key of every window of (doc_id, text), and of the runs that items of these sizes may fill.

    A row for each word, so that keys are made in generated code: functions of arrays would be interpreted for each window.
    """
    cut = texts.select("doc_id", F.xxhash64("text").alias("text_key"), marked(F.col("text")).alias("marked"))
    words = cut.select("doc_id", "text_key", word_list(template(F.col("marked"))).alias("words"), *[word_list(plain(F.col("marked"))).alias("literal")][: len(exact_sizes)])
    kinds = [("words", WINDOW, []), *(("literal", k, [F.lit(LITERAL)]) for k in exact_sizes), *(("words", k, [F.lit(LOOSE)]) for k in loose_sizes)]
    least = min(size for _, size, _ in kinds)
    # The outer form, as Spark would make the words twice to leave out texts without any; here the condition does it.
    placed = words.select("*", F.posexplode_outer("words").alias("at", "word")).where(F.col("at") <= F.size("words") - least)
    keys = [F.when(F.col("at") <= F.size(name) - size, key_at(F.col(name), F.col("at"), size, *kind)) for name, size, kind in kinds]
    if len(keys) == 1:
        return placed.select("doc_id", "text_key", "at", keys[0].alias("key"))
    return placed.select("doc_id", "text_key", "at", F.explode(F.array(*keys)).alias("key")).where("key is not null")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, at (the item's place in the document's words), n_matched, n_item, n_slots, n_changed of all leaks."""
    items = settled(items_of(benchmark.select("item_id", "text")))

    def telling(words: Column) -> Column:
        return F.size(F.filter(words, lambda w: ~w.isin(NAME, NUMBER, UNIT)))

    windows = items.select("*", F.posexplode("item_words").alias("item_at", "word")).where(F.col("item_at") <= F.size("item_words") - WINDOW)
    windows = windows.where(telling(F.slice("item_words", F.col("item_at") + 1, F.lit(WINDOW))) >= TELLING)
    windows = settled(windows.select(key_at(F.col("item_words"), F.col("item_at")).alias("key"), "item_id", "item_at", F.lit(False).alias("whole")))
    n, rest = F.size("item_words"), F.slice("item_words", 2, F.greatest(F.lit(0), F.size("item_words") - 1))
    found_by_window = windows.where("item_at > 0").select("item_id").distinct()
    short = settled(items.where(n > 0).join(found_by_window, "item_id", "left_anti").withColumn("literal", F.transform("item_values", plain)))
    exact = short.select(F.xxhash64("literal", F.lit(LITERAL)).alias("key"), "item_id", F.lit(0).alias("item_at"), F.lit(True).alias("whole"), n.alias("size"))
    loose = short.where(telling(rest) >= TELLING).select(F.xxhash64(rest, F.lit(LOOSE)).alias("key"), "item_id", F.lit(1).alias("item_at"), F.lit(True).alias("whole"), (n - 1).alias("size"))
    exact_sizes, loose_sizes = (sorted(r["size"] for r in x.select("size").distinct().collect()) for x in (exact, loose))
    known = windows.union(exact.union(loose).drop("size")) if exact_sizes else windows
    known = F.broadcast(known) if known.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS else known

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    lies = places(texts, exact_sizes, loose_sizes).join(known, "key").select("doc_id", "text_key", "item_id", (F.col("at") - F.col("item_at")).alias("at"), "whole")
    lies = settled(lies.groupBy("doc_id", "text_key", "item_id", "at").agg(F.max("whole").alias("whole"), F.max(~F.col("whole")).alias("by_window")))

    found = lies.select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).distinct()
    values = keyed.join(found, F.col("text_key").eqNullSafe(F.col("found_key")) & F.col("doc_id").eqNullSafe(F.col("found_id")), "left_semi").distinct()
    values = values.select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), marked(F.col("text")).alias("marked"))
    values = values.select("own_id", "own_key", word_list(F.col("marked")).alias("doc_values"), word_list(template(F.col("marked"))).alias("doc_words"))
    values = settled(values)
    laid = lies.join(values, F.col("text_key").eqNullSafe(F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("own_id"))).join(items, "item_id")
    first = F.greatest(F.lit(0), -F.col("at"))
    size = F.least(F.size("item_words") - first, F.size("doc_words") - F.col("at") - first)
    part = laid.withColumn("first", first).withColumn("size", size)
    here, there = F.col("first") + 1, F.col("at") + F.col("first") + 1
    pairs = F.arrays_zip(
        F.slice("item_words", here, F.col("size")).alias("item"),
        F.slice("doc_words", there, F.col("size")).alias("doc"),
        F.slice("item_values", here, F.col("size")).alias("item_value"),
        F.slice("doc_values", there, F.col("size")).alias("doc_value"),
    )
    pairs = part.select("doc_id", "text_key", "item_id", "at", "whole", "by_window", F.size("item_words").alias("n_item"), pairs.alias("pairs"))
    pairs = pairs.withColumn("agreed", F.filter("pairs", lambda p: p["item"] == p["doc"]))

    def slots_of(pairs: Column, value: Callable[[Column], Column]) -> Column:
        slots = F.filter(pairs, lambda p: p["item"].isin(NAME, NUMBER, UNIT))
        return F.array_distinct(F.transform(slots, lambda p: F.struct(value(p["item_value"]).alias("item_value"), value(p["doc_value"]).alias("doc_value"))))

    def consistent(slots: str) -> Column:
        return F.size(F.array_distinct(F.col(f"{slots}.item_value"))) == F.size(slots)

    slotted = pairs.withColumn("slots", slots_of(F.col("agreed"), lambda v: v)).withColumn("whole_slots", slots_of(F.col("pairs"), plain))
    enough = F.greatest(F.lit(WINDOW), F.least(F.lit(RUN), F.ceil(F.col("n_item") / 2)))
    verbatim = F.size(F.filter("agreed", lambda p: p["item_value"] == p["doc_value"]))
    literal = verbatim >= F.greatest(F.lit(RUN), F.ceil(F.col("n_item") * VERBATIM / 100))
    by_window = F.col("by_window") & (F.size("agreed") >= enough) & (consistent("slots") | literal)
    all_agree = F.forall("pairs", lambda p: (p["item"] == p["doc"]) | (plain(p["item_value"]) == plain(p["doc_value"])))
    as_whole = F.col("whole") & (F.col("at") >= 0) & (F.size("pairs") == F.col("n_item")) & all_agree & consistent("whole_slots")
    judged = slotted.withColumn("by_window", by_window).where(F.col("by_window") | as_whole)
    counted = judged.select("doc_id", "text_key", "item_id", "at", F.when(F.col("by_window"), F.size("agreed")).otherwise(F.col("n_item")).alias("n_matched"), "n_item", F.when(F.col("by_window"), F.col("slots")).otherwise(F.col("whole_slots")).alias("slots"))
    return counted.select(
        "doc_id", "text_key", "item_id", "at", "n_matched", "n_item", F.size("slots").alias("n_slots"), F.size(F.filter("slots", lambda s: s["item_value"] != s["doc_value"])).alias("n_changed")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no item of the benchmark."""
    leaks = matches(docs, benchmark).select("doc_id", "text_key").distinct().alias("leaks")
    own = docs.alias("own")
    same = F.xxhash64(F.col("own.text").cast("string")).eqNullSafe(F.col("leaks.text_key")) & F.col("own.doc_id").eqNullSafe(F.col("leaks.doc_id"))
    return own.join(leaks, same, "left_anti")


def oracle_sql() -> str:
    """The best match of each document and item, over the tables documents and benchmark, as DuckDB SQL."""

    def marked_sql(text: str) -> str:
        for _ in range(2):
            text = f"regexp_replace({text}, '([\\p{{Ll}}\\p{{Nd}},;:)] )(\\p{{Lu}}\\p{{L}}+)', '\\1' || chr(1) || '\\2', 'g')"
        text = f"regexp_replace({text}, '([0-9]+([.,:/][0-9]+)*)', chr(2) || '\\1', 'g')"
        text = f"lower(regexp_replace({text}, '[^\\p{{L}}\\p{{Nd}}\\x01-\\x03 \\t\\n\\x0B\\f\\r]+', '', 'g'))"
        return f"regexp_replace({text}, '(\\x02[^ \\t\\n\\x0B\\f\\r]* )({UNITS})([ \\t\\n\\x0B\\f\\r]|$)', '\\1' || chr(3) || '\\2\\3', 'g')"

    def listed(text: str) -> str:
        return f"list_filter(regexp_split_to_array({text}, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')"

    blank = "regexp_replace(marked, '[^ \\t\\n\\x0B\\f\\r]*([\\x01-\\x03])[^ \\t\\n\\x0B\\f\\r]*', '\\1', 'g')"

    def texts(table: str, name: str) -> str:
        return f"SELECT DISTINCT {name}, text, {listed('marked')} AS vals, {listed(blank)} AS words FROM (SELECT {name}, text, {marked_sql('text')} AS marked FROM {table} WHERE text IS NOT NULL)"

    slot = "(chr(1), chr(2), chr(3))"
    return f"""
WITH item AS MATERIALIZED ({texts("benchmark", "item_id")}),
doc AS MATERIALIZED ({texts("documents", "doc_id")}),
item_window AS (SELECT item_id, i AS item_at, words[i + 1:i + {WINDOW}] AS win FROM (SELECT *, unnest(range(0, len(words) - {WINDOW} + 1)) AS i FROM item)),
telling AS (SELECT *, array_to_string(win, ' ') AS key FROM item_window WHERE len(list_filter(win, lambda w: w NOT IN {slot})) >= {TELLING}),
doc_window AS (SELECT doc_id, text, i AS doc_at, array_to_string(words[i + 1:i + {WINDOW}], ' ') AS key
  FROM (SELECT *, unnest(range(0, len(words) - {WINDOW} + 1)) AS i FROM doc)),
lies AS (SELECT DISTINCT doc_id, text, item_id, doc_at - item_at AS shift FROM doc_window JOIN telling USING (key)),
laid AS (SELECT l.doc_id, l.item_id, len(i.words) AS n_item, list_filter(list_transform(range(0, len(i.words)),
    lambda j: CASE WHEN l.shift + j >= 0 AND l.shift + j < len(d.words) AND d.words[l.shift + j + 1] = i.words[j + 1]
      THEN {{'word': i.words[j + 1], 'item_value': i.vals[j + 1], 'doc_value': d.vals[l.shift + j + 1]}} END), lambda p: p IS NOT NULL) AS agreed
  FROM lies l JOIN item i USING (item_id) JOIN doc d ON d.doc_id IS NOT DISTINCT FROM l.doc_id AND d.text = l.text),
slotted AS (SELECT *, list_distinct(list_transform(list_filter(agreed, lambda p: p.word IN {slot}),
    lambda p: {{'item_value': p.item_value, 'doc_value': p.doc_value}})) AS slots FROM laid),
counted AS (SELECT doc_id, item_id, n_item, len(agreed) AS n_matched, len(slots) AS n_slots,
    len(list_filter(slots, lambda s: s.item_value <> s.doc_value)) AS n_changed FROM slotted
  WHERE (len(list_distinct(list_transform(slots, lambda s: s.item_value))) = len(slots)
      OR len(list_filter(agreed, lambda p: p.item_value = p.doc_value)) >= greatest({RUN}, ceil(n_item * {VERBATIM} / 100)))
    AND len(agreed) >= greatest({WINDOW}, least({RUN}, ceil(n_item / 2))))
SELECT doc_id, item_id, CAST(n_matched AS integer) AS n_matched, CAST(n_item AS integer) AS n_item, CAST(n_slots AS integer) AS n_slots, CAST(n_changed AS integer) AS n_changed
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_matched DESC, n_changed, n_item DESC, n_slots DESC) AS place FROM counted) WHERE place = 1"""
