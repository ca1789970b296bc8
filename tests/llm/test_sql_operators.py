"""Licence scan, decontamination and URL filters."""

import time

import duckdb
import pytest
from pyspark.sql import functions as F

from parley.llm import decontamination, license_scan, queries, url_filters
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
RULES = "rule_host string, rule_path string, rule_verdict string"


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(str, want))


# Licences


def scan(spark, *texts):
    docs = brute.frame(spark, list(enumerate(texts)))
    return [(r["licenses"], r["n_loose"]) for r in license_scan.scan(docs).orderBy("doc_id").collect()]


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    got = scan(
        spark,
        None,
        "",
        "Licensed under the Apache License, Version 2.0. Then more.",
        mit,
        "Prose. Released under the MIT License.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.",
        "You may not use this file except in compliance with the License.",
        "licensed under the Apache License, Version 1.2.3",
        "Unlicensed under the Apache License, Version 2.0.",
        "All rights reserved.",
        "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License. You may obtain a copy of the License at",
    )
    assert got == [("", 0), ("", 0), ("Apache-2.0", 0), ("MIT", 0), ("CC-BY-NC-4.0|MIT", 0), ("", 1), ("Apache-1.2.3", 0), ("", 0), ("", 1), ("Apache-2.0", 0)]


MIT_TEXT = """MIT License

Copyright (c) 2024 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{endorse}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
ENDORSE = """
3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL_TEXT = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
MPL_TEXT = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def test_official_texts(spark):
    """Texts with line breaks as they are published, also behind comment signs and with other line ends."""
    three = [BSD_TEXT.format(endorse=ENDORSE.format(name)) for name in ("the copyright holder", "Example 2 Corp.")]
    want = [
        (MIT_TEXT, "MIT"),
        (BSD_TEXT.format(endorse=""), "BSD-2-Clause"),
        (three[0], "BSD-3-Clause"),
        (three[1].replace("Corp.", "Corp"), "BSD-3-Clause"),
        (APACHE_TEXT, "Apache-2.0"),
        (GPL_TEXT, "GPL-or-later-2"),
        (GPL_TEXT.replace("software;", "software:").replace("version 2", "version 3"), "GPL-or-later-3"),
        (GPL_TEXT.replace("program", "library").replace("GNU", "GNU Lesser").replace("version 2", "version 2.1"), "LGPL-or-later-2.1"),
        (MPL_TEXT, "MPL-2.0"),
    ]
    forms = [lambda t: t, lambda t: "".join(f" * {line}\n" for line in t.splitlines()), lambda t: "".join(f"# {line} \r\n" for line in t.splitlines())]
    for form in forms:
        assert scan(spark, *[f"some code\n\n{form(t)}\nmore code" for t, _ in want]) == [(name, 0) for _, name in want]


def test_licence_forms(spark):
    want = [
        ("This file is licensed under the MIT License (MIT).", "MIT"),
        ("It is good. This file is released under the\nApache License, Version 2.0 (Apache-2.0). Done", "Apache-2.0"),
        ("Licensed under the GNU General Public License version 3 (GPLv3).", "GPL-3"),
        ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
        ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("/* SPDX-License-Identifier:GPL-2.0-only */", "GPL-2.0"),
        ("SPDX-License-Identifier: GPL-2.0+ WITH Linux-syscall-note", "GPL-or-later-2.0"),
        ("SPDX-License-Identifier: (LGPL-2.1-or-later OR MIT OR ISC)", "LGPL-or-later-2.1|MIT"),
        ("SPDX-License-Identifier: CC-BY-SA-4.0", "CC-BY-SA-4.0"),
        ("SPDX-License-Identifier: BSD-3-Clause", "BSD-clauses-3"),
        ("Released under the MIT\n\nLicense.", ""),
        ("Released under the MIT License, or not.", ""),
    ]
    assert scan(spark, *[t for t, _ in want]) == [(name, 0) for _, name in want]


def test_licences_of_no_rows(spark):
    assert scan(spark) == []


# Decontamination

ITEM = "In the spring Maria Lopez bought 12 kg of apples and 7 kg of pears for 31 dollars at the market near the old harbour"


def leaks(spark, texts, items=((1, ITEM),)):
    docs = brute.frame(spark, list(enumerate(texts)))
    found = decontamination.matches(docs, spark.createDataFrame(list(items), "item_id long, text string"))
    return {(r["doc_id"], r["item_id"]): r["n_changed"] for r in found.collect()}


def test_leaks(spark):
    other = ITEM.replace("Maria Lopez", "Peter Novak").replace("12", "15").replace("31", "44")
    texts = [
        f"Some words before it. {ITEM}, and after.",
        f"so {other} indeed",
        ITEM.upper(),
        None,
        "",
        "In the spring they bought 12 kg of other things for other people at another place",
        "x " * 30 + ITEM + " y" * 30,
    ]
    got = leaks(spark, texts)
    assert {d for d, _ in got} >= {0, 1, 6} and not {d for d, _ in got} & {3, 4, 5}
    assert got[(0, 1)] == 0 and got[(1, 1)] == 4


def test_slots_must_correspond(spark):
    item = "then Anna gave 5 books to Boris and 5 pens to Clara while Anna kept 9 coins in the small green box"
    same = item.replace("5", "8")
    mixed = item.replace("5 books", "8 books").replace("5 pens", "3 pens").replace("9 coins", "2 coins").replace("Boris", "Dora").replace("Anna kept", "Eva kept")
    got = leaks(spark, [same, mixed], [(1, item)])
    assert set(got) == {(0, 1)}


def test_changed_numbers_in_a_literal_copy_are_found(spark):
    """One of two equal numbers changed, and numbers that are equal by chance changed to different ones."""
    boxes = "then take 2 of the 2 boxes that were left in the hall and put all of them beside the old wooden door"
    books = "then Anna gave 5 books to Boris and 5 pens to Clara while Anna kept 9 coins in the small green box"
    texts = ["so " + boxes.replace("2 boxes", "3 boxes"), books.replace("5 books", "8 books").replace("5 pens", "3 pens"), boxes.replace("2 boxes", "3 boxes").replace("hall", "barn")]
    assert set(leaks(spark, texts, [(1, boxes), (2, books)])) == {(0, 1), (1, 2), (2, 1)}
    # Half of the words with numbers that do not correspond is chance likeness.
    assert not leaks(spark, [" ".join(boxes.replace("2 boxes", "3 boxes").split()[:12])], [(1, boxes)])


@pytest.mark.parametrize("text,words", [("中文字符" * 250_000, 1), (",".join(map(str, range(150_000))), 1), ("a1B2/+" * 160_000, 1), ("1" * 1_000_000, 1), ("Aa " * 300_000, 300_000)])
def test_long_words_take_no_longer(spark, text, words):
    """A million characters, with and without blanks, numbers and names, in seconds and without deep recursion."""
    began = time.monotonic()
    df = spark.createDataFrame([(text,)], "text string").select(decontamination.template(decontamination.marked(F.col("text"))).alias("t"))
    assert df.select(F.size(decontamination.word_list(F.col("t")))).first()[0] == words
    assert time.monotonic() - began < 60


def test_templates_are_as_their_rules_say(spark):
    """Against the rules in plain patterns: names in rows, numbers with separators, words with several values."""
    import random

    name, blank = decontamination.NAME, r"[^ \t\n\x0B\f\r]"
    rng = random.Random(5)
    parts = ["Anna", "BOB", "Eva's", "O", "éÉa", "Ärger", "12", "3.5", "1,000:2/3", "7kg", "km", "kg", "a1B2/+", "x\x01y\x02z", "\x03", "so", ",", ")", ";", "中文", "۳", "𝐀b"]
    texts = ["", " ", "\n a"] + ["".join(rng.choice(parts) + rng.choice([" ", " ", " ", "", "\n", "\t "]) for _ in range(12)) for _ in range(400)]

    def marked(text):
        for _ in range(2):
            text = F.regexp_replace(text, r"([\p{Ll}\p{Nd},;:)] )(\p{Lu}\p{L}+)", "$1" + name + "$2")
        text = F.regexp_replace(text, r"(?<![0-9])(?<![0-9][.,:/])([0-9])", decontamination.NUMBER + "$1")
        text = F.lower(F.regexp_replace(text, r"[^\p{L}\p{Nd}\x01-\x03 \t\n\x0B\f\r]+", ""))
        return F.regexp_replace(text, r"(\x02[^ \x02\t\n\x0B\f\r]* )(" + decontamination.UNITS + r")([ \t\n\x0B\f\r]|$)", "$1" + decontamination.UNIT + "$2$3")

    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(marked(F.col("text")).alias("want"), decontamination.marked(F.col("text")).alias("got"))
    words = F.filter(F.split(F.regexp_replace("want", f"{blank}*([\\x01-\\x03]){blank}*", "$1"), decontamination.BLANK + "+"), lambda w: w != "")
    rows = rows.select("want", "got", words.alias("words"), decontamination.word_list(decontamination.template(F.col("got"))).alias("got_words")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]
    assert [r["got_words"] for r in rows] == [r["words"] for r in rows]
    assert sum(name in r["want"] for r in rows) > 50


def test_windows_are_keyed_in_generated_code(spark, capsys):
    """No step of the scan of the documents is interpreted, and texts are made into words once."""
    docs = brute.frame(spark, [(1, ITEM), (2, ""), (3, "one two three")]).select("doc_id", "text")
    decontamination.places(docs, [3], [4]).explain()
    plan = capsys.readouterr().out
    assert plan.count("*(1) Generate") == 2 and plan.count("Generate") == 2
    assert plan.count("xxhash64(text") == 1 and plan.count("lower(") == 1
    n = len(ITEM.split())
    assert decontamination.places(docs, [], []).count() == n - 7
    assert decontamination.places(docs, [3], [4]).count() == (n - 7) + (n - 2) + (n - 3) + 1


RIVER = "Which river flows through the capital city of France"


def test_items_are_found_at_any_place(spark):
    """Short runs, whatever the number of words before them, also when the first word is read as a name."""
    nine, eight = RIVER, RIVER.replace(" capital", "")
    texts = [f"{'so ' * k}{item} {'and ' * (k % 3)}" for item in (nine, eight) for k in range(9)]
    got = leaks(spark, texts, [(1, nine), (2, eight)])
    assert set(got) == {(d, 1 + d // 9) for d in range(18)}


def test_broken_runs_are_found(spark):
    """A name of one word that becomes two leaves runs of eight and seven words."""
    item = "a very old man from that town met Anna near the small harbour of our island"
    got = leaks(spark, ["so " * k + item.replace("Anna", "Anna Maria") for k in range(8)], [(1, item)])
    assert {d for d, _ in got} == set(range(8))


def test_short_items(spark):
    items = [(1, "What is the capital of Peru?"), (2, "12 + 30 = 42"), (3, "Tom has 3 red apples and gave 2 away"), (4, "Tom Lee 4 5 Kim Ray 6 7 Al Bo 8 9"), (5, "..."), (6, "")]
    texts = ["so " * k + text for text in ("what is the capital of Peru", "12 + 30 = 42", "Bob has 8 red apples and gave 5 away", "the Tom Lee 4 5 Kim Ray 6 7 Al Bo 8 9 end") for k in range(4)]
    clean = ["what is the capital then of Peru", "13 + 30 = 43", "Bob has 8 green apples and gave 5 away", "the Tom Lee 4 5 Kim Ray 6 7 Al Bo 8 8 end", "what is the capital of Chile"]
    got = leaks(spark, texts + clean, items)
    # The last clean text has the first item's template, of which only four words tell.
    assert {d: i for d, i in got if d < 16} == {d: 1 + d // 4 for d in range(16)}
    assert not {d for d, _ in got if d >= 16}


def test_leaks_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert set(leaks(spark, [ITEM, "nothing of it"])) == {(0, 1)}


def test_decontaminated_rows(spark):
    docs = brute.frame(spark, [*brute.awkward(), (None, ITEM), (900, ITEM), (900, "clean words only")])
    benchmark = spark.createDataFrame([(1, ITEM), (2, None), (None, "short"), (1, ITEM)], "item_id long, text string")
    docs = docs.withColumnRenamed("key", "text_key").withColumnRenamed("kept", "item_id")
    kept = decontamination.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id >= 900").collect()) == [(900, "clean words only")]
    assert kept.count() == docs.count() - 2
    assert decontamination.decontaminated(docs, benchmark.limit(0)).count() == docs.count()
    assert decontamination.decontaminated(docs.limit(0), benchmark).count() == 0


def test_whole_items_are_found(spark):
    """Every item that stands whole in a document of the given table is reported, and nothing that does not."""
    import re

    sf = "/root/testdata/sf0.01"
    plain = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    docs = {r["doc_id"]: plain(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: plain(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op8_decontamination"](spark, sf).collect()}
    assert {(d, i) for d, t in docs.items() for i, x in items.items() if x in t} <= got
    for d, i in got:
        known = set(items[i].split())
        assert sum(w in known for w in docs[d].split()) >= 8


# URL filters


def judge(spark, pages, rules=None, edges=None):
    rows = spark.createDataFrame(pages, "page_id long, url string, html string, rule string, node string") if pages and len(pages[0]) == 5 else spark.createDataFrame(pages, "page_id long, url string, html string")
    rules = spark.createDataFrame(queries.URL_RULES if rules is None else rules, RULES)
    found = url_filters.judged(rows, rules, edges)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["reason"]) for r in found.collect()}


def test_rules(spark):
    got = judge(
        spark,
        [
            (1, "http://WWW.Example.COM/en/x?q#f", None),
            (2, "https://a.example.com/en/", None),
            (3, "http://example.com/EN/", None),
            (4, None, None),
            (5, "no scheme", None),
            (6, "http://badexample.com/en/", None),
            (7, "http://x.net/fr/1", ""),
            (8, "http://x.org?/es/", None),
            (9, "http://Ünder.org/a b", None),
            (10, "://x.net/es/", None),
        ],
    )
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow", "rule")
    assert got[2] == ("a.example.com", "/en/", "example.com/en/", "block", "rule")
    assert got[3] == ("example.com", "/EN/", "com/", "allow", "rule")
    assert got[4] == got[5] == ("", "", None, "allow", "default")
    assert got[6][2:4] == ("com/", "allow")
    assert got[7][2:4] == ("net/fr/", "block")
    assert got[8] == ("x.org", "", None, "allow", "default")
    assert got[9][:2] == ("Ünder.org".replace("Ü", "Ü"), "/a b")
    assert got[10][2:4] == ("net/es/", "block")


def canonical(to):
    return f'<html><head><LINK href="{to}" rel="canonical"></head></html>'


def refresh(to):
    return f"<meta http-equiv='refresh' content='0; url={to}'>"


def test_aliases(spark):
    pages = [
        (1, "http://a.org/1", canonical("https://b.net/fr/9#x")),  # blocked by its canonical page
        (2, "http://c.org/2", refresh("http://a.org/1")),  # and so is what leads there
        (3, "http://d.org/3", refresh("http://x.net/es/1")),
        (4, "http://d.org/4", canonical("http://d.org/3")),
        (5, "http://e.com/5", canonical("http://d.org/4")),  # an explicit allow comes first for all of them
        (6, "http://f.org/dir/6", canonical("7")),
        (7, "http://f.org/dir/7", canonical("//b.net/fr/z")),
        (8, "http://g.org/8", canonical("http://g.org/8")),
        (9, "http://h.org/9", canonical("/local")),
    ]
    got = {k: v[3:] for k, v in judge(spark, pages).items()}
    assert got[1] == got[2] == ("block", "alias")
    assert got[3] == got[4] == ("allow", "alias")
    assert got[5] == ("allow", "rule")
    assert got[6] == got[7] == ("block", "alias")
    assert got[8] == got[9] == ("allow", "default")


def test_aliases_as_sql(spark):
    pages = [(1, "http://a.org/1", canonical("https://b.net/fr/9#x")), (2, "http://c.org/2", refresh("http://a.org/1")), (3, "http://d.org/3?p=1", refresh("?p=2")), (4, "http://d.org/3?p=2", canonical("//x.net/es/")), (5, "http://e.com/5", canonical("http://d.org/3?p=1")), (6, "http://f.org", canonical("x&amp;y")), (7, None, canonical("/q")), (8, "http://g.org/a/b", canonical("c"))]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    duck.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    want = {r[0]: r[1:] for r in duck.execute(f"SELECT page_id, host, path, rule, verdict FROM ({queries.ORACLE['op10_url_filters']})").fetchall()}
    assert {k: v[:4] for k, v in judge(spark, pages).items()} == want
    assert want[3][3] == want[4][3] == "allow" and want[2][3] == "block"


def test_more_edges_and_clashing_columns(spark):
    edges = spark.createDataFrame([("a.org/1", "x.net/es/"), ("a.org/1", "a.org/1")], "a string, b string")
    got = judge(spark, [(1, "http://a.org/1", None, "r", "n"), (1, "http://a.org/1", None, "r", "n")], edges=edges)
    assert got[1][3:] == ("block", "alias")


def test_no_pages_or_rules(spark):
    assert judge(spark, []) == {}
    assert judge(spark, [(1, "http://x.net/es/", None)], rules=[])[1][3] == "allow"
    tie = [("x.org", "/a", "allow"), ("x.org", "/a", "block")]
    assert judge(spark, [(1, "http://x.org/ab", None)], rules=tie)[1][3] == "block"
