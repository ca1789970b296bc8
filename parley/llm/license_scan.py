"""Licence scans by sentence rules, in DataFrame functions only.

A text is normalised as a whole (lower case, marks to blanks, points kept only within version numbers) and cut into
pieces at line ends and after marks. A known sentence, version numbers aside, is found where it fills one or more
neighbouring pieces, so that line breaks, comment signs at line starts and marks within it do not matter; only a blank
line ends it. It becomes its identifier; the identifiers of a text, in their order, are matched against ordered rules. A
rule takes the identifiers it matches with it, so that a whole licence text is one licence and later rules see only what
is left. Everything is a narrow expression on one row: no shuffle.

The SQL knows SENTENCES, NAMES and RULES, each sentence within one piece; it says the same of texts whose licences are lines
of their own in these forms.

Defined results: a null or empty text has no sentences and no licence; identifiers that no rule takes are counted as loose;
rows with equal or null ids are judged one by one; a licence found more than once in a text is named once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERSION = "[0-9]+(_[0-9]+)*"

# Sentences of well-known licences, normalised; # stands for a version number.
SENTENCES: dict[str, str] = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "you may not use this file except in compliance with the license": "apache-use",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version # of the license or at your option any later version": "gpl-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-see",
    "this source code form is subject to the terms of the mozilla public license v #": "mpl-named",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
}
# How a text names its licence, and names with their identifiers.
OPENINGS = ["licensed under", "released under", "distributed under", "available under", "this work is licensed under", "this software is licensed under", "this project is licensed under", "this program is licensed under"]
NAMES: dict[str, str] = {
    "the mit license": "mit-named",
    "the apache license version #": "apache-named",
    "the apache license #": "apache-named",
    "the gnu general public license version #": "gpl-named",
    "the gnu lesser general public license version #": "lgpl-named",
    "the gnu affero general public license version #": "agpl-named",
    "the mozilla public license version #": "mpl-named",
    "the bsd # clause license": "bsd-named",
    "cc by #": "cc-by",
    "cc by sa #": "cc-by-sa",
    "cc by nc #": "cc-by-nc",
    "cc by nd #": "cc-by-nd",
    "cc by nc sa #": "cc-by-nc-sa",
    "cc by nc nd #": "cc-by-nc-nd",
}
KNOWN = SENTENCES | {f"{opening} {name}": identifier for opening in OPENINGS for name, identifier in NAMES.items()}


def _one(identifier: str) -> str:
    return f",{identifier}@([0-9.]*)"


def _rest(*identifiers: str) -> str:
    return "".join(f",{i}@[0-9.]*" for i in identifiers)


# The rules in their order; a pattern over identifiers with versions, whose first group is the version in the name.
RULES: list[tuple[str, str]] = [
    (_one("apache-named") + _rest("apache-use", "apache-copy") + f"({_rest('apache-warranty')})?({_rest('apache-see')})?", "Apache-"),
    (_one("mit-grant") + _rest("mit-notice") + f"({_rest('mit-warranty')})?({_rest('mit-liability')})?", "MIT"),
    (_one("bsd-grant") + _rest("bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
    (_one("bsd-grant") + _rest("bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (_one("gpl-later") + f"({_rest('gpl-warranty')})?({_rest('gpl-see')})?", "GPL-or-later-"),
    (_one("apache-named"), "Apache-"),
    (_one("mit-named"), "MIT"),
    (_one("gpl-named"), "GPL-"),
    (_one("lgpl-named"), "LGPL-"),
    (_one("agpl-named"), "AGPL-"),
    (_one("mpl-named"), "MPL-"),
    (_one("bsd-named"), "BSD-clauses-"),
    (_one("cc-by-nc-nd"), "CC-BY-NC-ND-"),
    (_one("cc-by-nc-sa"), "CC-BY-NC-SA-"),
    (_one("cc-by-nc"), "CC-BY-NC-"),
    (_one("cc-by-nd"), "CC-BY-ND-"),
    (_one("cc-by-sa"), "CC-BY-SA-"),
    (_one("cc-by"), "CC-BY-"),
    (_one("unlicense"), "Unlicense"),
]

# Further sentences of official texts as they are written; <> stands for up to 12 words, # for a version number.
OFFICIAL: dict[str, str] = {
    "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software.": "mit-notice",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution, and": "bsd-binary",
    "Neither the name of <> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "bsd-endorse",
    "Neither the name of <> nor the names of <> contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "bsd-endorse",
    "THIS SOFTWARE IS PROVIDED BY <> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.": "bsd-warranty",
    "IN NO EVENT SHALL <> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.": "bsd-liability",
    "Apache License Version #, January #": "apache-named",
    "GNU GENERAL PUBLIC LICENSE Version #, # June #": "gpl-named",
    "GNU LESSER GENERAL PUBLIC LICENSE Version #, # June #": "lgpl-named",
    "GNU LESSER GENERAL PUBLIC LICENSE Version #, February #": "lgpl-named",
    "GNU AFFERO GENERAL PUBLIC LICENSE Version #, # November #": "agpl-named",
    "Mozilla Public License Version #": "mpl-named",
    "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/#/": "mpl-obtain",
    "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/#/": "mpl-obtain",
    "See the GNU Lesser General Public License for more details.": "lgpl-see",
    "See the GNU Affero General Public License for more details.": "agpl-see",
}
THINGS = ["program", "file", "library", "software"]
for _kind, _family in (("GNU General Public License", "gpl"), ("GNU Lesser General Public License", "lgpl"), ("GNU Affero General Public License", "agpl")):
    for _thing in (f"This {t}" for t in THINGS):
        for _version in ("version # of the License, or (at your option) any later version", "version #, or (at your option) any later version"):
            OFFICIAL[f"{_thing} is free software; you can redistribute it and/or modify it under the terms of the {_kind} as published by the Free Software Foundation; either {_version}."] = f"{_family}-later"
for _thing in THINGS:
    OFFICIAL[f"This {_thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."] = "gpl-warranty"
# Further openings and names, and what may follow a name in brackets.
MORE_OPENINGS = [f"this {thing} is {how} under" for thing in ["file", "code", *THINGS, "project", "work"] for how in ("licensed", "released", "distributed", "available", "made available")]
MORE_NAMES: dict[str, str] = {"mit license": "mit-named", "apache license version #": "apache-named", "apache license #": "apache-named", "mozilla public license version #": "mpl-named", "the mozilla public license v #": "mpl-named", "bsd # clause license": "bsd-named"}
BRACKETED: dict[str, list[str]] = {"mit-named": ["mit"], "apache-named": ["apache #"], "gpl-named": ["gpl #", "gplv#", "gpl v#", "gnu gpl"], "lgpl-named": ["lgpl #", "lgplv#", "lgpl v#", "gnu lgpl"], "agpl-named": ["agpl #", "agplv#", "agpl v#", "gnu agpl"], "mpl-named": ["mpl #", "mpl"], "bsd-named": ["bsd # clause"]}
# Names after SPDX-License-Identifier.
SPDX = "spdx license identifier"
SPDX_NAMES: dict[str, str] = {"mit": "mit-named", "apache #": "apache-named", "mpl #": "mpl-named", "bsd # clause": "bsd-named", "unlicense": "unlicense"}
SPDX_NAMES |= {name: identifier for name, identifier in NAMES.items() if name.startswith("cc ")}
SPDX_NAMES |= {f"{family} #{tail}": f"{family}-{'later' if tail == ' or later' else 'named'}" for family in ("gpl", "lgpl", "agpl") for tail in ("", " only", " or later")}

# The rules of SQL, the longer texts of OFFICIAL put before them.
MORE_RULES: list[tuple[str, str]] = [
    (_one("bsd-grant") + _rest("bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty") + f"({_rest('bsd-liability')})?", "BSD-3-Clause"),
    (_one("bsd-grant") + _rest("bsd-source", "bsd-binary", "bsd-warranty") + f"({_rest('bsd-liability')})?", "BSD-2-Clause"),
    (_one("lgpl-later") + f"({_rest('gpl-warranty')})?({_rest('lgpl-see')})?", "LGPL-or-later-"),
    (_one("agpl-later") + f"({_rest('gpl-warranty')})?({_rest('agpl-see')})?", "AGPL-or-later-"),
    (_one("mpl-named") + _rest("mpl-obtain"), "MPL-"),
]
WORDS = "[a-z0-9_]+(?:[ \n][a-z0-9_]+){0,11}?"


def pieces(text: Column) -> Column:
    """The normalised text, a piece on each line, a line break before and after; blank lines stay."""
    text = F.translate(F.concat(F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("\n")), UPPER, LOWER)
    text = F.regexp_replace(text, "([.!?;:])[ \t\r]++(?!\n)", "$1\n")
    text = F.regexp_replace(text, "(gpl-[0-9.]+)[+]", "$1-or-later")
    for _ in range(2):  # the second time for 1.2.3
        text = F.regexp_replace(text, "([0-9])[.]([0-9])", "$1_$2")
    text = F.regexp_replace(text, "[^a-z0-9_\n]+", " ")
    return F.regexp_replace(text, " ?\n ?", "\n")


def _normalised(sentence: str) -> str:
    """What pieces makes of a sentence, on one line; # and <> stay."""
    return re.sub("[^a-z0-9_#<>]+", " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    """All known sentences, normalised, and their identifiers."""
    out = {_normalised(s): i for s, i in OFFICIAL.items()} | KNOWN
    out |= {f"{opening} {name}": i for opening in [*OPENINGS, *MORE_OPENINGS] for name, i in (NAMES | MORE_NAMES).items()}
    named = {s: i for s, i in out.items() if i in BRACKETED}
    out |= {f"{s} {end}": i for s, i in named.items() for end in ["the license", *BRACKETED[i]]}
    return out | {f"{SPDX} {name}": i for name, i in SPDX_NAMES.items()}


def _pattern(sentence: str) -> str:
    """A pattern for a normalised sentence over pieces."""
    return sentence.replace(" ", "[ \n]").replace("#", "[0-9]+(?:_[0-9]+)*").replace("<>", WORDS)


def _any(sentences: Iterable[str]) -> str:
    """A pattern for any of the sentences, longer ones first, by common first words: a line is held against few."""
    branches: dict[str, list[str]] = {}
    for s in sorted(sentences, key=lambda s: (-len(s), s)):
        first, _, rest = s.partition(" ")
        branches.setdefault(first, []).append(rest)
    return "|".join(f"{_pattern(first)}(?:{'|'.join(_pattern(f' {r}') if r else '' for r in rest)})" for first, rest in branches.items())


def _naming(name: str) -> Callable[[Column], Column]:
    return lambda version: F.concat(F.lit(name), version) if name.endswith("-") else F.lit(name)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (pieces that are not blank), identifiers (in order, comma before each, @ and the version), licenses (sorted, | between) and n_loose of every row."""
    sentences = known_sentences()
    known = F.create_map(*[F.lit(x) for pair in sentences.items() if "<>" not in pair[0] for x in pair])
    pattern = f"\\n(?:{_pattern(SPDX)}[ \\n][a-z0-9_ ]+|{_any(s for s in sentences if not s.startswith(SPDX))})(?=\\n)"
    open_ = [(f"^{_pattern(s)}$", i) for s, i in sentences.items() if "<>" in s]

    cut = docs.select("doc_id", pieces(F.col("text").cast("string")).alias("pieces"))
    hits = F.transform(F.regexp_extract_all("pieces", F.lit(pattern), F.lit(0)), lambda s: F.translate(F.substring(s, 2, 1 << 30), "\n", " "))

    def alone(s: Column) -> Column:
        """Each licence of an SPDX expression as a sentence of its own."""
        names = F.split(F.regexp_replace(s, f"^{SPDX} ", ""), " (?:and|or) (?!later)")
        return F.when(s.startswith(SPDX), F.transform(names, lambda n: F.concat(F.lit(f"{SPDX} "), F.regexp_replace(n, " with .*", "")))).otherwise(F.array(s))

    def identifier(s: Column) -> Column:
        version = F.translate(F.regexp_extract(s, VERSION, 0), "_", ".")
        closed = F.concat(F.element_at(known, F.regexp_replace(s, VERSION, "#")), F.lit("@"), version)
        # The words that <> stands for may hold numbers: no version.
        return F.concat(F.lit(","), F.coalesce(closed, *[F.when(s.rlike(p), F.lit(f"{i}@")) for p, i in open_]))

    found = F.transform(F.flatten(F.transform(hits, alone)), identifier)
    n_sentences = F.size(F.filter(F.split("pieces", "\n"), lambda s: s != ""))
    out = cut.select("doc_id", n_sentences.alias("n_sentences"), F.array_join(found, "").alias("identifiers"))
    left, names = F.col("identifiers"), F.array().cast("array<string>")
    steps = out.withColumn("left", left).withColumn("names", names)
    for pattern, name in MORE_RULES + RULES:
        hits = F.transform(F.regexp_extract_all("left", F.lit(pattern), 1), _naming(name))
        steps = steps.select("doc_id", "n_sentences", "identifiers", F.regexp_replace("left", pattern, ",").alias("left"), F.concat("names", hits).alias("names"))
    loose = F.length("left") - F.length(F.translate("left", "@", ""))
    return steps.select("doc_id", "n_sentences", "identifiers", F.array_join(F.array_sort(F.array_distinct("names")), "|").alias("licenses"), loose.alias("n_loose"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The same as DuckDB SQL."""
    text = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    text = f"regexp_replace({text}, '([.!?;:])[ \t\r]+', '\\1' || chr(10), 'g')"
    for _ in range(2):
        text = f"regexp_replace({text}, '([0-9])[.]([0-9])', '\\1_\\2', 'g')"
    text = f"regexp_replace({text}, '[^a-z0-9_\\n]+', ' ', 'g')"
    keys = ", ".join(_quoted(k) for k in KNOWN)
    values = ", ".join(_quoted(v) for v in KNOWN.values())
    steps = []
    for k, (pattern, name) in enumerate(RULES):
        hit = f"{_quoted(name)} || v" if name.endswith("-") else _quoted(name)
        steps.append(
            f"s{k + 1} AS (SELECT doc_id, n_sentences, identifiers, regexp_replace(rest, '{pattern}', ',', 'g') AS rest,"
            f" list_concat(names, list_transform(regexp_extract_all(rest, '{pattern}', 1), lambda v: {hit})) AS names FROM s{k})"
        )
    return f"""
WITH known AS (SELECT map([{keys}], [{values}]) AS m),
cut AS (SELECT doc_id, list_filter(list_transform(string_split({text}, chr(10)), lambda s: trim(s)), lambda s: s <> '') AS sentences FROM documents),
named AS (SELECT doc_id, len(sentences) AS n_sentences, list_filter(list_transform(sentences, lambda s:
    ',' || m[regexp_replace(s, '{VERSION}', '#', 'g')] || '@' || replace(regexp_extract(s, '{VERSION}', 0), '_', '.')), lambda x: x IS NOT NULL) AS found FROM cut, known),
s0 AS (SELECT doc_id, n_sentences, array_to_string(found, '') AS identifiers, array_to_string(found, '') AS rest, CAST([] AS varchar[]) AS names FROM named),
{", ".join(steps)}
SELECT doc_id, CAST(n_sentences AS integer) AS n_sentences, identifiers, array_to_string(list_sort(list_distinct(names)), '|') AS licenses,
  CAST(length(rest) - length(replace(rest, '@', '')) AS integer) AS n_loose FROM s{len(RULES)}"""
