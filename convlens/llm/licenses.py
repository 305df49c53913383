"""License scans by canonical digests.

Method: a text is brought into a canonical form (case, copyright lines, punctuation, equivalent
spellings), and the digest of the entire form is joined with the digests of known licences, brought
into the same form. Each line of a text is looked up likewise among the known one-line notices. All
of it is DataFrame functions; the known table is small and its size is a matter of its rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that mean the same, each with the one it is replaced by.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "behaviour": "behavior", "catalogue": "catalog",
    "centre": "center", "copyrightowner": "copyrightholder", "emphasised": "emphasized", "favour": "favor",
    "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "grey": "gray", "https": "http",
    "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "learnt": "learned",
    "licence": "license", "licenced": "licensed", "licencing": "licensing", "licences": "licenses",
    "merchantable": "merchantable", "modelling": "modeling", "organisation": "organization",
    "organisations": "organizations", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "sublicence": "sublicense", "utilisation": "utilization",
    "whilst": "while", "wilful": "willful",
}

#: Names of licences, as notices write them.
NAMES = {
    "MIT": ["MIT License", "MIT licence", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPLv3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL v3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPLv3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License"],
    "ISC": ["ISC License"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
}
#: Notices that name a licence; ``{}`` is its name.
PHRASES = [
    "{}",
    "{} applies",
    "license: {}",
    "licensed under {}",
    "licensed under the {}",
    "released under {}",
    "released under the {}",
    "distributed under the {}",
    "published under the {}",
    "available under the {}",
    "this work is licensed under {}",
    "this work is licensed under the {}",
    "this work is licensed under a {}",
    "this software is licensed under the {}",
    "this program is licensed under the {}",
    "this project is licensed under the {}",
    "licensed under the terms of the {}",
]

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
    " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL"
    " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
    " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN"
    " ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF"
    " THIS SOFTWARE."
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
    " distribution.\n"
)
_BSD_NO_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission.\n"
)
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF"
    " THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Entire licence texts, without the copyright lines that differ.
TEXTS = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the"
    " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
    " persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice"
    " and this permission notice shall be included in all copies or substantial portions of the Software.\n\n" + _AS_IS,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_AS_IS,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted.\n\n" + _ISC_AS_IS,
    "BSD-2-Clause": _BSD_TERMS + _BSD_AS_IS,
    "BSD-3-Clause": _BSD_TERMS + _BSD_NO_NAMES + _BSD_AS_IS,
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
    " compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\n"
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
    " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
    " specific language governing permissions and limitations under the License.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
    " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
    " option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
    " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public"
    " License for more details.\n\nYou should have received a copy of the GNU General Public License along with this program."
    " If not, see <https://www.gnu.org/licenses/>.",
}

#: Further titles that entire texts customarily have; the names of notices are titles too.
TITLES = {
    "MIT": ["MIT", "MIT License (MIT)", "The MIT License (MIT)"],
    "ISC": ["ISC", "ISC License (ISC)"],
    "0BSD": ["0BSD", "BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License"],
    "BSD-2-Clause": ["BSD-2-Clause", "BSD License", "2-Clause BSD License", "FreeBSD License"],
    "BSD-3-Clause": ["BSD-3-Clause", "BSD License", "3-Clause BSD License", "Revised BSD License"],
}
#: Digests of the canonical forms of longer entire texts, as their publishers write them
#: and in the usual shorter forms (without what follows the terms, or without the first title).
DIGESTS = {
    "Apache-2.0": [
        "4bc3c949c895ead14c0dc8c6e33fd6ed118359acaad7c084c4d563cd526a878d",
        "108490d21e2d3edc9128233e48fabc169818d0c7c5f0bbdd58231a367d2d6c87",
        "045649cdaf85384ba827242062f2f3b36409835c98d297e25177cb1faf7c2847",
    ],
    "GPL-2.0": [
        "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
        "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
    ],
    "GPL-3.0": [
        "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a",
        "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636",
    ],
    "LGPL-2.1": [
        "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
        "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",
    ],
    "LGPL-3.0": [
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ],
    "MPL-2.0": [
        "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9",
    ],
    "CC0-1.0": [
        "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
        "a142ae38742c8c4c35f5fa19e0a40ebfa60fc38535daf9c570ca3d7e012e1e32",
    ],
    "CC-BY-SA-4.0": [
        "4dd2d8faa991a43111f73718974d1a9133ba1453cd76d174da75d163e35fa974",
    ],
    "Unlicense": [
        "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd",
        "41f84c538b3bc6dcfe6afaab48f6e16c34fd1b11b2c6be7db47873ba3bce291a",
        "6077a8a20d606206e486caec85a30b2545701071b1e08d12c37fb9a0e490d1bf",
    ],
}

#: What lines that name a holder without a year begin with; the words after "copyright" that stand in NO_HOLDER
#: are those of wrapped sentences.
HOLDER = r"[ \t/*#;!%>-]*copyright(?:[ \t]+by)?[ \t:]+"
NO_HOLDER = r"(?:notices?|holders?|owners?|laws?|licen[sc]es?|interest|and|or|in|on|to|of|as|is|the above)\b"
#: Such lines, anywhere in a lower-case text.
HOLDER_LINE = rf"(?md)^{HOLDER}(?!{NO_HOLDER})[^\s]+(?:[ \t]+[^\s]+){{0,6}}[ \t\r]*$"
#: Lines that name holders and years, with marks of comments before them; A-Z are lower case by then.
#: A line that merely begins with the word is part of a wrapped sentence.
COPYRIGHT_LINE = r"(?m)^[ \t/*#;!%>-]*(copyright[^\n]*(\(c\)|©|\b(19|20)\d\d\b)|\(c\)|©|all rights reserved)[^\n]*$"
#: What separates words of the canonical form.
BETWEEN = r"[^\p{L}\p{N}]+"


def lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text.cast("string"), F.lit("")))


def spelled(between: Column) -> Column:
    """Words between single spaces, in the spelling that stands for all; ends are trimmed."""
    table = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    words = F.transform(F.split(between, " "), lambda w: F.coalesce(F.get(F.array(table[w]), F.lit(0)), w))
    return F.trim(F.array_join(words, " "))


def _contains(text: Column, parts: Iterable[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(p)) for p in parts], F.lit(False))


def _form(low: Column) -> Column:
    """The canonical form of a lower-case text; copyright lines are looked for where there can be one."""
    bare = F.when(_contains(low, ["copyright", "(c)", "©", "all rights reserved"]), F.regexp_replace(low, COPYRIGHT_LINE, "")).otherwise(low)
    return spelled(F.regexp_replace(bare, BETWEEN, " "))


def canonical(text: Column) -> Column:
    """The canonical form of an entire text; NULL counts as empty."""
    return _form(lowered(text))


def _digest(form: Column) -> Column:
    return F.when(form != "", F.sha2(form, 256))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; NULL if nothing is left of the text."""
    return _digest(canonical(text))


def known_texts(spark: SparkSession, texts: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """``(digest, license)`` of entire licence texts; of equal digests the first name counts.

    ``texts`` is a dict or a table ``(license, text)``, which may have several texts of a licence.
    """
    if isinstance(texts, DataFrame):
        table = texts.select(F.col("license").cast("string").alias("license"), "text")
    else:
        rows = [(name, text) for name, text in (TEXTS if texts is None else texts).items()]
        table = spark.createDataFrame(rows, "license string, text string")
    return table.select(digest(F.col("text")).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def titled_texts() -> list[tuple[str, str]]:
    """``(license, text)`` of the known texts, bare and under each of their titles."""
    rows = list(TEXTS.items())
    for key, more in TITLES.items():
        for title in [*NAMES.get(key, []), *more]:
            rows += [(key, f"{title}\n\n{TEXTS[key]}"), (key, f"The {title}\n\n{TEXTS[key]}")]
    return rows


def known_licenses(spark: SparkSession) -> DataFrame:
    """``(digest, license)`` of all texts known here."""
    titled = known_texts(spark, spark.createDataFrame(titled_texts(), "license string, text string"))
    longer = spark.createDataFrame([(d, key) for key, own in DIGESTS.items() for d in own], "digest string, license string")
    return titled.unionByName(longer).groupBy("digest").agg(F.min("license").alias("license"))


def notices() -> dict[str, str]:
    """One-line notices and the licence that each names, made of names and phrases."""
    found = {f"SPDX-License-Identifier: {key}": key for key in [*NAMES, *TEXTS]}
    for key, names in NAMES.items():
        for name in names:
            for phrase in PHRASES:
                found.setdefault(phrase.format(name), key)
    return found


def plain_canonical(line: str) -> str:
    """The canonical form of a notice: letters and digits of the ASCII range only."""
    import re

    words = re.sub(r"[^a-z0-9]+", " ", line.lower()).strip().split(" ")
    return " ".join(SPELLINGS.get(w, w) for w in words)


def needles(lines: Iterable[str]) -> list[str]:
    """Lower-case texts of which every line that is one of these canonical notices contains one.

    Words are picked until each notice has one; a notice with all words of another one needs no word
    of its own. A word counts in all spellings that it stands for.
    """
    bags: list[frozenset[str]] = []
    for bag in sorted({frozenset(line.split()) for line in lines}, key=len):
        if not any(less <= bag for less in bags):
            bags.append(bag)
    words: set[str] = set()
    while bags:
        count = Counter(w for bag in bags for w in bag)
        if not count:
            return [""]  # a notice without words: any line may be it
        best = max(count, key=lambda w: (len(w) > 1, count[w], w))
        words.add(best)
        bags = [bag for bag in bags if best not in bag]
    spellings = words | {a for a, b in SPELLINGS.items() if b in words}
    return sorted(s for s in spellings if not any(o in s for o in spellings - {s}))


def _notice_table(found: dict[str, str] | None) -> dict[str, list[str]]:
    """The canonical lines that name each licence."""
    table = {plain_canonical(line): key for line, key in (notices() if found is None else found).items()}
    by_license: dict[str, list[str]] = {}
    for line, key in sorted(table.items()):
        by_license.setdefault(key, []).append(line)
    return by_license


def _notice_lines(low: Column, by_license: dict[str, list[str]]) -> Column:
    """The canonical forms of a lower-case text's lines that can be a notice.

    Only lines with one of the ``needles`` are brought into the canonical form; no other can match.
    """
    parts = needles(line for own in by_license.values() for line in own)
    lines = F.filter(F.split(low, "\n"), lambda line: _contains(line, parts))
    return F.transform(lines, lambda line: spelled(F.regexp_replace(line, BETWEEN, " ")))


def _named(lines: Column, by_license: dict[str, list[str]]) -> Column:
    named = [F.when(F.arrays_overlap(lines, F.lit(own)), F.lit(key)) for key, own in sorted(by_license.items())]
    return F.when(F.size(lines) > 0, F.array_compact(F.array(*named))).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, known: DataFrame | None = None, found: dict[str, str] | None = None) -> DataFrame:
    """``docs(text, ...)`` with ``digest``, ``license`` (the entire text is that licence, else NULL) and
    ``notices`` (array of the licences that lines of it name, sorted, each once).

    The join is a hash join of every row's digest with the known ones (``known_licenses``, unless a
    table ``known(digest, license)`` is given). A text with lines that name a holder without a year is
    also looked up without them, wherever they stand. ``found`` replaces the known notices.

    Whole texts are read, however long; each is lower-cased and brought into its form once. A text without letters or digits, NULL included, has no digest
    and matches none. Repeated rows are kept; an empty table gives an empty one. Columns of the three names are replaced, others are kept, whatever their names.
    """
    known = known_licenses(docs.sparkSession) if known is None else known
    known = known.groupBy("digest").agg(F.min("license").alias("license"))
    by_license = _notice_table(found)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kept = [(i, c) for i, c in enumerate(docs.columns) if c not in ("digest", "license", "notices")]
    own = [f"c{i}" for i, _ in kept]
    low = F.col("low")
    without = F.when(F.contains(low, F.lit("copyright")) & low.rlike(HOLDER_LINE), _form(F.regexp_replace(low, HOLDER_LINE, "")))
    formed = plain.select(*own, lowered(F.col(f"c{docs.columns.index('text')}")).alias("low")).select(
        *own, _form(low).alias("form"), without.alias("bare"), _notice_lines(low, by_license).alias("lines")
    )
    marked = formed.select(
        *own, _digest(F.col("form")).alias("digest"), _digest(F.col("bare")).alias("bare"), _named(F.col("lines"), by_license).alias("notices")
    )
    entire = known.select(F.col("digest").alias("k1"), F.col("license").alias("l1"))
    bare = known.select(F.col("digest").alias("k2"), F.col("license").alias("l2"))
    rows = marked.join(entire, F.expr("digest = k1"), "left").join(bare, F.expr("bare = k2"), "left")
    return rows.select(
        *[F.col(f"c{i}").alias(c) for i, c in kept], "digest", "notices", F.coalesce("l1", "l2").alias("license")
    )
