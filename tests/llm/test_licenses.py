from __future__ import annotations

import textwrap
from pathlib import Path

from convlens.llm import licenses, oracle
from convlens.llm.queries import op1_license_scan
from tests.compare import differences, duck
from tests.llm import plain

MIT = licenses.TEXTS["MIT"]


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan(docs).collect()
    return [(r.license, r.notices) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_canonical_forms_match(spark):
    loud = "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + MIT.upper().replace(" ", "  \n ")
    commented = "\n".join(" * " + line for line in ["Copyright 1999-2001, A, B", *MIT.split("\n")])
    spelled = MIT.replace("sublicense", "sub" + "licence").replace('"', "\u201c")
    got = scanned(spark, [MIT, loud, commented, spelled, MIT + " extra", MIT[:-40]])
    assert [license for license, _ in got] == ["MIT", "MIT", "MIT", "MIT", None, None]


def test_every_known_text_has_its_own_digest(spark):
    known = {r.digest: r.license for r in licenses.known_texts(spark).collect()}
    assert sorted(known.values()) == sorted(licenses.TEXTS)


def test_titles_and_holders_without_a_year(spark):
    isc, bsd = licenses.TEXTS["ISC"], licenses.TEXTS["BSD-3-Clause"]
    texts = [
        "MIT License\n\nCopyright (c) 2020 X\n\n" + MIT,
        "The MIT License (MIT)\n\nCopyright Jane Doe\n\n" + MIT,
        "Copyright Jane Doe, Inc.\nCopyright: The Authors\nAll rights reserved.\n\n" + bsd,
        "# ISC License\n#\n# Copyright (c) 2001 A\n# Copyright by B\n#\n" + isc,
        "MIT License\n\nCopyright Jane Doe\n\n" + isc,
        "Copyright Jane Doe\n\n" + MIT + " extra",
    ]
    assert [license for license, _ in scanned(spark, texts)] == ["MIT", "MIT", "BSD-3-Clause", "ISC", None, None]
    wrapped = [(key, textwrap.fill(text, width, break_long_words=False)) for key, text in licenses.TEXTS.items() for width in range(30, 110, 7)]
    assert [license for license, _ in scanned(spark, [t for _, t in wrapped])] == [key for key, _ in wrapped]


def test_holders_wherever_they_stand(spark):
    """Any number of holders' lines, in several groups; a long text is read to its end."""
    many = "".join(f"Copyright The Holder Number {i}\n" for i in range(60))
    texts = [
        many + "\n" + MIT,
        "MIT License\n\nCopyright Jane Doe\n\nCopyright John Doe\n\n" + MIT,
        MIT + "\n\nCopyright by The Authors\n",
        "\n" * 5000 + "Copyright Jane Doe\n" * 3000 + MIT,
        many + "\n" + MIT + " extra",
        ("word " * 50 + "\n") * 4000 + "Released under the MIT License.",
    ]
    got = scanned(spark, texts)
    assert [license for license, _ in got] == ["MIT"] * 4 + [None] * 2
    assert got[5] == (None, ["MIT"])


def test_columns_of_any_name_and_texts_of_nothing(spark):
    names = ["_key", "_digest", "low", "form", "bare", "lines", "k1", "l1", "c0"]
    docs = spark.createDataFrame([(1, MIT, *names), (2, None, *names)], ["doc_id", "text", *names])
    got = licenses.scan(docs)
    assert got.columns == ["doc_id", "text", *names, "digest", "notices", "license"]
    rows = {r.doc_id: r for r in got.collect()}
    assert [rows[1][c] for c in names] == names and rows[1].license == "MIT"
    assert (rows[2].digest, rows[2].license, rows[2].notices) == (None, None, [])
    nothing = spark.createDataFrame([(1, None), (2, None)], "doc_id long, text string")
    assert [(r.digest, r.license, r.notices) for r in licenses.scan(nothing).collect()] == [(None, None, [])] * 2


def test_longer_entire_texts(spark):
    """The publishers' texts, where the system has copies of them."""
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0"}
    files |= {"MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    there = {key: path for name, key in files.items() if (path := Path("/usr/share/common-licenses", name)).exists()}
    assert [license for license, _ in scanned(spark, [p.read_text("utf-8") for p in there.values()])] == list(there)


def test_texts_from_a_table(spark):
    texts = spark.createDataFrame([("Own", "You may."), ("Own", "You may too.")], "license string, text string")
    docs = spark.createDataFrame([(1, "you MAY"), (2, "You may, too"), (3, MIT)], "doc_id long, text string")
    got = licenses.scan(docs, licenses.known_texts(spark, texts))
    assert {r.doc_id: r.license for r in got.collect()} == {1: "Own", 2: "Own", 3: None}


def test_notices_of_lines(spark):
    got = scanned(
        spark,
        [
            "story\nReleased under the MIT License.\nmore",
            "Licensed under the APACHE LICENCE, version 2.0!\n  licensed under CC BY-NC 4.0  ",
            "This is about the MIT License and other things",
            "# SPDX-License-Identifier: BSD-3-Clause",
            *plain.ODD_TEXTS,
        ],
    )
    assert [n for _, n in got[:4]] == [["MIT"], ["Apache-2.0", "CC-BY-NC-4.0"], [], ["BSD-3-Clause"]]
    assert all(found == (None, []) for found in got[4:])


def test_every_notice_is_found_as_a_line(spark):
    known = licenses.notices()
    first: dict[str, str] = {}
    for line, key in known.items():
        first[licenses.plain_canonical(line)] = key
    texts = [f"story\n  {line}.\nmore" for line in known]
    texts += ["Released under the GPLv3.", "Distributed under the MPL 2.0", "LICENCED UNDER THE MIT LICENCE"]
    got = [n for _, n in scanned(spark, texts)]
    assert got[: len(known)] == [[first[licenses.plain_canonical(line)]] for line in known]
    assert got[len(known) :] == [["GPL-3.0"], ["MPL-2.0"], ["MIT"]]


def test_needles_leave_no_notice_out():
    for lines in (map(licenses.plain_canonical, licenses.notices()), ["x", "the gray one", "of behavior", "1 2"], []):
        lines = list(lines)
        found = licenses.needles(lines)
        assert all(any(n in line for n in found) for line in lines)
    assert licenses.needles(["gray"]) == ["gray", "grey"]
    assert licenses.needles(["", "x"]) == [""]


def test_query_agrees_with_sql_and_stays_native(spark, sf):
    frame = op1_license_scan(spark, sf)
    assert differences(frame, duck(sf).sql(oracle.license_scan())) == []
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_kept_columns_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, MIT, "a"), (1, MIT, "a"), (None, MIT, "b")], "doc_id long, text string, license string")
    got = licenses.scan(docs)
    assert got.columns == ["doc_id", "text", "digest", "notices", "license"]
    assert [r.license for r in got.collect()] == ["MIT"] * 3
    assert licenses.scan(docs.where("doc_id > 5")).count() == 0
