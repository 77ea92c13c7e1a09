import re
import textwrap

import pytest
from llm_data import EDGE_ROWS, edge_docs, no_docs

from postlake.llm import licenses


def sentences(text, known):
    """Line by line, as the module's docstring says."""
    out, held = [], []

    def close():
        out.extend(re.split(r"[.!?]+[ \t\n]+", re.sub(licenses.VERSION, r"\1 \2", " ".join(held))))
        held.clear()

    for raw in re.split("\r\n|\n|\r", text):
        item, notice = re.search(licenses.LIST_MARK, raw), re.search(licenses.COPYRIGHT, raw)
        line = "" if re.search(licenses.URL_LINE, raw) else re.sub(licenses.VERSION, r"\1 \2", raw[item.end() :] if item else raw)
        parts = [p for p in map(licenses.normalise, re.split(r"[.!?]+[ \t]+", line)) if p]
        if not parts or item or notice or parts[0] in known:
            close()
        held.append(line)
        if not parts or notice or parts[-1] in known:
            close()
    close()
    return [s for s in map(licenses.normalise, out) if not re.search(licenses.NO_SENTENCE, s)]


def slow_scan(text):
    known, rules = licenses._tables(licenses.SENTENCES, licenses.RULES)
    ids = [known.index(s) + 1 if s in known else 0 for s in sentences(text or "", known)]
    hits = []
    for i in range(len(ids)):
        for k, (name, parts) in enumerate(rules, 1):
            if ids[i : i + len(parts)] == parts:
                hits.append((k, i + 1, len(parts), name))
                break
    return [(name, k, i, n) for k, i, n, name in hits if not any(g < k and a <= i and a + m >= i + n for g, a, m, _ in hits)]


MIT = ". ".join(licenses.SENTENCES[x] for x in ("mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liable")) + "."
CASES = [
    "Intro text here.\nReleased under the MIT License.\nMore.",
    MIT, MIT.replace(". ", ".\n"), MIT.lower(), MIT.replace("Software", "SOFTWARE!"),
    MIT.replace(licenses.SENTENCES["mit-notice"], "Something else"),
    "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0.\n" * 30,
    "licensed under cc by-nc 4 0", "Licensed under CC BY-NC 5.0.", "", None, "...", "ſoftware K. İ",
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_scan_equals_its_definition(spark, case):
    frame = spark.createDataFrame([(1, CASES[case])], "doc_id long, text string")
    got = [(r.license, r.rule, r.sentence, r.sentences) for r in licenses.scan(frame).orderBy("sentence").collect()]
    assert got == slow_scan(CASES[case])


def test_whole_license_is_one_match(spark):
    frame = spark.createDataFrame([(1, "Preamble.\n" + MIT + "\nEnd.")], "doc_id long, text string")
    assert [(r.license, r.sentence, r.sentences) for r in licenses.scan(frame).collect()] == [("MIT", 2, 5)]


def test_own_sentences_and_rules(spark):
    frame = spark.createDataFrame([(1, "One two. Three four. One two.")], "doc_id long, text string")
    got = licenses.scan(frame, sentences={"a": "one two", "b": "three, four!"}, rules=[("X", ["a", "b"]), ("Y", ["a"])]).orderBy("sentence").collect()
    assert [(r.license, r.sentence) for r in got] == [("X", 1), ("Y", 3)]


def test_edge_cases(spark):
    got = licenses.scan(edge_docs(spark)).collect()
    assert [(r.doc_id, r.license) for r in got] == [(10, "MIT")]
    assert sum("MIT" in (t or "") for _, t, _ in EDGE_ROWS) == 1


def test_empty_table(spark):
    assert licenses.scan(no_docs(spark)).count() == 0


def test_plan_is_native_and_shuffles_nothing(spark):
    plan = licenses.scan(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan.replace("LocalTableScan", "")


def test_every_rule_names_known_sentences():
    assert all(x in licenses.SENTENCES for _, parts in licenses.RULES for x in parts)


def test_every_rule_matches_its_own_sentences(spark):
    """Written as plain text, one after the other, in one match of its license."""
    texts = [(k, "Intro. " + ". ".join(licenses.SENTENCES[x] for x in parts) + ". More.") for k, (_, parts) in enumerate(licenses.RULES)]
    found = {}
    for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        found.setdefault(r.doc_id, []).append((r.license, r.sentence))
    assert found == {k: [(name, 2)] for k, (name, _) in enumerate(licenses.RULES)}


S = licenses.SENTENCES
BSD = [S["bsd-grant"], "", "1. " + S["bsd-source"] + ".", "2. " + S["bsd-binary"] + "."]
#: As they stand in files: (license, sentences of its match, paragraphs).
FILES = [
    ("MIT", 5, ["MIT License", "", "Copyright (c) 2020 Some One", "", S["mit-grant"], "", S["mit-notice"] + ".", "", S["mit-as-is"] + ". " + S["mit-liable"] + "."]),
    ("MIT", 5, ["The MIT License (MIT)", "Copyright 2020 Some One", "", S["mit-grant"], "", S["mit-notice"] + ".", "", S["mit-as-is"] + ". " + S["mit-liable"] + "."]),
    ("Apache-2.0", 5, ["Copyright 2020 Some One", "", 'Licensed under the Apache License, Version 2.0 (the "License");', "you may not use this file except in compliance with the License.",
                       S["apache-copy"], "", "    http://www.apache.org/licenses/LICENSE-2.0", "", S["apache-unless"] + ".", S["apache-see"] + "."]),
    ("Apache-2.0", 4, [S["apache-full"] + ". " + S["apache-copy"], "http://www.apache.org/licenses/LICENSE-2.0", S["apache-unless"] + ". " + S["apache-see"] + "."]),
    ("BSD-2-Clause", 4, ["Copyright (c) 2020, Some One", "All rights reserved.", "", *BSD]),
    ("BSD-3-Clause", 4, [*BSD, "3. " + S["bsd-names"] + ".", "", "THIS SOFTWARE IS PROVIDED AS IT IS."]),
    ("BSD-3-Clause", 5, ["Copyright (c) 2020, Some One. All rights reserved.", *(x.replace("1. ", "(a) ").replace("2. ", "(b) ") for x in BSD), "(c) " + S["bsd-names"] + "."]),
    ("GPL-2.0-or-later", 3, [S["gpl2-free"] + ".", "", S["gpl-hope"] + ".  " + S["gpl-details"] + "."]),
    ("GPL-3.0-or-later", 3, [S["gpl-free"] + ".", "", S["gpl-hope"] + ".  " + S["gpl-details"] + ".", "", "You should have received a copy of it. If not, see <https://www.gnu.org/licenses/>."]),
    ("ISC", 1, ["Copyright (c) 2020 Some One", "", S["isc-grant"] + ".", "", 'THE SOFTWARE IS PROVIDED "AS IS" AND SO ON.']),
    ("MPL-2.0", 2, [S["mpl-subject"] + ". " + S["mpl-copy"] + "."]),
]
MARKS = [("", "", ""), ("/* ", " * ", " */"), ("// ", "// ", ""), ("# ", "# ", ""), ("<!-- ", "", "-->"), ("\t;; ", "\t;; ", ""), ("/**\r\n * ", " * ", "\r\n **/")]


@pytest.mark.parametrize("width", [58, 72, 79, 10_000])
def test_licenses_as_they_stand_in_files(spark, width):
    rows = []
    for k, (_, _, paragraphs) in enumerate(FILES):
        lines = [x for p in paragraphs for x in (textwrap.wrap(p, width, break_long_words=False, break_on_hyphens=False) or [""])]
        for m, (begin, each, end) in enumerate(MARKS):
            body = ("\r\n" if m == 6 else "\n").join((begin if i == 0 else each) + x for i, x in enumerate(lines)) + end
            rows.append((k * 100 + m, "int before;\n\n" + body + "\n\nint main() { return 0; }"))
    found = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r.doc_id, []).append((r.license, r.sentences))
    for i, text in rows:
        name, n, _ = FILES[i // 100]
        assert [x[0] for x in found.get(i, [])] == [name] and abs(found[i][0][1] - n) <= (name == "Apache-2.0"), text
        assert sorted(found[i]) == sorted((a, n) for a, _, _, n in slow_scan(text))


def test_lines_and_wrapped_sentences_beside_each_other(spark):
    texts = ["some words without an end\nReleased under the MIT License.\nand more", "Licensed under CC BY 4.0\nmore words here",
             "Terms: licensed\nunder the MIT License. Licensed\nunder the MIT\n// License. ok", "1. Released under the MIT\n   License.\n2. All rights\n   reserved."]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(0, "MIT"), (1, "CC-BY-4.0"), (2, "MIT"), (3, "MIT"), (3, "Proprietary")]
    for i, t in enumerate(texts):
        assert sorted((r.license, r.rule, r.sentence, r.sentences) for r in got if r.doc_id == i) == sorted(slow_scan(t))


def test_oracle_agrees_on_files(spark):
    import duckdb

    rows = [(k, "\n".join(x for p in paragraphs for x in (textwrap.wrap(p, 70, break_on_hyphens=False) or [""]))) for k, (_, _, paragraphs) in enumerate(FILES)]
    rows += [(100 + i, c) for i, c in enumerate(CASES)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = sorted(con.sql(licenses.oracle()).fetchall())
    assert sorted(tuple(r) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == want and len(want) > 20


def test_mpl_header_is_one_match(spark):
    text = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    got = licenses.scan(spark.createDataFrame([(1, text), (2, "Version. 2.0. Public.")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license, r.sentence, r.sentences) for r in got] == [(1, "MPL-2.0", 1, 2)]
