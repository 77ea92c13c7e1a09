"""License scan by sentence rules, with DataFrame functions only.

A text is cut into sentences, each is normalised to lower-case ASCII words, and
the known ones get their identifier. Licenses stand wrapped in files, behind
comment marks and list numbers: a line end is a space, unless a line beside it
has no word, is a URL or begins a copyright notice, the next one begins with a
list mark, or a known sentence ends or begins there. Sentences that only say who
has the copyright, and bare numbers, are no sentences; "v. 2" is no sentence end.
The row of identifiers is then matched against ordered rules, each a row of identifiers that must stand in adjacent
sentences. At each sentence the first rule that fits counts; a match inside
that of an earlier rule is dropped. All of it happens inside one row, so
nothing is shuffled, and a text with very many license lines only looks at
matches that begin within the longest rule before.

Edge cases: null and empty texts, and those without a known sentence, give no
match. A sentence without a word is no sentence. Repeated rows give their
matches again. A null key is carried along. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE_END = "\r\n|\n|\r"
SENTENCE_END = "[.!?]+[ \t\n]+|\n+"
NOT_WORD = "[^A-Za-z0-9]+"
#: Patterns of a line: list marks, a URL alone, a copyright notice; and a version's "v.".
LIST_MARK = "^[^A-Za-z0-9(]*(?:[0-9]{1,2}[.)]|[(][a-z0-9]{1,3}[)])[ \t]+"
URL_LINE = "^[^A-Za-z0-9]*(?:https?://|www[.])[^ \t]+[ \t]*[^A-Za-z0-9]*$"
COPYRIGHT = "(?i)^[^A-Za-z0-9]*copyright[ \t]+(?:[(]c[)]|[0-9]{4})"
VERSION = "(?i)([^A-Za-z0-9]v)[.][^A-Za-z0-9\n]+([0-9])"
#: Normalised sentences that are none.
NO_SENTENCE = "^(?:[0-9 ]*|copyright (?:c |[0-9]{4}).*)$"

#: Sentences of well-known licenses and notices, by identifier.
SENTENCES = {
    "apache-named": "Licensed under the Apache License, Version 2.0",
    "apache-the": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-not-except": "you may not use this file except in compliance with the License",
    "apache-full": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
    "apache-copy": "You may obtain a copy of the License at",
    "apache-unless": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-title-short": "MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-named": "Licensed under the BSD 3-Clause License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-details": "See the GNU General Public License for more details",
    "lgpl-work": "This library is licensed under the GNU Lesser General Public License, version 3",
    "agpl-work": "This work is licensed under the GNU Affero General Public License, version 3",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "mpl-copy-at": "If a copy of the MPL was not distributed with this file, You can obtain one at",  # the URL on a line of its own
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-nd": "Licensed under CC BY-ND 4.0",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0": "To the extent possible under law, the author has dedicated all copyright to the public domain",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "reserved": "All rights reserved",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
}

#: Fixed values: (license, sentences in turn). Earlier rules win over later ones.
RULES = [
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liable"]),
    ("MIT", ["mit-title-short", "mit-grant", "mit-notice", "mit-as-is", "mit-liable"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liable"]),
    ("Apache-2.0", ["apache-full", "apache-copy", "apache-unless", "apache-see"]),
    ("Apache-2.0", ["apache-the", "apache-not-except", "apache-copy", "apache-unless", "apache-see"]),
    ("BSD-3-Clause", ["reserved", "bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["reserved", "bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-details"]),
    ("MPL-2.0", ["mpl-subject", "mpl-copy"]),
    ("MPL-2.0", ["mpl-subject", "mpl-copy-at"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("MIT", ["mit-grant"]),
    ("ISC", ["isc-grant"]),
    ("BSD-unspecified", ["bsd-grant"]),
    ("Apache-2.0", ["apache-full"]),
    ("Apache-2.0", ["apache-the"]),
    ("Apache-2.0", ["apache-named"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-title"]),
    ("MIT", ["mit-title-short"]),
    ("BSD-3-Clause", ["bsd-named"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("GPL-2.0-only", ["gpl2-work"]),
    ("LGPL-3.0-only", ["lgpl-work"]),
    ("AGPL-3.0-only", ["agpl-work"]),
    ("MPL-2.0", ["mpl-subject"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-ND-4.0", ["cc-by-nd"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-4.0", ["cc-by-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-long"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-long"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("MIT", ["spdx-mit"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("GPL-3.0-only", ["spdx-gpl3"]),
    ("Proprietary", ["reserved"]),
    ("MPL-2.0", ["mpl-copy"]),
    ("MPL-2.0", ["mpl-copy-at"]),
]


def normalise(sentence: str) -> str:
    return re.sub(NOT_WORD, " ", sentence).strip(" ").lower()


def _tables(sentences: dict[str, str], rules: Sequence[tuple[str, list[str]]]) -> tuple[list[str], list[tuple[str, list[int]]]]:
    """Normalised sentences by identifier (1, 2, ...), and rules over those. A
    sentence that two names share gets the identifier of the first."""
    known = list(dict.fromkeys(normalise(s) for s in sentences.values()))
    at = {name: known.index(normalise(s)) + 1 for name, s in sentences.items()}
    return known, [(name, [at[x] for x in parts]) for name, parts in rules]


def cover_words(known: Sequence[str]) -> list[str]:
    """A few words of which each known sentence has one, long ones where it can be:
    a text without any of them has no known sentence."""
    words = {s: {w for w in s.split() if len(w) >= min(6, max(map(len, s.split())))} for s in known if s}
    out: list[str] = []
    while words:
        most = max(sorted({w for ws in words.values() for w in ws}), key=lambda w: sum(w in ws for ws in words.values()))
        out.append(most)
        words = {s: ws for s, ws in words.items() if most not in ws}
    return out


def _plain(sentence: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(sentence, NOT_WORD, " ")))


def with_sentence_ids(docs: DataFrame, known: list[str]) -> DataFrame:
    """Columns ``key`` and ``ids``, the identifier of each sentence of ``text``, 0 for unknown ones."""
    table = F.array(*map(F.lit, known))

    def line(raw: Column) -> Column:
        body = F.when(raw.rlike(URL_LINE), "").otherwise(F.regexp_replace(F.regexp_replace(raw, LIST_MARK, ""), VERSION, "$1 $2"))
        return F.struct(body.alias("body"), raw.rlike(LIST_MARK).alias("item"), raw.rlike(COPYRIGHT).alias("notice"))

    def parts(x: Column) -> Column:
        plain = F.transform(F.split(x.body, SENTENCE_END), _plain)
        return F.struct(x.body.alias("body"), x.item.alias("item"), x.notice.alias("notice"), F.filter(plain, lambda s: s != "").alias("parts"))

    def edges(x: Column) -> Column:
        bare = F.size(x.parts) == 0
        begins = bare | x.item | x.notice | F.array_contains(table, F.get(x.parts, F.lit(0)))
        ends = bare | x.notice | F.array_contains(table, F.get(x.parts, F.size(x.parts) - 1))
        return F.struct(x.body.alias("body"), begins.alias("begins"), ends.alias("ends"))

    # each step reads a column of the one before: within a lambda, what is named twice is computed twice
    lines = docs.select("key", F.transform(F.split("text", LINE_END), line).alias("lines"))
    said = lines.select("key", F.transform("lines", parts).alias("lines"))
    marked = said.select("key", F.transform("lines", edges).alias("lines"))

    def joined(x: Column, i: Column) -> Column:
        cut = x.begins | F.get("lines", i - 1).ends
        return F.concat(F.when(i == 0, "").when(cut, "\n").otherwise(" "), x.body)

    text = marked.select("key", F.regexp_replace(F.array_join(F.transform("lines", joined), ""), VERSION, "$1 $2").alias("text"))
    plain = text.select("key", F.filter(F.transform(F.split("text", SENTENCE_END), _plain), lambda s: ~s.rlike(NO_SENTENCE)).alias("plain"))
    return plain.select("key", F.transform("plain", lambda s: F.array_position(table, s).cast("int")).alias("ids"))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", sentences: dict[str, str] | None = None, rules: Sequence[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Matches: (key, license, rule, sentence, sentences), rules and sentences
    counted from 1."""
    known, ordered = _tables(sentences or SENTENCES, rules or RULES)
    longest = max(len(ids) for _, ids in ordered)
    table = F.array(*(F.struct(F.lit(k).alias("rule"), F.lit(name).alias("license"), F.array(*map(F.lit, ids)).alias("ids")) for k, (name, ids) in enumerate(ordered, 1)))
    some = docs.where(F.col(text).rlike("(?i)" + "|".join(cover_words(known))))
    found = with_sentence_ids(some.select(F.col(key).alias("key"), F.col(text).alias("text")), known)

    def first_rule(at: Column) -> Column:
        return F.get(F.filter(table, lambda r: F.slice("ids", at, F.size(r.ids)) == r.ids), F.lit(0))

    places = F.filter(F.sequence(F.lit(1), F.size("ids")), lambda i: F.get("ids", i - 1) > 0)
    hits = F.transform(places, lambda i: F.struct(i.alias("at"), first_rule(i).alias("r")))
    found = found.select("key", F.filter(hits, lambda h: h.r.isNotNull()).alias("hits"))

    def inside(h: Column, k: Column) -> Column:
        end = h.at + F.size(h.r.ids)
        near = F.slice("hits", F.greatest(k + 2 - longest, F.lit(1)), longest)
        return F.exists(near, lambda g: (g.r.rule < h.r.rule) & (g.at <= h.at) & (g.at + F.size(g.r.ids) >= end))

    kept = found.select("key", F.explode(F.filter("hits", lambda h, k: ~inside(h, k))).alias("h"))
    return kept.select(F.col("key").alias(key), "h.r.license", "h.r.rule", F.col("h.at").alias("sentence"), F.size("h.r.ids").alias("sentences"))


def oracle() -> str:
    """The same over table documents, as DuckDB SQL with relations instead of arrays."""
    known, ordered = _tables(SENTENCES, RULES)
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    pattern = lambda x: quote(x.replace("\t", r"\t").replace("\r", r"\r").replace("\n", r"\n"))
    end, word = pattern(SENTENCE_END), pattern(NOT_WORD)
    plain = f"lower(trim(regexp_replace(@, {word}, ' ', 'g'), ' '))"
    return f"""
with rules(rule, license, ids) as (values {", ".join(f"({k}, {quote(name)}, {ids})" for k, (name, ids) in enumerate(ordered, 1))}),
known as (select unnest({"[" + ", ".join(map(quote, known)) + "]"}) as sentence, unnest(range(1, {len(known) + 1})) as id),
numbered as (select row_number() over () as rid, doc_id, string_split_regex(text, {pattern(LINE_END)}) as raw from documents where text is not null),
raws as (select rid, doc_id, unnest(raw) as raw, generate_subscripts(raw, 1) as ln from numbered),
lines as (select rid, doc_id, ln, regexp_matches(raw, {pattern(LIST_MARK)}) as item, regexp_matches(raw, {pattern(COPYRIGHT)}) as notice,
  case when regexp_matches(raw, {pattern(URL_LINE)}) then '' else regexp_replace(regexp_replace(raw, {pattern(LIST_MARK)}, ''), {pattern(VERSION)}, '\\1 \\2', 'g') end as body from raws),
parts as (select rid, ln, unnest(string_split_regex(body, {end})) as part, generate_subscripts(string_split_regex(body, {end}), 1) as p from lines),
said as (select rid, ln, p, {plain.replace("@", "part")} as s from parts),
edges as (select rid, ln, bool_or(id is not null and first) as begins, bool_or(id is not null and last) as ends from (
  select rid, ln, s, row_number() over (partition by rid, ln order by p) = 1 as first, row_number() over (partition by rid, ln order by p desc) = 1 as last
  from said where s <> '') t left join known on known.sentence = t.s group by rid, ln),
cuts as (select l.rid, l.doc_id, l.ln, l.body, e.rid is null or item or notice or e.begins as begins, e.rid is null or notice or e.ends as ends
  from lines l left join edges e on l.rid = e.rid and l.ln = e.ln),
joins as (select rid, doc_id, ln, case when lag(ends) over w is null then '' when begins or lag(ends) over w then chr(10) else ' ' end || body as body
  from cuts window w as (partition by rid order by ln)),
texts as (select rid, any_value(doc_id) as doc_id, regexp_replace(string_agg(body, '' order by ln), {pattern(VERSION)}, '\\1 \\2', 'g') as text from joins group by rid),
words as (select rid, doc_id, list_filter(list_transform(string_split_regex(text, {end}), lambda s: {plain.replace("@", "s")}), lambda s: not regexp_matches(s, {pattern(NO_SENTENCE)})) as w from texts),
placed as (select rid, doc_id, unnest(w) as sentence, generate_subscripts(w, 1) as pos from words),
rows as (select rid, any_value(doc_id) as doc_id, list(coalesce(id, 0) order by pos) as ids from placed left join known using (sentence) group by rid having max(coalesce(id, 0)) > 0),
starts as (select rid, doc_id, ids, unnest(range(1, len(ids) + 1)) as pos from rows),
fits as (select s.rid, s.doc_id, s.pos, min(r.rule) as rule from starts s join rules r on list_slice(s.ids, s.pos, s.pos + len(r.ids) - 1) = r.ids group by all),
hits as (select f.rid, f.doc_id, f.pos, r.rule, r.license, len(r.ids) as n from fits f join rules r using (rule))
select doc_id, license, cast(rule as int) as rule, cast(pos as int) as sentence, cast(n as int) as sentences from hits h
where not exists (select 1 from hits g where g.rid = h.rid and g.rule < h.rule and g.pos <= h.pos and g.pos + g.n >= h.pos + h.n)
"""
