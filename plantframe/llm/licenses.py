"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, which are normalised and mapped to identifiers of known licence sentences. Sentence marks
and blank lines end a sentence; a single line end ends one only where no known sentence goes on over it, whatever comment
marks the next line starts with. List numbers and bare URLs part nothing from each other. What a text says is then a
sequence of identifiers, with a mark where other text lies between; ordered rules match runs of it, each taking what it
matches out of the sequence before the next one looks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, lower_ascii, text_of

#: Sentences as licences and notices print them (any case and punctuation), by identifier.
SENTENCES = {
    "MITGrant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "MITNotice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "AsIs": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "NoLiability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "MITReleased": "Released under the MIT License",
    "MITLicensed": "Licensed under the MIT License",
    "MITThis": "This project is licensed under the MIT License",
    "ApacheLicensed": "Licensed under the Apache License, Version 2.0",
    "ApacheLicensedThe": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "ApacheComply": "you may not use this file except in compliance with the License",
    "ApacheObtain": "You may obtain a copy of the License at",
    "ApacheUnless": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "ApacheSee": "See the License for the specific language governing permissions and limitations under the License",
    "BSDRedistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSDSource": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "BSDBinary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BSDEndorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "GPLFree": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "GPL2Free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "GPLHope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "GPLWork3": "This work is licensed under the GNU General Public License, version 3",
    "GPLWork2": "This work is licensed under the GNU General Public License, version 2",
    "LGPLWork3": "This work is licensed under the GNU Lesser General Public License, version 3",
    "CCBYNC4": "Licensed under CC BY-NC 4.0",
    "CCBY4": "Licensed under CC BY 4.0",
    "CCBYSA4": "Licensed under CC BY-SA 4.0",
    "CC0": "Licensed under CC0 1.0",
    "MPL2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "SPDXMIT": "SPDX-License-Identifier: MIT",
    "SPDXApache": "SPDX-License-Identifier: Apache-2.0",
    "SPDXGPL3": "SPDX-License-Identifier: GPL-3.0-or-later",
    "SPDXBSD3": "SPDX-License-Identifier: BSD-3-Clause",
    "AllRights": "All rights reserved",
}
#: Licences in the order in which they are looked for, and the run of sentences that each one is.
RULES = [
    ("MIT", ["MITGrant", "MITNotice", "AsIs", "NoLiability"]),
    ("MIT", ["MITGrant", "MITNotice", "AsIs"]),
    ("Apache-2.0", ["ApacheLicensedThe", "ApacheComply", "ApacheObtain", "ApacheUnless", "ApacheSee"]),
    ("BSD-3-Clause", ["BSDRedistribution", "BSDSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-2-Clause", ["BSDRedistribution", "BSDSource", "BSDBinary"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPLHope"]),
    ("GPL-2.0-or-later", ["GPL2Free", "GPLHope"]),
    ("GPL-3.0-or-later", ["GPLFree"]),
    ("MIT", ["MITReleased"]),
    ("MIT", ["MITLicensed"]),
    ("MIT", ["MITThis"]),
    ("Apache-2.0", ["ApacheLicensedThe"]),
    ("Apache-2.0", ["ApacheLicensed"]),
    ("GPL-3.0-only", ["GPLWork3"]),
    ("GPL-2.0-only", ["GPLWork2"]),
    ("LGPL-3.0-only", ["LGPLWork3"]),
    ("CC-BY-NC-4.0", ["CCBYNC4"]),
    ("CC-BY-SA-4.0", ["CCBYSA4"]),
    ("CC-BY-4.0", ["CCBY4"]),
    ("CC0-1.0", ["CC0"]),
    ("MPL-2.0", ["MPL2"]),
    ("MIT", ["SPDXMIT"]),
    ("Apache-2.0", ["SPDXApache"]),
    ("GPL-3.0-or-later", ["SPDXGPL3"]),
    ("BSD-3-Clause", ["SPDXBSD3"]),
    ("AllRightsReserved", ["AllRights"]),
]
#: A sentence ends at these marks before white space, or at a line's end; what is left of it are letters, digits, plus.
_END, _OTHER = "[.!?;:]+[ \\t]|[\\n\\r]", "[^a-z0-9+\\n]+"
#: The same where lines are joined: marks before white space, unless they start a line as comment marks do; they leave a
#: blank line. A URL counts as one word of its own.
_MARKS, _URL, _WORD = "(?<!\\n[ \\t]{0,20}[;:.!?]{0,8})[.!?;:]+(?:[ \\t]|(?=\\n))", "https?://\\S*[^\\s.,;:!?)>\\]\"']", "\u0002"
#: List numbers, and the least length of a known part that may have one before it or URLs behind it.
_NUMBER, _LONG = "(?:[0-9]{1,2}|[a-h]|[ivx]{1,4})", 12


def normalised(sentence: str) -> str:
    """A known sentence as it looks after cutting and normalising; marks within it before white space become spaces."""
    import re

    return re.sub("[^a-z0-9+]+", " ", sentence.lower()).strip()


def _known() -> dict[str, str]:
    """Identifiers by normalised part: a known sentence that the cut parts counts by its parts, numbered."""
    import re

    found = {}
    for name, sentence in SENTENCES.items():
        parts = [p for x in re.sub(_END, "\n", sentence + " ").split("\n") if (p := normalised(x))]
        for i, part in enumerate(parts):
            found.setdefault(part, name if len(parts) == 1 else f"{name}{i}")
    return found


def _run(names: list[str]) -> str:
    """A rule's run of identifiers, sentences that were parted written out."""
    import re

    known = _known()
    out = []
    for name in names:
        parts = [p for x in re.sub(_END, "\n", SENTENCES[name] + " ").split("\n") if (p := normalised(x))]
        out += [known[p] for p in parts]
    return "".join(f"{x};" for x in out)


def _piece() -> str:
    """What a text is cut into: a known part, over as many lines as it takes, or else the rest of a line; longest first."""
    joined = lambda part: part.replace("+", "[+]").replace(" ", "(?: | ?\\n ?)")
    parts = sorted(_known(), key=len, reverse=True)
    long, short = ("|".join(joined(p) for p in parts if (len(p) >= _LONG) == x) for x in (True, False))
    # Runs of URLs are collapsed before, to at most one on the line, a line of its own, and one that other text follows.
    return f" ?(?:(?:{_NUMBER} )?(?:{long})(?:(?: | ?\\n ?){_WORD}){{0,3}}|{short})(?= ?(?:\\n|\\z))|[^\\n]++"


def sequence(text: Column) -> Column:
    """The text's sentences as identifiers, each followed by a semicolon, with ``-;`` where other sentences lie between.

    Every sentence is replaced by its identifier or by nothing, nothings are taken together. List numbers and URLs on
    their own are nothing as well, except between two known sentences.
    """
    lines = F.replace(F.replace(lower_ascii(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = F.regexp_replace(F.replace(lines, F.lit(_WORD), F.lit(" ")), _URL, _WORD)
    lines = F.regexp_replace(F.regexp_replace(lines, _MARKS, "\n\n"), _OTHER.replace("\\n", f"\\n{_WORD}"), " ")
    # A run of URLs on a line counts as one, as does a run of lines that have nothing else; no loop here can backtrack.
    lines = F.regexp_replace(lines, f"{_WORD}(?: {_WORD})++", _WORD)
    lines = F.regexp_replace(lines, f"(\\n ?{_WORD} ?)(?:\\n ?{_WORD} ?(?=\\n|\\z))++", "$1")
    names = F.create_map(*[F.lit(x) for pair in _known().items() for x in pair])
    marks = F.transform(F.regexp_extract_all(lines, F.lit(_piece()), F.lit(0)), lambda s: F.trim(s))
    marks = F.filter(marks, lambda s: s != "")

    def named(s: Column) -> Column:
        plain = F.regexp_replace(s, f"[ \\n]+|{_WORD}", " ")
        bare = F.trim(F.regexp_replace(F.regexp_replace(plain, " +", " "), f"^{_NUMBER} (?=.{{{_LONG}}})", ""))
        number = F.when(s.rlike(f"^(?:{_NUMBER}|{_WORD}(?: {_WORD})*)$"), F.lit("~"))
        # Whole pieces first; a number, a URL and line ends are only taken off where that leaves a known part.
        return F.concat(F.coalesce(names[s], number, names[bare], F.lit("-")), F.lit(";"))

    found = F.regexp_replace(F.array_join(F.transform(marks, named), ""), "(?<=[A-Za-z0-9];)(?:~;)+(?=[A-Z])", "")
    return F.regexp_replace(F.replace(found, F.lit("~"), F.lit("-")), "(-;)+", "-;")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, sentences (known ones, as a sequence), n_sentences, licenses, left_over.

    ``licenses`` joins the names of the matched rules with commas, each once, in the order of the rules; null without a
    match, as for null and empty texts. ``left_over`` has the known sentences that no rule took. A rule may match
    several times in a text. Texts of any length are read whole; repeated rows and null ids pass as they are.
    """
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), sequence(text_of(text_col)).alias("sentences"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(";" + _run(run)).alias("run")) for name, run in RULES])
    start = F.struct(F.concat(F.lit(";"), F.col("sentences")).alias("rest"), F.array().cast("array<string>").alias("names"))

    def look(state, rule):
        # A run is taken together with the semicolon before it, and leaves a mark that parts what stood on both sides.
        return F.struct(
            F.replace(state["rest"], rule["run"], F.lit(";-;")).alias("rest"),
            F.when(F.contains(state["rest"], rule["run"]), F.array_union(state["names"], F.array(rule["name"]))).otherwise(state["names"]).alias("names"),
        )

    matched = F.when(F.col("sentences").rlike("[A-Za-z]"), F.aggregate(rules, start, look))
    done = found.withColumn("_m", matched)
    return done.select(
        "doc_id", "sentences",
        F.regexp_count("sentences", F.lit("[A-Za-z0-9]+;")).cast("long").alias("n_sentences"),
        F.when(F.size("_m.names") > 0, F.array_join("_m.names", ",")).alias("licenses"),
        F.coalesce(F.array_join(F.filter(F.split("_m.rest", ";"), lambda x: x.rlike("[A-Za-z]")), ";"), F.lit("")).alias("left_over"),
    )


def scan_sql() -> str:
    """SQL over ``documents``, a step for each rule, for texts whose known sentences stand on lines of their own.

    It cuts at every line end, so it finds no sentence that is wrapped, commented or numbered, as ``scan`` does.
    """
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in _known().items())
    end, other = _END.replace("\\n\\r", "\\n\\r"), _OTHER
    steps = [f"r0 AS (SELECT doc_id, sentences, ';' || sentences AS rest, []::VARCHAR[] AS names FROM s)"]  # noqa: F541
    for i, (name, run) in enumerate(RULES):
        text = quote(";" + _run(run))
        add = f"CASE WHEN contains(rest, {text}) AND NOT list_contains(names, {quote(name)}) THEN list_append(names, {quote(name)}) ELSE names END"
        steps.append(f"r{i + 1} AS (SELECT doc_id, sentences, replace(rest, {text}, ';-;') AS rest, {add} AS names FROM r{i})")
    return f"""
WITH k(part, name) AS (VALUES {known}),
l AS (SELECT doc_id, rn, unnest(string_split(regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{end}', chr(10), 'g'), '{other}', ' ', 'g'), chr(10))) AS line,
  generate_subscripts(string_split(regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{end}', chr(10), 'g'), '{other}', ' ', 'g'), chr(10)), 1) AS i
  FROM (SELECT *, row_number() OVER () AS rn FROM documents)),
s AS (SELECT doc_id, regexp_replace(coalesce(string_agg(coalesce(name || ';', '-;'), '' ORDER BY i) FILTER (trim(line) <> ''), ''), '(-;)+', '-;', 'g') AS sentences
  FROM l LEFT JOIN k ON k.part = trim(line) GROUP BY doc_id, rn),
{", ".join(steps)}
SELECT doc_id, sentences, len(regexp_extract_all(sentences, '[A-Za-z0-9]+;'))::BIGINT AS n_sentences,
  CASE WHEN len(names) > 0 THEN array_to_string(names, ',') END AS licenses,
  coalesce(array_to_string(list_filter(string_split(rest, ';'), lambda x: regexp_matches(x, '[A-Za-z]')), ';'), '') AS left_over
FROM r{len(RULES)}
"""
