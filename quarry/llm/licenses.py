"""Licence scan: sentences recognised by identifier, identifier sequences by rule.

A text is cut into sentences; each is normalised (lower case, words only, British
spelling, without its list number and years, holders of the BSD texts abstracted) and
looked up in the table of known licence sentences; SPDX lines are read by the SPDX
licence list. The identifiers found, in order, are matched against rules: a licence's
sentences in their order, each at most ``REACH`` sentences behind the one before.

A sentence runs to a full stop, question or exclamation mark (behind more than one
letter, so not in "v. 2") or a colon (but that of an SPDX line) before white space,
or to a blank line. As lines before a licence line may lack a stop, every stretch of a
sentence that starts at a line's start is looked up too, the longest first, and so
is every single line; a sentence counts once. Stretches of more letters than ``LONGEST``
can be no known sentence, so the time grows with the text, not with its square.

Only DataFrame functions are used and no row moves: the table and the rules are a
fixed list of this module. Texts without any of the words that every known sentence
holds are not cut at all.

Defined cases: null and empty texts give empty arrays. Repeated rows each get their
row; other columns are carried, and one named like an output column is replaced by it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import carried, let, text_or_empty
from quarry.llm.spdx import IDS

#: What an SPDX line's identifiers begin with, and old names by their present ones.
SPDX = "spdx-"
OLD = {f"{f}-{v}{e}": f"{f}-{v}-{'or-later' if e else 'only'}" for f, v in (
    ("GPL", "1.0"), ("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "1.0"),
    ("AGPL", "3.0")) for e in ("", "+")}

#: Most sentences from one sentence of a rule to its next.
REACH = 4

#: Known sentences by identifier (texts of public licences and notices).
SENTENCES = {
    "mit-title": "MIT License",
    "mit-short": "Released under the MIT License.",
    "mit-short-2": "Licensed under the MIT License.",
    "mit-short-3": "This project is licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache-title": "Apache License",
    "apache-version": "Apache License Version 2.0, January 2004",
    "apache-head": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-short": "This work is licensed under the GNU General Public License, version 2.",
    "gpl3-notice": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program.",
    "lgpl21-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-notice": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-notice": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "cc-by-4": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-4-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4-short": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4-short": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nd-4-short": "Licensed under CC BY-ND 4.0.",
    "rights": "All rights reserved.",
}

#: Licences by the ordered sentence identifiers that state them. A
#: match whose sentences all belong to a longer match is dropped.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-title", "mit-grant"]),
    ("MIT", ["mit-short"]), ("MIT", ["mit-short-2"]), ("MIT", ["mit-short-3"]),
    ("Apache-2.0", ["apache-notice", "apache-copy", "apache-as-is", "apache-see"]),
    ("Apache-2.0", ["apache-notice", "apache-as-is"]), ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-short"]),
    ("GPL-3.0-or-later", ["gpl3-notice", "gpl-hope", "gpl-see", "gpl-copy"]), ("GPL-3.0-or-later", ["gpl3-notice"]),
    ("GPL-2.0-or-later", ["gpl2-notice", "gpl-hope", "gpl-see"]), ("GPL-2.0-or-later", ["gpl2-notice"]),
    ("GPL-3.0-only", ["gpl3-short"]), ("GPL-2.0-only", ["gpl2-short"]),
    ("LGPL-2.1-or-later", ["lgpl21-notice"]), ("LGPL-3.0-or-later", ["lgpl3-notice"]),
    ("AGPL-3.0-or-later", ["agpl3-notice"]),
    ("Apache-2.0", ["apache-head"]), ("Apache-2.0", ["apache-version"]), ("Apache-2.0", ["apache-title", "apache-copy"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("ISC", ["isc-grant"]), ("MPL-2.0", ["mpl2-notice", "mpl2-copy"]), ("MPL-2.0", ["mpl2-notice"]),
    ("Unlicense", ["unlicense"]), ("CC0-1.0", ["cc0"]),
    ("CC-BY-4.0", ["cc-by-4"]), ("CC-BY-SA-4.0", ["cc-by-sa-4"]), ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4-short"]), ("CC-BY-SA-4.0", ["cc-by-sa-4-short"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-short"]), ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4-short"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4-short"]),
    ("All-rights-reserved", ["rights"]),
]

#: Some of these stand in every known sentence (checked by a test).
HINTS = ("licen", "permission", "warrant", "redistribut", "copyright", "reserved", "domain",
         "liab", "mpl", "spdx")
_END = "\u0001"


#: A list number or letter before a sentence ("1. ", "(b) ", "* iv) ").
_ITEM = r"^[^\p{L}\p{N}]*(?:\p{N}{1,2}|[a-z]|[ivx]{2,4})[.)]\s+"
_YEAR = r" (?:19|20)[0-9]{2}(?= )"


def normal(s: Column) -> Column:
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), _ITEM, ""), r"[^\p{L}\p{N}]+", " "))
    words = F.trim(F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), _YEAR, ""))
    words = F.regexp_replace(words, "licence", "license")
    words = F.regexp_replace(words, "^this software is provided by .+? as is and any express",
                             "this software is provided by the copyright holders and contributors as is and any express")
    return F.regexp_replace(words, "neither the name of .+? nor the names of",
                            "neither the name of the copyright holder nor the names of")


def normal_text(s: str) -> str:
    """The same for the module's own sentences."""
    words = " ".join("".join(c.lower() if c.isalnum() else " " for c in s).split())
    return re.sub(_YEAR, "", f" {words} ").strip().replace("licence", "license")


#: Letters and digits of the longest known sentence, and room for a holder and years.
LONGEST = max(len(normal_text(x).replace(" ", "")) for x in SENTENCES.values()) + 500


def spdx_ids(sentence: Column) -> Column:
    """The licences an SPDX line names, in their writing in the licence list (with or
    without an exception or the old "+")."""
    said = F.regexp_extract(sentence, r"(?i)spdx-license-identifier:[ \t]*([^\r\n]+)", 1)
    listed = F.create_map(*[F.lit(x) for i in IDS for x in (i.lower(), OLD.get(i, i))])
    found = F.transform(F.regexp_extract_all(F.lower(said), F.lit(r"[a-z0-9][a-z0-9.+\-]*"), F.lit(0)), lambda w: F.coalesce(
        F.element_at(listed, w), F.element_at(listed, F.regexp_replace(w, r"[.+\-]+$", ""))))
    return F.array_distinct(F.filter(found, lambda i: i.isNotNull()))


def _table() -> Column:
    return F.create_map(*[F.lit(x) for i, s in SENTENCES.items() for x in (normal_text(s), i)])


def sentence_ids(text: Column) -> Column:
    """array<struct<at, id>>: the known sentences of a text by sentence number."""
    known = _table()
    cut = F.regexp_replace(text, r"(?<=[^\s.][^\s.][.!?])\s+|(?<=:)(?<!dentifier:)\s+|\n[ \t]*\n", _END)

    def tails(lines: Column) -> Column:
        """The whole sentence, and the stretches from a line's start to its end that are
        not too long to be known: those of the last lines with ``LONGEST`` letters."""
        def last_lines(letters: Column) -> Column:
            start = F.struct(F.lit(0).alias("letters"), F.lit(0).alias("lines"))
            return F.aggregate(F.reverse(letters), start, lambda s, n: F.when(
                s["letters"] + n <= LONGEST, F.struct((s["letters"] + n).alias("letters"), (s["lines"] + 1).alias("lines")))
                .otherwise(F.struct(F.lit(LONGEST + 1).alias("letters"), s["lines"].alias("lines"))))["lines"]

        def starts(letters: Column) -> Column:
            return let(last_lines(letters), lambda n: F.filter(
                F.sequence(F.greatest(F.lit(2), F.size(letters) - n + 1), F.size(letters) + 1),
                lambda k: F.coalesce(F.get(letters, k - 1) > 0, F.lit(False))))

        letters = F.transform(lines, lambda line: F.length(F.regexp_replace(line, r"[^\p{L}\p{N}]", "")))
        return F.transform(F.concat(F.array(F.lit(1)), let(letters, starts)), lambda k: F.array_join(
            F.slice(lines, k, F.size(lines)), " "))

    def lookup(sentence: Column, at: Column) -> Column:
        hit = let(F.split(sentence, "\n"), lambda lines: F.get(F.filter(F.transform(
            F.concat(tails(lines), lines), lambda c: F.element_at(known, normal(c))), lambda i: i.isNotNull()), 0))
        return F.struct(at.cast("int").alias("at"), hit.alias("id"))

    def named(sentence: Column, at: Column) -> Column:
        return F.transform(spdx_ids(sentence), lambda i: F.struct(at.cast("int").alias("at"), F.concat(F.lit(SPDX), i).alias("id")))

    none = F.array().cast("array<struct<at:int,id:string>>")
    found = F.flatten(F.transform(F.split(cut, _END), lambda s, at: F.when(
        F.lower(s).contains("spdx-license-identifier:"), F.concat(F.array(lookup(s, at)), named(s, at))).when(
        F.lower(s).rlike("|".join(HINTS)), F.array(lookup(s, at))).otherwise(none)))
    hinted = F.lower(text).rlike("|".join(HINTS))
    return F.when(hinted, F.filter(found, lambda f: f["id"].isNotNull())).otherwise(none)


def licences(found: Column) -> Column:
    """array<struct<license, first, last, sentences>>: rules matched by the sequence."""
    def match(license_: str, ids: list[str]) -> Column:
        # Every occurrence of the rule's first sentence may start a match.
        def follow(start: Column) -> Column:
            begin = F.struct(start["at"].alias("at"), F.lit(1).alias("n"))

            def step(s: Column, wanted: Column) -> Column:
                hit = F.get(F.filter(found, lambda f: (f["id"] == wanted) & (f["at"] > s["at"])
                                     & (f["at"] <= s["at"] + REACH)), 0)
                return F.when(hit.isNotNull(), F.struct(hit["at"].alias("at"), (s["n"] + 1).alias("n"))).otherwise(
                    F.struct(s["at"].alias("at"), s["n"].alias("n")))

            rest = F.array(*[F.lit(i) for i in ids[1:]]) if len(ids) > 1 else F.array().cast("array<string>")
            end = F.aggregate(rest, begin, step)
            return F.struct(F.lit(license_).alias("license"), start["at"].alias("first"), end["at"].alias("last"),
                            end["n"].cast("int").alias("sentences"))

        starts = F.filter(found, lambda f: f["id"] == ids[0])
        return F.filter(F.transform(starts, follow), lambda m: m["sentences"] == len(ids))

    named = F.transform(F.filter(found, lambda f: f["id"].startswith(SPDX)), lambda f: F.struct(
        F.substr(f["id"], F.lit(len(SPDX) + 1)).alias("license"), f["at"].alias("first"), f["at"].alias("last"),
        F.lit(1).alias("sentences")))
    every = F.concat(*[match(*r) for r in RULES], named)
    none = F.array().cast("array<struct<license:string,first:int,last:int,sentences:int>>")
    kept = let(every, lambda ms: F.filter(ms, lambda m: ~F.exists(ms, lambda o: (
        (o["first"] <= m["first"]) & (o["last"] >= m["last"]) & (o["sentences"] > m["sentences"])))))
    return F.when(F.size(found) > 0, F.array_sort(F.array_distinct(kept))).otherwise(none)


def scan(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all others but the text), sentences (at, id) and
    licenses (license, first and last sentence, number of sentences)."""
    keep = carried(docs, keep, [text], ["sentences", "licenses"])
    return (docs.select(*keep, sentence_ids(text_or_empty(text)).alias("sentences"))
            .select(*keep, "sentences", let(F.col("sentences"), licences).alias("licenses")))
