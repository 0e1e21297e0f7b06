from pyspark.sql import functions as F

from quarry.llm import licenses as L
from quarry.llm.common import table


def scan(spark, *texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r for r in sorted(L.scan(docs).collect(), key=lambda r: r.doc_id)]


def names(row):
    return [m.license for m in row.licenses]


def wrapped(*ids):
    words = " ".join(L.SENTENCES[i] for i in ids).split()
    return "\n".join(" ".join(words[k:k + 11]) for k in range(0, len(words), 11))


def test_every_sentence_has_a_hint_and_an_own_normal_form():
    forms = {i: L.normal_text(s) for i, s in L.SENTENCES.items()}
    assert all(any(h in f for h in L.HINTS) for f in forms.values())
    assert len(set(forms.values())) == len(forms)
    assert {i for _, ids in L.RULES for i in ids} <= set(L.SENTENCES)


def test_each_sentence_is_recognised(spark):
    rows = scan(spark, *[f"Some words before it\n{s}\nand after it." for s in L.SENTENCES.values()])
    for (i, s), r in zip(L.SENTENCES.items(), rows):
        if s[-1] in ".!?:" or "\n" not in s:
            assert i in [x.id for x in r.sentences], i


def test_rules_need_their_order(spark):
    whole = wrapped("mit-grant", "mit-notice", "mit-as-is", "mit-liability")
    bsd = wrapped("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is")
    mixed_up = wrapped("mit-as-is", "mit-grant", "mit-liability", "mit-notice")
    far = L.SENTENCES["bsd-grant"] + "\n" + "Other words stand here. " * 9 + L.SENTENCES["bsd-source"]
    rows = scan(spark, "intro.\n\n" + whole, bsd.replace("copyright holder nor", "Foo Inc nor").replace("holder nor", "Foo nor"),
                mixed_up, far, "A text about a license and a warranty.", "LICENCE: All Rights  Reserved!\n")
    assert names(rows[0]) == ["MIT"] and rows[0].licenses[0].sentences in (3, 4)
    assert names(rows[1]) == ["BSD-3-Clause"]
    assert names(rows[2]) == [] and names(rows[3]) == [] and names(rows[4]) == []
    assert names(rows[5]) == ["All-rights-reserved"]


def test_corpus_lines_are_all_found(spark, small_sf):
    lines = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "All-rights-reserved",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    sf = small_sf.replace("sf0.001", "sf0.01")
    docs = table(spark, sf, "documents")
    found = {r.doc_id: set(names(r)) for r in L.scan(docs, keep=["doc_id"]).collect()}
    for r in docs.collect():
        assert found[r.doc_id] == {l for s, l in lines.items() if s in (r.text or "")}


def test_defined_cases(spark, odd_docs, no_docs):
    rows = L.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.sentences == [] and r.licenses == [] for r in rows)
    assert L.scan(no_docs).count() == 0
    twice = L.scan(odd_docs.withColumnRenamed("row", "licenses"))
    assert dict(twice.dtypes)["licenses"].startswith("array")


def test_numbered_texts_holders_and_spdx_lines(spark):
    bsd = """Copyright (c) 1990, 1993 The Regents of the University. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE REGENTS BE LIABLE.
"""
    third = """
3. Neither the name of the University nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
    agpl = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU {} General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""
    head = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
"""
    spdx = ["LGPL-2.1-only", "AGPL-3.0-or-later", "GPL-2.0-or-later", "ISC", "CC0-1.0", "Unlicense", "MIT", "BSD-3-Clause"]
    rows = scan(spark, bsd.format(third), bsd.format(""), agpl.format("Affero"), agpl.format("Lesser"), head,
                "// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;", "/* SPDX-License-Identifier: GPL-2.0+ WITH Foo */",
                *[f"# SPDX-License-Identifier: {i}\nimport x\n" for i in spdx])
    assert "BSD-3-Clause" in names(rows[0]) and "BSD-2-Clause" not in names(rows[0])
    assert "BSD-2-Clause" in names(rows[1]) and "BSD-3-Clause" not in names(rows[1])
    assert [names(r) for r in rows[2:5]] == [["AGPL-3.0-or-later"], ["LGPL-3.0-or-later"], ["Apache-2.0"]]
    assert [names(r) for r in rows[5:7]] == [["Apache-2.0", "MIT"], ["GPL-2.0-or-later"]]
    assert [names(r) for r in rows[7:]] == [[i] for i in spdx]


def test_long_texts_without_stops_take_time_in_proportion(spark):
    """2 MB of lines without a full stop, a hint word in each hundredth: the licence line
    at the end and one in the middle are found, and twice the text takes no four times."""
    import time

    def text(lines):
        rows = [f"row {i} of the table, warranty column {i % 7}" if i % 100 == 0 else f"value {i} * {i % 13} ; next" for i in range(lines)]
        rows[lines // 2] = "Released under the MIT License."
        return "\n".join(rows + ["Licensed under the Apache License, Version 2.0."])

    took = []
    for lines in (20_000, 40_000, 80_000):
        df = spark.createDataFrame([(1, text(lines))], "doc_id long, text string")
        L.scan(df.withColumn("text", F.lit("warm up the MIT License"))).collect()
        start = time.perf_counter()
        row = L.scan(df).first()
        took.append(time.perf_counter() - start)
        assert [m.license for m in row.licenses] == ["Apache-2.0", "MIT"] or {m.license for m in row.licenses} == {"Apache-2.0", "MIT"}
    assert len(text(80_000)) > 1_800_000
    assert took[2] < 6 * took[1] + 2 and took[2] < 60, took
