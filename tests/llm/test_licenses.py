import re
import time

import pytest
from pyspark.sql import functions as F

from loadkeeper.llm import licenses
from loadkeeper.llm.queries import QUERIES, SQL
from tests.llm.conftest import FOLDER, ODD


def plain(sentence):
    """Letters, digits and inner full stops."""
    spaced = re.sub(r"[^a-z0-9.]+", " ", sentence)
    return re.sub(" +", " ", re.sub(r"(^|\s)\.+|\.+($|\s)", " ", spaced)).strip(" ")


NAMES = r"(?:the\s+)?(?:(?:mit|apache|bsd|isc|zlib|boost\s+software|mozilla\s+public|eclipse\s+public|gnu\s+(?:lesser\s+|affero\s+)?general\s+public)\s+licen[cs]e|cc(?:\s+|-)by)"


def lines_of(piece):
    """The normalised lines of what lies between two full stops."""
    piece = re.sub(r"(https?://\S+)[ \t]", r"\1\n", piece)
    piece = re.sub(r"([;:][^a-z0-9\s]*)[ \t]", r"\1\n", piece)
    piece = re.sub(rf"\s(?:and|or)\s+({NAMES})", r"\nlicensed under \1", piece)
    piece = re.sub(r"spdx-license-identifier:\s*", "\nspdx license identifier ", piece)
    return [re.sub(r"^(?:[0-9]{1,2}|[a-z]|i{2,3}) (?=redistribution|neither |the )", "", plain(x)) for x in piece.split("\n")]


def by_hand(text):
    """Known sentences by trying every run of lines, rules by one walk over the identifiers after the other."""
    ids = []
    for piece in re.split(r"\.[^a-z0-9\s]*\s|\n\n+", (text or "").lower()):
        lines, at = lines_of(piece), 0
        while at < len(lines):
            for end in range(len(lines), at, -1):
                run = " ".join(lines[at:end])
                own = re.sub(r"^.*\bnor (?=the names of\b)", "nor ", run)
                if "" not in lines[at:end] and own in licenses.SENTENCES or end == at + 1:
                    break
            if run.startswith("spdx license identifier "):
                names = {n.lower().replace("-", " "): f"Tag {n}" for n in licenses.TAGGED}
                ids += [names.get(t, "?") for t in re.split(" (?:and|or(?! later)|with) ", run[24:])]
            elif any(c in run for c in licenses.CUES):
                ids.append(licenses.SENTENCES.get(own, "?"))
            at = end
    left, found = list(enumerate(ids)), []
    for name, sequence in licenses.RULES:
        wanted, own = sequence.split(","), []
        for x in left:
            if x[1] == wanted[len(own) % len(wanted)]:
                own.append(x)
        own = own[: len(own) - len(own) % len(wanted)]
        left = [x for x in left if x not in own]
        found += [name] * (bool(own) and name not in found)
    return ids, found


TEXTS = {
    "Text before.\nLicensed under the Apache License, Version 2.0.\nMore.": ["Apache-2.0"],
    "LICENSED!! UNDER!! CC!! BY-NC!! 4.0.!!\nx": ["CC-BY-NC-4.0"],
    "Released*** under### the MIT%%% License.&&& Licensed under CC BY 4.0. End": ["MIT", "CC-BY-4.0"],
    "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0"],
    "Our own license.": [],
    "all rights reserved": ["all rights reserved"],
    "free of any cue": [],
}


def test_known_texts(table):
    df = table("text string", *((t,) for t in TEXTS)).withColumn("ids", licenses.sentence_ids(F.col("text")))
    for r in df.withColumn("found", licenses.licences(F.col("ids"))).collect():
        assert r["found"] == TEXTS[r["text"]] == by_hand(r["text"])[1]
        assert r["ids"] == by_hand(r["text"])[0]


def test_sequences_before_single_sentences(table):
    mit = ["MITGrant", "MITNotice", "MITWarranty"]
    rows = [mit, mit[:2], mit[1:], ["GPL3Later", "GNUWarranty", "GPLSee", "GPL3Short"], ["?"], ["CCBY4", "CCBY4", "CCBY4", "MITShort"]]
    got = table("ids array<string>", *((r,) for r in rows)).select(licenses.licences(F.col("ids")).alias("f")).collect()
    assert [r["f"] for r in got] == [["MIT"], ["MIT"], [], ["GPL-3.0-or-later", "GPL-3.0"], [], ["MIT", "CC-BY-4.0"]]


def test_sentences_are_normalised_and_speak_of_licences():
    for sentence, name in licenses.SENTENCES.items():
        assert plain(sentence) == sentence and any(c in sentence for c in licenses.CUES)
    named = {i for _, s in licenses.RULES for i in s.split(",")}
    assert named <= {*licenses.SENTENCES.values(), *licenses.TAGS.values()}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
(2) Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details."""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License."""
ISC = """// Permission to use, copy, modify, and/or distribute this software for any
// purpose with or without fee is hereby granted, provided that the above
// copyright notice and this permission notice appear in all copies."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this"""
WRAPPED = {
    MIT: ("MITGrant,MITNotice,MITWarranty", "MIT"),
    BSD: ("BSDGrant,BSDSource,BSDBinary", "BSD-2-Clause"),
    GPL: ("GPL3Later,GNUWarranty,GPLSee", "GPL-3.0-or-later"),
    GPL.replace("sion 3", "sion 2").replace("\n", "\r\n"): ("GPL2Later,GNUWarranty,GPLSee", "GPL-2.0-or-later"),
    APACHE: ("Apache2Head,Apache2Use,Apache2Copy,?,Apache2Warranty,Apache2See", "Apache-2.0"),
    ISC: ("ISCGrant", "ISC"),
    MPL: ("MPL2Head", "MPL-2.0"),
    "Licensed under the\nLicensed under the\nMIT License": ("?,MITShort", "MIT"),
    "Licensed under the\n\nMIT License": ("?,?", ""),
    "licensed under the. MIT License\nAll rights\nreserved": ("?,?,AllRights", "all rights reserved"),
}


def test_wrapped_texts(table):
    df = table("text string", *((t,) for t in WRAPPED)).withColumn("ids", licenses.sentence_ids(F.col("text")))
    for r in df.withColumn("found", licenses.licences(F.col("ids"))).collect():
        assert (",".join(r["ids"]), ",".join(r["found"])) == WRAPPED[r["text"]], r["text"]


def test_every_sentence_wrapped_at_every_width(table):
    import textwrap

    rows = [(f"{mark} " + f"\n{mark} ".join(textwrap.wrap(s, n)), i) for s, i in licenses.SENTENCES.items() for mark in ("", " *") for n in (20, 30, 72, 1000)]
    got = table("text string, id string", *rows).select("id", licenses.sentence_ids(F.col("text")).alias("ids")).collect()
    assert all(r["ids"] == [r["id"]] for r in got)


ENDORSE = """
3. Neither the name of Foo, Inc. nor the
   names of its contributors may be used to endorse or promote products
   derived from this software without specific prior written permission."""
EXTRA = "\n\nThis extra sentence of ours speaks of a license.\n\n"
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:"""
FULL = {
    MIT.replace("\n\n", EXTRA): "MIT",
    MIT.split("\n\n")[0]: "MIT",
    BSD + ENDORSE: "BSD-3-Clause",
    BSD + EXTRA + ENDORSE.replace("Foo, Inc.", "the copyright holder"): "BSD-3-Clause",
    BSD + ENDORSE.replace("Foo, Inc. nor the\n   names", "the University of\n   X nor the names"): "BSD-3-Clause",
    BSD + ENDORSE + "\n\n" + BSD: "BSD-3-Clause,BSD-2-Clause",
    BSD.replace("2. R", "2. Also r"): "BSD-2-Clause",
    BSD.split("(2)")[0]: "BSD",
    GPL.replace("GNU General", "GNU Lesser General"): "LGPL-3.0-or-later",
    GPL.replace("GNU General", "GNU Affero General"): "AGPL-3.0-or-later",
    GPL.replace(" *\n", " *\n * Some extra license words.\n *\n"): "GPL-3.0-or-later",
    ZLIB: "Zlib",
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)": "BSL-1.0",
    "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/": "EPL-2.0",
}


def test_full_texts_with_other_sentences_between(table):
    df = table("text string", *((t,) for t in FULL)).withColumn("found", licenses.licences(licenses.sentence_ids(F.col("text"))))
    for r in df.collect():
        assert ",".join(r["found"]) == FULL[r["text"]], r["text"]


NOTICES = {
    APACHE.replace("\n#", ""): "Apache-2.0",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.': "Apache-2.0",
    "Licensed under the MIT license; see the LICENSE file.": "MIT",
    "Licensed under CC BY 4.0 and the MIT license.": "MIT,CC-BY-4.0",
    "Released under the MIT License or the\nApache License, Version 2.0": "Apache-2.0,MIT",
    "A web server such as nginx and Apache has no license": "",
    "SPDX-License-Identifier: MIT": "MIT",
    "SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 OR LGPL-3.0-or-later": "GPL-2.0-or-later,LGPL-3.0-or-later",
    "/* SPDX-License-Identifier: GPL-2.0-only */ ": "GPL-2.0",
    "# spdx-license-identifier: (MIT OR Apache-2.0) AND Own-1.0\ncode": "Apache-2.0,MIT",
    GPL.replace(" as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.", "\n * version 2 as published by the Free Software Foundation."): "GPL-2.0",
    GPL.replace("either version 3 of the License, or\n * (at your option) any later version", "version 3 of the License"): "GPL-3.0",
    MIT.replace("\n", " "): "MIT",
}


def test_notices_on_one_line_and_tags(table):
    df = table("text string", *((t,) for t in NOTICES)).withColumn("found", licenses.licences(licenses.sentence_ids(F.col("text"))))
    for r in df.collect():
        assert ",".join(r["found"]) == NOTICES[r["text"]], r["text"]
    ids = table("text string", *((t,) for t in NOTICES)).select("text", licenses.sentence_ids(F.col("text")).alias("ids")).collect()
    assert {r["text"]: ",".join(r["ids"]) for r in ids}[APACHE.replace("\n#", "")].replace("?,", "") == "Apache2Head,Apache2Use,Apache2Copy,Apache2Warranty,Apache2See"


def test_all_of_these_by_hand_and_in_sql(spark, table, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    texts = [*TEXTS, *WRAPPED, *FULL, *NOTICES, None, "", " \n\n.", *(f"{a}\n\n{b}" for a in WRAPPED for b in (BSD + ENDORSE, GPL, MIT))]
    texts += [f"{a} {b}" for a in NOTICES for b in NOTICES]
    table("doc_id bigint, text string, ids int", *((n, t, 1) for n, t in enumerate(texts))).write.parquet(str(tmp_path / "documents.parquet"))
    df = QUERIES["op10_licenses"](spark, str(tmp_path))
    mine = {r["doc_id"]: tuple(r) for r in df.collect()}
    for n, text in enumerate(texts):
        ids, found = by_hand(text)
        assert mine[n] == (n, ",".join(ids), ",".join(found), ids.count("?")), text
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.sql(SQL["op10_licenses"]).fetchall()) == sorted(mine.values())


def test_very_long_texts_take_linear_time(table):
    def seconds(n):
        text = "Licensed under the MIT License\n" * n + "Permission is hereby granted, free of license\n" * n + MIT * (n // 20)
        df = table("text string", (text,)).select(licenses.sentence_ids(F.col("text")).alias("ids"))
        begun = time.perf_counter()
        r = df.select(F.size("ids").alias("n"), licenses.licences(F.col("ids")).alias("found")).collect()[0]
        assert r["n"] >= 2 * n and r["found"] == ["MIT"]
        return time.perf_counter() - begun

    seconds(1000)
    small, large = seconds(4000), seconds(32000)
    assert large < 3 * 8 * max(small, 0.5)


def test_rules_take_out_what_they_match(table):
    bsd = ["BSDGrant", "BSDSource", "BSDBinary"]
    rows = [
        (["GPL2Later", "?", "GPL3Later", "x", "GNUWarranty", "GPLSee", "?"], ["GPL-3.0-or-later", "GPL-2.0-or-later"]),
        ([*bsd, "?", *bsd, "BSDEndorse"], ["BSD-3-Clause", "BSD-2-Clause"]),
        (["MITNotice", "?", "MITWarranty"], []),
        (["AllRights"] * 3000 + ["ISCGrant"], ["ISC", "all rights reserved"]),
        (None, []),
    ]
    got = table("ids array<string>, want array<string>", *rows).select("want", licenses.licences(F.col("ids")).alias("f")).collect()
    assert all(r["f"] == r["want"] for r in got)


def test_odd_rows(odd, nothing):
    got = odd.select(licenses.sentence_ids(F.col("text")).alias("ids")).collect()
    assert len(got) == len(ODD) and all(r["ids"] == [] for r in got)
    assert nothing.select(licenses.sentence_ids(F.col("text"))).collect() == []


def test_query(spark, sample):
    df = QUERIES["op10_licenses"](spark, FOLDER)
    got = {r["doc_id"]: r for r in df.collect()}
    for doc_id, text in sample[1]:
        ids, found = by_hand(text)
        r = got[doc_id]
        assert (r["sentences"], r["licences"], r["n_unknown"]) == (",".join(ids), ",".join(found), ids.count("?"))
    plan = df._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Exchange"))


def test_the_same_in_sql(spark, sample, rows):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    expected = con.sql(SQL["op10_licenses"])
    df = QUERIES["op10_licenses"](spark, FOLDER)
    assert df.columns == expected.columns and rows(df) == sorted(expected.fetchall(), key=repr)
