"""Licence scans: normalised sentences to sentence identifiers, identifier sequences to ordered rules.

A text is cut at full stops followed by white space and at blank lines, and what lies between into lines. A line also
ends after a semicolon or colon, after a web address, and before a second licence of a notice ("... and the MIT license", which
reads as a notice of its own). Lines are normalised to letters and digits, words separated by one space, all in lower case; inner
full stops of version numbers stay. A line is a sentence of its own, unless it and the next ones are together a known sentence that
was wrapped, of which the longest counts; lines of signs alone end a sentence. Signs before a
line, as in comments, do not matter, nor do the marks of a list. A sentence known to a licence text gets its identifier; one that is not known but speaks
of licensing counts as unknown. An SPDX tag gives one identifier for each licence of its expression. The identifiers of a text, in order, form a sequence, on which the
rules are tried in their order. A rule matches its identifiers in their order, whatever stands between them; what it
has matched is taken out, as often as it occurs, and what stands between stays. So a general rule after a
special one does not match the same again, and a text can have several licences.

Only built-in functions are used, row by row, without a shuffle, in time linear in the text. Null, empty and blank texts have no
sentences, no licence and no unknown sentences. Repeated rows get equal results; all functions work on one column.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The licences an SPDX tag may name, and how a tag begins once normalised.
TAGGED = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "EPL-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
TAG = "spdx license identifier "
#: Normalised names to identifiers; the "or" of a name is not the one between two names.
TAGS = {name.lower().replace("-", " ").replace(" or later", " orlater"): f"Tag {name}" for name in TAGGED}
# Sentences of public licence texts and notices, normalised, with their identifiers.
SENTENCES = {
    "licensed under the apache license version 2.0": "ApacheShort2",
    "licensed under the apache license version 2.0 the license": "Apache2Head",
    "you may not use this file except in compliance with the license": "Apache2Use",
    "you may obtain a copy of the license at": "Apache2Copy",
    "you may obtain a copy of the license at http www apache org licenses license 2.0": "Apache2Copy",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "Apache2Copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "Apache2Warranty",
    "see the license for the specific language governing permissions and limitations under the license": "Apache2See",
    "released under the mit license": "MITShort",
    "licensed under the mit license": "MITShort",
    "this software is released under the mit license": "MITShort",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITWarranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    **{
        f"nor the names of {whose} may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse"
        for whose in ("its contributors", "their contributors", "any contributors", "other contributors", "the contributors", "contributors")
    },
    "licensed under the bsd license": "BSDShort",
    "released under the bsd license": "BSDShort",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "licensed under the isc license": "ISCShort",
    "this work is licensed under the gnu general public license version 2": "GPL2Short",
    "this work is licensed under the gnu general public license version 3": "GPL3Short",
    "licensed under the gnu general public license version 2": "GPL2Short",
    "licensed under the gnu general public license version 3": "GPL3Short",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3Later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "LGPL21Later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3Later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3.0 of the license or at your option any later version": "LGPL3Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "LGPL21Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPL3Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation version 3": "AGPL3Short",
    **{
        f"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license {how}": f"GPL{n}Short"
        for n in (2, 3)
        for how in (f"version {n} as published by the free software foundation", f"as published by the free software foundation version {n} of the license", f"as published by the free software foundation version {n}")
    },
    **{
        f"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license {how}": "LGPL21Short"
        for how in ("version 2.1 as published by the free software foundation", "as published by the free software foundation version 2.1 of the license")
    },
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GNUWarranty",
    "see the gnu lesser general public license for more details": "GPLSee",
    "see the gnu affero general public license for more details": "GPLSee",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 which accompanies this distribution and is available at http www.eclipse.org legal epl v10.html": "EPL1Head",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0": "EPL1Head",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www.eclipse.org legal epl 2.0": "EPL2Head",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at http www.eclipse.org legal epl 2.0": "EPL2Head",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0": "EPL2Head",
    "licensed under the eclipse public license version 1.0": "EPL1Head",
    "licensed under the eclipse public license version 2.0": "EPL2Head",
    "this software is provided as is without any express or implied warranty": "ZlibWarranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "licensed under the zlib license": "ZlibShort",
    "released under the zlib license": "ZlibShort",
    "distributed under the boost software license version 1.0": "BSLShort",
    "licensed under the boost software license version 1.0": "BSLShort",
    "boost software license version 1.0": "BSLShort",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "BSLGrant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GNUWarranty",
    "see the gnu general public license for more details": "GPLSee",
    "licensed under the gnu lesser general public license version 3": "LGPL3Short",
    "licensed under the gnu affero general public license version 3": "AGPL3Short",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "MPL2Head",
    "this source code form is subject to the terms of the mozilla public license v": "MPL2Head",
    "licensed under the mozilla public license version 2.0": "MPL2Head",
    "licensed under cc by 4.0": "CCBY4",
    "licensed under cc by sa 4.0": "CCBYSA4",
    "licensed under cc by nc 4.0": "CCBYNC4",
    "licensed under cc by nc sa 4.0": "CCBYNCSA4",
    "licensed under cc by nd 4.0": "CCBYND4",
    "licensed under cc by nc nd 4.0": "CCBYNCND4",
    "this work is licensed under a creative commons attribution 4.0 international license": "CCBY4",
    "this work is licensed under a creative commons attribution sharealike 4.0 international license": "CCBYSA4",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "CC0Waiver",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "all rights reserved": "AllRights",
}
# The rules in their order; the identifiers of a rule come in this order, with any others between.
RULES = (
    ("Apache-2.0", "Apache2Head,Apache2Use,Apache2Copy,Apache2Warranty,Apache2See"),
    ("Apache-2.0", "Apache2Head,Apache2Use"),
    ("Apache-2.0", "Apache2Head"),
    ("Apache-2.0", "ApacheShort2"),
    ("MIT", "MITGrant,MITNotice,MITWarranty"),
    ("MIT", "MITGrant,MITNotice"),
    ("MIT", "MITGrant,MITWarranty"),
    ("MIT", "MITGrant"),
    ("MIT", "MITShort"),
    ("BSD-3-Clause", "BSDGrant,BSDSource,BSDBinary,BSDEndorse"),
    ("BSD-3-Clause", "BSDGrant,BSDEndorse"),
    ("BSD-2-Clause", "BSDGrant,BSDSource,BSDBinary"),
    ("BSD", "BSDGrant,BSDSource"),
    ("BSD", "BSDGrant"),
    ("BSD", "BSDSource"),
    ("BSD", "BSDShort"),
    ("ISC", "ISCGrant"),
    ("ISC", "ISCShort"),
    ("GPL-3.0-or-later", "GPL3Later,GNUWarranty,GPLSee"),
    ("GPL-3.0-or-later", "GPL3Later"),
    ("GPL-2.0-or-later", "GPL2Later,GNUWarranty,GPLSee"),
    ("GPL-2.0-or-later", "GPL2Later"),
    ("LGPL-3.0-or-later", "LGPL3Later,GNUWarranty,GPLSee"),
    ("LGPL-3.0-or-later", "LGPL3Later"),
    ("LGPL-2.1-or-later", "LGPL21Later,GNUWarranty,GPLSee"),
    ("LGPL-2.1-or-later", "LGPL21Later"),
    ("AGPL-3.0-or-later", "AGPL3Later,GNUWarranty,GPLSee"),
    ("AGPL-3.0-or-later", "AGPL3Later"),
    ("GPL-3.0", "GPL3Short"),
    ("GPL-2.0", "GPL2Short"),
    ("LGPL-3.0", "LGPL3Short"),
    ("LGPL-2.1", "LGPL21Short"),
    ("AGPL-3.0", "AGPL3Short"),
    ("MPL-2.0", "MPL2Head"),
    ("EPL-1.0", "EPL1Head"),
    ("EPL-2.0", "EPL2Head"),
    ("Zlib", "ZlibWarranty,ZlibGrant"),
    ("Zlib", "ZlibGrant"),
    ("Zlib", "ZlibShort"),
    ("BSL-1.0", "BSLShort,BSLGrant"),
    ("BSL-1.0", "BSLGrant"),
    ("BSL-1.0", "BSLShort"),
    ("CC-BY-4.0", "CCBY4"),
    ("CC-BY-SA-4.0", "CCBYSA4"),
    ("CC-BY-NC-4.0", "CCBYNC4"),
    ("CC-BY-NC-SA-4.0", "CCBYNCSA4"),
    ("CC-BY-ND-4.0", "CCBYND4"),
    ("CC-BY-NC-ND-4.0", "CCBYNCND4"),
    ("CC0-1.0", "CC0Waiver"),
    ("Unlicense", "Unlicense"),
    ("all rights reserved", "AllRights"),
    *((name.removesuffix("-only"), f"Tag {name}") for name in TAGGED),
)
# Every known sentence has one of these in it, and so has a sentence that counts as unknown.
CUES = ("licens", "copyright", "permission", "redistribut", "warrant", "free software", "unencumbered", "rights reserved")
UNKNOWN = "?"
STOPS, OTHERS = "\\.[^a-z0-9\\s]*\\s|\n\n+", "[^a-z0-9.]+"
MARK = "^([0-9]{1,2}|[a-z]|i{2,3}) (?=redistribution|neither |the )"
# How a second licence of a notice is named, after "and" or "or"; it is read as this notice.
SECOND = "(?:the )?(?:(?:mit|apache|bsd|isc|zlib|boost software|mozilla public|eclipse public|gnu (?:lesser |affero )?general public) licen[cs]e|cc(?: |-)by)"
NOTICE = "licensed under "
# What a line ends with beside a line end, and what is put there: patterns and replacements, in this order.
ENDS = (
    ("(https?://[^\\s]+)[ \t]", "$1\n"),
    ("([;:][^a-z0-9\\s]*)[ \t]", "$1\n"),
    (f"\\s(?:and|or)\\s+({SECOND.replace(' ', chr(92) + 's+')})", f"\n{NOTICE}$1"),
    ("spdx-license-identifier:\\s*", f"\n{TAG}"),
)
# The third clause of BSD names a holder, who may be anyone: of the sentence counts what comes after.
HOLDER = "^.*\\bnor(?= the names of\\b)"
# One search finds the sentences of some lines: at a line start the longest known one, of which any blank may be a line end, else the line.
_wrapped = lambda s: re.escape(s).replace("\\ ", "[ \n]")
LINES = "(?m)^(?:" + "|".join(
    ("(?:[^\n]* )?" if i == "BSDEndorse" else "") + _wrapped(s) for s, i in sorted(SENTENCES.items(), key=lambda x: (-len(x[0]), x[0]))
) + "|[^\n]+)$"
# What is gathered one by one is kept in blocks of this length, so that adding to it copies little.
BLOCK = 512


def _speaks(text: Column) -> Column:
    out = F.lit(False)
    for cue in CUES:
        out = out | F.contains(text, F.lit(cue))
    return out


def normalised(sentence: Column) -> Column:
    """Letters, digits and inner full stops of a lower-case sentence, everything else as one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(sentence, OTHERS, " "), "(^|\\s)\\.+|\\.+($|\\s)", " "))


def _entry(entries: dict[str, str], key: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in entries.items() for x in pair)), key), F.lit(UNKNOWN))


def _named(found: Column) -> Column:
    """array<string>: the identifiers of one sentence: one if it is known, ? if it speaks of licensing, one a licence of a tag."""
    sentence = F.translate(found, "\n", " ")
    own = F.when(F.contains(sentence, F.lit(" nor ")), F.regexp_replace(sentence, HOLDER, "nor")).otherwise(sentence)
    names = F.replace(F.substring(sentence, len(TAG) + 1, 1 << 30), F.lit(" or later"), F.lit(" orlater"))
    tagged = F.transform(F.split(names, " (?:and|or|with) "), lambda name: _entry(TAGS, name))
    return (
        F.when(~_speaks(sentence), F.array().cast("array<string>"))
        .when(F.startswith(sentence, F.lit(TAG)), tagged)
        .otherwise(F.array(_entry(SENTENCES, own)))
    )


def sentence_ids(text: Column) -> Column:
    """array<string>: the identifiers of a text's known sentences in order, ? for an unknown one."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    plain = lambda s: F.regexp_replace(F.regexp_replace(normalised(s), " +", " "), MARK, "")
    may_speak = lambda s: _speaks(s) | F.contains(s, F.lit("free")) | F.contains(s, F.lit("rights"))

    def lines(piece):
        for pattern, to in ENDS:
            piece = F.regexp_replace(piece, pattern, to)
        return F.array_join(F.transform(F.split(piece, "\n"), plain), "\n")

    # a function of one variable, so that what is looked up more than once is worked out once
    named = lambda s: F.flatten(F.transform(F.regexp_extract_all(lines(s), F.lit(LINES), F.lit(0)), _named))
    found = F.flatten(F.transform(F.filter(F.split(lower, STOPS), may_speak), named))
    return F.when(may_speak(lower), found).otherwise(F.array().cast("array<string>"))


def licences(ids: Column) -> Column:
    """array<string>: the licences of a sequence of identifiers, each once, in the order of the rules."""
    codes = {name: n for n, name in enumerate(sorted({i for _, sequence in RULES for i in sequence.split(",")}))}
    coded = F.create_map(*(F.lit(x) for name, n in codes.items() for x in (name, n << 32)))
    sequences = [F.array(*(F.lit(codes[i]).cast("bigint") for i in sequence.split(","))) for _, sequence in RULES]
    rules = F.array(*(F.struct(F.lit(name).alias("name"), sequence.alias("sequence")) for (name, _), sequence in zip(RULES, sequences)))
    # an identifier's code and its place in one number, so no two are equal
    left = F.filter(F.transform(ids, lambda i, at: F.try_element_at(coded, i) + at), lambda x: x.isNotNull())
    start = F.struct(left.alias("left"), F.array().cast("array<string>").alias("found"))

    code = lambda x: F.call_function("shiftright", x, F.lit(32))

    def matched(left, sequence):
        """What a rule matches, one time after the other."""
        met = lambda seen, x: code(x) == F.get(sequence, seen["n"] % F.size(sequence))
        state = lambda n, full, own: F.struct(n.alias("n"), full.alias("full"), own.alias("own"))
        none = F.array().cast("array<bigint>")

        def add(seen, x):
            whole = F.size(seen["own"]) >= BLOCK
            full = F.when(whole, F.array_append(seen["full"], seen["own"])).otherwise(seen["full"])
            own = F.when(whole, F.array(x)).otherwise(F.array_append(seen["own"], x))
            return F.when(met(seen, x), state(seen["n"] + 1, full, own)).otherwise(seen)

        all_of = lambda seen: F.concat(F.flatten(seen["full"]), seen["own"])
        start = state(F.lit(0), F.array().cast("array<array<bigint>>"), none)
        several = F.aggregate(left, start, add, lambda seen: F.slice(all_of(seen), 1, seen["n"] - seen["n"] % F.size(sequence)))
        one = F.filter(left, lambda x: code(x) == sequence[0])
        return F.when(F.size(sequence) == 1, one).when(F.exists(left, lambda x: code(x) == sequence[0]), several).otherwise(none)

    def step(state, rule):
        without = lambda own: F.struct(F.array_except(state["left"], own).alias("left"), F.array_append(state["found"], rule["name"]).alias("found"))
        after = lambda own: F.when(F.size(own) > 0, without(own)).otherwise(state)
        return F.transform(F.array(matched(state["left"], rule["sequence"])), after)[0]

    found = F.aggregate(rules, start, step, lambda s: F.array_distinct(s["found"]))
    return F.when(F.exists(ids, lambda i: i != UNKNOWN), found).otherwise(F.array().cast("array<string>"))
