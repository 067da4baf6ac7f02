"""Licence scans by canonical digests.

A text is brought to a canonical form: lower case, copyright lines, list markers and
lines that only title a short licence dropped, every run of punctuation and blanks one
space, equivalent spellings one spelling. The canonical whole document, each of its
blocks between empty lines and each of its lines are then texts of their own, whose
digests are hash-joined to the digests of the known texts in ``KNOWN``, brought to the
same form. A known text of several blocks is also found inside a document: the digests
of its blocks are joined too, and it is there where all of them stand one after the
other. Identifiers in ``SPDX-License-Identifier`` lines are looked up one by one. A text
matches as a whole or not at all. Everything is DataFrame functions.

``BSD`` stands for the opening of the conditions alone and gives way to the licence that
a document names more closely. The long licences (GNU, Apache, Mozilla, Creative
Commons) are known by their headings, standard headers and notices; ``known`` takes
their full texts as any others.

Null, empty and blank documents hold no licence. Of a very long document every
line is looked up. Repeated rows get equal results, a licence found twice counts
once, names come in order. Only the id and text columns are read; an empty table
gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.staging import stage

# Public licence texts, headings, standard headers and notices, by SPDX name.
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD_OPENING = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:"""
_BSD_CONDITIONS = (
    """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.""",
    """2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.""",
    """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.""",
)
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_TEXTS = (
    (
        "MIT",
        f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

{_MIT_WARRANTY}""",
    ),
    (
        "ISC",
        f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

{_ISC_WARRANTY}""",
    ),
    (
        "0BSD",
        f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

{_ISC_WARRANTY}""",
    ),
    (
        "Unlicense",
        f"""This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

{_MIT_WARRANTY.replace("AUTHORS OR" + chr(10) + "COPYRIGHT HOLDERS", "AUTHORS")}""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    (
        "CC0-1.0",
        """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to
this software to the public domain worldwide. This software is distributed without any warranty.""",
    ),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007"),
    ("Apache-2.0", "Apache License\nVersion 2.0, January 2004"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
_NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("BSD", _BSD_OPENING.replace("\n", " ")),
)
# SPDX identifiers of common licences, beside those of the families below.
_SPDX = """MIT MIT-0 ISC 0BSD BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause Apache-1.1 Apache-2.0
Artistic-1.0 Artistic-2.0 BSL-1.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CPL-1.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 MPL-1.0 MPL-1.1
MPL-2.0 MS-PL MS-RL NCSA ODbL-1.0 OFL-1.1 OpenSSL PostgreSQL Python-2.0 Ruby Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib
ZPL-2.1""".split()
# GNU licences, their names and versions; Creative Commons licences, their names.
_GNU = (
    ("GPL", "General Public License", ("1.0", "2.0", "3.0")),
    ("LGPL", "Library General Public License", ("2.0",)),
    ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
    ("AGPL", "Affero General Public License", ("3.0",)),
)
_COMMONS = (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
_TAG = "SPDX-License-Identifier: "


def _bsd() -> list[tuple[str, str]]:
    """Both BSD texts, with the blocks that their files are divided into."""
    out = []
    for n in (2, 3):
        conditions = _BSD_CONDITIONS[:n]
        together = "\n".join(conditions)
        for blocks in ([_BSD_OPENING, *conditions], [_BSD_OPENING, together], [f"{_BSD_OPENING}\n{together}"]):
            out.append((f"BSD-{n}-Clause", "\n\n".join([*blocks, _BSD_WARRANTY])))
    return out


def _gnu() -> list[tuple[str, str]]:
    """Grants of the GNU licences, the first block of their standard headers, and their tags."""
    out = []
    for code, title, versions in _GNU:
        for full in versions:
            name, later, version = f"{code}-{full}", f"{code}-{full}-or-later", full.removesuffix(".0")
            out += [(name, f"{_TAG}{name}"), (name, f"{_TAG}{name}-only"), (later, f"{_TAG}{later}"), (later, f"{_TAG}{name}+")]
            for thing in ("program", "library", "software", "file"):
                free = f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the GNU"
                by = "as published by the Free Software Foundation"
                out.append((later, f"{free} {title} {by}; either version {version} of the License, or (at your option) any later version."))
                out.append((name, f"{free} {title} version {version} {by}."))
                out.append((name, f"{free} {title} {by}, version {version}."))
    return out


def _commons() -> list[tuple[str, str]]:
    out = []
    for code, title in _COMMONS:
        for version, place in (("4.0", "International"), ("3.0", "Unported")):
            name, licence = f"CC-{code}-{version}", f"Creative Commons {title} {version} {place} License"
            out += [
                (name, f"{_TAG}{name}"),
                (name, f"Licensed under CC {code} {version}."),
                (name, f"This work is licensed under CC {code} {version}."),
                (name, f"This work is licensed under a {licence}."),
                (name, f"This work is licensed under the {licence}."),
            ]
    return out


KNOWN: tuple[tuple[str, str], ...] = (
    *_TEXTS,
    *_NOTICES,
    *_bsd(),
    *_gnu(),
    *_commons(),
    *[(name, f"{_TAG}{name}") for name in _SPDX],
)
# Spellings that count as equal, in canonical form.
EQUIVALENT: tuple[tuple[str, str], ...] = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("noncommercial", "non commercial"),
    ("sharealike", "share alike"),
    ("noderivatives", "no derivatives"),
    ("noderivs", "no derivatives"),
    ("ver", "version"),
    ("v", "version"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("authorised", "authorized"),
    ("https", "http"),
    ("whilst", "while"),
    ("wilful", "willful"),
)
#: A line that names a holder: the word or sign, then a year or "by"; or that all rights are reserved.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n]*(((copyright|\(c\)|©)[ \t,:]*)+(\d{4}|by |<year>|\[year\])[^\n]*"
    r"|all rights reserved[^\p{L}\p{N}\n]*)$"
)

#: Numbers and letters that open a condition of a list.
LIST_MARK = r"(?m)^[^\p{L}\p{N}\n]*(\d{1,2}|[a-z])[.)][ \t]+"
#: A line, in canonical form, that only titles a short licence whose text says the rest.
TITLE_LINE = (
    r"(?m)^ ?(the )?(mit|isc|expat|zlib|unlicense|0bsd|(new |modified |simplified |revised )?(bsd( \d clause)?|\d clause bsd))"
    r"( license)?( mit| expat| isc)?( header| text)? ?$"
)


def canonical(text: Column) -> Column:
    """Canonical text: one line for each line, words parted by single spaces."""
    low = F.lower(F.coalesce(text, F.lit("")))
    # A plus behind an identifier is a word of it.
    plus = F.regexp_replace(low, r"(spdx-license-identifier:[^\n+]*)\+", "$1-plus")
    low = F.when(low.contains("spdx-license-identifier"), plus).otherwise(low)
    kept = F.regexp_replace(F.regexp_replace(low, "\r\n?", "\n"), COPYRIGHT_LINE, "\n")
    kept = F.regexp_replace(kept, LIST_MARK, "")
    spaced = F.regexp_replace(kept, r"[^\p{L}\p{N}\n]+", " ")
    spaced = F.regexp_replace(spaced, TITLE_LINE, "")
    numbered = F.regexp_replace(spaced, r"\bv(\d)", "version $1")
    same = reduce(lambda t, pair: F.regexp_replace(t, rf"\b{pair[0]}\b", pair[1]), EQUIVALENT, numbered)
    # One look for any spelling spares most texts the single replacements.
    return F.when(numbered.rlike(rf"\b({'|'.join(a for a, _ in EQUIVALENT)})\b"), same).otherwise(numbered)


def _joined(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def _blocks(form: Column) -> Column:
    """The blocks of a canonical text that hold a word."""
    return F.filter(F.transform(F.split(form, r"\n[ \n]*\n"), _joined), lambda b: b != "")


def _tags(text: Column) -> Column:
    """A canonical tag for each identifier of the SPDX expressions in a text; exceptions are left out."""
    said = F.regexp_extract_all(text, F.lit(r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9 ().+:-]+)"), F.lit(1))
    plain = F.transform(said, lambda e: F.regexp_replace(e, r"(?i)[()]|\bwith[ \t]+[^ \t()]+", " "))
    names = F.flatten(F.transform(plain, lambda e: F.split(e, r"(?i)[ \t]+(and|or)[ \t]+")))
    tags = F.transform(names, lambda n: _joined(canonical(F.concat(F.lit(_TAG), F.trim(n)))))
    return F.when(F.lower(text).contains("spdx-license-identifier"), tags)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``digest`` of the known texts and of the blocks of those that have several.

    ``n_parts`` is the number of blocks that a text of that ``license`` needs, ``part``
    the place of this one; a whole text is one part.
    """
    texts = spark.createDataFrame([(i, *pair) for i, pair in enumerate(known)], "known int, license string, body string")
    form = texts.select("known", "license", canonical(F.col("body")).alias("_form"))
    blocks = _blocks(F.col("_form"))
    whole = form.select("known", "license", F.lit(1).alias("n_parts"), F.lit(0).alias("part"), _joined(F.col("_form")).alias("unit"))
    parts = form.where(F.size(blocks) > 1).select(
        "known", "license", F.size(blocks).alias("n_parts"), F.posexplode(blocks).alias("part", "unit")
    )
    digest = F.sha2("unit", 256).alias("digest")
    return whole.unionByName(parts).where("unit <> ''").select("known", "license", "n_parts", "part", digest)


def scan(
    docs: DataFrame,
    known: tuple[tuple[str, str], ...] = KNOWN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id, ``whole_license`` of the entire text, and all ``licenses`` parted by bars."""
    keyed = docs.select(F.col(id_col), F.col(text_col).alias("_text")).withColumn("_content", F.xxhash64("_text"))
    form = keyed.select(id_col, "_content", canonical(F.col("_text")).alias("_form"), _tags(F.col("_text")).alias("_tags"))
    unit = lambda kind, place, text: F.struct(F.lit(kind).alias("kind"), place.alias("place"), text.alias("unit"))
    nowhere = F.lit(0)
    lines = F.split("_form", "\n")
    texts = F.concat(
        F.array(unit("whole", nowhere, _joined(F.col("_form")))),
        F.transform(_blocks(F.col("_form")), lambda b, place: unit("block", place, b)),
        F.transform(lines, lambda line: unit("line", nowhere, _joined(line))),
        F.transform(F.coalesce("_tags", F.array().cast("array<string>")), lambda t: unit("line", nowhere, t)),
    )
    units = form.select(F.col(id_col).alias("_id"), F.col("_content").alias("_c"), F.inline(texts)).where("unit <> ''")
    # Written, the digests have a known size, which decides how they are joined.
    digests = stage(known_digests(docs.sparkSession, known), "licence-digests")
    several = F.col("n_parts") > 1
    hits = (
        units.select("_id", "_c", "kind", "place", F.sha2("unit", 256).alias("digest"))
        .join(digests, "digest")
        .where(~several | (F.col("kind") == "block"))
        .groupBy("_id", "_c", "known", "license", "n_parts", F.when(several, F.col("place") - F.col("part")).alias("shift"))
        .agg(F.count_distinct("part").alias("n"), F.max(F.col("kind") == "whole").alias("whole"))
        .where("n = n_parts")
    )
    closer = lambda found: F.exists(found, lambda x: x.startswith("BSD-"))
    found = (
        hits.groupBy("_id", "_c")
        .agg(F.min(F.when(F.col("whole"), F.col("license"))).alias("whole_license"), F.collect_set("license").alias("_all"))
        .select(
            "_id", "_c", "whole_license",
            F.array_join(F.array_sort(F.when(closer(F.col("_all")), F.array_remove("_all", "BSD")).otherwise(F.col("_all"))), "|").alias("licenses"),
        )
    )
    return (
        keyed.select(id_col, "_content")
        .join(found, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_content") == F.col("_c")), "left")
        .select(id_col, "whole_license", F.coalesce("licenses", F.lit("")).alias("licenses"))
    )
