"""Operator 10: licence scan by canonical digest lookup.

Whole texts and their single lines are normalised (case, punctuation, copyright and title lines, equivalent spellings, what follows
the end of the terms), hashed, and joined with the digests of known texts, a fixed table small enough to broadcast. Every
known text speaks of a licence, copyright, warranty, permission or the public domain, so texts and lines without any of
these words match none and are not normalised. ``known_texts`` and ``LONG_DIGESTS`` name all that is known; any other
licence is reported only by its identifier line, if that is known.

Null and empty texts match none; null ids and repeated rows are each reported, every row once; licences that tie in a line are
all listed, in order; very long texts are normalised whole; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..shipping import materialize

# Public licence notices, identifiers and short licence texts.
IDENTIFIERS = "0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 EUPL-1.2 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-2.0 MS-PL OFL-1.1 Unlicense WTFPL Zlib".split()
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\");", "Released under the Apache License 2.0."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License v3.0."],
    "ISC": ["Released under the ISC License."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'
_MIT_END = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
TEXTS = {
    "0BSD": [f"{_ISC}. {_ISC_END}"],
    "BSD-2-Clause": [_BSD + _AS_IS],
    "BSD-3-Clause": [_BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _AS_IS],
    "ISC": [f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies."],
    "MIT": [f"{_MIT}, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_MIT_END}"],
    "MIT-0": [f"{_MIT}. {_MIT_END}"],
    "Unlicense": [
        'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>'
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ],
}
# SHA-256 of long licence texts as ``canonical`` gives them.
LONG_DIGESTS = {
    "Apache-2.0": "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f",
    "Artistic-1.0-Perl": "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2",
    "CC0-1.0": "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    "GFDL-1.2": "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b",
    "GFDL-1.3": "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d",
    "GPL-1.0": "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70",
    "GPL-2.0": "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808",
    "GPL-3.0": "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191",
    "LGPL-2.0": "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2",
    "LGPL-2.1": "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6",
    "MPL-2.0": "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d",
}
#: One of these stands in every known text.
KEYWORDS = "(?i)licen[cs]|copyright|warrant|permission|public domain"
_STEPS = [
    # What follows the terms, copyright lines, title lines.
    ("(?s)\\n[^\\p{L}\\p{N}\\n]*end of terms and conditions.*", " "),
    ("(?md)^[^\\p{L}\\p{N}\\n]*(?:copyright|\\(c\\)|©)[ \\t]*(?:\\(c\\)|©|[0-9]{4}|[<\\[{]|by )[^\\n]*", " "),
    ("(?md)^[^\\p{L}\\p{N}\\n]*all rights reserved[^\\p{L}\\p{N}\\n]*$", " "),
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("https://", "http://"),
    ("[^\\p{L}\\p{N}]+", " "),
    ("^ ", ""),
    (" $", ""),
    ("^(?:the )?(?:mit|isc|mit no attribution|zero clause bsd|bsd zero clause|zlib|the unlicense|bsd [23] clause(?: (?:simplified|new|revised|new or revised))?) license(?: (?:mit|isc))? ", ""),
    ("all rights reserved (redistribution and use in source)", "$1"),
    ("neither the name of .{1,80}? nor the names of (?:its|their|any) contributors", "neither the name of the copyright holder nor the names of its contributors"),
    ("in no event shall .{1,60}? or contributors be liable", "in no event shall the copyright holder or contributors be liable"),
    ("provided by .{1,60}? as is and any express", "provided by the copyright holders and contributors as is and any express"),
]


def canonical(text: Column) -> Column:
    """Null for texts without any of ``KEYWORDS``."""
    out = F.lower(text)
    for a, b in _STEPS:
        out = F.regexp_replace(out, a, b)
    return F.when(text.rlike(KEYWORDS), out)


def canonical_sql(text: str) -> str:
    """The same as an expression of a dialect whose patterns are linear-time ones."""
    out = f"lower({text})"
    for a, b in _STEPS:
        out = "regexp_replace({}, '{}', '{}', 'g')".format(out, a.replace("(?md)", "(?m)"), b.replace("$1", "\\1"))
    return f"CASE WHEN regexp_matches({text}, '{KEYWORDS}') THEN {out} END"


def known_texts() -> list[tuple[str, str]]:
    """(licence, text) of all notices, identifier lines and short licences."""
    out = [(k, t) for table in (NOTICES, TEXTS) for k, ts in table.items() for t in ts]
    return out + [(i.removesuffix("-only").removesuffix("-or-later"), f"SPDX-License-Identifier: {i}") for i in IDENTIFIERS]


def known_digests(spark) -> DataFrame:
    """(digest, license) of all that is known: a fixed number of rows."""
    rows = spark.createDataFrame(known_texts(), "license string, text string").select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license")
    return rows.unionByName(spark.createDataFrame([(d, k) for k, d in LONG_DIGESTS.items()], "digest string, license string")).distinct()


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, whole_license (or null), notices: licences of single lines in order, joined by commas, and n_notices."""
    known = F.broadcast(known_digests(docs.sparkSession))  # some 80 rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    # Digests of what may match: of few texts and lines.
    lines = F.filter(F.array_distinct(F.split("t", "\\n")), lambda x: x.rlike(KEYWORDS))
    found = rows.select("doc_id", F.sha2(canonical(F.col("t")), 256).alias("whole"), F.when(F.col("t").rlike(KEYWORDS), F.transform(lines, lambda x: F.sha2(canonical(x), 256))).alias("lines"))
    found = materialize(found.withColumn("row", F.monotonically_increasing_id()), "digests")
    whole = found.join(known.select(F.col("digest").alias("whole"), F.col("license").alias("whole_license")), "whole", "left").select("row", "doc_id", "whole_license")
    noted = found.select("row", F.explode("lines").alias("digest")).join(known, "digest").groupBy("row").agg(F.sort_array(F.collect_set("license")).alias("notices"))
    notices = F.coalesce("notices", F.array().cast("array<string>"))
    return whole.join(noted, "row", "left").select("doc_id", "whole_license", F.array_join(notices, ",").alias("notices"), F.size(notices).cast("long").alias("n_notices"))


def scan_sql() -> str:
    """``scan`` of ``documents`` in SQL."""
    quoted = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in known_texts())
    long = "".join(f" UNION SELECT '{d}', '{k}'" for k, d in LONG_DIGESTS.items())
    return f"""WITH k AS (SELECT DISTINCT sha256({canonical_sql("t")}) AS digest, license FROM (VALUES {quoted}) v(license, t){long}),
        d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        l AS (SELECT DISTINCT doc_id, unnest(string_split(t, chr(10))) AS line FROM d WHERE regexp_matches(t, '{KEYWORDS}')),
        n AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(DISTINCT license) AS n_notices FROM l JOIN k ON k.digest = sha256({canonical_sql("line")}) GROUP BY doc_id)
        SELECT d.doc_id, k.license AS whole_license, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
        FROM d LEFT JOIN k ON k.digest = sha256({canonical_sql("t")}) LEFT JOIN n ON n.doc_id = d.doc_id"""
