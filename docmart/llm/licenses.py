"""Licence scan by canonical digest lookup.

A text is brought to a canonical form: A-Z in lower case, copyright lines dropped, every run of
other characters than letters and digits one blank, equivalent spellings replaced. The SHA-256
of the canonical form of an entire text is hash-joined to the digests of known licences and
notices, which are made by the same expression from the texts below. The table of known digests
is this fixed list, so it can be broadcast.

Beside whole texts, lines are looked up the same way, so that one-line notices inside a document are
found: a line counts only if the entire line is a known text. Lines that are longer than every known
text or hold none of the cue words, one of which every known text holds, can't be known; the others are
exploded, hash-joined by their digest and gathered again by document.

Only DataFrame functions, one pass over the texts; texts are not shuffled.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.llm.common import materialize

# FIXED: equivalent spellings, in the order they are applied.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("sublicence", "sublicense"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("acknowledgement", "acknowledgment"), ("per cent", "percent"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("wilful", "willful"), ("whilst", "while"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("modified bsd", "bsd 3 clause"), ("v2", "version 2"), ("v3", "version 3"), ("https", "http"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted"""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""

# FIXED: verbatim texts beside this module, read by the driver only.
FILES = (
    ("Apache-2.0", "Apache-2.0"), ("CC0-1.0", "CC0-1.0"), ("GPL-1.0-only", "GPL-1"), ("GPL-2.0-only", "GPL-2"),
    ("GPL-3.0-only", "GPL-3"), ("LGPL-2.0-only", "LGPL-2"), ("LGPL-2.1-only", "LGPL-2.1"), ("LGPL-3.0-only", "LGPL-3"),
    ("MPL-1.1", "MPL-1.1"), ("MPL-2.0", "MPL-2.0"),
)
# FIXED: title lines that may stand above a text.
TITLES = {
    "MIT": ("The MIT License (MIT)", "The MIT License", "MIT License (MIT)"),
    "ISC": ("The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License",
                     "BSD 2-Clause \"Simplified\" License", "Simplified BSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License",
                     "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "Modified BSD License", "BSD License"),
}


def _files() -> list[tuple[str, str]]:
    """The texts of ``FILES``, and each up to the end of its terms, without the appendix."""
    out, end = [], "END OF TERMS AND CONDITIONS"
    for spdx, name in FILES:
        text = (Path(__file__).parent / "license_texts" / f"{name}.txt").read_text(encoding="utf-8")
        out.append((spdx, text))
        if end in text:
            out.append((spdx, text[:text.index(end) + len(end)]))
            out.append((spdx, text[:text.index(end)]))
    return out


# FIXED: SPDX identifier and text of known licences, then of notices that name one.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("ISC", _GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS),
    ("ISC", "ISC License\n\n" + _GRANT
     + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS),
    ("0BSD", _GRANT + ".\n\n" + _AS_IS),
    ("BSD-2-Clause", "\n\n".join([_BSD_HEAD, _BSD_TAIL])),
    ("BSD-3-Clause", "\n\n".join([_BSD_HEAD, _BSD_NAMES, _BSD_TAIL])),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
KNOWN += tuple((spdx, f"{title}\n\n{text}") for spdx, text in KNOWN[:7] if not text.startswith(f"{spdx} License")
               for title in TITLES[spdx]) + tuple(_files())

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A line that states a copyright: sign and word, whatever follows; the word or "(c)" alone only before
# a year or bracket, as lines of the terms may begin so. Then the line "All rights reserved".
COPYRIGHT_LINE = (
    r"(?m)^[ \t/*#;-]*(?:(?:copyright|\(c\)|©)[ \t]*(?:\(c\)|©)?[ \t]*[0-9]{4}[^\n]*"
    r"|(?:copyright[ \t]*(?:\(c\)|©|[<\[{])|\(c\)[ \t]*copyright|©)[^\n]*"
    r"|all rights reserved[ \t\r.!*/]*)$")
# Lines that begin with "copyright" and a name, at the head of a text or right under a title.
_TITLE_WORDS = "the|mit|isc|bsd|0bsd|zero|clause|license|licence|new|modified|simplified|revised|or|[0-9]|[ \\t\\r()\"-]"
HEAD_COPYRIGHT = rf"\A((?:(?:{_TITLE_WORDS})*\n)*)(?:[ \t/*#;-]*copyright[ \t][^\n]*(?:\n[ \t\r]*)*)+"
# FIXED: every known text holds one of these in its canonical form.
CUES = ("license", "licensed", "permission", "redistribution", "released", "cc0")
# Everything in ASCII but letters, digits and the line feed, and common typographic marks.
MARKS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F“”‘’«»–—…•·©®™]+"


def canonical_lines(text: Column) -> Column:
    """The canonical lines of ``text``: words between doubled blanks, so that no two share one."""
    text = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), COPYRIGHT_LINE, "")
    text = F.regexp_replace(text, HEAD_COPYRIGHT, "$1")
    text = F.regexp_replace(text, MARKS, " ")
    # From here on blanks are single; a blank on either side of a line feed goes.
    text = F.concat(F.lit(" "), F.replace(F.replace(F.replace(text, F.lit("\n "), F.lit("\n")), F.lit(" \n"), F.lit("\n")),
                                          F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    text = F.replace(text, F.lit(" "), F.lit("  "))
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return text


def one_line(lines: Column) -> Column:
    """Canonical lines joined to one text with single blanks."""
    return F.btrim(F.regexp_replace(lines, r"[ \n]+", " "))


def known(spark: SparkSession) -> DataFrame:
    """(digest, license, length, cued): the fixed table of known texts, one row per digest."""
    rows = spark.createDataFrame([(spdx, text) for spdx, text in KNOWN], "license string, known string")
    text = one_line(canonical_lines(F.col("known")))
    return rows.groupBy(F.sha2(text, 256).alias("digest")).agg(
        F.min("license").alias("license"), F.max(F.length(text)).alias("length"), F.max(_cued(text)).alias("cued"))


def _cued(line: Column) -> Column:
    cue = F.lit(False)
    for word in CUES:
        cue = cue | F.contains(line, F.lit(word))
    return cue


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, canonical_sha256, license (of the entire text, or NULL) and notices (known one-line
    texts in order of appearance, as SPDX identifiers joined by blanks): one row per document.

    NULL and blank texts have the canonical form of the empty text and no licence. Repeated rows
    each get a row; an empty table gives an empty result.
    """
    table = materialize(known(docs.sparkSession), "license_known")
    bound = table.agg(F.max("length").alias("longest"), F.min("cued").alias("cued")).first()
    if not bound["cued"]:
        raise ValueError("a known text holds no cue word")
    table = table.select("digest", "license")
    single = lambda x: F.btrim(F.replace(x, F.lit("  "), F.lit(" ")))
    lines = docs.select("doc_id", F.monotonically_increasing_id().alias("row_no"), canonical_lines(F.col("text")).alias("lines"))
    places = F.filter(F.transform(F.split("lines", "\n"), lambda x, i: F.struct(i.alias("place"), single(x).alias("line"))),
                      lambda x: _cued(x["line"]) & (F.length(x["line"]) <= bound["longest"]))
    digests = materialize(lines.select(
        "doc_id", "row_no", F.sha2(one_line(F.col("lines")), 256).alias("canonical_sha256"),
        F.transform(F.when(_cued(F.col("lines")), places), lambda x: F.struct(x["place"], F.sha2(x["line"], 256).alias("digest")))
        .alias("candidates")), "license_digests")
    # The fixed table is broadcast to both joins; the second groups a document's own lines.
    found = (digests.select("row_no", F.explode("candidates").alias("c")).select("row_no", "c.place", "c.digest")
             .join(F.broadcast(table), "digest")
             .groupBy("row_no").agg(F.sort_array(F.collect_list(F.struct("place", "license"))).alias("found")))
    whole = F.broadcast(table.withColumnRenamed("digest", "canonical_sha256"))
    return (digests.drop("candidates").join(whole, "canonical_sha256", "left").join(found, "row_no", "left")
            .select("doc_id", "canonical_sha256", "license",
                    F.coalesce(F.array_join("found.license", " "), F.lit("")).alias("notices")))
