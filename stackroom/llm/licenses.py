"""Licence scan: entire texts are looked up by canonical digest.

The canonical form of a text has lower case, one spelling for words that licences spell in
several ways, no copyright lines, no punctuation and single spaces. The SHA-256 of a
document's canonical form, and of each of its lines, is joined with the digests of known
licences and notices; equal digests mean equal entire texts, so nothing is guessed. The known
table is fixed and small and therefore broadcast; matches are combined per document before
they are joined back.

Results for odd input: a null text is empty; an empty canonical form matches nothing; rows
that repeat an id and its text share one result; a null id is carried along; an empty table
gives an empty table. Work is linear in the text.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm.common import kept_table

#: Spellings taken as equal (each left one becomes the right one, in this order).
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("https:", "http:"),
    ("&", " and "),
    ("owner", "holder"),  # one word, so that a line end between "copyright" and it does not count
    ("v2.0", "version 2.0"),
    ("gplv3", "gpl version 3"),
)
#: "Copyright" with (c), a year or its place, or a form that only holders have; a wrapped line of a
#: licence may begin with the word, or with item (c).
COPYRIGHT_LINE = (
    r"^[^a-z0-9©(]*(copyright([^a-z0-9(©]*(\(c\)|©|[0-9]{4}|yyyy|year)"
    r"|[^a-z](.*[^a-z](inc|llc|ltd|gmbh|corp|corporation|all rights reserved)[^a-z0-9]*$|[^@]*@))"
    r"|\(c\)[^a-z0-9(]*([0-9]{4}|copyright)|©)"
)
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F‘’“”–—…©®™" + "\u00a0]+"

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_ISC_TERMS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)

_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
    "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN "
    "IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_TERMS_END = "END OF TERMS AND CONDITIONS"


def _whole_texts() -> list[tuple[str, str]]:
    """Whole licences, with and without the title of BSD ones and what follows the terms of others."""
    found = []
    for license_id, title, terms in (("BSD-2-Clause", "BSD 2-Clause", _BSD_2), ("BSD-3-Clause", "BSD 3-Clause", _BSD_2 + _BSD_3)):
        for holder in ("HOLDER", "HOLDERS"):
            text = terms + _BSD_END.format(holder)
            found += [(license_id, text), (license_id, f"{title} License\n\n{text}")]
    for path in sorted(Path(__file__).with_name("license_texts").glob("*.txt")):
        text = path.read_text("utf-8")
        found.append((path.stem, text))
        if _TERMS_END in text:
            terms = text[: text.index(_TERMS_END)]
            found += [(path.stem, terms), (path.stem, terms + _TERMS_END)]
    return found


#: Known licences and notices (licence, text).
KNOWN = (
    *_whole_texts(),
    ("MIT", f"MIT License\n\n{_MIT_GRANT}"),
    ("MIT", _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("ISC", f"ISC License\n\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in "
            f"all copies.\n\n{_ISC_TERMS}"),
    ("0BSD", f"BSD Zero Clause License\n\n{_ISC_GRANT}.\n\n{_ISC_TERMS}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License v2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GPLv3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
)


def canonical_lines(text: Column) -> Column:
    """The canonical form of each line that is no copyright line."""
    lines = F.filter(F.split(F.lower(text), "\n"), lambda line: ~line.rlike(COPYRIGHT_LINE))
    joined = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, F.array_join(lines, "\u0001"))
    plain = F.regexp_replace(joined, PUNCTUATION.replace(r"\x00", r"\x02"), " ")
    return F.transform(F.split(plain, "\u0001"), lambda line: F.trim(line))


def canonical(lines: Column) -> Column:
    """The canonical form of a text from that of its lines."""
    return F.array_join(F.filter(lines, lambda line: line != ""), " ")


def known_licenses(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``digest, license_id``, one row per canonical text."""
    rows = spark.createDataFrame(list(known), "license_id string, text string")
    digests = rows.select("license_id", F.sha2(canonical(canonical_lines(F.col("text"))), 256).alias("digest"))
    return digests.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scanned(
    docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text_digest, license_id, notices, n_notices`` for every row.

    ``license_id`` is the licence that the entire text is; ``notices`` are the licences of
    lines, distinct and in order.
    """
    spark = docs.sparkSession
    known = known_licenses(spark) if known is None else known
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), canonical_lines(text).alias("lines"))
    units = lines.select(
        "doc_id",
        F.sha2(canonical(F.col("lines")), 256).alias("text_digest"),
        F.array_distinct(F.transform(F.filter("lines", lambda x: x != ""), lambda x: F.sha2(x, 256))).alias("line_digests"),
    )
    units = kept_table(units, "licence-digests")
    each = units.select(
        "doc_id", "text_digest", F.explode(F.array_append("line_digests", F.col("text_digest"))).alias("digest")
    )
    empty = F.sha2(F.lit(""), 256)
    hits = each.join(F.broadcast(known), "digest").where(F.col("digest") != empty)
    found = hits.groupBy("doc_id", "text_digest").agg(
        F.max(F.when(F.col("digest") == F.col("text_digest"), F.col("license_id"))).alias("license_id"),
        F.array_sort(F.collect_set("license_id")).alias("ids"),  # at most the known licences
    )
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_digest").alias("_digest"), "license_id", "ids")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_digest") == F.col("_digest"))
    return units.select("doc_id", "text_digest").join(found, same, "left").select(
        "doc_id",
        "text_digest",
        "license_id",
        F.coalesce(F.array_join("ids", ","), F.lit("")).alias("notices"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_notices"),
    )
