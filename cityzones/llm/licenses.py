"""Licence scan by canonical digest lookup.

A text is brought into a canonical form (lower case, copyright lines dropped,
equivalent spellings made one, punctuation and spacing reduced to single
spaces) and hashed; the digest is joined with the digests of known licence
texts and notices, canonicalised alike.  Entire texts are looked up: the whole
document and each of its lines.  The join is an equality of digests; its small
side has one row per known text and is never wider than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityzones.llm.common import materialize

# Spellings that licence matching treats as equal (variant, canonical).
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("sublicence", "sublicense"),
    ("sub license", "sublicense"), ("merchantibility", "merchantability"), ("non infringement", "noninfringement"),
    ("favour", "favor"), ("whilst", "while"), ("wilful", "willful"), ("acknowledgement", "acknowledgment"),
    ("redistributions", "redistribution"), ("organisation", "organization"), ("https", "http"),
)

# Known texts (licence id, text).  Notices are single lines; the others are whole licences.
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
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("proprietary", "All rights reserved."),
)

_COPYRIGHT = r"^[^a-z0-9©]*(copyright|©|\(c\))"
_PUNCTUATION = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def canonical_line(line: Column) -> Column:
    """One line without case, punctuation and variant spellings; empty when it is a copyright line."""
    low = F.lower(line)
    # two spaces between words: each word has a space of its own on both sides, so neighbours are replaced alike
    words = F.trim(F.regexp_replace(low, _PUNCTUATION, "  "))
    plain = F.concat(F.lit(" "), words, F.lit(" "))
    for variant, same in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {variant.replace(' ', '  ')} "), F.lit(f" {same} "))
    return F.when(low.rlike(_COPYRIGHT), "").otherwise(F.replace(F.trim(plain), F.lit("  "), F.lit(" ")))


def canonical_lines(text: Column) -> Column:
    """Array of the canonical lines that are not empty."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x != "")
    return F.filter(F.transform(lines, canonical_line), lambda x: x != "")


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """Rows (digest, license), one per canonical text; where two licences share one, the first by name."""
    texts = spark.createDataFrame(list(known), "license string, text string")
    return (texts.select(F.sha2(F.array_join(canonical_lines(F.col("text")), " "), 256).alias("digest"), "license")
            .groupBy("digest").agg(F.min("license").alias("license")))


def scan(df: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Findings (id, line, license): ``line`` counts the document's canonical lines from 0, -1 is the whole document.

    A document that is one line is found twice, as a whole and as a line.  Null and empty texts, and texts of copyright
    lines alone, have no lines and no finding.  Repeated rows give repeated findings.  ``known`` is written once, so
    that the planner joins by its measured size: documents are not shuffled while it is small."""
    known = materialize(known.select("digest", "license"), "known-licenses")
    lines = df.select(F.col(id_col).alias("id"), canonical_lines(F.col(text_col)).alias("_l"))
    whole = F.struct(F.lit(-1).alias("line"), F.sha2(F.array_join("_l", " "), 256).alias("digest"))
    each = F.transform("_l", lambda x, i: F.struct(i.alias("line"), F.sha2(x, 256).alias("digest")))
    units = lines.where(F.size("_l") > 0).select("id", F.explode(F.concat(F.array(whole), each)).alias("u"))
    return units.select("id", "u.line", "u.digest").join(known, "digest").select("id", "line", "license")


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, known_digests(spark)).select(F.col("id").alias("doc_id"), F.col("line").cast("long"), "license")


def _sql() -> str:
    def canon(x: str) -> str:
        low = f"lower({x})"
        words = f"string_split(trim(regexp_replace({low}, '{_PUNCTUATION}', ' ', 'g')), ' ')"
        cases = " ".join(f"WHEN '{v}' THEN '{same}'" for v, same in SPELLINGS if " " not in v)
        plain = f"' ' || array_to_string(list_transform({words}, lambda w: CASE w {cases} ELSE w END), ' ') || ' '"
        for variant, same in [p for p in SPELLINGS if " " in p[0]] * 2:  # twice: neighbours share a space
            plain = f"replace({plain}, ' {variant} ', ' {same} ')"
        return f"CASE WHEN regexp_matches({low}, '{_COPYRIGHT}') THEN '' ELSE trim({plain}) END"

    def lines(x: str) -> str:
        return (f"list_filter(list_transform(string_split(coalesce({x}, ''), chr(10)), lambda l: {canon('l')}), "
                "lambda l: l <> '')")

    quoted = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in KNOWN)
    return f"""
WITH k AS (SELECT array_to_string({lines('t')}, ' ') AS c, min(license) AS license
           FROM (VALUES {quoted}) AS v(license, t) GROUP BY 1),
d AS (SELECT doc_id, {lines('text')} AS l FROM documents),
u AS (SELECT doc_id, -1 AS line, array_to_string(l, ' ') AS c FROM d WHERE len(l) > 0
      UNION ALL SELECT doc_id, i - 1, l[i] FROM d, unnest(range(1, len(l) + 1)) AS r(i))
SELECT doc_id, line::BIGINT AS line, license FROM u JOIN k USING (c)"""


QUERIES = {"op8_license_scan": op8_license_scan}
ORACLE = {"op8_license_scan": _sql()}
