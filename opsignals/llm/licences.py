"""Licence scan by canonical digest (operator 9), in DataFrame functions only.

Texts are brought to one form: lower case, no copyright lines, no title line of a known licence before a text, one spelling of words that licences
spell in two ways, marks and white space as single blanks. The digest of the whole form is joined to
the digests of known licence texts. A document is looked up as a whole and line by line, so that a
notice on a line of its own is found; a line is an entire text too, and nothing matches in part.

A null text is an empty one; what is empty after normalising matches nothing. The result has one row
for each doc_id (a null id included), so that repeated ids are one document. Other columns are left
behind. Two licences of one form are both reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsignals.llm.common import table, texts
from opsignals.llm.known_licences import PUBLISHED

# Public licence texts and notices, as their publishers give them.
KNOWN: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT '
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
]
# Spellings that count as one.
SPELLINGS: list[tuple[str, str]] = [
    ("https", "http"),
    ("licence", "license"),
    ("licencing", "licensing"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
]
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright\b|\(c\)|©).*$"
# Titles that published copies carry, at the start of a text of more lines; then a line of rights.
TITLE = (
    r"\A\s*(?:(?:the )?(?:mit|isc|(?:new |modified |simplified |revised )?bsd(?: [23][- ]clause)?)(?: \"[a-z]+\"(?: or \"[a-z]+\")*)? licen[sc]e(?: \([a-z0-9 -]+\))?[ \t\r]*\n"
    r"|apache license\s*version 2\.0, january 2004\s*(?:https?://www\.apache\.org/licenses/?[ \t\r]*)?\n"
    r"|gnu (?:lesser )?general public license\s*version [0-9.]+, [0-9]* ?[a-z]+ [0-9]{4}[ \t\r]*\n"
    r"|mozilla public license,? version 2\.0[ \t\r]*\n(?:=+[ \t\r]*\n)?"
    r"|(?:creative commons legal code\s*)?cc0 1\.0 universal[ \t\r]*\n)?\s*(?:all rights reserved\.?[ \t\r]*\n)?"
)
MARKS = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    out = F.regexp_replace(out, TITLE, "")
    out = F.concat(F.lit(" "), F.regexp_replace(out, MARKS, " "), F.lit(" "))
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(f" {one} "), F.lit(f" {other} "))
    return F.trim(out)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """licence and digest of licence texts; a table of your own may take its place."""
    rows = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(text).alias("text")) for name, text in known or KNOWN + PUBLISHED])
    named = spark.range(1).select(F.inline(rows))
    return named.select("licence", F.sha2(canonical(F.col("text")), 256).alias("digest")).distinct()


def licence_scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, licence (of the whole text, null if none), n_notices (lines that are one) and notices
    (their licences, sorted) for every document."""
    whole = texts(docs)
    lines = F.split("text", "\n", -1)
    # A text of one line is that line; it is looked up once, as a whole and as a line.
    units = whole.select("doc_id", F.explode(F.concat(F.array(F.struct(F.lit(True).alias("is_text"), F.col("text").alias("unit"))), F.transform(lines, lambda x: F.struct(F.lit(False).alias("is_text"), x.alias("unit"))))).alias("u"))
    keyed = units.select("doc_id", "u.is_text", canonical(F.col("u.unit")).alias("form")).filter(F.col("form") != "")
    found = keyed.select("doc_id", "is_text", F.sha2("form", 256).alias("digest")).join(known, "digest").select("doc_id", "is_text", "licence")
    everyone = whole.select("doc_id", F.lit(None).cast("boolean").alias("is_text"), F.lit(None).cast("string").alias("licence"))
    grouped = everyone.unionByName(found).groupBy("doc_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("is_text"), F.col("licence")))).alias("own"),
        F.count(F.when(~F.col("is_text"), 1)).alias("n_notices"),
        F.sort_array(F.collect_set(F.when(~F.col("is_text"), F.col("licence")))).alias("notices"),
    )
    return grouped.select(
        "doc_id", F.nullif(F.array_join("own", ","), F.lit("")).alias("licence"), "n_notices", F.array_join("notices", ",").alias("notices")
    )


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"), known_digests(spark))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_form(column: str) -> str:
    out = f"regexp_replace(lower({column}), {_sql_text(COPYRIGHT_LINE)}, '', 'g')"
    out = f"(' ' || regexp_replace({out}, {_sql_text(MARKS)}, ' ', 'g') || ' ')"
    for one, other in SPELLINGS:
        out = f"replace({out}, ' {one} ', ' {other} ')"
    return f"trim({out})"


# The SQL holds the texts of KNOWN and no titles: on the given tables, that is all there is to find.
_VALUES = ", ".join(f"({_sql_text(name)}, {_sql_text(text)})" for name, text in KNOWN)
ORACLE = f"""
WITH known AS (SELECT DISTINCT licence, {_sql_form('text')} AS form FROM (VALUES {_VALUES}) v(licence, text)),
units AS (
  SELECT doc_id, true AS is_text, coalesce(text, '') AS unit FROM documents
  UNION ALL SELECT doc_id, false, unnest(string_split(coalesce(text, ''), chr(10))) FROM documents),
found AS (
  SELECT doc_id, is_text, licence FROM (SELECT doc_id, is_text, {_sql_form('unit')} AS form FROM units) u
  JOIN known USING (form) WHERE form <> '')
SELECT d.doc_id,
  (SELECT string_agg(DISTINCT licence, ',' ORDER BY licence) FROM found f WHERE f.doc_id = d.doc_id AND is_text) AS licence,
  (SELECT count(*) FROM found f WHERE f.doc_id = d.doc_id AND NOT is_text) AS n_notices,
  coalesce((SELECT string_agg(DISTINCT licence, ',' ORDER BY licence) FROM found f WHERE f.doc_id = d.doc_id AND NOT is_text), '') AS notices
FROM (SELECT DISTINCT doc_id FROM documents) d
"""
