"""Licence scan by canonical digest.

A text and a known licence are the same if they have the same words once case, punctuation, copyright lines and
equivalent spellings are put aside.  Both are brought to that canonical form and digested, and the digests are joined;
a text of any length is one row of a hash join against a table of a few known digests.  The whole text is looked up,
and so is each of its lines, as notices such as "Released under the MIT License." stand alone on a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Spellings that count as equal, after the public matching guidelines for licences.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
    "noncommercial": "non  commercial",
    "copyright  owner": "copyright  holder",
    "sublicence": "sublicense",
    "sub  license": "sublicense",
    "per  cent": "percent",
}
#: A line of this form names a holder and is no part of the terms.
COPYRIGHT_LINE = r"^[\s*#/;-]*(copyright\b|\(c\)|©|all rights reserved)"

# The texts of public licences and the notices that stand for them.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
LICENCES = (
    ("0BSD", f"{_ISC_GRANT}.\n{_ISC_END}"),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_NAMES + _BSD_END),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_END}"),
    (
        "MIT",
        f"{_PERMISSION}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies "
        f"or substantial portions of the Software.\n{_AS_IS}",
    ),
    ("MIT", f"MIT License\n{_PERMISSION}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included "
     f"in all copies or substantial portions of the Software.\n{_AS_IS}"),
    ("MIT-0", f"{_PERMISSION}.\n{_AS_IS}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
)


def canonical(text: Column) -> Column:
    """The words of a text in small letters, without copyright lines, in one spelling, with one space between them."""
    lines = F.filter(F.split(F.lower(text), "\n"), lambda line: ~line.rlike(COPYRIGHT_LINE))
    spaced = F.regexp_replace(F.array_join(lines, " "), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "  ")
    # two spaces between words, so that neighbours can both be replaced
    out = F.concat(F.lit(" "), spaced, F.lit(" "))
    for word, same in EQUIVALENT.items():
        out = F.replace(out, F.lit(f" {word} "), F.lit(f" {same} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def known(spark: SparkSession) -> DataFrame:
    """``license_id, digest`` of the known texts; as many rows as ``LICENCES`` at most."""
    rows = spark.createDataFrame(list(LICENCES), "license_id string, text string")
    return rows.select("license_id", F.md5(canonical(F.col("text"))).alias("digest")).distinct()


def scan(docs: DataFrame, licences: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, text_digest, license_id, notices, n_notices``.

    ``license_id`` is the licence that the whole text is, ``notices`` the licences that a line of it stands for, sorted
    and comma-joined.  ``licences`` has ``license_id, digest``, one id per digest.  Null texts have no digest; texts
    whose canonical form is empty match nothing; rows that repeat id and text have equal results.
    """
    licences = known(docs.sparkSession) if licences is None else licences
    empty = F.md5(F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    keyed = rows.withColumn("row_key", F.concat_ws(":", F.xxhash64("text").cast("string"), F.length("text").cast("string"), F.col("doc_id").cast("string")))
    lines = keyed.select("row_key", F.explode_outer(F.array_distinct(F.split("text", "\n"))).alias("line"))
    # a known line has a known number of words at most, but any spelling; only empty lines are left out
    # made by a generator, as filters that the join implies would otherwise be put below it and make the digest twice
    made = F.explode_outer(F.array(F.md5(canonical(F.col("line"))))).alias("digest")
    digests = lines.where(F.length("line") > 0).select("row_key", made)
    table = licences.where(F.col("digest") != empty)
    found = digests.join(table, "digest").groupBy("row_key").agg(F.sort_array(F.collect_set("license_id")).alias("ids"))
    whole = keyed.select("doc_id", "row_key", F.md5(canonical(F.col("text"))).alias("text_digest"))
    named = whole.join(table.withColumnRenamed("digest", "known_digest"), F.col("text_digest") == F.col("known_digest"), "left")
    return named.join(found, "row_key", "left").select(
        "doc_id",
        "text_digest",
        "license_id",
        F.coalesce(F.array_join("ids", ","), F.lit("")).alias("notices"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_notices"),
    )


def _sql_canonical(text: str) -> str:
    spaced = (
        f"regexp_replace(array_to_string(list_filter(string_split(lower({text}), chr(10)), "
        f"lambda l: NOT regexp_matches(l, '{COPYRIGHT_LINE}')), ' '), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', '  ', 'g')"
    )
    out = f"(' ' || {spaced} || ' ')"
    for word, same in EQUIVALENT.items():
        out = f"replace({out}, ' {word} ', ' {same} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def sql() -> str:
    """The scan of table ``documents`` with the known licences, for ids that are unique."""
    quoted = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in LICENCES)
    return f"""
WITH known AS (SELECT DISTINCT license_id, md5({_sql_canonical('t')}) AS digest FROM (VALUES {quoted}) AS v(license_id, t)),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
found AS (SELECT l.doc_id, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS notices, count(DISTINCT k.license_id) AS n
          FROM (SELECT doc_id, md5({_sql_canonical('line')}) AS digest FROM lines WHERE length(line) > 0) l
          JOIN known k ON k.digest = l.digest AND l.digest <> md5('') GROUP BY l.doc_id),
whole AS (SELECT doc_id, md5({_sql_canonical('text')}) AS text_digest FROM documents)
SELECT w.doc_id, w.text_digest, k.license_id, coalesce(f.notices, '') AS notices, coalesce(f.n, 0) AS n_notices
FROM whole w LEFT JOIN known k ON k.digest = w.text_digest AND w.text_digest <> md5('') LEFT JOIN found f ON f.doc_id = w.doc_id
"""
