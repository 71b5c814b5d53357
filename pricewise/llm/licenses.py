"""Licence scans by canonical digest (operator 5), in DataFrame functions only.

A text is brought into canonical form: lower case, no copyright lines, no punctuation,
one spelling of words that have several, single blanks. The SHA-256 of the form is
looked up by a hash join among the digests of known licence texts, which are brought
into the same form. So texts that differ only in these points have one digest. Each
line of the form is looked up as well, as an entire text of its own: this finds one-line
notices inside a document.

A licence file has more than the licence: titles, copyright lines with or without a year,
another wrapping, other list marks, the names of the holders. So an entire text is also
looked up by its body, the words from the first line on that is no title or copyright line
(:func:`body`). canonical_digest stays the digest of the canonical form.

The known texts are a parameter, a frame (license_id, text); ``KNOWN`` is a short list of
texts and notices, ``license_texts`` holds further public licences whole.

Defined cases: a null text counts as empty, and an empty form is no licence; of several
ids with one form the first in order is named; repeated rows are looked up alike; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as equal (from, to), after punctuation is gone.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("organisation", "organization"), ("authoris", "authoriz"), ("acknowledgement", "acknowledgment"),
    ("behaviour", "behavior"), ("favour", "favor"), ("fulfilment", "fulfillment"), ("judgement", "judgment"),
    ("merchantibility", "merchantability"), ("copyright owner", "copyright holder"),
)

#: Public licence texts and notices.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
}


_END = "END OF TERMS AND CONDITIONS"


def texts() -> list[tuple[str, str]]:
    """(license_id, text): ``KNOWN``, and the files of ``license_texts`` whole and, where
    an appendix follows the terms, without it."""
    out = list(KNOWN.items())
    for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = f.read_text("utf-8")
        out.append((f.stem, text))
        if _END in text:
            terms = text[:text.index(_END)]
            out += [(f.stem, terms), (f.stem, f"{terms}{_END}")]
    return out


def known(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(v).alias("text"))
                                                     for k, v in texts()])).alias("k")).select("k.*")


#: Patterns and what takes their place, in order.
_STEPS = (
    (r"(?m)^[^\p{L}\p{N}\n]*(?:copyright[^\p{L}\n]*(?:©|\(c\)|[0-9]{4})|©|\(c\)|all rights reserved)[^\n]*$", ""),
    (r"[^\p{L}\p{N}\n]+", " "),
    (r" *\n[ \n]*", "\n"),
)


def canonical(text: Column) -> Column:
    """The canonical form, line by line."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for pattern, to in _STEPS:
        out = F.regexp_replace(out, pattern, to)
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out, F.lit(" \n"))


#: Lines before the body, lower case and without punctuation.
_NAMES = (r"mit|expat|isc|x11|unlicense|zlib|zlib libpng|apache|boost software|artistic|mozilla public|0bsd|bsd zero clause|zero clause bsd"
          r"|(?:new |modified |revised |simplified |free)?bsd|(?:bsd )?(?:2|3|two|three) clause(?: bsd| simplified| freebsd| new or revised)?"
          r"|gnu (?:lesser |library )?general public|gnu free documentation")
_VERSION = r"v?(?:ersion )?[0-9]+(?: [0-9]+)*(?: [a-z]+(?: [0-9]+(?:th)?)? [0-9]{4})?"
_HEAD = (r"^(?:(?:portions )?(?:c )?copyright(?: .*)?|c [0-9]{4} .*|all rights reserved|license|spdx license identifier .*"
         rf"|(?:the )?(?:{_NAMES})(?: license)?(?: mit| expat| isc| 0bsd| zlib)?(?: {_VERSION})?|{_VERSION}"
         r"|https? www apache org licenses(?: license 2 0(?: txt)?)?|creative commons legal code|cc0 1 0 universal)$")
_YEAR = r"^(?:portions )?(?:c )?copyright (?:copyright |c )*(?:[0-9]{4}|yyyy|year)(?: .*)?$"

#: What differs between files of one licence, in the body: patterns and what takes their place.
_SAME = (
    (r" https ", " http "),
    (r" (?:59 temple place(?: suite 330)?|51 franklin st(?:reet)? fifth floor) boston ma [0-9 ]+usa", ""),
    (r" [1-3a-c] (redistributions (?:of source|in binary)|neither the name)", " $1"),
    (r" neither the names? of .{1,200}? nor the names of (?:its|their|the|any) contributors", " neither the name of the copyright holder nor the names of its contributors"),
    (r" provided by .{1,200}? as is and any express", " provided by the copyright holders and contributors as is and any express"),
    (r" in no event shall .{1,200}? be liable for any direct", " in no event shall the copyright holders be liable for any direct"),
)


def body(text: Column) -> Column:
    """The words of a licence file after its titles and copyright lines, one blank apart."""
    out = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("©"), F.lit(" copyright "))
    for pattern, to in _STEPS[1:]:
        out = F.regexp_replace(out, pattern, to)
    lines = F.transform(F.array(F.split(F.trim(out, F.lit(" \n")), "\n")), lambda a: F.filter(a, lambda x: ~x.rlike(_YEAR)))[0]
    rest = F.transform(F.array(lines), lambda a: F.transform(
        F.array(F.array_position(F.transform(a, lambda x: ~x.rlike(_HEAD)), True).cast("int")),
        lambda at: F.when(at > 0, F.array_join(F.slice(a, at, F.size(a)), " ")).otherwise(F.lit("")))[0])[0]
    out = F.concat(F.lit(" "), rest, F.lit(" "))
    for pattern, to in _SAME:
        out = F.regexp_replace(out, pattern, to)
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def scan(docs: DataFrame, licenses: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, canonical_digest, license_id (of the entire text or its body, or
    null), and notices, the ids of its lines that are known texts, joined by commas."""
    digest = lambda form: F.sha2(F.translate(form, "\n", " "), 256)
    table = licenses.select("license_id", canonical(F.col("text")).alias("form")).where("form <> ''") \
        .groupBy(digest(F.col("form")).alias("digest")).agg(F.min("license_id").alias("license_id"))
    form = F.transform(F.array(canonical(F.col(text_col))), lambda t: F.struct(
        digest(t).alias("digest"), F.array_distinct(F.transform(F.split(t, "\n"), lambda x: F.sha2(x, 256))).alias("lines")))[0]
    bodies = licenses.select("license_id", body(F.col("text")).alias("words")).where("words <> ''") \
        .groupBy(F.sha2("words", 256).alias("body_digest")).agg(F.min("license_id").alias("body_id"))
    rows = docs.select(F.col(id_col).alias("id"), form.alias("f"), F.sha2(body(F.col(text_col)), 256).alias("b"))
    entries = F.map_from_entries(F.collect_list(F.struct("digest", "license_id")))
    by_digest = table.agg(entries.alias("m")).first()["m"] or {}  # the known texts, a parameter of the query
    pairs = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(n).alias("n")) for d, n in sorted(by_digest.items())]) \
        if by_digest else F.expr("CAST(array() AS array<struct<d: string, n: string>>)")
    ours = F.array(*[F.lit(d) for d in sorted(by_digest)]).cast("array<string>")
    notices = F.transform(F.array(F.array_intersect("f.lines", ours)), lambda hits: F.when(F.size(hits) > 0, F.array_sort(
        F.transform(F.filter(pairs, lambda p: F.array_contains(hits, p["d"])), lambda p: p["n"])))
        .otherwise(F.array().cast("array<string>")))[0]
    return rows.join(table, F.col("f.digest") == F.col("digest"), "left") \
        .join(bodies, F.col("b") == F.col("body_digest"), "left") \
        .select(F.col("id").alias(id_col), F.col("f.digest").alias("canonical_digest"),
                F.coalesce("license_id", "body_id").alias("license_id"), F.array_join(notices, ",").alias("notices"))


def _sql_form(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for pattern, to in _STEPS:
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')".replace("\\n'", "'||chr(10)||'") if to == "\n" else \
            f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    for old, new in SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    return f"trim({out}, ' ' || chr(10))"


def oracle_sql() -> str:
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in KNOWN.items())
    return f"""
WITH raw(license_id, text) AS (VALUES {values}),
known AS (SELECT sha256(replace({_sql_form('text')}, chr(10), ' ')) AS digest, min(license_id) AS license_id FROM raw GROUP BY 1),
d AS (SELECT doc_id, {_sql_form('text')} AS form FROM documents),
e AS (SELECT doc_id, sha256(replace(form, chr(10), ' ')) AS canonical_digest,
    list_transform(string_split(form, chr(10)), lambda x: sha256(x)) AS lines FROM d)
SELECT doc_id, canonical_digest, known.license_id,
  coalesce((SELECT string_agg(k.license_id, ',' ORDER BY k.license_id) FROM known k WHERE list_contains(lines, k.digest)), '') AS notices
FROM e LEFT JOIN known ON canonical_digest = known.digest
"""
