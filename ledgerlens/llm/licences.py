"""Licence scans by canonical digest: whole texts are brought to one canonical form and hash-joined
to the digests of known licence texts. All steps are built-in functions.

Known are ``KNOWN``, the texts in ``licence_texts`` (one file per licence, as published) and, of each,
the text below its usual title lines, without the appendix after its terms, without the appendix's line
to fill in, and on one line.

Canonical form: lower case; statements of copyright (of holder and years, up to the end of the line or the
first words of a licence) and of reserved rights go; equivalent spellings become one (licence/license, organisation/organization, http/https, copyright holder(s)/
owner(s), and so on); every run of characters other than letters and digits becomes one blank. Two
texts that differ only in these have equal digests. The digest is SHA-256.

Cases: null text has no digest and no licence; a text that is empty in canonical form (blank, only
punctuation or only copyright lines) has the digest of the empty string and no licence; equal texts
get equal rows; if two known licences share a canonical form the smaller name is reported; empty
tables are allowed on both sides.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: known licence texts (fixed values, as published)
KNOWN = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
}

#: equivalent spellings, applied in this order to the lower-cased text (fixed values)
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("organisation", "organization"), ("modelled", "modeled"),
    ("labour", "labor"), ("favour", "favor"), ("behaviour", "behavior"), ("fulfil ", "fulfill "), ("judgement", "judgment"),
    ("non-infringement", "noninfringement"), ("sub-license", "sublicense"), ("merchantibility", "merchantability"),
    ("https://", "http://"), ("copyright owners", "copyright holders"), ("copyright owner", "copyright holder"),
    ("©", "(c)"), ("–", "-"),
]
#: a line that states a copyright, or reserves all rights, as the SQL of the query has it; lines end at U+000A alone
NOTICE_LINE = r"(?md)^[ \t\x0B\f\r#*/;\-]*(?:copyright[ \t]*(?:\(c\)|[0-9]|by\b)|\(c\)[ \t]*(?:copyright|[0-9])|all rights reserved)[^\n]*$"
#: the first words of a licence, which end a statement of copyright on the same line
OPENING = (r"(?:permission is hereby granted|permission to use|redistribution and use|licensed under|released under|this software is "
           r"provided|the software is provided|this program is free|this library is free|this work is licensed|this is free and|everyone is permitted)")
#: a copyright of marker, years and holders, at the start of a line or behind a title, up to reserved rights or a
#: licence's first words, however many holders there are; without those, the rest of a line of usual length (a
#: longer one is prose: only marker and years go); and reserved rights
STATEMENT = (r"(?md)(?:^[ \t\x0B\f\r#*/;\-]*|(?<=\blicense\)?[ \t]{1,4}))(?:"
             r"(?:copyright[ \t]*(?:\(c\)|[0-9]|by\b)|\(c\)[ \t]*(?:copyright|[0-9]))"
             rf"(?:[^\n]*?(?=\ball rights reserved\b|\b{OPENING})|[^\n]{{0,200}}$|[0-9 \t,\-]*)(?:all rights reserved\b\.?)?"
             r"|all rights reserved\b\.?)")
#: a line that states a copyright by the holder's name alone: capital words (and small ones that names hold)
HOLDER_LINE = (r"(?md)^[ \t\x0B\f\r#*/;\-]*(?:Copyright|COPYRIGHT)(?![ \t]+(?i:holders?|owners?|notices?|laws?|licen[sc]es?)\b)"
               r"(?:[ \t]+(?>\p{Lu}[^ \t\n]*|(?:the|and|of|its|contributors|authors|others|rights|reserved)\b[.,]?|&|<[^> \t\n]+>))++[ \t\r]*$")
#: title lines that stand above a licence whose own text has none (fixed values)
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT", "Expat License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License",
                     "Modified BSD License", "BSD License", "The BSD License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
}
GAP = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    out = F.lower(F.regexp_replace(text, HOLDER_LINE, ""))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.btrim(F.regexp_replace(F.regexp_replace(out, STATEMENT, ""), GAP, " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_texts() -> list[tuple[str, str]]:
    """(licence, body) of ``KNOWN``, of the published texts and of their usual forms."""
    files = sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))
    whole = [*KNOWN.items(), *((f.stem, f.read_text(encoding="utf-8")) for f in files)]
    out = []
    for name, body in whole:
        end = re.search(r"END OF TERMS AND CONDITIONS", body)
        forms = [body, re.sub(r"(?m)^.*Copyright \[yyyy\].*$", "", body)]
        forms += [body[:end.start()], body[:end.end()]] if end else []
        forms += [f"{title}\n\n{body}" for title in TITLES.get(name, [])]
        out += [(name, form) for f in forms for form in (f, " ".join(f.split()))]
    return list(dict.fromkeys(out))


def known_digests(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """licence, digest; one row per distinct canonical form."""
    rows = known_texts() if known is None else list(known.items())
    texts = spark.createDataFrame(rows, "licence string, body string")
    return (texts.where(canonical(F.col("body")) != "").groupBy(digest(F.col("body")).alias("digest"))
            .agg(F.min("licence").alias("licence")))


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest, licence (null: none) of every row. The join is on the digest alone; Spark
    broadcasts ``known`` (digest, licence) only where its measured size allows it."""
    known = known.groupBy(F.col("digest").alias("known_digest")).agg(F.min("licence").alias("licence"))
    digested = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("digest"))
    return (digested.join(known, F.col("digest") == F.col("known_digest"), "left")
            .select("doc_id", "digest", "licence"))
