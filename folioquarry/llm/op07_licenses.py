"""Licence scans by canonical digest. DataFrame functions only.

A text is brought to a canonical form, line by line: lower case, lines with a copyright notice
dropped, equivalent spellings made one, everything but letters and digits turned into single
spaces. Digests of whole canonical texts are joined to the digests of known licences, whose texts
pass through the very same expressions. Each line of a text is a text too, so that one-line licence
notices are found wherever they stand.

The known side is a fixed table (``NOTICES``, ``TEXTS`` and the files in ``licenses``, or the caller's) of at most
``MOST_KNOWN`` digests, never data: it is broadcast for the join of whole texts, and is a literal map for lines. Nothing is shuffled.

Defined results: a null or empty text has the digest of the empty canonical text, and no licence;
a text of copyright lines only is empty too; repeated rows give one row each; of licences of one digest the first by
code point counts; an empty table gives no rows; a text of any length is read whole; columns but ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One-line notices by which works name their licence.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0."],
    "all-rights-reserved": ["All rights reserved."],
}
# Whole licence texts.
_PERMISSION = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR "
    "IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
TEXTS = {
    "MIT": "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software.\n\n" + _PERMISSION,
    "ISC": "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
    "that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _ISC,
}

#: Digests that a scan may know.
MOST_KNOWN = 5_000
#: Lines of title of the whole texts; texts are known without the first of them too, up to all.
TITLE_LINES = {"Apache-2.0": 3, "BSD-2-Clause": 1, "BSD-3-Clause": 1, "CC0-1.0": 2, "GPL-2.0": 2, "GPL-3.0": 2, "ISC": 1, "LGPL-2.1": 2, "LGPL-3.0": 2, "MIT": 1, "MPL-2.0": 2, "Unlicense": 1}


def whole_texts() -> list[tuple[str, str]]:
    """(license_id, text) of ``TEXTS`` and of the files in ``licenses``, in the forms in which they are handed on.

    With and without title lines; to the end or to the end of the terms; with and without the line that holds a
    place for the owner (a filled one is a copyright line); BSD also with bullets, and with a line of rights reserved.
    """
    files = sorted((Path(__file__).parent / "licenses").glob("*.txt"))
    out = []
    for name, text in [*TEXTS.items(), *((f.stem, f.read_text(encoding="utf-8")) for f in files)]:
        lines = [x for x in text.split("\n") if x.strip()]
        bodies = [lines, [x for x in lines if "[yyyy]" not in x]]
        ends = [i for i, x in enumerate(lines) if x.strip() == "END OF TERMS AND CONDITIONS"]
        bodies += [lines[: i + more] for i in ends[:1] for more in (0, 1)]
        titles = TITLE_LINES.get(name, 0)
        forms = [body[k:] for body in bodies for k in range(titles + 1)]
        if name.startswith("BSD"):
            forms += [[re.sub(r"^[0-9]\. ", "* ", x) for x in form] for form in forms]
            forms += [[*form[:k], "All rights reserved.", *form[k:]] for form in forms for k in [int(form[0].startswith("BSD"))]]
        out += [(name, "\n".join(form)) for form in forms]
    return sorted(set(out))


#: (pattern, replacement) on lower-case text: spellings that licence readers treat as one.
SPELLINGS = (
    (r"https?://", " "), (r"licence", "license"), (r"sub[- ]license", "sublicense"), (r"non[- ]?infringement", "noninfringement"),
    (r"organisation", "organization"), (r"merchantibility", "merchantability"), (r"copyright owner", "copyright holder"), (r"&", " and "),
)
#: A line that only states who holds the copyright; a sentence that mentions copyright is no such line.
COPYRIGHT = r"^[^\p{L}\p{N}]*(portions )?(copyright|©|\(c\))[^\p{L}]*(\(c\)|©|[0-9]{4}|by )"


def canonical_lines(text: Column) -> Column:
    """The canonical forms of a text's lines, empty ones left out."""

    def form(line: Column) -> Column:
        low = F.lower(line)
        spelt = low
        for pattern, to in SPELLINGS:
            spelt = F.regexp_replace(spelt, pattern, to)
        return F.when(low.rlike(COPYRIGHT), F.lit("")).otherwise(F.trim(F.regexp_replace(spelt, r"[^\p{L}\p{N}]+", " ")))

    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), form), lambda x: x != "")


def known_licenses(spark: SparkSession, notices=NOTICES, texts=None) -> DataFrame:
    """(digest, license_id) of the known texts (``whole_texts`` unless given), through the same expressions as the data."""
    rows = [(name, t) for name, ts in notices.items() for t in ts] + (whole_texts() if texts is None else list(texts.items()))
    known = spark.createDataFrame(rows, "license_id string, text string")
    digest = F.sha2(F.array_join(canonical_lines(F.col("text")), " "), 256)
    return known.select(digest.alias("digest"), "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, license_id (of the whole text, or null), notices (ids named by its lines, comma-joined), n_notices."""
    known = known_licenses(docs.sparkSession) if known is None else known
    rows = [(r["digest"], r["license_id"]) for r in known.select("digest", "license_id").limit(MOST_KNOWN + 1).collect()]
    if len(rows) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known digests")
    table = docs.sparkSession.createDataFrame(rows, "known_digest string, license_id string")
    of = F.create_map(*[F.lit(x) for row in rows for x in row]) if rows else F.create_map().cast("map<string, string>")
    named = F.array_compact(F.transform("lines", lambda x: F.try_element_at(of, F.sha2(x, 256))))
    canonical = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))  # a step of its own, so that lines are made once
    hashed = canonical.select("doc_id", F.sha2(F.array_join("lines", " "), 256).alias("digest"), named.alias("named"))
    joined = hashed.join(F.broadcast(table), F.col("digest") == F.col("known_digest"), "left")
    return joined.select(
        "doc_id", "digest", "license_id", F.array_join(F.array_sort(F.array_distinct("named")), ",").alias("notices"), F.size("named").cast("bigint").alias("n_notices"),
    )
