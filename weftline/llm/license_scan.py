"""Licence scan by canonical digests.

Texts are normalised so that copies of one licence that differ in case, punctuation, spacing,
copyright lines or spelling become equal, and the digest of the whole result is hash-joined to
the digests of known licences. The same expressions normalise both sides.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import table

#: Spellings that count as equal, each to the word it becomes.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("analog", "analogue"), ("analyze", "analyse"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorise", "authorize"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("centre", "center"), ("emphasise", "emphasize"), ("favour", "favor"), ("favourite", "favorite"),
    ("fulfil", "fulfill"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("modelled", "modeled"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("utilisation", "utilization"), ("utilise", "utilize"), ("whilst", "while"), ("wilful", "willful"), ("noncommercial", "non commercial"), ("merchantibility", "merchantability"),
]

#: Short licence notices and texts that are known to the default registry.
KNOWN = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "ISC": ['Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


#: Whole texts, a file for each licence, and the title lines under which copies are found.
TEXTS = Path(__file__).resolve().parent.parent / "data" / "licenses"
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
#: Title lines at the start of the files, and what follows the terms, which copies may leave out.
HEAD = re.compile(r"\A\s*(?:apache license\s+version 2\.0, january 2004(?:\s+https?://\S+)?|gnu (?:lesser )?general public license\s+version [0-9.]+, [\w ]+|mozilla public license version 2\.0\s+=+|creative commons legal code\s+cc0 1\.0 universal)\s*\n", re.I)
TAIL = re.compile(r"END OF TERMS AND CONDITIONS")


def known_texts() -> dict[str, list[str]]:
    """KNOWN and the whole texts: with and without titles, with and without what follows the terms,
    as the files break lines and with each paragraph on one line."""
    out = {k: list(v) for k, v in KNOWN.items()}
    for path in sorted(TEXTS.glob("*.txt")):
        out.setdefault(path.stem, []).append(path.read_text("utf-8"))
    for name, texts in out.items():
        whole = [t for t in texts if len(t) > 500]
        whole += [t[: m.end()] for t in whole if (m := TAIL.search(t))] + [t[: m.start()] for t in whole if (m := TAIL.search(t))]
        whole += [t[m.end() :] for t in whole if (m := HEAD.match(t))]
        whole += [f"{title}\n\n{t}" for t in whole for title in TITLES.get(name, [])]
        whole += [re.sub(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)", " ", t) for t in whole]
        out[name] = list(dict.fromkeys([*texts, *whole]))
    return out


def canonical(text: Column) -> Column:
    """The normalised text, words joined by single spaces; null counts as empty.

    In this order: lines that begin with "copyright", "(c)" or the copyright sign (after white
    space or comment marks) or say "all rights reserved" alone go; A-Z are lower-cased; every
    other character than letters, digits and white space becomes a space; listed spellings
    change; white space collapses.
    """
    t = F.coalesce(text, F.lit(""))
    t = F.regexp_replace(t, r"(?im)^[ \t*#/;-]*(?:(?:copyright|\(c\)|©)[^\n]*|all rights reserved\.?[ \t]*)$", " ")
    t = F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))
    words = F.transform(F.split(F.trim(t), " "), lambda w: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in SPELLINGS for x in pair]), w), w))
    return F.array_join(words, " ")


def registry(spark: SparkSession, known: dict[str, list[str]] | None = None) -> DataFrame:
    """(license_id, digest), one row per distinct digest; of licences whose texts normalise alike
    the first by name has it. Texts that normalise to nothing are left out."""
    rows = [(k, t) for k, texts in (known_texts() if known is None else known).items() for t in texts]
    made = spark.createDataFrame(rows, "license_id string, text string").select("license_id", canonical(F.col("text")).alias("c")).where("c <> ''")
    return made.groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame, text: str = "text", doc_id: str = "doc_id", most_known: int = 100_000) -> DataFrame:
    """One row per input row: doc_id, digest of the whole canonical text, license_id (null if the
    text as a whole is no known licence).

    Null, empty and letterless texts have the digest of nothing and no licence; rows that repeat
    are treated alike; further columns are ignored. The registry is broadcast if it has at most
    ``most_known`` rows; a larger one is joined by shuffle.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.sha2(canonical(F.col(text)), 256).alias("digest"))
    side = F.broadcast(known) if known.limit(most_known + 1).count() <= most_known else known
    return rows.join(side, "digest", "left").select("doc_id", "digest", "license_id")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), registry(spark))


_MAP = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in SPELLINGS) + "}"
_CANONICAL = f"""array_to_string(list_transform(string_split(trim(lower(regexp_replace(regexp_replace(coalesce(text, ''),
  '(?im)^[ \\t*#/;-]*(?:(?:copyright|\\(c\\)|©)[^\\n]*|all rights reserved\\.?[ \\t]*)$', ' ', 'g'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))), ' '), lambda w: coalesce({_MAP}[w], w)), ' ')"""
_KNOWN = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in (k, t)) + ")" for k, texts in KNOWN.items() for t in texts)
OP7_SQL = f"""
WITH k AS (SELECT min(license_id) AS license_id, digest FROM (SELECT license_id, sha256({_CANONICAL}) AS digest FROM (VALUES {_KNOWN}) AS v(license_id, text)) GROUP BY digest),
d AS (SELECT doc_id, sha256({_CANONICAL}) AS digest FROM documents)
SELECT d.doc_id, d.digest, k.license_id FROM d LEFT JOIN k ON d.digest = k.digest
"""
