"""String functions: built-in expressions, and Arrow UDFs where Spark has no equivalent."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType

from weftline.functions import similar


def text(c: Column) -> Column:
    """Null as the empty string."""
    return F.coalesce(c, F.lit(""))


def squeeze(c: Column) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def title_case(c: Column) -> Column:
    """The first letter of every run of letters in upper case, the others in lower case."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(?U)(\p{L}+|[^\p{L}]+)"), 1), F.initcap), "")


def words(c: Column) -> Column:
    """Lower-cased words between white space."""
    return F.filter(F.split(F.lower(text(c)), r"(?U)\s+"), lambda w: w != "")


def token_jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct words; 0 if neither side has any. Takes arrays."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def within_edits(a: Column, b: Column, most: int) -> Column:
    """Levenshtein distance of at most ``most``; the built-in stops early at the threshold."""
    return F.levenshtein(a, b, most) >= 0


def edits_normalized(a: Column, b: Column) -> Column:
    """Levenshtein distance over the longer length: a distance, 0 for two empty strings."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, F.levenshtein(a, b) / longest).otherwise(F.lit(0.0))


def length_difference(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, F.abs(F.length(a) - F.length(b)) / longest).otherwise(F.lit(0.0))


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word of columns at a time."""
    if not a or not b:
        return 0
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    state = full = (1 << len(a)) - 1
    for c in b:
        hit = state & place.get(c, 0)
        state = (state + hit) | (state - hit)
    return (~state & full).bit_count()


def ratio(a: str, b: str) -> int:
    """100 * 2 * LCS / (|a| + |b|), rounded half to even; 100 for two empty strings."""
    total = len(a) + len(b)
    return round(200 * lcs_length(a, b) / total) if total else 100


@F.arrow_udf(IntegerType())
def fuzz_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """Case-sensitive similarity from 0 to 100; null if either side is."""
    return similar.by_pairs(similar.ratios, ratio, "int32")(a, b)


def jaro_winkler_of(a: str, b: str, weight: float = 0.1) -> float:
    """Jaro similarity, raised by a common prefix of up to four characters where it is over 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    window = max(max(len(a), len(b)) // 2 - 1, 0)
    used, matched = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - window), min(len(b), i + window + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                matched.append(c)
                break
    m = len(matched)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(matched, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * weight * (1 - jaro)


@F.arrow_udf(DoubleType())
def jaro_winkler(a: pa.Array, b: pa.Array) -> pa.Array:
    return similar.by_pairs(similar.jaro_winklers, jaro_winkler_of, "float64")(a, b)


#: Rules of the original Metaphone, tried in order at each letter: letter, what must follow the
#: place and what must precede it (patterns; empty: anything), the code, the letters used.
_RULES = [
    ("A", "", r"^$", "A", 1), ("E", "", r"^$", "E", 1), ("I", "", r"^$", "I", 1), ("O", "", r"^$", "O", 1), ("U", "", r"^$", "U", 1),
    ("B", r"$", r"M$", "", 1), ("B", "", "", "B", 1),
    ("C", "IA", "", "X", 1), ("C", "H", r"S$", "K", 2), ("C", "H", "", "X", 2), ("C", "[EIY]", r"S$", "", 1), ("C", "[EIY]", "", "S", 1), ("C", "", "", "K", 1),
    ("D", "G[EIY]", "", "J", 2), ("D", "", "", "T", 1),
    ("F", "", "", "F", 1),
    ("G", r"H(?![AEIOU]|$)", "", "", 2), ("G", r"N(ED)?$", "", "", 1), ("G", "[EIY]", r"(?<!G)$", "J", 1), ("G", "H", "", "K", 2), ("G", "", "", "K", 1),
    ("H", "[AEIOU]", r"(?<![CSPTG])$", "H", 1),
    ("J", "", "", "J", 1), ("K", "", r"(?<!C)$", "K", 1), ("L", "", "", "L", 1), ("M", "", "", "M", 1), ("N", "", "", "N", 1),
    ("P", "H", "", "F", 2), ("P", "", "", "P", 1), ("Q", "", "", "K", 1), ("R", "", "", "R", 1),
    ("S", "H", "", "X", 2), ("S", "I[AO]", "", "X", 1), ("S", "", "", "S", 1),
    ("T", "I[AO]", "", "X", 1), ("T", "H", "", "0", 2), ("T", "CH", "", "", 1), ("T", "", "", "T", 1),
    ("V", "", "", "F", 1), ("W", "[AEIOU]", "", "W", 1), ("X", "", r"^$", "S", 1), ("X", "", "", "KS", 1), ("Y", "[AEIOU]", "", "Y", 1), ("Z", "", "", "S", 1),
]
_BY_LETTER: dict[str, list] = {}
for _letter, _next, _before, _code, _used in _RULES:
    _BY_LETTER.setdefault(_letter, []).append((re.compile(_next), re.compile(_before), _code, _used))


def metaphone_of(word: str) -> str:
    """Metaphone code of the letters A-Z of a word; other characters are skipped."""
    s = re.sub("[^A-Z]", "", word.upper())
    s = re.sub(r"^(?:[KGP]N|AE|WR)", lambda m: m[0][1:], s)
    s = re.sub(r"^WH", "W", re.sub(r"^X", "S", s))
    s = re.sub(r"([^C])\1+", r"\1", s)
    out, i = [], 0
    while i < len(s):
        for follows, before, code, used in _BY_LETTER.get(s[i], []):
            if follows.match(s, i + 1) and before.search(s[:i]):
                out.append(code)
                i += used
                break
        else:
            i += 1
    return "".join(out)


@F.pandas_udf(StringType())
def metaphone(c: pd.Series) -> pd.Series:
    """Metaphone code; null and empty words have the empty code."""
    return c.fillna("").map(metaphone_of)


def block_hash(c: Column) -> Column:
    """The first 16 hex digits of the MD5 digest."""
    return F.left(F.md5(c), F.lit(16))


def canonical_hash(c: Column) -> Column:
    """PROV- and the first 16 hex digits of the SHA-256 digest, in upper case."""
    return F.concat(F.lit("PROV-"), F.upper(F.left(F.sha2(c, 256), F.lit(16))))


def register(spark: SparkSession) -> None:
    """Make the functions available to SQL under their names."""
    spark.udf.register("fuzz_ratio", fuzz_ratio)
    spark.udf.register("jaro_winkler", jaro_winkler)
    spark.udf.register("metaphone", metaphone)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION title_case(s STRING) RETURNS STRING RETURN array_join(transform(regexp_extract_all(s, '(?U)(\\\\p{L}+|[^\\\\p{L}]+)', 1), w -> initcap(w)), '')")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION token_jaccard(a STRING, b STRING) RETURNS DOUBLE RETURN coalesce(size(array_intersect(filter(split(lower(a), ' +'), w -> w <> ''), filter(split(lower(b), ' +'), w -> w <> ''))) / nullif(size(array_union(filter(split(lower(a), ' +'), w -> w <> ''), filter(split(lower(b), ' +'), w -> w <> ''))), 0), 0.0)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION block_key(s STRING) RETURNS STRING RETURN left(md5(s), 16)")
