"""Normalisers of names, affiliations, addresses and contact data, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import Normalization
from weftline.functions import fixed_values as V
from weftline.functions.text import fuzz_ratio, metaphone, squeeze, text, title_case, token_jaccard, words


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def in_case(c: Column, case: str) -> Column:
    return {"title": title_case, "upper": F.upper, "lower": F.lower}[case](c)


def normalize_name(c: Column, rules: Normalization = Normalization()) -> Column:
    """Without titles, suffixes and punctuation other than hyphens; null gives the empty string."""
    titles = "|".join(re.escape(t) for t in rules.titles)
    out = F.regexp_replace(F.trim(text(c)), rf"(?iU)\b(?:{titles})\b\.?", "")
    if rules.loose_suffixes:
        out = F.regexp_replace(out, rf"(?iU)\b(?:{'|'.join(re.escape(s) for s in rules.suffixes)})\.?", "")
    else:
        whole = sorted({s.rstrip(".") for s in rules.suffixes}, key=lambda s: (-len(s), s))
        out = F.regexp_replace(out, rf"(?iU)(?<!\w)(?:{'|'.join(map(re.escape, whole))})(?!\w)\.?", "")
    return in_case(squeeze(F.regexp_replace(out, r"(?U)[^\w\s-]", " ")), rules.case)


def split_name(c: Column) -> Column:
    """A struct of first, last and middle: one word is a last name; empty names are empty."""
    w = F.filter(F.split(squeeze(text(c)), " "), lambda x: x != "")
    n = F.size(w)
    return F.struct(
        F.when(n >= 2, F.get(w, F.lit(0))).otherwise("").alias("first"),
        F.when(n >= 1, F.try_element_at(w, F.lit(-1))).otherwise("").alias("last"),
        F.when(n >= 3, F.array_join(F.slice(w, F.lit(2), F.greatest(n - 2, F.lit(0))), " ")).otherwise("").alias("middle"),
    )


def normalize_names(df: DataFrame, rules: Normalization = Normalization()) -> DataFrame:
    """Adds norm_name, first and last names with their phonetic codes, and name_tokens."""
    made = df.withColumns({"norm_name": normalize_name(F.col("raw_name"), rules), "first_name_norm": normalize_name(F.col("first_name"), rules), "last_name_norm": normalize_name(F.col("last_name"), rules)})
    codes = {f"{part}_{how}": f(F.col(f"{part}_norm")) for part in ("last_name", "first_name") for how, f in (("metaphone", metaphone), ("soundex", F.soundex))}
    return made.withColumns(codes | {"name_tokens": F.filter(F.split("norm_name", " "), lambda w: w != "")})


def name_similarity(a: Column, b: Column) -> Column:
    """A struct of exact_match, fuzz_ratio, token_jaccard and phonetic_match of two names."""
    pairs = [(F.soundex(a), F.soundex(b)), (metaphone(a), metaphone(b))]
    there = [F.when((x != "") & (y != ""), 1).otherwise(0) for x, y in pairs]
    same = [F.when((x != "") & (x == y), 1).otherwise(0) for x, y in pairs]
    return F.struct(
        (F.lower(a) == F.lower(b)).cast("double").alias("exact_match"), (fuzz_ratio(a, b) / 100).alias("fuzz_ratio"),
        token_jaccard(words(a), words(b)).alias("token_jaccard"),
        F.when(sum(there[1:], there[0]) > 0, sum(same[1:], same[0]) / sum(there[1:], there[0])).otherwise(0.0).alias("phonetic_match"),
    )


def clean_affiliation(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.lower(F.trim(text(c))), r"(?U)[^\w\s&-]", " "))


def dictionary(spark: SparkSession, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """(variant, canonical), a row per lower-cased variant; of equal variants the last row counts."""
    given = list(enumerate(V.AFFILIATIONS if rows is None else rows))
    df = spark.createDataFrame([(i, c, v) for i, (c, v) in given], "pos int, canonical string, variant string")
    return last_of_each(df)


def last_of_each(df: DataFrame) -> DataFrame:
    return df.groupBy(F.lower(F.trim("variant")).alias("variant")).agg(F.max_by("canonical", "pos").alias("canonical"))


def add_affiliations(known: DataFrame, canonical: str, variants: list[str]) -> DataFrame:
    """The dictionary with further variants, which replace equal ones."""
    more = known.sparkSession.createDataFrame([(1, canonical, v) for v in [canonical, *variants]], "pos int, canonical string, variant string")
    return last_of_each(known.withColumn("pos", F.lit(0)).select("pos", "canonical", "variant").unionByName(more))


def dictionary_stats(known: DataFrame) -> DataFrame:
    return known.agg(F.count_distinct("canonical").alias("canonical_names"), F.count("*").alias("variants"), (F.count("*") / F.count_distinct("canonical")).alias("avg_variants"))


def affiliation_tokens(c: Column) -> Column:
    return F.filter(words(c), lambda w: ~w.isin(V.AFFILIATION_STOP_WORDS))


#: A dictionary is broadcast up to this many rows and shuffled beyond.
MOST_BROADCAST = 1_000_000


def normalize_affiliations(df: DataFrame, known: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds norm_affiliation and affiliation_tokens. A cleaned affiliation is looked up; those
    not found take the most similar canonical name of at least ``threshold`` (ties by name), and
    else stay in title case. Similarity is computed once for each distinct string not found."""
    if "affiliation" not in df.columns:
        return df
    small = known.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    side = F.broadcast(known) if small else known
    cleaned = df.withColumn("__clean", clean_affiliation(F.col("affiliation")))
    distinct = cleaned.select(F.col("__clean").alias("variant")).where("variant <> ''").distinct()
    missed = distinct.join(side, "variant", "left_anti")
    names = known.select("canonical").distinct()
    bare = lambda c: F.trim(F.regexp_replace(F.lower(c), r"(?U)[^\p{L}\p{N}]", " "))
    # a query set (the few distinct strings not found) against the dictionary's names
    scored = missed.crossJoin(F.broadcast(names) if small else names).withColumn("score", fuzz_ratio(bare(F.col("variant")), bare(F.col("canonical"))) / 100)
    best = scored.groupBy("variant").agg(F.max("score").alias("score"), F.min_by("canonical", F.struct(-F.col("score"), F.col("canonical"))).alias("canonical")).where(F.col("score") >= threshold)
    lookup = known.select("variant", "canonical").unionByName(best.select("variant", "canonical")).withColumnsRenamed({"variant": "__clean", "canonical": "__canonical"})
    found = cleaned.join(lookup, "__clean", "left").withColumn("norm_affiliation", F.coalesce("__canonical", title_case(F.col("__clean"))))
    return found.drop("__clean", "__canonical").withColumn("affiliation_tokens", affiliation_tokens(F.col("norm_affiliation")))


def affiliation_similarity(a: Column, b: Column, canonical_a: Column, canonical_b: Column) -> Column:
    return F.struct(
        (F.lower(a) == F.lower(b)).cast("double").alias("exact_match"), (fuzz_ratio(a, b) / 100).alias("fuzz_ratio"),
        token_jaccard(affiliation_tokens(a), affiliation_tokens(b)).alias("token_jaccard"), (canonical_a == canonical_b).cast("double").alias("canonical_match"),
    )


def normalize_city(c: Column) -> Column:
    return title_case(squeeze(F.regexp_replace(text(c), r"(?U)[^\w\s]", " ")))


def normalize_state(c: Column) -> Column:
    """Any two letters in upper case, or the code of a full name, or nothing."""
    s = F.lower(F.trim(text(c)))
    return F.when(s.rlike(r"^\p{L}{2}$"), F.upper(s)).otherwise(F.coalesce(F.try_element_at(_map(V.STATES), s), F.lit("")))


def normalize_zip(c: Column) -> Column:
    return F.left(F.regexp_extract(text(c), r"\d{5}(-\d{4})?", 0), F.lit(5))


def normalize_street(c: Column) -> Column:
    known = _map(V.DIRECTIONS | V.STREET_TYPES)
    return F.array_join(F.transform(words(c), lambda w: F.coalesce(F.try_element_at(known, w), title_case(w))), " ")


_DIRECTION = "(?:" + "|".join([*V.DIRECTIONS, "NE", "NW", "SE", "SW", "N", "S", "E", "W"]) + r")\.?"
_TYPE = "(?:" + "|".join([*V.STREET_TYPES, *V.STREET_TYPES.values()]) + r")\.?"
#: number [direction] street [type] [direction][, second line], city, state zip
ADDRESS = rf"(?i)^\s*(\d+[A-Za-z]?(?:-\d+)?)\s+(?:{_DIRECTION}\s+)?([^,]+?)(?:\s+({_TYPE}))?(?:\s+{_DIRECTION})?\s*(?:,\s*([^,]*?)\s*)?,\s*([^,]+?)\s*,\s*([A-Za-z][A-Za-z .]*?)\.?\s+(\d{{5}}(?:-\d{{4}})?)\s*$"


def parse_address(c: Column) -> Column:
    """A struct of the parts of a well-formed US address; what has no such form is line 1 alone."""
    a = text(c)
    good = a.rlike(ADDRESS)
    part = lambda n: F.when(good, F.trim(F.regexp_extract(a, ADDRESS, n))).otherwise("")
    number, street, kind = part(1), part(2), F.regexp_replace(part(3), r"\.$", "")
    return F.struct(
        number.alias("street_number"), street.alias("street_name"), kind.alias("street_type"), part(5).alias("city"), part(6).alias("state"), part(7).alias("zip"),
        F.when(good, squeeze(F.concat_ws(" ", number, street, kind))).otherwise(a).alias("line_1"), part(4).alias("line_2"),
    )


def normalize_phone(c: Column) -> Column:
    """E.164 of a North American number (area code and exchange from 2 up), or nothing. Numbers
    that begin with + and another country's code stay if they have 8 to 15 digits."""
    given = F.trim(text(c))
    digits = F.regexp_replace(given, r"\D", "")
    national = F.regexp_extract(digits, r"^1?([2-9]\d{2}[2-9]\d{6})$", 1)
    shaped = given.rlike(r"^[+\d\s().\-/]+$")
    return F.when(shaped & (national != ""), F.concat(F.lit("+1"), national)).when(shaped & given.startswith("+") & ~digits.startswith("1") & F.length(digits).between(8, 15), F.concat(F.lit("+"), digits)).otherwise("")


def normalize_email(c: Column) -> Column:
    e = F.lower(F.trim(text(c)))
    return F.when(F.contains(F.coalesce(F.get(F.split(e, "@"), F.lit(1)), F.lit("")), F.lit(".")), e).otherwise("")


def normalize_addresses(df: DataFrame) -> DataFrame:
    """Adds the address's parts, normalised, and phone_norm and email_norm."""
    p = F.col("__parsed")
    return df.withColumn("__parsed", parse_address(F.col("address"))).withColumns({
        "street_number": p["street_number"], "street_name": normalize_street(p["street_name"]), "street_type": title_case(p["street_type"]),
        "city_norm": normalize_city(p["city"]), "state_norm": normalize_state(p["state"]), "zip_norm": normalize_zip(p["zip"]),
        "address_line_1_norm": normalize_street(p["line_1"]), "address_line_2_norm": p["line_2"],
        "phone_norm": normalize_phone(F.col("phone")), "email_norm": normalize_email(F.col("email")),
    }).drop("__parsed")


def address_similarity(a: Column, b: Column) -> Column:
    """Of two normalised address structs; equal empty parts count as equal, location_match not."""
    same = lambda f: (F.lower(a[f]) == F.lower(b[f])).cast("double")
    there = lambda f: (a[f] != "") & (F.lower(a[f]) == F.lower(b[f]))
    return F.struct(same("line_1").alias("street_match"), same("city").alias("city_match"), same("state").alias("state_match"), same("zip").alias("zip_match"), ((there("city") & there("state")) | there("zip")).cast("double").alias("location_match"))


def normalize(df: DataFrame, rules: Normalization = Normalization(), known: DataFrame | None = None) -> DataFrame:
    """Names, affiliations, addresses and contact data of provider records."""
    known = dictionary(df.sparkSession) if known is None else known
    # the affiliations' join may gather many rows in a few tasks, so it comes last
    named = normalize_names(df, rules)
    placed = normalize_addresses(named)
    done = normalize_affiliations(placed, known, rules.affiliation_threshold)
    added = [c for c in done.columns if c not in placed.columns]
    return done.select(*named.columns, *added, *[c for c in placed.columns if c not in named.columns])
