"""Pair scores: weighted rules, an optional model's probability, and the decision."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.config import Thresholds, Weights
from weftline.functions.text import fuzz_ratio, jaro_winkler, within_edits, words

COMPARED = ("norm_name", "norm_affiliation", "city_norm", "state_norm", "zip_norm", "address_line_1_norm", "phone_norm", "email_norm", "source", "provider_id")
#: Those of them that are compared without regard to case.
LOWERED = ("norm_name", "norm_affiliation", "city_norm", "state_norm", "address_line_1_norm", "email_norm")
SCORES = ("name_exact_match", "name_levenshtein_match", "name_fuzz_ratio_match", "affiliation_jaccard_similarity", "location_location_match", "contact_contact_match")


def compared(records: DataFrame, columns: tuple[str, ...] = COMPARED) -> list[Column]:
    """The columns that pairs are compared by, as strings (null as empty), those of LOWERED in lower
    case, and the distinct words of the affiliation: made once for a record, which is in many pairs."""
    plain = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns if c in records.columns}
    made = {f"low_{c}": F.lower(plain[c]) for c in LOWERED if c in plain}
    made |= {"affiliation_words": F.array_distinct(words(plain["norm_affiliation"]))} if "norm_affiliation" in plain else {}
    return [v.alias(c) for c, v in (plain | made).items()]


def with_records(pairs: DataFrame, records: DataFrame, columns: tuple[str, ...] = COMPARED, record_id: str = "record_id") -> DataFrame:
    """The pairs with both records' ``compared`` columns, as <column>_1 and <column>_2."""
    plain = records.select(F.col(record_id).alias("record_id"), *compared(records, columns))
    side = lambda n: plain.select(*[F.col(c).alias(f"{c}_{n}") for c in plain.columns])
    return pairs.join(side(1), "record_id_1").join(side(2), "record_id_2")


def _flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def _same(column: str, case: bool = True) -> Column:
    kind = "low_" if case else ""
    a, b = F.col(f"{kind}{column}_1"), F.col(f"{kind}{column}_2")
    return (a != "") & (a == b)


def words_jaccard() -> Column:
    """Of two affiliations' words; equal strings have equal words."""
    a, b, x, y = F.col("norm_affiliation_1"), F.col("norm_affiliation_2"), F.col("affiliation_words_1"), F.col("affiliation_words_2")
    shared = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - shared
    return F.when((a == "") | (b == ""), 0.0).when(a == b, _flag(F.size(x) > 0)).when(union > 0, shared / union).otherwise(0.0)


def near_names(t: Thresholds) -> Column:
    """The ratio can be at least r only if the edit distance is at most (100 - r + 0.5) % of both lengths."""
    a, b = F.col("norm_name_1"), F.col("norm_name_2")
    most = (100.5 - t.least_fuzz) / 100 * (F.length(a) + F.length(b))
    few = F.levenshtein(a, b, 2)  # stops early
    return (F.abs(F.length(a) - F.length(b)) <= most) & F.when(most < 3, (few >= 0) & (few <= most)).otherwise(F.levenshtein(a, b) <= most)


def deterministic_scores(pairs: DataFrame, records: DataFrame, weights: Weights = Weights(), thresholds: Thresholds = Thresholds(), record_id: str = "record_id", with_jaro: bool = True) -> DataFrame:
    """The pairs with name, affiliation, location and contact similarities and their weighted sum,
    added in the order of the weights. Without ``with_jaro`` names have no name_fuzz_ratio either,
    so that few pairs need one."""
    return scored(with_records(pairs, records, record_id=record_id), weights, thresholds, with_jaro)


def scored(joined: DataFrame, weights: Weights = Weights(), thresholds: Thresholds = Thresholds(), with_jaro: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``deterministic_scores`` of pairs that have both records' columns already, in one pass over
    them; ``keep`` are further columns of theirs to keep."""
    a, b, x, y = F.col("norm_name_1"), F.col("norm_name_2"), F.col("norm_affiliation_1"), F.col("norm_affiliation_2")
    named, placed = (a != "") & (b != ""), (x != "") & (y != "")
    # unless all ratios are wanted, only those that may matter are computed
    asked = named & (F.lit(True) if with_jaro else (a != b) & near_names(thresholds))
    # first what needs no Python, so that what goes through it is narrow
    made = {
        "name_exact_match": _flag(_same("norm_name")), "name_levenshtein_match": _flag(named & within_edits(F.col("low_norm_name_1"), F.col("low_norm_name_2"), thresholds.most_edits)),
        "affiliation_exact_match": _flag(_same("norm_affiliation")), "affiliation_jaccard_similarity": words_jaccard(),
        "location_city_match": _flag(_same("city_norm")), "location_state_match": _flag(_same("state_norm")), "location_zip_match": _flag(_same("zip_norm", False)), "location_street_match": _flag(_same("address_line_1_norm")),
        "location_location_match": _flag((_same("city_norm") & _same("state_norm")) | _same("zip_norm", False)),
        "contact_phone_match": _flag(_same("phone_norm", False)), "contact_email_match": _flag(_same("email_norm")), "contact_contact_match": _flag(_same("phone_norm", False) | _same("email_norm")),
        "__same": named & (a == b), "__a": F.when(asked, a), "__b": F.when(asked, b), "__x": F.when(placed, x), "__y": F.when(placed, y), "__l": F.col("low_norm_name_1"), "__m": F.col("low_norm_name_2"),
    }
    plain = joined.select("record_id_1", "record_id_2", "block_key", "strategy", *keep, *[c.alias(k) for k, c in made.items()])
    ratio = F.coalesce(fuzz_ratio("__a", "__b"), F.lit(0))
    parts = {"name_fuzz_ratio": ratio / 100, "name_fuzz_ratio_match": _flag(F.when(F.col("__same"), thresholds.least_fuzz <= 100).otherwise(ratio >= thresholds.least_fuzz)), "affiliation_fuzz_ratio": F.coalesce(fuzz_ratio("__x", "__y") / 100, F.lit(0.0))}
    if with_jaro:
        parts["name_jaro_winkler"] = F.when((F.col("__l") != "") & (F.col("__m") != ""), jaro_winkler("__l", "__m")).otherwise(0.0)
    else:  # the ratios of a few pairs
        del parts["name_fuzz_ratio"]
    order = ("name_exact_match", "name_levenshtein_match", "name_fuzz_ratio", "name_fuzz_ratio_match", "name_jaro_winkler", "affiliation_exact_match", "affiliation_jaccard_similarity", "affiliation_fuzz_ratio")
    told = [c for c in (*order, *[k for k in made if k.startswith(("location_", "contact_"))]) if c in made or c in parts]
    return plain.withColumns(parts).select("record_id_1", "record_id_2", "block_key", "strategy", *keep, *told, weighted(weights).alias("deterministic_score"))


def weighted(w: Weights) -> Column:
    """The weighted sum of the six scores; missing ones count as 0."""
    of = (w.name_exact, w.name_fuzzy, w.name_fuzzy_fuzz, w.affiliation, w.location, w.contact)
    total = None
    for weight, name in zip(of, SCORES, strict=True):
        term = F.lit(float(weight)) * F.coalesce(F.col(name), F.lit(0.0))
        total = term if total is None else total + term
    return total


def decision(score: Column, t: Thresholds = Thresholds()) -> Column:
    """AUTO_MERGE, AUDIT or REJECT; scores that are null or not a number are rejected."""
    sound = score.isNotNull() & ~F.isnan(score)
    return F.when(sound & (score >= t.auto_merge), "AUTO_MERGE").when(sound & (score >= t.audit_low) & (score < t.audit_high), "AUDIT").otherwise("REJECT")


def hybrid_scores(scored: DataFrame, predictions: DataFrame | None = None, weights: Weights = Weights(), thresholds: Thresholds = Thresholds(), keep: tuple[str, ...] = ()) -> DataFrame:
    """The hybrid score and decision of each pair, and its columns to ``keep``. ``predictions`` (record_id_1, record_id_2,
    match_probability) are joined by the pair; without one the rules alone count."""
    base = scored.withColumn("deterministic_score", weighted(weights))
    if predictions is not None:
        base = base.join(predictions.select("record_id_1", "record_id_2", F.col("match_probability").alias("__ml")), ["record_id_1", "record_id_2"], "left")
    else:
        base = base.withColumn("__ml", F.lit(None).cast("double"))
    mixed = (1 - weights.ml_model) * F.col("deterministic_score") + weights.ml_model * F.col("__ml")
    done = base.withColumn("ml_probability", F.coalesce("__ml", F.lit(0.0))).withColumn("hybrid_score", F.when(F.col("__ml").isNull(), F.col("deterministic_score")).otherwise(mixed)).withColumn("decision", decision(F.col("hybrid_score"), thresholds))
    flags = {"auto_merge": "AUTO_MERGE", "audit_required": "AUDIT", "reject": "REJECT"}
    return done.withColumns({k: F.col("decision") == v for k, v in flags.items()}).select("record_id_1", "record_id_2", "block_key", "strategy", *SCORES, "deterministic_score", "ml_probability", "hybrid_score", "decision", *flags, *keep)


def score_stats(df: DataFrame, score: str = "deterministic_score") -> DataFrame:
    """One row: mean, median, sample deviation, least and greatest score, and five bins."""
    s = F.col(score)
    return df.agg(
        F.avg(s).alias("mean"), F.median(s).alias("median"), F.stddev_samp(s).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"),
        F.count_if(s <= 0.2).alias("bin_0_2"), F.count_if((s > 0.2) & (s <= 0.4)).alias("bin_2_4"), F.count_if((s > 0.4) & (s <= 0.6)).alias("bin_4_6"), F.count_if((s > 0.6) & (s <= 0.8)).alias("bin_6_8"), F.count_if(s > 0.8).alias("bin_8_up"),
    )


def scoring_stats(hybrid: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """One row of totals, counts and shares by threshold (the audit band ends at auto_merge)."""
    s = F.col("hybrid_score")
    bands = {"auto_merge": s >= t.auto_merge, "audit": (s >= t.audit_low) & (s < t.auto_merge), "reject": s < t.audit_low}
    return hybrid.agg(
        F.count("*").alias("total_pairs"), F.avg(s).alias("mean_score"), F.median(s).alias("median_score"), F.stddev_samp(s).alias("std_score"), F.min(s).alias("min_score"), F.max(s).alias("max_score"),
        *[F.count_if(b).alias(f"{k}_count") for k, b in bands.items()], *[F.try_divide(F.count_if(b) * 100.0, F.count("*")).alias(f"{k}_percentage") for k, b in bands.items()],
    )


def decision_counts(hybrid: DataFrame) -> DataFrame:
    return hybrid.groupBy("decision").agg(F.count("*").alias("n"))


def threshold_grid(labelled: DataFrame, score: str = "hybrid_score", label: str = "label", start: int = 50, stop: int = 94) -> DataFrame:
    """Precision, recall and F1 of ``score >= threshold`` at each hundredth. The labelled rows are
    first counted by the last hundredth that they reach, so they are read once."""
    reach = F.greatest(F.lit(start - 1), F.least(F.lit(stop), F.floor(F.round(F.col(score) * 100, 9)).cast("int")))
    counts = labelled.where(F.col(score).isNotNull() & ~F.isnan(score)).groupBy(reach.alias("reach")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    # at most stop - start + 2 rows
    spread = counts.select("*", F.explode(F.sequence(F.lit(start), F.lit(stop))).alias("t"))
    at = spread.groupBy("t").agg(F.sum(F.when(F.col("reach") >= F.col("t"), F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(F.col("reach") >= F.col("t"), F.col("neg")).otherwise(0)).alias("fp"), F.sum("pos").alias("all_pos"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    rates = at.select((F.col("t") / 100).alias("threshold"), "tp", "fp", (F.col("all_pos") - F.col("tp")).alias("fn"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("all_pos")).alias("recall"))
    return rates.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def best_thresholds(grid: DataFrame, precision: float = 0.92, recall: float = 0.88, default: Thresholds = Thresholds()) -> DataFrame:
    """One row auto_merge, audit_low, audit_high: the first threshold with the best F1 among those
    that meet both targets, or the default's."""
    good = (F.col("precision") >= precision) & (F.col("recall") >= recall) & (F.col("f1") > 0)
    best = F.coalesce(F.max_by(F.when(good, F.col("threshold")), F.when(good, F.struct("f1", -F.col("threshold")))), F.lit(default.auto_merge))
    return grid.agg(best.alias("auto_merge")).select("auto_merge", F.greatest(F.lit(0.5), F.round(F.col("auto_merge") - 0.2, 9)).alias("audit_low"), F.col("auto_merge").alias("audit_high"))


def optimized(row, default: Thresholds = Thresholds()) -> Thresholds:
    """Thresholds with the values of a row of ``best_thresholds``."""
    return replace(default, auto_merge=row["auto_merge"], audit_low=row["audit_low"], audit_high=row["audit_high"])
