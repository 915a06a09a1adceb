"""The registered queries of the record engine, with SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import Blocking, Config, Strategy
from weftline.functions import fixed_values as V
from weftline.functions import normalize as N
from weftline.functions import text as T
from weftline.operators import audit, blocking, linking, merge, ml, quality, report, scoring
from weftline.plans import fixtures as X
from weftline.session import cut, prepare

#: Strategies whose keys SQL can express, too: phonetic codes by Soundex only.
PLAIN = Blocking((Strategy("location_name", ("state_norm", "zip_norm[:3]", "last_name_soundex", "first_name_soundex")), Strategy("address_hash", ("city_norm", "address_line_1_norm[:3]"))))
TOKENS = Blocking((Strategy("affiliation_tokens", ("state_norm", "affiliation_tokens"), tokens=True),))


def r6(c, name):
    return F.round(c, 6).alias(name)


def _normal(s: SparkSession, d: str) -> DataFrame:
    prepare(s)
    return N.normalize(X.providers(s, d))


# --- scalar functions and normalisers -------------------------------------------------------
def normalize_names(s, d):
    return N.normalize_names(X.providers(s, d)).select("record_id", "norm_name", "first_name_norm", "last_name_norm", F.array_join("name_tokens", " ").alias("tokens"))


def title_case(s, d):
    p = X.table(s, d, "part")
    return p.select("p_partkey", T.title_case(F.concat_ws(" ", F.lower("p_name"), F.lower(F.col("p_type")))).alias("title"))


def normalize_address(s, d):
    return N.normalize_addresses(X.providers(s, d)).select("record_id", "street_number", "street_name", "street_type", "city_norm", "state_norm", "zip_norm", "address_line_1_norm", "address_line_2_norm")


def normalize_contact(s, d):
    return X.providers(s, d).select("record_id", N.normalize_phone(F.col("phone")).alias("phone_norm"), N.normalize_email(F.col("email")).alias("email_norm"))


def normalize_state_names(s, d):
    n = X.table(s, d, "nation")
    c = F.lower("n_name")
    return n.select("n_nationkey", N.normalize_state(F.when(F.col("n_nationkey") % 2 == 0, F.left("n_name", F.lit(2))).otherwise(F.element_at(F.array(*[F.lit(k) for k in V.STATES]), (F.col("n_nationkey") * 2 + 1).cast("int")))).alias("state"), N.normalize_city(c).alias("city"))


def normalize_streets(s, d):
    kinds = F.array(*[F.lit(k) for k in [*V.DIRECTIONS, *V.STREET_TYPES]])
    return X.table(s, d, "supplier").select("s_suppkey", N.normalize_street(F.concat_ws(" ", F.col("s_suppkey").cast("string"), F.element_at(kinds, (F.col("s_suppkey") % 20 + 1).cast("int")), F.lit("oAK-hill"), F.element_at(kinds, ((F.col("s_suppkey") + 9) % 20 + 1).cast("int")))).alias("street"))


def soundex_codes(s, d):
    return X.providers(s, d).select("record_id", F.soundex("last_name").alias("last_soundex"), F.soundex("first_name").alias("first_soundex"))


def metaphone_codes(s, d):
    return X.providers(s, d).select("last_name").distinct().select("last_name", T.metaphone("last_name").alias("code"))


def affiliation_exact(s, d):
    return N.normalize_affiliations(X.providers(s, d), N.dictionary(s)).select("record_id", "norm_affiliation", F.array_join("affiliation_tokens", " ").alias("tokens"))


def affiliation_fuzzy(s, d):
    nat = X.table(s, d, "nation").select("n_nationkey", F.concat(F.lit("clinic of "), F.lower("n_name")).alias("affiliation"))
    return N.normalize_affiliations(nat, N.dictionary(s)).select("n_nationkey", "norm_affiliation")


def dictionary_stats(s, d):
    return N.dictionary_stats(N.dictionary(s)).select("canonical_names", "variants", r6("avg_variants", "avg_variants"))


def split_names(s, d):
    n = N.split_name(F.col("raw_name"))
    return X.providers(s, d).select("record_id", n["first"].alias("first"), n["middle"].alias("middle"), n["last"].alias("last"))


def _name_pairs(s, d):
    """Neighbouring keys' names: entities with themselves and with others."""
    p = X.providers(s, d).select("record_id", "raw_name")
    return p.select("record_id", F.col("raw_name").alias("a")).join(p.select((F.col("record_id") - 1).alias("record_id"), F.col("raw_name").alias("b")), "record_id")


def fuzz_ratio_pairs(s, d):
    return _name_pairs(s, d).select("record_id", T.fuzz_ratio("a", "b").alias("ratio"))


def edit_pairs(s, d):
    a, b = F.col("a"), F.col("b")
    return _name_pairs(s, d).select("record_id", T.within_edits(F.lower(a), F.lower(b), 2).alias("within_2"), r6(T.edits_normalized(a, b), "edits"), r6(T.length_difference(a, b), "length_diff"), r6(T.token_jaccard(F.array_distinct(T.words(a)), F.array_distinct(T.words(b))), "jaccard"))


def jaro_winkler_pairs(s, d):
    return _name_pairs(s, d).select("record_id", r6(T.jaro_winkler(F.lower("a"), F.lower("b")), "jw"))


def name_similarity(s, d):
    n = N.name_similarity(F.col("a"), F.col("b"))
    return _name_pairs(s, d).select("record_id", n["exact_match"].alias("exact_match"), r6(n["fuzz_ratio"], "fuzz_ratio"), r6(n["token_jaccard"], "token_jaccard"), r6(n["phonetic_match"], "phonetic_match"))


# --- validation ------------------------------------------------------------------------------
def _dirty(s, d):
    """Providers with missing values, bad formats and repeated ids."""
    k = F.col("record_id")
    p = X.providers(s, d)
    return p.withColumns({
        "email": F.when(k % 50 == 7, F.lit(None)).when(k % 50 == 8, "bad").otherwise(F.col("email")), "phone": F.when(k % 60 == 9, "ext x").otherwise(F.col("phone")),
        "raw_name": F.when(k % 70 == 11, "X").otherwise(F.col("raw_name")), "source": F.when(k % 80 == 13, "Other").otherwise(F.col("source")), "provider_id": F.when(k % 40 == 1, F.concat(F.lit("P"), (k - 1).cast("string"))).otherwise(F.col("provider_id")),
    })


def validation_report(s, d):
    return quality.validation_report(_dirty(s, d))


def validation_summary(s, d):
    return quality.validation_summary(quality.validation_report(_dirty(s, d))).withColumn("success_rate", F.round("success_rate", 6))


def clean_providers(s, d):
    return quality.clean(_dirty(s, d)).select("record_id", "provider_id")


# --- blocking --------------------------------------------------------------------------------
def block_keys(s, d):
    b = blocking.block_keys(blocking.block_keys(_normal(s, d), PLAIN), TOKENS)
    return b.select("record_id", "block_location_name", "block_address_hash", "block_affiliation_tokens")


#: What pairs and merged records are made of.
KEPT = ("record_id", "true_entity", "first_name_soundex", "last_name_soundex", *scoring.COMPARED)


def _blocked(s, d):
    n = cut(_normal(s, d).select(*KEPT))
    return n, blocking.block_keys(n, PLAIN)


def _paired(s, d):
    """Candidate pairs with what they are compared by and the entities that their records are of."""
    n, blocked = _blocked(s, d)
    return blocking.paired(blocked, PLAIN, [*scoring.compared(n), F.col("true_entity")])


def candidate_pairs(s, d):
    return blocking.candidate_pairs(_blocked(s, d)[1], PLAIN)


def blocking_stats(s, d):
    _, blocked = _blocked(s, d)
    out = blocking.blocking_stats(blocked, None, PLAIN.strategies, made=blocking.count_pairs(blocked, PLAIN))
    return out.withColumns({c: F.round(c, 6) for c in ("avg_block_size", "coverage", "reduction_ratio")})


# --- scoring ---------------------------------------------------------------------------------
def _scored(s, d, jaro=False, keep=()):
    return scoring.scored(_paired(s, d), with_jaro=jaro, keep=keep)


def deterministic_scores(s, d):
    out = _scored(s, d, True)
    return out.select("record_id_1", "record_id_2", "strategy", *[r6(c, c) for c in out.columns if c.startswith(("name_", "affiliation_", "location_", "contact_", "deterministic"))])


def score_stats(s, d):
    out = scoring.score_stats(_scored(s, d))
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "median", "std", "min", "max")})


def hybrid_decisions(s, d):
    return scoring.hybrid_scores(_scored(s, d)).select("record_id_1", "record_id_2", r6("hybrid_score", "hybrid_score"), "decision", "auto_merge", "audit_required", "reject")


def scoring_stats(s, d):
    out = scoring.scoring_stats(scoring.hybrid_scores(_scored(s, d)))
    return out.withColumns({c: F.round(c, 6) for c, t in out.dtypes if t == "double"})


def decision_counts(s, d):
    return scoring.decision_counts(scoring.hybrid_scores(_scored(s, d)))


def _labelled(s, d):
    entities = ("true_entity_1", "true_entity_2")
    h = scoring.hybrid_scores(_scored(s, d, keep=entities), keep=entities)
    return h.withColumn("label", (F.col("true_entity_1") == F.col("true_entity_2")).cast("int"))


def threshold_search(s, d):
    return scoring.threshold_grid(_labelled(s, d)).select(r6("threshold", "threshold"), "tp", "fp", "fn", r6("precision", "precision"), r6("recall", "recall"), r6("f1", "f1"))


def best_thresholds(s, d):
    return scoring.best_thresholds(scoring.threshold_grid(_labelled(s, d)), 0.9, 0.5)


# --- merging ---------------------------------------------------------------------------------
def _merged(s, d):
    n, _ = _blocked(s, d)
    return (n, *merge.apply_merges(merge.groups(linking.merging_links(n, PLAIN), n), n))


def merge_groups(s, d):
    """The groups of all blocks, however large."""
    n, _ = _blocked(s, d)
    return merge.groups(linking.merging_links(n, replace(PLAIN, most_per_block=None)), n)


def merged_providers(s, d):
    join = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return _merged(s, d)[1].select("canonical_id", "component", "norm_name", "phone_norm", "email_norm", "address_line_1_norm", join("email_norm_all"), join("merged_from"), "merge_count", join("original_sources"))


def merge_log(s, d):
    return _merged(s, d)[3].select("merge_group_id", "canonical_id", F.array_join(F.col("merged_record_ids").cast("array<string>"), ",").alias("merged_record_ids"), "merge_count")


def merge_stats(s, d):
    n, _, _, log = _merged(s, d)
    return merge.merge_stats(log, n.count()).withColumns({c: F.round(c, 6) for c in ("duplicate_reduction_percentage", "avg_group_size")})


def merge_group_sizes(s, d):
    return merge.group_sizes(_merged(s, d)[3])


def unmerged_providers(s, d):
    return _merged(s, d)[2].select("record_id", "norm_name")


def rollback_merge(s, d):
    n, merged, unmerged, _ = _merged(s, d)
    first = merged.agg(F.min("canonical_id")).first()[0]
    _, back = merge.rollback(merged, unmerged, n, first)
    return back.select("record_id", "norm_name")


# --- audit and reports -----------------------------------------------------------------------
def audit_candidates(s, d):
    return audit.audit_candidates(scoring.hybrid_scores(_scored(s, d))).select(audit.pair_id().alias("pair_id"), r6("hybrid_score", "hybrid_score"))


def pending_topk(s, d):
    return audit.pending(X.audit_queue(s, d), limit=50).select("pair_id", "priority", "added_date")


def decisions_by_date(s, d):
    from datetime import datetime

    log = X.audit_log(s, d)
    return audit.decisions_between(log, datetime(2024, 1, 10), datetime(2024, 1, 20)).select("pair_id", "decision", "timestamp")


def training_data(s, d):
    return audit.training_data(X.audit_log(s, d)).select("pair_id", "label", r6("score_diff", "score_diff"), "high_confidence", "low_confidence")


def review_export(s, d):
    return audit.review_export(X.audit_log(s, d).withColumn("comment", F.concat(F.lit("by "), "reviewer")))


def audit_metrics(s, d):
    return audit.audit_metrics(audit.recent(X.audit_log(s, d))).withColumn("merge_rate", F.round("merge_rate", 6))


def queue_stats(s, d):
    return audit.queue_stats(X.audit_queue(s, d))


def reviewer_performance(s, d):
    return audit.reviewer_performance(audit.recent(X.audit_log(s, d))).withColumns({c: F.round(c, 6) for c in ("avg_processing_time", "merge_rate")})


def review_statistics(s, d):
    return audit.review_statistics(audit.recent(X.audit_log(s, d))).withColumns({c: F.round(c, 6) for c in ("avg_processing_time", "merge_rate")})


def decision_shares(s, d):
    return audit.decision_shares(X.audit_log(s, d)).withColumn("percentage", F.round("percentage", 6))


def daily_activity(s, d):
    return audit.daily_activity(audit.recent(X.audit_log(s, d)), 7)


def should_retrain(s, d):
    log = X.audit_log(s, d)
    last = log.agg((F.max("timestamp") - F.expr("interval 2 days")).alias("retraining_date"))
    return audit.should_retrain(log, last)


def model_perf_lag(s, d):
    out = audit.model_performance_summary(X.model_performance(s, d))
    return out.withColumns({c: F.round(c, 6) for c, t in out.dtypes if t == "double"})


def derived_metrics(s, d):
    out = report.derived_metrics(X.audit_queue(s, d), X.audit_log(s, d), X.model_performance(s, d))
    return out.withColumns({c: F.round(c, 6) for c in out.columns})


def processing_time_trend(s, d):
    return report.processing_time_trend(X.audit_log(s, d)).withColumn("processing_time", F.round("processing_time", 6))


def processing_time_histogram(s, d):
    return report.processing_time_histogram(X.audit_log(s, d))


def system_health(s, d):
    return report.system_health({"audit_log": X.audit_log(s, d), "audit_queue": X.audit_queue(s, d), "model_performance": X.model_performance(s, d), "retraining_log": None}, s)


def metrics_report(s, d):
    out = report.metrics_report({"audit_queue": audit.queue_stats(X.audit_queue(s, d)), "audit": audit.audit_metrics(X.audit_log(s, d))})
    return out.withColumn("value", F.round("value", 6))


# --- machine learning ------------------------------------------------------------------------
def ml_features(s, d):
    return ml.features(_paired(s, d)).select("record_id_1", "record_id_2", *[r6(c, c) for c in ml.FEATURES])


def _learned(s, d):
    """(model, pairs with features and label, their distinct features and labels with counts)."""
    labelled = ml.features(_paired(s, d)).select("record_id_1", "record_id_2", *ml.FEATURES, (F.col("true_entity_1") == F.col("true_entity_2")).cast("double").alias("label"))
    counted = cut(ml.counted(labelled))
    return ml.train(counted.where("n_train > 0"), weight="n_train"), labelled, counted


def ml_predictions(s, d):
    model, labelled, _ = _learned(s, d)
    return ml.predict(model, labelled).select("record_id_1", "record_id_2", "label", "match_probability", "match_prediction")


def _predicted(s, d):
    """The predictions for distinct features and labels, with their counts of pairs n."""
    model, _, counted = _learned(s, d)
    return ml.predict(model, counted)


def ml_stats(s, d):
    return ml.prediction_stats(_predicted(s, d), weight="n")


def ml_calibration(s, d):
    return ml.calibrate(_predicted(s, d), weight="n")


def full_pipeline(s, d):
    """The whole pipeline with its own defaults (all three strategies), to decisions by strategy."""
    from weftline.plans.pipeline import run

    return run(X.providers(s, d), Config()).hybrid.groupBy("strategy", "decision").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    normalize_names, title_case, normalize_address, normalize_contact, normalize_state_names, normalize_streets, soundex_codes, metaphone_codes, affiliation_exact, affiliation_fuzzy, dictionary_stats, split_names,
    fuzz_ratio_pairs, edit_pairs, jaro_winkler_pairs, name_similarity, validation_report, validation_summary, clean_providers, block_keys, candidate_pairs, blocking_stats,
    deterministic_scores, score_stats, hybrid_decisions, scoring_stats, decision_counts, threshold_search, best_thresholds, merge_groups, merged_providers, merge_log, merge_stats, merge_group_sizes, unmerged_providers, rollback_merge,
    audit_candidates, pending_topk, decisions_by_date, training_data, review_export, audit_metrics, queue_stats, reviewer_performance, review_statistics, decision_shares, daily_activity, should_retrain, model_perf_lag, derived_metrics,
    processing_time_trend, processing_time_histogram, system_health, metrics_report, ml_features, ml_predictions, ml_stats, ml_calibration, full_pipeline,
)}
