from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weftline import config as C
from weftline.functions import normalize as N
from weftline.operators import audit, blocking, merge, ml, quality, scoring
from weftline.plans import pipeline
from weftline.sources import files
from weftline.streaming import incremental

PROVIDERS = [
    ("1", "Dr. John Smith MD", "John", "Smith", "Johns Hopkins Hospital", "600 N Wolfe St, Baltimore, MD 21287", "(410) 955-5000", "jsmith@jhmi.edu", "EHR"),
    ("2", "John Smith", "John", "Smith", "johns hopkins", "600 N Wolfe Street, Baltimore, MD 21287", "410-955-5000", "jsmith@jhmi.edu", "Medicaid"),
    ("3", "Jane Doe", "Jane", "Doe", "Mayo Clinic", "200 First St, Rochester, MN 55905", "(507) 284-2511", "jdoe@mayo.edu", "HMO"),
    ("4", "Dr. Jane Doe", "Jane", "Doe", "Mayo Clinic Rochester", "200 First Street, Rochester, MN 55905", "507-284-2511", "jane@mayo.edu", "EHR"),
    ("5", "Bob Wilson", "Bob", "Wilson", "Cleveland Clinic", "9500 Euclid Ave, Cleveland, OH 44195", "(216) 444-2200", "bw@ccf.org", "EHR"),
]
SCHEMA = "provider_id string, raw_name string, first_name string, last_name string, affiliation string, address string, phone string, email string, source string"


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("f", "given", "want"), [
    (N.normalize_name, "Dr. John Smith MD", "John Smith"), (N.normalize_name, "  john  smith  ", "John Smith"), (N.normalize_name, None, ""), (N.normalize_name, "Ivan Petrov III", "Ivan Petrov"),
    (N.normalize_city, "  new york  ", "New York"), (N.normalize_state, "Maryland", "MD"), (N.normalize_state, "md", "MD"), (N.normalize_state, "", ""), (N.normalize_state, "Atlantis", ""),
    (N.normalize_zip, "21287-1234", "21287"), (N.normalize_zip, None, ""), (N.normalize_street, "100 north MAIN street", "100 N Main St"),
    (N.normalize_phone, "(410) 955-5000", "+14109555000"), (N.normalize_phone, "invalid", ""), (N.normalize_phone, "+44 20 7946 0958", "+442079460958"), (N.normalize_phone, None, ""),
    (N.normalize_email, "John.Smith@Example.COM", "john.smith@example.com"), (N.normalize_email, "invalid-email", ""), (N.normalize_email, "a@b@c.d", ""), (N.normalize_email, None, ""),
])
def test_scalars(spark, f, given, want):
    assert one(spark, given, f) == want


def test_loose_suffixes(spark):
    assert one(spark, "Ivan", lambda c: N.normalize_name(c, C.Normalization(loose_suffixes=True))) == "An"


@pytest.mark.parametrize(("given", "want"), [("John A Smith Jr", ("John", "Jr", "A Smith")), ("Smith", ("", "Smith", "")), ("", ("", "", "")), (None, ("", "", "")), ("A B", ("A", "B", ""))])
def test_split_name(spark, given, want):
    assert tuple(one(spark, given, N.split_name)) == want


def test_address(spark):
    r = one(spark, "600 N Wolfe St, Baltimore, MD 21287", N.parse_address)
    assert (r.street_number, r.street_name, r.street_type, r.city, r.state, r.zip, r.line_1) == ("600", "Wolfe", "St", "Baltimore", "MD", "21287", "600 Wolfe St")
    r = one(spark, "somewhere", N.parse_address)
    assert r.line_1 == "somewhere" and r.city == ""


def test_affiliations(spark):
    df = spark.createDataFrame([("  mayo clinic  ",), ("HCA",), ("Mayo Clinc",), ("zzz qqq",), (None,)], "affiliation string")
    got = [r.norm_affiliation for r in N.normalize_affiliations(df, N.dictionary(spark)).collect()]
    assert sorted(got) == sorted(["Mayo Clinic", "Hospital Corporation of America", "Mayo Clinic", "Zzz Qqq", ""])
    more = N.add_affiliations(N.dictionary(spark), "New Place", ["np", "hca"])
    assert {r.variant: r.canonical for r in more.collect()}["hca"] == "New Place"
    stats = N.dictionary_stats(N.dictionary(spark)).first()
    assert (stats.canonical_names, stats.variants) == (22, 68)


def test_golden_key_and_pairs(spark):
    df = spark.createDataFrame([(0, "MD", "21287", "SM0", "J500")], "record_id long, state_norm string, zip_norm string, last_name_metaphone string, first_name_soundex string")
    key = df.select(blocking.plain_key(df, ("state_norm", "zip_norm[:3]", "last_name_metaphone", "first_name_soundex")).alias("k")).first().k
    assert key == "c5c5b3c38782ea24"
    with pytest.raises(ValueError):
        blocking.field(df, "nothing[:3]")
    rules = C.Blocking((C.Strategy("location_name", ()), C.Strategy("affiliation_tokens", ())))
    rows = [(0, "ABC123", "XYZ789"), (1, "ABC123", "XYZ789"), (2, "DEF456", "XYZ789"), (3, "ABC123", "XYZ789")]
    b = spark.createDataFrame(rows, "record_id long, block_location_name string, block_affiliation_tokens string")
    got = {(r.record_id_1, r.record_id_2): r.strategy for r in blocking.candidate_pairs(b, rules).collect()}
    assert got == {(0, 1): "location_name", (0, 3): "location_name", (1, 3): "location_name", (0, 2): "affiliation_tokens", (1, 2): "affiliation_tokens", (2, 3): "affiliation_tokens"}
    assert blocking.candidate_pairs(b, C.Blocking(rules.strategies, most_per_block=3)).count() == 3
    assert blocking.candidate_pairs(b.limit(0), rules).columns == ["record_id_1", "record_id_2", "block_key", "strategy"]


def test_decisions(spark):
    df = spark.createDataFrame([(0.85,), (0.65,), (0.84,), (0.64,), (float("nan"),), (None,), (1.15,)], "s double")
    assert [r.d for r in df.select(scoring.decision(F.col("s")).alias("d")).collect()] == ["AUTO_MERGE", "AUDIT", "AUDIT", "REJECT", "REJECT", "REJECT", "AUTO_MERGE"]


def test_validation(spark):
    bad = [(None, *PROVIDERS[0][1:]), PROVIDERS[1], PROVIDERS[1], (*PROVIDERS[2][:7], "nope", "Other")]
    df = pipeline.with_record_ids(spark.createDataFrame([*PROVIDERS, *bad], SCHEMA))
    assert df.select("record_id").distinct().count() == 9
    report = {(r.rule, r.column): r.unexpected for r in quality.validation_report(df).collect()}
    assert report["not_null", "provider_id"] == 1 and report["unique", "provider_id"] == 5 and report["matches_pattern", "email"] == 1 and report["in_set", "source"] == 1
    cleaned, _ = quality.validate(df)
    assert sorted(r.provider_id for r in cleaned.collect()) == list("12345")
    empty = spark.createDataFrame([], SCHEMA)
    assert not quality.validation_summary(quality.validation_report(empty)).first().success and quality.clean(empty).count() == 0


@pytest.fixture(scope="module")
def result(spark):
    return pipeline.run(spark.createDataFrame(PROVIDERS, SCHEMA), now=datetime(2024, 1, 1))


def test_pipeline_on_five_records(result):
    pairs = {(r.decision, round(r.hybrid_score, 6)) for r in result.hybrid.collect()}
    assert pairs == {("AUTO_MERGE", 1.15)}
    merged = {r.canonical_id: r for r in result.merged.collect()}
    assert set(merged) == {"PROV-84655CE7A8D0FC08", "PROV-219A255DAB14D5C1"} and all(r.merge_count == 2 for r in merged.values())
    doe = merged["PROV-219A255DAB14D5C1"]
    assert set(doe.email_norm_all) == {"jdoe@mayo.edu", "jane@mayo.edu"} and doe.phone_norm_all is None and doe.original_sources == ["EHR", "HMO"]
    report = result.report()
    assert report["merge_statistics"]["duplicate_reduction"] == 2 and report["data_processing"]["final_records"] == 3
    assert [r.provider_id for r in result.unmerged.collect()] == ["5"]
    assert sorted(r.merge_group_id for r in result.log.collect()) == [0, 1]


def test_rollback_and_save(spark, result, tmp_path):
    merged, unmerged = merge.rollback(result.merged, result.unmerged, result.normalized, "PROV-84655CE7A8D0FC08")
    assert merged.count() == 1 and sorted(r.provider_id for r in unmerged.collect()) == ["1", "2", "5"]
    pipeline.save(result, str(tmp_path), "csv")
    back = files.read(spark, str(tmp_path / "merge_log"), "csv")
    assert back.count() == 2 and back.first().merged_record_ids.startswith("[")


def test_files(spark, tmp_path):
    df = spark.createDataFrame(PROVIDERS, SCHEMA)
    for kind in files.FORMATS:
        files.write(df, str(tmp_path / f"x.{kind}"), kind)
        got = files.ingest(spark, str(tmp_path / f"x.{kind}"), "LABEL")
        assert got.count() == 5 and {r.source for r in got.collect()} == {"LABEL"} and set(got.columns) == set(df.columns)
    assert files.read_many(spark, [str(tmp_path / "x.csv"), str(tmp_path / "x.parquet")]).count() == 10
    assert files.read_many(spark, []).count() == 0
    assert files.list_files(spark, str(tmp_path), ".PARQUET").count() >= 1
    for call in (lambda: files.read(spark, "x", "xml"), lambda: files.write(df, str(tmp_path / "y"), "xml"), lambda: files.format_of("x.txt")):
        with pytest.raises(ValueError):
            call()
    spark.createDataFrame([("1", "a", "x"), ("1", "0.5", "")], "label string, f string, g string").write.option("header", True).csv(str(tmp_path / "t.csv"))
    assert {(r.label, r.f, r.g) for r in files.read_training(spark, str(tmp_path / "t.csv"), ["f", "g"]).collect()} == {(1, 0.0, 0.0), (1, 0.5, 0.0)}


def test_audit_exports(spark, tmp_path):
    rows = [("3_4", 3, 4, "REJECT", "no, not", "bob", datetime(2024, 1, 4), 0.8, 0.8, 0.0, 2.0), ("1_2", 1, 2, "MERGE", None, "ann", datetime(2024, 1, 3), 0.7, 0.6, 0.0, 1.0)]
    log = spark.createDataFrame(rows, "pair_id string, record_id_1 long, record_id_2 long, decision string, comment string, reviewer string, timestamp timestamp_ntz, hybrid_score double, deterministic_score double, ml_probability double, processing_time double")
    out = audit.review_export(log)
    assert [(r.pair_id, r.label, r.comment) for r in out.collect()] == [("1_2", 1, None), ("3_4", 0, "no, not")] and "decision" not in out.columns
    assert audit.review_export(log.limit(0)).count() == 0
    path = audit.export_decisions(log, str(tmp_path), datetime(2024, 5, 6, 7, 8, 9))
    assert path.endswith("/audit_export_20240506_070809.csv")
    back = spark.read.option("header", True).csv(path)
    assert back.columns == log.columns and {(r.pair_id, r.decision, r.comment) for r in back.collect()} == {("3_4", "REJECT", "no, not"), ("1_2", "MERGE", None)}


def test_audit_store(spark):
    hybrid = spark.createDataFrame([(1, 2, 0.7, 0.7, 0.0, "k", "s"), (3, 4, 0.8, 0.8, 0.0, "k", "s")], "record_id_1 long, record_id_2 long, hybrid_score double, deterministic_score double, ml_probability double, block_key string, strategy string")
    queue = audit.enqueue(audit.enqueue(None, hybrid, datetime(2024, 1, 1)), hybrid, datetime(2024, 1, 2))
    assert queue.count() == 2 and audit.pending(queue).count() == 2
    said = [("1_2", "MERGE", "ok", "ann", datetime(2024, 1, 3), 2.0), ("1_2", "REJECT", "no", "bob", datetime(2024, 1, 4), 3.0), ("9_9", "MERGE", "", "ann", datetime(2024, 1, 4), 1.0), ("3_4", "MAYBE", "", "ann", datetime(2024, 1, 4), 1.0)]
    decisions = spark.createDataFrame(said, "pair_id string, decision string, comment string, reviewer string, timestamp timestamp_ntz, processing_time double")
    queue, log = audit.record_decisions(queue, None, decisions)
    assert [(r.pair_id, r.decision) for r in log.collect()] == [("1_2", "REJECT")]
    assert {r.pair_id: r.status for r in queue.collect()} == {"1_2": "reviewed", "3_4": "pending"}
    assert audit.training_data(log).count() == 0 and audit.training_data(log, 1).first().label == 0
    assert audit.should_retrain(log, None, 1).first().retrain and audit.recent(log.limit(0)).count() == 0
    assert 0 <= audit.audit_sample(hybrid, 0.07).count() <= 2 and audit.audit_sample(hybrid, 1.0).count() == 2
    one_row = spark.createDataFrame([("default", "{}")], "config_name string, data string")
    assert audit.seed_config(one_row, one_row).count() == 1


def test_classifier(spark, sf, tmp_path):
    from weftline.plans import queries

    predicted = queries.ml_predictions(spark, sf)
    assert predicted.count() and predicted.where("match_probability < 0 or match_probability > 1").count() == 0
    rows = spark.createDataFrame([(i, i + 1, float(i % 2), *[float(i % 2)] * len(ml.FEATURES)) for i in range(60)], "record_id_1 long, record_id_2 long, label double, " + ", ".join(f"{f} double" for f in ml.FEATURES))
    model = ml.train(rows)
    ml.save(model, str(tmp_path / "m"))
    told = ml.predict(ml.load(str(tmp_path / "m")), rows)
    assert told.where("match_prediction <> label").count() == 0 and ml.auc(model, rows) == 1.0
    assert ml.calibrate(told).first().value == 1.0 and len(ml.feature_importance(model)) == 16
    with pytest.raises(ValueError):
        ml.estimator("other")
    mixed = scoring.hybrid_scores(spark.createDataFrame([(0, 1, "k", "s", *[1.0] * 6)], "record_id_1 long, record_id_2 long, block_key string, strategy string, " + ", ".join(f"{c} double" for c in scoring.SCORES)), told.where("record_id_1 = 0"))
    row = mixed.first()
    assert row.hybrid_score == pytest.approx(0.75 * 1.15 + 0.25 * row.ml_probability)


def test_stream(spark, tmp_path):
    known = N.normalize(pipeline.with_record_ids(spark.createDataFrame(PROVIDERS[:1], SCHEMA)))
    new = pipeline.with_record_ids(spark.createDataFrame(PROVIDERS[1:], SCHEMA))
    new.write.parquet(str(tmp_path / "in"))
    got = []
    q = incremental.link_stream(spark.readStream.schema(new.schema).parquet(str(tmp_path / "in")), lambda: known, lambda records, decisions, n: got.extend(decisions.collect()), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert sorted(r.decision for r in got) == ["AUTO_MERGE", "AUTO_MERGE"]


def test_config():
    over = C.merged(C.to_dict(C.Config()), {"thresholds": {"auto_merge": 0.9}, "blocking": {"strategies": [{"name": "s", "keys": ["a"], "similarity_threshold": 0.5}]}})
    made = C.from_dict(over)
    assert made.thresholds.auto_merge == 0.9 and made.weights == C.Weights() and made.blocking.strategies == (C.Strategy("s", ("a",), True),)
    for bad in ({"nope": {}}, {"weights": {"x": 1}}, {"normalization": {"affiliation_threshold": 2}}, {"merge": {"strategy": "x"}}):
        with pytest.raises(ValueError):
            C.from_dict(bad)
