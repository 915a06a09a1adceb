"""Pairs, scores and links without sending pairs: the results are those of plain ways."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline import config as C
from weftline.functions import similar, text
from weftline.operators import blocking, linking, ml, scoring
from weftline.operators.components import connected_components
from weftline.plans import queries


def test_similarities_of_many_equal_those_of_one():
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcAé 日") for _ in range(rng.randrange(n)))
    a = [word(rng.choice([4, 20, 70])) for _ in range(3000)] + ["", "", "x" * 63, "x" * 64, None, "a"]
    b = [x if n % 9 == 0 else word(rng.choice([4, 20, 70])) for n, x in enumerate(a[:3000])] + ["", "b", "x" * 63, "x" * 64, "a", None]
    for many, one, kind in ((similar.ratios, text.ratio, "int32"), (similar.jaro_winklers, text.jaro_winkler_of, "float64")):
        got = similar.by_pairs(many, one, kind)(pa.array(a), pa.array(b)).to_pylist()
        assert got == [None if x is None or y is None else one(x, y) for x, y in zip(a, b, strict=True)]


@pytest.fixture(scope="module")
def records(spark):
    """Records of few names, places and contacts, so that all kinds of pairs occur; also empty fields."""
    rng = random.Random(8)
    pick = lambda *values: rng.choice(values)
    rows = [(i, pick("Ann Lee", "Ann Lees", "ann lee", "Bo Maximilian Long", "Bo Maximilian Lung", "Al", ""), pick("Mayo Clinic", "Clinic Mayo", "Mayo Clinic Of It", ""), pick("Rome", "ROME", "Oslo", ""), pick("MD", "MN", ""), pick("11111", "22222", ""), pick("1 Main St", ""), pick(f"p{rng.randrange(30)}", ""), pick(f"e{rng.randrange(30)}", f"E{rng.randrange(30)}", ""), "s", f"P{i}", i // 2) for i in range(260)]
    return spark.createDataFrame(rows, "record_id long, norm_name string, norm_affiliation string, city_norm string, state_norm string, zip_norm string, address_line_1_norm string, phone_norm string, email_norm string, source string, provider_id string, true_entity long")


RULES = C.Blocking((C.Strategy("a", ("state_norm", "norm_name[:2]")), C.Strategy("b", ("zip_norm",)), C.Strategy("c", ("phone_norm",))))


def plain_pairs(records, rules):
    """By hand: (id, id): (strategy, key)."""
    rows = [r.asDict() for r in blocking.block_keys(records, rules).collect()]
    found = {}
    for s in reversed(rules.strategies):
        blocks = {}
        for r in rows:
            if r[f"block_{s.name}"]:
                blocks.setdefault(r[f"block_{s.name}"], []).append(r["record_id"])
        for key, ids in blocks.items():
            if rules.most_per_block is None or len(ids) <= rules.most_per_block:
                found |= {(x, y): (s.name, key) for x in ids for y in ids if x < y}
    return found


@pytest.mark.parametrize("most", [None, 60, 10])
def test_pairs_are_made_once_and_never_sent(spark, records, most):
    rules = C.Blocking(RULES.strategies, most_per_block=most)
    blocked = blocking.block_keys(records, rules)
    pairs = blocking.candidate_pairs(blocked, rules)
    want = plain_pairs(records, rules)
    got = [((r.record_id_1, r.record_id_2), (r.strategy, r.block_key)) for r in pairs.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert blocking.count_pairs(blocked, rules).first().generated_candidates == len(want)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[: plan.index("Join Inner")]  # nothing gathers the pairs


def test_ids_with_rows_of_different_keys(spark):
    b = spark.createDataFrame([(1, "x", "q"), (1, "y", "q"), (2, "x", "q"), (2, "y", "q"), (3, "z", "q")], "record_id long, block_a string, block_b string")
    rules = C.Blocking((C.Strategy("a", ()), C.Strategy("b", ())))
    assert sorted(tuple(r) for r in blocking.candidate_pairs(b, rules).collect()) == [(1, 2, "x", "a"), (1, 3, "q", "b"), (2, 3, "q", "b")]
    assert blocking.count_pairs(b, rules).first().generated_candidates == 3


def groups_of(found):
    return {r.node: r.component for r in found.collect()}


@pytest.mark.parametrize("most", [None, 60])
@pytest.mark.parametrize("weights", [C.Weights(), C.Weights(name_exact=0.6)])
def test_links_join_what_all_pairs_join(spark, records, most, weights):
    rules = C.Blocking(RULES.strategies, most_per_block=most)
    pairs = blocking.candidate_pairs(blocking.block_keys(records, rules), rules)
    auto = scoring.hybrid_scores(scoring.deterministic_scores(pairs, records, weights), None, weights).where("auto_merge")
    links = linking.merging_links(records, rules, weights)
    assert linking.separable(weights) == (weights == C.Weights())
    want = groups_of(connected_components(auto, "record_id_1", "record_id_2"))
    assert groups_of(connected_components(links, "record_id_1", "record_id_2")) == want and len(set(want.values())) > 2
    if weights == C.Weights() and most is None:
        assert links.count() < auto.count()


def test_groups_are_of_whole_blocks(spark, tmp_path):
    """merge_groups takes part in blocks of any size; the cap would leave the second half of these apart."""
    spark.range(1200).selectExpr("id * 900 * 4096 * 7 as c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    found = queries.merge_groups(spark, str(tmp_path))
    assert found.count() == 1200 and found.where("component <> 0").count() == 0


def test_counted_pairs_teach_as_all_pairs(spark, sf):
    labelled = ml.features(queries._paired(spark, sf)).select("record_id_1", "record_id_2", *ml.FEATURES, (F.col("true_entity_1") == F.col("true_entity_2")).cast("double").alias("label"))
    counted = ml.counted(labelled)
    assert counted.agg(F.sum("n")).first()[0] == labelled.count() and counted.agg(F.sum("n_train")).first()[0] == ml.split(labelled)[0].count()
    told = ml.predict(ml.train(ml.split(labelled)[0]), labelled)
    weighed = ml.predict(ml.train(counted.where("n_train > 0"), weight="n_train"), labelled)
    p = {(r.record_id_1, r.record_id_2): r.match_prediction for r in told.collect()}
    q = {(r.record_id_1, r.record_id_2): r.match_prediction for r in weighed.collect()}
    assert p == q
    each = weighed.withColumn("n", F.lit(1))
    more = each.unionByName(each)
    assert ml.prediction_stats(each.withColumn("n", F.lit(2)), weight="n").first() == pytest.approx(ml.prediction_stats(more).first())
    assert ml.calibrate(each.withColumn("n", F.lit(2)), weight="n").first() == ml.calibrate(more).first()
