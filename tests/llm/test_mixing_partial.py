import pytest

from weftline.llm import mixing


@pytest.mark.parametrize("targets", [{"lang": {"en": 0.25}, "source": {}}, {"lang": {"en": 0.0, "de": 0.0, "fr": 0.0}}])
def test_targets_for_some_values_agree_on_both_paths(spark, targets):
    rows = [(i, "word " * (20 + i % 7), ("en", "de", "fr")[i % 3], ("a", "b")[i % 2]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    near = {r.doc_id: r.probability for r in mixing.with_probabilities(docs, targets, rounds=4).collect()}
    far = {r.doc_id: r.probability for r in mixing.with_probabilities(docs, targets, rounds=4, most_cells=0).collect()}
    assert far.keys() == near.keys() and all(far[d] == pytest.approx(near[d], rel=1e-6) for d in far)
