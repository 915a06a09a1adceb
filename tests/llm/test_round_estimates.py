from weftline.llm import shingle_dedup
from weftline.session import cut_round

from tests.llm.test_shingle_dedup import near_copies, plain_groups


def bits(df):
    """Length of the size that Spark estimates for ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())).bit_length()


def test_cut_round_starts_the_estimate_anew(spark):
    df = spark.createDataFrame([(1, "a", 2.5, None), (2, None, None, [3])], "k long, s string, d double, a array<long>")
    now = df
    for _ in range(3):
        now = cut_round(now.join(now.select("k"), "k"))
        assert bits(now) <= 64
    assert sorted(now.collect()) == sorted(df.collect()) and now.schema == df.schema
    assert cut_round(df.limit(0)).count() == 0


def test_near_stage_estimates_stay_small(spark, monkeypatch):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # without the grid all links are found in rounds
    monkeypatch.setattr(shingle_dedup, "grid_pairs", lambda keyed: keyed.selectExpr("key as src", "key as dst").limit(0))
    seen = []
    for name in ("_open_cells", "_linked"):
        own = getattr(shingle_dedup, name)
        monkeypatch.setattr(shingle_dedup, name, lambda *a, own=own: seen.append(bits(out := own(*a))) or out)
    apart = shingle_dedup._apart
    monkeypatch.setattr(shingle_dedup, "_apart", lambda pairs, labels: seen.append(bits(pairs)) or apart(pairs, labels))
    got = [(r.doc_id, r.component_id) for r in shingle_dedup.shingle_groups(df).collect()]
    assert sorted(got, key=str) == sorted([(d, w) for (d, _), w in zip(rows, plain_groups(rows), strict=True)], key=str)
    assert len(seen) >= 6 and max(seen) <= 4096
