import os

from weftline.llm import bpe, common, shingle_dedup, toxicity


def test_lean_drops_what_is_held():
    first = bpe.codec(bpe.vocabulary())
    assert bpe.codec(bpe.vocabulary()) is first and common.HELD
    common.lean()
    assert not common.HELD and bpe.codec(bpe.vocabulary()) is not first


def test_near_stage_begins_lean(spark, monkeypatch, tmp_path):
    folder = str(tmp_path)
    monkeypatch.setattr(shingle_dedup, "lean", lambda: open(f"{folder}/{os.getpid()}", "w").close(), raising=False)
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f")], "doc_id long, text string")
    assert [r.component_id for r in shingle_dedup.shingle_groups(df).collect()] == [1, 1]
    assert os.listdir(folder)


def test_toxicity_stage_begins_lean(spark, monkeypatch, tmp_path):
    folder = str(tmp_path)
    monkeypatch.setattr(toxicity, "lean", lambda: open(f"{folder}/{os.getpid()}", "w").close(), raising=False)
    df = spark.createDataFrame([(i, "foul foul words" if i % 2 else "kind words here") for i in range(40)], "doc_id long, text string")
    kept = toxicity.drop_toxic(df, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")).collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 40, 2))
    assert os.listdir(folder)
