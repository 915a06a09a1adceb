import corpus_pipeline
from weftline.llm import bpe, exact_dedup, mixing, shingle_dedup, toxicity
from weftline.llm.queries import ORACLE, QUERIES


def test_stages_against_their_operators(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "bpe_encoding"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], sf).cache())
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False)) and ids[-1] == ids[-2]
    scores = {r.doc_id for r in toxicity.op6_toxicity(spark, sf).where("predicted = 0").select("doc_id").collect()}
    assert ids[1] == scores
    assert ids[2] == {r.doc_id for r in exact_dedup.exact_groups(frames[1]).where("kept").collect()}
    assert ids[3] == {r.doc_id for r in shingle_dedup.shingle_groups(frames[2]).where("doc_id = component_id").collect()}
    assert ids[4] == {r.doc_id for r in mixing.with_probabilities(frames[3]).where("kept").collect()}
    text = {r.doc_id: r.text or "" for r in frames[4].collect()}
    codec = bpe.Codec(bpe.vocabulary())
    assert all(codec.decode(r.ids) == text[r.doc_id] for r in frames[5].collect())
    whole = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert whole == {r.doc_id: r.ids for r in frames[5].collect()}


def test_registered_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and ORACLE.keys() <= QUERIES.keys()
