import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.llm import bpe, langid, license_scan, mixing, toxicity

tokenizers = pytest.importorskip("tokenizers")
PATH = bpe.vocabulary()
CODEC, THEIRS = bpe.Codec(PATH), tokenizers.Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abté 1½\n\t'_<|sx\x1c 　漢é\U0001f600.") | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_bpe_equals_the_library(text):
    text = text.replace("x", "<|endoftext|>")
    ids = THEIRS.encode(text, add_special_tokens=False).ids
    assert CODEC.encode(text) == ids
    assert CODEC.decode(ids) == THEIRS.decode(ids, skip_special_tokens=False) == text


def test_bpe_single_and_many_trees_agree():
    rng = random.Random(3)
    words = ["".join(rng.choice("theandingo é") for _ in range(rng.randrange(1, 40))).encode() for _ in range(500)]
    assert [tuple(CODEC.merge(w)) for w in words] == CODEC.merge_many(words)
    long = b"abcdefg" * 3000
    assert CODEC.decode(CODEC.merge(long)) == long.decode()


def test_bpe_forgets_but_stays_right():
    small = bpe.Codec(PATH)
    small.known, small.pieces = bpe.Recent(3), bpe.Recent(2)  # far fewer than the words
    for t in ["one two three four", "two three five", "one six", "one two three four"]:
        assert small.encode(t) == THEIRS.encode(t, add_special_tokens=False).ids


def test_bpe_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {}
    for r in docs.collect():
        ids = THEIRS.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(THEIRS.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_digests(docs, PATH).collect()}
    assert got == want
    rows = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (2, "hi <|endoftext|>", None)], "doc_id long, text string, ids string")
    back = bpe.bpe_decode(bpe.bpe_encode(rows, PATH), PATH, out="again").collect()
    assert [r.again for r in back] == ["", "", "hi <|endoftext|>"] and back[0].__fields__ == ["doc_id", "text", "ids", "again"]
    assert bpe.bpe_digests(rows.limit(0), PATH).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in toxicity.op6_toxicity(spark, sf).collect()}
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [(got[d].score, t) for d, t in marks.items() if d in got and got[d].held_out]
    assert all(0 <= s <= 1 for s, _ in out) and all((r.score >= 0.5) == bool(r.predicted) for r in got.values())
    up, down = [s for s, t in out if t], [s for s, t in out if not t]
    assert sum((a > b) + 0.5 * (a == b) for a in up for b in down) / max(1, len(up) * len(down)) > 0.9


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, "you idiot " * 3, 5.0), (2, None, 5.0), (3, "", None), (None, "idiot", 1.0), (4, "fine words " * 50000, 1.0), (1, "you idiot " * 3, 5.0)], "doc_id long, text string, score double")
    none = toxicity.fit([], {})
    rows = toxicity.toxicity_scores(docs, none).collect()
    assert len(rows) == 6 and {r.score for r in rows} == {0.0}
    few = toxicity.fit([(i, i % 2, f"{'idiot' if i % 2 else 'calm'} {'clown' if i % 2 else 'nice'} x{i}") for i in range(60)], {0: 900, 1: 100})
    rows = toxicity.toxicity_scores(docs, few).collect()
    assert [r.predicted for r in rows] == [1, 0, 0, 1, 0, 1] and rows[0].evidence
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (9, None), (2, 0)], "doc_id long, toxic int")
    assert sorted((r.id, r.label) for r in toxicity.labelled_ids(docs, labels).collect()) == [(1, 1), (1, 1), (2, 0)]
    assert toxicity.drop_toxic(docs.limit(0), labels).count() == 0 and toxicity.drop_toxic(docs, labels).columns == docs.columns


def test_language_held_out(spark):
    got = langid.op1_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    out = [r for r in got if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) / len(out) > 0.97


def test_language_edges(spark):
    model = langid.Model({"xx": ["lorem ipsum dolor sit amet"], "yy": ["grmpf blrgh zzkt vvrrm"]})
    docs = spark.createDataFrame([(1, "lorem ipsum dolor"), (2, None), (3, ""), (4, "12 34 !!"), (None, "grmpf blrgh"), (5, "zzkt vvrrm " * 60000), (6, "é")], "score long, text string")
    rows = langid.identify(docs.withColumn("lang_pred", F.lit("old")), model).collect()
    assert [r.lang_pred for r in rows[:6]] == ["xx", "und", "und", "und", "yy", "yy"] and rows[6].lang_pred in ("xx", "yy")
    assert all(0 <= r.score <= 1 for r in rows) and rows[0].accepted and not rows[1].accepted
    nothing = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    assert langid.labelled_sample(nothing) == {}
    assert langid.Model({}).predict("abc") == ("und", 0.0, False)
    assert langid.identify(docs.limit(0), model).count() == 0


def test_license_scan(spark):
    mit = license_scan.KNOWN["MIT"][1]
    rows = [(1, mit.upper()), (2, "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + mit.replace(",", " ,\n")), (3, mit + " more"), (4, None), (5, ""), (None, "released under the mit LICENCE"), (6, "x " * 100000), (2, "Licensed under CC BY-NC 4.0.")]
    got = license_scan.scan(spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, license_id string"), license_scan.registry(spark)).collect()
    assert sorted(((r.doc_id, r.license_id) for r in got), key=str) == sorted([(1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (None, "MIT"), (6, None), (2, "CC-BY-NC-4.0")], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan(empty, license_scan.registry(spark)).count() == 0
    plan = license_scan.scan(empty, license_scan.registry(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_rake(cells, goals, rounds=2000):
    w = {k: v for k, v in cells}
    total = sum(w.values())
    w = {k: v / total for k, v in w.items()}
    for _ in range(rounds):
        for axis, goal in enumerate(goals):
            margin = Counter()
            for k, v in w.items():
                margin[k[axis]] += v
            w = {k: v * goal[k[axis]] / margin[k[axis]] for k, v in w.items()}
    return [w[k] for k, _ in cells]


def test_rake_meets_margins():
    rng = random.Random(8)
    cells = [((a, b, c), rng.uniform(1, 9)) for a in "ab" for b in "xyz" for c in "pq"]
    goals = [{"a": 0.3, "b": 0.7}, {"x": 0.2, "y": 0.5, "z": 0.3}, {"p": 0.9, "q": 0.1}]
    got = mixing.rake(cells, goals)
    assert got == pytest.approx(plain_rake(cells, goals), abs=1e-9)
    for axis, goal in enumerate(goals):
        for v, g in goal.items():
            assert sum(w for (k, _), w in zip(cells, got, strict=True) if k[axis] == v) == pytest.approx(g)
    assert mixing.rake([], goals) == [] and mixing.rake([(("a", "x", "p"), 0.0)], goals) == [0.0]


def test_mixing_near_and_far_paths_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    targets = {"lang": {"en": 0.25, "de": 0.25, "fr": 0.25, "es": 0.25}}
    near = {r.doc_id: r.probability for r in mixing.with_probabilities(docs, targets).collect()}
    far = {r.doc_id: r.probability for r in mixing.with_probabilities(docs, targets, rounds=6, most_cells=0).collect()}
    close = {r.doc_id: r.probability for r in mixing.with_probabilities(docs, targets, rounds=6).collect()}
    assert far.keys() == near.keys() and all(far[d] == pytest.approx(close[d], rel=1e-6) for d in far)


def test_mixing_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.with_probabilities(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.probability <= 1 and r.kept == (r.draw < r.probability) for r in rows)
    cells = Counter()
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.tokens
    cells = sorted(cells.items())
    total = sum(cells_n for _, cells_n in cells)
    goals = []
    for axis in range(3):
        share = Counter()
        for k, n in cells:
            share[k[axis]] += n / total
        goals.append(mixing.tempered(share, 0.9))
    want = plain_rake(cells, goals)
    factor = {k: w / (n / total) for (k, n), w in zip(cells, want, strict=True) if n}
    for r in rows:
        if (k := (r.source, r.lang, r.topic)) in factor:
            assert r.probability == pytest.approx(factor[k] / max(factor.values()), rel=1e-5)
    kept = mixing.mix(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}


def test_mixing_edges(spark):
    docs = spark.createDataFrame([(1, None, None, None), (None, "", "en", "a"), (2, "x y", "en", "a"), (2, "x y", "en", "a"), (3, "z " * 100000, "de", None)], "doc_id long, text string, lang string, source string").withColumn("topic", F.lit(1))
    rows = mixing.with_probabilities(docs).collect()
    assert sorted(r.tokens for r in rows) == [0, 0, 2, 2, 100000] and len({r.kept for r in rows if r.doc_id == 2}) == 1
    assert mixing.with_probabilities(docs.limit(0)).count() == 0 and mixing.mix(docs).columns == docs.columns
