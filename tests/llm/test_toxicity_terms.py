import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.llm import toxicity
from weftline.llm.common import remainder

WORD = __import__("re").compile(r"\w+")


def bag(text):
    out = Counter()
    for w in WORD.findall((text or "").lower()):
        out[w] += 1
        for k in (3, 4, 5, 6, 7):
            if k < len(w):
                out[w[:k] + "*"] += 1
    return out


def brute(rows, totals, texts, k=15):
    """Scores and cosines by plain loops over every example and every term."""
    kept = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        kept.setdefault(tuple(sorted(Counter(WORD.findall((r[2] or "").lower())).items())), r)
    rows = list(kept.values())
    n, n1 = len(rows), sum(r[1] for r in rows)
    bags = [bag(r[2]) for r in rows]
    df = Counter(t for b in bags for t in b)
    df1 = Counter(t for b, r in zip(bags, rows) if r[1] for t in b)

    def weight(t):
        a, b, n0 = df1[t], df[t] - df1[t], n - n1
        odds = math.log((a + 0.5) / (n1 - a + 0.5)) - math.log((b + 0.5) / (n0 - b + 0.5))
        error = math.sqrt(1 / (a + 0.5) + 1 / (n1 - a + 0.5) + 1 / (b + 0.5) + 1 / (n0 - b + 0.5))
        return math.log((1 + n) / (1 + df[t]) + 1e-9) * (0.05 + max(0, abs(odds) - 2.5 * error)) ** 1.5

    def unit(b):
        v = {t: (1 + math.log(c)) * weight(t) for t, c in b.items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1
        return {t: x / size for t, x in v.items()}

    units, base = [unit(b) for b in bags], totals[1] / (totals[0] + totals[1])
    share = {1: base / max(n1, 1), 0: (1 - base) / max(n - n1, 1)}
    out = []
    for text in texts:
        q = unit(bag(text))
        cosines = sorted(((sum(x * u.get(t, 0) for t, x in q.items()), r[0], r[1]) for u, r in zip(units, rows)), key=lambda x: -x[0])
        near = [c for c in cosines if c[0] > 1e-7][:k]
        votes = [share[y] / max(share.values()) / (1.05 - min(c, 1)) for c, _, y in near]
        out.append(((0.2 * base + sum(v * y for v, (_, _, y) in zip(votes, near))) / (0.2 + sum(votes)), [c for c, _, _ in near]))
    return out


def test_index_equals_brute_force():
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    word = lambda y: rng.choice(stems[:40] if y else stems[20:]) + rng.choice(["", "ing", "ed", "ness"])
    rows = [(i, i % 2, " ".join(word(i % 2) for _ in range(rng.randrange(0, 30)))) for i in range(500)]
    texts = [" ".join(word(rng.random() < 0.5) for _ in range(rng.randrange(1, 40))) + " unseen wording" for _ in range(60)] + ["", None, "unseen"]
    index = toxicity.fit(rows, {0: 900, 1: 100})
    for text, (score, cosines) in zip(texts, brute(rows, {0: 900, 1: 100}, texts), strict=True):
        got, near = index.score(text)
        assert [c for c, _ in near] == pytest.approx(cosines, abs=2e-6) and got == pytest.approx(score, abs=1e-4)


def test_query_equals_brute_force(spark):
    """The sample holds all labelled rows of this table, so the query's scores are those of plain loops."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").where(remainder(F.col("doc_id"), 5) == 0).select("doc_id").collect()}
    marks = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        if r.toxic is not None and r.doc_id in docs and r.doc_id not in held:
            marks[r.doc_id] = max(r.toxic, marks.get(r.doc_id, 0))
    totals = {y: sum(m == y for m in marks.values()) for y in (0, 1)}
    rows = [(d, y, docs[d]) for d, y in marks.items() if len(docs[d] or "") <= 10_000]
    got = {r.doc_id: r for r in toxicity.op6_toxicity(spark, sf).collect()}
    some = sorted(docs)[::4]
    for d, (score, _) in zip(some, brute(rows, totals, [docs[d] for d in some]), strict=True):
        assert got[d].score == pytest.approx(score, abs=1e-3) and got[d].held_out == (d in held)


def test_rare_toxic_words_count_in_a_large_sample():
    """40 of 2,000 toxic examples share a word: enough at any sample size."""
    for n in (400, 4000):
        rows = [(i, i % 2, f"{'clown' if i % 2 and i < 80 else 'plain'} u{i}") for i in range(n)]
        index = toxicity.fit(rows, {0: n // 2, 1: n // 2})
        score, near = index.score("what a clown")
        assert score >= 0.5 and near and all(index.labels[i] == 1 for _, i in near)
        assert index.score("what clownery")[0] >= 0.5  # a word of the same beginning


def test_one_label_or_none():
    rows = [(i, 0, f"plain u{i}") for i in range(50)]
    assert toxicity.fit(rows, {0: 50}).score("plain")[0] == 0.0
    assert toxicity.fit([(i, 1, t) for i, _, t in rows], {1: 50}).score("plain")[0] == 1.0
    assert toxicity.fit([], {0: 3, 1: 1}).score("plain") == (0.25, [])


def test_queries_beside_each_other_change_nothing():
    """Many texts go through the blocks together; each has the score and neighbours that it has alone."""
    rng = random.Random(9)
    stems = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80)]
    text = lambda: " ".join(rng.choice(stems) + rng.choice(["", "ing", "ed"]) for _ in range(rng.randrange(0, 60)))
    rows = [(i, i % 2, text()) for i in range(700)]
    texts = [*(text() for _ in range(600)), None, "", "unseen", rows[3][2], rows[3][2]]
    index, alone = toxicity.fit(rows, {0: 900, 1: 100}), toxicity.fit(rows, {0: 900, 1: 100})
    assert index.scores(texts) == [alone.score(t) for t in texts]
    assert index.scores([]) == [] and toxicity.fit([], {0: 3, 1: 1}).scores(["a", None]) == [(0.25, [])] * 2
