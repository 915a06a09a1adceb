import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.llm import lm_score

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(t):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")), None]


def walk(rows, prior=lm_score.PRIOR, order=lm_score.ORDER):
    """rows: (id, text, train); states, arcs and failure arcs in plain dicts, walked token by token."""
    seen, ctx = Counter(), Counter()
    uni = Counter()
    for _, t, train in rows:
        if train:
            words = ["start ", *split(t)]
            uni.update(words[1:])
            for i in range(1, len(words)):
                for n in range(2, order + 1):
                    if i - n + 1 >= 0:
                        gram = tuple(words[i - n + 1 : i + 1])
                        seen[gram] += 1
                        ctx[gram[:-1]] += 1
    total, distinct = sum(uni.values()), len(uni)

    def p(context, w):
        if not context:
            return (uni[w] + 0.5) / (total + 0.5 * (distinct + 1))
        return (seen[(*context, w)] + prior * p(context[1:], w)) / (ctx[context] + prior)

    out = []
    for i, t, _ in rows:
        state, base, score = ("start ",), 0.0, 0.0
        for w in split(t):
            base += math.log10(p((), w))
            while state and not seen[(*state, w)]:
                score += math.log10(prior / (ctx[state] + prior))
                state = state[1:]
            score += math.log10(p(state, w))
            state = (*state, w)[-(order - 1) :]
            while state and not (seen[state] if len(state) > 1 else uni[state[0]]):
                state = state[1:]
        out.append((i, len(split(t)), sum(uni[w] > 0 for w in split(t)), total, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize(("block_chars", "order"), [(4_000_000, 3), (20_000, 3), (50_000, 4), (50_000, 2)])
def test_scores_match_a_plain_walk(spark, sf, block_chars, order):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 5 != 1) for r in docs.collect()]
    held = lm_score.remainder(F.col("doc_id"), 5) == 1
    got = lm_score.lm_scores(docs, ~held, block_chars=block_chars, order=order).collect()
    for g, w in zip(sorted((tuple(r) for r in got), key=str), walk(rows, order=order), strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9) and g[5] == pytest.approx(w[5], rel=1e-9)
    # bigrams tell more than unigrams on texts that weren't learned from
    out = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 1]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_edges(spark):
    rows = [(1, "A b a B", True), (2, None, True), (3, "", False), (None, "a", False), (4, "zz " * 50000, False), (1, "A b a B", True), (5, "é É\x0bx", True)]
    df = spark.createDataFrame([(i, t, k, "q") for i, t, k in rows], "doc_id long, text string, learn boolean, block string")
    got = sorted((tuple(r) for r in lm_score.lm_scores(df, F.col("learn")).collect()), key=str)
    for g, w in zip(got, walk(rows), strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4]) and g[5] == pytest.approx(w[5])
    assert lm_score.lm_scores(df.limit(0), F.col("learn")).count() == 0
    none = lm_score.lm_scores(df, F.lit(False)).collect()
    assert {r.n_known for r in none} == {0} and all(r.score == pytest.approx(r.base_score) == pytest.approx(0) for r in none)


def test_a_row_of_one_id_and_hot_ids_split(spark):
    """Rows of one id, or of none, are dealt like any others."""
    df = spark.range(400, numPartitions=4).select(F.lit(7).alias("doc_id"), F.lit("the very same words again").alias("text"))
    got = lm_score.lm_scores(df, F.lit(True), block_chars=500).collect()
    assert len(got) == 400 and {r.train_tokens for r in got} == {2400} and len({r.score for r in got}) == 1


def test_messages_follow_the_blocks():
    """A block's messages number its ranges, whatever other blocks there are; keys keep all bits."""
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    sent = lm_score._messages(3, 2, keys, np.ones(len(keys), np.int64), 64, 0)
    assert len(sent) == 64
    back = np.concatenate([np.cumsum(lm_score._unplanes(k.as_py()), dtype=np.uint64) for k in sent.column("keys")])
    assert (back == keys).all()


@pytest.mark.parametrize("order", [2, 3, 4])
def test_all_words_of_a_block_take_their_arcs_at_once(order):
    """One block without Spark: texts of one word, of none and of many, seen and unseen, as the plain walk scores them."""
    import numpy as np

    texts = ["a b c a b d", "", "a b c", None, "d d d a b", "x a b c d", "a", "b a b c a b d d " * 50]
    train = np.array([True, True, False, False, True, False, False, True])
    block = lm_score.Block.of(texts, train)
    for _ in range(order - 1):
        block.longer()
    totals = block.counts
    got = lm_score.Automaton(block, totals, block.starts, int(totals[0].sum()), int((totals[0] > 0).sum()), lm_score.PRIOR).scores()
    want = walk([(i, t, bool(k)) for i, (t, k) in enumerate(zip(texts, train, strict=True))], order=order)
    assert got.tolist() == pytest.approx([w[5] for w in want], rel=1e-12)
