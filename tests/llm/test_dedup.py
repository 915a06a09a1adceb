import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.llm import exact_dedup, simhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def plain_fingerprint(t):
    w = SPACE.findall(low(t))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def brute_components(fps):
    """fps: [(doc_id, fp)]; the least id reachable, by doc position."""
    uniq = sorted({f for _, f in fps})
    parent = {f: f for f in uniq}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(uniq):
        for b in uniq[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for d, f in fps:
        r = find(f)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [least.get(find(f)) for _, f in fps]


TEXTS = ["", None, "  \t\n", "one", "One", "one two", "ONE two three", "a b c d", "É b c", "é b c", "a\x0bb\x0cc d", "x " * 40000, "word " * 5 + "end", "a b c d"]


def test_fingerprint_matches_plain():
    rng = random.Random(1)
    for t in [*TEXTS, *(" ".join(rng.choice(["ab", "cd", "ef", "Gh", "ij"]) for _ in range(rng.randrange(30))) for _ in range(100))]:
        assert simhash.fingerprint(t) == plain_fingerprint(t), t


def test_simhash_groups_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    want = dict(zip([d for d, _ in rows], zip([f"{f:016x}" for _, f in fps], brute_components(fps), strict=True), strict=True))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_groups(docs).collect()}
    assert got == want


def test_simhash_edge_rows(spark):
    rows = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(None, "alone in the null land of ids", None), (3, "one", None), (None, "one", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.simhash_groups(df).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert by[(1, "0" * 16)] == 0 and by[(2, "0" * 16)] == 0
    assert by[(4, f"{plain_fingerprint('one'):016x}")] == 3
    assert by[(None, f"{plain_fingerprint('alone in the null land of ids'):016x}")] is None
    assert simhash.simhash_groups(df.limit(0)).count() == 0
    kept = simhash.simhash_dedup(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i in ids if i is not None} == {c for c in by.values() if c is not None}
    assert ids.count(None) == 2  # a null id says nothing of which row stays, so it does


def test_grid_reaches_all_near_codes_in_few_cells(spark):
    """Codes within a step in one half meet; no fingerprint has more than 34 cells."""
    rng = random.Random(6)
    rows = []
    for _ in range(200):
        a = b = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 4)):
            b ^= 1 << rng.randrange(64)
        rows.append([int(np.uint64(x).view(np.int64)) for x in (a, b)])
    code = lambda c: F.expr(f"({c} | shiftrightunsigned({c}, 1)) & {simhash.EVEN}L | shiftleft({c} & shiftrightunsigned({c}, 1) & {simhash.EVEN}L, 1)")
    cells = lambda c, half: simhash._reached(code(c), half, 1)
    both = [F.arrays_overlap(cells("a", h), cells("b", h)) for h in simhash.HALVES]
    many = [F.size(cells("a", h)) for h in simhash.HALVES]
    got = spark.createDataFrame(rows, "a long, b long").select((both[0] | both[1]).alias("met"), (many[0] + many[1]).alias("n")).collect()
    assert all(r.met and 2 <= r.n <= 34 for r in got)


@pytest.mark.parametrize("tile", [4096, 16])
def test_near_links_of_clusters(spark, tile):
    rng = random.Random(2)
    fps = set()
    for _ in range(40):
        c = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 60])):
            x = c
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), tile=tile).collect()
    mask = (1 << 64) - 1
    assert all(((r.src ^ r.dst) & mask).bit_count() <= 3 for r in links)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        parent[find(r.src & mask)] = find(r.dst & mask)
    want = brute_components([(f, f) for f in fps])
    got_root = {f: find(f) for f in fps}
    groups = {}
    for f, w in zip([f for f in fps], want, strict=True):
        groups.setdefault(w, set()).add(got_root[f])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({find(f) for f in fps})


def test_exact_groups_edges(spark):
    rows = [(1, "A b", "k"), (2, "a B", "k"), (3, "É", None), (4, "é", "q"), (5, None, "q"), (6, "", "q"), (None, "a b", "z"), (None, "solo", "z"), (7, "a b", "z"), (7, "a b", "z"), (8, "x" * 300000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    got = exact_dedup.exact_groups(df).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)
    want = {}
    for d, t, _ in rows:
        want.setdefault(low(t), []).append(d)
    for r in got:
        group = next(g for t, g in want.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        top = max((d for d in group if d is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (top, len(group), r.doc_id == top)
    kept = exact_dedup.exact_dedup(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 4, 6, 7, 7, 8]
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0


def test_exact_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("Same")).otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_groups(df).groupBy("group_size").agg(F.count("*").alias("n"), F.count_if("kept").alias("k")).collect()
    assert {(r.group_size, r.n, r.k) for r in got} == {(1000, 1000, 1), (1, 2000, 2000)}
    assert exact_dedup.exact_groups(df, keep="smallest").where("group_size > 1 and kept").first().doc_id == 0
