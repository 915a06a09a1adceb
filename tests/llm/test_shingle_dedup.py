import random

import corpus_pipeline
from weftline.llm import shingle_dedup, simhash


def plain_set(t):
    w = (t or "").lower().split()
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def plain_groups(rows):
    """[(doc_id, text)]: the least id reachable over pairs of similarity 0.8 or more, by brute force."""
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(rows))]


def near_copies():
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = [None, "", " \t", "one", "One", "one two three four five", "one two three four six"]
    for n in (12, 60, 60, 300, 300, 1500):
        base = [word() for _ in range(n)]
        for edits in (0, 1, 1, 2, 4, n // 50, n // 40, n // 30, n // 20):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(n)] = word()
            texts.append(" ".join(copy))
    line = "all of this stands on every page of the site and says nothing "
    texts += [line * 2 + " ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(30)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return [*zip(ids, texts, strict=True), (None, "a text that has no id of its own"), (None, texts[-1])]


def test_near_copies_match_brute_force(spark):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_groups(rows)
    assert sum(d is not None and w != d for (d, _), w in zip(rows, want, strict=True)) > 20
    got = [(r.doc_id, r.component_id) for r in shingle_dedup.shingle_groups(df).collect()]
    assert sorted(got, key=str) == sorted([(d, w) for (d, _), w in zip(rows, want, strict=True)], key=str)
    kept = corpus_pipeline.near(spark, df, "").collect()
    assert sorted([r.doc_id for r in kept], key=str) == sorted([d for (d, _), w in zip(rows, want, strict=True) if d is None or d == w], key=str)
    assert shingle_dedup.shingle_dedup(df.limit(0)).count() == 0 and shingle_dedup.shingle_dedup(df).columns == df.columns


def test_near_stage_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {d for (d, _), w in zip(rows, plain_groups(rows), strict=True) if d == w}
    assert {r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect()} == want


def edited(n, edits, rng):
    words = [f"w{rng.randrange(3000)}" for _ in range(n)]
    out = [" ".join(words)]
    for _ in range(edits):
        copy = list(words)
        copy[rng.randrange(n)] = "edited"
        out.append(" ".join(copy))
    return out


def test_simhash_grid_comes_first(spark, monkeypatch):
    """The grid's links join light edits before any cell is looked at; each of them is checked exactly."""
    rng = random.Random(8)
    for text in [None, "", "One two", *edited(400, 1, rng), "a b " * 40_000]:
        assert shingle_dedup.simhash_of(shingle_dedup.hashes(text)) == simhash.fingerprint(text, 5)
    rows = [*enumerate([*edited(3000, 12, rng), *edited(3000, 12, rng), *edited(12, 3, rng)])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    grid, cells = shingle_dedup.grid_pairs, shingle_dedup._open_cells
    monkeypatch.setattr(shingle_dedup, "grid_pairs", lambda keyed: seen.append(("grid", (out := grid(keyed)).count())) or out)
    monkeypatch.setattr(shingle_dedup, "_open_cells", lambda r: seen.append(("cells", (out := cells(r)).count())) or out)
    got = [r.component_id for r in sorted(shingle_dedup.shingle_groups(df).collect())]
    assert got == plain_groups(rows)
    assert seen[0][0] == "grid" and seen[0][1] >= 20  # most of the two groups' 24 copies
    # texts of one fingerprint whose sets have little in common stay apart
    monkeypatch.setattr(shingle_dedup, "simhash_of", lambda found: 5)
    monkeypatch.setattr(shingle_dedup, "grid_pairs", grid)
    some = spark.createDataFrame([(i, " ".join(f"{i}x{k}" for k in range(30))) for i in range(20)], "doc_id long, text string")
    assert all(r.doc_id == r.component_id for r in shingle_dedup.shingle_groups(some).collect())
