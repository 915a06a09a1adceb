import numpy as np
import pytest

from weftline.llm.embedding_dedup import embedding_groups, quantise, tile_links


def brute(rows, least=0.9):
    """rows: (vec_id, vector); results by row position."""
    good = []
    for at, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append((at, np.array(v, np.float64)))
    links = {at: set() for at in range(len(rows))}
    for a, x in good:
        for b, y in good:
            if a < b and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                links[a].add(b)
                links[b].add(a)
    out = []
    for at, (i, _) in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        top = min((rows[s][0] for s in seen if rows[s][0] is not None), default=None)
        out.append((i, len(links[at]), top, i is not None and i == top))
    return sorted(out, key=str)


@pytest.mark.parametrize(("kind", "tile"), [("float", 4096), ("double", 16)])
def test_groups_match_brute_force(spark, kind, tile):
    rng = np.random.default_rng(4)
    rows = []
    for c in rng.normal(size=(25, 12)):
        for _ in range(int(rng.choice([1, 2, 9]))):
            rows.append((len(rows), [float(np.float32(x)) for x in c + rng.normal(size=12) * rng.choice([0.05, 0.35])]))
    rows += [(900, rows[3][1]), (901, rows[3][1]), (902, [2 * x for x in rows[3][1]]), (903, None), (904, []), (905, [0.0] * 12), (906, [1.0, None] + [0.0] * 10), (907, [float("nan")] * 12), (908, [float("inf")] * 12), (909, [1.0, 2.0]), (910, [1.0, 2.0]), (None, rows[5][1]), (911, [-0.0] * 11 + [1.0]), (912, [0.0] * 11 + [1.0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, id string")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_groups(df, tile=tile).collect()), key=str)
    assert got == brute(rows)


def test_no_vectors(spark):
    assert embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_tiles_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(300, 16))
    b = a + rng.normal(size=a.shape) * 0.47
    cosine = (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1))
    for least in (0.9, 0.5, float(np.sort(cosine.ravel())[-40])):
        want = {(int(i), int(j)) for i, j in zip(*np.nonzero(cosine >= least), strict=True)}
        got = {(int(i), int(j)) for i, j in tile_links(a, b, least, False)}
        near = {(int(i), int(j)) for i, j in zip(*np.nonzero(np.abs(cosine - least) < 1e-12), strict=True)}
        assert got ^ want <= near


def test_bounds_hold():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(50, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    codes, step, lost = quantise(x)
    near = codes * step[:, None]
    assert (np.abs(x @ x.T - near @ near.T) <= lost[:, None] + lost[None, :] * (1 + lost[:, None])).all()
