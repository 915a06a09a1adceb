"""Embedding near-dedup by int8 tile products with error bounds.

Equal vectors are merged first. The others are scaled to unit length and quantised to int8 with
a step of their own; what quantisation loses of a vector is measured as the norm of its residue.
For unit vectors x = x' + r and y = y' + s (x', y' quantised) the cosine is
x'y' + x's + r'y, so it lies within |r| + |s| * |x'| of the product x'y'. Products of int8 tiles
are integers, computed exactly; only pairs whose upper bound reaches the threshold are
recomputed in double precision from the vectors as given.

Vectors are ordered along their nearest of a few pivots and cut into tiles; pairs of tiles are
skipped when the angle between their pivots, less their radii, exceeds the threshold's angle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import table
from weftline.operators.components import connected_components
from weftline.operators.skew import deal, with_totals
from weftline.session import cut

TILE = 4096


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, steps, and the norms of what the codes miss, of unit row vectors."""
    step = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / step[:, None]).astype(np.int8)
    # a little more than the measured norm covers rounding in the measurement
    lost = np.linalg.norm(unit - codes * step[:, None], axis=1) + 1e-12
    return codes, step, lost


def tile_links(a: np.ndarray, b: np.ndarray, least: float, same: bool) -> np.ndarray:
    """Index pairs (i, j) of rows of ``a`` and ``b`` (doubles, not zero) with cosine >= ``least``;
    of one tile with itself (``same``) those with i < j."""
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    (qa, sa, la), (qb, sb, lb) = quantise(a / norm_a[:, None]), quantise(b / norm_b[:, None])
    out = [np.empty((0, 2), np.int64)]
    exact = a.shape[1] * 127 * 127 < 1 << 24  # then sums of products are exact in single precision
    kind = np.float32 if exact else np.float64
    qa, qb = qa.astype(kind), qb.astype(kind).T.copy()
    for start in range(0, len(a), 256):
        rows = slice(start, start + 256)
        first = start if same else 0
        # x'y' >= least - |r| - |s| |x'|, with |x'| <= 1 + |r|
        reach = (qa[rows] @ qb[:, first:]) * sb[None, first:].astype(np.float32)
        floor = (least - 1e-6 - la[rows, None] - lb.max(initial=0) * (1 + la[rows, None])) / sa[rows, None]
        i, j = np.nonzero(reach >= floor.astype(np.float32) - 1e-3)
        i, j = i + start, j + first
        if same:
            i, j = i[i < j], j[i < j]
        tight = (qa[i] * qb.T[j]).sum(axis=1, dtype=np.float64) * sa[i] * sb[j] + la[i] + lb[j] * (1 + la[i]) >= least - 1e-9
        i, j = i[tight], j[tight]
        cosine = np.einsum("ij,ij->i", a[i], b[j]) / (norm_a[i] * norm_b[j])
        out.append(np.stack([i, j], axis=1)[cosine >= least])
    return np.concatenate(out)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int, kind: str) -> np.ndarray:
    """Packed vectors as rows of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.float64)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index reachable from each of 0..n-1 over the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def embedding_groups(vectors: DataFrame, least: float = 0.9, embedding: str = "embedding", vec_id: str = "vec_id", pivots: int = 64, tile: int = TILE) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
    nor do vectors of different lengths link. n_links counts the other rows linked directly,
    equal vectors included; component_id is the least vec_id reachable, itself included, and
    kept says that it is the row's own. A null vec_id never is; its row links like any other.
    Rows that repeat an id are rows of their own. An empty table gives an empty result.

    Distinct vectors are told apart by a 64-bit hash of their components. ``pivots`` (at most so
    many vectors, drawn by a hash) order the vectors and bound tiles; the result is exact with any.
    """
    kind = "<f4" if dict(vectors.dtypes)[embedding] == "array<float>" else "<f8"
    e = F.col(embedding).cast("array<double>")
    sound = (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    v = F.when(F.coalesce(sound, F.lit(False)), F.transform(e, lambda x: F.when(x == 0, 0.0).otherwise(x)))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).withColumn("id", F.when(F.col("v").isNotNull(), F.xxhash64(F.col("v").cast("string"), F.lit(17))))
    one = rows.where("v is not null").groupBy("id").agg(F.min("vec_id").alias("least"), F.count("*").alias("same"), F.first("v").alias("v"))
    one = cut(one.withColumn("width", F.size("v")))
    found = None
    for r in one.groupBy("width").agg(F.count("*").alias("n")).where("n > 1").collect():  # as many as there are lengths of vectors
        own = one.where(F.col("width") == r.width).mapInArrow(_packer(kind), "id long, same long, v binary")
        got = _links(own, r.n, r.width, kind, least, pivots, tile)
        found = got if found is None else found.unionByName(got)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "id long, root long, links long")
    found = cut(found)
    degree = found.groupBy("id").agg(F.sum("links").alias("others"))
    component = connected_components(found.where("id <> root"), "id", "root").withColumnRenamed("node", "id")
    named = one.select("id", "least", "same").join(component, "id", "left").withColumn("component", F.coalesce("component", "id")).join(degree, "id", "left")
    dealt = deal(named, ["component"], F.xxhash64("id", F.lit(4)), 16, 16)
    top = with_totals(dealt, ["component"], {"component_id": (F.min("least"), F.min)}, 16, 16)
    known = cut(top.select("id", "component_id", (F.coalesce("others", F.lit(0)) + F.col("same") - 1).alias("n_links")))
    # a very common vector's rows are dealt over runs before they meet its result
    spread = rows.where("v is not null").select("vec_id", "id", F.pmod(F.xxhash64("vec_id", F.lit(8)), F.lit(64)).cast("int").alias("run")).repartition("id", "run")
    per_run = spread.groupBy("id", "run").agg(F.count("*").alias("here")).drop("here").join(known, "id")
    met = spread.join(per_run, ["id", "run"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return met.unionByName(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _packer(kind: str):
    def run(batches):
        for b in batches:
            packed = pa.array([np.asarray(x.values, kind).tobytes() for x in b.column("v")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("same"), packed], ["id", "same", "v"])

    return run


def _links(vectors: DataFrame, n: int, width: int, kind: str, least: float, most_pivots: int, tile: int) -> DataFrame:
    """For each pair of tiles, a row for each vector with a link: id, the least id of those it
    reaches within the pair, and how many rows of others it links with there."""
    drawn = vectors.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(max(1, min(most_pivots, n // tile))).select("v").collect()
    piv = np.array([np.frombuffer(r.v, kind) for r in drawn], np.float64).reshape(-1, width)
    piv /= np.linalg.norm(piv, axis=1, keepdims=True)
    reach = float(np.arccos(min(1.0, least))) + 1e-6

    def place(batches):
        for b in batches:
            m = _matrix(b.column("v"), width, kind)
            cosine = np.clip(m @ piv.T / np.linalg.norm(m, axis=1, keepdims=True), -1, 1)
            near = cosine.argmax(axis=1)
            angle = np.arccos(cosine[np.arange(len(m)), near])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32)), pa.array(angle)], ["id", "same", "v", "pivot", "angle"])

    placed = cut(vectors.mapInArrow(place, "id long, same long, v binary, pivot int, angle double"))
    sizes = {r.pivot: (r.n, r.far) for r in placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("angle").alias("far")).collect()}
    # tiles: a pivot's vectors in parts by a hash, all within its radius
    parts = {p: -(-c // tile) for p, (c, _) in sizes.items()}
    tiles = [(p, i) for p in sorted(sizes) for i in range(parts[p])]
    number = {t: i for i, t in enumerate(tiles)}
    between = np.arccos(np.clip(piv @ piv.T, -1, 1))
    near_of = {p: [q for q in sizes if between[p, q] - sizes[p][1] - sizes[q][1] <= reach] for p in sizes}
    partners = [[number[(q, j)] for q in near_of[p] for j in range(parts[q])] for p, _ in tiles]

    def send(batches):
        for b in batches:
            ids = b.column("id").to_numpy().view(np.uint64) >> np.uint64(7)
            own = [number[(p, i % parts[p])] for p, i in zip(b.column("pivot").to_pylist(), ids.tolist(), strict=True)]
            row = np.repeat(np.arange(len(own)), [len(partners[t]) for t in own])
            other = np.fromiter((o for t in own for o in partners[t]), np.int32, len(row))
            mine = np.array(own, np.int32)[row]
            for at in range(0, len(row), 50_000):
                r, o, t = row[at : at + 50_000], other[at : at + 50_000], mine[at : at + 50_000]
                moved = [b.column(c).take(pa.array(r)) for c in ("id", "same", "v")]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(t, o)), pa.array(np.maximum(t, o)), pa.array(t), *moved], ["low", "high", "own", "id", "same", "v"])

    def join(pair: pa.Table) -> pa.Table:
        low, high = pair.column("low")[0].as_py(), pair.column("high")[0].as_py()
        own, ids, same = (pair.column(c).to_numpy() for c in ("own", "id", "same"))
        order = np.lexsort((ids, own))
        own, ids, same, m = own[order], ids[order], same[order], _matrix(pair.column("v"), width, kind)[order]
        cut_at = int((own == low).sum())
        got = tile_links(m, m, least, True) if low == high else tile_links(m[:cut_at], m[cut_at:], least, False)
        i, j = got[:, 0], got[:, 1] + (0 if low == high else cut_at)
        links = np.bincount(i, same[j], len(ids)) + np.bincount(j, same[i], len(ids))
        some = np.flatnonzero(links)
        return pa.table({"id": ids[some], "root": ids[_roots(len(ids), i, j)[some]], "links": links[some].astype(np.int64)})

    return placed.mapInArrow(send, "low int, high int, own int, id long, same long, v binary").groupBy("low", "high").applyInArrow(join, "id long, root long, links long")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS s, b.vec_id AS d FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(s, d) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.s, l.d FROM reach r JOIN links l ON r.d = l.s),
c AS (SELECT s AS vec_id, min(d) AS component_id FROM reach GROUP BY s),
n AS (SELECT s AS vec_id, count(*) AS n FROM links GROUP BY s)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON v.vec_id = c.vec_id LEFT JOIN n ON v.vec_id = n.vec_id
"""
