"""SimHash near-dedup: fingerprints, a segment-popcount grid join, exact verification.

The 64 bits of a fingerprint are cut into 32 segments of two. A segment's number of set bits
is written in unary (00, 01, 11), so that the Manhattan distance of two vectors of counts is
the number of bits in which their codes differ. It never exceeds the Hamming distance of the
fingerprints, and so bounds it from below.

The grid's axes are the segments. Of two fingerprints within Manhattan distance ``max_bits`` (3),
one half of the axes lies within ``max_bits // 2`` (1): a range join over each half's grid finds
them. Each fingerprint stands in the cell of its own counts and in the neighbouring cells that lie
a step up in one axis (in up to ``max_bits // 2`` axes); the lower of two near fingerprints meets
the upper one in the upper one's cell. That makes about 26 rows for a fingerprint, however many
there are. Cells larger than a tile are cut into tiles whose pairs cover the cell. In a tile the
candidates pass the Manhattan bound, then the exact distance, and only a spanning forest of the links leaves it:
links lost this way join fingerprints that the forest already joins, so components are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import table, without
from weftline.operators.components import connected_components
from weftline.operators.skew import deal, with_totals
from weftline.session import cut

SEED, BITS, SEGMENTS = 42, 64, 32
PIECE = 1 << 15
EVEN = 0x5555555555555555
#: The halves of the axes, each as its segments.
HALVES = (range(0, SEGMENTS // 2), range(SEGMENTS // 2, SEGMENTS))


def fingerprint(text: str | None, words: int = 3, seed: int = SEED) -> int:
    """The unsigned SimHash of the word shingles of ``text``: a bit is set if it is set in over
    half of the shingles' hashes. A-Z are lower-cased; fewer words than a shingle give the whole
    sequence as one; no words (null, empty, white space) give zero."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    ends = ends[words - 1 :] if len(parts) >= words else ends[-1:]
    spans = list(zip(starts[:n].tolist(), ends.tolist(), strict=True))
    digest, counts = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for i in range(0, n, PIECE):
        raw = b"".join([digest(joined[a:b], seed) for a, b in spans[i : i + PIECE]])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long), one row per input row."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words, seed) for t in b.column("t")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).mapInArrow(run, f"doc_id {kind}, fp long")


def unary(fp: np.ndarray) -> np.ndarray:
    """Unary codes of the segments' bit counts."""
    a, b = fp & np.uint64(EVEN), (fp >> np.uint64(1)) & np.uint64(EVEN)
    return a | b | ((a & b) << np.uint64(1))


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _reached(code: Column, half: range, steps: int) -> Column:
    """The cells of one half of the axes that lie at most ``steps`` up from a unary code: an array."""
    own = code.bitwiseAND(_signed(sum(3 << (2 * s) for s in half)))
    found = F.array(own)
    for _ in range(steps):
        # one up: no set bit becomes one, one becomes two, and two have no neighbour
        ups = lambda c: F.array(*[F.when(c.bitwiseAND(_signed(1 << (2 * s))) == 0, c.bitwiseOR(_signed(1 << (2 * s)))).when(c.bitwiseAND(_signed(2 << (2 * s))) == 0, c.bitwiseOR(_signed(2 << (2 * s)))) for s in half])
        found = F.array_distinct(F.concat(found, F.filter(F.flatten(F.transform(found, ups)), lambda c: c.isNotNull())))
    return found


def _forest(fp: np.ndarray, code: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints."""
    left, out = np.arange(len(fp)), []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(code[left] ^ code[x]) <= max_bits
            near[near] = np.bitwise_count(fp[left[near]] ^ fp[x]) <= max_bits
            hits = left[near].tolist()
            if hits:
                out += [(x, h) for h in hits]
                queue += hits
                left = left[~near]
    return out


def _cell_links(batches, max_bits: int, small: int = 8):
    """Links from rows (cell, fp) sorted by cell; a cell may span batches."""

    def links(keys, fp):
        new = np.ones(len(fp), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(fp)))
        code, src, dst = unary(fp), [], []
        group = np.repeat(np.arange(len(first)), size)
        few = (size <= small)[group]
        for step in range(1, small):
            i = np.flatnonzero((group[:-step] == group[step:]) & few[:-step]) if len(fp) > step else np.array([], int)
            i = i[np.bitwise_count(code[i] ^ code[i + step]) <= max_bits]
            i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= max_bits]
            src.append(fp[i])
            dst.append(fp[i + step])
        for a, n in zip(first[size > small], size[size > small], strict=True):
            got = np.array(_forest(fp[a : a + n], code[a : a + n], max_bits), int).reshape(-1, 2)
            src.append(fp[a + got[:, 0]])
            dst.append(fp[a + got[:, 1]])
        a, b = np.concatenate(src).view(np.int64), np.concatenate(dst).view(np.int64)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["src", "dst"])

    held_k, held_f = np.empty(0, np.int64), np.empty(0, np.uint64)
    for b in batches:
        held_k = np.concatenate([held_k, b.column("cell").to_numpy()])
        held_f = np.concatenate([held_f, b.column("fp").to_numpy().view(np.uint64)])
        # the last cell may go on in the next batch
        end = int(np.searchsorted(held_k, held_k[-1])) if len(held_k) else 0
        if end:
            yield links(held_k[:end], held_f[:end])
            held_k, held_f = held_k[end:], held_f[end:]
    if len(held_f):
        yield links(held_k, held_f)


def near_links(fps: DataFrame, max_bits: int = 3, tile: int = 4096, most_hot: int = 20_000) -> DataFrame:
    """Links (src, dst) that span every component of fingerprints within ``max_bits`` bits.

    ``fps`` holds distinct fingerprints in the column fp. Cells that a 1-in-``sampled`` sample of
    the fingerprints shows to be hot are cut into chunks of about ``tile``; a tile holds two of
    them, so a cell of m fingerprints makes m / tile copies of each of its rows. Few cells can be
    hot, so they are broadcast; whether a cell is called hot never changes the components.
    """
    n = fps.count()
    code = F.expr(f"(fp | shiftrightunsigned(fp, 1)) & {EVEN}L | shiftleft(fp & shiftrightunsigned(fp, 1) & {EVEN}L, 1)")
    # a cell's key; cells that share a key by chance only meet candidates more
    keyed = lambda i: lambda c: F.xxhash64(F.lit(i), c)
    keys = F.concat(*[F.transform(_reached(F.col("code"), half, max_bits // 2), keyed(i)) for i, half in enumerate(HALVES)])
    cells = fps.select("fp", code.alias("code")).select("fp", F.explode(keys).alias("cell"))
    sampled = 16 if tile >= 64 else 1
    limit = max(tile, 26 * n // most_hot)
    part = cells.where(F.pmod(F.xxhash64("fp", F.lit(5)), F.lit(sampled)) == 0)
    hot = part.groupBy("cell").agg((F.count("*") * sampled).alias("n")).where(F.col("n") > limit).select("cell", F.ceil(F.col("n") / tile).cast("int").alias("chunks"))
    known = cells.join(F.broadcast(hot), "cell", "left").withColumn("own", F.pmod(F.xxhash64("fp", F.lit(6)), F.col("chunks")).cast("int"))
    # a hot cell's chunk meets each other chunk in a tile of their own
    other = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: x != F.col("own"))
    tiles = F.transform(other, lambda x: F.xxhash64("cell", F.least("own", x), F.greatest("own", x)))
    rows = known.select(F.explode(F.when(F.col("chunks") > 1, tiles).otherwise(F.array("cell"))).alias("cell"), "fp")
    dealt = rows.repartition("cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInArrow(lambda it: _cell_links(it, max_bits), "src long, dst long").distinct()


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3, max_bits: int = 3, seed: int = SEED, tile: int = 4096) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, n_same.

    component_id is the least doc_id of the fingerprints reachable over links of ``max_bits``
    differing bits or fewer (null if none there has an id); n_same counts the rows with the very
    same fingerprint. Null and empty texts have fingerprint zero and link like any other; rows
    that repeat share theirs; an empty table gives an empty result.
    """
    fps = cut(fingerprints(docs, text, doc_id, words, seed))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_same")))
    # components of fingerprints, then the least id of each, by the tree
    found = connected_components(near_links(distinct.select("fp"), max_bits, tile))
    joined = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    labelled = cut(with_totals(deal(joined, ["component"], F.xxhash64("fp", F.lit(7)), 16, 16), ["component"], {"component_id": (F.min("least"), F.min)}, 16, 16))
    # documents meet their fingerprint's row by run, so a very common one is spread out
    runs = 64
    spread = fps.withColumn("run", F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(8)), F.lit(runs)).cast("int")).repartition("fp", "run")
    per_run = spread.groupBy("fp", "run").agg(F.count("*").alias("here")).join(labelled.select("fp", "component_id", "n_same"), "fp").drop("here")
    out = spread.join(per_run, ["fp", "run"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_same")


def simhash_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3, max_bits: int = 3, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its group, and rows without an id; all columns
    as they are. Ids name documents: rows that share an id stay or go together."""
    gone = simhash_groups(docs, text, doc_id, words, max_bits, seed).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return without(docs, gone, [docs[doc_id] == gone["__gone"]])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
