"""Near-dedup by shingle similarity: the form of operator 8 for a similarity in place of bits.

SimHash comes first: fingerprints of the shingles meet in operator 8's segment-popcount grid, and
the links that it finds are checked exactly, set against set. That brings copies and light edits
together in one pass, however large their group.

Word shingles that are alike by 0.8 leave fingerprints some ten bits of 64 apart, though, and up to
twenty in the tail: so wide a range leaves a grid of fingerprints no selective cell, and no range is
wide enough for certain. For what the grid leaves apart, the shingle hashes of a text are kept as a
set and the sets are joined exactly.

Two sets whose Jaccard similarity is ``t`` or more share at least the share t of either one's
members, so that, whatever order all sets are sorted in, they meet in the first
n - ceil(t * n) + 1 members of both (n: the set's size). Each of those members is a cell of its
set. Where two sets meet first, what follows in both bounds what they can share, which rules out
most strangers. Shingles that a sample shows to be common come last in the order, which keeps cells
small; which ones are called common never changes the result.

Groups of copies are linked without their pairs: in each round some sets of a cell are its hubs,
every other set of the cell that isn't in the hub's component yet is held against them, and the hubs
leave the cell. A pair meets by its sketches first, the parities of the members over a few bits each,
which bound the sets' difference from below; of those left, whole sets are compared for one pair of each set,
and then for the pairs that are still between components. Cells whose sets are in one component are done. A round makes at most
``EMIT`` candidates for each row that the first one had. The components are those of all similar pairs.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import lean, slices, sweep, without
from weftline.llm.simhash import BITS, PIECE, near_links
from weftline.operators.components import connected_components
from weftline.session import cut, cut_round, prepare

WORDS, SIMILARITY, SEED = 5, 0.8, 42
EPS = 1e-9
#: Candidates of a round for each row of the first; hubs of a cell in a round; cells in over one of so many sampled texts are salted.
EMIT, MOST_HUBS, HOT, SALTS = 64, 4096, 200, 64
#: Up to so many likely pairs of a round are compared in one step.
FEW = 1000


def hashes(text: str | None, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The hashes of the word shingles in order, A-Z lower-cased; fewer words than a shingle give
    the whole sequence as one; no words give none."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    digest, n = xxhash.xxh64_intdigest, max(1, len(parts) - words + 1)
    return np.fromiter((digest(b" ".join(parts[i : i + words]), seed) for i in range(n)), np.uint64, n)


def shingles(text: str | None, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The sorted distinct hashes of the word shingles."""
    return np.unique(hashes(text, words, seed))


def simhash_of(found: np.ndarray) -> int:
    """``simhash.fingerprint`` of a text, given the hashes of its shingles."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(found), PIECE):
        counts += np.unpackbits(found[i : i + PIECE].astype(">u8").view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(found)).tobytes(), "big")


def key_of(members: np.ndarray) -> int:
    """One 64-bit key for equal sets."""
    return xxhash.xxh64_intdigest(members.tobytes(), SEED)


def prefix(members: np.ndarray, similarity: float, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The members in which a set meets every set of at least the similarity; ``common`` is sorted."""
    n = len(members)
    size = n - ceil(similarity * n - EPS) + 1 if n else 0
    rank = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, members), len(common) - 1)
        rank = np.where(common[at] == members, counts[at], 0)
    return members[np.lexsort((members, rank))[:size]]


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - EPS


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(a, np.uint64).view(np.int64))


def common_shingles(docs: DataFrame, text: str, words: int, sample: int, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of ``least`` or more among about ``sample`` texts, sorted, and their counts."""
    share = min(1.0, sample / max(docs.count(), 1))
    drawn = docs.select(F.col(text).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches):
        for b in (s for whole in batches for s in slices(whole)):
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate([np.empty(0, np.uint64), *(shingles(t.as_py(), words) for t in b.column("t"))]))], ["s"])

    rows = drawn.mapInArrow(run, "s long").groupBy("s").count().where(F.col("count") >= least).toArrow()
    common, counts = rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy()
    order = np.argsort(common)
    return common[order], counts[order]


def shared_cells(docs: DataFrame, text: str, words: int, similarity: float, sample: int) -> DataFrame:
    """(cell, key, n, at, many): for every set, the cells in which another set stands, and whether
    more than two rows do. Sets that repeat may stand in a cell again."""
    found = common_shingles(docs, text, words, sample)
    shared = docs.sparkSession.sparkContext.broadcast(found)  # shingles of about ``sample`` texts

    def cells(batches):
        common, counts = shared.value
        hot = common[counts * HOT > sample]
        for b in (s for whole in batches for s in slices(whole)):
            sets = [shingles(t.as_py(), words) for t in b.column("t")]
            heads = [prefix(s, similarity, common, counts) for s in sets]
            long = [len(h) for h in heads]
            keys = np.repeat(np.array([key_of(s) for s in sets], np.uint64), long)
            cell = np.concatenate([np.empty(0, np.uint64), *heads])
            at = np.arange(len(cell)) - np.repeat(np.cumsum(long) - long, long)
            is_hot = np.isin(cell, hot)
            columns = [_signed(cell), pa.array(np.where(is_hot, keys % np.uint64(SALTS), 0).astype(np.int32)), _signed(keys)]
            columns += [pa.array(c.astype(np.int32)) for c in (np.repeat(np.array([len(s) for s in sets], np.int64), long), at)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(is_hot)], ["cell", "salt", "key", "n", "at", "hot"])

    made = docs.select(F.col(text).alias("t")).mapInArrow(cells, "cell long, salt int, key long, n int, at int, hot boolean")
    own = Window.partitionBy("cell", "salt")
    met = made.withColumn("met", F.col("hot") | (F.min("key").over(own) != F.max("key").over(own))).withColumn("many", F.col("hot") | (F.count("*").over(own) > 2))
    return met.where("met").select("cell", "key", "n", "at", "many")


def candidates(rows: DataFrame, hubs: DataFrame, similarity: float) -> DataFrame:
    """Pairs (src, dst) of a cell's hubs and its other sets that aren't in one component yet and that,
    meeting here first, can share enough."""
    at = rows.join(hubs.select("cell", "hub"), "cell")
    fits = F.least(F.col("n") - F.col("at"), F.col("hub.n") - F.col("hub.at")) >= similarity / (1 + similarity) * (F.col("n") + F.col("hub.n")) - EPS
    pairs = at.where((F.col("comp") != F.col("hub.comp")) & fits)
    return pairs.select(F.least("key", "hub.key").alias("src"), F.greatest("key", "hub.key").alias("dst")).distinct()


def sketch(members: np.ndarray) -> bytes:
    """The parity of how many members fall on each of m bits, m a power of two from 2 n (64 at least)."""
    m = max(64, 1 << (2 * len(members) - 1).bit_length()) if len(members) else 64
    odd = np.zeros(m, np.uint8)
    np.bitwise_xor.at(odd, (members & np.uint64(m - 1)).astype(np.int64), 1)
    return np.packbits(odd).tobytes()


def may_be_similar(a: bytes, n: int, b: bytes, k: int, similarity: float) -> bool:
    """False only for sets whose similarity is surely less: each bit that differs stands for another
    member that only one of the two has. A longer sketch is folded to the shorter one's length."""
    a, b = (np.frombuffer(x, np.uint8) for x in sorted((a, b), key=len))
    b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum()) <= (1 - similarity) / (1 + similarity) * (n + k) + EPS


def _texts(docs: DataFrame, reps: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(t): the texts that ``reps`` (want_tx, want_id) names."""
    read = docs.select(F.col(text).alias("t"), F.xxhash64(text).alias("tx"), F.col(doc_id).alias("own_id"))
    wanted = _small(reps.select("want_tx", "want_id"))
    return read.join(wanted, [read.tx == wanted.want_tx, read.own_id.eqNullSafe(wanted.want_id)], "left_semi").select("t")


def _judged(made: DataFrame, pairs: DataFrame, judge) -> DataFrame:
    """Those of ``pairs`` (src, dst: keys) for which ``judge`` holds; it is given what ``made`` (key, n,
    made) has of either one. A pair's two rows stand side by side, and each is sent to it once."""
    halves = pairs.select(F.explode(F.array("src", "dst")).alias("key"), "src", "dst")

    def run(batches):
        last = (None, None, None, None)
        for b in (s for whole in batches for s in slices(whole)):
            out = []
            for row, at in zip(zip(*(b.column(c).to_pylist() for c in ("src", "dst", "key", "n")), strict=True), range(len(b)), strict=True):
                here = row[:2], row[2], row[3], b.column("made")[at].as_py()
                # a text that stands twice repeats its row
                if here[0] == last[0] and here[1] != last[1] and judge(last[3], last[2], here[3], here[2]):
                    out.append(here[0])
                last = here
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], ["src", "dst"])

    sent = made.join(_small(halves), "key").repartition("src", "dst").sortWithinPartitions("src", "dst", "key")
    return sent.select("src", "dst", "key", "n", "made").mapInArrow(run, "src long, dst long").distinct()


def _made(texts: DataFrame, words: int, make) -> DataFrame:
    """(key, n, made) of the shingle sets of ``texts``."""

    def run(batches):
        for b in (s for whole in batches for s in slices(whole)):
            sets = [shingles(t.as_py(), words) for t in b.column("t")]
            columns = [_signed(np.array([key_of(s) for s in sets], np.uint64)), pa.array([len(s) for s in sets], pa.int32()), pa.array([make(s) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n", "made"])

    return texts.mapInArrow(run, "key long, n int, made binary")


def similar_pairs(docs: DataFrame, pairs: DataFrame, reps: DataFrame, text: str, doc_id: str, words: int, similarity: float) -> DataFrame:
    """Those of ``pairs`` (src, dst: keys) whose whole sets are similar enough. Only the texts that
    stand for a wanted key in ``reps`` are read again."""
    keys = pairs.select(F.explode(F.array("src", "dst")).alias("key")).distinct()
    wanted = cut(reps.join(_small(keys), "key", "left_semi"))
    sets = _made(_texts(docs, wanted, text, doc_id), words, np.ndarray.tobytes)
    return _judged(sets, pairs, lambda a, _n, b, _k: similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), similarity))


def _small(df: DataFrame, most: int = 200_000) -> DataFrame:
    """``df`` to be broadcast if it has at most so many (narrow) rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (src, dst) whose ends aren't in one component."""
    labels = _small(labels)
    for end in ("src", "dst"):
        pairs = pairs.join(labels.select(F.col("key").alias(end), F.col("comp").alias(f"{end}_comp")), end, "left")
    return pairs.where(F.coalesce("src_comp", "src") != F.coalesce("dst_comp", "dst")).select("src", "dst")


def grid_pairs(keyed: DataFrame) -> DataFrame:
    """Pairs (src, dst) of keys that SimHash joins: one key for each end of a link of fingerprints in
    the grid, and of the keys of one fingerprint the least with each other."""
    keys = cut(keyed.select("key", "fp").distinct())
    ends = cut(keys.groupBy("fp").agg(F.min("key").alias("least"), F.max("key").alias("most")))
    far = cut(near_links(ends.select("fp")))
    for end in ("src", "dst"):
        far = cut(ends.select(F.col("fp").alias(end), F.col("least").alias(f"{end}_key")).join(_small(far), end))
    # a fingerprint's keys meet its row by run, so a very common one is spread out
    dealt = keys.withColumn("run", F.pmod(F.xxhash64("key", F.lit(8)), F.lit(SALTS)))
    many = _small(ends.where("least <> most").select("fp", "least"))
    same = dealt.join(dealt.select("fp", "run").distinct().join(many, "fp"), ["fp", "run"])
    pairs = far.select(F.col("src_key").alias("a"), F.col("dst_key").alias("b")).unionByName(same.select(F.col("least").alias("a"), F.col("key").alias("b")))
    return cut(pairs.where("a <> b").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct())


def _linked(labels: DataFrame, found: DataFrame) -> DataFrame:
    """(key, comp) of the components that ``labels`` and the links ``found`` (src, dst) make together."""
    links = labels.select(F.col("key").alias("src"), F.col("comp").alias("dst")).unionByName(found)
    return cut_round(connected_components(links).select(F.col("node").alias("key"), F.col("component").alias("comp")))


def _open_cells(rows: DataFrame) -> DataFrame:
    """The rows of those cells whose sets are of several components."""
    several = rows.groupBy("cell").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("cell")
    return cut_round(rows.join(several, "cell").select("cell", "key", "n", "at", "many", "comp"))


def key_components(docs: DataFrame, keyed: DataFrame, text: str, doc_id: str, words: int, similarity: float, sample: int = 4_000) -> DataFrame:
    """(key, comp) of all keys that have a similar one: the components of the similar pairs."""
    # one document stands for each key
    reps = keyed.groupBy("key").agg(F.min(F.struct("tx", "doc_id")).alias("row"))
    reps = cut(reps.select("key", F.col("row.tx").alias("want_tx"), F.col("row.doc_id").alias("want_id")))
    labels = docs.sparkSession.createDataFrame([], "key long, comp long")
    tested = grid_pairs(keyed)
    if not tested.isEmpty():
        labels = _linked(labels, cut(similar_pairs(docs, tested, reps, text, doc_id, words, similarity)))
    sweep(docs.sparkSession)
    rows = shared_cells(docs, text, words, similarity, sample).join(_small(labels), "key", "left")
    rows = _open_cells(cut(rows.withColumn("comp", F.coalesce("comp", "key"))))
    first = left = rows.count()
    if not left:
        return labels
    # the sketch of each key that is left is made once
    sketches = cut(_made(_texts(docs, cut(reps.join(_small(rows.select("key").distinct()), "key", "left_semi")), text, doc_id), words, sketch))
    slots = 1  # hubs of a cell grow fourfold a round, so that groups come together before many pairs are tried
    while left:
        sweep(docs.sparkSession)
        slotted = rows.withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(slots)))
        hubs = slotted.groupBy("cell", "slot").agg(F.min(F.struct("key", "n", "at", "comp")).alias("hub"))
        pairs = candidates(rows, hubs, similarity)
        pairs = cut(pairs.join(_small(tested), ["src", "dst"], "left_anti"))
        likely = cut(_judged(sketches, pairs, lambda a, n, b, k: may_be_similar(a, n, b, k, similarity)))
        # where there are many, one pair of each key first: most others are then within one component and need no check
        steps = [likely.groupBy("dst").agg(F.min("src").alias("src")).select("src", "dst"), likely] if likely.count() > FEW else [likely]
        for some in steps:
            some = cut(_apart(some, labels))
            found = None if some.isEmpty() else cut(similar_pairs(docs, some, reps, text, doc_id, words, similarity))
            if found is not None and not found.isEmpty():
                labels = _linked(labels, found)
        # written anew, so that neither its plan nor its partitions add up over the rounds
        tested = cut_round(_apart(tested.unionByName(pairs), labels).repartition("src", "dst"))
        # the hubs have met all others of their cells; what is left matters where it is of several components
        rest = slotted.where("many").join(hubs, ["cell", "slot"]).where(F.col("key") != F.col("hub.key")).select("cell", "key", "n", "at", "many")
        rows = _open_cells(rest.join(_small(labels), "key", "left").withColumn("comp", F.coalesce("comp", "key")))
        left = rows.count()
        slots = max(1, min(4 * slots, MOST_HUBS, EMIT * first // max(left, 1)))
    return labels


def shingle_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, component_id, the least doc_id among the texts reachable over
    pairs of at least the similarity (null if none there has an id). Texts without words, null
    ones too, are alike; an empty table gives an empty result."""
    prepare(docs.sparkSession)

    def run(batches):
        lean()
        for b in batches:
            found = (hashes(t.as_py(), words) for t in b.column("t"))
            made = np.array([(key_of(np.unique(h)), simhash_of(h)) for h in found], np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tx"), _signed(made[:, 0].copy()), _signed(made[:, 1].copy())], ["doc_id", "tx", "key", "fp"])

    kind = dict(docs.dtypes)[doc_id]
    keyed = cut(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tx"), F.col(text).alias("t")).mapInArrow(run, f"doc_id {kind}, tx long, key long, fp long"))
    found = key_components(docs, keyed, text, doc_id, words, similarity)
    # the least id of a key, then of its component; both are counted in part before they meet
    least = cut(keyed.groupBy("key").agg(F.min("doc_id").alias("least")).join(found, "key", "left").withColumn("comp", F.coalesce("comp", "key")))
    names = least.groupBy("comp").agg(F.min("least").alias("component_id"))
    return keyed.join(least.join(names, "comp").select("key", "component_id"), "key").select("doc_id", "component_id")


def shingle_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its group, and rows without an id; all columns
    as they are. Ids name documents: rows that share an id stay or go together."""
    gone = shingle_groups(docs, text, doc_id, words, similarity).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return without(docs, gone, [docs[doc_id] == gone["__gone"]])
