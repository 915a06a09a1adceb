"""Language-model scores from a weighted backoff automaton over words.

The automaton's states are the n-grams of one to ``order`` - 1 words that stand in the training
texts, the start of a text (which counts as a word before the first), and a root. From the state
of an n-gram an arc leads, for every word seen after it, to the state of the longest n-gram that
ends there; its weight is the log10 of the smoothed probability
(c(context, word) + m * P(word | shorter context)) / (c(context) + m), with the add-half unigram at
the root. A failure arc leads to the state without the first word and weighs log10 of
m / (c(context) + m). So the weights out of a state sum to one in probability. A text is one
left-to-right traversal: the state is carried from word to word, failure arcs are followed until
a state has the word's arc, and the weights add up. It begins in the state of the start and ends
with the end token. The state that a word leads to is the longest stored n-gram that ends there,
whatever arcs led to it; so all words of a block take their arcs at once, and those whose state
lacks the arc follow their failure arcs together, one length at a time.

Counts are exact and distributed. The texts of an input partition are packed into blocks of words
as numbers, written down once. A block sends its distinct n-grams, as sorted 64-bit keys cut by
key range, with the counts of its training texts; each range adds up the counts and answers every
block with the totals of the keys it asked for. Words and pairs go first. A longer n-gram is
only sent where both n-grams within it stand in other blocks too: any other can't stand elsewhere,
so the block's own count is the total. Each block then builds the
part of the automaton that its texts can reach. No task holds more than a block, a range, and
the answers to a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from weftline.llm.common import remainder, sweep, table
from weftline.session import cut, prepare

HELD_OUT = (5, 1)
END, START = b" end", b" start"  # no word holds a space
PRIOR, ORDER = 8.0, 3
LEAST_RANGES = 64
DIGEST = xxhash.xxh64_intdigest
PRESS = zstandard.ZstdCompressor(level=1)


def tokens(text: str | None) -> list[bytes]:
    """Words of the text, A-Z lower-cased, then one end token."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of 64-bit keys."""
    k = a * np.uint64(0x9E3779B97F4A7C15) + b
    for m in (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F):
        k = (k ^ (k >> np.uint64(32))) * np.uint64(m)
    return k ^ (k >> np.uint64(29))


def _planes(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, so that high bytes, mostly zero, compress."""
    return PRESS.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unplanes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


class Block:
    """Some texts as numbers of their distinct words, and their distinct n-grams of each length."""

    def __init__(self, words: np.ndarray, token: np.ndarray, lengths: np.ndarray, train: np.ndarray) -> None:
        self.words, self.token, self.lengths = words, token, lengths
        self.first = np.cumsum(lengths) - lengths
        self.learn = np.repeat(train.astype(np.float64), lengths)
        self.starts = int(train.sum())
        self.at = np.arange(len(token)) - np.repeat(self.first, lengths)  # of a token in its text
        self.running = words[token]
        self.keys, self.place, self.counts, self.sample = [words], [token], [np.bincount(token, self.learn, len(words)).astype(np.int64)], [None]

    @classmethod
    def of(cls, texts: list[str | None], train: np.ndarray) -> Block:
        number: dict[bytes, int] = {}
        token: list[int] = []
        lengths = []
        for t in texts:
            parts = tokens(t)
            lengths.append(len(parts))
            token += [number.setdefault(w, len(number)) for w in parts]
        words, back = np.unique(np.fromiter(map(DIGEST, number), np.uint64, len(number)), return_inverse=True)
        return cls(words, back[np.array(token, np.int64)], np.array(lengths, np.int64), train)

    def longer(self) -> None:
        """Go on to n-grams of one more word; the start of a text counts as a word."""
        n = len(self.keys) + 1
        before = np.empty_like(self.running)
        before[1:] = self.running[:-1]
        if n == 2:
            before[self.first] = DIGEST(START)
        valid = self.at >= n - 2
        self.running = _mix(before, self.words[self.token])
        where = np.flatnonzero(valid)
        keys, some, back = np.unique(self.running[where], return_index=True, return_inverse=True)
        place = np.full(len(self.token), -1, np.int64)
        place[where] = back
        self.keys.append(keys)
        self.place.append(place)
        self.counts.append(np.bincount(back, self.learn[where], len(keys)).astype(np.int64))
        self.sample.append(where[some])  # a token at which each n-gram ends

    def open(self, shared: np.ndarray) -> np.ndarray:
        """Which of the longest n-grams may stand in other blocks, given which of those of one word less do."""
        at, place = self.sample[-1], self.place[-2]
        return shared[place[at - 1]] & shared[place[at]]


class Automaton:
    """The states that a block's texts can reach, with their arcs and failure arcs."""

    def __init__(self, block: Block, totals: list[np.ndarray], starts: int, total: int, distinct: int, prior: float) -> None:
        self.block, order, width = block, len(totals), len(block.words)
        # states: the root, the start, then seen n-grams below the order by length
        state, sizes, size = [], 2, [0, 1]
        for n in range(order - 1):
            seen = totals[n] > 0
            state.append(np.where(seen, sizes + np.cumsum(seen) - 1, -1))
            sizes += int(seen.sum())
            size += [n + 1] * int(seen.sum())
        self.state, self.size = state, np.array(size, np.int8)  # of a state: the words of its n-gram, the start being one
        self.fail, self.back = np.zeros(sizes, np.int64), np.zeros(sizes)
        self.back[1] = np.log10(prior / (starts + prior))
        p = (totals[0] + 0.5) / (total + 0.5 * (distinct + 1))
        # the root has an arc for every word; weights of the arcs by n-gram, nan where there is no arc
        self.arcs = [np.log10(p)]
        self.root = self.arcs[0]
        for n in range(order):
            seen = totals[n] > 0
            if n < order - 1:
                own = state[n][seen]
                self.back[own] = np.log10(prior / (totals[n][seen] + prior))
                if n:
                    self.fail[own] = state[n - 1][block.place[n - 1][block.sample[n][seen]]]
            if n:
                at, place = block.sample[n], block.place[n - 1]
                at_start = block.at[at] == 0  # the context is the start of a text
                context = np.where(at_start, -1, place[at - 1])
                after = np.where(at_start, starts, totals[n - 1][context])
                p = (totals[n] + prior * p[place[at]]) / (after + prior)
                self.arcs.append(np.where(seen, np.log10(p), np.nan))

    def scores(self) -> np.ndarray:
        """The log10 probability of each text of the block, from the state of the start."""
        block, total = self.block, np.zeros(len(self.block.token))
        # where each word leads, and so the state before the next one
        state = np.zeros(len(total), np.int64)
        for known, place in zip(self.state, block.place, strict=False):
            there = np.where(place >= 0, known[place], -1) if len(known) else np.full(len(place), -1)
            state = np.where(there >= 0, there, state)
        state = np.concatenate([[1], state[:-1]])[: len(total)]
        state[block.first] = 1
        left = np.arange(len(total))
        for n in range(len(self.arcs) - 1, -1, -1):
            here = self.size[state[left]] == n
            words = left[here]
            weight = self.arcs[n][block.place[n][words]]
            has = ~np.isnan(weight)
            total[words[has]] += weight[has]
            failed = words[~has]
            total[failed] += self.back[state[failed]]
            state[failed] = self.fail[state[failed]]
            left = np.concatenate([left[~here], failed])
        return np.add.reduceat(total, block.first) if len(block.first) else total


def _pack(batches: Iterator[pa.RecordBatch], block_chars: int, kept: list[str]) -> Iterator[pa.RecordBatch]:
    """One row for each block of about ``block_chars`` characters, or one text that is longer."""
    held: list[pa.RecordBatch] = []
    chars, number = 0, 0

    def packed():
        nonlocal number
        rows = pa.Table.from_batches(held).combine_chunks()
        block = Block.of(rows.column("t").to_pylist(), rows.column("train").to_numpy())
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, (columns := rows.select(kept)).schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(columns)
        number += 1
        parts = [_planes(np.diff(block.words, prepend=np.uint64(0))), _planes(block.token), _planes(block.lengths), rows.column("train").to_numpy().tobytes(), sink.getvalue().to_pybytes()]
        return pa.RecordBatch.from_arrays([pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()), *(pa.array([x], pa.binary()) for x in parts)], ["block", "words", "token", "lengths", "train", "columns"])

    for batch in batches:
        sizes = np.cumsum(pc.utf8_length(batch.column("t")).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        begin = 0
        while begin < len(batch):
            before = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, before + block_chars - chars, "right")))
            held.append(batch.slice(begin, end - begin))
            chars += int(sizes[end - 1] - before)
            begin = end
            if chars >= block_chars or begin < len(batch):
                yield packed()
                held, chars = [], 0
    if held:
        yield packed()


def _unpack(row: dict) -> Block:
    return Block(_words(row), _unplanes(row["token"]).astype(np.int64), _unplanes(row["lengths"]).astype(np.int64), np.frombuffer(row["train"], bool))


def _words(row: dict) -> np.ndarray:
    return np.cumsum(_unplanes(row["words"]), dtype=np.uint64)


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each key, which never falls as keys rise."""
    return (((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


ASKED = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("starts", pa.int64())])
TOLD = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("counts", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64()), ("starts", pa.int64())])
ASKED_SQL = "range int, block long, n int, keys binary, counts binary, starts long"


def _messages(block: int, n: int, keys: np.ndarray, counts: np.ndarray, ranges: int, starts: int) -> pa.RecordBatch:
    """One row for each range in which the sorted keys lie."""
    of = _ranges(keys, ranges)
    edges = np.flatnonzero(np.diff(of, prepend=-1))
    stops = [*edges[1:], len(keys)][: len(edges)]
    columns = [
        pa.array(of[edges], pa.int32()), pa.array([block] * len(edges), pa.int64()), pa.array([n] * len(edges), pa.int32()),
        pa.array([_planes(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in zip(edges, stops, strict=True)], pa.binary()),
        pa.array([_planes(counts[a:b]) for a, b in zip(edges, stops, strict=True)], pa.binary()),
        pa.array([starts if i == 0 and n == 1 else 0 for i in range(len(edges))], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=ASKED)


def _answer(asked: pa.Table) -> pa.Table:
    """To every block that asked, twice the total of each key of one range, and one more if other blocks asked too."""
    out = {k: [] for k in TOLD.names}
    at, lengths = asked.column("range")[0].as_py(), asked.column("n").to_numpy()
    for n in np.unique(lengths):
        own = asked.filter(pa.array(lengths == n))
        keys = [np.cumsum(_unplanes(k.as_py()), dtype=np.uint64) for k in own.column("keys")]
        counts = np.concatenate([_unplanes(c.as_py()) for c in own.column("counts")]).astype(np.int64)
        _, back, blocks = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        totals = np.bincount(back, counts).astype(np.int64)
        told = 2 * totals + (blocks > 1)
        stops = np.cumsum([len(k) for k in keys])
        for block, a, b in zip(own.column("block").to_pylist(), [0, *stops[:-1]], stops, strict=True):
            for name, value in zip(TOLD.names, (at, block, int(n), _planes(told[back[a:b]]), 0, 0, 0), strict=True):
                out[name].append(value)
        if n == 1:
            for name, value in zip(TOLD.names, (at, -1, 0, b"", int(totals.sum()), int((totals > 0).sum()), sum(own.column("starts").to_pylist())), strict=True):
                out[name].append(value)
    return pa.table(out, TOLD)


def _totals(block: Block, told: pa.Table, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Training counts of the block's n-grams of each length up to ``order``, and which of the longest stand in other blocks."""
    told = told.sort_by([("n", "ascending"), ("range", "ascending")])
    lengths, blobs = told.column("n").to_numpy(), told.column("counts")
    given = lambda n: np.concatenate([np.empty(0, np.int64), *(_unplanes(blobs[int(i)].as_py()).astype(np.int64) for i in np.flatnonzero(lengths == n))])
    out, shared = [], np.empty(0, bool)
    for n in range(1, order + 1):
        if n > 1:
            block.longer()
        sent = block.open(shared) if n > 2 else np.ones(len(block.keys[-1]), bool)
        own = 2 * block.counts[-1]
        own[sent] = given(n)
        out.append(own >> 1)
        shared = (own & 1).astype(bool)
    return out, shared


def _further(n: int, ranges: int):
    """What a block, given the totals of shorter n-grams, asks of those of ``n`` words."""

    def ask(part: pa.Table, answers: pa.Table) -> pa.Table:
        row = part.to_pylist()[0]
        block = _unpack(row)
        _, shared = _totals(block, answers, n - 1)
        block.longer()
        asked = block.open(shared)
        return pa.Table.from_batches([_messages(row["block"], n, block.keys[-1][asked], block.counts[-1][asked], ranges, 0)])

    return ask


def lm_scores(docs: DataFrame, train, text: str = "text", doc_id: str = "doc_id", prior: float = PRIOR, order: int = ORDER, block_chars: int = 3_000_000, range_keys: int = 8_000_000, keep: list[str] | None = None) -> DataFrame:
    """doc_id, the columns ``keep``, and n_tokens, n_known, train_tokens, base_score and score, one
    row per input row. ``train`` is a condition on ``docs``: the rows to learn from (null: not).

    Null and empty texts are the end token alone. Texts are never cut; a block holds about
    ``block_chars`` characters, or one text that is longer. Rows that repeat are learned from as
    often as they stand, wherever they stand. Without training rows every token has the same share.
    Words and n-grams are told apart by 64-bit hashes, of whole length at any size of the input.
    Ranges number about one for ``range_keys`` keys, and 64 at least; a block sends each range one
    row at most and never a row without keys. ``order`` is 2 or more. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    kept = [doc_id, *(keep or [])]
    body = F.coalesce(F.col(text), F.lit(""))
    chars = docs.agg(F.sum(F.length(body).cast("long") + 1)).first()[0] or 0
    ranges = max(LEAST_RANGES, -(-chars * (order - 1) // (6 * range_keys)))
    names = [f"__k{i}" for i in range(len(kept))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(kept, names, strict=True)], body.alias("t"), F.coalesce(train, F.lit(False)).alias("train"))
    blocks = cut(rows.mapInArrow(lambda it: _pack(it, block_chars, names), "block long, words binary, token binary, lengths binary, train binary, columns binary"))

    def first(batches):
        for b in batches:
            for row in b.to_pylist():
                block = _unpack(row)
                yield _messages(row["block"], 1, block.keys[0], block.counts[0], ranges, block.starts)
                block.longer()
                yield _messages(row["block"], 2, block.keys[1], block.counts[1], ranges, 0)

    def answered(asked: DataFrame) -> DataFrame:
        sweep(spark)
        return cut(asked.groupBy("range").applyInArrow(_answer, "range int, block long, n int, counts binary, total long, distinct long, starts long"))

    told = answered(blocks.drop("columns").mapInArrow(first, ASKED_SQL))
    sums = told.where("block = -1").agg(F.sum("total"), F.sum("distinct"), F.sum("starts")).first()
    total, distinct, starts = (int(x or 0) for x in sums)
    told = told.where("block >= 0").select("block", "n", "range", "counts")
    for n in range(3, order + 1):
        asked = blocks.drop("columns").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_further(n, ranges), ASKED_SQL)
        told = told.unionByName(answered(asked).select("block", "n", "range", "counts"))
        del asked
    sweep(spark)

    def score(part: pa.Table, answers: pa.Table) -> pa.Table:
        row = part.to_pylist()[0]
        block = _unpack(row)
        totals, _ = _totals(block, answers, order)
        model = Automaton(block, totals, starts, total, distinct, prior)
        known, base = ((np.add.reduceat(x[block.token], block.first) if len(block.first) else x[:0]) for x in ((totals[0] > 0).astype(np.int64), model.root))
        columns = pa.ipc.open_stream(row["columns"]).read_all()
        return pa.table([*columns.columns, pa.array(block.lengths), pa.array(known), pa.array(np.full(len(known), total)), pa.array(base), pa.array(model.scores(), pa.float64())], [*names, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = StructType(rows.select(*names).schema.fields)
    for c, kind in (("n_tokens", LongType()), ("n_known", LongType()), ("train_tokens", LongType()), ("base_score", DoubleType()), ("score", DoubleType())):
        schema = schema.add(c, kind)
    out = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, schema)
    return out.select(*[F.col(k).alias("doc_id" if k == names[0] else c) for c, k in zip(kept, names, strict=True)], "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1], F.lit(False)))
    return lm_scores(docs, F.col("doc_id").isNotNull() & ~F.col("held_out"), keep=["held_out"])
