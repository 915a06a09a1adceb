"""Toxicity by nearest labelled examples.

Examples are a bounded, documented sample of the labelled rows. A text's terms are its lower-cased
words and the beginnings of its words (three to seven letters, marked by a star), so that
inflected and compounded forms of a word meet. Every term of a text has a place in its TF-IDF
vector. A term weighs its inverse document frequency, raised for terms that tell the labels apart
beyond chance: those decide which examples are near, all others take part with a small weight.

The examples' vectors stand in an inverted index with block maxima: postings of rare terms as lists,
those of frequent terms by block. A query first adds up its rare terms' postings. With them the
block maxima of its frequent terms bound its cosine in each block of examples; blocks are completed,
the most promising first, until no bound left exceeds the k-th best cosine. Many queries go through this
together: one matrix product bounds them, and one for each block completes those that need it. The
examples that may be among a query's nearest are then added up term by term, so the k nearest are
exact and do not depend on the queries beside it. Their
votes, weighted by closeness and by what one example of a class stands for among all labelled
rows, together with a vote of the base rate, give the score; the neighbours are its evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructType

from weftline.llm.common import lean, remainder, slices, table
from weftline.session import cut, prepare

WORD = re.compile(r"\w+")
HELD_OUT = (5, 0)
BEGINNINGS = range(3, 8)
#: Examples in a block; terms in more than one of so many examples are frequent.
BLOCK, FREQUENT = 32, 16
#: Queries that go through the blocks together; what single precision may add to or take from a cosine.
QUERIES, SLACK = 250, 1e-5
#: How many standard errors of the log odds count as chance, and what any term's weight has at least.
CHANCE, FLOOR, POWER = 2.5, 0.05, 1.5


def terms_of(text: str | None) -> Counter:
    """Terms and their counts: lower-cased words, and beginnings of longer words with a star; null
    and empty texts have none."""
    out: Counter = Counter()
    for word, n in Counter(WORD.findall((text or "").lower())).items():
        for term in _terms(word):
            out[term] += n
    return out


def _terms(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in BEGINNINGS if k < len(word))]


@dataclass
class Index:
    """Inverted index of labelled examples; made by ``fit``. Examples that are alike in kind share a block."""

    terms: dict[str, int]  # frequent ones first
    weight: np.ndarray  # of each term, and at the end of any other term
    starts: np.ndarray  # where each rare term's postings start, and the end
    places: np.ndarray  # the examples of the postings
    values: np.ndarray  # their weights in unit vectors
    frequent: np.ndarray  # the same of frequent terms: block x term x example of the block
    maxima: np.ndarray  # their largest weights: term x block
    labels: np.ndarray  # of the examples
    ids: list
    votes: np.ndarray  # class weight of each example
    base: float  # share of label 1 among labelled rows
    k: int = 15
    local: dict = field(default_factory=dict, repr=False)  # word -> its terms' places, within a worker
    others: dict = field(default_factory=dict, repr=False)  # terms that no example has -> places of their own
    seen: dict = field(default_factory=dict, repr=False)

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(terms, unit weights) of a text; terms that no example has have places beyond the index's."""
        return self.vectors([text])[0]

    def vectors(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``vector`` of each text; a word's terms are looked up once for all."""
        if len(self.local) + len(self.others) > 150_000:
            self.local.clear()
            self.others.clear()
        number: dict[str, int] = {}
        words, tf, long = [], [], []
        for text in texts:
            counts = Counter(WORD.findall((text or "").lower()))
            words += [number.setdefault(w, len(number)) for w in counts]
            tf += counts.values()
            long.append(len(counts))
        known, n, found = self.terms, len(self.terms), []
        for word in number:
            at = self.local.get(word)
            if at is None:
                at = tuple([known[t] if t in known else n + self.others.setdefault(t, len(self.others)) for t in _terms(word)])
                if len(word) <= 40:
                    self.local[word] = at
            found.append(at)
        size = np.fromiter(map(len, found), np.int64, len(found))
        start, terms = np.cumsum(size) - size, np.fromiter(chain.from_iterable(found), np.int64, size.sum())
        words, doc = np.array(words, np.int64), np.repeat(np.arange(len(texts)), long)
        many = size[words]
        terms = terms[np.arange(many.sum()) + np.repeat(start[words] - np.cumsum(many) + many, many)]
        top = n + len(self.others) + 1
        key, back = np.unique(np.repeat(doc, many) * top + terms, return_inverse=True)
        doc, at = np.divmod(key, top)
        weights = (1 + np.log(np.bincount(back, np.repeat(np.array(tf, float), many), len(key)))) * self.weight[np.minimum(at, n)]
        out, edges = [], np.searchsorted(doc, np.arange(len(texts) + 1))
        for low, high in zip(edges, edges[1:], strict=False):
            own = weights[low:high]
            length = np.linalg.norm(own)
            out.append((at[low:high], own / length if length > 0 else own))
        return out

    def nearest(self, at: np.ndarray, weights: np.ndarray) -> list[tuple[float, int]]:
        """Exact k nearest examples of a query vector: (cosine, example), the nearest first, ties by
        the example's place. Examples of cosine 0 aren't neighbours."""
        return self.nearest_many([(at, weights)])[0]

    def nearest_many(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> list[list[tuple[float, int]]]:
        """``nearest`` of each query vector."""
        if not len(self.labels):
            return [[] for _ in queries]
        n, blocks, often = len(self.terms), len(self.frequent), self.maxima.shape[0]
        part = np.zeros((len(queries), blocks, BLOCK), np.float32)  # cosines: of rare terms, and of all where a block is complete
        heavy, rare = np.zeros((len(queries), often), np.float32), []
        for i, (at, weights) in enumerate(queries):
            a, b = np.searchsorted(at, [often, n])  # places rise: frequent, rare, other terms
            heavy[i, at[:a]] = weights[:a]
            own = at[a:b] - often
            many = self.starts[own + 1] - self.starts[own]
            there = np.arange(many.sum()) + np.repeat(self.starts[own] - np.cumsum(many) + many, many)
            rare.append(np.bincount(self.places[there], np.repeat(weights[a:b], many) * self.values[there], blocks * BLOCK))
            part[i] = rare[-1].reshape(blocks, BLOCK)
        bounds = part.max(axis=2) + heavy @ self.maxima
        order = np.argsort(-bounds, axis=1, kind="stable")
        turn = np.empty_like(order)  # of a block, for each query
        np.put_along_axis(turn, order, np.arange(blocks)[None, :], axis=1)
        done, least = np.zeros(bounds.shape, bool), np.zeros(len(queries), np.float32)
        first = -(-self.k // BLOCK)
        for low, high in ((0, first), (first, 4 * first), (4 * first, blocks)):
            chosen = (turn >= low) & (turn < high) & (bounds > 0) & (bounds >= least[:, None] - SLACK)
            for block in np.flatnonzero(chosen.any(axis=0)):
                own = np.flatnonzero(chosen[:, block])
                part[own, block] += heavy[own] @ self.frequent[block]
            done |= chosen
            cosines = np.where(done[:, :, None], part, 0).reshape(len(queries), -1)
            if cosines.shape[1] > self.k:
                least = np.partition(cosines, cosines.shape[1] - self.k, axis=1)[:, -self.k]
        out = []
        for (at, weights), mine, bound, slow in zip(queries, cosines, least, rare, strict=True):
            places = np.flatnonzero(mine > max(bound - SLACK, 0))
            a = np.searchsorted(at, often)
            of, mass = at[:a], weights[:a]
            exact = slow[places] + (self.frequent[(places // BLOCK)[:, None], of, (places % BLOCK)[:, None]] * mass).sum(axis=1)
            exact = np.round(exact, 7)
            best = np.lexsort((places, -exact))[: self.k]
            out.append([(c, i) for c, i in zip(exact[best].tolist(), places[best].tolist(), strict=True) if c > 0])
        return out

    def score(self, text: str | None) -> tuple[float, list[tuple[float, int]]]:
        """(score, neighbours) of a text."""
        return self.scores([text])[0]

    def scores(self, texts: list[str | None]) -> list[tuple[float, list[tuple[float, int]]]]:
        """(score, neighbours) of each text."""
        keys = [xxhash.xxh128_digest(t.encode("utf-8", "surrogatepass")) if t and len(t) > 200 else t or "" for t in texts]
        if len(self.seen) >= 1_000:  # about 3 KB each
            self.seen.clear()
        new = {k: t for k, t in zip(keys, texts, strict=True) if k not in self.seen}
        found = (self.nearest_many(self.vectors([*new.values()][i : i + QUERIES])) for i in range(0, len(new), QUERIES))
        for key, near in zip(new, chain.from_iterable(found), strict=True):
            # closeness 1 / (1.05 - cosine); the base rate votes like a fifth of one distant neighbour
            top, total = 0.2 * self.base, 0.2
            for c, i in near:
                v = self.votes[i] / (1.05 - min(c, 1.0))
                top, total = top + v * self.labels[i], total + v
            self.seen[key] = (float(min(1.0, max(0.0, top / total))), near)
        return [self.seen[k] for k in keys]


def term_weights(df: np.ndarray, df1: np.ndarray, n: int, n1: int) -> np.ndarray:
    """Weights of terms in ``df`` of ``n`` examples, ``df1`` of them among the ``n1`` of label 1: the
    inverse document frequency times a factor, which is FLOOR, and more by what the log odds ratio
    of the labels exceeds CHANCE standard errors, to the power POWER."""
    a, b, n0 = df1, df - df1, n - n1
    odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
    error = np.sqrt(1 / (a + 0.5) + 1 / (n1 - a + 0.5) + 1 / (b + 0.5) + 1 / (n0 - b + 0.5))
    return np.log((1 + n) / (1 + df) + 1e-9) * (FLOOR + np.maximum(0, np.abs(odds) - CHANCE * error)) ** POWER


def fit(rows: list[tuple], totals: dict[int, int], k: int = 15) -> Index:
    """``rows``: (id, label, text) of the sample; ``totals``: labelled rows per label in all.

    Texts that repeat count once (the row first in order stays). Without rows every score is the
    share of label 1 (0 without any).
    """
    unique: dict[str, tuple] = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        words = Counter(WORD.findall((r[2] or "").lower()))
        unique.setdefault(" ".join(f"{w}:{c}" for w, c in sorted(words.items())), (r[1], words.most_common(1)[0][0] if words else "", *r))
    # the most frequent word, as a rule of a language, brings texts of one kind into one block
    rows = [r[2:] for r in sorted(unique.values(), key=lambda r: (r[0], r[1], str(r[2])))]
    y = np.array([r[1] for r in rows], int)
    n, n1 = len(rows), int(y.sum())
    labelled = sum(totals.values())
    base = totals.get(1, 0) / labelled if labelled else 0.0
    terms: dict[str, int] = {}
    cols, counts = [], []
    for r in rows:  # one bag of terms at a time
        bag = terms_of(r[2])
        cols.append(np.fromiter((terms.setdefault(t, len(terms)) for t in bag), np.int32, len(bag)))
        counts.append(np.fromiter(bag.values(), np.float32, len(bag)))
    row = np.repeat(np.arange(n, dtype=np.int32), [len(c) for c in cols])
    col = np.concatenate([np.empty(0, np.int32), *cols])
    tf = np.concatenate([np.empty(0, np.float32), *counts])
    df = np.bincount(col, minlength=len(terms)).astype(float)
    order = np.argsort(-df, kind="stable")
    df, place = df[order], np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    col, terms = place[col], {t: int(place[i]) for t, i in terms.items()}
    weight = term_weights(np.append(df, 0), np.append(np.bincount(col, y[row], len(terms)), 0), n, n1) if n else np.zeros(1)
    values = (1 + np.log(tf)) * weight[col]
    size = np.sqrt(np.bincount(row, values**2, n))
    values = (values / np.where(size > 0, size, 1)[row]).astype(np.float32)
    often, blocks = int((df * FREQUENT > n).sum()), -(-n // BLOCK)
    heavy = col < often
    frequent = np.zeros((blocks, often, BLOCK), np.float32)
    frequent[row[heavy] // BLOCK, col[heavy], row[heavy] % BLOCK] = values[heavy]
    col, row, values = col[~heavy] - often, row[~heavy], values[~heavy]
    order = np.argsort(col, kind="stable")
    starts = np.searchsorted(col[order], np.arange(len(terms) - often + 1))
    share = {1: base / max(n1, 1), 0: (1 - base) / max(n - n1, 1)}
    scale = 1 / max(share.values()) if n else 1.0
    return Index(
        terms, weight, starts, row[order], values[order], frequent, frequent.max(axis=2).T.copy(),
        y, [r[0] for r in rows], np.array([share[int(i)] * scale for i in y]), base, k,
    )


def labelled_ids(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", doc_id: str = "doc_id", held_out: Column | None = None) -> DataFrame:
    """(id, label, chars) of documents with a label 0 or 1 that aren't held out. A document
    labelled twice has the larger label; rows without an id have none."""
    marks = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max(label).cast("int").alias("label"))
    own = docs.select(F.col(doc_id).alias("id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("chars"), (held_out if held_out is not None else F.lit(False)).alias("held"))
    return own.where("not held").join(marks, "id").select("id", "label", "chars")


def sample_and_fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", doc_id: str = "doc_id", held_out: Column | None = None, examples: int = 1500, most_chars: int = 10_000, **options) -> Index:
    """Fit on at most about ``examples`` rows for each label, drawn by a hash of the id among the
    labelled rows of at most ``most_chars`` characters. Both bounds hold at any input size; the base
    rate counts all labelled rows. Only ids and lengths are joined to the labels; texts are read for
    the drawn rows alone."""
    marked = cut(labelled_ids(docs, labels, label, text, doc_id, held_out))
    counted = marked.groupBy("label").agg(F.count("*").alias("n"), F.count(F.when(F.col("chars") <= most_chars, 1)).alias("short")).collect()
    totals, short = {r.label: r.n for r in counted}, {r.label: r.short for r in counted}
    if not totals:
        return fit([], totals, **options)
    at = F.pmod(F.xxhash64("id", F.lit(61)), F.lit(1 << 40)) / float(1 << 40)
    limit = F.when(F.col("label") == 1, min(1.0, examples / max(short.get(1, 0), 1))).otherwise(min(1.0, examples / max(short.get(0, 0), 1)))
    ids = F.broadcast(marked.where((F.col("chars") <= most_chars) & (at <= limit)).select("id", "label").distinct())  # about 2 * examples rows
    body = F.coalesce(F.col(text), F.lit(""))
    drawn = docs.select(F.col(doc_id).alias("id"), body.alias("text")).where(F.length("text") <= most_chars).join(ids, "id").select("id", "label", "text").distinct().toArrow()
    return fit(list(zip(*(drawn.column(c).to_pylist() for c in ("id", "label", "text")), strict=True)), totals, **options)


def toxicity_scores(docs: DataFrame, index: Index, text: str = "text", evidence: int = 3, keep: list[str] | None = None, spare: bool = False) -> DataFrame:
    """``docs`` (or its columns ``keep``) with score (0 to 1), predicted (1 if the score is 0.5 or more) and evidence (the
    ids of the nearest examples, as text). These take the place of columns of those names.

    Texts without any term that an example has, null and empty ones too, get the share of label 1
    among the labelled rows. Whole texts count, whatever their length; rows that repeat score alike.
    With ``spare`` the workers first give back what earlier steps left in them.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by 2 * examples texts of most_chars characters
    kept = [c for c in docs.columns if c not in ("score", "predicted", "evidence") and (keep is None or c in keep)]
    # the text goes to the workers once, and back only where it is kept
    sent = docs.select(*kept) if text in kept else docs.select(*kept, docs[text].alias("__text"))
    at = kept.index(text) if text in kept else len(kept)

    def run(batches):
        if spare:
            lean()
        model = shared.value
        for whole in batches:
            for b in slices(whole):
                found = model.scores(b.columns[at].to_pylist())
                scores = pa.array([s for s, _ in found], pa.float64())
                said = pa.array([int(s >= 0.5) for s, _ in found], pa.int32())
                why = pa.array([[str(model.ids[i]) for _, i in near[:evidence]] for _, near in found], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], scores, said, why], [*kept, "score", "predicted", "evidence"])

    schema = StructType([docs.schema[c] for c in kept]).add("score", DoubleType()).add("predicted", IntegerType()).add("evidence", ArrayType(StringType()))
    return sent.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose predicted label is 0, columns as they are."""
    index = sample_and_fit(docs, labels, held_out=F.coalesce(remainder(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1], F.lit(False)))
    named = docs.select([F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns])
    return toxicity_scores(named, index, "in_text", spare=True).where("predicted = 0").select([F.col(f"`in_{c}`").alias(c) for c in docs.columns])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(remainder(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    index = sample_and_fit(docs, labels, held_out=held)
    return toxicity_scores(docs.select("doc_id", held.alias("held_out"), "text"), index, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted", "evidence")
