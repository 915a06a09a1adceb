"""Byte-level BPE encoding and decoding with a given vocabulary.

A text is cut into pretokens, a pretoken into byte symbols. The ranks of adjacent pairs stand
in the leaves of a segment tree whose root is the least (rank, position): the leftmost of the
lowest-ranked merges. A merge updates three leaves, each in logarithmic time, until the root
holds no mergeable pair. The trees of many pretokens are rows of one array and merge in step.
Pretokens repeat, so recent encodings are kept in tables of bounded size; they only save time.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from weftline.llm.common import HELD, table
from weftline.llm.common import slices as row_slices

#: The pattern that cuts text into pretokens, part of the byte-level scheme.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of a table of recent encodings, bytes of a row of trees, rows at once, characters at once.
KEPT, WIDEST, ROWS, PART = 120_000, 64, 20_000, 2_000_000
NONE = 1 << 62
MIX = 0x9E3779B97F4A7C15
#: White space other than the space, as the pretoken pattern has it.
SPACES = "\t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary: printable Latin-1
    letters stand for themselves, the rest for the code points from 256 on, in order."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Recent:
    """A table that forgets: once ``now`` holds ``size`` entries, those not asked for since the
    last time go. What ``missing`` has been asked for stays in ``now`` until ``age`` is called."""

    def __init__(self, size: int) -> None:
        self.size, self.now, self.old = size, {}, {}

    def missing(self, keys: set) -> set:
        """The keys that aren't known; the others are in ``now`` after this."""
        now, old = self.now, self.old
        rest = keys.difference(now)
        back = rest.intersection(old)
        for k in back:
            now[k] = old[k]
        return rest.difference(back)

    def age(self) -> None:
        if len(self.now) >= self.size:
            self.now, self.old = {}, self.now


class Codec:
    """Encodes and decodes with the vocabulary file at ``path`` (tokenizers' JSON form)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        to_byte = {c: b for b, c in enumerate(letters)}
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.byte_ids = [vocab[c] for c in letters]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.bytes_of = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.pretoken = regex.compile(PRETOKEN)
        # of tokens that begin alike, the longest
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.wide_special = [t for t in self.special if regex.search(r"\s", t)]
        self.strings = {i: str(i) for i in self.bytes_of}
        self.runs = re.compile(f"[{SPACES} ]*[^{SPACES} ]+|[{SPACES} ]+")
        # of ASCII text the pattern needs no Unicode classes
        self.ascii = re.compile(PRETOKEN.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+"), re.ASCII)
        self._hash_pairs()
        top = max(self.bytes_of) + 1
        self.blob = np.frombuffer(b"".join([self.bytes_of.get(i, b"") for i in range(top)]), np.uint8)
        self.starts = np.cumsum([0, *(len(self.bytes_of.get(i, b"")) for i in range(top))])
        self.known, self.pieces = Recent(KEPT), Recent(KEPT)

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pretoken."""
        pairs, ids = self.pairs, [self.byte_ids[b] for b in raw]
        n = len(ids)
        if n == 1:
            return ids
        shift = n.bit_length()
        low = (1 << shift) - 1
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [NONE] * (2 * size)
        made = [0] * n
        for i in range(n - 1):
            got = pairs.get((ids[i], ids[i + 1]))
            if got is not None:
                tree[size + i] = got[0] << shift | i
                made[i] = got[1]
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(at: int, key: int) -> None:
            at += size
            tree[at] = key
            at >>= 1
            while at:
                least = min(tree[2 * at], tree[2 * at + 1])
                if tree[at] == least:
                    break
                tree[at] = least
                at >>= 1

        def rank(a: int, b: int) -> int:
            got = pairs.get((ids[a], ids[b]))
            if got is None:
                return NONE
            made[a] = got[1]
            return got[0] << shift | a

        while tree[1] != NONE:
            i = tree[1] & low
            j = after[i]
            k = after[i] = after[j]
            ids[i], ids[j] = made[i], -1
            if j < n - 1:
                put(j, NONE)
            if k < n:
                before[k] = i
            put(i, rank(i, k) if k < n else NONE)
            if before[i] >= 0:
                put(before[i], rank(before[i], i))
        return [x for x in ids if x >= 0]

    def _hash_pairs(self) -> None:
        """Pairs by an open-addressed table: a slot's key, rank and merged id."""
        bits = max(4, (4 * len(self.pairs)).bit_length())
        self.shift = 64 - bits
        self.slot_keys = np.full((1 << bits) + 64, -1, np.int64)
        self.slot_ranks = np.full((1 << bits) + 64, NONE, np.int64)
        self.slot_ids = np.zeros((1 << bits) + 64, np.int64)
        self.probes = 1
        for (a, b), (rank, made) in self.pairs.items():
            key = a << 20 | b
            at = ((key * MIX) & (1 << 64) - 1) >> self.shift
            n = 1
            while self.slot_keys[at] >= 0:
                at, n = at + 1, n + 1
            self.slot_keys[at], self.slot_ranks[at], self.slot_ids[at] = key, rank, made
            self.probes = max(self.probes, n)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (NONE: not mergeable) and merged ids of pairs; ids below 0 pair with nothing."""
        keys = left << 20 | right
        at = ((keys.view(np.uint64) * np.uint64(MIX)) >> np.uint64(self.shift)).view(np.int64)
        found = self.slot_keys.take(at)
        for _ in range(1, self.probes):
            on = np.flatnonzero((found != keys) & (found >= 0))
            if not len(on):
                break
            at[on] += 1
            found[on] = self.slot_keys.take(at[on])
        return np.where(found == keys, self.slot_ranks.take(at), NONE), self.slot_ids.take(at)

    def merge_many(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """``merge`` of many pretokens at once: the segment trees of pretokens of like length are
        rows of one array, and every round merges at the root of each row that still has one."""
        out: list[tuple[int, ...]] = [()] * len(words)
        sizes: dict[int, list[int]] = {}
        for at, raw in enumerate(words):
            if len(raw) > WIDEST:
                out[at] = tuple(self.merge(raw))
            else:
                sizes.setdefault(1 << (len(raw) - 1).bit_length(), []).append(at)
        for size, members in sizes.items():
            for some in (members[i : i + ROWS] for i in range(0, len(members), ROWS)):
                ids = self._merge_rows([words[i] for i in some], size)
                live = ids >= 0
                flat, ends, start = ids[live].tolist(), np.cumsum(live.sum(axis=1)).tolist(), 0
                for at, end in zip(some, ends, strict=True):
                    out[at] = tuple(flat[start:end])
                    start = end
        return out

    def _merge_rows(self, words: list[bytes], size: int) -> np.ndarray:
        """Ids of pretokens of at most ``size`` bytes, a power of two; -1 where a symbol has gone."""
        n, column = np.array([len(w) for w in words]), np.arange(size)
        ids = np.array(self.byte_ids, np.int64)[np.frombuffer(b"".join([w.ljust(size, b"\0") for w in words]), np.uint8).reshape(-1, size)]
        ids[column >= n[:, None]] = -1
        if size == 1:
            return ids
        width = 2 * size
        tree = np.full((len(words), width), NONE, np.int64)
        made = np.zeros(ids.shape, np.int64)
        ranks, merged = self._look_up(np.ascontiguousarray(ids[:, :-1]).ravel(), np.ascontiguousarray(ids[:, 1:]).ravel())
        ranks, made[:, :-1] = ranks.reshape(-1, size - 1), merged.reshape(-1, size - 1)
        tree[:, size:-1] = np.where((ids[:, 1:] >= 0) & (ranks < NONE), ranks << 8 | column[:-1], NONE)
        level = size
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        after = np.where(column + 1 < n[:, None], column + 1, size).ravel()
        before = np.tile(column - 1, len(words))
        # flat from here: symbol p of row r stands at r * size + p, node q of its tree at r * width + q
        flat, made, tree = ids.ravel(), made.ravel(), tree.ravel()
        row = np.flatnonzero(tree[1::width] < NONE)
        while len(row):
            sym, node = row * size, row * width
            i = tree.take(node + 1) & 0xFF
            at_i = sym + i
            j, new, h = after.take(at_i), made.take(at_i), before.take(at_i)
            at_j = sym + j
            k = after.take(at_j)
            flat[at_i], flat[at_j], after[at_i] = new, -1, k
            right, left = np.flatnonzero(k < size), np.flatnonzero(h >= 0)
            sym_r, i_r = sym[right], i[right]
            at_k = sym_r + k[right]
            before[at_k] = i_r
            tree[node + size + j] = NONE
            tree[node + size + i] = NONE
            rank, made[sym_r + i_r] = self._look_up(new[right], flat.take(at_k))
            tree[node[right] + size + i_r] = np.where(rank < NONE, rank << 8 | i_r, NONE)
            h_l = h[left]
            at_h, node_l = sym[left] + h_l, node[left]
            rank, made[at_h] = self._look_up(flat.take(at_h), new[left])
            tree[node_l + size + h_l] = np.where(rank < NONE, rank << 8 | h_l, NONE)
            for base, leaf in ((node, j), (node, i), (node_l, h_l)):
                q, level = size + leaf, size
                while level > 1:
                    q, level = q >> 1, level // 2
                    below = base + 2 * q
                    tree[base + q] = np.minimum(tree.take(below), tree.take(below + 1))
            row = row[tree.take(node + 1) < NONE]
        return ids

    def words(self, text: str) -> list[str]:
        """Pretokens and special tokens, in order; joined they are the text."""
        for t in self.special:
            if t in text:
                parts = self.split.split(text)
                return list(chain.from_iterable([part] if part in self.special else self.pretoken.findall(part) for part in parts))
        return self.ascii.findall(text) if text.isascii() else self.pretoken.findall(text)

    def chunks(self, text: str) -> list[str]:
        """The text in parts that can be encoded apart: a run of white space and what follows it.
        No pretoken, and no special token but one with white space inside, has white space after
        another character."""
        for t in self.wide_special:
            if t in text:
                return [text]
        if "  " in text or any([" " + c in text or c + " " in text for c in SPACES if c in text]):
            return self.runs.findall(text)
        head, *rest = text.split(" ")
        rest = [" " + x for x in rest]
        return [head, *rest] if head else rest

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks that aren't known."""
        new_chunks, pieces = self.known.missing(chunks), self.pieces
        cut = {c: self.words(c) for c in new_chunks}
        new = [*pieces.missing(set(chain.from_iterable(cut.values())))]
        plain = [w for w in new if w not in self.special]
        ids = dict(zip(plain, self.merge_many([w.encode("utf-8") for w in plain]), strict=True)) | {t: (i,) for t, i in self.special.items()}
        strings, known, pieces = self.strings, self.known.now, pieces.now
        for w in new:
            pieces[w] = ",".join([strings[i] for i in ids[w]])
        for c, ws in cut.items():
            known[c] = pieces[ws[0]] if len(ws) == 1 else ",".join([pieces[w] for w in ws])

    def encode_many(self, texts: list[str]) -> list[str]:
        """For each text its ids in decimal, joined by commas."""
        parts = [self.chunks(t) for t in texts]
        self.learn(set(chain.from_iterable(parts)))
        look = self.known.now.__getitem__
        out = [",".join(map(look, cs)) for cs in parts]
        self.known.age()
        self.pieces.age()
        return out

    def encode(self, text: str) -> list[int]:
        return numbers(self.encode_many([text])[0]).tolist()

    def decode(self, ids) -> str:
        """Ids that the vocabulary lacks are skipped; broken UTF-8 becomes U+FFFD."""
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.starts) - 1)]
        begin, size = self.starts[ids], self.starts[ids + 1] - self.starts[ids]
        total = int(size.sum())
        at = np.arange(total) + np.repeat(begin - (np.cumsum(size) - size), size)
        return self.blob[at].tobytes().decode("utf-8", "replace")


def numbers(text: str) -> np.ndarray:
    """The ids of a string of decimal ids joined by commas."""
    return np.fromstring(text, np.int32, sep=",") if text else np.empty(0, np.int32)


def codec(path: str) -> Codec:
    """One codec per worker and path."""
    if path not in HELD:
        HELD[path] = Codec(path)
    return HELD[path]


def slices(texts: pa.Array, size: int = PART):
    """Lists of texts (null: empty) of about ``size`` characters, or of one text."""
    some, total = [], 0
    for t in texts:
        t = t.as_py() or ""
        some.append(t)
        total += len(t)
        if total >= size:
            yield some
            some, total = [], 0
    if some:
        yield some


def _replaced(batches, names: list[str], make):
    """The batches with what ``make`` makes of their last column in its place, in pieces, so that
    neither side holds the ids of a whole batch."""
    for whole in batches:
        for b in row_slices(whole):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], make(b.columns[-1])], names)


def _with(docs: DataFrame, source: str, out: str, kind, make) -> DataFrame:
    """``docs`` with a column ``out`` made from the column ``source`` in Python."""
    kept = [c for c in docs.columns if c != out]

    def run(batches):
        yield from _replaced(batches, [*kept, out], make)

    schema = StructType([docs.schema[c] for c in kept]).add(out, kind)
    return docs.select(*kept, docs[source].alias("__source")).mapInArrow(run, schema)


def bpe_encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` (null: empty) as the array column ``out``, which
    takes the place of a column of that name."""

    def make(texts):
        c = codec(path)
        ids = [numbers(found) for some in slices(texts) for found in c.encode_many(some)]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))

    return _with(docs, text, out, ArrayType(IntegerType()), make)


def bpe_decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``docs`` with the text of the token ids in ``ids`` (null: empty) as the column ``out``,
    which takes the place of a column of that name."""

    def make(arrays):
        c = codec(path)
        return pa.array([c.decode(a.as_py() or ()) for a in arrays], pa.string())

    return _with(docs, ids, out, StringType(), make)


def bpe_digests(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256 of the decimal ids joined by commas,
    decoded_sha256 of the text decoded from the ids, and round_trip (the two texts are equal).

    Null texts count as empty: no tokens, digests of nothing. Extra columns are ignored; rows
    that repeat repeat; an empty table gives an empty result. Texts may be of any length.
    """

    def run(batches):
        c, sha = codec(path), hashlib.sha256
        for b in batches:
            rows = []
            for some in slices(b.column("t")):
                for given, said in zip(some, c.encode_many(some), strict=True):
                    ids = numbers(said)
                    decoded = c.decode(ids)
                    rows.append((len(ids), sha(said.encode()).hexdigest(), sha(decoded.encode("utf-8")).hexdigest(), decoded == given))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The file of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), vocabulary())
