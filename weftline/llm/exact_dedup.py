"""Exact dedup: a tree-merge of sorted digest runs.

Texts are read once: each row's digests are written down. The digest rows are dealt into runs by a
hash of the row; a run is sorted by digest and holds one entry per digest. In each round the runs
that meet (``fan_in`` of them, four binomial rounds at once) are exchanged by digest, brought into
one order and merged as a stream into one sorted run, keeping the identifier that stays and the
group's size, until one entry per digest is left. The result travels down the same tree to every
row, so a digest shared by a third of all rows never meets in one task.

Entries merge only if the SHA-256 digest, the byte length of the normalised text and an
independent 64-bit hash all agree: the three are the key at every level, so texts that differ in
one of them stay apart, each group with an identifier of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import ascii_lower, table, without
from weftline.operators.skew import deal, with_totals
from weftline.session import cut

FAN_IN, LEAST_RUNS = 16, 256


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, verified.

    ``keep`` is "largest" or "smallest" identifier. Null texts equal the empty text. Null ids
    stay only if a group has no other; rows that repeat both text and id are kept alike, as one
    document. An empty table gives an empty result; further input columns are ignored. verified
    is true where the entry that reached the row was merged under the row's own three hashes.
    """
    return _found(docs, text, doc_id, keep).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), F.expr("verified"))


def _found(docs: DataFrame, text: str, doc_id: str, keep: str) -> DataFrame:
    pick = {"largest": F.max, "smallest": F.min}[keep]
    norm = docs.select(F.col(doc_id).alias("doc_id"), ascii_lower(F.col(text)).alias("norm"))
    rows = cut(norm.select("doc_id", F.unhex(F.sha2("norm", 256)).alias("digest"), F.octet_length("norm").alias("bytes"), F.xxhash64("norm").alias("again")))
    keys = ["digest", "bytes", "again"]
    dealt = deal(rows, keys, F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(9)), FAN_IN, LEAST_RUNS)
    # an entry is a struct, whose state has no fixed width: sorted runs are merged as streams
    entry = pick(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.col("again").alias("seen"))))
    found = with_totals(dealt, keys, {"entry": (entry, pick), "group_size": (F.count("*"), F.sum)}, FAN_IN, LEAST_RUNS, in_order=True)
    return found.select("doc_id", *keys, F.col("entry.doc_id").alias("keep_id"), "group_size", (F.col("entry").isNull() | (F.col("entry.seen") == F.col("again"))).alias("verified"))


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are. Rows with a null id stay only
    if no row with an id has their text; of rows alike in text and id, all stay, and so does
    every row that isn't verified."""
    gone = _found(docs, text, doc_id, keep).where("verified and not doc_id <=> keep_id").select(F.col("doc_id").alias("__gone"), F.col("again").alias("__again")).distinct()
    return without(docs, gone, [docs[doc_id].eqNullSafe(gone["__gone"]), F.xxhash64(ascii_lower(docs[text])) == gone["__again"]])


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP9_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.norm) AS text_sha256, true AS verified
FROM n JOIN g ON n.norm = g.norm
"""
