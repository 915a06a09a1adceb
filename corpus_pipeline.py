"""A corpus pipeline: five operators in a row, each over all that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm.bpe import bpe_encode, vocabulary
from weftline.llm.common import table
from weftline.llm.exact_dedup import exact_dedup
from weftline.llm.mixing import mix
from weftline.llm.shingle_dedup import shingle_dedup
from weftline.llm.toxicity import drop_toxic
from weftline.session import cut, prepare


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    prepare(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row with the largest id stays."""
    prepare(spark)
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a five-word shingle similarity of 0.8 or more, the one with the least id stays."""
    prepare(spark)
    return shingle_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that sources, languages and topics meet their target weights."""
    prepare(spark)
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document left."""
    prepare(spark)
    return bpe_encode(docs, vocabulary()).select("doc_id", "lang", "source", "ids")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("simhash_near_dedup", near), ("mixing", mixing), ("bpe_encoding", encoding)]

#: SQL expresses neither the neighbours' votes nor the raking.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are written to the checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = cut(docs)
    return docs
