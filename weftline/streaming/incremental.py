"""Incremental linkage: batches of new records meet the records already known."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.config import Blocking, Thresholds, Weights
from weftline.functions.normalize import normalize
from weftline.operators import blocking, scoring


def link_batch(new: DataFrame, known: DataFrame, rules: Blocking = Blocking(), weights: Weights = Weights(), thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Decisions on pairs of a new and a known record, or of two new ones. Both sides are
    normalised; record ids must differ between them."""
    both = known.withColumn("__new", F.lit(False)).unionByName(new.withColumn("__new", F.lit(True)), allowMissingColumns=True)
    pairs = blocking.candidate_pairs(blocking.block_keys(both, rules), rules)
    fresh = both.where("__new").select("record_id")
    some = pairs.join(fresh.withColumnRenamed("record_id", "record_id_1"), "record_id_1", "left_semi").unionByName(pairs.join(fresh.withColumnRenamed("record_id", "record_id_2"), "record_id_2", "left_semi")).distinct()
    return scoring.hybrid_scores(scoring.deterministic_scores(some, both, weights, thresholds, with_jaro=False), None, weights, thresholds)


def link_stream(stream: DataFrame, known: Callable[[], DataFrame], sink: Callable[[DataFrame, DataFrame, int], None], checkpoint: str, rules: Blocking = Blocking(), once: bool = True) -> StreamingQuery:
    """Starts a query that normalises each batch, links it to ``known()`` and hands records and
    decisions to ``sink(records, decisions, batch)``, which must write each batch number once."""

    def batch(df: DataFrame, number: int) -> None:
        records = normalize(df)
        sink(records, link_batch(records, known(), rules), number)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
