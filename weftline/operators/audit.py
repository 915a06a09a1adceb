"""The audit queue, its decisions, and the statistics over them. Tables are DataFrames in, DataFrames
out; writing them is the caller's. Recent periods end at ``asof`` or at the latest row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.config import Thresholds


def merged() -> Column:
    """The decision is to merge."""
    return F.col("decision") == "MERGE"


def pair_id() -> Column:
    return F.concat_ws("_", "record_id_1", "record_id_2")


def audit_candidates(hybrid: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    return hybrid.where((F.col("hybrid_score") >= t.audit_low) & (F.col("hybrid_score") < t.audit_high))


def audit_sample(hybrid: DataFrame, rate: float = 0.07) -> DataFrame:
    """A share of the pairs, the same ones each time: those whose pair's hash is below the rate."""
    return hybrid.where(F.pmod(F.xxhash64(pair_id()), F.lit(10_000)) < round(rate * 10_000))


def enqueue(queue: DataFrame | None, pairs: DataFrame, added: datetime, priority: int = 0) -> DataFrame:
    """The queue with the pairs that it doesn't hold yet, pending."""
    new = pairs.withColumn("pair_id", pair_id()).dropDuplicates(["pair_id"]).select(
        "pair_id", "record_id_1", "record_id_2", "hybrid_score", "deterministic_score", "ml_probability", "block_key", "strategy",
        F.lit(added).cast("timestamp_ntz").alias("added_date"), F.lit("pending").alias("status"), F.lit(priority).alias("priority"), F.lit(None).cast("double").alias("processing_time"),
    )
    return new if queue is None else queue.unionByName(new.join(queue.select("pair_id"), "pair_id", "left_anti"))


def record_decisions(queue: DataFrame, log: DataFrame | None, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queue, log) after decisions (pair_id, decision, reviewer, comment, timestamp,
    processing_time) on queued pairs: the latest one of each pair stands in the log, and the pair
    is reviewed. Decisions on pairs that aren't queued, or other than MERGE and REJECT, go."""
    sound = decisions.where(F.col("decision").isin("MERGE", "REJECT"))
    known = queue.select("pair_id", "record_id_1", "record_id_2", "hybrid_score", "deterministic_score", "ml_probability")
    new = sound.join(known, "pair_id").select("pair_id", "record_id_1", "record_id_2", "decision", "comment", "reviewer", "timestamp", "hybrid_score", "deterministic_score", "ml_probability", "processing_time")
    rows = (new if log is None else log.unionByName(new)).withColumn("__n", F.row_number().over(Window.partitionBy("pair_id").orderBy(F.desc("timestamp"), "reviewer", "decision")))
    done = new.groupBy("pair_id").agg(F.max_by("processing_time", "timestamp").alias("__time"))
    marked = queue.join(done.withColumn("__done", F.lit(True)), "pair_id", "left")
    marked = marked.withColumn("status", F.when(F.col("__done"), "reviewed").otherwise(F.col("status"))).withColumn("processing_time", F.coalesce("__time", "processing_time"))
    return marked.select(queue.columns), rows.where("__n = 1").drop("__n")


def pending(queue: DataFrame, status: str = "pending", limit: int = 50) -> DataFrame:
    """The first of the queue: by priority, then by date."""
    return queue.where(F.col("status") == status).orderBy(F.desc("priority"), "added_date", "pair_id").limit(limit)


def decisions_between(log: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    out = log
    if start is not None:
        out = out.where(F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out.where(F.col("timestamp") <= F.lit(end).cast("timestamp_ntz"))
    return out.orderBy(F.desc("timestamp"))


def training_data(log: DataFrame, least: int = 100) -> DataFrame:
    """Labelled pairs from the decisions; none if there are fewer than ``least``."""
    enough = log.limit(least).count() >= least
    rows = log if enough else log.limit(0)
    return rows.select(
        "pair_id", "record_id_1", "record_id_2", F.when(merged(), 1).otherwise(0).alias("label"), "hybrid_score", "deterministic_score", "ml_probability", "reviewer", "timestamp",
        (F.col("hybrid_score") - F.col("deterministic_score")).alias("score_diff"), (F.col("hybrid_score") >= 0.9).cast("int").alias("high_confidence"), (F.col("hybrid_score") <= 0.1).cast("int").alias("low_confidence"),
    )


def review_export(log: DataFrame) -> DataFrame:
    """All decisions with their labels, oldest first."""
    return log.select("pair_id", "record_id_1", "record_id_2", F.when(merged(), 1).otherwise(0).alias("label"), "hybrid_score", "deterministic_score", "ml_probability", "comment", "reviewer", "timestamp").orderBy("timestamp", "pair_id")


def export_decisions(log: DataFrame, folder: str, at: datetime) -> str:
    """Writes all decisions as CSV, latest first, to a folder named after the time; gives its path."""
    path = f"{folder}/audit_export_{at:%Y%m%d_%H%M%S}.csv"
    decisions_between(log).write.mode("overwrite").option("header", True).csv(path)
    return path


def recent(log: DataFrame, days: int = 30, asof: datetime | None = None) -> DataFrame:
    """The rows of the last ``days`` days up to ``asof``, or up to the latest row."""
    if asof is None:
        asof = log.agg(F.max("timestamp")).first()[0]
    return log.where(F.col("timestamp") >= F.lit(asof).cast("timestamp_ntz") - F.expr(f"interval {int(days)} days")) if asof is not None else log.limit(0)


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


def audit_metrics(log: DataFrame) -> DataFrame:
    """One row: reviews, merges, rejects, and the share of merges."""
    return log.agg(F.count("*").alias("total_reviews"), F.count_if(merged()).alias("merge_count"), F.count_if(F.col("decision") == "REJECT").alias("reject_count"), F.coalesce(F.try_divide(F.count_if(merged()).cast("double"), F.count("*")), F.lit(0.0)).alias("merge_rate"))


def queue_stats(queue: DataFrame) -> DataFrame:
    return queue.agg(F.count("*").alias("total_queue"), F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(F.col("status") == "reviewed").alias("reviewed"))


def reviewer_performance(log: DataFrame) -> DataFrame:
    return log.groupBy("reviewer").agg(F.count("*").alias("reviews_completed"), F.avg("processing_time").alias("avg_processing_time"), share(F.count_if(merged()), F.count("*")).alias("merge_rate"), F.min("timestamp").alias("first_review"), F.max("timestamp").alias("last_review"))


def review_statistics(log: DataFrame) -> DataFrame:
    """By day and decision: reviews, average time, share of merges among the group."""
    return log.groupBy(F.to_date("timestamp").alias("review_date"), "decision").agg(F.count("*").alias("review_count"), F.avg("processing_time").alias("avg_processing_time"), share(F.count_if(merged()), F.count("*")).alias("merge_rate"))


def decision_shares(log: DataFrame) -> DataFrame:
    """Counts and percentages of decisions; the total is a window over the few groups."""
    n = log.groupBy("decision").agg(F.count("*").alias("n"))
    return n.withColumn("percentage", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def daily_activity(log: DataFrame, limit: int | None = None) -> DataFrame:
    days = log.groupBy(F.to_date("timestamp").alias("date")).agg(F.count("*").alias("reviews_completed"))
    return days.orderBy(F.desc("date")).limit(limit) if limit else days


def should_retrain(log: DataFrame, retrainings: DataFrame | None, threshold: int = 100) -> DataFrame:
    """One row: decisions since the last retraining, and whether they reach the threshold."""
    last = retrainings.agg(F.max("retraining_date")).first()[0] if retrainings is not None else None
    new = log if last is None else log.where(F.col("timestamp") > F.lit(last).cast("timestamp_ntz"))
    return new.agg(F.count("*").alias("new_decisions"), (F.count("*") >= threshold).alias("retrain"))


def model_performance_summary(performance: DataFrame) -> DataFrame:
    """Each evaluation with the precision, recall and F1 of the one before. Evaluations are few."""
    w = Window.orderBy("evaluation_date")
    return performance.select("model_version", "evaluation_date", "precision", "recall", "f1_score", "auc_score", *[F.lag(c).over(w).alias(f"prev_{p}") for c, p in (("precision", "precision"), ("recall", "recall"), ("f1_score", "f1"))])


def append_row(table: DataFrame | None, row: DataFrame) -> DataFrame:
    """A log (model performance, retraining) with one more row; columns by name."""
    return row if table is None else table.unionByName(row, allowMissingColumns=True)


def seed_config(table: DataFrame | None, row: DataFrame, key: str = "config_name") -> DataFrame:
    """The configuration table with the row, unless it has one of that name."""
    return row if table is None else table.unionByName(row.join(table.select(key), key, "left_anti").select(table.columns))


def create_views(log: DataFrame, queue: DataFrame, performance: DataFrame, days: int = 30) -> None:
    """Temporary views pending_reviews, review_statistics and model_performance_summary."""
    pending(queue, limit=2_147_483_647).createOrReplaceTempView("pending_reviews")
    review_statistics(recent(log, days)).createOrReplaceTempView("review_statistics")
    model_performance_summary(performance).createOrReplaceTempView("model_performance_summary")
