"""Pipeline metrics, what derives from them, and their export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators import audit


def latest_performance(performance: DataFrame, limit: int = 10) -> DataFrame:
    return performance.orderBy(F.desc("evaluation_date")).limit(limit)


def derived_metrics(queue: DataFrame, log: DataFrame, performance: DataFrame) -> DataFrame:
    """One row: completion_rate, merge_rate, reject_rate and the trends of the last two evaluations."""
    zero = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    done = queue.agg(zero(F.count_if(F.col("status") == "reviewed"), F.count("*")).alias("completion_rate"))
    rates = log.agg(zero(F.count_if(F.col("decision") == "MERGE"), F.count("*")).alias("merge_rate"), zero(F.count_if(F.col("decision") == "REJECT"), F.count("*")).alias("reject_rate"))
    two = performance.orderBy(F.desc("evaluation_date")).limit(2).withColumn("n", F.row_number().over(Window.orderBy(F.desc("evaluation_date"))))
    at = lambda c, n: F.max(F.when(F.col("n") == n, F.col(c)))
    trends = two.agg(*[F.coalesce(at(c, 1) - at(c, 2), F.lit(0.0)).alias(f"{name}_trend") for c, name in (("precision", "precision"), ("recall", "recall"), ("f1_score", "f1"))])
    return done.crossJoin(rates).crossJoin(trends)  # one row each


def processing_time_trend(log: DataFrame, last: int = 1000) -> DataFrame:
    """Daily mean of the processing times of the last reviews."""
    some = log.where("processing_time is not null").orderBy(F.desc("timestamp"), "pair_id").limit(last)
    return some.groupBy(F.to_date("timestamp").alias("date")).agg(F.avg("processing_time").alias("processing_time"))


def processing_time_histogram(log: DataFrame, bins: int = 50, last: int = 1000) -> DataFrame:
    """Counts by decision and equal-width bin (0 to ``bins`` - 1) of the last reviews' times."""
    some = log.where("processing_time is not null").orderBy(F.desc("timestamp"), "pair_id").limit(last)
    w = Window.partitionBy()  # over at most ``last`` rows
    low, high = F.min("processing_time").over(w), F.max("processing_time").over(w)
    bin_of = F.when(high > low, F.least(F.lit(bins - 1), F.floor((F.col("processing_time") - low) / (high - low) * bins).cast("int"))).otherwise(0)
    return some.withColumn("bin", bin_of).groupBy("decision", "bin").agg(F.count("*").alias("n"))


def system_health(tables: dict[str, DataFrame | None], spark: SparkSession) -> DataFrame:
    """Row counts by table; missing tables have 0."""
    rows = [spark.range(1).select(F.lit(n).alias("table"), F.lit(0).cast("long").alias("rows")) if t is None else t.agg(F.lit(n).alias("table"), F.count("*").alias("rows")) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def metrics_report(metrics: dict[str, DataFrame]) -> DataFrame:
    """(category, name, value) of one-row tables of numbers, in the order of their columns."""
    out = []
    for category, df in metrics.items():
        each = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in df.columns])
        out.append(df.select(F.lit(category).alias("category"), F.explode(each).alias("m")).select("category", "m.*"))
    return reduce(DataFrame.unionByName, out)


def export_report(report: DataFrame, path: str, kind: str = "csv") -> None:
    """CSV rows, or one JSON object of categories of names and values."""
    if kind == "csv":
        report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    elif kind == "json":
        per = report.groupBy("category").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("m"))
        per.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("category", "m")))).alias("value")).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unsupported format: {kind}")


def pipeline_metrics(queue: DataFrame, log: DataFrame, performance: DataFrame, days: int = 30) -> dict[str, DataFrame]:
    return {"audit_queue": audit.queue_stats(queue), "audit_decisions": audit.decision_shares(log), "model_performance": latest_performance(performance), "recent_activity": audit.daily_activity(audit.recent(log, days))}
