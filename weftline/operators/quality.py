"""Validation rules, all of them in one pass, and the cleaning they ask for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weftline.functions import fixed_values as V


@dataclass(frozen=True)
class Rule:
    """``bad`` is true for a row that breaks the rule; nulls break the null rule only. ``holds`` is
    set for rules on the schema."""

    name: str
    column: str
    bad: Column | None = None
    holds: bool | None = None


def rules(df: DataFrame, required: list[str] | None = None) -> list[Rule]:
    """The suite's rules on rows and schema, in order (row count and uniqueness are aggregates)."""
    out: list[Rule] = []
    kinds = {f.name: f.dataType for f in df.schema}
    for c in required or V.REQUIRED:
        out.append(Rule("column_exists", c, holds=c in kinds))
        if c in kinds:
            out.append(Rule("not_null", c, F.col(c).isNull()))
            out.append(Rule("is_string", c, holds=isinstance(kinds[c], StringType)))
    c = F.col
    if "raw_name" in kinds:
        out.append(Rule("length_between", "raw_name", ~F.length("raw_name").between(*V.NAME_LENGTH)))
    if "email" in kinds:
        out.append(Rule("matches_pattern", "email", ~c("email").rlike(V.EMAIL_RULE)))
    if "phone" in kinds:
        out.append(Rule("matches_pattern", "phone", ~c("phone").rlike(V.PHONE_RULE)))
    if "source" in kinds:
        out.append(Rule("in_set", "source", ~c("source").isin(V.SOURCES)))
    return out


def validation_report(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """One row per rule: rule, column, evaluated, unexpected, success. The table is read once, but
    for uniqueness, which groups by provider_id."""
    checks = rules(df, required)
    counts = [F.count("*").alias("n")] + [F.count_if(r.bad).alias(f"r{i}") for i, r in enumerate(checks) if r.bad is not None]
    totals = df.agg(*counts)
    low, high = V.TABLE_ROWS
    entries = [F.struct(F.lit("row_count_between").alias("rule"), F.lit("").alias("column"), F.col("n").alias("evaluated"), F.when(F.col("n").between(low, high), 0).otherwise(1).cast("long").alias("unexpected"))]
    for i, r in enumerate(checks):
        bad = F.col(f"r{i}") if r.bad is not None else F.lit(0 if r.holds else 1).cast("long")
        entries.append(F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"), F.col("n").alias("evaluated"), bad.alias("unexpected")))
    report = totals.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    if "provider_id" in df.columns:
        per_id = df.where("provider_id is not null").groupBy("provider_id").agg(F.count("*").alias("k"))
        unique = per_id.agg(F.lit("unique").alias("rule"), F.lit("provider_id").alias("column"), F.coalesce(F.sum("k"), F.lit(0)).alias("evaluated"), F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k"))), F.lit(0)).alias("unexpected"))
        report = report.unionByName(unique)
    return report.withColumn("success", F.col("unexpected") == 0)


def validation_summary(report: DataFrame) -> DataFrame:
    """One row: success, total, passed, failed, success_rate (percent; 0 without rules), failures."""
    return report.agg(
        F.coalesce(F.every("success"), F.lit(True)).alias("success"), F.count("*").alias("total"), F.count_if(F.col("success")).alias("passed"), F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.try_divide(F.count_if(F.col("success")) * 100.0, F.count("*")), F.lit(0.0)).alias("success_rate"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("success"), F.concat_ws(":", "rule", "column")))), ",").alias("failures"),
    )


def clean(df: DataFrame, required: list[str] | None = None, order: str = "record_id") -> DataFrame:
    """Without rows that lack a required value, and with the first row, by ``order``, of each
    provider_id. Rows that break other rules stay."""
    present = [c for c in required or V.REQUIRED if c in df.columns]
    kept = df.dropna(subset=present) if present else df
    if "provider_id" not in df.columns:
        return kept
    if order not in df.columns:
        return kept.dropDuplicates(["provider_id"])
    first = Window.partitionBy("provider_id").orderBy(order)
    return kept.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def validate(df: DataFrame, required: list[str] | None = None, order: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """(records, report): the records as given if every rule holds, else cleaned."""
    report = validation_report(df, required)
    return (df if report.where(~F.col("success")).isEmpty() else clean(df, required, order)), report
