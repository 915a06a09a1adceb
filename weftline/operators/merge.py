"""Merging: components of matching pairs become canonical records with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.config import Merge
from weftline.functions.text import canonical_hash
from weftline.operators.components import connected_components

#: Text fields of which the longest value is the most complete; of others the first that isn't empty.
LONGEST_FIELDS = ("raw_name", "affiliation", "address", "norm_name", "norm_affiliation", "address_line_1_norm")
DROPPED = ("provider_id", "source", "record_id")


def groups(pairs: DataFrame, records: DataFrame, record_id: str = "record_id") -> DataFrame:
    """(record_id, component) of records that exist and that the pairs join."""
    found = connected_components(pairs, "record_id_1", "record_id_2").withColumnRenamed("node", record_id)
    return found.join(records.select(record_id), record_id, "left_semi")


def canonical_id(fields: tuple[str, ...], fallback: Column) -> Column:
    """The hash of the fields that aren't empty, trimmed and lower-cased; of the fallback without any."""
    joined = F.concat_ws("|", *[F.nullif(F.lower(F.trim(F.coalesce(F.col(f), F.lit("")))), F.lit("")) for f in fields])
    return canonical_hash(F.when(joined != "", joined).otherwise(F.concat(F.lit("record:"), fallback.cast("string"))))


def resolve(value: Column, order: Column, column: str, rules: Merge) -> Column:
    """An aggregate: one value of a field over a group's records in the order of ``order``."""
    v = F.coalesce(value.cast("string"), F.lit(""))
    longest = F.max_by(v, F.struct(F.length(v), -order))
    first = F.min_by(F.when(v != "", v), F.when(v != "", order))
    if rules.strategy == "longest":
        return F.coalesce(longest, F.lit(""))
    if rules.strategy == "most_recent":
        return F.coalesce(F.max_by(v, F.col(rules.recency)) if rules.recency else F.min_by(v, order), F.lit(""))
    return F.coalesce(longest if column in LONGEST_FIELDS else first, F.lit(""))


def merge_records(members: DataFrame, rules: Merge = Merge(), record_id: str = "record_id", component: str = "component") -> DataFrame:
    """One row per component: canonical_id, component, each field's resolved value, its distinct
    values (<field>_all) and their sources (<field>_sources) where they differ (null where not),
    merged_from, merge_count and original_sources. Array and map columns are left out."""
    fields = [c for c, t in members.dtypes if c not in (*DROPPED, component, record_id) and not t.startswith(("array", "map", "struct"))]
    order = F.col(record_id)
    aggs = [F.array_sort(F.collect_list(record_id)).alias("merged_from"), F.count("*").alias("merge_count")]
    source = F.col("source") if "source" in members.columns else F.lit(None).cast("string")
    aggs.append(F.array_sort(F.collect_set(source)).alias("original_sources"))
    aggs += [F.min_by(F.col(f), order).alias(f"__first_{f}") for f in rules.hash_fields if f in members.columns]
    for f in fields:
        v = F.col(f).cast("string")
        there = v.isNotNull() & (v != "")
        pairs = F.array_sort(F.collect_list(F.when(there, F.struct(order.alias("o"), v.alias("v"), source.alias("s")))))
        aggs += [resolve(F.col(f), order, f, rules).alias(f), pairs.alias(f"__{f}")]
    merged = members.groupBy(component).agg(*aggs)
    differ = lambda f: F.size(F.array_distinct(F.col(f"__{f}.v"))) > 1
    hashed = [f for f in rules.hash_fields if f in members.columns]
    named = merged.withColumn("canonical_id", canonical_id(tuple(f"__first_{f}" for f in hashed), F.col(component)))
    extra = [c for f in fields for c in (F.when(differ(f), F.array_distinct(F.col(f"__{f}.v"))).alias(f"{f}_all"), F.when(differ(f), F.array_distinct(F.col(f"__{f}.s"))).alias(f"{f}_sources"))]
    return named.select("canonical_id", component, *fields, *extra, "merged_from", "merge_count", "original_sources")


def merge_log(merged: DataFrame, component: str = "component") -> DataFrame:
    """merge_group_id (from 0, by component), canonical_id, merged_record_ids, merge_count and
    original_sources. Ids are numbered within ranges of components; only the ranges' counts are
    summed in one task."""
    parts = merged.select(F.col(component).alias("__c")).withColumn("__p", F.floor(F.col("__c") / 65536))
    sizes = parts.groupBy("__p").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    own = merged.withColumn("__p", F.floor(F.col(component) / 65536))
    numbered = own.join(before, "__p").withColumn("__row", F.row_number().over(Window.partitionBy("__p").orderBy(component)))
    return numbered.select((F.col("__before") + F.col("__row") - 1).cast("long").alias("merge_group_id"), "canonical_id", F.col("merged_from").alias("merged_record_ids"), "merge_count", "original_sources")


def merge_pairs(pairs: DataFrame, records: DataFrame, rules: Merge = Merge(), record_id: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """(canonical records, merge log) of the records that the pairs join."""
    members = records.join(groups(pairs, records, record_id), record_id)
    merged = merge_records(members, rules, record_id)
    return merged, merge_log(merged)


def apply_auto_merges(hybrid: DataFrame, records: DataFrame, rules: Merge = Merge(), record_id: str = "record_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(canonical records, unmerged records, merge log). Without automatic merges every record is
    unmerged and the others are empty."""
    return apply_merges(groups(hybrid.where("auto_merge").select("record_id_1", "record_id_2"), records, record_id), records, rules, record_id)


def apply_merges(member: DataFrame, records: DataFrame, rules: Merge = Merge(), record_id: str = "record_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``apply_auto_merges`` with the groups found already."""
    merged = merge_records(records.join(member, record_id), rules, record_id)
    return merged, records.join(member.select(record_id), record_id, "left_anti"), merge_log(merged)


def merge_stats(log: DataFrame, original_count: int) -> DataFrame:
    """One row of totals of a merge log."""
    n = F.lit(original_count)
    cut = F.coalesce(F.sum("merge_count"), F.lit(0)) - F.count("*")
    return log.agg(
        n.cast("long").alias("original_count"), (n - cut).cast("long").alias("merged_count"), cut.cast("long").alias("duplicate_reduction"), F.coalesce(F.try_divide(cut * 100.0, n), F.lit(0.0)).alias("duplicate_reduction_percentage"),
        F.count("*").alias("merge_groups"), F.coalesce(F.avg("merge_count"), F.lit(0.0)).alias("avg_group_size"), F.coalesce(F.max("merge_count"), F.lit(0)).alias("max_group_size"),
    )


def group_sizes(log: DataFrame) -> DataFrame:
    return log.groupBy("merge_count").agg(F.count("*").alias("n"))


def rollback(merged: DataFrame, unmerged: DataFrame, records: DataFrame, canonical: str, record_id: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """(canonical records, unmerged records) after the canonical record is taken back: it goes, and
    the records it was merged from stand among the unmerged again."""
    gone = merged.where(F.col("canonical_id") == canonical)
    back = records.join(gone.select(F.explode("merged_from").alias(record_id)), record_id, "left_semi")
    return merged.where(F.col("canonical_id") != canonical), unmerged.unionByName(back)
