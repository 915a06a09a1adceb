"""Block keys and candidate pairs: equi self-joins on hashes of normalised fields."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from weftline.config import Blocking, Strategy
from weftline.functions.text import block_hash, text

FIELD = re.compile(r"^\s*(\w+)\s*(?:\[:(\d+)\])?\s*$")


def field(df: DataFrame, expression: str) -> Column:
    """``col`` or ``col[:n]`` as a string column, or an array column as it is."""
    m = FIELD.match(expression)
    if not m or m[1] not in df.columns:
        raise ValueError(f"not a field of the records: {expression!r}")
    if isinstance(df.schema[m[1]].dataType, ArrayType):
        return F.col(m[1])
    c = text(F.col(m[1]).cast("string"))
    return F.left(c, F.lit(int(m[2]))) if m[2] else c


def plain_key(df: DataFrame, keys: tuple[str, ...]) -> Column:
    """The hash of the fields that aren't empty, joined by bars; empty if all are."""
    joined = F.concat_ws("|", *[F.nullif(field(df, k), F.lit("")) for k in keys])
    return F.when(joined != "", block_hash(joined)).otherwise("")


def key_tokens(c: Column) -> Column:
    """Lower-cased words without other characters than letters and digits, of two or more."""
    return F.filter(F.transform(F.split(F.lower(c), r"(?U)\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]", "")), lambda w: F.length(w) >= 2)


def token_key(df: DataFrame, keys: tuple[str, ...], skip_arrays: bool = False) -> Column:
    """The hash of the first three, in order, of the fields' distinct words; empty without words."""
    fields = [(k, isinstance(df.schema[k.split("[")[0].strip()].dataType, ArrayType)) for k in keys]
    lists = [key_tokens(F.array_join(field(df, k), " ") if many else field(df, k)) for k, many in fields if not (many and skip_arrays)]
    if not lists:
        return F.lit("")
    first = F.slice(F.array_sort(F.array_distinct(F.concat(*lists))), 1, 3)
    return F.when(F.size(first) > 0, block_hash(F.array_join(first, "_"))).otherwise("")


def block_keys(df: DataFrame, blocking: Blocking = Blocking()) -> DataFrame:
    """The records with a block_<strategy> column for each strategy."""
    make = lambda s: token_key(df, s.keys, blocking.skip_arrays) if s.tokens else plain_key(df, s.keys)
    return df.withColumns({f"block_{s.name}": make(s) for s in blocking.strategies})


def long_keys(blocked: DataFrame, strategies: tuple[Strategy, ...], record_id: str = "record_id") -> DataFrame:
    """(record_id, ord, strategy, block_key) for each key that isn't empty."""
    each = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(s.name).alias("strategy"), F.col(f"block_{s.name}").alias("block_key")) for i, s in enumerate(strategies)])
    return blocked.select(F.col(record_id).alias("record_id"), F.explode(each).alias("k")).select("record_id", "k.*").where("block_key <> ''")


#: Pairs of a task, about, as far as there are few enough tasks.
TASK_PAIRS = 100_000


def fitting_sizes(keys: DataFrame, blocking: Blocking) -> DataFrame:
    """(ord, block_key, n) of the blocks that are paired, from ``long_keys``."""
    sizes = keys.groupBy("ord", "block_key").agg(F.count("*").alias("n")).where("n >= 2")
    return sizes if blocking.most_per_block is None else sizes.where(F.col("n") <= blocking.most_per_block)


def fitting_keys(blocked: DataFrame, blocking: Blocking = Blocking(), record_id: str = "record_id") -> DataFrame:
    """(record_id, __keys_0, __keys_1, ...): for each strategy the record's keys of blocks of two to
    ``most_per_block`` records (any number if that is None). Rows of one id are one record."""
    keys = long_keys(blocked, blocking.strategies, record_id)
    fit = keys.join(fitting_sizes(keys, blocking).drop("n"), ["ord", "block_key"])
    return fit.groupBy("record_id").agg(*[F.array_sort(F.collect_set(F.when(F.col("ord") == i, F.col("block_key")))).alias(f"__keys_{i}") for i in range(len(blocking.strategies))])


def in_blocks(blocked: DataFrame, blocking: Blocking = Blocking(), columns: Sequence[Column] = (), record_id: str = "record_id") -> DataFrame:
    """A row for each record and key of ``fitting_keys``: these, ord, block_key and the columns."""
    per = fitting_keys(blocked, blocking, record_id)
    if columns:
        per = per.join(blocked.select(F.col(record_id).alias("record_id"), *columns), "record_id")
    at = lambda i: F.transform(f"__keys_{i}", lambda k: F.struct(F.lit(i).alias("ord"), k.alias("block_key")))
    each = F.concat(*[at(i) for i in range(len(blocking.strategies))])
    return per.select("*", F.explode(each).alias("__k")).select("*", "__k.ord", "__k.block_key").drop("__k")


def _shared(a: Column, b: Column) -> Column:
    """The arrays, of one element mostly, have an element in common."""
    single = (F.size(a) <= 1) & (F.size(b) <= 1)
    return F.coalesce(F.when(single, F.get(a, F.lit(0)) == F.get(b, F.lit(0))).otherwise(F.arrays_overlap(a, b)), F.lit(False))


def paired(blocked: DataFrame, blocking: Blocking = Blocking(), columns: Sequence[Column] = (), record_id: str = "record_id") -> DataFrame:
    """``candidate_pairs`` with both records' columns, as <column>_1 and <column>_2.

    Records are sent to their blocks with their columns and with their keys of every strategy, so a
    pair is made and told from those of earlier strategies in one place: pairs themselves are never
    sent. Spark would choose the number of tasks by the rows sent, few for the pairs that come of
    them, so it is chosen here by the sizes of the blocks, which are counted first.
    """
    made = fitting_sizes(long_keys(blocked, blocking.strategies, record_id), blocking).agg(F.sum(F.expr("n * (n - 1) div 2"))).first()[0] or 0
    most = 4 * int(blocked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_blocks(blocked, blocking, columns, record_id).repartition(min(most, made // TASK_PAIRS + 1), "ord", "block_key")
    own = [c for c in rows.columns if c not in ("ord", "block_key")]
    side = lambda n: rows.select("ord", "block_key", *[F.col(c).alias(f"{c}_{n}") for c in own])
    met = side(1).join(side(2), ["ord", "block_key"]).where("record_id_1 < record_id_2")
    for i in range(len(blocking.strategies)):
        a, b = F.col(f"__keys_{i}_1"), F.col(f"__keys_{i}_2")
        if i < len(blocking.strategies) - 1:  # pairs of an earlier strategy
            met = met.where((F.col("ord") <= i) | ~_shared(a, b))
        # two blocks of one strategy, if an id has rows with different keys
        met = met.where((F.col("ord") != i) | (F.size(a) < 2) | (F.size(b) < 2) | (F.array_min(F.array_intersect(a, b)) == F.col("block_key")))
    name = F.element_at(F.array(*[F.lit(s.name) for s in blocking.strategies]), F.col("ord") + 1)
    return met.select("record_id_1", "record_id_2", "block_key", name.alias("strategy"), *[f"{c}_{n}" for n in (1, 2) for c in own if c != "record_id" and not c.startswith("__keys_")])


def candidate_pairs(blocked: DataFrame, blocking: Blocking = Blocking(), record_id: str = "record_id") -> DataFrame:
    """(record_id_1, record_id_2, block_key, strategy): every two records that share a block of at
    most ``most_per_block`` records, once, under the first strategy that pairs them.

    Larger blocks are left out before the join, so a key's pairs are bounded and no key is hot.
    """
    return paired(blocked, blocking, record_id=record_id)


def count_pairs(blocked: DataFrame, blocking: Blocking = Blocking(), record_id: str = "record_id") -> DataFrame:
    """One row generated_candidates: the number of ``candidate_pairs``, by the sizes of the blocks and
    of what blocks of different strategies have in common, so no pair is made."""
    per = fitting_keys(blocked, blocking, record_id)
    every = range(len(blocking.strategies))
    if not per.where(reduce(or_, [F.size(f"__keys_{i}") > 1 for i in every])).isEmpty():
        return candidate_pairs(blocked, blocking, record_id).agg(F.count("*").alias("generated_candidates"))
    one = per.select(*[F.get(f"__keys_{i}", F.lit(0)).alias(f"k{i}") for i in every])
    pairs = F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0))
    terms = []
    for many in range(1, len(blocking.strategies) + 1):
        for some in combinations([f"k{i}" for i in every], many):
            terms.append(one.dropna(subset=list(some)).groupBy(*some).agg(F.count("*").alias("n")).agg((pairs * (-1) ** (many + 1)).alias("n")))
    return reduce(DataFrame.unionByName, terms).agg(F.sum("n").alias("generated_candidates"))


def blocking_stats(blocked: DataFrame, pairs: DataFrame | None, strategies: tuple[Strategy, ...], record_id: str = "record_id", made: DataFrame | None = None) -> DataFrame:
    """A row for each strategy: blocks, average and largest size, coverage, and the overall totals
    total_records, generated_candidates, total_possible_pairs and reduction_ratio. ``made`` is the
    row of ``count_pairs``; without it the pairs are counted."""
    totals = blocked.agg(F.count("*").alias("total_records"))
    made = pairs.agg(F.count("*").alias("generated_candidates")) if made is None else made
    sizes = long_keys(blocked, strategies, record_id).groupBy("strategy", "block_key").agg(F.count("*").alias("n"))
    per = sizes.groupBy("strategy").agg(F.count("*").alias("num_blocks"), F.avg("n").alias("avg_block_size"), F.max("n").alias("max_block_size"), F.sum("n").alias("covered"))
    names = reduce(DataFrame.unionByName, [totals.select(F.lit(s.name).alias("strategy"), "total_records") for s in strategies])
    possible = F.col("total_records") * (F.col("total_records") - 1) / 2
    joined = names.join(per, "strategy", "left").crossJoin(made)  # one row of totals
    return joined.select(
        "strategy", F.coalesce("num_blocks", F.lit(0)).alias("num_blocks"), F.coalesce("avg_block_size", F.lit(0.0)).alias("avg_block_size"), F.coalesce("max_block_size", F.lit(0)).alias("max_block_size"),
        F.coalesce(F.try_divide("covered", "total_records"), F.lit(0.0)).alias("coverage"), "total_records", "generated_candidates", possible.cast("long").alias("total_possible_pairs"),
        F.coalesce(1 - F.try_divide(F.col("generated_candidates"), possible), F.lit(0.0)).alias("reduction_ratio"),
    )
