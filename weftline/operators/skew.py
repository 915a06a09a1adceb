"""Group aggregates for every row of a group, however large the group.

A group's rows are dealt into runs by a hash, each run is reduced, and the runs' results are
merged over rounds of ``fan_in`` into one. The totals then travel back down the same tree, so
no join or aggregation ever sees more than one run (or ``fan_in`` partial results) of a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Merge = Callable[[Column], Column]
RUN = "__run"


def run_count(df: DataFrame, fan_in: int, least: int) -> int:
    """The least power of ``fan_in`` that is no smaller than ``least`` or the shuffle partitions."""
    want = max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = fan_in
    while runs < want:
        runs *= fan_in
    return runs


def deal(df: DataFrame, keys: list[str], spread: Column, fan_in: int = 16, least: int = 256) -> DataFrame:
    """``df`` with its run number, partitioned by key and run."""
    runs = run_count(df, fan_in, least)
    return df.withColumn(RUN, F.pmod(spread, F.lit(runs)).cast("int")).repartition(*keys, RUN)


def tree_levels(dealt: DataFrame, keys: list[str], aggs: dict[str, tuple[Column, Merge]], fan_in: int = 16, least: int = 256, in_order: bool = False) -> list[DataFrame]:
    """Partial results by (key, run), from single runs up to the root; the last has no run column.

    ``aggs`` maps an output name to (aggregate over rows, how to merge partial results of that name).
    ``in_order`` sorts what meets by key, so that runs are sorted and aggregates whose states have
    no fixed width (of structs, say) are merged as streams.
    """
    runs = run_count(dealt, fan_in, least)
    met = lambda df, by: df.repartition(*by).sortWithinPartitions(*by) if in_order else df
    merges = [merge(F.col(name)).alias(name) for name, (_, merge) in aggs.items()]
    levels = [(dealt.sortWithinPartitions(*keys, RUN) if in_order else dealt).groupBy(*keys, RUN).agg(*[first.alias(name) for name, (first, _) in aggs.items()])]
    while runs > fan_in:
        runs //= fan_in
        levels.append(met(levels[-1].withColumn(RUN, F.floor(F.col(RUN) / fan_in).cast("int")), [*keys, RUN]).groupBy(*keys, RUN).agg(*merges))
    levels.append(met(levels[-1], keys).groupBy(*keys).agg(*merges))
    return levels


def with_totals(dealt: DataFrame, keys: list[str], aggs: dict[str, tuple[Column, Merge]], fan_in: int = 16, least: int = 256, in_order: bool = False) -> DataFrame:
    """Rows of ``deal`` with the totals of their group. Keys must not be null."""
    *partial, down = tree_levels(dealt, keys, aggs, fan_in, least, in_order)
    for depth in range(len(partial) - 1, 0, -1):
        # rows of one level and key: at most fan_in share a parent
        side = partial[depth].select(*keys, RUN)
        side = side if depth == len(partial) - 1 else side.withColumn("__up", F.floor(F.col(RUN) / fan_in).cast("int"))
        down = _join_up(side, down, keys)
    side = partial[0].select(*keys, RUN)
    if len(partial) > 1:
        side = side.withColumn("__up", F.floor(F.col(RUN) / fan_in).cast("int"))
    down = _join_up(side, down, keys)
    return dealt.join(down, [*keys, RUN]).drop(RUN)


def _join_up(side: DataFrame, down: DataFrame, keys: list[str]) -> DataFrame:
    if "__up" in side.columns:
        return side.join(down.withColumnRenamed(RUN, "__up"), [*keys, "__up"]).drop("__up")
    return side.join(down, keys)
