"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted in cells of (source, lang, topic). The cells' token weights are raked:
scaled to the target of each source, then of each language, then of each topic, over and over
until all three marginals hold. A cell's raked weight over its natural one is the factor by
which its tokens should count; scaled so that the largest is one, it is the probability with
which each document of the cell is drawn.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import table, without
from weftline.session import cut, prepare

AXES = ("source", "lang", "topic")
MOST_CELLS = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    """A coarse topic by form: legal (names a licence or copyright), tabular (cells between
    bars), contact (an address sign), prose (the rest, null and empty texts too)."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(low.contains("licen") | low.contains("copyright"), "legal").when(low.contains(" | "), "tabular").when(low.contains("@"), "contact").otherwise("prose")


def tempered(shares: dict[str, float], power: float = 0.9) -> dict[str, float]:
    """Shares raised to a power below one and normalised: rare values gain, common ones lose."""
    raised = {v: s**power for v, s in shares.items() if s > 0}
    total = sum(raised.values())
    return {v: r / total for v, r in raised.items()}


def rake(cells: list[tuple[tuple[str, ...], float]], targets: list[dict[str, float]], rounds: int = 500, tolerance: float = 1e-10) -> list[float]:
    """The raked shares of ``cells`` (key, natural weight), in order.

    A value without a target keeps its natural share; the targets of an axis are normalised over
    the values present. Values of natural weight 0 stay 0. Targets that no weights can meet
    jointly leave the last round's weights, which meet the last axis exactly.
    """
    w = np.array([n for _, n in cells], float)
    if not len(w) or w.sum() <= 0:
        return [0.0] * len(w)
    w /= w.sum()
    codes, goals = [], []
    for axis, wanted in enumerate(targets):
        values, code = np.unique([k[axis] for k, _ in cells], return_inverse=True)
        natural = np.bincount(code, w, len(values))
        goal = np.where(natural > 0, [wanted.get(str(v), s) for v, s in zip(values, natural, strict=True)], 0)
        codes.append(code)
        goals.append(goal / goal.sum() if goal.sum() > 0 else natural)
    for _ in range(rounds):
        worst = 0.0
        for code, goal in zip(codes, goals, strict=True):
            now = np.bincount(code, w, len(goal))
            step = np.divide(goal, now, out=np.ones_like(goal), where=now > 0)
            worst = max(worst, float(np.abs(step - 1)[now > 0].max()))
            w = w * step[code]
        if worst < tolerance:
            break
    return w.tolist()


def _rake_far(cells: DataFrame, targets: list[dict[str, float] | None], power: float, rounds: int) -> DataFrame:
    """``rake`` without the driver, for more cells than it may hold: columns axes, natural, raked."""
    spark = cells.sparkSession
    now = cells.withColumn("raked", F.col("natural"))
    whole = cells.agg(F.sum("natural")).first()[0] or 1.0
    goals = []
    for axis, wanted in zip(AXES, targets, strict=True):
        goal = cells.groupBy(axis).agg((F.sum("natural") / whole).alias("s"))  # natural shares, as targets are shares
        if wanted is None:
            goal = goal.withColumn("g", F.when(F.col("s") > 0, F.pow("s", F.lit(power))).otherwise(0.0))
        else:
            given = spark.createDataFrame([(v, float(g)) for v, g in wanted.items()], f"{axis} string, t double")
            goal = goal.join(given, axis, "left").withColumn("g", F.when(F.col("s") > 0, F.coalesce("t", "s")).otherwise(0.0))
        total = goal.agg(F.sum("g")).first()[0] or 0.0
        if total <= 0:  # as in rake: no target is left to meet
            goal, total = goal.withColumn("g", F.col("s")), 1.0
        goals.append(cut(goal.select(axis, (F.col("g") / total).alias("g"))))
    for _ in range(rounds):
        now = now.withColumn("off", F.lit(0.0))
        for axis, goal in zip(AXES, goals, strict=True):
            margin = now.groupBy(axis).agg(F.sum("raked").alias("m")).join(goal, axis).select(axis, F.when(F.col("m") > 0, F.col("g") / F.col("m")).otherwise(1.0).alias("step"))
            now = now.join(margin, axis).withColumn("raked", F.col("raked") * F.col("step")).withColumn("off", F.greatest("off", F.abs(F.col("step") - 1) * (F.col("raked") > 0).cast("int"))).drop("step")
        now = cut(now)
        if (now.agg(F.max("off")).first()[0] or 0.0) < 1e-10:
            break
        now = now.drop("off")
    return now.select(*AXES, "natural", "raked")


def with_probabilities(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = 0.9, text: str = "text", doc_id: str = "doc_id", source: str = "source", lang: str = "lang", topic: str | None = None, rounds: int = 500, most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per input row: doc_id, source, lang, topic, tokens, probability, draw, kept.

    ``targets`` maps an axis (source, lang, topic) to its values' weights; an axis without
    targets gets its natural token shares raised to ``power``. Null sources, languages and
    topics form the value "". tokens counts runs of characters other than white space; null and
    empty texts have 0, and cells without tokens get the probability of a factor of one. draw
    is a hash of the id (of the text where the id is null) in [0, 1); a row is kept if it is
    below the probability, so rows that repeat are kept or dropped alike.

    Up to ``most_cells`` cells are raked on the driver and joined by broadcast; beyond that the
    raking is distributed and the join salted.
    """
    spark = docs.sparkSession
    prepare(spark)
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), name(F.col(source)).alias("source"), name(F.col(lang)).alias("lang"),
        name(F.col(topic) if topic else topic_of(F.col(text))).alias("topic"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("tokens"),
        (F.pmod(F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), body), F.lit(77)), F.lit(1 << 53)) / float(1 << 53)).alias("draw"),
    )
    rows = cut(rows)  # a few words a document; the texts are read once
    cells = rows.groupBy(*AXES).agg(F.sum("tokens").cast("double").alias("natural"))
    wanted = [(targets or {}).get(axis) for axis in AXES]
    some = cells.limit(most_cells + 1).collect()
    if len(some) <= most_cells:
        some.sort(key=lambda r: (r.source, r.lang, r.topic))
        listed = [((r.source, r.lang, r.topic), r.natural) for r in some]
        total = sum(n for _, n in listed) or 1.0
        goals = []
        for i, goal in enumerate(wanted):
            if goal is None:
                shares: dict[str, float] = {}
                for k, n in listed:
                    shares[k[i]] = shares.get(k[i], 0.0) + n / total
                goal = tempered(shares, power)
            goals.append(goal)
        raked = rake(listed, goals, rounds)
        factors = [w / (n / total) if n else None for (_, n), w in zip(listed, raked, strict=True)]
        top = max([f for f in factors if f is not None], default=1.0) or 1.0
        found = spark.createDataFrame([(*k, float(min(1.0, (1.0 if f is None else f) / top))) for (k, _), f in zip(listed, factors, strict=True)], "source string, lang string, topic string, probability double")
        out = rows.join(F.broadcast(found), [*AXES])  # at most most_cells rows
    else:
        far = _rake_far(cells, wanted, power, rounds)
        total = far.agg(F.sum("natural"), F.sum("raked")).first()
        far = far.withColumn("factor", F.when(F.col("natural") > 0, F.col("raked") / total[1] / (F.col("natural") / total[0])).otherwise(1.0))
        top = far.agg(F.max(F.when(F.col("natural") > 0, F.col("factor")))).first()[0] or 1.0
        salts = 64
        far = far.select(*AXES, F.least(F.lit(1.0), F.col("factor") / top).alias("probability"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        out = rows.withColumn("salt", F.floor(F.col("draw") * salts).cast("int")).join(far.hint("merge"), [*AXES, "salt"]).drop("salt")
    return out.select("doc_id", *AXES, "tokens", "probability", "draw", (F.col("draw") < F.col("probability")).alias("kept"))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = 0.9, **columns) -> DataFrame:
    """The rows of ``docs`` that are drawn, columns as they are; rows with a null id are drawn
    by their text and stay only if another row without an id, and with the same draw, does."""
    gone = with_probabilities(docs, targets, power, **columns).where("not kept").select(F.col("doc_id").alias("__gone"), F.col("draw").alias("__draw")).distinct()
    doc_id, text = columns.get("doc_id", "doc_id"), columns.get("text", "text")
    draw = F.pmod(F.xxhash64(F.coalesce(docs[doc_id].cast("string"), docs[text], F.lit("")), F.lit(77)), F.lit(1 << 53)) / float(1 << 53)
    return without(docs, gone, [docs[doc_id].eqNullSafe(gone["__gone"]), draw == gone["__draw"]])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_probabilities(table(spark, sf_dir, "documents"))
