"""A match classifier over pair features, with the library's own ML pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import edits_normalized, fuzz_ratio, jaro_winkler, length_difference
from weftline.operators.scoring import _flag, _same, with_records, words_jaccard

FEATURES = [
    "name_exact", "name_edits", "name_fuzz", "name_jaro_winkler", "name_length_diff",
    "affiliation_exact", "affiliation_jaccard", "affiliation_fuzz",
    "city_match", "state_match", "zip_match", "street_match",
    "phone_match", "email_match", "same_source", "same_provider_id",
]


def pair_features(pairs: DataFrame, records: DataFrame, record_id: str = "record_id") -> DataFrame:
    """The pairs with sixteen feature columns. Features of two names or affiliations are 0 if either
    is empty; matches of a field need it on both sides."""
    return features(with_records(pairs, records, record_id=record_id)).select(*pairs.columns, *FEATURES)


def features(df: DataFrame) -> DataFrame:
    """``pair_features`` of pairs that have both records' columns already, with these columns."""
    n1, n2, a1, a2 = F.col("norm_name_1"), F.col("norm_name_2"), F.col("norm_affiliation_1"), F.col("norm_affiliation_2")
    l1, l2 = F.col("low_norm_name_1"), F.col("low_norm_name_2")
    named = lambda c: F.when((n1 != "") & (n2 != ""), c).otherwise(0.0)
    placed = lambda c: F.when((a1 != "") & (a2 != ""), c).otherwise(0.0)
    made: dict[str, Column] = dict(zip(FEATURES, [
        _flag(_same("norm_name")), named(edits_normalized(l1, l2)), named(fuzz_ratio(n1, n2) / 100), named(jaro_winkler(l1, l2)), named(length_difference(n1, n2)),
        _flag(_same("norm_affiliation")), words_jaccard(), placed(fuzz_ratio(a1, a2) / 100),
        _flag(_same("city_norm")), _flag(_same("state_norm")), _flag(_same("zip_norm", False)), _flag(_same("address_line_1_norm")),
        _flag(_same("phone_norm", False)), _flag(_same("email_norm")), _flag(_same("source", False)), _flag(_same("provider_id", False)),
    ], strict=True))
    return df.withColumns(made)


def estimator(algorithm: str = "gbt", seed: int = 42, **params) -> Pipeline:
    """Assembled, scaled features and a classifier. Other algorithms than "gbt" are an error."""
    if algorithm != "gbt":
        raise ValueError(f"unsupported algorithm: {algorithm}")
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="raw", handleInvalid="keep"), StandardScaler(inputCol="raw", outputCol="features", withMean=True), GBTClassifier(labelCol="label", featuresCol="features", seed=seed, **({"maxIter": 20, "maxDepth": 4} | params))])


def _place(seed: int) -> Column:
    """Where a labelled pair is in [0, 1)."""
    return F.pmod(F.xxhash64("record_id_1", "record_id_2", "label", F.lit(seed)), F.lit(10_000)) / 10_000


def split(labelled: DataFrame, test: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test), the same rows each time: by a hash of the pair, within each label."""
    return labelled.where(_place(seed) >= test), labelled.where(_place(seed) < test)


def counted(labelled: DataFrame, test: float = 0.2, seed: int = 42) -> DataFrame:
    """The distinct features and labels with the number of their pairs, ``n``, and of those that
    ``split`` would train with, ``n_train``."""
    return labelled.groupBy(*FEATURES, "label").agg(F.count("*").alias("n"), F.count_if(_place(seed) >= test).alias("n_train"))


def train(labelled: DataFrame, algorithm: str = "gbt", seed: int = 42, grid: dict[str, list] | None = None, folds: int = 3, weight: str | None = None) -> PipelineModel:
    """A fitted pipeline; with a grid (classifier parameter to values) the best by AUC over folds.
    A row counts ``weight`` times, or once."""
    pipeline = estimator(algorithm, seed, **({"weightCol": weight} if weight else {}))
    if not grid:
        return pipeline.fit(labelled)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(pipeline.getStages()[-1].getParam(name), values)
    return CrossValidator(estimator=pipeline, estimatorParamMaps=builder.build(), evaluator=BinaryClassificationEvaluator(), numFolds=folds, seed=seed, parallelism=2).fit(labelled).bestModel


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """record ids, match_probability and match_prediction (1 from 0.5 on)."""
    p = vector_to_array("probability")[1]
    return model.transform(features).withColumn("match_probability", p).withColumn("match_prediction", (p >= 0.5).cast("int")).select(*features.columns, "match_probability", "match_prediction")


def auc(model: PipelineModel, labelled: DataFrame) -> float:
    return BinaryClassificationEvaluator().evaluate(model.transform(labelled))


def cross_validate(labelled: DataFrame, folds: int = 5, seed: int = 42) -> dict[str, float]:
    """Mean, deviation, least and greatest AUC over folds."""
    pipeline = estimator("gbt", seed)
    fold = F.pmod(F.xxhash64("record_id_1", "record_id_2", F.lit(seed + 1)), F.lit(folds))
    scores = [auc(pipeline.fit(labelled.where(fold != k)), labelled.where(fold == k)) for k in range(folds)]
    mean = sum(scores) / folds
    return {"mean": mean, "std": (sum((s - mean) ** 2 for s in scores) / folds) ** 0.5, "min": min(scores), "max": max(scores)}


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel) -> list[tuple[str, float]]:
    return sorted(zip(FEATURES, model.stages[-1].featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def prediction_stats(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """One row of totals; a prediction counts ``weight`` times, or once."""
    p = F.col("match_probability")
    bands = {"high_confidence": p >= 0.9, "low_confidence": p <= 0.1, "uncertain": (p > 0.4) & (p < 0.6)}
    if weight is None:
        return predictions.agg(F.count("*").alias("total"), F.avg(p).alias("mean"), F.median(p).alias("median"), F.stddev_samp(p).alias("std"), F.min(p).alias("min"), F.max(p).alias("max"), *[F.count_if(b).alias(k) for k, b in bands.items()])
    n = F.col(weight)
    sums = predictions.agg(F.coalesce(F.sum(n), F.lit(0)).alias("total"), F.try_divide(F.sum(n * p), F.sum(n)).alias("mean"), F.percentile(p, F.lit(0.5), n).alias("median"), F.min(p).alias("min"), F.max(p).alias("max"), *[F.coalesce(F.sum(F.when(b, n)), F.lit(0)).alias(k) for k, b in bands.items()])
    off = F.sum(n * (p - F.col("mean")) * (p - F.col("mean")))
    std = predictions.select(p, n).crossJoin(F.broadcast(sums.select("mean"))).agg(F.sqrt(F.try_divide(off, F.nullif(F.sum(n) - 1, F.lit(0)))).alias("std"))
    return sums.crossJoin(F.broadcast(std)).select("total", "mean", "median", "std", "min", "max", *bands)


def threshold_curve(labelled: DataFrame, score: str = "match_probability", label: str = "label", digits: int = 4, weight: str | None = None) -> DataFrame:
    """(threshold, precision, recall, f1) at each distinct score, rounded to ``digits``. Rows are
    counted by score first, so the running sums go over at most 10**digits + 1 rows. A row counts
    ``weight`` times, or once."""
    of = lambda k: F.coalesce(F.sum(F.when(F.col(label) == k, F.col(weight) if weight else F.lit(1))), F.lit(0))
    per = labelled.groupBy(F.round(score, digits).alias("threshold")).agg(of(1).alias("pos"), of(0).alias("neg"))
    down = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    tp, fp, pos = F.sum("pos").over(down), F.sum("neg").over(down), F.sum("pos").over(Window.partitionBy())
    rates = per.select("threshold", F.try_divide(tp.cast("double"), tp + fp).alias("precision"), F.coalesce(F.try_divide(tp.cast("double"), pos), F.lit(0.0)).alias("recall"))
    return rates.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def calibrate(labelled: DataFrame, metric: str = "f1", **columns) -> DataFrame:
    """One row: the threshold with the best f1, precision or recall (the largest such), and its value."""
    if metric not in ("f1", "precision", "recall"):
        raise ValueError(f"unsupported metric: {metric}")
    return threshold_curve(labelled, **columns).agg(F.max_by("threshold", F.struct(metric, "threshold")).alias("threshold"), F.max(metric).alias("value"))
