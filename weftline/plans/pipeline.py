"""Provider records to canonical records: validate, normalise, block, score, decide, merge."""

from __future__ import annotations

import argparse
import json
import time
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import config as settings
from weftline.functions.normalize import normalize
from weftline.operators import audit, blocking, linking, merge, ml, quality, scoring
from weftline.session import create_session, cut, prepare
from weftline.sources import files


@dataclass
class Result:
    validation: DataFrame
    normalized: DataFrame
    pairs: DataFrame
    hybrid: DataFrame
    merged: DataFrame
    unmerged: DataFrame
    log: DataFrame
    queue: DataFrame
    seconds: dict[str, float] = field(default_factory=dict)

    def report(self) -> dict:
        """Nested totals, from four small aggregations."""
        records = self.normalized.count()
        stats = merge.merge_stats(self.log, records).first().asDict()
        totals = scoring.scoring_stats(self.hybrid).first().asDict()
        return {
            "execution": {"seconds": self.seconds}, "data_processing": {"total_records": records, "candidate_pairs": totals["total_pairs"], "final_records": stats["merged_count"]},
            "scoring": totals, "merge_statistics": stats, "audit_metrics": audit.queue_stats(self.queue).first().asDict(),
        }


def with_record_ids(df: DataFrame) -> DataFrame:
    """The records with a stable record_id: as given, or by a hash of the whole row. Rows alike in
    every column are numbered by provider_id and row number."""
    if "record_id" in df.columns:
        return df
    from pyspark.sql import Window

    base = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in df.columns])
    numbered = df.withColumn("__h", base).withColumn("__n", F.row_number().over(Window.partitionBy("__h").orderBy("__h")))
    return numbered.withColumn("record_id", F.when(F.col("__n") == 1, F.col("__h")).otherwise(F.xxhash64("__h", "__n"))).drop("__h", "__n")


def run(records: DataFrame, config: settings.Config = settings.Config(), known: DataFrame | None = None, model: PipelineModel | None = None, queue: DataFrame | None = None, now: datetime | None = None) -> Result:
    """The whole pipeline over records of the provider columns. Normalised records are used more than
    once and so are written to the checkpoint folder. Pairs are many more: they are scored anew for
    each use, and merged by ``linking``; only with a model their scores are written, too."""
    prepare(records.sparkSession)
    seconds: dict[str, float] = {}

    def timed(name, make):
        began = time.perf_counter()
        out = make()
        seconds[name] = round(time.perf_counter() - began, 3)
        return out

    valid, report = timed("validate", lambda: quality.validate(with_record_ids(records)))
    normal = timed("normalize", lambda: cut(normalize(valid, config.normalization, known)))
    pairs = timed("pairs", lambda: blocking.candidate_pairs(blocking.block_keys(normal, config.blocking), config.blocking))

    def score():
        joined = blocking.paired(blocking.block_keys(normal, config.blocking), config.blocking, scoring.compared(normal))
        found = scoring.scored(joined, config.weights, config.thresholds, with_jaro=False)
        if model is None:
            return scoring.hybrid_scores(found, None, config.weights, config.thresholds)
        told = ml.predict(model, ml.pair_features(pairs.select("record_id_1", "record_id_2"), normal))
        return cut(scoring.hybrid_scores(found, told, config.weights, config.thresholds))

    def join():
        if model is None:
            links = linking.merging_links(normal, config.blocking, config.weights, config.thresholds)
            return merge.apply_merges(merge.groups(links, normal), normal, config.merge)
        return merge.apply_auto_merges(hybrid, normal, config.merge)

    hybrid = timed("score", score)
    merged, unmerged, log = timed("merge", join)
    waiting = audit.enqueue(queue, audit.audit_candidates(hybrid, config.thresholds), now or datetime.now(UTC).replace(tzinfo=None))
    return Result(report, normal, pairs, hybrid, merged, unmerged, log, waiting, seconds)


def save(result: Result, folder: str, kind: str = "parquet") -> None:
    for name, df in {"merged_providers": result.merged, "unmerged_providers": result.unmerged, "scoring_results": result.hybrid, "merge_log": result.log, "audit_queue": result.queue}.items():
        files.write(df, f"{folder.rstrip('/')}/{name}", kind)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True)
    p.add_argument("--source", required=True)
    p.add_argument("--format", choices=files.FORMATS)
    p.add_argument("--config")
    p.add_argument("--model", help="a saved classifier")
    p.add_argument("--output", required=True)
    p.add_argument("--output-format", choices=files.FORMATS, default="parquet")
    p.add_argument("--master")
    given = p.parse_args(args)
    spark: SparkSession = create_session("provider resolution", given.master)
    result = run(files.ingest(spark, given.input, given.source, given.format), settings.load(given.config), model=ml.load(given.model) if given.model else None)
    save(result, given.output, given.output_format)
    print(json.dumps(result.report(), default=str))


if __name__ == "__main__":
    main()
