"""Session helpers: builder defaults, the shared checkpoint folder, the workers' import path."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def create_session(app: str = "weftline", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A UTC session with adaptive execution; ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | (conf or {})
    builder = SparkSession.builder.appName(app).config(map=settings)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable and this package importable in Python workers.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only where that is
    unset and the master is local (tests, a laptop) a temporary one is made.
    """
    sc = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weftline-checkpoint-"))
    paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder; later reads survive lost executors."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_round(df: DataFrame) -> DataFrame:
    """``cut`` for what a loop carries from round to round. A checkpoint keeps the size that Spark
    estimated for it, and joins multiply sizes, so over rounds of self-joins the estimate grows to
    numbers of megabytes that the driver multiplies for each query. Here it starts anew."""
    done = cut(df)
    spark = done.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(done._jdf.toJavaRDD(), done._jdf.schema()), spark)
