"""What the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.session import cut, prepare

#: Seconds after which the driver has heard of released objects.
HANDED_OVER = 2.0
#: What a worker keeps from task to task.
HELD: dict = {}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; read through Spark only, so any store Spark reaches will do."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only, other letters as they are; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of))


def sweep(spark: SparkSession) -> None:
    """Have both sides of the driver notice that shuffles before the last checkpoint are out of use, so
    that Spark removes their files now and not at its next full collection. The gateway hands
    objects that Python has released over to the driver about once a second, so it is waited for."""
    gc.collect()
    time.sleep(HANDED_OVER)
    spark.sparkContext._jvm.System.gc()
    time.sleep(HANDED_OVER / 4)


def lean() -> None:
    """Give back what earlier steps left in this worker: a worker that is used again keeps their
    objects, and the C library the pages of those that are gone."""
    HELD.clear()
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(batch, rows: int = 500):
    """A record batch in pieces, so that what is made of its texts stays small."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)


def without(docs: DataFrame, gone: DataFrame, on: list[Column], most: int = 200_000) -> DataFrame:
    """The rows of ``docs`` for which no row of ``gone`` meets all of ``on``; columns as they are.
    ``gone`` is broadcast if it has at most ``most`` rows, which spares a shuffle of the texts."""
    gone = cut(gone)
    few = gone.limit(most + 1).count() <= most
    return docs.join(F.broadcast(gone) if few else gone, on, "left_anti")
