"""Readers and writers of provider files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from weftline.functions import fixed_values as V
from weftline.functions.normalize import last_of_each

FORMATS = ("csv", "parquet", "json")
PROVIDERS = StructType([StructField(c, StringType()) for c in V.REQUIRED])


def format_of(path: str) -> str:
    """The format that a path's suffix names."""
    name = path.rstrip("/").lower()
    for kind in FORMATS:
        if name.endswith(f".{kind}") or f".{kind}." in name.rsplit("/", 1)[-1]:
            return kind
    if name.endswith(".jsonl"):
        return "json"
    raise ValueError(f"no format given and none known from {path!r}")


def read(spark: SparkSession, path: str | list[str], kind: str | None = None, schema: StructType | None = None) -> DataFrame:
    """A table from any path Spark reaches (local, s3a, ...). CSV has a header and empty fields are
    null; JSON holds an object a line. Without a schema CSV columns are strings."""
    first = path if isinstance(path, str) else path[0]
    kind = kind or format_of(first)
    if kind not in FORMATS:
        raise ValueError(f"unsupported format: {kind}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "csv":
        return reader.option("header", True).option("nullValue", "").option("emptyValue", "").option("enforceSchema", False).csv(path)
    return reader.json(path) if kind == "json" else reader.parquet(path)


def read_many(spark: SparkSession, paths: list[str], kind: str | None = None, schema: StructType | None = None) -> DataFrame:
    """The union of files by column name; columns that some lack are null there. No path at all
    gives an empty table of provider columns. A file that can't be read is an error."""
    frames = [read(spark, p, kind, schema) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else spark.createDataFrame([], schema or PROVIDERS)


def ingest(spark: SparkSession, path: str, source: str, kind: str | None = None) -> DataFrame:
    """Provider records with the label ``source`` on every row."""
    return read(spark, path, kind).withColumn("source", F.lit(source))


def ingest_many(spark: SparkSession, labelled: dict[str, str], kind: str | None = None) -> DataFrame:
    """Records of several sources, label to path, in one table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [ingest(spark, p, s, kind) for s, p in labelled.items()])


def list_files(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Paths, sizes and times of the files below a folder whose names end in ``suffix``, in any case."""
    pattern = "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")


def write(df: DataFrame, path: str, kind: str = "parquet", compression: str = "snappy") -> None:
    """Overwrites ``path``. In CSV arrays, maps and structs stand as JSON."""
    if kind == "parquet":
        df.write.mode("overwrite").option("compression", compression).parquet(path)
    elif kind == "csv":
        nested = (ArrayType, MapType, StructType)
        flat = df.select([F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema])
        flat.write.mode("overwrite").option("header", True).csv(path)
    elif kind == "json":
        df.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unsupported format: {kind}")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """An affiliation dictionary (canonical_name, variant); of equal variants the last row counts.
    The file's order is its rows' order within the one file."""
    rows = read(spark, path, "csv").withColumn("pos", F.monotonically_increasing_id())
    return last_of_each(rows.withColumnRenamed("canonical_name", "canonical").select("pos", F.trim("canonical").alias("canonical"), "variant"))


def read_training(spark: SparkSession, path: str, features: list[str], label: str = "label") -> DataFrame:
    """Labelled pairs: missing features count as 0; labels other than 0 and 1 are an error."""
    df = read(spark, path, "csv")
    if missing := sorted({label, *features} - set(df.columns)):
        raise ValueError(f"missing columns: {missing}")
    df = df.withColumns({f: F.coalesce(F.col(f).try_cast("double"), F.lit(0.0)) for f in features}).withColumn(label, F.col(label).try_cast("double"))
    if not df.where(F.col(label).isNull() | ~F.col(label).isin(0.0, 1.0)).isEmpty():
        raise ValueError("labels must be 0 or 1")
    return df.withColumn(label, F.col(label).cast("int"))
