"""Provider records derived from the customer table by integer arithmetic, and audit tables
derived from events. Every ten keys hold a triple, a pair and five singletons; variant 1 is
decorated, variant 2 has a typing error. The SQL does the same for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from weftline.functions import fixed_values as V
from weftline.session import prepare

FIRST = "John Jane Robert Mary Zoe Ivan Carlos Wei Aisha Peter Susan Omar Linda Hugo Nina Paul".split()
LAST = "Smith Johnson Garcia Ashcraft Pfister Tymczak Nguyen Okafor Brown-Lee Walsh Schmidt Kowalski Haddad Ito Fraser Mbeki".split()
ENDINGS = ["", "son", "ton", "man", "berg", "well", "ford", "ley", "ski", "ez", "ova", "ini", "dal", "gren", "etti", "oglu"]
INSTITUTIONS = ["Mayo Clinic", "Johns Hopkins Hospital", "Cleveland Clinic", "Kaiser Permanente", "Stanford Health Care", "Tenet Healthcare", "Duke Hospital"]
PLACES = ["Baltimore, MD 21287", "Rochester, MN 55905", "Cleveland, OH 44195", "Oakland, CA 94612", "Durham, NC 27710"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _statement(pick, source: str) -> str:
    """The projection in SQL; ``pick`` writes the choice of a list's element by a 0-based index."""
    return f"""
SELECT record_id, 'P' || CAST(record_id AS STRING) AS provider_id, true_entity,
  CASE v WHEN 0 THEN f || ' ' || l WHEN 1 THEN 'Dr. ' || f || ' ' || l || ' MD' ELSE upper(f) || '  ' || l END AS raw_name,
  f AS first_name, l AS last_name, CASE WHEN v = 1 THEN upper(a) ELSE a END AS affiliation,
  CAST(100 + e % 900 AS STRING) || ' Main ' || CASE WHEN v = 1 THEN 'Street' ELSE 'St' END || ', ' || p AS address,
  CASE WHEN moved THEN '(410) 556-' ELSE '(410) 555-' END || lpad(CAST(e % 10000 AS STRING), 4, '0') AS phone,
  CASE WHEN moved THEN 'alt.' ELSE '' END || lower(f) || CAST(e AS STRING) || '@example.org' AS email, s AS source
FROM (SELECT k AS record_id, e, e AS true_entity, k - e AS v, k - e = 2 AND (e // 10) % 2 = 1 AS moved,
    {pick(FIRST, "e % 16")} AS f,
    CASE WHEN k - e = 2 THEN left(l0, length(l0) - 1) ELSE l0 END AS l,
    {pick(INSTITUTIONS, "e % 7")} AS a, {pick(PLACES, "e % 5")} AS p, {pick(V.SOURCES, "k % 6")} AS s
  FROM (SELECT k, e, {pick(LAST, "(e // 16) % 16")} || {pick(ENDINGS, "(e // 256) % 16")} AS l0
    FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 <= 2 THEN c_custkey - c_custkey % 10 WHEN c_custkey % 10 <= 4 THEN c_custkey - c_custkey % 10 + 3 ELSE c_custkey END AS e FROM {source}) k1) k2) k3
"""


def _words(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


PROVIDERS_SQL = _statement(lambda values, at: f"([{_words(values)}])[1 + {at}]", "customer").replace("AS STRING", "AS VARCHAR")


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records, dealt to all executors: the table's file is read by a task or two."""
    said = _statement(lambda values, at: f"element_at(array({_words(values)}), cast(1 + {at} AS int))", "{customers}")
    keys = table(spark, sf_dir, "customer").select("c_custkey").repartition(2 * spark.sparkContext.defaultParallelism, "c_custkey")
    return spark.sql(re.sub(r"\((e) // (\d+)\)", r"(\1 div \2)", said), customers=keys)


#: Decisions from events: every event is a review of a pair of its own.
LOG_SQL = """
SELECT event_id AS audit_id, 'p' || CAST(event_id AS VARCHAR) AS pair_id, event_id AS record_id_1, event_id + 1 AS record_id_2,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'MERGE' ELSE 'REJECT' END AS decision, 'u' || CAST(user_id % 25 AS VARCHAR) AS reviewer, ts AS "timestamp", value AS processing_time,
  CAST(event_id % 101 AS DOUBLE) / 100 AS hybrid_score, CAST(event_id % 89 AS DOUBLE) / 100 AS deterministic_score, CAST(0 AS DOUBLE) AS ml_probability
FROM events
"""
QUEUE_SQL = """
SELECT event_id AS queue_id, 'p' || CAST(event_id AS VARCHAR) AS pair_id, event_id AS record_id_1, event_id + 1 AS record_id_2, CAST(event_id % 101 AS DOUBLE) / 100 AS hybrid_score,
  CASE WHEN event_type = 'view' THEN 'pending' ELSE 'reviewed' END AS status, CAST(event_id % 3 AS INTEGER) AS priority, ts AS added_date
FROM events
"""
PERFORMANCE_SQL = """
SELECT 'v' || CAST(d AS VARCHAR) AS model_version, d AS evaluation_date, CAST(a AS DOUBLE) / n AS "precision", CAST(b AS DOUBLE) / n AS recall, CAST(a + b AS DOUBLE) / (2 * n) AS f1_score, CAST(c AS DOUBLE) / n AS auc_score
FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS a, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS b, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS c FROM events GROUP BY CAST(ts AS DATE)) t
"""


def _from_events(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    said = sql.replace("AS VARCHAR", "AS STRING").replace('"timestamp"', "`timestamp`").replace('"precision"', "`precision`").replace("FROM events", "FROM {events}")
    return spark.sql(said, events=table(spark, sf_dir, "events"))


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, LOG_SQL)


def audit_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, QUEUE_SQL)


def model_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, PERFORMANCE_SQL)
