import math
import os
from glob import glob

import duckdb
import pytest

import __spark_entry__ as entry
from weftline.plans.oracle import ORACLE
from weftline.plans.queries import QUERIES


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


QUICK = ["normalize_names", "normalize_address", "soundex_codes", "affiliation_fuzzy", "fuzz_ratio_pairs", "jaro_winkler_pairs", "validation_report", "clean_providers", "blocking_stats", "threshold_search", "merged_providers", "rollback_merge", "reviewer_performance", "model_perf_lag", "derived_metrics", "metrics_report", "ml_features"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted([plain(r[c]) for c in columns] for r in df.collect())
    result = con.execute(ORACLE[name])
    at = [d[0] for d in result.description]
    want = sorted([plain(r[at.index(c)]) for c in columns] for r in result.fetchall())
    assert sorted(at) == columns and got == want and got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert entry.oracle_sql().keys() <= entry.queries().keys() and ORACLE.keys() <= QUERIES.keys()
