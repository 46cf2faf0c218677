"""Registered queries against their DuckDB statements on the smallest
tables (the driver does the same for every query at sf0.01)."""

import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

from paths import SF_SMALL

TABLES = ["part", "lineitem"]
CHECKED = ["products_main", "price_summary", "filter_ladder", "numeric_profile", "join_coverage",
           "peer_percentiles", "robust_z", "primary_price", "anomaly_feed", "nutrition_structure", "products_analysis", "brand_concentration", "top_array_values", "task_readiness", "nested_extract",
           "alignment_counters", "job_dataset_audit", "job_filter_audit", "job_preprocess", "job_analysis_csv",
           "parquet_round_trip", "row_counts"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    cols = sdf.columns
    got = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=repr)
    rel = duck.sql(oracle_sql()[name])
    assert sorted(rel.columns) == sorted(cols)
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == exp
