"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as registered

DATA = "/root/testdata/sf0.001"
TABLES = ("events", "lineitem", "pages")
CHECKED = ["s6_range_read", "s7_series_rows", "k6_store_write", "p5_clean_names", "p8_epochs", "a2_median_mad",
           "a4_resample", "a4_resample_7min", "a6_cut", "w0_index", "w2_ema", "w4_trailing", "j2_side_by_side",
           "d5_ema", "d6_parts", "d8_ensemble_supplier", "m0b_scaled", "m2_lof", "m3_knn", "r2_summary",
           "r4_histogram", "r5_box_plot", "r6_matrix", "e5_dispatch"]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def ordered(rows, columns):
    at = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(None if isinstance(r[j], float) and math.isnan(r[j]) else r[j] for j in at) for r in rows]
    return sorted(picked, key=lambda r: [(x is None, x if x is not None else 0) for x in r])


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    got = registered.queries()[name](spark, DATA)
    result = con.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert ordered([tuple(r) for r in got.collect()], got.columns) == ordered(result.fetchall(), columns)


def test_flagship(spark):
    assert registered.entry(spark).count() == 5
