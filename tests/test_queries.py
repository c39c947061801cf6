"""Registered queries against DuckDB on the smallest test tables, one per kind of operator.

python -m harness.check SF_DIR compares all of them."""

import os

import pytest

from harness.check import compare, duck
from harness.oracles import ORACLES
from harness.queries import QUERIES

SMALLEST = "/root/testdata/sf0.001"
SAMPLE = ("src_legacy_reviews", "src_cap_per_category", "silver_enrich", "silver_build",
          "gold_product_metrics", "gold_star_histogram", "bi_declining", "bi_top_value",
          "bi_overview", "bi_review_bundle", "sql_last_month", "dq_suite", "audit_dropoff")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="needs the test tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_duckdb(spark, name):
    assert compare(spark, duck(SMALLEST), QUERIES[name], ORACLES[name], SMALLEST) == ""
