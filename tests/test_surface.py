import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from tests.builders import category_trends, day, rows_of, silver

from ratings_engine import schemas
from ratings_engine.operators import audit, quality
from ratings_engine.operators.upsert import upsert_table
from ratings_engine.plans import sqlsurface


@pytest.mark.parametrize("text", [
    "DROP TABLE t", "select 1; delete from t", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a",
    "/* SELECT */ show tables", "", "explain select 1", "select 1 -- ok\n; truncate table t"])
def test_refused(spark, text):
    with pytest.raises(ValueError):
        sqlsurface.safe_sql(spark, text)


@pytest.mark.parametrize("escaped", ["true", "false"])
def test_a_write_behind_a_raw_string_is_refused(spark, escaped):
    spark.sql("create or replace temp view written as select 'x' as y")
    text = r"WITH a AS (SELECT r'\' AS x) INSERT INTO written SELECT 'y' FROM a"
    spark.conf.set("spark.sql.parser.escapedStringLiterals", escaped)
    try:
        with pytest.raises(ValueError, match="Insert"):
            sqlsurface.safe_sql(spark, text)
        assert sqlsurface.safe_sql(spark, "WITH a AS (SELECT 1 AS x) SELECT * FROM a WHERE x IN "
                                          "(SELECT 1)").count() == 1
    finally:
        spark.conf.unset("spark.sql.parser.escapedStringLiterals")
    assert rows_of(spark.table("written")) == [("x",)]


def test_words_in_literals_names_and_comments_are_allowed(spark):
    got = sqlsurface.safe_sql(
        spark, "-- drop it\nSELECT 'UPDATE it''s' AS `delete`, \"MERGE\" AS x /* create */ ;")
    assert tuple(got.first()) == ("UPDATE it's", "MERGE")


def test_outer_cap_holds_whatever_the_inner_limit(spark):
    text = "WITH a AS (SELECT 1 LIMIT 5) SELECT * FROM range(500)"
    assert sqlsurface.safe_sql(spark, text).count() == 100
    assert sqlsurface.safe_sql(spark, "select * from range(500) limit 7").count() == 7
    assert sqlsurface.safe_sql(spark, "select * from range(500) limit 200", cap=150).count() == 150


def test_views_of_existing_tables_only(spark, tmp_path):
    root = str(tmp_path)
    assert sqlsurface.register_views(spark, root) == []
    table = schemas.CATEGORY_TRENDS_TABLE
    upsert_table(spark, category_trends(spark, {}), f"{root}/{table.name}", table)
    assert sqlsurface.register_views(spark, root) == ["category_trends"]
    assert sqlsurface.safe_sql(spark, "select category from category_trends").first()[0] == "C"
    assert rows_of(audit.gold_counts(spark, root)) == [
        ("category_trends", 1), ("product_metrics", 0), ("verified_purchase_impact", 0)]
    assert rows_of(audit.gold_counts(spark, root, "other"))[0] == ("category_trends", 0)


def test_relative_periods(spark):
    d = dt.date
    assert sqlsurface.relative_bounds("yesterday", "2024-03-01") == (d(2024, 2, 29), d(2024, 2, 29))
    assert sqlsurface.relative_bounds("last 7 days", d(2024, 3, 1)) == (d(2024, 2, 23), d(2024, 2, 29))
    assert sqlsurface.relative_bounds("last month", "2024-03-01") == (d(2024, 1, 31), d(2024, 2, 29))
    assert sqlsurface.relative_bounds("today")[0] == d.today()
    with pytest.raises(ValueError):
        sqlsurface.relative_bounds("next year")
    trends = category_trends(spark, *(dict(review_date=day(x)) for x in (
        "2024-02-22", "2024-02-23", "2024-02-29", "2024-03-01")))
    assert sqlsurface.relative_range(trends, "last 7 days", "2024-03-01").count() == 2


def test_gate_counts_and_messages(spark):
    good = silver(spark, {}, dict(rating=None, helpful_vote=None))
    assert quality.validate_silver(good)
    with pytest.raises(ValueError, match="null_review_id=1, null_parent_asin=2"):
        quality.validate_silver(silver(spark, dict(review_id=""), dict(parent_asin=None),
                                       dict(parent_asin="", rating=9.0)))
    with pytest.raises(ValueError, match="invalid_rating=2, invalid_helpful_vote=1"):
        quality.validate_silver(silver(spark, dict(rating=0.5), dict(rating=5.5),
                                       dict(helpful_vote=-1)))


def test_suite(spark):
    suite = {"expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "review_id"}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "rating", "min_value": 1, "max_value": 5}},
        {"expectation_type": "expect_column_values_to_be_greater_than_or_equal_to",
         "kwargs": {"column": "helpful_vote", "value": 0}}]}
    rows = silver(spark, dict(rating=7.0), dict(helpful_vote=-2), {})
    for form in (suite, json.dumps(suite)):
        got = quality.count_violations(rows, quality.compile_suite(form)).orderBy("position")
        assert [r.violations for r in got.collect()] == [0, 1, 1]
    with pytest.raises(ValueError, match="unknown expectation"):
        quality.compile_suite({"expectations": [{"expectation_type": "x", "kwargs": {}}]})


def test_dropoff_keeps_categories_of_any_layer(spark):
    lines = spark.createDataFrame([("A", 5), ("B", 2)], "category string, count long")
    bronze = spark.createDataFrame([("A",)] * 4 + [("C",)], "category string")
    kept = spark.createDataFrame([("A",)] * 3, "category string")
    assert rows_of(audit.layer_dropoff(lines, bronze, kept)) == [
        ("A", 5, 4, 3, 1, 1), ("B", 2, 0, 0, 2, 0), ("C", 0, 1, 0, -1, 1)]


def test_one_pass_for_all_rules(spark):
    df = silver(spark, {}).withColumn("more", F.lit(1))
    plan = quality.silver_report(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 4 and plan.count("Scan") == 1
