import datetime as dt
import hashlib

from pyspark.sql import functions as F
from tests.builders import bronze_metadata, bronze_reviews, day

from ratings_engine import schemas
from ratings_engine.functions import columns as fc
from ratings_engine.operators.silver import build_silver, unique_reviews, with_event_time, with_review_id


def test_review_id_ignores_asin_and_takes_null_as_empty(spark):
    df = with_review_id(bronze_reviews(
        spark, dict(asin="A1"), dict(asin="A2"),
        dict(user_id=None, parent_asin=None, timestamp=None)))
    one, two, empty = [r.review_id for r in df.collect()]
    assert one == two == hashlib.sha256(b"U1||P1||1588687728923").hexdigest()
    assert empty == hashlib.sha256(b"||||").hexdigest()


def test_event_time_is_cut_to_seconds_towards_zero(spark):
    rows = with_event_time(bronze_reviews(
        spark, dict(timestamp=1_999), dict(timestamp=-1_500), dict(timestamp=None),
        dict(timestamp=2**63 - 1))).select(
        F.col("review_timestamp").cast("string"), F.col("review_date").cast("string")).collect()
    assert [tuple(r) for r in rows] == [
        ("1970-01-01 00:00:01", "1970-01-01"), ("1969-12-31 23:59:59", "1969-12-31"), (None, None),
        (None, None)]


def test_newest_delivery_survives(spark):
    reviews = bronze_reviews(
        spark, dict(text="old", ingestion_date=day("2026-03-08")),
        dict(text="new", ingestion_date=day("2026-03-09")),
        dict(text="older", ingestion_date=day("2026-03-07")))
    result = build_silver(reviews, bronze_metadata(spark)).collect()
    assert [r.review_text for r in result] == ["new"]
    assert result[0].product_title is None and result[0].price is None


def test_equal_dates_leave_the_same_survivor_for_any_storage_order(spark):
    rows = [dict(text=t, rating=r) for t, r in (("b", 2.0), ("a", 3.0), ("a", 1.0))]
    survivors = {build_silver(bronze_reviews(spark, *order), bronze_metadata(spark)).first()
                 for order in (rows, rows[::-1])}
    assert len(survivors) == 1


def test_repeated_metadata_does_not_multiply_reviews(spark):
    metadata = bronze_metadata(
        spark, dict(title="old", price="$5", ingestion_date=day("2026-03-07")),
        dict(title="new", price="$6", ingestion_date=day("2026-03-08")))
    result = build_silver(bronze_reviews(spark, {}), metadata).collect()
    assert [(r.product_title, r.price) for r in result] == [("new", 6.0)]


def test_category_is_part_of_the_product(spark):
    result = build_silver(bronze_reviews(spark, dict(category="Books")), bronze_metadata(spark, {}))
    assert result.first().product_title is None


def test_prices(spark):
    given = ["$19.99", "Not available", "", None, "$1,299.99", "from 5 to 9", "7"]
    df = spark.createDataFrame([(p,) for p in given], "p string")
    assert [r[0] for r in df.select(fc.parse_price(F.col("p"))).collect()] == [
        19.99, None, None, None, 1.0, 5.0, 7.0]


def test_columns_follow_the_contract(spark):
    built = build_silver(bronze_reviews(spark, {}), bronze_metadata(spark, {}))
    assert [(f.name, f.dataType) for f in built.schema] == [
        (f.name, f.dataType) for f in schemas.SILVER]


def test_strip_equals_python(spark):
    texts = ["  a b ", "\t\n x ", "\x1c\x85y　", "", " ", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(fc.strip(F.col("t"))).collect()] == [t.strip() for t in texts]


def test_digest_of_the_key_is_made_after_the_shuffles(spark):
    df = build_silver(bronze_reviews(spark, {}, {"text": "y"}), bronze_metadata(spark, {}))
    above, below = df._jdf.queryExecution().optimizedPlan().toString().split("Window", 1)
    assert "sha2" in above and "sha2" not in below


def test_rows_whose_parts_differ_but_whose_key_text_is_equal_are_one_review(spark):
    rows = bronze_reviews(spark, {"user_id": "a||b", "parent_asin": "c"}, {"user_id": "a", "parent_asin": "b||c"},
                          {"user_id": None, "parent_asin": ""}, {"user_id": "", "parent_asin": None})
    assert build_silver(rows, bronze_metadata(spark, {})).count() == 2


def test_reviews_are_unique_by_the_text_of_their_id(spark):
    rows = [("a||b", "c", 1, 1.0), ("a", "b||c", 1, 2.0), (None, "c", 1, 3.0), ("", "c", 1, 4.0), ("a", "c", None, 5.0),
            ("a", "c", 1, 6.0), ("a", "c", 1, 7.0), ("a", "d", 1, 8.0), ("a|", "c", 1, 9.0)]
    frame = spark.createDataFrame([(*r, dt.date(2026, 1, 1)) for r in rows],
                                  "user_id string, parent_asin string, timestamp long, rating double, ingestion_date date")
    got = unique_reviews(frame)
    assert got.columns == frame.columns
    # Of equal texts the first by the other columns in the order of their names: product b||c before c.
    assert sorted(r.rating for r in got.collect()) == [2.0, 3.0, 5.0, 6.0, 8.0, 9.0]
    assert {tuple(r)[:3] for r in got.collect()} <= {r[:3] for r in rows}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_user_id" in plan and "_key" in plan
