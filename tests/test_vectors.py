"""Known inputs with known results for the Silver and Gold builders."""

from tests.builders import bronze_metadata, bronze_reviews, day, silver

from ratings_engine.operators import gold
from ratings_engine.operators.silver import build_silver


def test_silver_normalises_and_enriches(spark):
    reviews = bronze_reviews(
        spark,
        dict(rating=5.0, title="Great product", text="Works as expected.", asin="B001",
             parent_asin="P001", user_id="USER1", helpful_vote=2),
        dict(rating=4.0, asin="B999", parent_asin="P999", user_id="USER2",
             timestamp=1_588_690_000_000, verified_purchase=False))
    metadata = bronze_metadata(
        spark, dict(title="Test Gift Card", parent_asin="P001"),
        dict(title="Bad Price", average_rating=3.5, price="Not available", parent_asin="P999"))
    first, second = build_silver(reviews, metadata).orderBy("asin").collect()
    assert (first.review_title, first.review_text) == ("Great product", "Works as expected.")
    assert first.raw_timestamp == 1_588_687_728_923
    assert first.review_date == day("2020-05-05")
    assert (first.product_title, first.main_category) == ("Test Gift Card", "Gift Cards")
    assert (first.product_avg_rating, first.price) == (4.5, 19.99)
    assert len(first.review_id) == 64
    assert (second.product_title, second.price) == ("Bad Price", None)


def test_gold_tables(spark):
    rows = silver(
        spark,
        dict(rating=5.0), dict(rating=4.0, verified_purchase=False),
        dict(rating=3.0, review_date=day("2020-05-02")),
        dict(parent_asin="P2", rating=2.0, review_date=day("2020-05-02"),
             verified_purchase=False, price=9.99))
    bounds = ("2020-05-01", "2020-05-02")

    products = {(r.parent_asin, str(r.review_date)): r
                for r in gold.product_metrics(rows, *bounds).collect()}
    assert len(products) == 3
    p1, p1_next, p2 = (products[k] for k in (
        ("P1", "2020-05-01"), ("P1", "2020-05-02"), ("P2", "2020-05-02")))
    assert (p1.total_reviews, p1.average_rating, p1.rolling_30d_avg_rating) == (2, 4.5, 4.5)
    assert p1.avg_price == 19.99
    assert (p1_next.total_reviews, p1_next.average_rating) == (3, 4.0)
    assert p1_next.rolling_30d_avg_rating == 4.0
    assert (p2.total_reviews, p2.average_rating, p2.avg_price) == (1, 2.0, 9.99)

    days = {str(r.review_date): r for r in gold.category_trends(rows, *bounds).collect()}
    a, b = days["2020-05-01"], days["2020-05-02"]
    assert (a.daily_review_count, a.daily_avg_rating) == (2, 4.5)
    assert (a.count_5_star, a.count_4_star, a.count_1_star) == (1, 1, 0)
    assert (b.daily_review_count, b.daily_avg_rating) == (2, 2.5)
    assert (b.count_3_star, b.count_2_star) == (1, 1)

    split = {(str(r.review_date), r.verified_purchase): r
             for r in gold.verified_impact(rows, *bounds).collect()}
    assert split["2020-05-01", True].daily_review_count == 1
    assert [split[k].avg_rating for k in (
        ("2020-05-01", True), ("2020-05-01", False),
        ("2020-05-02", True), ("2020-05-02", False))] == [5.0, 4.0, 3.0, 2.0]
