"""Small frames in the shape of the layers."""

from __future__ import annotations

import datetime as dt

from ratings_engine import schemas


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


def bronze_reviews(spark, *rows):
    base = dict(rating=5.0, title="t", text="x", asin="A1", parent_asin="P1", user_id="U1",
                timestamp=1_588_687_728_923, helpful_vote=0, verified_purchase=True,
                category="Gift_Cards", ingestion_date=day("2026-03-08"))
    return _frame(spark, schemas.BRONZE_REVIEWS, base, rows)


def bronze_metadata(spark, *rows):
    base = dict(main_category="Gift Cards", title="Card", average_rating=4.5, rating_number=100,
                price="$19.99", store="S", categories=["Gift Cards"], parent_asin="P1",
                category="Gift_Cards", ingestion_date=day("2026-03-08"))
    return _frame(spark, schemas.BRONZE_METADATA, base, rows)


def silver(spark, *rows):
    base = dict(review_id="R", user_id="U", asin="A1", parent_asin="P1", rating=5.0,
                review_title="t", review_text="x", raw_timestamp=1, review_timestamp=None,
                review_date=day("2020-05-01"), helpful_vote=0, verified_purchase=True,
                category="Gift_Cards", ingestion_date=day("2026-03-08"), product_title="Prod",
                main_category="Gift Cards", product_avg_rating=4.5, price=19.99)
    numbered = [{"review_id": f"R{i}", **r} for i, r in enumerate(rows)]
    return _frame(spark, schemas.SILVER, base, numbered)


def product_metrics(spark, *rows):
    base = dict(parent_asin="P1", category="C", review_date=day("2024-01-01"), total_reviews=1,
                average_rating=4.0, rolling_30d_avg_rating=4.0, avg_price=10.0)
    return _frame(spark, schemas.PRODUCT_METRICS, base, rows)


def category_trends(spark, *rows):
    base = dict(category="C", review_date=day("2024-01-01"), daily_review_count=1,
                daily_avg_rating=4.0, count_1_star=0, count_2_star=0, count_3_star=0,
                count_4_star=0, count_5_star=0)
    return _frame(spark, schemas.CATEGORY_TRENDS, base, rows)


def verified_impact(spark, *rows):
    base = dict(category="C", review_date=day("2024-01-01"), verified_purchase=True,
                daily_review_count=1, avg_rating=4.0)
    return _frame(spark, schemas.VERIFIED_IMPACT, base, rows)


def _frame(spark, schema, base, rows):
    full = [{**base, **r} for r in rows]
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in full], schema)


def rows_of(df):
    """Rows as a sorted list of tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
