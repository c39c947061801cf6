import datetime as dt
import random

import pytest
from tests.builders import day, silver

from ratings_engine.operators import gold


def test_rolling_window_counts_calendar_days(spark):
    rows = silver(
        spark,
        dict(review_date=day("2024-01-01"), rating=1.0, price=10.0),
        dict(review_date=day("2024-01-01"), rating=1.0, price=10.0),
        dict(review_date=day("2024-01-30"), rating=4.0, price=None),
        dict(review_date=day("2024-01-31"), rating=5.0, price=None))
    got = [(str(r.review_date), r.rolling_30d_avg_rating, r.avg_price, r.total_reviews)
           for r in gold.product_metrics(rows).orderBy("review_date").collect()]
    # 01-30 still sees 01-01; 01-31 does not, and has no price within its window.
    assert got == [("2024-01-01", 1.0, 10.0, 2), ("2024-01-30", 2.0, 10.0, 3),
                   ("2024-01-31", 4.5, None, 4)]


def test_output_range_is_applied_after_the_windows(spark):
    rows = silver(spark, dict(review_date=day("2024-01-01"), rating=1.0),
                  dict(review_date=day("2024-01-10"), rating=5.0))
    got = gold.product_metrics(rows, "2024-01-05", "2024-01-31").collect()
    assert [(r.total_reviews, r.rolling_30d_avg_rating) for r in got] == [(2, 3.0)]


def test_histogram_rounds_half_up_and_ignores_what_is_no_star(spark):
    ratings = (0.4, 1.5, 2.5, 5.4, 6.0, None)
    row = gold.category_trends(silver(spark, *(dict(rating=r) for r in ratings))).first()
    assert [row[f"count_{n}_star"] for n in range(1, 6)] == [0, 1, 1, 0, 1]
    assert row.daily_review_count == 6


def test_unknown_flag_is_a_group(spark):
    rows = silver(spark, *(dict(verified_purchase=v) for v in (True, False, None, None)))
    got = {r.verified_purchase: r.daily_review_count for r in gold.verified_impact(rows).collect()}
    assert got == {True: 1, False: 1, None: 2}


def test_recompute_window(spark):
    rows = silver(spark, dict(review_date=day("2024-03-01")), dict(review_date=day("2024-03-05")),
                  dict(review_date=None))
    window = gold.recompute_window(rows).first()
    assert (window.source_start, window.output_start, window.output_end) == (
        day("2024-02-01"), day("2024-03-01"), day("2024-03-05"))


def test_touched_categories(spark):
    rows = silver(spark, *(dict(category=c) for c in ("A", "B", "A", None)))
    assert sorted(r[0] for r in gold.touched_categories(rows).collect()) == ["A", "B"]


@pytest.mark.parametrize("seed", [1, 2])
def test_metrics_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [dict(parent_asin=rng.choice("PQ"), rating=float(rng.randint(1, 5)),
                 price=rng.choice([None, 1.0, 2.0]),
                 review_date=day("2024-01-01") + dt.timedelta(days=rng.randint(0, 90)))
            for _ in range(150)]
    for got in gold.product_metrics(silver(spark, *rows)).collect():
        mine = [r for r in rows if r["parent_asin"] == got.parent_asin
                and r["review_date"] <= got.review_date]
        recent = [r for r in mine if (got.review_date - r["review_date"]).days < 30]
        assert got.total_reviews == len(mine)
        assert got.average_rating == sum(r["rating"] for r in mine) / len(mine)
        assert got.rolling_30d_avg_rating == sum(r["rating"] for r in recent) / len(recent)
        priced = [r for r in recent if r["price"] is not None]
        last = max((r["review_date"] for r in priced), default=None)
        prices = [r["price"] for r in priced if r["review_date"] == last]
        assert got.avg_price == (pytest.approx(sum(prices) / len(prices)) if prices else None)


def test_consistency_between_tables(spark):
    rng = random.Random(3)
    rows = silver(spark, *(dict(rating=rng.choice([None, 0.0, 1.0, 3.0, 5.0, 9.0]),
                                verified_purchase=rng.choice([True, False, None]),
                                review_date=day("2024-01-01") + dt.timedelta(days=i % 7))
                           for i in range(80)))
    by_day = {}
    for r in gold.verified_impact(rows).collect():
        by_day[r.review_date] = by_day.get(r.review_date, 0) + r.daily_review_count
    for r in gold.category_trends(rows).collect():
        assert by_day[r.review_date] == r.daily_review_count
        assert sum(r[f"count_{n}_star"] for n in range(1, 6)) <= r.daily_review_count
