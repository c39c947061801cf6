import datetime as dt
import random

import pandas as pd
import pytest
from tests.builders import category_trends, day, product_metrics, rows_of, verified_impact

from ratings_engine.operators import bi


def points(*series, **more):
    """Product rows from (product, date, rolling average)."""
    return [dict(parent_asin=p, review_date=day(d), rolling_30d_avg_rating=v, **more)
            for p, d, v in series]


def test_declining_needs_more_than_half_a_point_exactly_a_week_earlier(spark):
    got = bi.declining(product_metrics(spark, *points(
        ("edge", "2024-01-01", 4.0), ("edge", "2024-01-08", 3.5),
        ("down", "2024-01-01", 4.0), ("down", "2024-01-08", 3.4),
        ("early", "2024-01-01", 4.0), ("early", "2024-01-07", 1.0),
        ("back", "2024-01-01", 4.0), ("back", "2024-01-08", 1.0), ("back", "2024-01-09", 4.0),
        ("up", "2024-01-01", 1.0), ("up", "2024-01-08", 4.0))))
    assert [(r.parent_asin, round(r.rating_decline, 6)) for r in got.collect()] == [("down", 0.6)]


def random_metrics(spark, seed):
    rng = random.Random(seed)
    seen, rows = set(), []
    for _ in range(400):
        key = (rng.choice("XY"), f"P{rng.randint(0, 60)}", rng.randint(0, 20))
        if key not in seen:
            seen.add(key)
            rows.append(dict(category=key[0], parent_asin=key[1],
                             review_date=day("2024-01-01") + dt.timedelta(days=key[2]),
                             total_reviews=rng.randint(1, 500),
                             rolling_30d_avg_rating=rng.choice([None, 2.0, 3.0, 3.5, 4.0, 5.0]),
                             avg_price=rng.choice([None, 5.0, 10.0, 20.0, 40.0])))
    return product_metrics(spark, *rows), pd.DataFrame(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_value_for_money_against_counting(spark, seed):
    metrics, frame = random_metrics(spark, seed)
    got = {(r.category, r.parent_asin): r.value_score
           for r in bi.value_for_money(metrics, n=20).collect()}
    newest, want = {}, {}
    for row in frame.itertuples():
        key = (row.category, row.parent_asin)
        if key not in newest or newest[key].review_date < row.review_date:
            newest[key] = row

    def place(value, values):
        return (sum(v < value for v in values) + (1 + sum(v == value for v in values)) / 2) / len(values)

    for category in "XY":
        known = [r for r in newest.values() if r.category == category
                 and r.avg_price == r.avg_price and r.rolling_30d_avg_rating == r.rolling_30d_avg_rating]
        known = [r for r in known if sum((o.total_reviews, r.parent_asin) > (r.total_reviews, o.parent_asin)
                                         for o in known) < 20]
        ratings, prices = ([getattr(r, c) for r in known] for c in ("rolling_30d_avg_rating", "avg_price"))
        for r in known:
            want[category, r.parent_asin] = place(r.rolling_30d_avg_rating, ratings) - place(r.avg_price, prices)
    assert got == pytest.approx(want)
    best = bi.top_value(metrics, n=20, k=3).collect()
    for category in "XY":
        scores = sorted((v for k, v in want.items() if k[0] == category), reverse=True)[:3]
        assert sorted((r.value_score for r in best if r.category == category),
                      reverse=True) == pytest.approx(scores)


def test_product_without_latest_price_is_out(spark):
    rows = product_metrics(spark, dict(review_date=day("2024-01-01"), avg_price=3.0),
                           dict(review_date=day("2024-01-02"), avg_price=None))
    assert bi.value_for_money(rows).count() == 0


@pytest.mark.parametrize("seed", [3])
def test_declining_against_pandas(spark, seed):
    metrics, frame = random_metrics(spark, seed)
    want = []
    for (category, product), piece in frame.groupby(["category", "parent_asin"]):
        last = piece.loc[piece.review_date.idxmax()]
        before = piece[piece.review_date == last.review_date - dt.timedelta(days=7)]
        for value in before.rolling_30d_avg_rating:
            if value - last.rolling_30d_avg_rating > 0.5:
                want.append((category, product, value - last.rolling_30d_avg_rating))
    got = [(r.category, r.parent_asin, r.rating_decline) for r in bi.declining(metrics).collect()]
    assert sorted(got) == sorted(want) and want


def test_latest_and_top_products(spark):
    metrics = product_metrics(spark, *points(
        ("a", "2024-01-01", 5.0), ("a", "2024-01-02", 3.0), ("b", "2024-01-01", 4.0),
        ("c", "2024-01-03", 4.0), ("d", "2024-01-03", None)))
    assert rows_of(bi.latest_per_product(metrics).select("parent_asin", "rolling_30d_avg_rating")
                   ) == [("a", 3.0), ("b", 4.0), ("c", 4.0), ("d", None)]
    assert [r.parent_asin for r in bi.top_products(metrics, 2).collect()] == ["b", "c"]
    assert [r.parent_asin for r in bi.top_products(metrics, None).collect()] == ["b", "c", "a", "d"]


def test_leaderboard(spark):
    trends = category_trends(
        spark, dict(category="A", daily_review_count=1, daily_avg_rating=5.0),
        dict(category="A", review_date=day("2024-01-02"), daily_review_count=3, daily_avg_rating=1.0),
        dict(category="B", daily_review_count=2, daily_avg_rating=3.125),
        dict(category="Z", daily_review_count=0, daily_avg_rating=None))
    board = bi.leaderboard(trends, "2024-01-01", "2024-01-31")
    assert [tuple(r) for r in board.collect()] == [("A", 4, 2.0), ("B", 2, 3.125), ("Z", 0, None)]
    assert [tuple(r) for r in bi.ranked_leaderboard(board).orderBy("rank").collect()] == [
        (1, "A", 4, 2.0), (2, "B", 2, 3.12), (3, "Z", 0, None)]
    assert tuple(bi.leaderboard_summary(board).first()) == (3, 6, 2.56, "A", 2.0)


def test_ranges_and_catalog(spark):
    trends = category_trends(spark, dict(category="B"), dict(category="A"), dict(category=None),
                             dict(review_date=day("2024-01-15")))
    assert tuple(bi.catalog(trends).first()) == (["A", "B", "C"], day("2024-01-01"), day("2024-01-15"))
    assert tuple(bi.default_range(trends).first()) == (day("2024-01-01"), day("2024-01-15"))
    long = category_trends(spark, {}, dict(review_date=day("2024-05-31")))
    assert tuple(bi.default_range(long).first()) == (day("2024-05-01"), day("2024-05-31"))


def test_sentiment_drops_days_without_stars(spark):
    trends = category_trends(spark, dict(count_1_star=1, count_5_star=3),
                             dict(review_date=day("2024-01-02"), daily_review_count=2))
    assert [tuple(r)[2:] for r in bi.sentiment(trends).collect()] == [(25.0, 0.0, 0.0, 0.0, 75.0)]


def test_trust(spark):
    impact = verified_impact(
        spark, dict(avg_rating=5.0, daily_review_count=9),
        dict(avg_rating=3.0, review_date=day("2024-01-02")),
        dict(verified_purchase=False, avg_rating=1.0), dict(verified_purchase=None, avg_rating=2.0))
    assert bi.verified_uplift(impact).first().verified_uplift == 3.0
    assert rows_of(bi.trust_summary(impact)) == [
        ("C", "Non-Verified", 1.0, 1), ("C", "Verified", 4.0, 10)]
    assert bi.trust_trend(impact).count() == 3
    assert rows_of(bi.verified_on_date(impact, "2024-01-01")) == [
        ("C", "Non-Verified", 1, 1.0), ("C", "Verified", 9, 5.0)]


def test_overview(spark):
    got = bi.overview(
        category_trends(spark, dict(daily_review_count=2, daily_avg_rating=1.0),
                        dict(review_date=day("2024-01-02"), daily_review_count=3)),
        product_metrics(spark, *points(("a", "2024-01-01", None), ("c", "2024-01-01", 4.5),
                                       ("b", "2024-01-01", 4.5))),
        verified_impact(spark, dict(avg_rating=5.0), dict(verified_purchase=False)))
    assert [tuple(r) for r in got.collect()] == [("C", 4.0, 5, "b", 4.5, 1.0)]


def test_lag_decline_compares_consecutive_rows(spark):
    metrics = product_metrics(spark, *points(
        ("a", "2024-01-01", 5.0), ("a", "2024-01-20", 4.0), ("a", "2024-01-21", 4.5),
        ("b", "2024-01-01", 3.0), ("b", "2024-01-02", 1.0)))
    assert [(r.parent_asin, r.rating_decline) for r in bi.lag_decline(metrics).collect()] == [
        ("b", 2.0), ("a", 1.0)]
    assert [r.parent_asin for r in bi.lag_decline(metrics, n=1).collect()] == ["b"]
    assert [r.parent_asin for r in bi.lag_decline(metrics, "C", 12, today="2024-02-01").collect()] == []
    assert [r.parent_asin for r in bi.lag_decline(metrics, "C", 13, today="2024-02-01").collect()] == []
    assert [r.parent_asin for r in bi.lag_decline(metrics, "C", 31, today="2024-02-01").collect()] == ["b", "a"]
    assert bi.lag_decline(metrics, "other").count() == 0
    assert bi.declining_in_period(metrics, "C", "2024-01-02", "2024-01-31").count() == 0


def test_most_reviewed_counts_inside_the_period(spark):
    metrics = product_metrics(
        spark, dict(parent_asin="a", total_reviews=10),
        dict(parent_asin="a", review_date=day("2024-01-09"), total_reviews=12),
        dict(parent_asin="b", review_date=day("2024-01-10"), total_reviews=5),
        dict(parent_asin="b", review_date=day("2024-01-20"), total_reviews=50),
        dict(parent_asin="old", total_reviews=99))
    got = bi.most_reviewed(metrics, "2024-01-08", "2024-01-14").collect()
    assert [(r.parent_asin, r.reviews_in_period) for r in got] == [("b", 5), ("a", 2)]


def test_top_categories_by_rating(spark):
    trends = category_trends(spark, dict(category="A", daily_review_count=9, daily_avg_rating=3.0),
                             dict(category="B", daily_avg_rating=4.0))
    assert [r.category for r in bi.top_categories_by_rating(trends).collect()] == ["B", "A"]
