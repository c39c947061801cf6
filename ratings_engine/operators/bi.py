"""Business questions over the Gold tables.

Every function takes whole tables or slices of them (see tables.read_slice) and answers for
all categories at once, one answer per category; a filter on category before or after gives a
single one. Ties are broken by product, so results are repeatable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratings_engine.functions import columns as fc
from ratings_engine.operators.gold import restrict

ROLLING = "rolling_30d_avg_rating"
STARS = tuple(f"count_{n}_star" for n in range(1, 6))

# Thresholds and sizes of the reports.
DEFAULT_RANGE_DAYS = 30
DECLINE_DAYS = 7
DECLINE_POINTS = 0.5
VALUE_PRODUCTS = 50
TOP_VALUE_PRODUCTS = 5
TOP_PRODUCTS = 10
# End of fixed values.


# --- categories -----------------------------------------------------------------------------

def catalog(trends: DataFrame) -> DataFrame:
    """One row: sorted known categories, first and last date."""
    return trends.agg(F.sort_array(F.collect_set("category")).alias("categories"),
                      F.min("review_date").alias("min_date"),
                      F.max("review_date").alias("max_date"))


def default_range(trends: DataFrame) -> DataFrame:
    """One row: the last 30 days of the data, not before its first day."""
    return (trends.agg(F.min("review_date").alias("min_date"), F.max("review_date").alias("end_date"))
            .select(F.greatest("min_date", F.date_sub("end_date", DEFAULT_RANGE_DAYS))
                    .alias("start_date"), "end_date"))


def leaderboard(trends: DataFrame, start=None, end=None) -> DataFrame:
    """Categories by number of reviews, with the review-weighted average rating."""
    total = F.sum("daily_review_count")
    weighted = F.sum(F.col("daily_review_count") * F.col("daily_avg_rating"))
    return (restrict(trends, start, end).groupBy("category")
            .agg(total.alias("total_reviews"),
                 F.try_divide(weighted, total).alias("weighted_avg_rating"))
            .orderBy(F.desc("total_reviews"), "category"))


def ranked_leaderboard(board: DataFrame) -> DataFrame:
    """Leaderboard with rank 1..n and the rating rounded half to even at two places.

    The window has no partition: it runs over one row per category."""
    order = Window.orderBy(F.desc("total_reviews"), "category")
    return board.select(F.row_number().over(order).alias("rank"), "category", "total_reviews",
                        F.bround("weighted_avg_rating", 2).alias("weighted_avg_rating"))


def leaderboard_summary(board: DataFrame) -> DataFrame:
    """One row: number of categories, reviews, plain mean of the rounded ratings, the leader."""
    leader = F.min_by(F.struct("category", "weighted_avg_rating"), "rank")
    return (ranked_leaderboard(board)
            .agg(F.count(F.lit(1)).alias("categories"), F.sum("total_reviews").alias("total_reviews"),
                 F.avg("weighted_avg_rating").alias("avg_rating"), leader.alias("leader"))
            .select("categories", "total_reviews", "avg_rating",
                    F.col("leader.category").alias("top_category"),
                    F.col("leader.weighted_avg_rating").alias("top_category_rating")))


def sentiment(trends: DataFrame) -> DataFrame:
    """Share of each star in percent per category and day; days without any star are left out."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in STARS), F.lit(0))
    return (trends.withColumn("total", total).where("total > 0")
            .select("category", "review_date",
                    *((100 * F.col(c) / F.col("total")).alias(f"{c}_pct") for c in STARS)))


def rating_trend(trends: DataFrame) -> DataFrame:
    """Daily average and number of reviews, in order of time."""
    return (trends.select("category", "review_date", "daily_avg_rating", "daily_review_count")
            .orderBy("category", "review_date"))


# --- products -------------------------------------------------------------------------------

def latest_per_product(metrics: DataFrame) -> DataFrame:
    """Each product's row with the greatest date.

    Only the best row of each product and task is shuffled (window group limit)."""
    recency = Window.partitionBy("parent_asin", "category").orderBy(F.desc("review_date"))
    return (metrics.withColumn("_position", F.row_number().over(recency))
            .where("_position = 1").drop("_position"))


def declining(metrics: DataFrame, days: int = DECLINE_DAYS,
              drop: float = DECLINE_POINTS) -> DataFrame:
    """Products whose latest rolling average lies more than `drop` below the one exactly
    `days` days earlier.

    The earlier row comes from a one-day range frame instead of a self-join: one shuffle and
    one sort, and at most one row per product and day in a group."""
    timeline = (Window.partitionBy("parent_asin", "category")
                .orderBy(F.unix_date("review_date")))
    earlier = F.first(ROLLING).over(timeline.rangeBetween(-days, -days))
    following = F.lead("review_date").over(timeline)
    return (metrics.select("parent_asin", "category", "review_date",
                           F.col(ROLLING).alias("current_rating"),
                           earlier.alias("prev_rating"), following.alias("_following"))
            .where("_following is null").drop("_following")
            .withColumn("rating_decline", F.col("prev_rating") - F.col("current_rating"))
            .where(F.col("rating_decline") > drop)
            .orderBy(F.desc("rating_decline"), "parent_asin", "category"))


def _first_per_category(df: DataFrame, n: int, *order: Column) -> DataFrame:
    position = F.row_number().over(Window.partitionBy("category").orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") <= n).drop("_position")


def _percent_rank(value: str) -> Column:
    """Average rank among equals divided by the number of rows, per category."""
    everyone = Window.partitionBy("category")
    below = F.rank().over(everyone.orderBy(value))
    equals = F.count(F.lit(1)).over(Window.partitionBy("category", value))
    return (below + (equals - 1) / 2) / F.count(F.lit(1)).over(everyone)


def value_for_money(metrics: DataFrame, n: int = VALUE_PRODUCTS) -> DataFrame:
    """The n most reviewed products per category with price and rating, scored by how far the
    rank of the rating exceeds the rank of the price.

    Latest rows first, then rows without price or rating go: a product whose latest row has no
    price is out even if an older row has one. The score windows see at most n rows."""
    priced = latest_per_product(metrics).dropna(subset=["avg_price", ROLLING])
    most_reviewed = _first_per_category(priced, n, F.desc("total_reviews"), F.asc("parent_asin"))
    return most_reviewed.withColumn(
        "value_score", _percent_rank(ROLLING) - _percent_rank("avg_price"))


def top_value(metrics: DataFrame, n: int = VALUE_PRODUCTS,
              k: int = TOP_VALUE_PRODUCTS) -> DataFrame:
    """The k best scores of value_for_money per category."""
    return _first_per_category(value_for_money(metrics, n), k,
                               F.desc("value_score"), F.asc("parent_asin"))


def top_products(metrics: DataFrame, n: int | None = TOP_PRODUCTS) -> DataFrame:
    """Latest rows by rolling average: the best n per category, or all of them for None."""
    latest = latest_per_product(metrics)
    order = [F.desc(ROLLING), F.asc("parent_asin")]
    if n is not None:
        latest = _first_per_category(latest, n, *order)
    return latest.select("parent_asin", "category", "review_date", "total_reviews",
                         "average_rating", ROLLING, "avg_price").orderBy("category", *order)


def lag_decline(metrics: DataFrame, category: str | None = None, days: int | None = None,
                n: int | None = None, today=None) -> DataFrame:
    """Rows whose rolling average fell against the product's previous row, steepest first: all of
    them, or the n steepest per category. category and days (back from today, by default the
    session's date) narrow the rows before they are compared."""
    if category is not None:
        metrics = metrics.where(F.col("category") == category)
    if days is not None:
        day = F.current_date() if today is None else F.lit(str(today)).cast("date")
        metrics = metrics.where(F.col("review_date") >= F.date_sub(day, days))
    timeline = Window.partitionBy("parent_asin", "category").orderBy("review_date")
    previous = F.lag(ROLLING).over(timeline)
    fallen = (metrics.select("parent_asin", "category", "review_date", ROLLING,
                             previous.alias("previous_rolling_avg"))
              .withColumn("rating_decline", F.col("previous_rolling_avg") - F.col(ROLLING))
              .where("rating_decline > 0"))
    order = [F.desc("rating_decline"), F.asc("parent_asin"), F.asc("review_date")]
    if n is not None:
        fallen = _first_per_category(fallen, n, *order)
    return fallen.orderBy(*order, "category")


# --- trust ----------------------------------------------------------------------------------

def verified_uplift(impact: DataFrame) -> DataFrame:
    """Mean of the daily averages of verified reviews minus that of the others, per category."""
    by_flag = impact.groupBy("category").agg(
        F.avg(F.when(F.col("verified_purchase"), F.col("avg_rating"))).alias("verified_avg"),
        F.avg(F.when(~F.col("verified_purchase"), F.col("avg_rating"))).alias("non_verified_avg"))
    return by_flag.withColumn("verified_uplift", F.col("verified_avg") - F.col("non_verified_avg"))


def trust_summary(impact: DataFrame) -> DataFrame:
    """Mean of the daily averages and number of reviews per segment; unknown flags are left out."""
    return (_labelled(impact).groupBy("category", "purchase_type")
            .agg(F.avg("avg_rating").alias("avg_rating"),
                 F.sum("daily_review_count").alias("daily_review_count")))


def trust_trend(impact: DataFrame) -> DataFrame:
    """Daily average per segment, in order of time."""
    return (_labelled(impact).select("category", "review_date", "purchase_type", "avg_rating")
            .orderBy("category", "review_date", "purchase_type"))


def _labelled(impact: DataFrame) -> DataFrame:
    return (impact.withColumn("purchase_type", fc.purchase_type(F.col("verified_purchase")))
            .where(F.col("purchase_type").isNotNull()))


# --- overview -------------------------------------------------------------------------------

def overview(trends: DataFrame, metrics: DataFrame, impact: DataFrame) -> DataFrame:
    """Per category: latest daily average, reviews, best product and verified uplift.

    Three aggregates down to one row per category, then joins of those."""
    volume = trends.groupBy("category").agg(
        F.max_by("daily_avg_rating", "review_date").alias("latest_daily_avg_rating"),
        F.sum("daily_review_count").alias("reviews_in_range"))
    best = _first_per_category(latest_per_product(metrics), 1,
                               F.desc(ROLLING), F.asc("parent_asin")).select(
        "category", F.col("parent_asin").alias("top_product"),
        F.col(ROLLING).alias("top_product_rating"))
    uplift = verified_uplift(impact).select("category", "verified_uplift")
    return volume.join(best, "category", "left").join(uplift, "category", "left")


# --- question templates ---------------------------------------------------------------------

def top_categories_by_rating(trends: DataFrame, start=None, end=None) -> DataFrame:
    """Categories by review-weighted average rating in a period, best first."""
    return leaderboard(trends, start, end).orderBy(F.desc("weighted_avg_rating"), "category")


def declining_in_period(metrics: DataFrame, category: str, start=None, end=None,
                        n: int | None = None) -> DataFrame:
    """lag_decline within one category and period."""
    return lag_decline(restrict(metrics, start, end), category, n=n)


def verified_on_date(impact: DataFrame, day) -> DataFrame:
    """Verified against non-verified reviews of one day, per category."""
    return _labelled(restrict(impact, day, day)).select(
        "category", "purchase_type", "daily_review_count", "avg_rating")


def verified_in_period(impact: DataFrame, start, end) -> DataFrame:
    """Verified against non-verified reviews of a period, per category: number of reviews and
    their average rating, the daily averages weighted by their reviews."""
    count = F.sum("daily_review_count")
    return (_labelled(restrict(impact, start, end)).groupBy("category", "purchase_type")
            .agg(count.alias("review_count"),
                 F.try_divide(F.sum(F.col("daily_review_count") * F.col("avg_rating")), count).alias("avg_rating")))


def most_reviewed(metrics: DataFrame, start, end, n: int | None = None) -> DataFrame:
    """Products by number of reviews in a period, from the running totals: the last total in
    the period minus the last one before it. `metrics` must reach back before the period.
    All products, or the n with most reviews per category."""
    day = F.col("review_date")
    inside = F.max(F.when(fc.date_between(day, start, end), F.col("total_reviews")))
    before = F.max(F.when(day < F.lit(start).cast("date"), F.col("total_reviews")))
    found = (restrict(metrics, None, end).groupBy("parent_asin", "category")
            .agg(inside.alias("_inside"), before.alias("_before"))
            .where("_inside is not null")
            .select("parent_asin", "category",
                    (F.col("_inside") - F.coalesce("_before", F.lit(0))).alias("reviews_in_period")))
    order = [F.desc("reviews_in_period"), F.asc("parent_asin")]
    if n is not None:
        found = _first_per_category(found, n, *order)
    return found.orderBy(*order, "category")
