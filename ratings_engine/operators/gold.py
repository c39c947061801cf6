"""Gold: daily product, category and trust metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratings_engine import schemas
from ratings_engine.functions import columns as fc
from ratings_engine.schemas import ROLLING_DAYS

# The columns Gold reads; everything else, the texts above all, is never scanned.
GOLD_INPUT = ("parent_asin", "category", "review_date", "rating", "price", "verified_purchase")


def restrict(df: DataFrame, start=None, end=None) -> DataFrame:
    """Rows with review_date in [start, end]; None leaves a side open."""
    if start is None and end is None:
        return df
    return df.where(fc.date_between(F.col("review_date"), start, end))


def recompute_window(batch: DataFrame, days: int = ROLLING_DAYS) -> DataFrame:
    """One row: the dates a batch touches and where the look-back for them starts."""
    return (batch.agg(F.min("review_date").alias("output_start"),
                      F.max("review_date").alias("output_end"))
            .withColumn("source_start", F.date_sub("output_start", days - 1)))


def daily_product(silver: DataFrame) -> DataFrame:
    """Reviews, rating sum and mean price per product and day; combined before the shuffle."""
    return silver.groupBy("parent_asin", "category", "review_date").agg(
        F.count(F.lit(1)).alias("daily_review_count"),
        F.sum("rating").alias("daily_rating_sum"),
        F.avg("price").alias("daily_avg_price"))


def star_counts(silver: DataFrame) -> DataFrame:
    """One row per product, day, verified flag and star: the sums all Gold tables are made of.

    Read Silver once for this; daily_from(), trends_from() and impact_from() need no other rows."""
    return silver.groupBy("parent_asin", "category", "review_date", "verified_purchase",
                          fc.star(F.col("rating")).alias("star")).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count("rating").alias("rated"), F.sum("rating").alias("rating_sum"),
        F.count("price").alias("priced"), F.sum("price").alias("price_sum"))


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def daily_from(sums: DataFrame) -> DataFrame:
    """daily_product() from star_counts()."""
    return sums.groupBy("parent_asin", "category", "review_date").agg(
        F.sum("reviews").alias("daily_review_count"), F.sum("rating_sum").alias("daily_rating_sum"),
        _mean("price_sum", "priced").alias("daily_avg_price"))


def trends_from(sums: DataFrame) -> DataFrame:
    """category_trends() from star_counts()."""
    counts = (F.coalesce(F.sum(F.when(F.col("star") == n, F.col("reviews"))), F.lit(0)).alias(f"count_{n}_star")
              for n in range(1, 6))
    return sums.groupBy("category", "review_date").agg(
        F.sum("reviews").alias("daily_review_count"), _mean("rating_sum", "rated").alias("daily_avg_rating"),
        *counts).select(*schemas.CATEGORY_TRENDS.names)


def impact_from(sums: DataFrame) -> DataFrame:
    """verified_impact() from star_counts()."""
    return sums.groupBy("category", "review_date", "verified_purchase").agg(
        F.sum("reviews").alias("daily_review_count"), _mean("rating_sum", "rated").alias("avg_rating"),
    ).select(*schemas.VERIFIED_IMPACT.names)


def _by_day():
    return Window.partitionBy("parent_asin", "category").orderBy("_day")


def _cumulative() -> dict[str, Column]:
    so_far = _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reviews, ratings = F.sum("daily_review_count").over(so_far), F.sum("daily_rating_sum").over(so_far)
    return {"total_reviews": reviews, "total_rating_sum": ratings,
            "average_rating": ratings / reviews}


def _rolling(days: int) -> dict[str, Column]:
    recent = _by_day().rangeBetween(1 - days, 0)
    return {f"rolling_{days}d_avg_rating":
            F.sum("daily_rating_sum").over(recent) / F.sum("daily_review_count").over(recent)}


def _last_price(days: int) -> dict[str, Column]:
    recent = _by_day().rangeBetween(1 - days, 0)
    return {"avg_price": F.last("daily_avg_price", ignorenulls=True).over(recent)}


def _over_days(daily: DataFrame, *columns: dict[str, Column]) -> DataFrame:
    """Add window columns that all order by one day number, so Spark sorts once for them."""
    wanted = {name: column for group in columns for name, column in group.items()}
    return (daily.withColumn("_day", F.unix_date("review_date"))
            .withColumns(wanted).drop("_day"))


def cumulative(daily: DataFrame) -> DataFrame:
    """Running review count and running average rating."""
    return _over_days(daily, _cumulative()).drop("total_rating_sum")


def rolling(daily: DataFrame, days: int = ROLLING_DAYS) -> DataFrame:
    """Average rating over the last calendar days, today included, each review counting once."""
    return _over_days(daily, _rolling(days))


def last_price(daily: DataFrame, days: int = ROLLING_DAYS) -> DataFrame:
    """Latest known daily price within the last calendar days."""
    return _over_days(daily, _last_price(days))


def over_days(daily: DataFrame) -> DataFrame:
    """daily_product() with totals, rolling averages and last prices."""
    return _over_days(daily, _cumulative(), _rolling(ROLLING_DAYS), _last_price(ROLLING_DAYS))


def metrics_from_daily(daily: DataFrame, start=None, end=None) -> DataFrame:
    """Cumulative and rolling metrics of daily_product(), restricted after the windows."""
    return restrict(over_days(daily), start, end).select(*schemas.PRODUCT_METRICS.names)


def product_metrics(silver: DataFrame, start=None, end=None) -> DataFrame:
    """Cumulative and rolling metrics per product and day.

    The output range applies after the windows; the caller supplies the look-back rows.
    All windows share one shuffle and one sort over one row per product and day, so even a
    product with a third of all reviews gives a task no more rows than it has days."""
    return metrics_from_daily(daily_product(silver), start, end)


def category_trends(silver: DataFrame, start=None, end=None) -> DataFrame:
    """Daily count, average and star histogram per category."""
    stars = fc.star(F.col("rating"))
    return (restrict(silver, start, end).groupBy("category", "review_date").agg(
        F.count(F.lit(1)).alias("daily_review_count"),
        F.avg("rating").alias("daily_avg_rating"),
        *(F.count_if(stars == n).alias(f"count_{n}_star") for n in range(1, 6)))
        .select(*schemas.CATEGORY_TRENDS.names))


def verified_impact(silver: DataFrame, start=None, end=None) -> DataFrame:
    """Daily count and average by verified flag; an unknown flag is a group of its own."""
    return (restrict(silver, start, end).groupBy("category", "review_date", "verified_purchase")
            .agg(F.count(F.lit(1)).alias("daily_review_count"),
                 F.avg("rating").alias("avg_rating"))
            .select(*schemas.VERIFIED_IMPACT.names))


def touched_categories(silver: DataFrame) -> DataFrame:
    """Distinct known categories of a batch."""
    return silver.where(F.col("category").isNotNull()).select("category").distinct()
