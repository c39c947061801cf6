"""Recent review texts of many products, one text block per product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratings_engine.functions import columns as fc

# Sizes and layout of a block.
NEWEST_REVIEWS = 50
EXCERPT_CHARS = 500
SHOWN_REVIEWS = 30
ELLIPSIS = "..."
BLOCK_SEPARATOR = "\n\n---\n\n"
# End of fixed values.

PRODUCT_KEY = ("parent_asin", "category")


def excerpt(text, chars: int = EXCERPT_CHARS):
    """Text without edge white space, cut to `chars` characters."""
    bare = fc.strip(F.coalesce(text, F.lit("")))
    return F.when(F.length(bare) > chars,
                  F.concat(F.substring(bare, 1, chars), F.lit(ELLIPSIS))).otherwise(bare)


def review_bundle(silver: DataFrame, products: DataFrame, n: int = NEWEST_REVIEWS,
                  chars: int = EXCERPT_CHARS, keep: int = SHOWN_REVIEWS) -> DataFrame:
    """Per product: its newest n reviews, of those the first `keep` with text, as one block.

    Excerpts are taken where the text is read, so full texts are never shuffled. Ranking comes
    first: each task passes on at most n rows per product (window group limit), so no product is
    hot in the semi-join that follows on the same key. Spark moves that join below the ranking
    when the products are few enough to broadcast."""
    reviews = silver.select(*PRODUCT_KEY, "review_id", "review_timestamp", "rating",
                            excerpt(F.col("review_text"), chars).alias("_excerpt"))
    recency = (Window.partitionBy(*PRODUCT_KEY)
               .orderBy(F.desc("review_timestamp"), F.asc("review_id")))
    newest = (reviews.withColumn("_age", F.row_number().over(recency)).where(F.col("_age") <= n)
              .join(products.select(*PRODUCT_KEY).distinct(), list(PRODUCT_KEY), "left_semi")
              .where("_excerpt <> ''"))
    shown = (newest.withColumn(
                 "_place", F.row_number().over(Window.partitionBy(*PRODUCT_KEY).orderBy("_age")))
             .where(F.col("_place") <= keep))
    rating = F.coalesce(F.col("rating").cast("string"), F.lit("None"))
    line = F.concat(F.lit("[Rating: "), rating, F.lit("] "), F.col("_excerpt"))
    ordered = F.array_sort(F.collect_list(F.struct("_place", line.alias("line"))))
    return shown.groupBy(*PRODUCT_KEY).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.array_join(ordered["line"], BLOCK_SEPARATOR).alias("reviews_block"))
