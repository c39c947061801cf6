"""Silver: keyed, deduplicated, typed and enriched reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratings_engine import schemas
from ratings_engine.functions import columns as fc

PRODUCT_KEY = ("parent_asin", "category")


def with_review_id(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "review_id", fc.review_id(F.col("user_id"), F.col("parent_asin"), F.col("timestamp")))


def with_event_time(df: DataFrame) -> DataFrame:
    """review_timestamp (whole seconds) and review_date in the session's time zone."""
    return (df.withColumn("review_timestamp", fc.epoch_ms_to_timestamp(F.col("timestamp")))
              .withColumn("review_date", F.to_date("review_timestamp")))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark keeps the best row per key of each task before the shuffle (window group limit), so
    a key with very many copies sends one row per task."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def newest_first(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Latest batch first, then every other column, so the surviving values do not depend on
    where a row was stored."""
    rest = sorted(c for c, kind in df.dtypes
                  if c not in keys and c != "ingestion_date" and not kind.startswith("map"))
    return [F.desc("ingestion_date"), *(F.asc(c) for c in rest)]


def prepare_metadata(metadata: DataFrame) -> DataFrame:
    """The joined product columns only, price parsed, one row per product: the newest batch's."""
    pruned = metadata.select(
        *PRODUCT_KEY, F.col("title").alias("product_title"), "main_category",
        F.col("average_rating").alias("product_avg_rating"),
        fc.parse_price(F.col("price")).alias("price"), "ingestion_date")
    newest = dedup_latest(pruned, PRODUCT_KEY, newest_first(pruned, PRODUCT_KEY))
    return newest.drop("ingestion_date")


def enrich(reviews: DataFrame, products: DataFrame, small_products: bool = False) -> DataFrame:
    """Left join with the product columns; a review without a product keeps nulls.

    small_products says that the caller has checked the size of the products (see
    is_small_enough): they are broadcast then. Otherwise it is a plain equi-join, in which adaptive
    execution splits the reviews of a product that has very many."""
    right = F.broadcast(products) if small_products else products
    return reviews.join(right, list(PRODUCT_KEY), "left")


# Stored size up to which product metadata is broadcast. Columnar files of titles and numbers
# grow a few times when read, so this stays within what one executor holds with ease.
BROADCAST_BYTES = 32 * 1024 * 1024


def is_small_enough(stored_bytes: int) -> bool:
    return stored_bytes <= BROADCAST_BYTES


# Product keys of a batch that travel to every task: their number and their bytes.
FEW_PRODUCTS = 500_000
FEW_PRODUCT_BYTES = 32 * 1024 * 1024


def of_reviewed_products(metadata: DataFrame, reviews: DataFrame, few: int = FEW_PRODUCTS) -> DataFrame:
    """The metadata rows of products that the reviews name; all rows where they name very many.

    The reviews' distinct keys are counted and sized first and broadcast only below both limits, so
    rows of other products never reach the shuffle of the metadata's own deduplication. Enrichment
    gives the same rows either way. A batch that names more products needs most of the metadata anyway."""
    named = reviews.select(*PRODUCT_KEY).where(
        F.col("parent_asin").isNotNull() & F.col("category").isNotNull()).distinct()
    found = named.limit(few + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(
        F.octet_length("parent_asin") + F.octet_length("category") + 32), F.lit(0)).alias("bytes")).first()
    if found.n > few or found.bytes > FEW_PRODUCT_BYTES:
        return metadata
    return metadata.join(F.broadcast(named), list(PRODUCT_KEY), "left_semi")


def unique_reviews(reviews: DataFrame) -> DataFrame:
    """One row per review id: the newest batch's.

    Rows are told apart by the text the id is a digest of. Neither moves: of a row whose parts say where
    that text joins them, these parts do, in columns of their own, and only other rows have the text."""
    parts = ("user_id", "parent_asin", "timestamp")
    clear = fc.is_clear_key(F.col("user_id"), F.col("parent_asin"), F.col("timestamp"))
    apart = (reviews.withColumn("_clear", clear)
             .withColumn("_key", F.when(~F.col("_clear"), fc.review_key(*(F.col(c) for c in parts))))
             .withColumns({f"_{c}": F.when(F.col("_clear"), F.col(c)) for c in parts})
             .withColumns({c: F.when(~F.col("_clear"), F.col(c)) for c in parts}).drop("_clear"))
    keys = [*(f"_{c}" for c in parts), "_key"]
    unique = dedup_latest(apart, keys, newest_first(apart, [*keys, "review_id"]))
    return unique.withColumns({c: F.coalesce(f"_{c}", c) for c in parts}).drop(*keys)


def build_silver(reviews: DataFrame, metadata: DataFrame,
                 small_metadata: bool = False) -> DataFrame:
    """Bronze reviews and metadata to the Silver columns. Duplicates go before the join.

    The id comes last: its 64 characters, which no codec shortens, would be half of what the shuffles move."""
    enriched = enrich(unique_reviews(reviews), prepare_metadata(metadata), small_metadata)
    return with_event_time(with_review_id(enriched)).withColumnsRenamed(
        {"title": "review_title", "text": "review_text", "timestamp": "raw_timestamp"}).select(
        *schemas.SILVER.names)
