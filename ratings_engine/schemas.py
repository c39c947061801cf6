"""Column contracts of every layer and the on-disk layout of the written tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql.types import ArrayType, StringType, StructType

from ratings_engine.functions import columns as fc


def _columns(*required: str, **types) -> StructType:
    schema = StructType()
    for name, kind in types.items():
        schema.add(name, kind, name not in required)
    return schema


# Names, order and types of the columns are the data contract.
REVIEW_RAW = _columns(
    rating="double", title="string", text="string", asin="string", parent_asin="string",
    user_id="string", timestamp="long", helpful_vote="long", verified_purchase="boolean",
)
METADATA_RAW = _columns(
    main_category="string", title="string", average_rating="double", rating_number="long",
    price="string", store="string", categories=ArrayType(StringType()), parent_asin="string",
)
SILVER = _columns(
    "review_id",
    review_id="string", user_id="string", asin="string", parent_asin="string", rating="double",
    review_title="string", review_text="string", raw_timestamp="long",
    review_timestamp="timestamp", review_date="date", helpful_vote="long",
    verified_purchase="boolean", category="string", ingestion_date="date",
    product_title="string", main_category="string", product_avg_rating="double", price="double",
)
PRODUCT_METRICS = _columns(
    parent_asin="string", category="string", review_date="date", total_reviews="long",
    average_rating="double", rolling_30d_avg_rating="double", avg_price="double",
)
CATEGORY_TRENDS = _columns(
    category="string", review_date="date", daily_review_count="long", daily_avg_rating="double",
    count_1_star="long", count_2_star="long", count_3_star="long", count_4_star="long",
    count_5_star="long",
)
VERIFIED_IMPACT = _columns(
    category="string", review_date="date", verified_purchase="boolean",
    daily_review_count="long", avg_rating="double",
)
ROLLING_DAYS = 30
# End of fixed values.

# What a refresh carries on from: the sums of a product's day and its totals up to that day.
PRODUCT_DAILY = _columns(
    parent_asin="string", category="string", review_date="date", daily_review_count="long",
    daily_rating_sum="double", daily_avg_price="double", total_reviews="long",
    total_rating_sum="double",
)


def with_batch_columns(raw: StructType) -> StructType:
    """Bronze columns: the raw ones plus the batch label."""
    schema = StructType(list(raw.fields))
    return schema.add("category", "string").add("ingestion_date", "date")


BRONZE_REVIEWS = with_batch_columns(REVIEW_RAW)
BRONZE_METADATA = with_batch_columns(METADATA_RAW)

# Integer partition columns derived from review_date, coarser than a day so that a
# partition holds files of useful size.
DATE_BUCKETS = {
    "year": "year({0})",
    "year_month": "year({0}) * 100 + month({0})",
}
# How long a bucket is, as date_trunc() and make intervals name it.
BUCKET_UNITS = {"year": "year", "year_month": "month"}
# Integer partition column derived from the key: an upsert looks for a key in its own bucket only.
KEY_BUCKET = "key_bucket"


@dataclass(frozen=True)
class Table:
    """A written table: its columns, its key and the columns its folders are named by."""

    name: str
    schema: StructType
    keys: tuple[str, ...]
    partition_by: tuple[str, ...]
    # Partition columns whose value follows from the key, so a matching row can only lie in
    # the same value of them.
    fixed_by_key: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    # Columns that hold hex digests.
    digests: tuple[str, ...] = ()
    # Columns that as a rule follow from others: name, the others and how. No such column is among the others.
    derived: tuple[tuple[str, tuple[str, ...], Callable[..., Column]], ...] = ()
    # Into how many folders keys are hashed, 0 for none; fixed once a table is written.
    key_buckets: int = 0

    @property
    def bucket(self) -> str | None:
        return next((c for c in self.partition_by if c in DATE_BUCKETS), None)

    @property
    def stored_schema(self) -> StructType:
        schema = StructType(list(self.schema.fields))
        if self.bucket:
            schema.add(self.bucket, "integer")
        return schema.add(KEY_BUCKET, "integer") if self.key_buckets else schema


BRONZE_REVIEWS_TABLE = Table("reviews", BRONZE_REVIEWS, (), ("category", "ingestion_date"))
BRONZE_METADATA_TABLE = Table("metadata", BRONZE_METADATA, (), ("category", "ingestion_date"))
# The review key hashes the timestamp, hence fixes the year but not the category.
SILVER_TABLE = Table(
    "reviews", SILVER, ("review_id",), ("category", "year", KEY_BUCKET), ("year", KEY_BUCKET),
    digests=("review_id",), key_buckets=4,
    derived=(("review_id", ("user_id", "parent_asin", "raw_timestamp"), fc.review_id),
             ("review_timestamp", ("raw_timestamp",), fc.epoch_ms_to_timestamp),
             ("review_date", ("raw_timestamp",), fc.epoch_ms_to_date)),
)
PRODUCT_METRICS_TABLE = Table(
    "product_metrics", PRODUCT_METRICS, ("parent_asin", "category", "review_date"),
    ("category", "year_month"), ("category", "year_month"), ("parent_asin",),
)
CATEGORY_TRENDS_TABLE = Table(
    "category_trends", CATEGORY_TRENDS, ("category", "review_date"),
    ("category", "year"), ("category", "year"),
)
VERIFIED_IMPACT_TABLE = Table(
    "verified_purchase_impact", VERIFIED_IMPACT,
    ("category", "review_date", "verified_purchase"),
    ("category", "year"), ("category", "year"), ("verified_purchase",),
)
PRODUCT_DAILY_TABLE = Table(
    "product_daily", PRODUCT_DAILY, ("parent_asin", "category", "review_date"),
    ("category", "year"), ("category", "year"), ("parent_asin",),
)
GOLD_TABLES = (PRODUCT_METRICS_TABLE, CATEGORY_TRENDS_TABLE, VERIFIED_IMPACT_TABLE)
