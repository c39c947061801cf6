"""Test tables as engine inputs: every row of the bound tables is used.

reviews    one per lineitem row; returned items are delivered again in the next batch, with an
           edited text and one more vote, so a third of the keys has two copies
metadata   two batches per part, the older one without price; one product in ten is reviewed
           under an identifier that has no metadata
documents  review texts, with source as product and lang as category
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratings_engine import schemas
from ratings_engine.operators import gold
from ratings_engine.operators.silver import build_silver, is_small_enough
from ratings_engine.sources import storage


#: Raw folders that bound reviews are spread over.
RAW_SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name", "p_size")
    returned = F.col("l_returnflag") == "R"
    copies = F.explode(F.when(returned, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    delivered = table(spark, sf_dir, "lineitem").withColumn("copy", copies)
    line = F.col("l_linenumber")
    return delivered.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        (1 + (F.col("l_quantity").cast("int") - 1) % 5).cast("double").alias("rating"),
        F.concat(F.lit("t"), "l_linestatus").alias("title"),
        F.concat_ws(" ", "p_name", "l_returnflag", F.col("copy").cast("string")).alias("text"),
        F.concat(F.lit("A"), F.col("l_partkey").cast("string")).alias("asin"),
        F.concat(F.when(F.col("p_size") % 10 == 9, "N").otherwise("P"),
                 F.col("l_partkey").cast("string")).alias("parent_asin"),
        F.concat(F.lit("U"), F.col("l_suppkey").cast("string")).alias("user_id"),
        (F.unix_millis(F.col("l_shipdate").cast("timestamp")) + line * 3_600_123).alias("timestamp"),
        (line - 1 + F.col("copy")).cast("long").alias("helpful_vote"),
        F.when(line != 7, ~returned).alias("verified_purchase"),
        F.col("p_type").alias("category"),
        F.date_add(F.lit("2026-01-01").cast("date"),
                   (F.col("l_orderkey") % 3 + F.col("copy")).cast("int")).alias("ingestion_date"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    size = F.col("p_size")
    shown = (F.when(size % 7 == 0, "Not available")
             .when(size % 7 == 1, F.concat(F.lit("from "), size.cast("string"), F.lit(" to 99")))
             .when(size % 7 == 2, F.concat(F.lit("$1,"), price))
             .when(size % 7 == 3, "").when(size % 7 == 4, F.lit(None))
             .otherwise(F.concat(F.lit("$"), price)))
    batches = F.explode(F.array(F.lit(0), F.lit(1)))
    newest = F.col("batch") == 1
    return table(spark, sf_dir, "part").withColumn("batch", batches).select(
        F.col("p_type").alias("main_category"),
        F.when(newest, F.col("p_name")).otherwise(F.concat(F.lit("old "), "p_name")).alias("title"),
        (size % 5).cast("double").alias("average_rating"),
        size.cast("long").alias("rating_number"),
        F.when(newest, shown).alias("price"),
        F.col("p_brand").alias("store"),
        F.array("p_type", "p_brand").alias("categories"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("parent_asin"),
        F.col("p_type").alias("category"),
        F.date_add(F.lit("2026-01-01").cast("date"), F.col("batch")).alias("ingestion_date"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, reviews(spark, sf_dir))


def built(spark: SparkSession, sf_dir: str, some_reviews: DataFrame) -> DataFrame:
    """Silver rows of some reviews; the metadata has two rows per row of the part table."""
    small = is_small_enough(2 * storage.size_bytes(spark, f"{sf_dir}/part.parquet"))
    return build_silver(some_reviews, metadata(spark, sf_dir), small)


def product_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.product_metrics(silver(spark, sf_dir))


def category_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.category_trends(silver(spark, sf_dir))


def verified_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.verified_impact(silver(spark, sf_dir))


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("parent_asin"), F.col("lang").alias("category"),
        F.col("doc_id").cast("string").alias("review_id"),
        F.timestamp_seconds("doc_id").alias("review_timestamp"),
        (1 + F.col("n_chars") % 5).cast("double").alias("rating"),
        F.col("text").alias("review_text"))


def flagged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a document labelled toxic."""
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return (table(spark, sf_dir, "documents").join(toxic, "doc_id", "left_semi")
            .select(F.col("source").alias("parent_asin"), F.col("lang").alias("category")))


def flawed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows with the faults the checks look for."""
    votes = F.col("helpful_vote")
    return silver(spark, sf_dir).withColumns({
        "parent_asin": F.when(F.col("verified_purchase").isNull(), "").otherwise(F.col("parent_asin")),
        "rating": F.when(votes == 3, F.lit(None)).otherwise(F.col("rating") + (votes % 2)),
        "helpful_vote": votes - 1})


RAW_REVIEW_COLUMNS = schemas.REVIEW_RAW.names
RAW_METADATA_COLUMNS = schemas.METADATA_RAW.names
