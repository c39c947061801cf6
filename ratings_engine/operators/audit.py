"""Row counts per layer and what gets lost between layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratings_engine import schemas
from ratings_engine.sources import raw, storage, tables

# Fixed value: the audit takes the category from the file name, wherever the file lies.
FILE_CATEGORY_PATTERN = r"([^/\\]+)\.jsonl\.gz$"


def _by_category(df: DataFrame, *keys: str, count: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).orderBy(F.desc(count), *keys)


def raw_counts(spark: SparkSession, raw_root: str, one: str | None = None) -> DataFrame:
    """Lines per category (or of one) in the raw review files, blank and malformed ones included;
    no rows where there are no raw files."""
    if not storage.exists(spark, f"{raw_root}/reviews"):
        return spark.createDataFrame([], "category string, count long")
    lines = (spark.read.option("recursiveFileLookup", True)
             .option("pathGlobFilter", raw.RAW_GLOB).text(f"{raw_root}/reviews"))
    category = F.regexp_extract(F.col("_metadata.file_path"), FILE_CATEGORY_PATTERN, 1)
    counts = _by_category(lines.select(category.alias("category")), "category")
    return counts if one is None else counts.where(F.col("category") == one)


def rejected_counts(spark: SparkSession, raw_root: str) -> DataFrame:
    """Lines of the raw review files that are no JSON objects, per file."""
    lost = raw.unreadable_lines(spark, f"{raw_root}/reviews", schemas.REVIEW_RAW,
                                recursiveFileLookup=True, pathGlobFilter=raw.RAW_GLOB)
    return _by_category(lost, "file_path")


def unlabelled_files(spark: SparkSession, raw_root: str) -> DataFrame:
    """Raw review files whose path yields no category, so that Bronze leaves them out."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", raw.RAW_GLOB).load(f"{raw_root}/reviews"))
    return files.where(
        F.regexp_extract("path", raw.PATH_PATTERNS["reviews"], 1) == "").select("path", "length")


def bronze_counts(bronze: DataFrame) -> DataFrame:
    """Rows per category and batch."""
    return _by_category(bronze, "category", "ingestion_date")


def stored_counts(spark: SparkSession, root: str, category: str | None = None) -> DataFrame:
    """(layer, count) of the stored Bronze reviews and Silver; a layer that does not exist has 0."""
    counts = None
    for layer, path, table in (("bronze", f"{root}/bronze/reviews", schemas.BRONZE_REVIEWS_TABLE),
                               ("silver", f"{root}/silver/{schemas.SILVER_TABLE.name}", schemas.SILVER_TABLE)):
        rows = (tables.read_slice(spark, path, table, category) if storage.exists(spark, path)
                else spark.createDataFrame([], table.schema))
        one = rows.agg(F.count(F.lit(1)).alias("count")).select(F.lit(layer).alias("layer"), "count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def silver_counts(silver: DataFrame) -> DataFrame:
    """Rows per category."""
    return _by_category(silver, "category")


def gold_counts(spark: SparkSession, gold_root: str, category: str | None = None) -> DataFrame:
    """Rows per Gold table; a table that does not exist has 0."""
    counts = None
    for table in schemas.GOLD_TABLES:
        path = f"{gold_root}/{table.name}"
        if storage.exists(spark, path):
            rows = tables.read_slice(spark, path, table, category).agg(
                F.lit(table.name).alias("table_name"), F.count(F.lit(1)).alias("count"))
        else:
            rows = spark.range(1).select(F.lit(table.name).alias("table_name"),
                                         F.lit(0).cast("long").alias("count"))
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


def layer_dropoff(raw_by_category: DataFrame, bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Raw, Bronze and Silver rows per category and the losses between them.

    Takes the raw counts and the two tables; what is joined has one row per category."""
    layers = (raw_by_category.select("category", F.col("count").alias("raw_rows")),
              _by_category(bronze, "category", count="bronze_rows"),
              _by_category(silver, "category", count="silver_rows"))
    joined = layers[0].join(layers[1], "category", "full").join(layers[2], "category", "full")
    filled = joined.fillna(0, subset=["raw_rows", "bronze_rows", "silver_rows"])
    return filled.withColumns({
        "raw_to_bronze_drop": F.col("raw_rows") - F.col("bronze_rows"),
        "bronze_to_silver_drop": F.col("bronze_rows") - F.col("silver_rows")})
