"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import bindings as b
from harness.rawfiles import json_lines, write_lines
from ratings_engine import schemas
from ratings_engine.operators import audit, bi, carry, gold, quality, upsert
from ratings_engine.operators import silver as sv
from ratings_engine.operators.bundle import review_bundle
from ratings_engine.plans import medallion, sqlsurface
from ratings_engine.sources import legacy, raw, storage, tables

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Averages of prices and of averages depend on the order of addition in the last digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _scratch(spark: SparkSession) -> str:
    return storage.scratch_path(spark, "query")


def _built_once(spark, sf_dir, *columns):
    """Some columns of Silver, written once: what reads them several times builds Silver once."""
    return _staged(spark, sf_dir, *columns)[0]


def _staged(spark, sf_dir, *columns):
    """The same and its folder, for what is done with the rows before it returns."""
    return storage.stage(b.silver(spark, sf_dir).select(*columns), "silver")


def _comparable(silver: DataFrame) -> DataFrame:
    return silver.withColumn("review_timestamp", F.col("review_timestamp").cast("timestamp_ntz"))


# --- sources and sinks ----------------------------------------------------------------------

@query
def src_read_jsonl(spark, sf_dir):
    path = _scratch(spark)
    (b.reviews(spark, sf_dir).select(*b.RAW_REVIEW_COLUMNS)
     .write.option("compression", "gzip").json(path))
    return raw.read_jsonl(spark, path, schemas.REVIEW_RAW)


@query
def src_bulk_scan(spark, sf_dir):
    path = _scratch(spark)
    write_lines(json_lines(b.metadata(spark, sf_dir), b.RAW_METADATA_COLUMNS), path, "metadata",
                b.RAW_SHARDS, "meta_")
    return (raw.read_jsonl_tree(spark, path, schemas.METADATA_RAW)
            .withColumn("categories", F.array_join("categories", "|")))


@query
def src_category_from_path(spark, sf_dir):
    path = _scratch(spark)
    write_lines(json_lines(b.reviews(spark, sf_dir), b.RAW_REVIEW_COLUMNS), path, "reviews",
                b.RAW_SHARDS)
    return raw.with_category_from_path(
        raw.read_jsonl_tree(spark, path, schemas.REVIEW_RAW), "reviews")


@query
def src_batch_label(spark, sf_dir):
    rows = b.reviews(spark, sf_dir).select(*b.RAW_REVIEW_COLUMNS)
    return raw.with_batch(rows, "Everything", "2026-02-01")


@query
def sink_dynamic_overwrite(spark, sf_dir):
    path, rows = _scratch(spark), b.reviews(spark, sf_dir)
    tables.write_partitions(rows, path, ["category", "ingestion_date"])
    second = rows.where("ingestion_date = date'2026-01-02'").withColumn(
        "helpful_vote", F.col("helpful_vote") + 100)
    tables.write_partitions(second, path, ["category", "ingestion_date"])
    return tables.open_table(spark, path, schemas.BRONZE_REVIEWS_TABLE)


@query
def sink_append(spark, sf_dir):
    path, rows = _scratch(spark), b.reviews(spark, sf_dir)
    tables.append_partitions(rows, path, ["category", "ingestion_date"])
    tables.append_partitions(rows.where("ingestion_date = date'2026-01-02'"), path,
                             ["category", "ingestion_date"])
    return tables.open_table(spark, path, schemas.BRONZE_REVIEWS_TABLE)


@query
def src_slice(spark, sf_dir):
    path = _scratch(spark)
    rows = tables.with_bucket(b.silver(spark, sf_dir), schemas.SILVER_TABLE)
    table = schemas.SILVER_TABLE
    tables.write_partitions(tables.compact_output(rows, ["category", "year"], table.digests,
                                                  tables.derived_columns(rows, table)), path, ["category", "year"])
    return _comparable(tables.read_slice(spark, path, schemas.SILVER_TABLE, "ECONOMY",
                                         "1996-03-01", "1999-08-31"))


def _mixed_review_lines(spark, sf_dir):
    """Returned items as Python literals, accepted ones as older JSON, the rest as current JSON."""
    rows = b.table(spark, sf_dir, "lineitem")
    seconds = F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))
    part = F.concat(F.lit("A"), F.col("l_partkey").cast("string"))
    user = F.concat(F.lit("U"), F.col("l_suppkey").cast("string"))
    line = F.col("l_linenumber")
    text = F.concat(F.lit("None of it\\'s \"True\" "), F.col("l_quantity").cast("string"))
    literal = F.concat(
        F.lit("{'overall': "), F.col("l_quantity").cast("string"), F.lit(", 'summary': None, "
              "'reviewText': '"), text, F.lit("', 'asin': '"), part, F.lit("', 'reviewerID': u'"),
        user, F.lit("', 'unixReviewTime': "), seconds.cast("string"), F.lit(", 'helpful': ["),
        line.cast("string"), F.lit(", 9], 'verified_purchase': True}"))
    older = F.to_json(F.struct(
        F.col("l_quantity").alias("overall"), F.col("l_linestatus").alias("summary"),
        part.alias("asin"), F.lit("").alias("parent_asin"), user.alias("user_id"),
        seconds.alias("timestamp"), line.alias("helpful_vote")))
    current = F.to_json(F.struct(
        F.col("l_quantity").alias("rating"), F.col("l_linestatus").alias("title"),
        F.lit("plain").alias("text"), part.alias("asin"), part.alias("parent_asin"),
        user.alias("user_id"), (seconds * 1000).alias("timestamp"),
        line.alias("helpful_vote"), (line > 3).alias("verified_purchase")))
    flag = F.col("l_returnflag")
    return rows.select(F.when(flag == "R", literal).when(flag == "A", older)
                       .otherwise(current).alias("line"), flag.alias("flag"), (line == 2).alias("many"),
                       F.floor(F.col("l_orderkey") / 4096).alias("shelf"))


@query
def src_legacy_reviews(spark, sf_dir):
    path = _scratch(spark)
    _mixed_review_lines(spark, sf_dir).select("line").write.option("compression", "gzip").text(path)
    return legacy.normalize_reviews(legacy.read_raw_any(spark, path, legacy.REVIEW_FIELDS))


@query
def src_legacy_metadata(spark, sf_dir):
    path, size = _scratch(spark), F.col("p_size")
    nested = F.to_json(F.struct(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("asin"),
        F.col("p_name").alias("title"), (size % 6).alias("avg_rating"), size.alias("num_reviews"),
        F.col("p_retailprice").alias("price"),
        F.array(F.array("p_type", "p_brand"), F.array("p_brand")).alias("categories")))
    current = F.to_json(F.struct(
        F.lit("Current").alias("main_category"), F.col("p_name").alias("title"),
        (size % 6).alias("average_rating"), size.alias("rating_number"),
        F.array("p_brand").alias("categories"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("parent_asin")))
    (b.table(spark, sf_dir, "part").select(F.when(size % 2 == 0, nested).otherwise(current))
     .write.option("compression", "gzip").text(path))
    records = legacy.read_raw_any(spark, path, legacy.METADATA_FIELDS)
    return legacy.normalize_metadata(records).withColumn(
        "categories", F.array_join("categories", "|"))


@query
def src_corrupt_dropped(spark, sf_dir):
    path, line = _scratch(spark), F.to_json(F.struct(*b.RAW_REVIEW_COLUMNS))
    broken = F.when(F.col("text").contains(" R "), F.concat(F.lit("#"), line)).otherwise(line)
    b.reviews(spark, sf_dir).select(broken).write.option("compression", "gzip").text(path)
    return raw.read_jsonl(spark, path, schemas.REVIEW_RAW)


@query
def src_cap_per_category(spark, sf_dir):
    rows = b.reviews(spark, sf_dir)
    return legacy.cap_per_category(rows, legacy.ROWS_PER_CATEGORY, "timestamp", [
        F.asc(c) for c in rows.columns if c != "timestamp"])


# --- Silver ---------------------------------------------------------------------------------

@query
def silver_review_id(spark, sf_dir):
    return sv.with_review_id(b.reviews(spark, sf_dir)).select(
        "review_id", "user_id", "parent_asin", "timestamp")


@query
def silver_event_time(spark, sf_dir):
    return _comparable(sv.with_event_time(b.reviews(spark, sf_dir))).select(
        "user_id", "asin", "timestamp", "review_timestamp", "review_date")


@query
def silver_dedup(spark, sf_dir):
    keyed = sv.with_review_id(b.reviews(spark, sf_dir))
    return sv.dedup_latest(keyed, ["review_id"], sv.newest_first(keyed, ["review_id"]))


@query
def silver_price_parse(spark, sf_dir):
    return sv.prepare_metadata(b.metadata(spark, sf_dir))


@query
def silver_enrich(spark, sf_dir):
    keyed = sv.with_review_id(b.reviews(spark, sf_dir))
    unique = sv.dedup_latest(keyed, ["review_id"], sv.newest_first(keyed, ["review_id"]))
    products = sv.prepare_metadata(sv.of_reviewed_products(b.metadata(spark, sf_dir), keyed))
    return sv.enrich(unique, products).select(
        "review_id", "parent_asin", "category", "product_title", "main_category",
        "product_avg_rating", "price")


@query
def src_mixed_encodings(spark, sf_dir):
    """One folder with JSON lines, Python literals, one-line arrays and an array over many lines."""
    path, lines = _scratch(spark), _mixed_review_lines(spark, sf_dir)
    flag = F.col("flag")
    lines.where(flag == "R").select("line").write.text(path)
    lines.where((flag == "N") & ~F.col("many")).select("line").write.mode("append").text(path)
    (lines.where(flag == "A").select(F.concat(F.lit("["), "line", F.lit(", "), "line", F.lit("]")))
     .write.mode("append").text(path))
    pretty = F.concat(F.lit("[\n"), F.array_join(F.collect_list("line"), ",\n"), F.lit("\n]"))
    (lines.where((flag == "N") & F.col("many")).groupBy("shelf").agg(pretty.alias("line"))
     .select("line").write.option("maxRecordsPerFile", 1).mode("append").text(path))
    return legacy.normalize_reviews(legacy.read_raw_any(spark, path, legacy.REVIEW_FIELDS))


@query
def src_missing_input(spark, sf_dir):
    """What Bronze holds after an ingest that is refused because a raw file is missing."""
    root = _scratch(spark)
    write_lines(json_lines(b.reviews(spark, sf_dir), b.RAW_REVIEW_COLUMNS), f"{root}/raw", "reviews", b.RAW_SHARDS)
    write_lines(json_lines(b.metadata(spark, sf_dir), b.RAW_METADATA_COLUMNS), f"{root}/raw", "metadata",
                b.RAW_SHARDS, "meta_")
    bronze = medallion.bronze_path(f"{root}/tables")
    raw.ingest(spark, f"{root}/raw", bronze, None, "2026-02-01")
    try:
        raw.ingest(spark, f"{root}/raw", bronze, "Unknown", "2026-02-02")
    except FileNotFoundError:
        pass
    stored = tables.open_table(spark, f"{bronze}/reviews", schemas.BRONZE_REVIEWS_TABLE)
    return audit.bronze_counts(stored)


@query
def silver_empty_batch(spark, sf_dir):
    """Silver after one batch and a second run for a day without rows."""
    root = _scratch(spark)
    for table, rows in ((schemas.BRONZE_REVIEWS_TABLE, b.reviews), (schemas.BRONZE_METADATA_TABLE, b.metadata)):
        tables.write_partitions(rows(spark, sf_dir), f"{medallion.bronze_path(root)}/{table.name}", table.partition_by)
    medallion.run_silver(spark, root)
    medallion.run_silver(spark, root, ingestion_date="2030-01-01")
    return audit.silver_counts(tables.read_slice(spark, medallion.silver_path(root), schemas.SILVER_TABLE))


@query
def sink_small_output(spark, sf_dir):
    """Files per folder of a little output, compacted on writing: at most two."""
    path, rows = _scratch(spark), b.metadata(spark, sf_dir).repartition(16)
    tables.write_partitions(tables.compact_output(rows, ["ingestion_date"]), path, ["ingestion_date"])
    files = spark.read.parquet(path).select("ingestion_date", F.col("_metadata.file_path").alias("file")).distinct()
    return files.groupBy("ingestion_date").agg((F.count("*") <= 2).alias("few_files"))


@query
def silver_build(spark, sf_dir):
    return _comparable(b.silver(spark, sf_dir))


def _two_batches(spark, sf_dir, path, times=1):
    rows = b.reviews(spark, sf_dir)
    batches = [rows.where("ingestion_date <= date'2026-01-02'"),
               rows.where("ingestion_date > date'2026-01-02'")]
    for batch in [batches[0]] + batches[1:] * times:
        upsert.upsert_table(spark, b.built(spark, sf_dir, batch), path, schemas.SILVER_TABLE)
    return _comparable(tables.read_slice(spark, path, schemas.SILVER_TABLE))


@query
def silver_upsert(spark, sf_dir):
    return _two_batches(spark, sf_dir, _scratch(spark))


@query
def upsert_idempotent(spark, sf_dir):
    return _two_batches(spark, sf_dir, _scratch(spark), times=2)


# --- Gold -----------------------------------------------------------------------------------

@query
def gold_recompute_window(spark, sf_dir):
    return gold.recompute_window(
        b.silver(spark, sf_dir).where("ingestion_date = date'2026-01-04'"))


@query
def gold_output_range(spark, sf_dir):
    return _rounded(gold.product_metrics(b.silver(spark, sf_dir), "1997-01-01", "1997-12-31"),
                    "avg_price")


@query
def gold_daily_product(spark, sf_dir):
    return _rounded(gold.daily_product(b.silver(spark, sf_dir)), "daily_avg_price")


def _windowed(spark, sf_dir, window, *columns):
    daily = gold.daily_product(b.silver(spark, sf_dir))
    return window(daily).select("parent_asin", "category", "review_date", *columns)


@query
def gold_cumulative(spark, sf_dir):
    return _windowed(spark, sf_dir, gold.cumulative, "total_reviews", "average_rating")


@query
def gold_rolling_30d(spark, sf_dir):
    return _windowed(spark, sf_dir, gold.rolling, "rolling_30d_avg_rating")


@query
def gold_last_price(spark, sf_dir):
    return _rounded(_windowed(spark, sf_dir, gold.last_price, "avg_price"), "avg_price")


@query
def gold_product_metrics(spark, sf_dir):
    return _rounded(b.product_metrics(spark, sf_dir), "avg_price")


@query
def gold_category_trends(spark, sf_dir):
    return b.category_trends(spark, sf_dir)


@query
def gold_star_histogram(spark, sf_dir):
    """Fractional ratings up to 6, and unknown ones."""
    return gold.category_trends(b.flawed_silver(spark, sf_dir).withColumn(
        "rating", F.col("rating") - 0.5 * (F.col("helpful_vote") % 3))).drop("daily_avg_rating")


@query
def gold_verified_impact(spark, sf_dir):
    return b.verified_impact(spark, sf_dir)


@query
def gold_upsert(spark, sf_dir):
    path, silver = _scratch(spark), _built_once(spark, sf_dir, *gold.GOLD_INPUT, "ingestion_date")
    early = silver.where("ingestion_date <= date'2026-01-02'")
    for rows in (early, silver):
        upsert.upsert_table(spark, gold.verified_impact(rows), path, schemas.VERIFIED_IMPACT_TABLE)
    return tables.read_slice(spark, path, schemas.VERIFIED_IMPACT_TABLE)


@query
def gold_schema_evolution(spark, sf_dir):
    """Three batches into the same folders: without the star counts, with them and a column that is
    not declared, and without that column again."""
    path, trends = _scratch(spark), storage.stage(b.category_trends(spark, sf_dir), "trends")[0]
    table, weekday = schemas.CATEGORY_TRENDS_TABLE, F.dayofweek("review_date")
    upsert.upsert_table(spark, trends.drop(*bi.STARS), path, table)
    upsert.upsert_table(spark, gold.restrict(trends, "1998-05-01").where(weekday < 5)
                        .withColumn("bar", F.col("daily_review_count") * 2), path, table, evolve=True)
    upsert.upsert_table(spark, gold.restrict(trends, "1998-05-01").where(weekday == 5), path, table, evolve=True)
    return tables.open_evolved(spark, path, table).drop(table.bucket)


@query
def upsert_after_crash(spark, sf_dir):
    """The second of two batches dies after its rows are written; the next run finishes it."""
    path, trends = _scratch(spark), storage.stage(b.category_trends(spark, sf_dir), "trends")[0]
    table, delete_all = schemas.CATEGORY_TRENDS_TABLE, storage.delete_all
    upsert.upsert_table(spark, gold.restrict(trends, None, "1999-12-31"), path, table)

    def dying(*_):
        raise RuntimeError("died")

    storage.delete_all = dying
    try:
        upsert.upsert_table(spark, gold.restrict(trends, "1999-06-01"), path, table)
    except RuntimeError:
        pass
    finally:
        storage.delete_all = delete_all
    upsert.upsert_table(spark, gold.restrict(trends, "2000-01-01", "2000-01-31"), path, table)
    return tables.read_slice(spark, path, table)


@query
def gold_touched_categories(spark, sf_dir):
    return gold.touched_categories(b.silver(spark, sf_dir))


@query
def gold_compaction(spark, sf_dir):
    path, table = _scratch(spark), schemas.PRODUCT_METRICS_TABLE
    upsert.upsert_table(spark, b.product_metrics(spark, sf_dir), path, table)
    upsert.compact(spark, path, table, start="1997-02-10", end="1999-11-20", min_bytes=0)
    return _rounded(tables.read_slice(spark, path, table), "avg_price")


def _silver_batches(spark, sf_dir, root):
    """Silver loaded in two batches, the second being the last day's deliveries."""
    rows = b.reviews(spark, sf_dir)
    for test in ("<", "="):
        batch = rows.where(f"ingestion_date {test} date'2026-01-04'")
        upsert.upsert_table(spark, b.built(spark, sf_dir, batch),
                            medallion.silver_path(root), schemas.SILVER_TABLE)
        yield None if test == "<" else "2026-01-04"


@query
def gold_incremental(spark, sf_dir):
    """Two refreshes with full history equal one build of everything."""
    root = _scratch(spark)
    for ingestion_date in _silver_batches(spark, sf_dir, root):
        medallion.run_gold(spark, root, ingestion_date=ingestion_date, skip_compact=True)
    table = schemas.PRODUCT_METRICS_TABLE
    return _rounded(tables.read_slice(spark, medallion.gold_path(root, table), table), "avg_price")


@query
def gold_incremental_full(spark, sf_dir):
    """The same with every row of the second batch's products read again, instead of the state."""
    root = _scratch(spark)
    for ingestion_date in _silver_batches(spark, sf_dir, root):
        medallion.run_gold(spark, root, ingestion_date=ingestion_date, skip_compact=True, history="full")
    table = schemas.VERIFIED_IMPACT_TABLE
    return tables.read_slice(spark, medallion.gold_path(root, table), table)


@query
def gold_late_reviews(spark, sf_dir):
    """Reviews of 1995 come last, by category: stored totals of all later days are corrected."""
    root, (silver, staged) = _scratch(spark), _staged(spark, sf_dir, *schemas.SILVER.names)
    late = silver.where("year(review_date) = 1995")
    for rows, batch in ((silver.where("year(review_date) <> 1995 or review_date is null"), "2026-03-01"),
                        (late.where("category = 'SMALL'"), "2026-03-02"), (late.where("category <> 'SMALL'"), "2026-03-03")):
        rows = rows.withColumn("ingestion_date", F.lit(batch).cast("date"))
        upsert.upsert_table(spark, rows, medallion.silver_path(root), schemas.SILVER_TABLE)
        medallion.run_gold(spark, root, ingestion_date=batch, skip_compact=True)
    storage.delete(spark, staged)
    state = tables.read_slice(spark, medallion.state_path(root), schemas.PRODUCT_DAILY_TABLE)
    return state.drop("daily_avg_price")


@query
def gold_touched_intervals(spark, sf_dir):
    """The days the last delivery of each category's returned items touches, as intervals."""
    batch = b.silver(spark, sf_dir).where("ingestion_date = date'2026-01-04' and helpful_vote = 3 and rating = 5")
    return carry.merge_days(batch.select("category", "review_date"), gap=2)


@query
def gold_incremental_lookback(spark, sf_dir):
    """One refresh of the dates of a single batch, reading 30 days back."""
    root = _scratch(spark)
    upsert.upsert_table(spark, b.silver(spark, sf_dir), medallion.silver_path(root),
                        schemas.SILVER_TABLE)
    medallion.run_gold(spark, root, ingestion_date="2026-01-04", skip_compact=True, history="lookback")
    table = schemas.PRODUCT_METRICS_TABLE
    return _rounded(tables.read_slice(spark, medallion.gold_path(root, table), table), "avg_price")


# --- business questions ---------------------------------------------------------------------

@query
def bi_catalog(spark, sf_dir):
    return bi.catalog(b.category_trends(spark, sf_dir)).withColumn(
        "categories", F.array_join("categories", "|"))


@query
def bi_leaderboard(spark, sf_dir):
    return _rounded(bi.leaderboard(b.category_trends(spark, sf_dir), "1996-01-01", "1999-12-31"),
                    "weighted_avg_rating")


@query
def bi_leaderboard_summary(spark, sf_dir):
    return _rounded(bi.leaderboard_summary(bi.leaderboard(b.category_trends(spark, sf_dir))),
                    "avg_rating")


@query
def bi_default_range(spark, sf_dir):
    return bi.default_range(b.category_trends(spark, sf_dir))


@query
def bi_latest_product(spark, sf_dir):
    return _rounded(bi.latest_per_product(b.product_metrics(spark, sf_dir)), "avg_price")


@query
def bi_declining(spark, sf_dir):
    return bi.declining(b.product_metrics(spark, sf_dir))


@query
def bi_value_for_money(spark, sf_dir):
    return _rounded(bi.value_for_money(_rounded(b.product_metrics(spark, sf_dir), "avg_price")),
                    "value_score")


@query
def bi_top_value(spark, sf_dir):
    return _rounded(bi.top_value(_rounded(b.product_metrics(spark, sf_dir), "avg_price")),
                    "value_score")


@query
def bi_sentiment(spark, sf_dir):
    return bi.sentiment(b.category_trends(spark, sf_dir))


@query
def bi_overview(spark, sf_dir):
    silver = b.silver(spark, sf_dir)
    return _rounded(bi.overview(gold.category_trends(silver), gold.product_metrics(silver),
                                gold.verified_impact(silver)), "verified_uplift")


@query
def bi_verified_uplift(spark, sf_dir):
    return _rounded(bi.verified_uplift(b.verified_impact(spark, sf_dir)),
                    "verified_avg", "non_verified_avg", "verified_uplift")


@query
def bi_rating_trend(spark, sf_dir):
    return bi.rating_trend(b.category_trends(spark, sf_dir))


@query
def bi_top_products(spark, sf_dir):
    return _rounded(bi.top_products(b.product_metrics(spark, sf_dir)), "avg_price")


@query
def bi_product_ranking(spark, sf_dir):
    return _rounded(bi.top_products(b.product_metrics(spark, sf_dir), None), "avg_price")


@query
def bi_trust_summary(spark, sf_dir):
    return _rounded(bi.trust_summary(b.verified_impact(spark, sf_dir)), "avg_rating")


@query
def bi_trust_trend(spark, sf_dir):
    return bi.trust_trend(b.verified_impact(spark, sf_dir))


@query
def bi_lag_decline(spark, sf_dir):
    return bi.lag_decline(b.product_metrics(spark, sf_dir))


ANCHOR = "1999-06-15"


@query
def bi_q_top_categories(spark, sf_dir):
    period = sqlsurface.relative_bounds("last 7 days", ANCHOR)
    return _rounded(bi.top_categories_by_rating(b.category_trends(spark, sf_dir), *period),
                    "weighted_avg_rating")


@query
def bi_q_declining_month(spark, sf_dir):
    period = sqlsurface.relative_bounds("last month", ANCHOR)
    return bi.declining_in_period(b.product_metrics(spark, sf_dir), "ECONOMY", *period)


@query
def bi_q_verified_on_date(spark, sf_dir):
    return bi.verified_on_date(b.verified_impact(spark, sf_dir), ANCHOR)


@query
def bi_q_verified_last_week(spark, sf_dir):
    period = sqlsurface.relative_bounds("last 7 days", ANCHOR)
    return _rounded(bi.verified_in_period(b.verified_impact(spark, sf_dir), *period), "avg_rating")


@query
def bi_q_most_reviewed(spark, sf_dir):
    period = sqlsurface.relative_bounds("last 7 days", ANCHOR)
    return bi.most_reviewed(b.product_metrics(spark, sf_dir), *period)


@query
def bi_review_bundle(spark, sf_dir):
    return review_bundle(b.text_reviews(spark, sf_dir), b.flagged_products(spark, sf_dir))


@query
def bi_declining_bundle(spark, sf_dir):
    """Recent reviews of every declining product, in one job."""
    silver = _built_once(spark, sf_dir, *gold.GOLD_INPUT, "review_id", "review_timestamp", "review_text")
    return review_bundle(silver, bi.declining(gold.product_metrics(silver)))


# --- SQL surface ----------------------------------------------------------------------------

def _gold_root(spark, sf_dir):
    root, silver = _scratch(spark), _built_once(spark, sf_dir, *gold.GOLD_INPUT)
    frames = (gold.product_metrics, gold.category_trends, gold.verified_impact)
    for table, build in zip(schemas.GOLD_TABLES, frames):
        upsert.upsert_table(spark, build(silver), f"{root}/{table.name}", table)
    return root


@query
def sql_views(spark, sf_dir):
    sqlsurface.register_views(spark, _gold_root(spark, sf_dir))
    return spark.sql("""
        select c.category, c.review_date, c.daily_review_count, p.products,
               sum(v.daily_review_count) as flagged_reviews
        from category_trends c
        join (select category, review_date, count(*) as products from product_metrics
              group by category, review_date) p using (category, review_date)
        join verified_purchase_impact v using (category, review_date)
        group by c.category, c.review_date, c.daily_review_count, p.products""")


@query
def sql_guarded_cte(spark, sf_dir):
    sqlsurface.register_views(spark, _gold_root(spark, sf_dir))
    return sqlsurface.safe_sql(spark, """
        with yearly as (
            select category, year(review_date) as review_year, 'UPDATE' as label,
                   sum(daily_review_count) as reviews
            from category_trends group by category, year(review_date))
        select * from yearly -- drop nothing
        order by category, review_year limit 500;""")


@query
def sql_last_7_days(spark, sf_dir):
    return sqlsurface.relative_range(b.category_trends(spark, sf_dir), "last 7 days", ANCHOR)


@query
def sql_last_month(spark, sf_dir):
    return sqlsurface.relative_range(b.verified_impact(spark, sf_dir), "last month", ANCHOR)


# --- checks and audit -----------------------------------------------------------------------

@query
def dq_not_blank(spark, sf_dir):
    return quality.count_violations(
        b.flawed_silver(spark, sf_dir),
        [quality.not_blank("review_id"), quality.not_blank("parent_asin")])


@query
def dq_rating_range(spark, sf_dir):
    return quality.count_violations(b.flawed_silver(spark, sf_dir),
                                    [quality.between("rating", 1, 5)])


@query
def dq_helpful_vote(spark, sf_dir):
    return quality.count_violations(b.flawed_silver(spark, sf_dir),
                                    [quality.at_least("helpful_vote", 0)])


@query
def dq_report(spark, sf_dir):
    return quality.silver_report(b.flawed_silver(spark, sf_dir))


SUITE = """{"expectations": [
  {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "rating"}},
  {"expectation_type": "expect_column_values_to_be_between",
   "kwargs": {"column": "rating", "min_value": 2, "max_value": 5}},
  {"expectation_type": "expect_column_values_to_be_greater_than_or_equal_to",
   "kwargs": {"column": "helpful_vote", "value": 0}}]}"""


@query
def dq_suite(spark, sf_dir):
    return quality.count_violations(b.flawed_silver(spark, sf_dir), quality.compile_suite(SUITE))


def _damaged_lines(spark, sf_dir):
    """Raw lines, those of returned items cut in half and those without a flag blank."""
    rows = b.reviews(spark, sf_dir)
    line = F.to_json(F.struct(*b.RAW_REVIEW_COLUMNS))
    damaged = (F.when(F.col("verified_purchase").isNull(), "")
               .when(F.col("text").contains(" R "), F.left(line, F.lit(20))).otherwise(line))
    return rows.select("category", damaged.alias("line"))


@query
def audit_raw(spark, sf_dir):
    path = _scratch(spark)
    write_lines(_damaged_lines(spark, sf_dir), path, "reviews", b.RAW_SHARDS)
    return audit.raw_counts(spark, path)


@query
def audit_bronze(spark, sf_dir):
    return audit.bronze_counts(b.reviews(spark, sf_dir))


@query
def audit_silver(spark, sf_dir):
    return audit.silver_counts(b.silver(spark, sf_dir))


@query
def audit_gold(spark, sf_dir):
    return audit.gold_counts(spark, _gold_root(spark, sf_dir))


@query
def audit_dropoff(spark, sf_dir):
    path = _scratch(spark)
    write_lines(_damaged_lines(spark, sf_dir), path, "reviews", b.RAW_SHARDS)
    bronze = raw.with_batch(raw.with_category_from_path(
        raw.read_jsonl_tree(spark, path, schemas.REVIEW_RAW), "reviews"), None, "2026-02-01")
    silver = b.built(spark, sf_dir, bronze)
    return audit.layer_dropoff(audit.raw_counts(spark, path), bronze, silver)


@query
def medallion_end_to_end(spark, sf_dir):
    """Two deliveries of raw files to Gold: the first through all steps, then both together. Both
    hold metadata of every product; the newer one counts."""
    root = _scratch(spark)
    tables_root = f"{root}/tables"
    for day, test in (("2026-02-01", "<="), ("2026-02-02", ">")):
        reviews = b.reviews(spark, sf_dir).where(f"ingestion_date {test} date'2026-01-02'")
        metadata = b.metadata(spark, sf_dir).where(f"ingestion_date {test} date'2026-01-01'")
        write_lines(json_lines(reviews, b.RAW_REVIEW_COLUMNS), f"{root}/{day}", "reviews", b.RAW_SHARDS)
        write_lines(json_lines(metadata, b.RAW_METADATA_COLUMNS), f"{root}/{day}", "metadata",
                    b.RAW_SHARDS, "meta_")
    medallion.run(spark, f"{root}/2026-02-01", tables_root, ingestion_date="2026-02-01", skip_compact=True)
    raw.ingest(spark, f"{root}/2026-02-02", medallion.bronze_path(tables_root), None, "2026-02-02")
    medallion.run_silver(spark, tables_root)
    medallion.run_gold(spark, tables_root, skip_compact=True)
    table = schemas.PRODUCT_METRICS_TABLE
    metrics = tables.read_slice(spark, medallion.gold_path(tables_root, table), table)
    return _rounded(metrics, "avg_price")
