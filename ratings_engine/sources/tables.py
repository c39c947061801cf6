"""Partitioned Parquet tables: reading slices, replacing and appending partitions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ratings_engine.functions.columns import date_between
from ratings_engine.schemas import BUCKET_UNITS, DATE_BUCKETS, KEY_BUCKET, Table
from ratings_engine.sources import storage


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions df has rows for; all others stay."""
    with storage.freeing_shuffles(df.sparkSession):
        (df.write.partitionBy(*partition_by).mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").option("compression", storage.CODEC).parquet(path))


def append_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Add rows to their partitions; running it twice adds them twice."""
    with storage.freeing_shuffles(df.sparkSession):
        df.write.partitionBy(*partition_by).mode("append").option("compression", storage.CODEC).parquet(path)


def packed(df: DataFrame, digests: Sequence[str] = (), derived: dict[str, Column] | None = None) -> tuple[DataFrame, list[Column]]:
    """The rows as they travel through a shuffle, and the columns that restore them after it.

    digests names columns of lower-case hex, which travel as bytes; any other text in them stays as it is.
    derived has for some columns what they follow from, columns of df that are not among them: values that do
    follow from these are left out and made again."""
    columns = df.columns
    restored = {c: F.col(c) for c in columns}
    derived = {c: value for c, value in (derived or {}).items() if c in columns}
    for c in digests:
        if c in columns and c not in derived:
            hexed = F.coalesce(F.lower(F.hex(F.unhex(c))) == F.col(c), F.lit(False))
            df = df.withColumn(f"{c} bytes", F.when(hexed, F.unhex(c))).withColumn(c, F.when(~hexed, F.col(c)))
            restored[c] = F.coalesce(c, F.lower(F.hex(f"{c} bytes"))).alias(c)
    df = df.withColumns({f"{c} follows": F.col(c).eqNullSafe(value) for c, value in derived.items()})
    df = df.withColumns({c: F.when(~F.col(f"{c} follows"), F.col(c)) for c in derived})
    for c, value in derived.items():
        restored[c] = F.when(F.col(f"{c} follows"), value).otherwise(F.col(c)).alias(c)
    return df, list(restored.values())


def compact_output(df: DataFrame, partition_by: Sequence[str], digests: Sequence[str] = (),
                   derived: dict[str, Column] | None = None) -> DataFrame:
    """Arrange rows by partition before a write.

    Adaptive execution merges small pieces, so little data gives one or two files, and splits
    a partition beyond the advisory size, so a hot category does not end in one task. digests and
    derived are as in packed()."""
    df, restored = packed(df, digests, derived)
    return df.hint("rebalance", *partition_by).select(restored)


def derived_columns(df: DataFrame, table: Table) -> dict[str, Column]:
    """The declared derived columns of a table that df has with what they follow from."""
    types = dict(df.dtypes)
    declared = {f.name: f.dataType.simpleString() for f in table.schema}
    return {c: value(*(F.col(k) for k in of)) for c, of, value in table.derived
            if all(types.get(k) == declared[k] for k in (c, *of))}


def with_bucket(df: DataFrame, table: Table) -> DataFrame:
    """Add the table's date bucket and key bucket, where it has them, as partition columns."""
    if table.bucket is not None:
        df = df.withColumn(table.bucket, F.expr(DATE_BUCKETS[table.bucket].format("review_date")).cast("int"))
    if table.key_buckets:
        df = df.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*table.keys), F.lit(table.key_buckets)).cast("int"))
    return df


def _one_of(column: str, values: set) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def in_folders(columns: Sequence[str], values: Iterable[tuple]) -> Column:
    """Whether the columns have one of some combinations of values, null being one; on partition columns
    Spark lists those folders only."""
    head, *rest = columns
    if not rest:
        return _one_of(head, {v[0] for v in values})
    tails: dict = {}
    for value in values:
        tails.setdefault(value[0], set()).add(tuple(value[1:]))
    heads: dict = {}
    for value, tail in tails.items():
        heads.setdefault(frozenset(tail), set()).add(value)
    test = F.lit(False)
    for tail, found in heads.items():
        test = test | (_one_of(head, found) & in_folders(rest, tail))
    return test


def bucket_between(table: Table, start=None, end=None) -> Column:
    """Folder filter for a range of review dates: whole buckets, open where a bound is None."""
    test = F.lit(True)
    if table.bucket is not None:
        rule = DATE_BUCKETS[table.bucket]
        if start is not None:
            test = test & (F.col(table.bucket) >= F.expr(rule.format(f"date'{start}'")))
        if end is not None:
            test = test & (F.col(table.bucket) <= F.expr(rule.format(f"date'{end}'")))
    return test


def open_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The table under its declared columns: no type guessing for partition values, and null
    for a column that older files lack."""
    return spark.read.schema(table.stored_schema).parquet(path)


def open_evolved(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The table under its declared columns and all others that its files have; looks into every
    file, so meant for tables that are known to have grown columns."""
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    declared = table.stored_schema
    further = [StructField(f.name, f.dataType, True) for f in found if f.name not in declared.names]
    return spark.read.schema(StructType([*declared.fields, *further])).parquet(path)


def read_slice(spark: SparkSession, path: str, table: Table, category: str | None = None,
               start=None, end=None, ingestion_date=None) -> DataFrame:
    """The declared columns for a category, a range of review dates and/or a batch.

    The date range is repeated on the date bucket, so whole folders are skipped."""
    df = open_table(spark, path, table)
    if category is not None:
        df = df.where(F.col("category") == category)
    if ingestion_date is not None:
        df = df.where(F.col("ingestion_date") == F.lit(ingestion_date).cast("date"))
    if start is not None or end is not None:
        df = df.where(date_between(F.col("review_date"), start, end)
                      & bucket_between(table, start, end))
    return df.select(*table.schema.names)


#: Up to so many intervals, a few MB, travel to every task; more are joined day by day.
FEW_INTERVALS = 50_000


def read_intervals(spark: SparkSession, path: str, table: Table, intervals: DataFrame) -> DataFrame:
    """The declared columns for intervals (category, start, end) of review dates, which must not overlap.

    Folders are chosen by the categories and date buckets of the intervals, as many values as folders;
    within them rows meet the intervals of their category and bucket."""
    unit = BUCKET_UNITS[table.bucket]
    bucket = F.expr(DATE_BUCKETS[table.bucket].format("piece")).cast("int")
    pieces = intervals.select("category", "start", "end", F.explode(F.expr(
        f"sequence(to_date(date_trunc('{unit}', start)), to_date(date_trunc('{unit}', end)), interval 1 {unit})"
    )).alias("piece")).select(F.col("category").alias("_of"), bucket.alias("_in"), "start", "end")
    folders = [tuple(row) for row in pieces.select("_of", "_in").distinct().collect()]
    stored = open_table(spark, path, table).where(in_folders(["category", table.bucket], folders))
    if pieces.limit(FEW_INTERVALS + 1).count() <= FEW_INTERVALS:
        wanted = (F.col("category").eqNullSafe(F.col("_of")) & (F.col(table.bucket) == F.col("_in"))
                  & F.col("review_date").between(F.col("start"), F.col("end")))
        return stored.join(F.broadcast(pieces), wanted, "left_semi").select(*table.schema.names)
    days = intervals.select(F.col("category").alias("_of"), F.explode(F.sequence("start", "end")).alias("_day"))
    wanted = F.col("category").eqNullSafe(F.col("_of")) & (F.col("review_date") == F.col("_day"))
    return stored.join(days, wanted, "left_semi").select(*table.schema.names)


def stored_categories(spark: SparkSession, path: str) -> set:
    """Categories that a table partitioned by category has folders for; reads no file."""
    if not storage.exists(spark, path):
        return set()
    names = (unquote(folder.rstrip("/").rsplit("/", 1)[-1]).partition("=")[2]
             for folder in storage.subfolders(spark, path, "category="))
    return {None if name == "__HIVE_DEFAULT_PARTITION__" else name for name in names}
