"""Corpus preparation: documents through five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratings_engine.llm import decontaminate, mixing, ngramjoin, quality, secrets
from ratings_engine.llm.common import staged
from ratings_engine.sources import storage

#: Near duplicates: words of a shingle and similarity in percent.
SHINGLE, SIMILARITY = 5, 80
#: SQL cannot express the fitted models; tests compare with brute-force versions.
ORACLE_SQL = None


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose probability of good quality is below quality.ACCEPT."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model, column="score of this stage")
    return scored.where(F.col("score of this stage") >= quality.ACCEPT).drop("score of this stage")


#: Up to so many file names travel to every task.
FEW_FILES = 100_000


def _numbered(docs: DataFrame, number: str) -> DataFrame:
    """docs with a number for every row: its file's and its place in the file, whatever is computed again.

    A DataFrame that is no plain scan of Parquet files is written first."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = staged(docs, "plain")
    files = docs.select(F.col("_metadata.file_path").alias("file of the row")).distinct()
    files = staged(files.withColumn("file number", F.row_number().over(Window.orderBy("file of the row"))), "files")
    small = files.limit(FEW_FILES + 1).count() <= FEW_FILES
    placed = docs.select("*", F.col("_metadata.file_path").alias("file of the row"), F.col("_metadata.row_index").alias("place of the row"))
    met = placed.join(F.broadcast(files) if small else files, "file of the row")
    return met.select(*docs.columns, (F.shiftleft(F.col("file number").cast("bigint"), 33) + F.col("place of the row")).alias(number))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that of least id, null ids last, and of rows with
    that id the first in the order of files.

    Rows are told apart by file and place, whatever their ids. Rows without words are a group each."""
    number = "number in this stage"
    rows = _numbered(docs, number)
    linked = ngramjoin.link(rows.select(number, "text"), doc_id=number, n=SHINGLE, percent=SIMILARITY)
    first = F.struct(F.col("id").isNull(), "id", "number")
    chosen = (linked.select(F.col("doc_id").alias("number"), "component_id")
              .join(rows.select(F.col(number).alias("number"), F.col("doc_id").alias("id")), "number")
              .groupBy("component_id").agg(F.min(first)["number"].alias(number)))
    return rows.join(chosen, number, "left_semi").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item or a paraphrase of one with its answer."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; all documents stay, n_chars follows the text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with how many copies of each."""
    mixed = mixing.mix(docs)
    copies = F.col("epochs") + F.col("sampled").cast("int")
    return mixed.withColumn("copies", copies).where("copies > 0").drop("sampled", "epochs")


STAGES = [("quality classifier", keep_good_quality), ("n-gram Jaccard join", keep_one_of_near_duplicates),
          ("benchmark decontamination", drop_benchmark_leaks), ("secret scans", mask_secrets),
          ("mixing sources", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs, path = storage.stage(stage(spark, docs, sf_dir), "pipeline")
        if before is not None:
            storage.delete(spark, before)
        before = path
    return docs
