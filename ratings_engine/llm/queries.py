"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratings_engine.llm import (
    decontaminate,
    langid,
    lm,
    merkle,
    mixing,
    ngramjoin,
    quality,
    rules,
    secrets,
    substring,
    suffix,
    variants,
    warc,
)

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(folds):
    """crc32 of the id's text, modulo folds."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


@query
def op1_latent_decontamination(spark, sf_dir):
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op2_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(_fold(4) != 2)
    scored = quality.score(docs, quality.fit(docs, labels)).drop("text")
    return scored.select("doc_id", (_fold(4) == 2).alias("held_out"), "score",
                         (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


@query
def op3_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(_fold(5) != 0))
    return (langid.predict(docs.select("doc_id", "text"), model)
            .select("doc_id", (_fold(5) == 0).alias("held_out"), "lang_pred", "score"))


@query
def op4_adaptive_rules(spark, sf_dir):
    return rules.judge(_table(spark, sf_dir, "documents"))


@query
def op5_deleted_interpolation(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return (lm.score(docs, _fold(5) != 1)
            .select("doc_id", (_fold(5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                    "base_score", "score"))


@query
def op6_secret_scan(spark, sf_dir):
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("_base", lambda s: s["rank"] == secrets.KINDS.index(kind))).cast("bigint")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(secrets.listed(F.col("_base")), 256).alias("base_sha256"),
                        secrets.listed(F.col("_spans")).alias("spans"))


@query
def op7_suffix_dedup(spark, sf_dir):
    return suffix.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


@query
def op8_ngram_jaccard(spark, sf_dir):
    return ngramjoin.link(_table(spark, sf_dir, "documents"), n=3, percent=90)


@query
def op9_mix_sources(spark, sf_dir):
    return (mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
            .select("doc_id", "size", "source_size", "target", "taken"))


@query
def op10_warc_revisits(spark, sf_dir):
    return (warc.archive_pages(_table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query
def op11_window_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return (substring.remove_repeats(docs)
            .select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")))


@query
def op12_merkle_manifest(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    claimed = F.when(_fold(7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    given = merkle.leaf_digest(*[claimed if c == "n_chars" else F.col(c) for c in columns])
    listed = merkle.manifest(docs, columns, keep={"claimed": F.unhex(given)})
    proved = listed.withColumn("folded_root", merkle.folded(F.lower(F.hex("claimed")), F.col("steps")))
    return proved.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query
def op13_spelling_variants(spark, sf_dir):
    return variants.variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))
