import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ratings_engine.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Good and bad documents, a group of near copies, benchmark leaks and secrets."""
    root = tmp_path_factory.mktemp("tables")
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["ra", "to", "li", "men", "su"]) for _ in range(rng.randint(2, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(rng.randint(40, 90)), "en", f"s{i % 3}", 1) for i in range(150)]
    rows += [(i, " ".join(rng.choice(["BUY!!", "$$$", "WIN###"]) for _ in range(50)), "en", "s0", 1) for i in range(150, 220)]
    base = text(80).split()
    rows += [(300 + k, " ".join(base[:-1] + [word()]), "de", "s1", 1) for k in range(8)]
    items = [(k, text(30) + ". " + text(6) + ".") for k in range(5)]
    rows += [(400 + k, f"{text(40)} {items[k][1]} {text(40)}", "en", "s2", 1) for k in range(5)]
    rows += [(500, text(50) + " password=abcdef0123456789ab " + text(50), "en", "s2", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{root}/documents.parquet")
    (docs.where("doc_id < 220").select("doc_id", (F.col("doc_id") < 150).cast("int").alias("quality"), F.lit(0).alias("toxic"))
     .write.parquet(f"{root}/labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stages_take_effect_and_clean_documents_stay(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, tables), "test")
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "secret scans":
            (row,) = docs.where("doc_id = 500").collect()
            assert "[SECRET]" in row.text and "abcdef" not in row.text and row.n_chars == len(row.text)
    good, single, clean, masked, mixed = kept
    assert good >= set(range(150)) | {300, 400, 500} and not good & set(range(150, 220))
    assert good - single == set(range(301, 308)) and single - clean == set(range(400, 405))
    assert masked == clean and mixed <= masked and len(mixed) > 50


def test_awkward_rows_pass_every_stage(spark, tables, awkward, none):
    for docs in (awkward, none):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.staged(stage(spark, docs, tables), "test")
        assert docs.count() <= awkward.count()


def test_near_duplicates_are_rows_not_ids(spark, tables):
    rng = random.Random(10)
    text = lambda: " ".join(rng.choice("abcdefghij") + str(rng.randrange(99)) for _ in range(60))
    a, b, c, d, e = (text() for _ in range(5))
    near = lambda t: t + " more"
    rows = [(1, a), (1, b), (1, c), (2, near(a)), (0, near(b)), (None, near(c)), (None, d), (None, d), (None, e), (3, e),
            (4, ""), (4, None), (None, ""), (5, a)]
    docs = spark.createDataFrame([(i, t, "en", "s0", 1) for i, t in rows], SCHEMA)
    got = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, tables)
    assert got.columns == docs.columns
    want = [(1, a), (1, c), (0, near(b)), (None, d), (3, e), (4, ""), (4, None), (None, "")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, want))


def test_registered_names():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert len(corpus_pipeline.STAGES) == 5
