import gzip
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.builders import rows_of

from ratings_engine import schemas
from ratings_engine.operators import audit
from ratings_engine.sources import legacy, raw, tables


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write("".join(line + "\n" for line in lines))


@pytest.fixture
def raw_root(tmp_path):
    root = tmp_path / "raw"
    write(root / "reviews/Gift_Cards.jsonl.gz", '{"rating": 5, "asin": "A", "parent_asin": "P"}',
          "not json", "", '{"rating": "bad", "asin": "B"}')
    write(root / "reviews/Books.jsonl.gz", '{"rating": 4.5, "verified_purchase": true}')
    write(root / "reviews/nested/deep/Toys.jsonl.gz", '{"rating": 1}')
    write(root / "metadata/meta_Gift_Cards.jsonl.gz",
          '{"title": "Card", "price": "$5", "categories": ["a", "b"], "parent_asin": "P"}')
    write(root / "metadata/Books.jsonl.gz", '{"title": "Book"}')
    return str(root)


def test_unreadable_lines_are_left_out_and_counted(spark, raw_root):
    path = f"{raw_root}/reviews/Gift_Cards.jsonl.gz"
    df = raw.read_jsonl(spark, path, schemas.REVIEW_RAW)
    assert df.schema == schemas.REVIEW_RAW
    # One bad field costs that field only.
    assert sorted((r.asin, r.rating) for r in df.collect()) == [("A", 5.0), ("B", None)]
    assert df.count() == 2
    assert [r.line for r in raw.unreadable_lines(spark, path, schemas.REVIEW_RAW).collect()] == [
        "not json"]


def test_bulk_scan_labels_by_file_name(spark, raw_root):
    reviews = raw.with_category_from_path(
        raw.read_jsonl_tree(spark, f"{raw_root}/reviews", schemas.REVIEW_RAW), "reviews")
    assert sorted(r.category for r in reviews.collect()) == ["Books", "Gift_Cards", "Gift_Cards"]
    metadata = raw.with_category_from_path(
        raw.read_jsonl_tree(spark, f"{raw_root}/metadata", schemas.METADATA_RAW), "metadata")
    assert sorted((r.category, r.title) for r in metadata.collect()) == [
        ("Books", "Book"), ("Gift_Cards", "Card")]
    assert [r.path.rsplit("/", 1)[1] for r in audit.unlabelled_files(spark, raw_root).collect()] == [
        "Toys.jsonl.gz"]


def test_ingest_replaces_its_own_partitions(spark, raw_root, tmp_path):
    bronze = str(tmp_path / "bronze")
    for date in ("2026-01-01", "2026-01-02", "2026-01-01"):
        raw.ingest(spark, raw_root, bronze, "Gift_Cards", date)
    read = tables.open_table(spark, f"{bronze}/reviews", schemas.BRONZE_REVIEWS_TABLE)
    assert read.schema == schemas.BRONZE_REVIEWS
    assert read.count() == 4
    raw.ingest(spark, raw_root, bronze, ingestion_date="2026-01-01")
    assert rows_of(audit.bronze_counts(read.sparkSession.read.schema(
        schemas.BRONZE_REVIEWS).parquet(f"{bronze}/reviews")).select(
        "category", F.col("ingestion_date").cast("string"), "count")) == [
        ("Books", "2026-01-01", 1), ("Gift_Cards", "2026-01-01", 2), ("Gift_Cards", "2026-01-02", 2)]


def test_ingest_append_repeats_rows(spark, raw_root, tmp_path):
    bronze = str(tmp_path / "bronze")
    for _ in range(2):
        raw.ingest(spark, raw_root, bronze, ingestion_date="2026-01-01", append=True)
    assert tables.open_table(spark, f"{bronze}/metadata", schemas.BRONZE_METADATA_TABLE).count() == 4


def test_ingest_without_date_uses_today(spark, raw_root, tmp_path):
    bronze = str(tmp_path / "bronze")
    raw.ingest(spark, raw_root, bronze, "Gift_Cards")
    df = tables.open_table(spark, f"{bronze}/metadata", schemas.BRONZE_METADATA_TABLE)
    row = df.select("ingestion_date", F.current_date().alias("today"), "categories").first()
    assert row.ingestion_date == row.today and row.categories == ["a", "b"]


def test_ingest_needs_both_files(spark, raw_root, tmp_path):
    with pytest.raises(FileNotFoundError, match="meta_Books"):
        raw.ingest(spark, raw_root, str(tmp_path / "bronze"), "Books")
    assert not (tmp_path / "bronze").exists()


def test_mixed_encodings(spark, tmp_path):
    write(tmp_path / "mixed.gz",
          '{"overall": 4, "summary": "s", "reviewText": "t", "asin": "A", "reviewerID": "U",'
          ' "unixReviewTime": 1400000000, "helpful": [2, 3]}',
          "{'overall': 5.0, 'summary': None, 'reviewText': 'it\\'s: None, \"True\"', 'asin': 'B',"
          " 'verified_purchase': True, 'user_id': u'V', 'timestamp': 7}",
          '  [{"rating": 1, "title": "x", "timestamp": 12}, {"rating": 2}]  ',
          "", "null", "None", "rubbish", '{"broken": ', "{'also': broken}", "17",
          '{"overall": "3", "helpful_vote": 6, "parent_asin": "Q", "asin": "C"}')
    df = legacy.normalize_reviews(
        legacy.read_raw_any(spark, str(tmp_path / "mixed.gz"), legacy.REVIEW_FIELDS))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in schemas.REVIEW_RAW]
    got = {r.rating: tuple(r) for r in df.collect()}
    assert got == {
        4.0: (4.0, "s", "t", "A", "A", "U", 1_400_000_000_000, 2, False),
        5.0: (5.0, "", 'it\'s: None, "True"', "B", "B", "V", 7000, 0, True),
        1.0: (1.0, "x", None, None, None, None, 12, None, None),
        2.0: (2.0, None, None, None, None, None, None, None, None),
        3.0: (3.0, "", "", "C", "Q", "", 0, 6, False)}


def test_array_over_many_lines(spark, tmp_path):
    write(tmp_path / "array.gz", "[", '{"overall": 4,', '"asin": "A"},', '{"overall": 2}', "]")
    df = legacy.read_raw_any(spark, str(tmp_path / "array.gz"), legacy.REVIEW_FIELDS)
    assert sorted(r.rating for r in legacy.normalize_reviews(df).collect()) == [2.0, 4.0]


def test_literals_with_long_texts_and_odd_pieces(spark, tmp_path):
    """A long text used to be a step of the matcher per character, which its stack did not hold."""
    long = "it\\'s None (x), " * 4000
    write(tmp_path / "literals.gz",
          "{'overall': 1, 'reviewText': '" + long + "', 'helpful': (2, 3,), 'asin': u'A', 'verified_purchase': False,}",
          "{'overall': 2, 'summary': b\"u\", 'asin': 'caf\\xe9', 'reviewText': None}",
          "{'overall': 3, 'reviewText': 'a \x1f, True', 'asin': u'C\\x41', 'summary': None}")
    df = legacy.normalize_reviews(legacy.read_raw_any(spark, str(tmp_path / "literals.gz"), legacy.REVIEW_FIELDS))
    got = {r.rating: r for r in df.collect()}
    assert got[1.0].text == long.replace("\\", "") and got[1.0].helpful_vote == 2 and got[1.0].asin == "A"
    assert got[2.0].title == "u" and got[2.0].asin == "café"
    assert len(got) in (2, 3) and (3.0 not in got or got[3.0].asin == "CA")


def test_records_over_lines_with_brackets_in_texts_and_parts_of_lines(spark, tmp_path):
    long = "x" * 30_000
    write(tmp_path / "array.gz", "[", '{"overall": 1, "asin": "}, {", "helpful": [1, 2]} ,',
          '{"overall": 2, "asin": "' + long + '"}, {"overall": 3,', '"helpful": [[4, 5], 6],', '"asin": "C"}, {"overall": 4}', ",",
          "{'overall': 5, 'asin': 'it\\'s {'}", "]")
    got = {r.rating: r for r in legacy.normalize_reviews(
        legacy.read_raw_any(spark, str(tmp_path / "array.gz"), legacy.REVIEW_FIELDS)).collect()}
    assert sorted(got) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert got[1.0].asin == "}, {" and got[1.0].helpful_vote == 1 and got[2.0].asin == long and got[3.0].asin == "C"
    assert got[5.0].asin == "it's {"


def test_older_metadata(spark, tmp_path):
    write(tmp_path / "meta.gz",
          '{"asin": "A", "title": "T", "categories": [["Top", "Sub"], ["Other"]],'
          ' "avg_rating": 4.5, "num_reviews": 9, "price": 3.5}',
          '{"asin": "B", "categories": ["Flat"], "average_rating": 0, "avg_rating": 2}',
          '{"asin": "C", "categories": []}',
          '{"main_category": "M", "title": "N", "rating_number": 3, "categories": ["k"],'
          ' "parent_asin": "D", "price": null}')
    df = legacy.normalize_metadata(
        legacy.read_raw_any(spark, str(tmp_path / "meta.gz"), legacy.METADATA_FIELDS))
    got = {r.parent_asin: tuple(r)[:-1] for r in df.collect()}
    assert got == {
        "A": ("Top", "T", 4.5, 9, "3.5", "", ["Top", "Sub"]),
        "B": ("Flat", "", 2.0, 0, "", "", ["Flat"]),
        "C": ("", "", 0.0, 0, "", "", []),
        "D": ("M", "N", None, 3, None, None, ["k"])}


def test_cap_keeps_the_first_rows_of_each_category(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("category"),
        (F.col("id") * 7919 % 3000).alias("v"))
    got = legacy.cap_per_category(df, 50, "v")
    want = [(c, v) for c in ("cold", "hot")
            for v in sorted(r.v for r in df.where(F.col("category") == c).collect())[:50]]
    assert rows_of(got) == sorted(want)
    assert legacy.cap_per_category(df, None, "v") is df


def test_cap_with_many_equal_rows(spark):
    df = spark.range(500).select(F.lit("c").alias("category"), F.lit(1).alias("v"))
    assert legacy.cap_per_category(df, 20, "v").count() == 20
    assert legacy.cap_per_category(df, 0, "v").count() == 0
    assert legacy.cap_per_category(df.where("v = 2"), 20, "v").count() == 0
    assert legacy.cap_per_category(df.withColumn("v", F.lit("x")), 20, "v", rounds=(4, 1)).count() == 20


def test_cap_with_null_and_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(legacy, "ENOUGH_ROWS", 10)
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(12)]) if rng.random() < 0.5
             else float(rng.randint(0, 10 ** 6)), i) for i in range(6000)]
    rows += [("few", float(i), i) for i in range(5)] + [("nulls", None, i) for i in range(90)]
    df = spark.createDataFrame([(c, None if k is None else float(k), i) for c, k, i in rows],
                               "category string, k double, i long")
    by_key = lambda r: (r[1] is not None, r[1] or 0.0, r[2])
    for n in (1, 40, 700, 5000):
        want = Counter()
        for category in {c for c, _, _ in rows}:
            want += Counter(r[2] for r in sorted((r for r in rows if r[0] == category), key=by_key)[:n])
        got = legacy.cap_per_category(df, n, "k", [F.asc("i")], rounds=(4, 1))
        assert Counter(r.i for r in got.collect()) == want
        assert got.columns == df.columns


def test_cap_moves_no_texts(spark):
    df = spark.range(0, 5000, 1, 4).select(F.lit("c").alias("category"), F.col("id").alias("v"),
                                           F.sha2(F.col("id").cast("string"), 256).alias("text"))
    got = legacy.cap_per_category(df, 100, "v")
    steps = got._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not any("Exchange" in x and "Broadcast" not in x for x in steps)
    assert got.count() == 100


def test_each_file_of_a_folder_by_its_own_encoding(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"overall": 1, "asin": "a"}\n\nnull\nbroken {\n{"overall": 2, "asin": "b"}\n')
    (tmp_path / "literals.json").write_text(
        "{'overall': 3.0, 'asin': u'c', 'reviewText': \"it's (None)\", 'helpful': (1, 2), 'verified_purchase': True}\n"
        "{'overall': 4.0, 'asin': 'd', 'summary': 'say \\'hi\\' \\xe9', 'reviewText': None,}\n")
    (tmp_path / "oneline.json").write_text('[{"overall": 5, "asin": "e"}, {"overall": 6, "asin": "f"}]\n')
    (tmp_path / "pretty.json").write_text('[\n  {"overall": 7,\n   "asin": "g"},\n  {"overall": 8, "asin": "h"}\n]\n')
    (tmp_path / "object.json").write_text('{\n  "overall": 9,\n  "asin": "i"\n}\n')
    raw = legacy.read_raw_any(spark, str(tmp_path), legacy.REVIEW_FIELDS)
    assert raw.count() == 9
    rows = {r.asin: r for r in legacy.normalize_reviews(raw).collect()}
    assert {a: r.rating for a, r in rows.items()} == {a: float(k) for k, a in enumerate("abcdefghi", 1)}
    assert rows["c"].text == "it's (None)" and rows["c"].helpful_vote == 1 and rows["c"].verified_purchase
    assert rows["d"].title == "say 'hi' é" and rows["d"].text == ""


def test_absent_and_null_fields_differ(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '{"main_category": null, "title": "now", "price": null, "store": null, "categories": ["X"], "parent_asin": "p"}\n'
        '{"title": "then", "categories": [["Y", "Z"]], "asin": "q"}\n')
    rows = {r.title: r for r in legacy.normalize_metadata(
        legacy.read_raw_any(spark, str(tmp_path), legacy.METADATA_FIELDS)).collect()}
    assert (rows["now"].main_category, rows["now"].price, rows["now"].store) == (None, None, None)
    assert (rows["then"].main_category, rows["then"].price, rows["then"].parent_asin) == ("Y", "", "q")


def test_seconds_with_decimals(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"overall": 5, "unixReviewTime": 1588687728.0}\n{"overall": 4, "unixReviewTime": "1588687729"}\n')
    rows = legacy.normalize_reviews(legacy.read_raw_any(spark, str(tmp_path), legacy.REVIEW_FIELDS)).collect()
    assert sorted(r.timestamp for r in rows) == [1588687728000, 1588687729000]


def test_records_over_many_lines_are_cut_by_depth(spark, tmp_path):
    """Small splits, so that records and depths cross them; brackets and quotes inside strings."""
    import json
    rows = [{"overall": k, "asin": f"a{k}", "reviewText": ["plain", 'he said "[{" \\', "it's }, {", "]", ""][k % 5],
             "helpful": [k, 9], "summary": None} for k in range(200)]
    (tmp_path / "pretty.json").write_text(json.dumps(rows[:60], indent=2))
    (tmp_path / "rows.json").write_text("[\n" + ",\n".join(json.dumps(r) for r in rows[60:100]) + "\n]\n")
    (tmp_path / "shared.json").write_text("[" + json.dumps(rows[100]) + ",\n{\n" + json.dumps(rows[101])[1:] + ", "
                                          + json.dumps(rows[102]) + ",\nnull, 7\n]")
    (tmp_path / "objects.json").write_text("".join(json.dumps(r, indent=1) + "\n" for r in rows[103:150]))
    (tmp_path / "literals.json").write_text("[\n" + ",\n".join(repr(r) for r in rows[150:190]) + "\n]")
    (tmp_path / "torn.json").write_text(json.dumps(rows[190:], indent=2)[:-60])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        raw = legacy.read_raw_any(spark, str(tmp_path), legacy.REVIEW_FIELDS)
        got = {r.asin: r for r in legacy.normalize_reviews(raw).collect()}
        assert not any("pretty.json" in line for line in raw._jdf.queryExecution().toString().splitlines())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(got) == {r["asin"] for r in rows[:-1]}
    for r in rows[:-1]:
        mine = got[r["asin"]]
        assert (mine.rating, mine.text, mine.helpful_vote, mine.title) == (float(r["overall"]), r["reviewText"], r["helpful"][0], "")


def test_many_files_of_many_lines_need_no_list(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(legacy, "FEW_FILES", 1)
    for k in range(3):
        (tmp_path / f"a{k}.json").write_text('[\n{"overall": %d}\n]' % k)
    (tmp_path / "lines.json").write_text('{"overall": 3}\n')
    rows = legacy.normalize_reviews(legacy.read_raw_any(spark, str(tmp_path), legacy.REVIEW_FIELDS)).collect()
    assert sorted(r.rating for r in rows) == [0.0, 1.0, 2.0, 3.0]


def test_a_mark_named_in_a_text_is_no_mark(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"rating": 4, "text": "overall fine", "title": "x"}\n{"rating": 3, "overall": null}\n')
    rows = {r.title: r for r in legacy.normalize_reviews(legacy.read_raw_any(spark, str(tmp_path), legacy.REVIEW_FIELDS)).collect()}
    assert rows["x"].rating == 4.0 and rows["x"].asin is None
    assert rows[""].rating is None and rows[""].asin == ""
