from collections import Counter

from pyspark.sql import functions as F

from ratings_engine.llm import mixing


def targets(sizes, copies=3):
    """Shares by weight, capped, the excess given to the others until none is above."""
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    open_, left, got = set(names), float(sum(sizes.values())), {}
    while open_:
        level = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if copies * sizes[n] < level * weight[n]}
        if not full:
            return got | {n: level * weight[n] for n in open_}
        for n in full:
            got[n] = float(copies * sizes[n])
            left -= got[n]
        open_ -= full
    return got


def test_targets_and_taken_words(spark, awkward):
    rows = mixing.mix(awkward, rows_per_range=5).collect()
    assert len(rows) == awkward.count() and Counter(r.doc_id for r in rows)[1] == 3
    sizes = Counter()
    for r in rows:
        assert r.size == len((r.text or "").split())
        sizes[r.source] += r.size
    want = targets(sizes)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for source, size in sizes.items():
        assert abs(taken[source] - want[source]) <= largest[source]


def test_reruns_and_ranges_agree(awkward):
    pick = lambda n: Counter(tuple(r) for r in mixing.mix(awkward, rows_per_range=n).select("doc_id", "size", "taken").collect())
    assert pick(3) == pick(3) == pick(10 ** 6)


def test_better_documents_are_taken_more_often(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("five words in this text").alias("text"),
                                    F.lit("small").alias("source"))
    docs = docs.unionAll(spark.range(2000, 10000).select("id", F.lit("a b c d e"), F.lit("large")))
    good = F.col("doc_id") % 2 == 0
    rows = mixing.mix(docs, quality=F.when(good, 1.0).otherwise(0.2)).where("source = 'large'").collect()
    even, odd = (sum(r.taken for r in rows if r.doc_id % 2 == k) for k in (0, 1))
    assert even > 1.3 * odd > 0


def test_no_rows_and_clashing_names(none, awkward):
    assert mixing.mix(none).count() == 0
    clash = awkward.withColumns({"size": F.lit("x"), "key": F.lit(1), "range": F.lit(2), "id": F.lit(3)})
    got = mixing.mix(clash)
    assert got.columns.count("size") == 1 and dict(got.dtypes)["size"] == "bigint"
    assert {(r.key, r.range, r.id) for r in got.collect()} == {(1, 2, 3)}


def test_ranges_hold_about_equally_many_rows_whatever_the_quality(spark):
    docs = spark.range(0, 8000, 1, 4).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 7000, "hot").otherwise("b").alias("source"),
                                             F.lit("w").alias("text"))
    quality = F.when(F.col("doc_id") % 2 == 0, 0.1).otherwise(1.0)
    rows = docs.select(F.col("source").alias("key"), F.round(mixing.LEVELS * F.log(quality)).cast("int").alias("level"),
                       mixing.exponential_key(F.col("doc_id"), quality, "s").alias("draw"))
    got = mixing._with_ranges(rows, 500)
    counts = got.groupBy("key", "range").agg(F.count("*").alias("n"), F.min("draw").alias("low"), F.max("draw").alias("high")).collect()
    hot = sorted((r for r in counts if r.key == "hot"), key=lambda r: r.range)
    assert len(hot) == 14 and max(r.n for r in counts) < 700
    assert all(a.high < b.low for a, b in zip(hot, hot[1:]))
