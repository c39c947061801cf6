import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ratings_engine.llm import rules


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_counts_against_brute_force(spark, awkward):
    more = spark.createDataFrame([
        (300, "a b c d e f g h " * 4 + "z", "en", "s0", 1), (301, "x\n y \nx\n\n\n y \n", "en", "s0", 1),
        (302, "# *$ a|b <c>\n# *$ a|b <c>", "en", "s0", 1), (303, "a " * 25, "en", "s0", 1),
        (304, "one two three four five six seven eight nine " * 2, "en", "s0", 1)], awkward.schema)
    docs = awkward.unionAll(more)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in rules.judge(docs).collect())
    assert got == Counter((r.doc_id, *base(r.text)) for r in docs.collect())


def test_outliers_of_a_group_go_and_others_stay(spark):
    plain = lambda i: " ".join(f"word{(i * 7 + k) % 97}x" for k in range(40))
    marked = lambda sign: "".join(f" {sign}{k}" for k in range(30))
    rows = [(i, plain(i), "en", "prose") for i in range(200)] + [(i, plain(i) + marked("#"), "en", "code") for i in range(200, 400)]
    rows += [(900, plain(1) + marked("$$$"), "en", "prose"), (901, plain(2) + marked("#"), "en", "code"),
             (902, plain(3) + "\n" + "same line here\n" * 40, "en", "prose"), (903, plain(5), None, None)]
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i].kept for i in range(400)) and got[901].kept and got[903].kept
    assert not got[900].kept and "symbols" in got[900].failed and not got[902].kept


def test_sketches_merge_to_the_same_quantiles(spark):
    values = [(lang, source, int(v)) for lang in "ab" for source in "xyz" for v in range(1, 500)]
    rows = spark.createDataFrame(values, "lang string, source string, v long").select(
        "lang", "source", F.array(F.struct(F.lit("symbols").alias("measure"), F.col("v").alias("value"))).alias("measures"))
    sketch = rules.sketches(rows)
    by_source = defaultdict(set)
    for r in rules.quantiles(sketch, ["lang", "source"]).unionByName(
            rules.quantiles(sketch, ["lang"]).withColumn("source", F.lit(None)), allowMissingColumns=True).collect():
        by_source[r.lang].add((r.limits["symbols"].low, r.limits["symbols"].high))
    assert len(by_source["a"] | by_source["b"]) == 1


def test_each_fence_moves_with_its_group(spark):
    """Two groups with other values get other fences for every measure; ten times the values, about ten times the fence."""
    rows = [(source, m, scale * (10 + i % 50)) for source, scale in (("calm", 1), ("wild", 10)) for i in range(300)
            for m in rules.MEASURES] + [("flat", m, 7) for m in rules.MEASURES for _ in range(300)]
    table = spark.createDataFrame([("en", s, m, int(v)) for s, m, v in rows], "lang string, source string, measure string, value long")
    sketch = rules.sketches(table.select("lang", "source", F.array(F.struct("measure", "value")).alias("measures")))
    got = {r.source: r.limits for r in rules.thresholds(sketch).collect()}
    for m in rules.MEASURES:
        calm, wild, flat = got["calm"][m].high, got["wild"][m].high, got["flat"][m].high
        assert 59 < calm < 120 and 8 * calm < wild < 12 * calm and 7 < flat
        assert (got["calm"][m].low is None) == (m not in rules.TWO_SIDED)
    assert got["wild"]["word_length"].low != got["calm"]["word_length"].low
    alone = rules.sketches(table.where("source = 'flat'").select("lang", "source", F.array(F.struct("measure", "value")).alias("measures")))
    assert all(x.high is None for x in rules.thresholds(alone).first().limits.values())


def test_no_rows(none):
    assert rules.judge(none).count() == 0
