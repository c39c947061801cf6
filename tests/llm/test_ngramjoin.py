import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from ratings_engine.llm import components, ngramjoin


def sets(text, n):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1))


def brute(rows, n, percent):
    found = [sets(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(found[i] & found[j])
            if found[i] and 100 * common >= percent * (len(found[i]) + len(found[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return sorted(((name, len(s), least.get(find(i)) if s else name) for i, ((name, _), s) in enumerate(zip(rows, found))), key=str)


def documents():
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghijklmnop") + str(rng.randrange(40))
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 80)))) for i in range(60)]
    base = [word() for _ in range(120)]
    for i in range(90):  # near copies with few or many changes, more than one block of them
        changed = base[:]
        for _ in range(rng.randint(0, 5)):
            changed[rng.randrange(len(changed))] = word()
        rows.append((100 + i, " ".join(changed)))
    passage = " ".join(word() for _ in range(15))
    rows += [(300 + i, " ".join(word() for _ in range(30)) + " " + passage) for i in range(30)]
    rows += [(400, "One two"), (401, "one TWO"), (402, "two one"), (403, None), (404, ""), (405, " \n"),
             (None, rows[5][1]), (5, rows[5][1]), (406, rows[60][1].upper())]
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("clash")).repartition(3)
    for n, percent, few, block in ((3, 90, 40, 256), (5, 80, 4, 20)):
        monkeypatch.setattr(ngramjoin, "FEW", few)
        monkeypatch.setattr(ngramjoin, "BLOCK", block)
        got = [tuple(r) for r in ngramjoin.link(docs, n=n, percent=percent).collect()]
        assert sorted(got, key=str) == brute(rows, n, percent)


def test_no_rows(none):
    assert ngramjoin.link(none).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, k) for k in range(101, 130)] + [(50, 50), (7, 3)]
    rows = components.connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert sorted((r.node, r.root) for r in rows) == [(i, 0) for i in range(21)] + [(k, 100) for k in range(100, 130)]


def test_candidates_travel_as_packed_texts_in_one_shuffle(spark):
    """Sets of 8 bytes a shingle used to be staged and shuffled for each of the joins that read them."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    texts = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(60)]
    common = " ".join(words[:400])
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " end") for i, t in enumerate(texts)]
    rows += [(200 + i, f"{common} {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = ngramjoin._features(docs, "text", "doc_id", 3, 90).withColumnRenamed("doc_id", "id")
    wanted = classes.select("class", "id")
    packed = ngramjoin._texts(docs, "text", "doc_id", 3, wanted).toPandas()
    sets = {bytes(c): x for c, x in zip(packed["class"], ngramjoin._sets(pa.array(packed["packed"], pa.binary()), 3))}
    assert {bytes(r["class"]): r.n_shingles for r in classes.collect()} == {c: len(x) for c, x in sets.items()}
    assert packed["packed"].map(len).sum() < 0.75 * sum(8 * len(x) for x in sets.values())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links, _ = ngramjoin._links(docs, "text", "doc_id", 3, 90, classes)
        plan = links._jdf.queryExecution()
        assert links.count() >= 60 + 59
        plan.toRdd().count()
        assert plan.executedPlan().toString().split("Initial Plan")[0].count("ReusedExchange") >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
