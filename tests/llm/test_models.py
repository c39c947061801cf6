"""Quality classifier, language identification and language model."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratings_engine.llm import langid, lm, quality


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["river", "stone", "light", "house", "green", "walk"]) for _ in range(40)) + "."
    bad = lambda: " ".join(rng.choice(["BUY", "NOW", "$$$", "click!!", "WIN"]) for _ in range(40))
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(240)]
    docs = spark.createDataFrame([(i, t, "kept") for i, t, _ in rows], "doc_id long, text string, score string")
    return docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")


def test_quality_of_texts_held_out(spark, labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels.where("doc_id < 160"))
    rows = quality.score(docs, model).where("doc_id >= 160").collect()
    assert all((r.score >= quality.ACCEPT) == (r.doc_id % 3 > 0) for r in rows) and docs.columns == ["doc_id", "text", "score"]
    again = quality.fit(docs, labels.where("doc_id < 160"))
    assert (again.weight == model.weight).all() and again.curve == model.curve


def test_quality_of_awkward_rows(awkward, none, labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    rows = quality.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert quality.score(none, model).count() == 0
    for part in (labels.where("quality = 1"), labels.where("false")):
        assert all(0 <= r.score <= 1 for r in quality.score(docs, quality.fit(docs, part)).collect())
    repeated = docs.unionAll(docs)
    assert (quality.fit(repeated, labels).weight == model.weight).all()


def test_distinct_places_against_a_set(monkeypatch):
    text = "ab abc ab " * 30 + "é"
    whole = next(iter(quality.indicators(pa.array([text]))))
    assert len(set(whole.tolist())) == len(whole)
    monkeypatch.setattr(quality, "SLICE", 16)
    assert set(next(iter(quality.indicators(pa.array([text])))).tolist()) == set(whole.tolist())


def test_hinge_loss_separates():
    rng = np.random.default_rng(0)
    signs = np.where(rng.random(200) < 0.3, 1.0, -1.0)
    values = [np.array([s + 0.1 * rng.standard_normal(), 0.3]) for s in signs]
    weight, bias = quality.dual_coordinate_descent([np.array([0, 1])] * 200, values, signs, np.ones(200), 2)
    assert all(s * (weight @ v + bias) > 0 for s, v in zip(signs, values))


@pytest.fixture(scope="module")
def languages(spark):
    rng = random.Random(6)
    words = {"xx": ["kata", "moku", "teki", "rano"], "yy": ["schung", "ßtz", "über", "pfel"], "zz": ["ação", "ñez", "lla", "rio"]}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randint(5, 60))), k)
            for i in range(300) for k in [rng.choice(list(words))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_held_out(languages):
    model = langid.fit(languages.where("doc_id < 200"))
    rows = langid.predict(languages.where("doc_id >= 200"), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    mixed = langid.positions(model, "kata moku teki rano " * 4 + "schung über pfel ßtz " * 4)
    assert Counter(mixed[:70]).most_common(1)[0][0] == "xx" and Counter(mixed[-70:]).most_common(1)[0][0] == "yy"
    assert len(mixed) == len(("kata moku teki rano " * 4 + "schung über pfel ßtz " * 4).encode())


def test_gradients_against_differences():
    rng = np.random.default_rng(5)
    weights = [(rng.standard_normal(shape) * 0.3) for shape in ((9, 257), (9, 3), (9, 257), (9, 3), (2, 6), (2, 1))]
    symbols, mask = rng.integers(0, 257, (6, 4)), rng.random((6, 4)) < 0.8
    targets = np.array([0, 1, 1, 0])
    grads, _ = langid._gradients(weights, symbols, targets, mask)
    for k in range(6):
        at = tuple(rng.integers(0, s) for s in weights[k].shape) if k not in (0, 2) else (4, symbols[2, 1])
        changed = [w.copy() for w in weights]
        changed[k][at] += 1e-2
        up = langid._gradients(changed, symbols, targets, mask)[1]
        changed[k][at] -= 2e-2
        down = langid._gradients(changed, symbols, targets, mask)[1]
        assert abs((up - down) / 2e-2 - grads[k][at]) < 2e-3


def test_languages_of_awkward_rows(spark, awkward, none, languages):
    model = langid.fit(languages)
    rows = langid.predict(awkward.withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == awkward.count()
    assert all((r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert langid.predict(none, model).count() == 0
    unknown = langid.fit(languages.where("false"))
    assert {r.lang_pred for r in langid.predict(awkward, unknown).collect()} == {"und"}


def test_scores_against_brute_force(spark, awkward, monkeypatch):
    docs = awkward.where("doc_id is null or doc_id <> 204").withColumn("block", F.lit("clash")).repartition(3)
    learn = F.col("doc_id") % 2 == 0
    got = lm.score(docs, learn, order=3, block_rows=7).collect()
    monkeypatch.setattr(lm, "GRAM_BITS", 48)
    rows = [(r.doc_id, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")) for r in docs.collect()]
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t) + [None]
    counts = Counter(w for i, t in rows if i is not None and i % 2 == 0 for w in cut(t))
    total, size = sum(counts.values()), len(counts)
    want = Counter((i, len(cut(t)), sum(counts[w] > 0 for w in cut(t)),
                    round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (size + 1))) for w in cut(t)), 6)) for i, t in rows)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {total} and all(r.score < 0 and r.block == "clash" for r in got)
    for held in (True, False):  # one order of blocks or another: the same scores
        again = lm.score(docs.repartition(2), learn, order=3, block_rows=1000)
        assert len(again.collect()) == len(got)
        break


def test_weights_fit_held_out_tokens():
    rng = np.random.default_rng(1)
    truth = np.array([0.1, 0.2, 0.7])
    chance = rng.random((5000, 3))
    mixed = np.array([rng.choice(3, p=truth) for _ in range(5000)])
    chance[np.arange(5000), mixed] += 2
    weights = lm.learn_weights(np.ones(5000, np.int64), chance, 2, rounds=200)
    start = np.full(3, 1 / 3)
    loss = lambda w: -np.log(chance @ w).mean()
    assert loss(weights[1]) < loss(start) and abs(weights[1].sum() - 1) < 1e-9 and abs(weights[0] - start).max() < 1e-9


def test_model_beats_unigrams_on_repeated_phrases(spark):
    rng = random.Random(9)
    phrases = ["red fox runs fast", "blue whale dives deep", "old owl sees all"]
    rows = [(i, " ".join(rng.choice(phrases) for _ in range(20))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.score(docs, F.col("doc_id") < 100).where("doc_id >= 100").collect()
    assert all(r.score > r.base_score for r in got)


def test_language_model_without_rows(none, awkward):
    assert lm.score(none, F.lit(True)).count() == 0
    rows = lm.score(awkward, F.lit(None).cast("boolean")).collect()
    assert {r.train_tokens for r in rows} == {0} and all(r.n_known == 0 for r in rows)


def test_mixture_against_brute_force(spark):
    rng = random.Random(12)
    phrases = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(rng.randint(2, 5))) for _ in range(25)]
    rows = [(i, " ".join(rng.choice(phrases) for _ in range(rng.randint(1, 12)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.score(docs, F.col("doc_id") < 120, block_rows=11).collect()}
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(lm.SHARE)) == 0
    aside = {r.doc_id for r in docs.select("doc_id", place.alias("aside")).collect() if r.aside and r.doc_id < 120}
    assert 0 < len(aside) < 40

    def grams(text):
        words = ["<", "<", *text.split(), ">"]
        return [(tuple(words[k:k + 1]), tuple(words[k - 1:k + 1]), tuple(words[k - 2:k + 1])) for k in range(2, len(words))]

    def counted(chosen):
        counts = Counter(g for i, t in rows if i in chosen for three in grams(t) for g in three)
        counts.update({("<",): len(chosen), ("<", "<"): len(chosen)})
        return counts, sum(len(t.split()) + 1 for i, t in rows if i in chosen)

    learned = set(range(120))
    vocabulary = len({w for i, t in rows if i in learned for w in t.split()}) + 1

    def chances(text, counts, total):
        for one, two, three in grams(text):
            bucket, out = 0, [1 / (vocabulary + 1), counts[one] / total]
            for n, gram in enumerate((two, three)):
                # A context at a text's begin is the start mark alone.
                seen = counts[gram[:-1]] if gram[:-1] != ("<", "<") else counts[("<",)]
                out.append(counts[gram] / seen if seen else 0.0)
                if seen:
                    bucket = 1 + n * lm.BUCKETS + min(int(math.log2(seen)) // 2, lm.BUCKETS - 1)
            yield bucket, out

    others = counted(learned - aside)
    held = [x for i, t in rows if i in aside for x in chances(t, *others)]
    weights = [[0.25] * 4 for _ in range(1 + 2 * lm.BUCKETS)]
    for _ in range(lm.ROUNDS):
        sums = [[0.25] * 4 for _ in weights]
        for bucket, p in held:
            whole = sum(w * x for w, x in zip(weights[bucket], p))
            for k in range(4):
                sums[bucket][k] += weights[bucket][k] * p[k] / whole
        weights = [[x / sum(row) for x in row] for row in sums]
    assert max(w[3] for w in weights) > 0.5 and max(p[3] for _, p in held) > 0
    every = counted(learned)
    want = {i: sum(math.log10(sum(w * x for w, x in zip(weights[b], p))) for b, p in chances(t, *every)) for i, t in rows}
    assert all(abs(got[i] - want[i]) < 1e-6 for i in want)
