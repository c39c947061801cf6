import random
import re
import zlib
from collections import Counter

import pytest

from ratings_engine.llm import variants


def near(a, b):
    """Exactly one insertion, deletion or replacement."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(counts, ratio=10):
    form, out = {}, {}
    for w in counts:
        close = [x for x in counts if near(w, x)]
        best = min(close, key=lambda x: (-counts[x], [ord(c) for c in x]), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
        out[w] = len(close)
    rows = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, counts[w], out[w], counts[form[w]] if form[w] else None))
    return rows


def words(rng, n, letters, sizes):
    return {"".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(n)}


@pytest.mark.parametrize("most", [1, 4, 20000])
def test_near_words_against_brute_force(spark, most):
    rng = random.Random(most)
    found = words(rng, 150, "ab", range(1, 8)) | words(rng, 150, "abcé", range(3, 9)) | words(rng, 60, "xyzÿ", [11, 12, 13])
    found |= {"a" * n for n in range(1, 12)} | {"ab" * n for n in range(1, 7)} | {"ba" * n for n in range(1, 7)}
    vocabulary = spark.createDataFrame([(w, len(w)) for w in found], "word string, n long").repartition(3)
    got = Counter((r.word, r.near, r.n, r.near_n) for r in variants.near_words(vocabulary, most).collect())
    assert got == Counter((a, b, len(a), len(b)) for a in found for b in found if near(a, b))


def test_forms_and_roots_against_brute_force(spark):
    rng = random.Random(4)
    counts = {w: 10 ** rng.randint(0, 5) for w in words(rng, 300, "abc", range(4, 8))}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = variants.group(vocabulary, most=8)
    assert {tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()} == brute(counts)
    chain = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "aaabbbb": 10000, "zzzzzzz": 5}
    got = {r.word: r.root for r in variants.group(spark.createDataFrame(list(chain.items()), "word string, n long")).collect()}
    assert got == {**dict.fromkeys(chain, "aaabbbb"), "zzzzzzz": "zzzzzzz"}


def vocabulary(rows, one_in):
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_documents_against_brute_force(spark, awkward, none):
    rng = random.Random(9)
    pool = ["Erinnerung", "erinnerung", "Größenwahn", "señalización", "ÀÉÎÕÜÿ÷×a", "common", "repeated", "Repeatedly"]
    rows = [(i, " ".join(rng.choice(pool) + rng.choice(["", ",", "x", "-y"]) for _ in range(60))) for i in range(60)]
    rows += [(r.doc_id, r.text) for r in awkward.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({}).selectExpr("*", "1 as word", "2 as n")
    want = vocabulary(rows, 5)
    assert {r.word: r.n for r in variants.vocabulary(docs, one_in=5).collect()} == want
    got = variants.variants(docs, one_in=5).select("word", "form", "root", "n", "n_near", "form_n")
    assert {tuple(r) for r in got.collect()} == brute(want)
    assert variants.variants(none).count() == 0


def test_queries_may_be_few_at_a_time():
    rng = random.Random(1)
    found = sorted(words(rng, 80, "ab", range(3, 7)))
    codes, size = variants._codes(found)
    import numpy as np
    pairs = lambda step: {(int(i), int(j)) for a, b in variants.near_in_groups(
        codes, size, np.zeros(len(found), int), size == 4, step) for i, j in zip(a, b)}
    assert pairs(1) == pairs(4096) == {(i, j) for i in range(len(found)) for j in range(len(found)) if len(found[i]) == 4
                                       and near(found[i], found[j]) and (len(found[j]) == 5 or (len(found[j]) == 4 and i < j))}
