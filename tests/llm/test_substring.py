import random
import re
from collections import Counter

import pytest

from ratings_engine.llm import substring

LENGTH = 6


def brute(rows, length):
    later = lambda i: (i is None, i if i is not None else 0)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (name, _), w in zip(rows, words):
        for p in range(len(w) - length + 1):
            key = tuple(w[p:p + length])
            first[key] = min(first.get(key, later(name)), later(name))
    out = []
    for (name, _), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - length + 1):
            if first[tuple(w[p:p + length])] < later(name):
                gone.update(range(p, p + length))
        out.append((name, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


def documents(seed=5):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice(["", "é", "Z"]) for _ in range(n))
    passages = [text(n) for n in (LENGTH, 12, 30)]
    rows = []
    for i in range(80):
        parts = [text(rng.randint(0, 20)), rng.choice(passages), text(rng.randint(0, 9)), rng.choice([*passages, "", passages[2][9:31]])]
        rows.append((i, rng.choice([" ", "\n ", "\t"]).join(parts)))
    near = rows[7][1].split()
    rows += [(100 + k, " ".join(near[:k] + ["edit"] + near[k + 1:])) for k in range(12)]
    rows += [(200 + k, rows[9][1]) for k in range(30)] + [(3, rows[3][1]), (3, rows[4][1]), (4, rows[3][1])]
    rows += [(None, rows[5][1]), (None, "only without an id but twice there " * 2), (None, "only without an id but twice there " * 2),
             (400, None), (401, ""), (402, " \n\t "), (403, "a " * 200), (404, "a " * 90 + "b"), (405, "a b " * 3), (406, "a b " * 20)]
    return rows


@pytest.mark.parametrize(("counters", "gram"), [(1 << 28, 3), (64, 3), (1 << 12, 1), (1 << 20, 50)])
def test_against_brute_force(spark, counters, gram):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring.remove_repeats(docs, length=LENGTH, gram=gram, most_counters=counters)
    assert Counter(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept").collect())) == brute(rows, LENGTH)


def test_long_windows_and_segments(spark, monkeypatch):
    rows = documents(6)
    monkeypatch.setattr(substring, "SEGMENT", 17)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.remove_repeats(docs, length=15).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert Counter(map(tuple, got)) == brute(rows, 15)


def test_awkward_rows_text_ids_and_clashing_names(spark, awkward, none):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = substring.remove_repeats(awkward).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert Counter(map(tuple, got)) == brute(rows, 50)
    assert substring.remove_repeats(none).count() == 0
    named = spark.createDataFrame([("b", "x " * 60, 1, "k", 2), ("a", "x " * 60, 3, "r", 4)],
                                  "doc_id string, text string, N_words int, key string, row int")
    out = substring.remove_repeats(named)
    assert out.columns == ["doc_id", "text", "key", "row", "n_words", "n_removed", "kept"]
    assert {(r.doc_id, r.key, r.row, r.n_removed) for r in out.collect()} == {("a", "r", 4, 0), ("b", "k", 2, 60)}


def test_sketch_never_underestimates(spark):
    rows = documents()
    docs = spark.createDataFrame([(t or "",) for _, t in rows], "text string").repartition(7)
    small = substring.repeated_counters(docs, LENGTH, 3, 1 << 8)
    large = substring.repeated_counters(docs, LENGTH, 3, 1 << 22)
    bits = lambda planes: sum(int(x).bit_count() for x in planes.ravel())
    assert bits(small[0]) <= 1 << 8 and bits(large) > 0
    seen = Counter()
    for _, t in rows:
        import pyarrow as pa
        anchors = {int(a) for part in substring._runs(pa.array([t or ""]), LENGTH, 3) for a in part[2]}
        seen.update(anchors)
    import numpy as np
    for planes in (small, large):
        for row in range(substring.ROWS):
            place = substring._counters(np.array([a for a, n in seen.items() if n > 1], np.uint64), row, planes.shape[1] << 6)
            assert ((planes[row][(place >> np.uint64(6)).astype(int)] >> (place & np.uint64(63))) & np.uint64(1)).all()
