import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ratings_engine.llm import suffix
from ratings_engine.sources import storage

LENGTH = 40


def brute(rows):
    seen = Counter(b[p:p + LENGTH] for _, t in rows for b in [(t or "").encode()] for p in range(len(b) - LENGTH + 1))
    out = []
    for name, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - LENGTH + 1):
            if seen[data[p:p + LENGTH]] > 1:
                gone[p:p + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out.append((name, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def documents():
    rng = random.Random(1)
    text = lambda k: " ".join(rng.choice(["ab", "cde", "f", "ghij"]) + str(rng.randrange(50)) for _ in range(k))
    passage = text(40)
    rows = [(i, text(rng.randrange(1, 60)) + (" " + passage if i % 4 == 0 else "") + (passage[20:120] if i % 5 == 0 else ""))
            for i in range(30)]
    return rows + [(100, rows[3][1]), (3, rows[3][1]), (101, None), (102, ""), (103, "é" * 60), (104, "x" * 39),
                   (105, "x" * 41), (106, passage + "Q" + passage), (None, "\0" * 90), (107, passage[:LENGTH])]


@pytest.mark.parametrize("small", [1 << 20, 1500])
def test_against_brute_force(spark, small):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix.remove_repeats(docs, length=LENGTH, gram=8, small=small).drop("spans").collect()
    assert Counter(tuple(r) for r in got) == brute(rows)


def test_ranks_order_all_suffixes(spark):
    rng = random.Random(2)
    data = bytes(rng.choice(b"ab") for _ in range(250)) + b"abab" * 20
    size = len(data) // 3 * 3 + 6
    symbols = [data[i] + 1 if i < len(data) else 0 for i in range(size)]
    ranks = suffix.suffix_ranks(spark.createDataFrame(list(enumerate(symbols)), "pos long, sym long"), 100, small=40)
    got = [r.pos for r in ranks.orderBy("rank").collect()]
    padded = symbols + [0] * 100
    assert [padded[p:p + 100] for p in got] == sorted(padded[p:p + 100] for p in range(size))


def test_anchors_are_least_hashes_of_their_string():
    data = np.frombuffer(b"abcabcabcabc" * 9 + b"xyzxyz" * 9, np.uint8)
    place, hashes = suffix.anchors(data, 30, 8)
    for p in range(len(data) - 29):
        window = hashes[p:p + 23]
        assert place[p] == p + int(window.argmin())


def test_no_rows_and_no_repeats(spark, none):
    assert suffix.remove_repeats(none).count() == 0
    docs = spark.createDataFrame([(1, "short"), (2, "z" * 10 + "".join(map(str, range(300))))], "doc_id long, text string")
    assert [r.n_removed for r in suffix.remove_repeats(docs, length=LENGTH, gram=8).collect()] == [0, 0]


def test_strings_longer_than_the_default_depth(spark):
    """Equal strings of 7,000 bytes are found whatever lies beside them in suffix order."""
    rng = random.Random(6)
    unit = "".join(rng.choice("ab") for _ in range(2500))
    long = unit * 2 + "".join(rng.choice("ab") for _ in range(2000))
    near = [unit * 2 + "".join(rng.choice("ab") for _ in range(2000)) for _ in range(3)]
    rows = [(1, long + "X"), (2, "Y" + long), *[(10 + i, t) for i, t in enumerate(near)]]
    got = {r.doc_id: r.n_removed for r in suffix.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string"), length=6990).collect()}
    assert got == {1: 7000, 2: 7000, 10: 0, 11: 0, 12: 0}


def test_candidates_are_fragments_and_no_rows_per_byte(spark, monkeypatch):
    """Repeated passages stay fragments of many bytes; only frequent anchors are taken apart."""
    sizes = {}

    stage = storage.stage

    def counted(df, label):
        out, path = stage(df, label)
        sizes[label] = sizes.get(label, 0) + out.count()
        return out, path

    monkeypatch.setattr(storage, "stage", counted)
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh") for _ in range(3000))
    rows = [(i, passage[i:] + chr(65 + i)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix.remove_repeats(docs).collect()}
    assert got[0] == 2999 and got[19] == 2981
    assert "symbols" not in sizes and sum(sizes.values()) < 20 * 3000 / 20


@pytest.mark.parametrize("small", [1, 600, 4000])
def test_frequent_anchors_are_split_and_ranked(spark, small):
    """A passage in many contexts: by parts, and by ranks of suffixes if these are too many as well."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcd") for _ in range(LENGTH + 3))
    rows = documents() + [(200 + i, f"{i:03d}"[::-1] * 7 + passage[i % 9:LENGTH - 2 + i % 6] + f"{i * 7 % 50:03d}" * 9)
                          for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix.remove_repeats(docs, length=LENGTH, gram=8, small=small).drop("spans").collect()
    assert Counter(tuple(r) for r in got) == brute(rows)


def test_strings_equal_on_both_sides_of_the_anchor():
    found = suffix.repeated_strings(np.array([5, 5, 9]), np.array([3, 3, 3]), np.array([4, 4, 4]),
                                    [b"xyzabcdefg", b"_yzabcdef-", b"xyzabcdefg"], 7)
    assert found.tolist() == [[False, True, True, False]] * 2 + [[False] * 4]


def test_segments_and_long_periods(spark):
    """Texts longer than a segment, texts that repeat themselves, and texts in one batch that touch."""
    rng = random.Random(11)
    unit = "".join(rng.choice("abcdefgh") for _ in range(97))
    long = "".join(rng.choice("ab") for _ in range(70000))
    rows = [(1, unit * 30), (2, "q" * 3000), (3, unit[:50] + "é" * 200 + unit * 3), (4, long), (5, "#" + long[60000:] + "#"),
            (6, long[:39]), (7, long[39:80]), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = suffix.remove_repeats(docs, length=LENGTH, gram=8).drop("spans").collect()
    assert Counter(tuple(r) for r in got) == brute(rows)


def test_repeats_inside_one_text_across_segments(spark):
    """The two places lie in different segments, of a long text and of a short one on a border between two."""
    rng = random.Random(12)
    text = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    far, near = text(60), text(50)
    for rows in ([(1, far + text(100000) + far), (2, text(200))],
                 [(1, text(suffix.SEGMENT - 100)), (2, near + text(100) + near), (3, text(70))]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        got = suffix.remove_repeats(docs, length=LENGTH, gram=8).drop("spans").collect()
        assert Counter(tuple(r) for r in got) == brute(rows)
