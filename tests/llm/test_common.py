import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratings_engine.llm import common, text


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_sums_of_arrays_over_many_tasks(spark, parts, monkeypatch):
    monkeypatch.setattr(common, "FAN_IN", 3)

    def add(total, column):
        for value in column.to_pylist():
            total[value % 4] += value

    rows = spark.range(200).repartition(parts)
    want = [sum(v for v in range(200) if v % 4 == k) for k in range(4)]
    assert common.summed(rows, np.zeros(4, np.int64), add).tolist() == want
    assert common.summed(rows.where("id < 0"), np.zeros(4, np.int64), add).tolist() == [0] * 4


def test_words_and_ngrams_by_hash():
    texts = pa.array(["One two  three\ttwo", None, "", "\n x", "one TWO three two", "é" * 5])
    data, offsets = text.raw(texts)
    starts, ends, owner = text.word_bounds(data, offsets)
    words = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert words == ["One", "two", "three", "two", "x", "one", "TWO", "three", "two", "é" * 5]
    assert owner.tolist() == [0, 0, 0, 0, 3, 4, 4, 4, 4, 5]
    lower, exact = (text.word_hashes(data, starts, ends, flag) for flag in (True, False))
    assert lower[:4].tolist() == lower[5:9].tolist() and lower[1] == lower[3]
    assert exact[0] != exact[5] and len(set(lower.tolist())) == 5
    pairs, of = text.ngrams(lower, owner, 2)
    assert of.tolist() == [0, 0, 0, 4, 4, 4] and pairs[:3].tolist() == pairs[3:].tolist()


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    column = pa.array(["alpha beta gamma delta " * 50, "y" * 400 + " beta"])
    data, offsets = text.raw(column)
    starts, ends, _ = text.word_bounds(data, offsets)
    whole = text.word_hashes(data, starts, ends)
    monkeypatch.setattr(text, "SLICE", 16)
    assert text.word_hashes(data, starts, ends).tolist() == whole.tolist()
    assert sum(len(p) for p in text.pieces(column, 10)) == 2


def test_let_computes_once(spark):
    row = spark.range(1).select(common.let(F.rand(1), lambda x: x - x).alias("d")).first()
    assert row.d == 0.0
