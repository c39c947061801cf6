import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratings_engine.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*[enc(row[c]) for c in COLUMNS])


def climb(digests, fanout):
    """The root and, per leaf, its (before, after) siblings of each level."""
    place, steps = list(range(len(digests))), [[] for _ in digests]
    while len(digests) > 1:
        for k in range(len(steps)):
            first = place[k] // fanout * fanout
            run = digests[first:first + fanout]
            steps[k].append(("".join(run[:place[k] - first]), "".join(run[place[k] - first + 1:])))
            place[k] //= fanout
        digests = [h(*digests[p:p + fanout]) for p in range(0, len(digests), fanout)]
    return digests[0], steps


def brute(rows, fanout):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    low = {n: climb([x[2] for x in sorted(groups[n])], fanout) for n in names}
    root, high = climb([low[n][0] for n in names], fanout)
    out = []
    for n, upper in zip(names, high):
        for (has, key, digest), steps in zip(sorted(groups[n]), low[n][1]):
            out.append((key if has else None, n, digest, low[n][0], root, h(*[a + b for a, b in steps + upper])))
    return sorted(out, key=str)


def listed(docs, **options):
    found = merkle.manifest(docs, COLUMNS, **options)
    return found, sorted((tuple(r) for r in found.select(
        "doc_id", "lang", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps"))).collect()), key=str)


@pytest.mark.parametrize(("fanout", "band"), [(2, 6), (2, 2), (3, 1), (5, 2)])
def test_against_brute_force(spark, fanout, band):
    rng = random.Random(fanout)
    sizes = {"en": 37, "de": 16, "fr": 1, "es": 17, None: 5, "é": 2, "zz": 3}
    rows = [dict(doc_id=rng.randrange(10 ** 6), text="é" * rng.randrange(9), lang=n, source=rng.choice(["s", None]),
                 n_chars=rng.choice([None, 4])) for n, size in sizes.items() for _ in range(size)]
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    found, got = listed(docs, fanout=fanout, band=band)
    assert got == brute(rows, fanout)
    assert found.where(merkle.folded(F.col("leaf"), F.col("steps")) != F.col("root")).isEmpty()


def test_awkward_rows(spark, awkward):
    rows = [r.asDict() for r in awkward.collect()]
    assert listed(awkward)[1] == brute(rows, 2)
    assert listed(awkward.withColumns({c: F.lit(1) for c in ("tree", "low", "steps", "kept", "rank")}))[1] == brute(rows, 2)


def test_tampering_shows(spark, awkward):
    claimed = F.unhex(merkle.leaf_digest(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]))
    found = merkle.manifest(awkward, COLUMNS, keep={"claimed": claimed, "chars": F.col("n_chars")})
    held = found.select("chars", (merkle.folded(F.lower(F.hex("claimed")), F.col("steps")) == F.col("root")).alias("held"))
    assert {(r.chars is None, r.held) for r in held.collect()} == {(True, True), (False, False)}


def test_no_rows_and_one_row(spark, awkward, none):
    assert merkle.manifest(none, COLUMNS).count() == 0
    one = awkward.where("doc_id = 5")
    row = merkle.manifest(one, COLUMNS).first()
    assert row.leaf == row.subroot == row.root == leaf(one.first().asDict()) and row.steps == []
