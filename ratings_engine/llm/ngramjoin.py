"""Near duplicates by exact Jaccard similarity of word shingles: a grouped prefix join.

Documents with equal shingle sets form one class. If two sets are similar enough, the rarest few
shingles of both (their prefixes) share one. Classes with the same prefix and size form one group;
groups meet where they share a prefix shingle and their sizes allow the similarity; then the members
are verified on their whole sets.

Rarity comes from a count sketch of fixed size over all documents. It only sets the order, so its
errors cost time and never a link. Shingles shared by few classes give pairs of classes, joined with
their sets. Shingles shared by many go to units of two blocks of classes, compared inside one task,
which returns a spanning forest of the links it found instead of pairs.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratings_engine.llm.common import staged, summed
from ratings_engine.llm.components import connected
from ratings_engine.llm.text import mix, shingle_sets
from ratings_engine.sources import storage

#: Counters of the sketch (4 MB), whatever the corpus.
SKETCH = 1 << 20
#: Shingles shared by more classes than this are compared in blocks.
FEW = 40
BLOCK = 1024
#: Bits of the filter that lets candidates' texts through when their sets are read (2 MB).
FILTER_BITS = 1 << 24


def _sketch(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """Document counts of shingles by hash; bounded by SKETCH."""

    def count(counts, column):
        for found in shingle_sets(column, n):
            # A set holds a shingle once, but two of its shingles may share a counter.
            places, times = np.unique(found & np.uint64(SKETCH - 1), return_counts=True)
            counts[places.astype(np.int64)] += times.astype(np.uint32)

    return summed(docs.select(text), np.zeros(SKETCH, np.uint32), count)


def least_overlap(size, percent: int):
    return -(-percent * size // 100)


def _features(docs: DataFrame, text: str, doc_id: str, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, class, group, prefix): class stands for the set, group for prefix and size."""
    counts = docs.sparkSession.sparkContext.broadcast(_sketch(docs, text, n))

    def features(batches):
        for batch in batches:
            rows = {"n_shingles": [], "class": [], "group": [], "prefix": []}
            for found in shingle_sets(batch.column(1), n):
                size = len(found)
                order = np.lexsort((found, counts.value[(found & np.uint64(SKETCH - 1)).astype(np.int64)]))
                prefix = found[order[:size - least_overlap(size, percent) + 1]] if size else found
                packed = prefix.tobytes() + size.to_bytes(8, "little")
                rows["n_shingles"].append(size)
                rows["class"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                rows["group"].append(int.from_bytes(hashlib.blake2b(packed, digest_size=8).digest(), "little", signed=True))
                rows["prefix"].append(prefix.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(rows["n_shingles"], pa.int64()),
                 pa.array(rows["class"], pa.binary()), pa.array(rows["group"], pa.int64()),
                 pa.array(rows["prefix"], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "class", "group", "prefix"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text).mapInArrow(
        features, "doc_id bigint, n_shingles bigint, class binary, group bigint, prefix array<bigint>")


def _texts(docs: DataFrame, text: str, doc_id: str, n: int, wanted: DataFrame) -> DataFrame:
    """(class, packed) of the wanted classes (class, id): a text with the class's set, compressed, as that
    takes a third of the set's room. A bit filter of fixed size on the ids picks the texts to read
    again; the exact join by class follows."""
    position = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    marked = wanted.select(position(F.col("id")).alias("p")).groupBy(F.expr("bitmap_bucket_number(p + 1)").alias("b")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(p + 1))").alias("bits"))
    for bucket, packed in marked.collect():
        at = (bucket - 1) * len(packed)
        bits[at:at + len(packed)] = np.frombuffer(packed, np.uint8)
    filter_ = docs.sparkSession.sparkContext.broadcast(np.packbits(np.unpackbits(bits, bitorder="little")))

    def packed(batches):
        for batch in batches:
            at = batch.column(1).to_numpy()
            keep = (filter_.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            texts = batch.column(0).filter(pa.array(keep.astype(bool)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in shingle_sets(texts, n)], pa.binary()),
                 pa.array([zlib.compress((x.as_py() or "").encode()) for x in texts], pa.binary())], ["class", "packed"])

    rows = docs.select(text, position(F.col(doc_id).cast("bigint")).alias("p")).mapInArrow(
        packed, "class binary, packed binary")
    return rows.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])


def _sets(packed: pa.Array, n: int):
    """The shingle sets of compressed texts, few texts at a time."""
    for first in range(0, len(packed), 64):
        yield from shingle_sets(pa.array([zlib.decompress(x.as_py()).decode() for x in packed[first:first + 64]]), n)


def _alike(n: int, percent: int):
    def verify(batches):
        """The pairs (a, b) whose sets, from packed_a and packed_b, are similar enough."""
        for batch in batches:
            keep = []
            for x, y in zip(_sets(batch.column(2), n), _sets(batch.column(3), n), strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _forest(n: int, percent: int):
    def verify(table: pa.Table) -> pa.Table:
        """A spanning forest of the links between the classes of one unit."""
        names = table.column("class").combine_chunks()
        sets = list(_sets(table.column("packed").combine_chunks(), n))
        sizes = np.array([len(x) for x in sets])
        values = np.concatenate(sets)
        _, column, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = times > 1
        place = np.cumsum(shared) - 1
        row = np.repeat(np.arange(len(sizes)), sizes)
        row, column = row[shared[column]], place[column[shared[column]]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(sizes), len(sizes)), np.float32)
        for low in range(0, int(shared.sum()), 4096):
            a, b = np.searchsorted(column, (low, low + 4096))
            dense = np.zeros((len(sizes), 4096), np.float32)
            dense[row[a:b], column[a:b] - low] = 1
            both += dense @ dense.T
        union = sizes[:, None] + sizes[None, :] - both
        left, right = np.nonzero(np.triu(100 * both >= percent * union, 1))
        root = np.arange(len(sizes))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        edges = []
        for x, y in zip(left.tolist(), right.tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[q] = p
                edges.append((x, y))
        take = lambda k: names.take(pa.array([e[k] for e in edges], pa.int64()))
        return pa.table({"a": take(0), "b": take(1)})

    return verify


def _links(docs: DataFrame, text: str, doc_id: str, n: int, percent: int, classes: DataFrame) -> tuple[DataFrame, list[str]]:
    """(a, b): links between classes that connect everything that links connect; the staged tables they read."""
    # Groups with one hash by accident would only be verified together.
    groups = classes.groupBy("group").agg(F.count("*").cast("int").alias("members"),
                                          F.first("n_shingles").cast("int").alias("n"), F.first("prefix").alias("prefix"))
    postings = groups.select("group", "n", "members", F.posexplode("prefix").alias("place", "shingle"))
    # Shingles found in the same groups give the same pairs: the first of them in order stands for all,
    # known by weight and two checksums of the groups. One shuffle brings a shingle's groups together; it
    # is asked for, or the checksums would be made before it and moved.
    same = Window.partitionBy("shingle")
    postings = postings.repartition("shingle").withColumns({
        "weight": F.sum("members").over(same), "first": F.min("place").over(same),
        "c": F.bit_xor(F.xxhash64("group")).over(same), "d": F.bit_xor(F.xxhash64("group", F.lit("d"))).over(same)})
    spark = docs.sparkSession
    shared, shared_path = storage.stage(postings.where("weight > 1"), "shared")
    chosen = shared.groupBy("weight", "c", "d").agg(F.min_by("shingle", "first").alias("shingle")).select("shingle")
    postings, postings_path = storage.stage(shared.drop("first", "c", "d").join(chosen, "shingle"), "postings")
    storage.delete(spark, shared_path)
    member = classes.select("group", "class", "id")

    few = postings.where(F.col("weight") <= FEW)
    x, y = few.alias("x"), few.alias("y")
    # The first shingle two sets have in common, in order of rarity, leaves room for at most as many
    # common ones as follow it in either; links need least so many.
    needed = percent * (F.col("x.n") + F.col("y.n"))
    room = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    pairs = (x.join(y, F.col("x.shingle") == F.col("y.shingle"))
             .where((F.struct("x.n", "x.group") <= F.struct("y.n", "y.group"))
                    & (100 * F.col("x.n") >= percent * F.col("y.n")) & ((100 + percent) * room >= needed)
                    & ((F.col("x.group") != F.col("y.group")) | (F.col("x.members") > 1)))
             .select(F.col("x.group").alias("g"), F.col("y.group").alias("h")).distinct())
    pairs, pairs_path = storage.stage(pairs.join(member.select(F.col("group").alias("g"), F.col("class").alias("a"), F.col("id").alias("i")), "g")
                   .join(member.select(F.col("group").alias("h"), F.col("class").alias("b"), F.col("id").alias("j")), "h")
                   .where((F.col("g") != F.col("h")) | (F.col("a") < F.col("b"))).select("a", "i", "b", "j"), "pairs")
    many, many_path = storage.stage(
        postings.where(F.col("weight") > FEW).select("shingle", "group", "weight").join(member, "group"), "many")
    storage.delete(spark, postings_path)
    wanted = (pairs.select(F.col("a").alias("class"), F.col("i").alias("id"))
              .unionAll(pairs.select("b", "j")).unionAll(many.select("class", "id")).distinct())
    # Read three times below from one shuffle.
    texts = _texts(docs, text, doc_id, n, wanted)
    named = lambda c: texts.select(F.col("class").alias(c), F.col("packed").alias(f"packed_{c}"))
    linked = (pairs.select("a", "b").join(named("a"), "a").join(named("b"), "b")
              .select("a", "b", "packed_a", "packed_b").mapInArrow(_alike(n, percent), "a binary, b binary"))

    # Blocks of a shingle's classes hold equal numbers by hash; a unit is a pair of blocks.
    many = (many.withColumn("blocks", F.ceil(F.col("weight") / BLOCK).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int")))
    units = many.select("shingle", "class", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("low"), F.greatest("block", k).alias("high")))).alias("unit"))
    rows = units.join(texts, "class").select("shingle", "unit.low", "unit.high", "class", "packed")
    forest = rows.groupBy("shingle", "low", "high").applyInArrow(_forest(n, percent), "a binary, b binary")
    return linked.unionAll(forest), [pairs_path, many_path]


def link(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: component_id is the least id that links reach,
    where two documents link if 100 * common shingles >= percent * all their shingles.

    Words are compared with A-Z in lower case. Texts without words (null too) have no shingles and
    link with nothing; shorter texts than n words are one shingle. Repeated rows are rows of their
    own; a null id never names a component unless all its ids are null. An empty table gives no
    rows; other columns are left out."""
    spark = docs.sparkSession
    features, features_path = storage.stage(_features(docs, text, doc_id, n, percent), "shingles")
    rows = staged(features.select("doc_id", "n_shingles", "class"), "rows")
    classes, classes_path = storage.stage(features.where("n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("group").alias("group"),
        F.first("prefix").alias("prefix")), "classes")
    # Tables with shingles go as soon as what follows from them is written.
    storage.delete(spark, features_path)
    links, paths = _links(docs, text, doc_id, n, percent, classes)
    roots = connected(links, "a", "b")
    ids = staged(classes.select("class", "id"), "ids")
    for path in (classes_path, *paths):
        storage.delete(spark, path)
    rooted = (ids.join(roots, F.col("class") == F.col("node"), "left")
              .select("class", "id", F.coalesce("root", "class").alias("root")))
    named = (rooted.join(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "root")
             .select("class", "component_id"))
    return (rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("class")).alias("class"))
            .join(named, "class", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
