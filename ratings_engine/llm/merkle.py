"""A Merkle manifest of a table: leaf digests, trees per language under one root, proofs and their check.

Nodes are labelled with nested intervals: a node carries the leaf ranks [low, high) that it covers, so a
node is an ancestor of a leaf if its interval contains the leaf's rank. On level k an interval starts at a
multiple of fanout^k; low // fanout^k is its bucket, which turns the containment join into an equi-join
on tree, level and bucket. What a parent's interval has beyond its child's are the child's siblings.

Levels come in bands. A band's lowest nodes meet the inner nodes of their band and the finished proof of the
node above it in one row by bucket, so a leaf is moved once and not once for each level. Ranks are taken by ranges of the order, never in one task for a tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratings_engine.llm.common import let, staged

#: Levels of a band: groups of fanout^BAND nodes are hashed together.
BAND = 6


def field(value: Column) -> Column:
    """A value as the manifest hashes it: '-' for null, else its length in bytes, ':' and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return _digest(F.concat(*[field(v) for v in values]))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _packed(digest: Column) -> Column:
    """32 bytes for 64 hexadecimal digits, as digests are stored and shuffled."""
    return F.unhex(digest)


def _spelled(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def ranked(rows: DataFrame, tree: str, order: list[Column]) -> DataFrame:
    """rows with rank (from 0, within the tree, ties in any order) and leaves, the tree's number of rows.

    Rows are sorted by ranges of tree and order and written; a range's place follows from the counts of
    the ranges before it in its tree, of which there are no more than tasks."""
    keys = [F.col(tree).asc_nulls_first(), *order]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    # The row number within its task, and the task's number above it.
    stored = staged(sorted_rows.withColumn("place", place), "ranked")
    part = F.shiftright("place", 33).alias("part")
    counts = stored.groupBy(tree, part).agg(F.count("*").alias("n"), F.min("place").alias("least"))
    earlier = Window.partitionBy(tree).orderBy("part")
    offsets = counts.select(
        F.col(tree).alias("of"), "part", "least", F.sum("n").over(earlier).alias("upto"), "n",
        F.sum("n").over(Window.partitionBy(tree)).alias("leaves"))
    met = stored.withColumn("part", F.shiftright("place", 33)).join(
        offsets.withColumnRenamed("part", "p"), F.col(tree).eqNullSafe(F.col("of")) & (F.col("part") == F.col("p")))
    return met.select(*rows.columns, (F.col("place") - F.col("least") + F.col("upto") - F.col("n")).alias("rank"), "leaves")


def _runs_above(members: DataFrame, base: int, fanout: int, band: int) -> DataFrame:
    """All nodes above members (tree, low, high, leaves, digest: the nodes of level `base`) in their band.

    One row per parent: tree, level of its children, bucket, own interval and digest, its children."""
    width = fanout ** base
    bucket = F.floor(F.col("low") / (width * fanout ** band))
    node = "struct<low:bigint,high:bigint,digest:binary>"
    run = f"struct<level:int,low:bigint,high:bigint,digest:binary,children:array<{node}>>"

    def parents(nodes: Column, level: Column) -> Column:
        """The runs of `fanout` consecutive nodes, each with the interval and digest of their parent."""
        def one(k):
            children = F.slice(nodes, k * fanout + 1, fanout)
            return F.struct(level.cast("int").alias("level"), children[0]["low"].alias("low"),
                            F.element_at(children, -1)["high"].alias("high"),
                            _packed(_digest(F.array_join(F.transform(children, lambda c: _spelled(c["digest"])), ""))).alias("digest"),
                            children.alias("children")).cast(run)
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int")), one)

    def climb(state, step):
        """One level up, unless the whole tree has one node left."""
        level = F.lit(base) + step
        more = F.col("leaves") > F.pow(F.lit(fanout), level).cast("bigint")

        def up(made):
            return F.struct(F.transform(made, lambda r: F.struct(r["low"], r["high"], r["digest"]).cast(node)).alias("nodes"),
                            F.concat(state["runs"], made).alias("runs"))
        return F.when(more, let(parents(state["nodes"], level), up)).otherwise(state)

    nodes = F.array_sort(F.collect_list(F.struct("low", "high", "digest").cast(node)))
    groups = members.groupBy("tree", bucket.alias("bucket")).agg(F.first("leaves").alias("leaves"), nodes.alias("nodes"))
    start = F.struct(F.col("nodes").alias("nodes"), F.array().cast(f"array<{run}>").alias("runs"))
    climbed = F.aggregate(F.sequence(F.lit(0), F.lit(band - 1)), start, climb)["runs"]
    found = groups.select("tree", "leaves", F.explode(climbed).alias("run")).select("tree", "leaves", "run.*")
    return staged(found, "nodes")


def _spans(leaves: DataFrame) -> DataFrame:
    """Leaves cover an interval of one rank."""
    return leaves.withColumn("low", F.col("rank")).withColumn("high", F.col("rank") + 1).drop("rank", "leaves")


def _top(runs: DataFrame, level: int) -> DataFrame:
    """The nodes of a level, taken from their children's level."""
    return runs.where(F.col("level") == level - 1).select("tree", "low", "high", "leaves", "digest")


def trees(leaves: DataFrame, fanout: int = 2, band: int = BAND) -> tuple[list, DataFrame]:
    """Bands of inner nodes from below, and (tree, digest) of the roots.

    leaves: tree, rank, leaves (of the tree), digest (binary). Each band is (level it starts on, runs)."""
    members = leaves.select("tree", F.col("rank").alias("low"), (F.col("rank") + 1).alias("high"),
                            "leaves", "digest")
    roots = members.where("leaves = 1").select("tree", "digest")
    bands, base = [], 0
    while not members.where("leaves > 1").isEmpty():
        runs = _runs_above(members.where("leaves > 1"), base, fanout, band)
        bands.append((base, runs))
        roots = roots.unionByName(runs.where("low = 0 and high = leaves").select("tree", "digest"))
        # Trees with nodes left beside that of the band's highest level go on.
        members = _top(runs, base + band).where(F.col("leaves") > F.lit(fanout ** (base + band)))
        base += band
    return bands, roots


#: What a proof says of a level: digests of the siblings before and after the node, one behind the other.
_STEP = "struct<level:int,before:binary,after:binary>"
_NO_STEPS = f"array<{_STEP}>"


def _joined(nodes: Column) -> Column:
    return F.aggregate(nodes, F.lit(b""), lambda all_, c: F.concat(all_, c["digest"]))


def _attach(members: DataFrame, runs: DataFrame, above: DataFrame | None, base: int, fanout: int, band: int) -> DataFrame:
    """members (tree, low, high and others) with steps.

    A member meets the nodes of its band in one row, by tree and the bucket of the band's highest level. Those
    whose interval contains the member's are its ancestors; their children beside it are the siblings. The
    steps above the band come with the same row."""
    reach = fanout ** (base + band)
    bucket = F.floor(F.col("low") / reach)
    run = F.struct("level", "low", "high", "children")
    covering = runs.groupBy(F.col("tree").alias("of"), bucket.alias("b")).agg(F.collect_list(run).alias("runs"))
    if above is not None:
        further = above.select(F.col("tree").alias("t"), bucket.alias("k"), F.col("steps").alias("further"))
        covering = covering.join(further, F.col("of").eqNullSafe(F.col("t")) & (F.col("b") == F.col("k")), "left").drop("t", "k")
    else:
        covering = covering.withColumn("further", F.lit(None).cast(_NO_STEPS))
    ancestors = F.array_sort(F.filter("runs", lambda r: (r["low"] <= F.col("low")) & (F.col("high") <= r["high"])))
    steps = F.transform(ancestors, lambda r: F.struct(
        r["level"].alias("level"),
        _joined(F.filter(r["children"], lambda c: c["high"] <= F.col("low"))).alias("before"),
        _joined(F.filter(r["children"], lambda c: c["low"] >= F.col("high"))).alias("after")).cast(_STEP))
    none = F.array().cast(_NO_STEPS)
    met = members.join(covering, F.col("tree").eqNullSafe(F.col("of")) & (bucket == F.col("b")), "left")
    return met.select(*members.columns, F.concat(F.coalesce(steps, none), F.coalesce("further", none)).alias("steps"))


def proofs(leaves: DataFrame, bands: list, fanout: int = 2, band: int = BAND) -> DataFrame:
    """leaves (tree, low, high and others) with steps: their siblings on all levels, from below.

    The steps of the nodes at the foot of the highest band come first and are handed down."""
    above = None
    for base, runs in reversed(bands[1:]):
        nodes = runs.where(F.col("level") == base).select("tree", F.explode("children").alias("c")).select(
            "tree", F.col("c.low").alias("low"), F.col("c.high").alias("high"))
        above = _attach(nodes, runs, above, base, fanout, band)
    if not bands:
        return leaves.withColumn("steps", F.array().cast(_NO_STEPS))
    return _attach(leaves, bands[0][1], above, 0, fanout, band)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf (hexadecimal) and its siblings give."""
    return F.aggregate(steps, leaf, lambda digest, s: _digest(F.concat(_spelled(s["before"]), digest, _spelled(s["after"]))))


def proof_digest(steps: Column) -> Column:
    return _digest(F.array_join(F.transform(steps, lambda s: F.concat(_spelled(s["before"]), _spelled(s["after"]))), ""))


def manifest(docs: DataFrame, columns: list[str], tree: str = "lang", order: str = "doc_id", fanout: int = 2,
             band: int = BAND, keep: dict[str, Column] | None = None) -> DataFrame:
    """(order column, tree column, leaf, subroot, root, steps) per row: its digest and its siblings' up to the root.

    Leaves are digests of `columns`; those of a value of `tree` (null is a value, the first) ascend by
    `order`, null first, ties by leaf; every `fanout` consecutive nodes, of which the last run may have
    fewer, get a parent until one is left. The subroots, in the order of their values as UTF-8, get a tree
    of their own. A row alone has no siblings and is the root. Repeated rows are leaves of their own.
    An empty table gives no rows. steps has for each level the digests of the siblings before and after, joined, as bytes.
    keep names expressions over docs that come along; other columns of docs are not read, whatever their names."""
    keep = keep or {}
    leaf = _packed(leaf_digest(*[F.col(f"`{c}`") for c in columns]))
    rows = docs.select(F.col(f"`{tree}`").alias("tree"), F.col(f"`{order}`").alias("id"), leaf.alias("digest"),
                       F.struct(F.lit(0), *[value.alias(name) for name, value in keep.items()]).alias("kept"))
    leaves = ranked(rows, "tree", [F.col("id").asc_nulls_first(), F.col("digest").asc()])
    bands, roots = trees(leaves, fanout=fanout, band=band)
    roots = staged(roots, "roots")
    # The subroots are leaves of one more tree.
    upper = ranked(roots.select(F.lit(0).alias("tree"), F.col("tree").alias("value"), "digest"), "tree",
                   [F.col("value").asc_nulls_first()])
    upper_bands, root = trees(upper, fanout=fanout, band=band)
    root = root.first()
    top = proofs(_spans(upper), upper_bands, fanout, band).select(
        F.col("value").alias("of tree"), F.col("digest").alias("subroot"), F.col("steps").alias("further"))
    out = proofs(_spans(leaves), bands, fanout, band).join(top, F.col("tree").eqNullSafe(F.col("of tree")))
    return out.select(F.col("id").alias(order), F.col("tree").alias(tree), _spelled(F.col("digest")).alias("leaf"),
                      _spelled(F.col("subroot")).alias("subroot"), F.lit(root and root.digest.hex()).cast("string").alias("root"),
                      F.concat("steps", "further").alias("steps"), *[F.col(f"kept.`{name}`") for name in keep])
