"""Removal of long repeated strings by a sparse suffix sort, spread over tasks by anchors.

A byte goes if it lies in a string of LENGTH bytes that also starts somewhere else. In every such string
one k-gram, the one of least hash, is its anchor: equal strings have equal anchors at the same place.
Strings whose anchor hash is unique occur once. Of the others those around one anchor make a fragment,
equal fragments are taken once, and the fragments of an anchor meet in a task. There the suffixes that
start at the anchors are sorted, and the reversed prefixes that end there; with the lengths that
neighbours in either order share, a string of LENGTH bytes that starts d bytes before its anchor has an
equal where another fragment is in its class both by d bytes to the left and by the rest to the right.

Anchors whose fragments are too many for a task are split, twice if need be: strings that start about as
far before their anchor have more bytes around it in common and meet by these. What is still too much is
left to a distributed suffix sort with the difference cover of 1 and 2 modulo 3: the triples at
sampled positions are sorted and named, the string of names is sorted by recursion, and the remaining
suffixes, ordered by their first symbol and the rank behind it, are merged in. Positions are only numbers
that grow by one inside a fragment; fragments end in zeros. Sorting means range partitions, names are row
numbers in them, and only one row per partition reaches the driver.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratings_engine.llm.common import staged
from ratings_engine.llm.text import mix, pieces, raw
from ratings_engine.sources import storage

LENGTH = 400
GRAM = 64
#: Bits of the filter of repeated anchors that travels to the tasks: eight for each, within these bounds
#: (64 MB at most). Beyond the upper bound more strings are candidates and nothing is lost.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29
#: Positions that share a task when neighbours are looked up, and symbols sorted without recursion.
RUN = 1 << 16
SMALL = 1 << 20
#: Bytes of fragments sorted at a time.
CHUNK = 1 << 22
#: Parts into which the strings around a frequent anchor are split, and how often.
PARTS, SPLITS = 8, 2
#: Positions hashed at a time, and fragments a task remembers as written.
SEGMENT, SEEN = 1 << 16, 1 << 18
_PRIME = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(400).integers(1, 2 ** 63, 256, dtype=np.uint64)


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of the string of so many bytes at each position, by doubling: two halves make a whole."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    out, have, done, at = None, _BYTES[data], 1, 0
    count = len(data) - length + 1
    while True:
        if length & done:
            part = have[at:at + count]
            out = mix(part) if out is None else mix(out * np.uint64(_PRIME) + part)
            at += done
        if 2 * done > length:
            return out
        have = mix(have[:-done] * np.uint64(_PRIME) + have[done:])
        done *= 2


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the anchor of the string at each position, hash of the k-gram at each position).

    Of hashes that agree but for as many low bits as a position takes, the first is the least."""
    hashes = window_hashes(data, gram)
    width = length - gram + 1
    if len(hashes) < width:
        return np.zeros(0, np.int64), hashes
    low = np.uint64((1 << len(hashes).bit_length()) - 1)
    least, have = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    count = len(hashes) - width + 1
    return (np.minimum(least[:count], least[width - have:width - have + count]) & low).astype(np.int64), hashes


def _around_anchors(texts: pa.Array, length: int, gram: int):
    """Runs of strings with one anchor, for a string column in segments of bounded size.

    Yields the bytes, and arrays (text number, where the text begins in the bytes, first string, behind the
    last one, anchor, hash of the anchor) in order."""
    step, base = max(SEGMENT, 4 * length), 0
    for piece in pieces(texts):
        data, offsets = raw(piece)
        for first in range(0, max(len(data) - length + 1, 0), step):
            place, hashes = anchors(data[first:first + step + length - 1], length, gram)
            heads = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            at = place[heads]
            owner = np.searchsorted(offsets, first + at, "right") - 1
            begin = np.maximum(first + heads, offsets[owner])
            end = np.minimum(first + np.append(heads[1:], len(place)), offsets[owner + 1] - length + 1)
            inside = begin < end
            owner, at = owner[inside], at[inside]
            yield data, base + owner, offsets[owner], begin[inside], end[inside], first + at, hashes[at].view(np.int64)
        base += len(piece)


def _repeated_anchors(rows: DataFrame, length: int, gram: int) -> np.ndarray:
    """A bit per anchor hash found at two places of a text or in two different ones; two hashes may share a
    bit, which only adds candidates."""

    def found(batches):
        for batch in batches:
            # The begin of a digest stands for a text.
            own = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)[::2]
            for _, text, origin, _, _, at, hashes in _around_anchors(batch.column(1), length, gram):
                order = np.lexsort((hashes, text))
                text, hashes, place = text[order], hashes[order], (at - origin)[order].astype(np.uint64)
                head = np.flatnonzero(np.append(np.ones(min(len(text), 1), bool),
                                                (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])))
                times = np.diff(np.append(head, len(text)))
                # One text may have an anchor in several segments.
                met = mix(own[text[head]] + place[head] * np.uint64(_PRIME)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[head]), pa.array(met), pa.array(times > 1)],
                                                 ["hash", "met", "again"])

    repeated = staged(rows.select("key", "text").mapInArrow(found, "hash bigint, met bigint, again boolean")
                      .groupBy("hash").agg(F.min("met").alias("low"), F.max("met").alias("high"), F.max("again").alias("again"))
                      .where("again or low <> high").select("hash"), "anchors")
    size = min(max(1 << (8 * repeated.count()).bit_length(), LEAST_BITS), MOST_BITS)
    marked = (repeated.select(F.pmod("hash", F.lit(size)).alias("p"))
              .groupBy(F.expr("bitmap_bucket_number(p + 1)").alias("b"))
              .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p + 1))").alias("bits")))
    bits = np.zeros(size // 8, np.uint8)
    for bucket, packed in marked.toLocalIterator():
        bits[(bucket - 1) * len(packed):bucket * len(packed)] = np.frombuffer(packed, np.uint8)
    return bits


_FRAGMENT = "hash bigint, class binary, anchor int, strings int, bytes binary"
_PLACED = f"key binary, start bigint, whole bigint, news int, {_FRAGMENT}"


def _batch(columns: list) -> pa.RecordBatch:
    types = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      [c.split()[0] for c in _PLACED.split(", ")])


def _name(seen: dict[bytes, int], part: bytes, anchor: int) -> tuple[bytes, int]:
    """(class of a fragment, 1 or 2 if it is the first or second of it in the task, else 0)."""
    if len(seen) > SEEN:
        seen.clear()
    name = hashlib.md5(part + struct.pack("<q", anchor), usedforsecurity=False).digest()
    seen[name] = min(seen.get(name, 0) + 1, 3)
    return name, seen[name] % 3


def _fragments(rows: DataFrame, repeated: np.ndarray, length: int, gram: int) -> DataFrame:
    """(key, start, whole, news, hash, class, anchor, strings, bytes): the strings around candidate anchors.

    A fragment is strings + length - 1 bytes, its anchor a place in them. Fragments that follow each other and
    are equal, as in a text that repeats itself, are one row of whole strings. news is 1 for the first row of
    a class in a task, which alone has the bytes, and 2 for the second."""
    shared = rows.sparkSession.sparkContext.broadcast(repeated)

    def cut(batches):
        bits, seen = shared.value, {}
        size = 8 * len(bits)
        for batch in batches:
            keys = batch.column(0)
            for data, text, origin, begin, end, at, hashes in _around_anchors(batch.column(1), length, gram):
                bit = hashes % size
                wanted = np.flatnonzero(bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                if not len(wanted):
                    continue
                columns = [x[wanted].tolist() for x in (text, origin, begin, end, at, hashes)]
                window, out, last = data[begin[wanted[0]]:end[wanted[-1]] + length - 1].tobytes(), [], None
                shift = columns[2][0]
                for owner, zero, b, e, a, h in zip(*columns, strict=True):
                    part = window[b - shift:e - shift + length - 1]
                    name, news = _name(seen, part, a - b)
                    if last == (owner, b, name):
                        out[-1][2] += e - b
                    else:
                        out.append([owner, b - zero, e - b, news, h, name, a - b, e - b, part if news == 1 else None])
                    last = (owner, e, name)
                found = list(zip(*out, strict=True))
                found[0] = keys.take(pa.array(found[0], pa.int64())).to_pylist()
                yield _batch(found)

    return rows.select("key", "text").mapInArrow(cut, _PLACED)


def _parts(fragments: DataFrame, length: int, step: int) -> DataFrame:
    """Fragments (key is their class) split by how far, in steps, strings start before the anchor. The strings
    of a part have more bytes in common than the anchor, whose hash is the new one, so that fewer parts meet."""

    def cut(batches):
        seen = {}
        for batch in batches:
            out = []
            for name, anchor, strings, data in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                for k in range((anchor - strings + 1) // step, anchor // step + 1):
                    begin, end = max(anchor - (k + 1) * step + 1, 0), min(anchor - k * step + 1, strings)
                    part, at = data[begin:end + length - 1], anchor - begin
                    common = struct.pack("<q", k) + data[anchor - k * step:anchor - (k + 1) * step + 1 + length]
                    met = struct.unpack("<q", hashlib.md5(common, usedforsecurity=False).digest()[:8])[0]
                    class_, news = _name(seen, part, at)
                    out.append((name, begin, end - begin, news, met, class_, at, end - begin, part if news == 1 else None))
            if out:
                yield _batch(list(zip(*out, strict=True)))

    return fragments.select("class", "anchor", "strings", "bytes").mapInArrow(cut, _PLACED)


def _in_order(strings: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by group and string, bytes that each shares with the one before it, -1 for another group)."""
    width = max(map(len, strings)) + 8
    filled = b"".join([g + s.ljust(width - 8, b"\0") for g, s in zip(
        np.frombuffer(group.astype(">u8").tobytes(), "V8").tolist(), strings, strict=True)])
    order = np.argsort(np.frombuffer(filled, f"S{width}"), kind="stable")
    rows = np.frombuffer(filled, np.uint8).reshape(-1, width)[order]
    differ = rows[1:] != rows[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), width) - 8
    return order, np.append(-1, np.maximum(shared, -1))


def repeated_strings(group: np.ndarray, anchor: np.ndarray, strings: np.ndarray, fragments: list[bytes],
                     length: int) -> np.ndarray:
    """Whether the string at each place (column) of a fragment (row) is in another fragment of its group."""
    count = len(fragments)
    group = np.unique(group, return_inverse=True)[1]
    right = _in_order([f[a:] for f, a in zip(fragments, anchor.tolist(), strict=True)], group)
    left = _in_order([f[:a][::-1] for f, a in zip(fragments, anchor.tolist(), strict=True)], group)
    found = np.zeros((count, int(strings.max())), bool)

    def classes(ordered: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
        out = np.empty(count, np.int64)
        out[ordered[0]] = np.cumsum(ordered[1] < depth)
        return out

    for before in range(int((anchor - strings).min()) + 1, int(anchor.max()) + 1):
        there = np.flatnonzero((before <= anchor) & (before > anchor - strings))
        if len(there) < 2:
            continue
        both = classes(right, length - before)[there] * (count + 1) + classes(left, before)[there]
        order = np.argsort(both)
        equal = both[order][1:] == both[order][:-1]
        hit = there[order[np.append(equal, False) | np.append(False, equal)]]
        found[hit, anchor[hit] - before] = True
    return found


def _sorted_groups(fragments: DataFrame, length: int) -> DataFrame:
    """(class, found) of fragments whose equal hashes share a partition: found are the ranges of strings that
    another fragment has."""

    def complete(table):
        hashes = table.column("hash").to_numpy()
        same = hashes[1:] == hashes[:-1]
        # An anchor with one fragment has none to meet.
        table = table.take(pa.array(np.flatnonzero(np.append(False, same) | np.append(same, False))))
        hashes = table.column("hash").to_numpy()
        ends = np.append(np.flatnonzero(hashes[1:] != hashes[:-1]) + 1, len(hashes))
        size = np.cumsum(pc.binary_length(table.column("bytes")).to_numpy().astype(np.int64))
        first = 0
        while first < len(hashes):
            done = size[first - 1] if first else 0
            last = ends[max(np.searchsorted(size[ends - 1], done + CHUNK, "right") - 1, np.searchsorted(ends, first, "right"))]
            part = table.slice(first, last - first)
            first = last
            hit = repeated_strings(*(part.column(c).to_numpy().astype(np.int64) for c in ("hash", "anchor", "strings")),
                                   part.column("bytes").to_pylist(), length)
            edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, begin = np.nonzero(edge == 1)
            end = np.nonzero(edge == -1)[1]
            some = np.unique(row)
            cuts = np.append(np.searchsorted(row, some), len(row)).astype(np.int32)
            ranges = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(
                [pa.array(begin.astype(np.int64)), pa.array(end.astype(np.int64))], ["begin", "end"]))
            yield pa.RecordBatch.from_arrays(
                [part.column("class").take(pa.array(some)).combine_chunks(), ranges], ["class", "found"])

    def ranked(batches):
        held = None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            # The last hash may go on in the next batch.
            hashes = table.column("hash").to_numpy()
            last = int(np.searchsorted(hashes, hashes[-1]))
            held = table.slice(last)
            yield from complete(table.slice(0, last))
        if held is not None:
            yield from complete(held)

    return (fragments.select("hash", "class", "anchor", "strings", "bytes").sortWithinPartitions("hash")
            .mapInArrow(ranked, "class binary, found array<struct<begin:bigint,end:bigint>>"))


def _symbols(runs: DataFrame, length: int) -> DataFrame:
    """(pos, sym, hash): one row per byte and three or more zeros behind each run. hash is that of the
    string that starts there, null near the end of a run."""

    def spread(batches):
        for batch in batches:
            for base, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(data, np.uint8)
                size = len(data) // 3 * 3 + 6
                symbols = np.zeros(size, np.int64)
                symbols[:len(data)] = data.astype(np.int64) + 1
                hashes = np.zeros(size, np.int64)
                count = len(data) - length + 1
                hashes[:count] = window_hashes(data, length).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + np.arange(size)), pa.array(symbols), pa.array(hashes, mask=np.arange(size) >= count)],
                    ["pos", "sym", "hash"])

    return runs.select("base", "bytes").mapInArrow(spread, "pos bigint, sym bigint, hash bigint")


def _div(value: Column, by: int) -> Column:
    """Whole-number division; positions exceed what a double holds."""
    return F.call_function("div", value, F.lit(by))


def _behind(rows: DataFrame, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Add values of the rows one or two positions further (0 where there is none): new name -> (column, steps).

    Runs of positions share a task; their first two rows are sent to the run before as well."""
    run = _div(F.col("pos"), RUN)
    near = Window.partitionBy("run").orderBy("pos")
    at = lambda c, k: F.coalesce(F.when(F.lead("pos", k).over(near) == F.col("pos") + k, F.lead(c, k).over(near)),
                                 F.when(F.lead("pos", 1).over(near) == F.col("pos") + k, F.lead(c, 1).over(near)), F.lit(0))
    both = rows.withColumn("run", F.explode(F.when(F.col("pos") % RUN < 2, F.array(run, run - 1)).otherwise(F.array(run))))
    return (both.withColumns({name: at(c, k) for name, (c, k) in columns.items()})
            .where(F.col("run") == run).drop("run"))


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows in the given order, with part (number of the range) and number, which grows with the order."""
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("part", F.spark_partition_id()).withColumn("number", F.monotonically_increasing_id()))


def _last_before(rows: DataFrame, value: str, order: list[Column]) -> Column:
    """The largest value up to each row of a numbered table, across its parts."""
    largest = sorted((r[0], r[1]) for r in rows.groupBy("part").agg(F.max(value)).collect())
    carried, pairs = -1, []
    for part, most in largest:
        pairs.append((part, carried))
        carried = max(carried, -1 if most is None else most)
    spark = rows.sparkSession
    starts = F.broadcast(spark.createDataFrame(pairs or [(0, -1)], "part int, carried bigint"))
    inside = F.max(value).over(Window.partitionBy("part").orderBy(*order))
    return rows.join(starts, "part").withColumn("last", F.greatest(F.col("carried"), F.coalesce(inside, F.lit(-1))))


def _sort_small(rows: DataFrame, depth: int) -> DataFrame:
    """(pos, rank) of at most SMALL symbols by their first depth symbols, by doubling in one task."""

    def ranked(batches):
        table = pa.Table.from_batches(batches, schema=pa.schema([("pos", pa.int64()), ("sym", pa.int64())]))
        pos, sym = (table.column(c).to_numpy() for c in ("pos", "sym"))
        order = np.argsort(pos)
        pos, rank = pos[order], np.unique(sym[order], return_inverse=True)[1] + 1
        step = 1
        while len(pos) and rank.max() < len(pos) and step <= 4 * depth:
            there = np.searchsorted(pos, pos + step)
            there = np.where((there < len(pos)) & (pos[np.minimum(there, len(pos) - 1)] == pos + step), there, -1)
            pairs = rank * (len(pos) + 2) + np.where(there >= 0, rank[there], 0)
            rank, step = np.unique(pairs, return_inverse=True)[1] + 1, 2 * step
        yield pa.RecordBatch.from_arrays([pa.array(pos), pa.array(rank.astype(np.int64))], ["pos", "rank"])

    return rows.repartition(1).mapInArrow(ranked, "pos bigint, rank bigint")


def suffix_ranks(symbols: DataFrame, depth: int = LENGTH, covered: int = 1, small: int = SMALL) -> DataFrame:
    """(pos, rank) of a string (pos, sym): rank orders the suffixes, at least by their first depth bytes.

    covered is how many bytes a symbol stands for; with depth or more of them the symbols are ranks."""
    if covered >= depth:
        return symbols.select("pos", F.col("sym").alias("rank"))
    size = symbols.count()
    if size <= small:
        return _sort_small(symbols.select("pos", "sym"), depth)
    near = _behind(symbols.select("pos", "sym"), {"s1": ("sym", 1), "s2": ("sym", 2)})
    triples = _numbered(near.where(F.col("pos") % 3 != 0), "sym", "s1", "s2")
    of_triple = Window.partitionBy("sym", "s1", "s2")
    # Equal triples lie in one range, so the window needs no further shuffle.
    sampled = staged(triples.withColumn("name", F.min("number").over(of_triple))
                     .withColumn("times", F.count("*").over(of_triple)).select("pos", "name", "times"), "names")
    far = F.lit(1 << 60)
    if sampled.where("times > 1").isEmpty():
        ranks = sampled.select("pos", F.col("name").alias("rank"))
    else:
        shorter = sampled.select((_div(F.col("pos"), 3) + F.when(F.col("pos") % 3 == 2, far).otherwise(0)).alias("pos"),
                                 F.col("name").alias("sym"))
        ranks = staged(suffix_ranks(shorter, depth, 3 * covered, small).select(
            F.when(F.col("pos") < far, 3 * F.col("pos") + 1).otherwise(3 * (F.col("pos") - far) + 2).alias("pos"),
            "rank"), "ranks")
    known = staged(_behind(symbols.select("pos", "sym").join(ranks, "pos", "left"),
                           {"s1": ("sym", 1), "r1": ("rank", 1), "r2": ("rank", 2)}), "known")
    rest = F.col("pos") % 3 == 0

    def place(residue: int, *key: str) -> DataFrame:
        """Rank of the last sampled suffix of a residue that is not behind each remaining suffix."""
        rows = known.where(rest | (F.col("pos") % 3 == residue)).withColumn("flag", F.when(rest, 1).otherwise(0))
        rows = staged(_numbered(rows.select("pos", "flag", *key, "rank"), *key, "flag"), "merge")
        return _last_before(rows, "rank", [F.col("number")]).where("flag = 1").select("pos", "last")

    first = place(1, "sym", "r1").withColumnRenamed("last", "last1")
    second = place(2, "sym", "s1", "r2").withColumnRenamed("last", "last2")
    remaining = (known.where(rest).join(first, "pos").join(second, "pos")
                 .select("pos", F.greatest("last1", "last2").alias("major"), F.lit(1).alias("flag"), "sym", "r1"))
    merged = remaining.unionAll(known.where(~rest).select(
        "pos", F.col("rank").alias("major"), F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint")))
    return _numbered(merged, "major", "flag", "sym", "r1").select("pos", F.col("number").alias("rank"))


def repeated_starts(symbols: DataFrame, ranks: DataFrame) -> DataFrame:
    """(pos) of the strings that equal a neighbour in suffix order."""
    starts = symbols.where(F.col("hash").isNotNull()).select("pos", "hash").join(ranks, "pos")
    rows = staged(_numbered(starts.select("pos", "hash", "rank"), "rank", "pos"), "order")
    near = Window.partitionBy("part").orderBy("number")
    edges = {r.part: r for r in rows.groupBy("part").agg(
        F.min_by("hash", "number").alias("first"), F.max_by("hash", "number").alias("last")).collect()}
    parts = sorted(edges)
    ends = [(p, edges[parts[k - 1]].last if k else None, edges[parts[k + 1]].first if k + 1 < len(parts) else None)
            for k, p in enumerate(parts)] or [(0, None, None)]
    outer = F.broadcast(rows.sparkSession.createDataFrame(ends, "part int, before bigint, behind bigint"))
    equal = lambda x: F.coalesce(x == F.col("hash"), F.lit(False))
    return (rows.join(outer, "part")
            .where(F.lit(True)).withColumn("left", F.coalesce(F.lag("hash").over(near), F.col("before")))
            .withColumn("right", F.coalesce(F.lead("hash").over(near), F.col("behind")))
            .where(equal(F.col("left")) | equal(F.col("right"))).select("pos"))


def _ranked_strings(fragments: DataFrame, length: int, small: int) -> DataFrame:
    """(class, begin, end) of the strings of (class, bytes) found twice, by ranks of all suffixes."""

    def placed(batches):
        task, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy().astype(np.int64) // 3 * 3 + 6
            places = place + np.cumsum(sizes) - sizes
            place += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), task)), pa.array(places), *batch.columns],
                                             ["task", "place", "class", "bytes"])

    runs = staged(fragments.select("class", "bytes").mapInArrow(
        placed, "task bigint, place bigint, class binary, bytes binary"), "runs")
    ends = runs.groupBy("task").agg(F.max(F.col("place") + F.length("bytes") + 6).alias("size")).collect()
    base, bases = 3, []
    for task, size in sorted((r.task, r.size) for r in ends):
        bases.append((task, base))
        base += -(-size // 3) * 3 + 3
    offsets = F.broadcast(fragments.sparkSession.createDataFrame(bases or [(0, 0)], "task bigint, offset bigint"))
    runs = runs.join(offsets, "task").withColumn("base", F.col("place") + F.col("offset"))
    symbols = staged(_symbols(runs, length), "symbols")
    starts = repeated_starts(symbols, suffix_ranks(symbols, length, small=small))
    step = 1 << 12
    spans = starts.groupBy(_div(F.col("pos"), step).alias("cell")).agg(F.collect_list("pos").alias("at"))
    cells = F.sequence(_div(F.col("base"), step), _div(F.col("base") + F.length("bytes"), step))
    return (runs.select("class", "base", F.length("bytes").alias("size"), F.explode(cells).alias("cell")).join(spans, "cell")
            .select("class", F.explode(F.filter("at", lambda p: (p >= F.col("base")) & (p < F.col("base") + F.col("size"))))
                    .alias("pos"), "base")
            .select("class", (F.col("pos") - F.col("base")).alias("begin"), (F.col("pos") - F.col("base") + 1).alias("end")))


def _found(fragments: DataFrame, length: int, width: int, small: int, paths: list[str], splits: int = SPLITS) -> DataFrame:
    """(key, begin, end): ranges of repeated strings of the keys that fragments were cut from.

    width is how many places before an anchor the strings around it may start at. paths gets the folders
    to remove once the ranges are made."""
    fragments, path = storage.stage(fragments, "fragments")
    paths.append(path)
    # Whatever has an equal fragment is repeated as a whole.
    found = (fragments.where("news > 0").groupBy("class").agg(F.count("*").alias("n"), F.first("strings").alias("end"))
             .where("n > 1").select("class", F.lit(0).cast("bigint").alias("begin"), F.col("end").cast("bigint")))
    first = fragments.where("news = 1")
    # At most one hash for small bytes of fragments.
    frequent = staged(first.groupBy("hash").agg(F.sum(F.col("strings") + (length - 1)).alias("size"))
                      .where(F.col("size") > small).select("hash"), "frequent")
    ranked = _sorted_groups(first.join(F.broadcast(frequent), "hash", "left_anti").repartition("hash")
                            .dropDuplicates(["hash", "class"]), length)
    found = found.unionAll(ranked.select("class", F.inline("found")))
    if not frequent.isEmpty():
        large = first.join(F.broadcast(frequent), "hash", "left_semi").dropDuplicates(["class"])
        step = -(-width // PARTS)
        found = found.unionAll(
            _found(_parts(large, length, step), length, step, small, paths, splits - 1).withColumnRenamed("key", "class")
            if splits else _ranked_strings(large, length, small))
    follows = fragments.where("whole > strings").select("key", F.col("start").alias("begin"), F.expr("start + whole").alias("end"))
    return fragments.select("key", "start", "class").join(found, "class").select(
        "key", F.expr("start + begin").alias("begin"), F.expr("start + end").alias("end")).unionAll(follows)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH,
                   gram: int = GRAM, small: int = SMALL) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256) of every row.

    Null texts are empty; texts under length bytes lose nothing; copies of a text of length bytes or
    more lose everything; overlapping occurrences count, also inside one text. spans are the removed
    (start, end) in bytes. Repeated rows are copies. An empty table gives no rows. Anchors with more
    than small bytes of fragments are split. Texts and fragments are the same if 128 bits of their
    digests are; one anchor at places (text and offset) that agree in 64 bits counts as one."""
    own = F.coalesce(F.col(text), F.lit(""))
    key = F.unhex(F.substring(F.sha2(own.cast("binary"), 256), 1, 32))
    fits = F.octet_length(own) >= length
    rows = docs.where(fits).select(key.alias("key"), own.alias("text"))
    paths: list[str] = []
    found = _found(_fragments(rows, _repeated_anchors(rows, length, gram), length, gram), length, length - gram + 1, small, paths)
    copies = (rows.select("key", F.octet_length("text").alias("n_bytes")).groupBy("key")
              .agg(F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes")).where("copies > 1")
              .select("key", F.lit(0).cast("bigint").alias("begin"), (F.col("n_bytes") - length + 1).cast("bigint").alias("end")))
    ranges = staged(found.unionAll(copies).groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("ranges")), "ranges")
    for path in paths:
        storage.delete(docs.sparkSession, path)

    def removed(batches):
        for batch in batches:
            out = []
            for name, text_, ranges_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, spans_ = text_.encode(), []
                for begin, end in sorted((r["begin"], r["end"] - 1 + length) for r in ranges_ or []):
                    if spans_ and begin <= spans_[-1][1]:
                        spans_[-1][1] = max(end, spans_[-1][1])
                    else:
                        spans_.append([begin, end])
                kept, last = hashlib.sha256(), 0
                for begin, end in spans_:
                    kept.update(data[last:begin])
                    last = end
                kept.update(data[last:])
                out.append((name, len(data), sum(e - b for b, e in spans_), len(spans_),
                            [{"start": b, "end": e} for b, e in spans_], kept.hexdigest()))
            kinds = (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(),
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds, strict=True)],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])

    kind = docs.schema[doc_id].dataType.simpleString()
    met = docs.where(fits).select(key.alias("key"), F.col(doc_id).alias("doc_id"), own.alias("text")).join(ranges, "key", "left")
    short = docs.where(~fits).select(F.col(doc_id).alias("doc_id"), own.alias("text"),
                                     F.lit(None).cast(ranges.schema["ranges"].dataType).alias("ranges"))
    return met.select("doc_id", "text", "ranges").unionAll(short).mapInArrow(
        removed, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                 "spans array<struct<start:bigint,end:bigint>>, kept_sha256 string")
