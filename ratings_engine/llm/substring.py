"""Removal of word windows that an earlier document has: a count-min prefilter, then exact groups.

A window is `length` consecutive words of one document. Its fingerprint in the sketch is its anchor, the
least hash among its `gram`-word shingles: equal windows have equal anchors, so the number of documents
with an anchor is never below the number with the window, and consecutive windows mostly share theirs.

First pass: each task fills a count-min sketch (ROWS rows of counters that stop at two, kept as two bit
planes); sketches are merged slice by slice in tasks. Collisions only raise an estimate.
Second pass: runs of windows with one anchor that is estimated to be in two documents are written out,
one row per run. Runs of equal words are one class, grouped before anything meets; only anchors with
several classes are looked at window by window. Every window in question is compared exactly, on 128
bits of hashes, so that a false estimate costs time and nothing is lost.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from ratings_engine.llm import text as words_of
from ratings_engine.sources import storage

#: Words of a shingle that may be an anchor.
GRAM = 8
#: Rows of the sketch, and bits of a plane that are merged as one.
ROWS, SLICE = 2, 1 << 20
#: Counters of a row: about four for each anchor expected, within these bounds (a task holds four planes,
#: 128 MB at most). Beyond the upper bound estimates get looser and more windows are grouped exactly.
LEAST_COUNTERS, MOST_COUNTERS = 1 << 20, 1 << 28
#: Bytes of stored input that give one anchor, roughly: a word is four, an anchor comes every 20 words.
ANCHOR_BYTES = 80
#: Words taken at a time, whatever the length of a text.
SEGMENT = 1 << 20

_PRIME = np.uint64(0xD6E8FEB86659FD93)
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _runs(texts: pa.Array, length: int, gram: int):
    """Runs of windows with one anchor, for a string column in segments of bounded size.

    Yields arrays (text number, first word, anchor, hash of the run's words, windows of the run) and the
    hashes of all these windows in order. A run has at most as many windows as a window has shingles."""
    gram = min(gram, length)
    span = length - gram + 1
    base = 0
    for piece in words_of.pieces(texts):
        data, offsets = words_of.raw(piece)
        begins, ends, owner = words_of.word_bounds(data, offsets)
        hashes = words_of.word_hashes(data, begins, ends, lower=False)
        opening = np.searchsorted(owner, np.arange(len(piece)))
        for first in range(0, max(len(hashes) - length + 1, 0), SEGMENT):
            part = hashes[first:first + SEGMENT + length - 1]
            n = len(part) - length + 1
            text = owner[first:first + n]
            inside = text == owner[first + length - 1:first + length - 1 + n]
            shingles = part[:len(part) - gram + 1]
            for k in range(1, gram):
                shingles = words_of.mix(shingles * _PRIME + part[k:k + len(part) - gram + 1])
            width = 1
            while 2 * width <= span:
                shingles = np.minimum(shingles[:-width], shingles[width:])
                width *= 2
            anchors = np.minimum(shingles[:n], shingles[span - width:span - width + n])
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * _powers(len(part), int(_PRIME)), out=sums[1:])
            inverse = _powers(len(part) + 1, pow(int(_PRIME), -1, 2 ** 64))
            windows = words_of.mix((sums[length:] - sums[:-length]) * inverse[:n])
            places = np.flatnonzero(inside)
            if not len(places):
                continue
            new = np.ones(len(places), bool)
            new[1:] = (places[1:] != places[:-1] + 1) | (anchors[places[1:]] != anchors[places[:-1]])
            since = np.arange(len(places)) - np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
            heads = np.flatnonzero(since % span == 0)
            count = np.diff(np.append(heads, len(places)))
            start = places[heads]
            whole = (sums[start + count + length - 1] - sums[start]) * inverse[start]
            yield (text[start] + base, first + start - opening[text[start]], anchors[start],
                   words_of.mix(whole + count.astype(np.uint64)), count, windows[places])
        base += len(piece)


def _counters(anchors: np.ndarray, row: int, counters: int) -> np.ndarray:
    return words_of.mix(anchors ^ _SALTS[row]) & np.uint64(counters - 1)


def _add(once: np.ndarray, twice: np.ndarray, places: np.ndarray) -> None:
    """Count places in two bit planes: seen, and seen again."""
    places, times = np.unique(places, return_counts=True)
    cell, bit = (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63))
    head = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    new, again = (np.bitwise_or.reduceat(x, head) for x in (bit, np.where(times > 1, bit, np.uint64(0))))
    cell = cell[head]
    twice[cell] |= (once[cell] & new) | again
    once[cell] |= new


def _first_windows(owner: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Each anchor once per text."""
    order = np.lexsort((anchors, owner))
    owner, anchors = owner[order], anchors[order]
    new = np.ones(len(anchors), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (anchors[1:] != anchors[:-1])
    return anchors[new]


def repeated_counters(rows: DataFrame, length: int, gram: int, counters: int) -> np.ndarray:
    """For each row of the sketch the bits of counters that two or more texts of the first column reach."""

    def sketch(batches):
        once, twice = (np.zeros((ROWS, counters >> 6), np.uint64) for _ in range(2))
        for batch in batches:
            for owner, _, anchors, *_ in _runs(batch.column(0), length, gram):
                found = _first_windows(owner, anchors)
                for row in range(ROWS):
                    _add(once[row], twice[row], _counters(found, row, counters))
        cells, per = min(SLICE, counters) >> 6, max(counters // SLICE, 1)
        for k in range(ROWS * per):
            place = (k // per, slice(k % per * cells, (k % per + 1) * cells))
            if once[place].any():
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array([k], pa.int32()), "once": [zlib.compress(once[place].tobytes(), 1)],
                    "twice": [zlib.compress(twice[place].tobytes(), 1)]})

    def merge(batches):
        planes = {}
        for batch in batches:
            for k, *packed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                once, twice = (np.frombuffer(zlib.decompress(x), np.uint64) for x in packed)
                before = planes.get(k)
                planes[k] = (once, twice) if before is None else (
                    before[0] | once, before[1] | twice | (before[0] & once))
        for k, (_, twice) in planes.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([k], pa.int32()),
                                              "twice": [zlib.compress(twice.tobytes(), 1)]})

    merged = (rows.mapInArrow(sketch, "slice int, once binary, twice binary").repartition("slice")
              .mapInArrow(merge, "slice int, twice binary"))
    out = np.zeros((ROWS, counters >> 6), np.uint64)
    per, cells = max(counters // SLICE, 1), min(SLICE, counters) >> 6
    # At most ROWS planes, 64 MB.
    for k, packed in merged.collect():
        out[k // per, k % per * cells:(k % per + 1) * cells] = np.frombuffer(zlib.decompress(bytes(packed)), np.uint64)
    return out


def _counters_for(docs: DataFrame, most: int) -> int:
    """Counters of a row by the size Spark expects of the input; it decides nothing but time."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    wanted = 4 * size // ANCHOR_BYTES
    return min(max(1 << max(wanted - 1, 1).bit_length(), LEAST_COUNTERS), most)


def _occurrences(rows: DataFrame, length: int, gram: int, repeated: np.ndarray) -> DataFrame:
    """Runs (key, id, anchor, run, start, windows) whose anchor is estimated to be in two texts."""
    sent = rows.sparkSession.sparkContext.broadcast(repeated)
    counters = repeated.shape[1] << 6

    def runs(batches):
        planes = sent.value
        for batch in batches:
            for owner, start, anchors, run, count, windows in _runs(batch.column(2), length, gram):
                kept = np.ones(len(anchors), bool)
                for row in range(ROWS):
                    place = _counters(anchors, row, counters)
                    kept &= (planes[row][(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
                cuts = np.append(0, np.cumsum(count[kept])).astype(np.int32)
                wanted = pa.array(owner[kept])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(wanted), batch.column(1).take(wanted),
                     pa.array(anchors[kept].view(np.int64)), pa.array(run[kept].view(np.int64)),
                     pa.array(start[kept], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(windows[np.repeat(kept, count)].view(np.int64)))],
                    ["key", "id", "anchor", "run", "start", "windows"])

    long = LongType()
    return rows.mapInArrow(runs, StructType([
        StructField("key", BinaryType()), StructField("id", rows.schema["id"].dataType), StructField("anchor", long),
        StructField("run", long), StructField("start", long), StructField("windows", ArrayType(long))]))


def _earlier(first, own):
    """Whether first is before own; null comes last and is not before null."""
    return first.isNotNull() & (own.isNull() | (own > first))


def _marks(runs: DataFrame) -> DataFrame:
    """(key, marks): start and window bits of the runs that have windows to remove."""
    classes = runs.groupBy("anchor", "run").agg(F.min("id").alias("first"))
    mixed = classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1").select("anchor")
    doubtful = classes.join(mixed, "anchor")
    # The runs of the first documents stand for their class; its windows may be in earlier classes.
    windows = (runs.join(doubtful, ["anchor", "run"]).where(F.col("id").eqNullSafe(F.col("first")))
               .select("anchor", "run", "first", F.posexplode("windows").alias("place", "window")))
    lowest = windows.groupBy("anchor", "window").agg(F.min("first").alias("lowest"))
    bits = (windows.join(lowest, ["anchor", "window"]).where(_earlier(F.col("lowest"), F.col("first")))
            .groupBy("anchor", "run").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits")))
    whole = F.expr("shiftleft(1L, size(windows)) - 1")
    taken = F.when(_earlier(F.col("first"), F.col("id")), F.col("whole")).otherwise(F.col("bits"))
    return (runs.select("key", "id", "anchor", "run", "start", whole.alias("whole"))
            .join(classes.join(bits, ["anchor", "run"], "left"), ["anchor", "run"])
            .select("key", "start", taken.alias("bits")).where("bits is not null")
            # Rows with one id and one text have one key and the same marks.
            .groupBy("key").agg(F.collect_set(F.struct("start", "bits")).alias("marks")))


def _cut(texts: pa.Array, marks: pa.Array, length: int) -> list[pa.Array]:
    """(words, removed words, remaining words joined by one space) of each text."""
    counts, removed, kept = [], [], []
    base = 0
    for piece in words_of.pieces(texts):
        data, offsets = words_of.raw(piece)
        begins, ends, owner = words_of.word_bounds(data, offsets)
        opening = np.searchsorted(owner, np.arange(len(piece) + 1))
        part = marks.slice(base, len(piece))
        flat, bounds = part.flatten(), np.append(0, np.cumsum(np.nan_to_num(
            part.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)))
        start, bits = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2))
        start = start + np.repeat(opening[:-1], np.diff(bounds))
        change = np.zeros(len(begins) + 1, np.int64)
        for k in range(64):
            hit = start[(bits >> k) & 1 == 1] + k
            np.add.at(change, hit, 1)
            np.add.at(change, hit + length, -1)
        stay = np.cumsum(change)[:-1] == 0
        totals = np.append(0, np.cumsum(stay))
        n, left = np.diff(opening), totals[opening[1:]] - totals[opening[:-1]]
        # A kept word takes the byte behind it along, as a space, unless it is the last kept one.
        words = np.flatnonzero(stay)
        last = np.append(owner[words[1:]] != owner[words[:-1]], True) if len(words) else np.zeros(0, bool)
        edge = np.zeros(len(data) + 2, np.int8)
        edge[begins[words]] += 1
        stop = ends[words] + ~last
        np.add.at(edge, stop, -1)
        taken = np.cumsum(edge, dtype=np.int8)[:len(data)] > 0
        data = data.copy()
        data[ends[words][~last]] = 32
        size = np.append(0, np.cumsum(taken))[offsets]
        counts.append(n)
        removed.append(n - left)
        kept.append(pa.LargeStringArray.from_buffers(len(piece), pa.py_buffer(size.astype(np.int64).tobytes()),
                                                     pa.py_buffer(data[taken].tobytes())).cast(pa.string()))
        base += len(piece)
    whole = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.int64())
    return [whole(counts), whole(removed), pa.concat_arrays(kept) if kept else pa.array([], pa.string())]


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 50,
                   gram: int = GRAM, most_counters: int = MOST_COUNTERS) -> DataFrame:
    """docs with n_words, n_removed and kept: the words that no window covers whose words also start in a
    document of smaller id, joined by one space.

    Words are runs of other than ASCII white space, compared as they are. Windows are judged on the input.
    Ids may be of any type that Spark orders; a null id comes after all others, and rows with equal ids
    (or without) remove nothing of each other. A null or empty text has no words and keeps ''. Of repeated
    rows all stay and are treated alike. Columns of docs called like the three new ones are replaced;
    others pass unchanged. An empty table gives an empty table."""
    # shiftleft(1, n) - 1 marks all windows of a run, so a run has fewer than 64.
    gram = max(min(gram, length), length - 62)
    own = F.col(doc_id)
    key = F.unhex(F.md5(F.concat(F.when(own.isNull(), "-").otherwise(F.concat(F.lit("="), own.cast("string"))),
                                 F.lit(":"), F.coalesce(F.col(text), F.lit("")))))
    # Fewer characters than words and the spaces between them cannot hold a window.
    rows = (docs.where(F.length(text) >= 2 * length - 1)
            .select(key.alias("key"), own.alias("id"), F.col(text).alias("text")))
    spark = docs.sparkSession
    repeated = repeated_counters(rows.select("text"), length, gram, _counters_for(docs.select(text), most_counters))
    runs, path = storage.stage(_occurrences(rows, length, gram, repeated), "runs")
    marks, _ = storage.stage(_marks(runs), "marks")
    storage.delete(spark, path)

    added = ["n_words", "n_removed", "kept"]
    others = [c for c in docs.columns if c.lower() not in added]
    # Texts meet their marks; a key that a third of all rows share is split, as it is once on the right.
    met = (docs.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(text).alias("text"))
           .join(marks, "key", "left").select("row", "text", "marks"))

    def cut(batches):
        for batch in batches:
            found = _cut(batch.column(1), batch.column(2), length)
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["row", *added])

    long = LongType()
    schema = StructType([met.schema["row"], StructField(added[0], long), StructField(added[1], long),
                         StructField(added[2], StringType())])
    return met.mapInArrow(cut, schema).select(*[F.col(f"row.`{c}`") for c in others], *added)
