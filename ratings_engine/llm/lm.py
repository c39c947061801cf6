"""Deleted interpolation: an n-gram language model whose orders are mixed by context frequency.

P(w | u v) = l3 c(uvw)/c(uv) + l2 c(vw)/c(v) + l1 c(w)/N + l0 / (V + 1), with weights l that depend
on how often the context was seen (powers of four) and are learned by expectation-maximisation on a
tenth of the training documents, with the counts of all other training documents.

Counts grow with the corpus and are never gathered: documents are dealt to blocks; every block sends
each range of hashed n-grams the n-grams it holds with its own counts, as packed sorted rows; a range
adds up what the blocks sent and answers each block in the order of its request; the block then
scores its documents. A text travels once, an n-gram once per block. The tokens set aside stay in
their blocks as well: a round of expectation-maximisation is an aggregate over them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratings_engine.llm.common import staged
from ratings_engine.llm.text import mix, pieces, raw, word_bounds, word_hashes

ORDER = 3
#: Documents of a block, and n-grams that a range holds of one block on average.
BLOCK_ROWS = 2000
RANGES_PER_BLOCK = 1.5
#: n-grams of two words and more are known by so many bits, words by all 64.
GRAM_BITS = 48
#: One in so many training documents is set aside to learn the mixture weights.
SHARE = 10
BUCKETS = 12
ROUNDS = 40
END = np.uint64(0xE7D0E7D0E7D0E7D1)
START = np.uint64(0x5A5A0001F0F05A5B)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Totals:
    """Bounded numbers of the training corpus."""

    tokens: int
    vocabulary: int
    #: Tokens of the training documents set aside.
    aside: int = 0


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number): the words of each text and its end."""
    data, offsets = raw(texts)
    starts, ends, owner = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    count = len(texts)
    out = np.empty(len(hashes) + count, np.uint64)
    text = np.empty(len(out), np.int64)
    place = np.arange(len(hashes)) + owner
    out[place], text[place] = hashes, owner
    last = np.searchsorted(owner, np.arange(count), "right") + np.arange(count)
    out[last], text[last] = END, np.arange(count)
    return out, text


def grams(words: np.ndarray, text: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order the hash of the n-gram that ends at each token; texts begin with starts."""
    out, history = [words], words
    place = np.arange(len(words)) - np.searchsorted(text, text)
    low = np.uint64((1 << GRAM_BITS) - 1)
    for n in range(2, order + 1):
        earlier = np.concatenate([np.full(n - 1, START, np.uint64), words[:-(n - 1)]])[:len(words)]
        earlier = np.where(place >= n - 1, earlier, START)
        history = mix(history * _PRIME + earlier)
        out.append(history & low)
    return out


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes, low first, as many as the largest needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + planes.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _width(order: int, ranges: int) -> int:
    """Numbers in each of the ranges that the keys of an order are dealt to."""
    return (1 << (64 if order == 1 else GRAM_BITS)) // ranges + 1


class Keyed:
    """The n-grams of some texts as places in sorted arrays of distinct keys, one per order, which
    count as one array after the other.

    at[n] holds the place of the n+1-gram that ends at each token, before[n] that of the n+1-gram that
    ends at the token before it (at a text's begin, of the start mark, which is among the words)."""

    def __init__(self, texts: pa.Array, order: int):
        words, self.text = tokens(texts)
        found = grams(words, self.text, order)
        parts = [np.unique(np.append(found[0], START), return_inverse=True)]
        parts += [np.unique(g, return_inverse=True) for g in found[1:]]
        self.keys = [p[0] for p in parts]
        self.offsets = np.cumsum([0, *map(len, self.keys)])
        self.size, self.start = int(self.offsets[-1]), int(parts[0][1][-1])
        self.at = [(low + p[1][:len(words)]).astype(np.int32) for low, p in zip(self.offsets, parts)]
        first = np.ones(len(words), bool)
        first[1:] = self.text[1:] != self.text[:-1]
        self.before = [np.where(first, self.start, np.roll(at, 1)) for at in self.at[:-1]]

    def counts(self, training: np.ndarray) -> np.ndarray:
        """How often each key occurs in the texts to learn from."""
        learn = training[self.text]
        counts = sum(np.bincount(at[learn], minlength=self.size) for at in self.at)
        counts[self.start] += int(training.sum())
        return counts

    def ranges(self, number: int) -> list[list[tuple[int, int]]]:
        """Per range of keys and order the places (from, to) of the keys in it."""
        cuts = []
        for n, keys in enumerate(self.keys):
            part = keys // np.uint64(_width(n + 1, number))
            cuts.append(self.offsets[n] + np.searchsorted(part, np.arange(number + 1, dtype=np.uint64)))
        return [[(int(c[p]), int(c[p + 1])) for c in cuts] for p in range(number)]


def _narrow(docs: DataFrame, text: str, carried: list[str], training: Column) -> DataFrame:
    """(text, training, aside, row). Every pass reads these columns whole, so that all see the same order."""
    learn = F.coalesce(training, F.lit(False))
    # A row's place in the scan, not its content, decides: copies of one text are not all set aside.
    aside = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SHARE)) == 0
    return docs.select(F.col(text).alias("text"), learn.alias("training"), (learn & aside).alias("aside"),
                       F.struct(F.lit(0).alias("no column"), *carried).alias("row"))


def _blocked(narrow: DataFrame, rows: int, make, schema: str) -> DataFrame:
    """What make(name, table) gives for runs of rows of each task.

    A block is named by task and run, so a task that runs again on a scan makes the same blocks."""

    def pack(batches):
        task, number, waiting = TaskContext.get().partitionId(), 0, []

        def block():
            nonlocal number, waiting
            table = pa.Table.from_batches(waiting)
            number, waiting = number + 1, []
            return make(task << 32 | number, table).to_batches()

        for batch in batches:
            for low in range(0, len(batch), rows):
                waiting.append(batch.slice(low, rows))
                if sum(map(len, waiting)) >= rows:
                    yield from block()
        if waiting:
            yield from block()

    return narrow.mapInArrow(pack, schema)


def _packed(name: int, table: pa.Table) -> pa.Table:
    return pa.table({"block": pa.array([name], pa.int64()), "packed": pa.array([_to_bytes(table)], pa.binary())})


def _to_bytes(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _from_bytes(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def _requests(narrow: DataFrame, rows: int, ranges: int, order: int) -> DataFrame:
    def ask(name: int, table: pa.Table) -> pa.Table:
        block = Keyed(table.column("text").combine_chunks(), order)
        counts = block.counts(table.column("training").to_numpy())
        asides = block.counts(table.column("aside").to_numpy())
        parts, keys, own, aside = [], [], [], []
        for p, spans in enumerate(block.ranges(ranges)):
            if all(a == b for a, b in spans):
                continue
            parts.append(p)
            keys.append([_pack(np.diff(block.keys[n][a - block.offsets[n]:b - block.offsets[n]],
                                       prepend=np.uint64(p * _width(n + 1, ranges)))) for n, (a, b) in enumerate(spans)])
            for out, numbers in ((own, counts), (aside, asides)):
                out.append(zlib.compress(_pack(np.concatenate([numbers[a:b] for a, b in spans])), 1))
        return pa.table({"block": pa.array([name] * len(parts), pa.int64()), "part": pa.array(parts, pa.int64()),
                         "keys": pa.array(keys, pa.list_(pa.binary())), "counts": pa.array(own, pa.binary()),
                         "aside": pa.array(aside, pa.binary())})

    return _blocked(narrow, rows, ask, "block bigint, part bigint, keys array<binary>, counts binary, aside binary")


def _answers(requests: DataFrame, ranges: int) -> DataFrame:
    """Total counts in the order of each request, and others: counts without the documents set aside,
    of those keys that the block holds in such documents (null: none)."""

    def add(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        counts, asides = ([_unpack(zlib.decompress(c.as_py())) for c in table.column(name)] for name in ("counts", "aside"))
        asked = [[_unpack(k) for k in row] for row in table.column("keys").to_pylist()]
        totals, others, done = [[] for _ in asked], [[] for _ in asked], [0] * len(asked)
        for n in range(len(asked[0])):
            keys = [np.cumsum(row[n]) + np.uint64(part * _width(n + 1, ranges)) for row in asked]
            own, aside = ([c[k][done[k]:done[k] + len(x)] for k, x in enumerate(keys)] for c in (counts, asides))
            distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total, left = (np.bincount(inverse, np.concatenate(c), len(distinct)).astype(np.uint64) for c in (own, aside))
            left = total - left
            cut = np.cumsum([0, *map(len, keys)])
            for k, x in enumerate(keys):
                at = inverse[cut[k]:cut[k + 1]]
                totals[k].append(total[at])
                others[k].append(left[at[aside[k] > 0]])
                done[k] += len(x)
        pack = lambda arrays: zlib.compress(_pack(np.concatenate(arrays)), 1)
        return pa.table({"block": table.column("block"), "part": table.column("part"),
                         "totals": pa.array([pack(t) for t in totals], pa.binary()),
                         "others": pa.array([pack(t) if any(map(len, t)) else None for t in others], pa.binary())})

    return requests.groupBy("part").applyInArrow(add, "block bigint, part bigint, totals binary, others binary")


def _answered(block: Keyed, ranges: int, parts: pa.ChunkedArray, packed: pa.ChunkedArray) -> np.ndarray:
    """The counts of a block's keys from the answers to it."""
    counts, spans = np.zeros(block.size), block.ranges(ranges)
    for p, packed_ in zip(parts.to_pylist(), packed.to_pylist(), strict=True):
        found = _unpack(zlib.decompress(packed_))
        for a, b in spans[p]:
            counts[a:b], found = found[:b - a], found[b - a:]
    return counts


def _probabilities(block: Keyed, counts: np.ndarray, tokens: int, vocabulary: int):
    """(bucket, probabilities by order from 0) of each token, given the counts of the keys among so many tokens."""
    size = len(block.text)
    by_order = [np.full(size, 1 / (vocabulary + 1)), counts[block.at[0]] / max(tokens, 1)]
    # The longest context that was seen decides: its length and how often it was seen.
    bucket = np.zeros(size, np.int64)
    for n, (gram, context) in enumerate(zip(block.at[1:], block.before, strict=True)):
        seen = counts[context]
        by_order.append(np.where(seen > 0, counts[gram] / np.maximum(seen, 1), 0.0))
        level = np.minimum(np.log2(np.maximum(seen, 1)).astype(np.int64) // 2, BUCKETS - 1)
        bucket = np.where(seen > 0, 1 + n * BUCKETS + level, bucket)
    return bucket, np.stack(by_order, 1)


def expected(weights: np.ndarray, bucket: np.ndarray, probabilities: np.ndarray) -> np.ndarray:
    """How many tokens each order accounts for, by bucket."""
    shares = weights[bucket] * probabilities
    shares /= shares.sum(1, keepdims=True)
    return np.stack([np.bincount(bucket, shares[:, k], len(weights)) for k in range(weights.shape[1])], 1)


def maximised(expect: Callable[[np.ndarray], np.ndarray], order: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights by bucket. Expectation-maximisation from equal weights; one token's worth of
    equal weights is added, so that a bucket without tokens stays mixed."""
    weights = np.full((1 + BUCKETS * max(order - 1, 1), order + 1), 1 / (order + 1))
    for _ in range(rounds):
        total = expect(weights) + 1 / (order + 1)
        weights = total / total.sum(1, keepdims=True)
    return weights


def learn_weights(bucket: np.ndarray, probabilities: np.ndarray, order: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights by bucket of tokens at hand."""
    return maximised(lambda weights: expected(weights, bucket, probabilities), order, rounds)


def fit_weights(narrow: DataFrame, answers: DataFrame, totals: Totals, rows: int, ranges: int, order: int) -> np.ndarray:
    """Weights from all documents set aside, with the counts of their n-grams taken over all other
    training documents. Tokens stay with the tasks; the driver sees a sum per task, bucket and order."""

    def aside(name: int, table: pa.Table) -> pa.Table:
        held = table.select(["text"]).filter(table.column("aside"))
        return _packed(name, held).slice(0, min(len(held), 1))

    def tokens_aside(packed: pa.Table, answered: pa.Table) -> pa.Table:
        block = Keyed(_from_bytes(packed.column("packed")[0].as_py()).column("text").combine_chunks(), order)
        counts = _answered(block, ranges, answered.column("part"), answered.column("others"))
        bucket, probabilities = _probabilities(block, counts, totals.tokens - totals.aside, totals.vocabulary)
        columns = {"bucket": bucket.astype(np.int16)} | {str(k): probabilities[:, k] for k in range(order + 1)}
        return pa.table({"packed": pa.array([_to_bytes(pa.table(columns))], pa.binary())})

    known = answers.where("others is not null").select("block", "part", "others")
    tokens_ = staged(_blocked(narrow, rows, aside, "block bigint, packed binary").groupBy("block")
                     .cogroup(known.groupBy("block")).applyInArrow(tokens_aside, "packed binary"), "aside")

    def expect(weights: np.ndarray) -> np.ndarray:
        def add(batches):
            total = np.zeros(weights.shape)
            for batch in batches:
                for packed in batch.column(0):
                    table = _from_bytes(packed.as_py())
                    total += expected(weights, table.column("bucket").to_numpy(),
                                      np.stack([table.column(str(k)).to_numpy() for k in range(order + 1)], 1))
            yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

        sums = tokens_.mapInArrow(add, "sums binary").collect()
        return sum((np.frombuffer(bytes(r[0])).reshape(weights.shape) for r in sums), np.zeros(weights.shape))

    return maximised(expect, order)


def totals_of(narrow: DataFrame) -> Totals:
    """Tokens and distinct tokens of the training documents: words by hash in a plain aggregate."""

    def distinct(batches):
        for batch in batches:
            batch = batch.filter(batch.column("training"))
            held, words, aside, done = batch.column("aside").to_numpy(zero_copy_only=False), [], 0, 0
            for piece in pieces(batch.column("text")):
                found, text = tokens(piece)
                words.append(found)
                aside += int(held[done + text].sum())
                done += len(piece)
            keys, counts = np.unique(np.concatenate(words or [np.zeros(0, np.uint64)]), return_counts=True)
            asides = np.zeros(len(keys), np.int64)
            asides[:1] = aside
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts), pa.array(asides)],
                                             ["key", "n", "aside"])

    rows = narrow.mapInArrow(distinct, "key bigint, n bigint, aside bigint")
    found = (rows.groupBy("key").agg(F.sum("n").alias("n"), F.sum("aside").alias("aside"))
             .agg(F.count("*"), F.sum("n"), F.sum("aside")).first())
    return Totals(found[1] or 0, found[0], found[2] or 0)


def score(docs: DataFrame, training: Column, text: str = "text", order: int = ORDER,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """docs (without the text) with n_tokens, n_known, train_tokens, base_score and score.

    training says which rows the model learns from (null: not). Null and empty texts consist of their
    end only. base_score is the add-half unigram score, score the model's; both log10. Input columns
    named like a result give way; repeated rows count and score each; an empty table gives no rows."""
    from pyspark.sql.types import StructType
    results = ("n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    names = [part.split()[0] for part in results.split(", ")]
    carried = [c for c in docs.columns if c not in (text, *names)]
    narrow = _narrow(docs, text, carried, training)
    totals = totals_of(narrow)
    ranges = max(2, math.ceil(docs.count() / block_rows * RANGES_PER_BLOCK))
    answers = staged(_answers(_requests(narrow, block_rows, ranges, order), ranges), "answers")
    weights = fit_weights(narrow, answers, totals, block_rows, ranges, order)
    blocked = _blocked(narrow, block_rows, lambda name, table: _packed(name, table.select(["text", "row"])),
                       "block bigint, packed binary")

    def judge(packed: pa.Table, answered: pa.Table) -> pa.Table:
        texts = _from_bytes(packed.column("packed")[0].as_py())
        block = Keyed(texts.column("text").combine_chunks(), order)
        text_ = block.text
        counts = _answered(block, ranges, answered.column("part"), answered.column("totals"))
        n = len(texts)
        seen = counts[block.at[0]]
        base = np.log10((seen + 0.5) / (totals.tokens + 0.5 * (totals.vocabulary + 1)))
        bucket, probabilities = _probabilities(block, counts, totals.tokens, totals.vocabulary)
        mixed = np.log10((weights[bucket] * probabilities).sum(1))
        return pa.table({
            "row": texts.column("row"),
            "n_tokens": pa.array(np.bincount(text_, minlength=n), pa.int64()),
            "n_known": pa.array(np.bincount(text_[seen > 0], minlength=n), pa.int64()),
            "train_tokens": pa.array(np.full(n, totals.tokens), pa.int64()),
            "base_score": np.bincount(text_, base, n), "score": np.bincount(text_, mixed, n)})

    schema = StructType([narrow.schema["row"], *StructType.fromDDL(results).fields])
    return (blocked.groupBy("block").cogroup(answers.select("block", "part", "totals").groupBy("block")).applyInArrow(judge, schema)
            .select("row.*", *names).drop("no column"))
