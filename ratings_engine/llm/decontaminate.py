"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages of PASSAGE words, HOP apart. Passages are TF-IDF vectors over the words
of the benchmark items; a distributed randomised singular value decomposition of benchmark passages
and all passages of all documents gives a latent space, in which every passage of
every document is compared with every benchmark passage by cosine. Pairs above a threshold are
compared again by their whole vectors, and those that remain are checked around the passage: the longest common subsequence of words with the item, and for
paraphrases whether the item's answer, its last sentence, is there as well.

The benchmark is taken in blocks of BLOCK items, so what a pass broadcasts is bounded. Document
frequencies come from all documents, and all passages of all documents are searched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratings_engine.llm.common import summed
from ratings_engine.llm.text import LETTERS, pieces, raw, word_bounds, word_hashes

PASSAGE = 32
HOP = 16
BLOCK = 200
RANK, OVERSAMPLE = 256, 16
#: Terms up to which a task counts pairs of terms (100 MB).
GRAM_TERMS = 5000
#: Cosine from which a passage is a candidate; share of the squared TF-IDF length of the least
#: informative benchmark passage that a passage must have to be compared at all: half of the words of
#: an item bring half of its length, so passages below it hold no leak.
COSINE = 0.4
MASS = 0.25
#: Cosine of the whole TF-IDF vectors that a candidate of the latent space must reach.
WORDS = 0.25
#: Shares of an item's words found in order: for a copy, and for a paraphrase with its answer.
COPY, PARAPHRASE, ANSWER = 0.8, 0.5, 0.8
AT_ONCE = 1024

LEAKS = "array<struct<item_id:bigint,similarity:double,lcs_share:double,answer_share:double,kind:string>>"


@dataclass
class Items:
    """A block of the benchmark: words and answer words by item, vocabulary, passages of terms."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray
    owner: np.ndarray


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = raw(texts)
    starts, ends, owner = word_bounds(data, offsets, LETTERS)
    return word_hashes(data, starts, ends), owner


def _answer(text: str) -> str:
    """The last sentence (or line), the whole of a text of one sentence."""
    return [s for s in re.split(r"(?<=[.?!])\s+|\n+", text.strip()) if s][-1]


def _items(rows) -> Items:
    """Items without words are left out: they cannot leak."""
    rows = [(i, t) for i, t in rows if t and len(_words(pa.array([t]))[0])]
    words = [_words(pa.array([t]))[0] for _, t in rows]
    answers = [_words(pa.array([_answer(t)]))[0] for _, t in rows]
    owner = np.repeat(np.arange(len(rows)), [-(-len(w) // PASSAGE) for w in words]) if rows else np.zeros(0, np.int64)
    vocabulary = np.unique(np.concatenate(words)) if rows else np.zeros(0, np.uint64)
    return Items([i for i, _ in rows], words, answers, vocabulary, owner)


class Lookup:
    """Places of word hashes in a sorted vocabulary; most other words are told by one table look-up."""

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        self.table = np.zeros(1 << 20, bool)
        self.table[(vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into hashes, term) of the words in the vocabulary."""
        at = np.flatnonzero(self.table[(hashes >> np.uint64(44)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
        known = self.vocabulary[term] == hashes[at]
        return at[known], term[known]


def _half_passages(owner: np.ndarray) -> np.ndarray:
    """Number of the run of HOP words that each word lies in; a run never crosses texts."""
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (place[1:] % HOP == 0)
    return np.cumsum(fresh) - 1


def _entries(hop: np.ndarray, owner: np.ndarray, at: np.ndarray, term: np.ndarray, idf: np.ndarray):
    """(passage, term, weight) with distinct terms per passage, sorted by passage. Passage p is the
    runs of words p and p + 1, if both belong to the same text."""
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.float32)
    last = hop[-1]
    of_run = np.zeros(last + 1, np.int64)
    of_run[hop] = owner
    own = hop[at]
    second = (own > 0) & (of_run[np.maximum(own - 1, 0)] == of_run[own])
    keys = np.concatenate([own, own[second] - 1]) * len(idf) + np.concatenate([term, term[second]])
    keys, count = np.unique(keys, return_counts=True)
    passage, term = keys // len(idf), keys % len(idf)
    return passage, term, (np.sqrt(count) * idf[term]).astype(np.float32)


def _project(passage: np.ndarray, term: np.ndarray, weight: np.ndarray, basis: np.ndarray):
    """(distinct passages, rows of A @ basis)."""
    first = np.flatnonzero(np.diff(passage, prepend=-1))
    size = np.diff(first, append=len(passage))
    # Longest passages first, one term of each at a time: whole rows are added, none is padded.
    order = np.argsort(-size, kind="stable")
    sums = np.zeros((len(first), basis.shape[1]), basis.dtype)
    left = len(first)
    for k in range(int(size.max(initial=0))):
        while left and size[order[left - 1]] <= k:
            left -= 1
        at = first[order[:left]] + k
        sums[:left] += basis[term[at]] * weight[at, None]
    out = np.empty_like(sums)
    out[order] = sums
    return passage[first], out


def _test_weights(items: Items) -> np.ndarray:
    """Inverse frequencies of the terms in the benchmark itself, a guess made before the documents are read."""
    term = np.searchsorted(items.vocabulary, np.concatenate(items.words))
    counts = np.bincount(term, minlength=len(items.vocabulary))
    return np.log((len(term) / HOP + 1) / np.minimum(counts + 1, len(term) / HOP + 1)) + 0.1


def _product(entries, basis: np.ndarray) -> np.ndarray:
    """A'(A basis) of the passages in entries, AT_ONCE of them at a time."""
    passage, term, weight = entries
    total = np.zeros(basis.shape)
    cuts = np.flatnonzero(np.diff(passage, prepend=-1))[::AT_ONCE]
    for low, high in zip(cuts, [*cuts[1:], len(passage)]):
        p, t, w = passage[low:high], term[low:high], weight[low:high]
        rows, projected = _project(p, t, w, basis)
        order = np.argsort(t, kind="stable")
        starts = np.flatnonzero(np.diff(t[order], prepend=-1))
        place = np.searchsorted(rows, p)
        total[t[order][starts]] += np.add.reduceat((projected[place] * w[:, None])[order], starts, axis=0)
    return total


def _add_pairs(entries, gram: np.ndarray) -> None:
    """Add the part of A'A on and above the places (term, later term of the passage) to a flat array."""
    passage, term, weight = entries
    size = int(np.sqrt(len(gram)))
    times = np.searchsorted(passage, passage, "right") - np.arange(len(term))
    until = np.cumsum(times)
    cuts = np.unique(np.searchsorted(until, np.arange(0, until[-1] if len(until) else 0, 1 << 20)))
    for low, high in zip(cuts, [*cuts[1:], len(term)]):
        own, count = np.arange(low, high), times[low:high]
        left = np.repeat(own, count)
        right = left + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        np.add.at(gram, term[left] * size + term[right], weight[left] * weight[right])


def _weights_and_latent(docs: DataFrame, text: str, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(idf, latent), both of all documents, read once. idf: log of all runs of HOP words to those with
    the term. latent: right singular vectors (terms x rank) of the benchmark's and all documents' passages.

    Randomised range finding: with A the passages weighted by counts alone, A'A times a random matrix is
    a sum over documents that needs no idf; rows are weighted afterwards. The sum and the random matrix
    make up Nystroem's approximation, whose leading vectors are returned."""
    look = Lookup(items.vocabulary)
    size = len(items.vocabulary)
    rank = min(RANK, size)
    ones = np.ones(size)
    start = np.random.default_rng(3).standard_normal((size, min(rank + OVERSAMPLE, size)))
    start *= _test_weights(items)[:, None]
    shared = docs.sparkSession.sparkContext.broadcast(start.astype(np.float32))

    def add(total, column):
        # Many passages share pairs of terms: the pairs are counted first and multiplied once.
        dense = size <= GRAM_TERMS and column.nbytes > size * size // 4
        gram = np.zeros(size * size if dense else 0, np.float32)
        for piece in pieces(column):
            hashes, owner = _words(piece)
            if not len(hashes):
                continue
            hop = _half_passages(owner)
            at, term = look(hashes)
            total[:size, 0] += np.bincount(np.unique(hop[at] * size + term) % size, minlength=size)
            total[size, 0] += hop[-1] + 1
            entries = _entries(hop, owner, at, term, ones)
            if dense:
                _add_pairs(entries, gram)
            else:
                total[:size, 1:] += _product(entries, shared.value)
        if dense:
            gram = gram.reshape(size, size)
            total[:size, 1:] += gram @ shared.value + gram.T @ shared.value - gram.diagonal()[:, None] * shared.value

    sums = summed(docs.select(text), np.zeros((size + 1, 1 + start.shape[1])), add)
    idf = np.log((sums[size, 0] + 1) / (sums[:size, 0] + 1)) + 0.1
    # In weighted terms: Y = G T with G = D A'A D, T = start / D.
    tested = sums[:size, 1:] + _product(_benchmark_entries(items, ones), start)
    inner = start.T @ tested
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    good = values > values[-1] * 1e-7
    found = idf[:, None] * tested @ (vectors[:, good] / np.sqrt(values[good]))
    return idf, np.linalg.svd(found, full_matrices=False)[0][:, :rank].astype(np.float32)


def _benchmark_entries(items: Items, idf: np.ndarray):
    """TF-IDF entries of the items' passages, one after the other; an item's last passage is its last
    PASSAGE words, so that none is a remainder of a few words."""
    parts = []
    for words in items.words:
        term = np.searchsorted(items.vocabulary, words)
        starts = range(0, len(term), PASSAGE)
        parts += [term[max(0, min(s, len(term) - PASSAGE)):s + PASSAGE] for s in starts]
    passage = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    keys, count = np.unique(passage * len(idf) + np.concatenate(parts), return_counts=True)
    return keys // len(idf), keys % len(idf), (np.sqrt(count) * idf[keys % len(idf)]).astype(np.float32)


def common_length(pattern: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit of a whole number per word of the pattern."""
    places: dict[int, int] = {}
    for k, w in enumerate(pattern.tolist()):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << len(pattern)) - 1
    row = full
    for w in words.tolist():
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(pattern) - row.bit_count()


def judge(item: np.ndarray, answer: np.ndarray, words: np.ndarray) -> tuple[float, float, str | None]:
    """(share of the item in order, share of the answer in order, kind or None)."""
    share = common_length(item, words) / len(item)
    if share < PARAPHRASE:
        return share, 0.0, None
    of_answer = common_length(answer, words) / len(answer) if len(answer) else 1.0
    return share, of_answer, "copy" if share >= COPY else "paraphrase" if of_answer >= ANSWER else None


def _normal(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


#: Candidate pairs whose whole vectors are multiplied at once.
PAIRS_AT_ONCE = 1 << 15


def _alike(row, query, bounds, term, weight, whole) -> np.ndarray:
    """Marks the (passage, query) pairs whose whole vectors reach the cosine WORDS."""
    size = np.diff(bounds)
    length = np.sqrt(np.add.reduceat(weight[:bounds[-1]] ** 2, bounds[:-1]))
    alike = np.zeros(len(row), bool)
    for low in range(0, len(row), PAIRS_AT_ONCE):
        r, q = row[low:low + PAIRS_AT_ONCE], query[low:low + PAIRS_AT_ONCE]
        ends = np.cumsum(size[r])
        begins = ends - size[r]
        entry = np.arange(ends[-1]) + np.repeat(bounds[r] - begins, size[r])
        products = whole[np.repeat(q, size[r]), term[entry]] * weight[entry]
        alike[low:low + PAIRS_AT_ONCE] = np.add.reduceat(products, begins) >= WORDS * length[r]
    return alike


def _search(piece: pa.Array, items: Items, look: Lookup, idf, latent, queries, whole, least: float):
    """Text number -> {item number: (similarity, lcs share, answer share, kind)} of one run of texts."""
    hashes, owner = _words(piece)
    hop = _half_passages(owner)
    passage, term, weight = _entries(hop, owner, *look(hashes), idf)
    if not len(passage):
        return {}
    mass = np.bincount(passage, weight * weight)
    keep = mass[passage] >= least
    passage, term, weight = passage[keep], term[keep], weight[keep]
    first = np.searchsorted(hop, np.arange(hop[-1] + 1))
    found: dict[int, dict] = {}
    cuts = np.flatnonzero(np.diff(passage, prepend=-1))[::AT_ONCE]
    for low, high in zip(cuts, [*cuts[1:], len(passage)]):
        numbers, projected = _project(passage[low:high], term[low:high], weight[low:high], latent)
        length = np.sqrt(np.einsum("ij,ij->i", projected, projected))
        cosine = projected @ queries
        bounds = low + np.searchsorted(passage[low:high], [*numbers, passage[high - 1] + 1])
        rows, near = np.nonzero(cosine >= COSINE * np.maximum(length, 1e-9)[:, None])
        alike = _alike(rows, near, bounds, term, weight, whole)
        for row, query in zip(rows[alike], near[alike]):
            item, at = int(items.owner[query]), first[numbers[row]]
            text = int(owner[at])
            begin, end = np.searchsorted(owner, (text, text + 1))
            reach = len(items.words[item])
            around = hashes[max(begin, at - reach):min(end, at + PASSAGE + reach)]
            share, of_answer, kind = judge(items.words[item], items.answers[item], around)
            best = found.setdefault(text, {}).get(item)
            if kind and (best is None or share > best[1]):
                found[text][item] = (float(cosine[row, query] / length[row]), share, of_answer, kind)
    return found


def annotate(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
             item_id: str = "item_id", item_text: str = "text", column: str = "leaks") -> DataFrame:
    """docs with the benchmark items that leaked into each text: an array, empty for clean texts.

    Null and empty texts are clean, items without words leak nowhere, equal texts get equal results.
    A column of the same name gives way. Without items every text is clean."""
    kept = [c for c in docs.columns if c != column]
    place = kept.index(text)
    out = docs.select(*kept).withColumn(column, F.array().cast(LEAKS))
    total = benchmark.count()
    blocks = -(-total // BLOCK)
    numbered = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    for block in range(blocks):
        # Blocks by hash: about BLOCK items each, whatever the ids.
        rows = numbered.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id", "text").collect()
        items = _items(rows)
        if not items.ids:
            continue
        idf, latent = _weights_and_latent(docs, text, items)
        passage, term, weight = _benchmark_entries(items, idf)
        queries = np.ascontiguousarray(_normal(_project(passage, term, weight, latent)[1]).T)
        whole = np.zeros((len(items.owner), len(idf)), np.float32)
        whole[passage, term] = weight
        least = MASS * np.bincount(passage, weight * weight).min()
        # Plain data: a broadcast is unpickled where this package need not be.
        shared = docs.sparkSession.sparkContext.broadcast((vars(items), idf, latent, queries, _normal(whole), float(least)))

        def searched(batches, shared=shared):
            fields, *rest = shared.value
            items = SimpleNamespace(**fields)
            look = Lookup(items.vocabulary)
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("lcs_share", pa.float64()),
                                       ("answer_share", pa.float64()), ("kind", pa.string())]))
            for batch in batches:
                leaks, done = batch.column(len(kept)).to_pylist(), 0
                for piece in pieces(batch.column(place)):
                    for number, hits in _search(piece, items, look, *rest).items():
                        leaks[done + number] += [
                            {"item_id": items.ids[k], "similarity": s, "lcs_share": share, "answer_share": a, "kind": what}
                            for k, (s, share, a, what) in sorted(hits.items())]
                    done += len(piece)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(leaks, kind)], batch.schema.names)

        out = out.mapInArrow(searched, out.schema)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, similarity, lcs_share, answer_share, kind."""
    doc_id = names.get("doc_id", "doc_id")
    found = annotate(docs.select(doc_id, names.get("text", "text")), benchmark, **names)
    return found.select(doc_id, F.explode("leaks").alias("leak")).select(doc_id, "leak.*")


def remove(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """The documents without leaks, all columns unchanged."""
    return annotate(docs, benchmark, column="leaks of this pass", **names).where(
        F.size("`leaks of this pass`") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
