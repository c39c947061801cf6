"""Spelling variants: words that differ by one edit, found by dynamic programming over sorted lists.

Two words of t and t or t + 1 characters that differ by one edit agree in their first t // 2 characters
or in as many last ones, so each word joins the groups of its halves; the edit lies in the rest, the
piece. A group with more than `most` members is split the same way along its piece, which ends at pieces
of one character, so no group grows with the vocabulary beyond the alphabet. A pair belongs to one group only:
the one that its first differing character decides.

Within a group the words are a sorted list of pieces. For every word of t characters the banded matrix of edit
distances against that list is filled row by row: words that share a prefix share its rows (their common
prefix with the word before, the LCP, says how many), and a range of words whose shared prefix already has
more than one edit is left with all its words. All ranges of one depth are advanced together in numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratings_engine.llm.common import ascii_lower
from ratings_engine.sources import storage

#: Members of a group that one task compares.
MOST = 20000
#: Words compared with their lists at a time.
QUERIES = 4096
#: A form is this many times as frequent as its variant.
RATIO = 10


def near_in_groups(pieces: np.ndarray, size: np.ndarray, group: np.ndarray, short: np.ndarray, queries: int = QUERIES):
    """Pairs (i, j) of rows of one group whose pieces differ by exactly one edit, i short; both short: i < j.

    pieces: code points, a row each, 0 beyond size; rows sorted by group and piece, distinct in a group."""
    n, width = pieces.shape
    if not n:
        return
    new_group = np.append(True, group[1:] != group[:-1])
    differ = pieces[1:] != pieces[:-1]
    lcp = np.append(0, np.where(differ.any(axis=1), differ.argmax(axis=1), width))
    bound = np.append(np.flatnonzero(new_group), n)
    opening = bound[np.searchsorted(bound, np.arange(n), "right") - 1]
    closing = bound[np.searchsorted(bound, np.arange(n), "right")]
    # At depth d a new range begins where the shared prefix is shorter than d. Ranges are numbered in order.
    heads = [np.append(np.flatnonzero(new_group | (lcp < d)), n) for d in range(width + 1)]
    number = [np.searchsorted(h, np.arange(n), "right") - 1 for h in heads]
    padded = np.concatenate([np.zeros((n, 1), pieces.dtype), pieces, np.zeros((n, 2), pieces.dtype)], axis=1)
    asked = np.flatnonzero(short)
    two = np.int8(2)
    for first in range(0, len(asked), queries):
        query = asked[first:first + queries]
        low, high = opening[query], closing[query]
        # Cells of row d: distances of the list's prefix of d to the query's prefixes of d - 1, d, d + 1.
        a, b = np.full(len(query), two), np.zeros(len(query), np.int8)
        c = np.where(size[query] >= 1, 1, 2).astype(np.int8)
        for d in range(width + 1):
            # The word that ends here, if any, is the first of its range.
            m = size[query]
            found = (size[low] == d) & (low != query) & (
                ((m == d) & (b <= 1) & (low > query) & short[low]) | ((m == d - 1) & (a <= 1) & ~short[low]))
            if found.any():
                yield query[found], low[found]
            if d == width:
                break
            # Enter the ranges of the next depth.
            begin, end = number[d + 1][low], number[d + 1][high - 1] + 1
            times = end - begin
            total = int(times.sum())
            source = np.repeat(np.arange(len(query)), times)
            child = np.arange(total) - np.repeat(np.cumsum(times) - times, times) + begin[source]
            start = heads[d + 1][child]
            letter = pieces[start, d]
            goes_on = letter != 0
            source, child, start, letter = source[goes_on], child[goes_on], start[goes_on], letter[goes_on]
            q = query[source]
            a0, b0, c0 = a[source], b[source], c[source]
            at = padded[q, d], padded[q, d + 1], padded[q, d + 2]
            left = size[q] - d
            x = np.minimum(a0 + (letter != at[0]), b0 + 1)
            y = np.minimum(np.minimum(b0 + (letter != at[1]), c0 + 1), x + 1)
            z = np.minimum(c0 + (letter != at[2]), y + 1)
            x = np.where((left >= 0) & (d > 0), x, b0 + 1 if d == 0 else 2)
            y = np.where(left >= 1, np.minimum(y, x + 1), 2)
            z = np.where(left >= 2, np.minimum(z, y + 1), 2)
            alive = np.minimum(np.minimum(x, y), z) <= 1
            query, low = q[alive], start[alive]
            high = heads[d + 1][child[alive] + 1]
            a, b, c = (np.minimum(v[alive], 2).astype(np.int8) for v in (x, y, z))
            if not len(query):
                break


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, words), np.int64, len(words))
    width = int(size.max(initial=0))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    out = np.zeros((len(words), width), np.uint32)
    out[np.arange(width) < size[:, None]] = flat
    return out, size


def _members(vocabulary: DataFrame) -> DataFrame:
    """Each word as the shorter (or equal) and as the longer one of a pair: (word, n, t, start, span, open).

    The edit lies in the `span` characters from `start` of the shorter word; in the longer one they are one
    more. open: it may also lie right behind them."""
    length = F.char_length("word")
    return vocabulary.select("word", "n", F.explode(F.array(length, length - 1)).alias("t")).select(
        "word", "n", "t", F.lit(0).alias("start"), F.col("t").alias("span"), F.lit(True).alias("open"))


def _halved(members: DataFrame) -> DataFrame:
    """Members of the two groups that share the first or the last part of the piece."""
    half = F.floor(F.col("span") / 2).cast("int")
    parts = F.array(
        F.struct((F.col("start") + half).alias("start"), (F.col("span") - half).alias("span"), F.col("open").alias("open")),
        F.struct(F.col("start").alias("start"), half.alias("span"), F.lit(False).alias("open")))
    return members.select("word", "n", "t", F.explode(parts).alias("part")).select("word", "n", "t", "part.*")


def _key(members: DataFrame) -> DataFrame:
    """With `around`: what the members of a group share before and behind their piece."""
    word, behind = F.col("word"), F.col("t") - F.col("start") - F.col("span")
    # Code points below the letters part the two sides.
    around = F.concat(F.substring(word, F.lit(1), F.col("start")), F.lit("\n"), F.when(behind > 0, F.expr(
        "right(word, t - start - span)")).otherwise(""))
    return members.withColumn("around", around)


_GROUP = ["t", "start", "span", "open", "around"]


def near_words(vocabulary: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n, near, near_n) for every two words of vocabulary (word, n) that differ by exactly one inserted,
    deleted or replaced code point, in both directions. Words must be distinct."""
    members = _key(_halved(_members(vocabulary.where(F.char_length("word") >= 1))))
    done = []
    while True:
        crowded = (members.groupBy(*_GROUP).agg(F.count("*").alias("members"))
                   .where((F.col("members") > most) & (F.col("span") > 1)).drop("members"))
        crowded, path = storage.stage(crowded, "crowded")
        if crowded.isEmpty():
            storage.delete(members.sparkSession, path)
            break
        done.append(members.join(crowded, _GROUP, "left_anti"))
        members = _key(_halved(members.join(crowded, _GROUP, "left_semi").drop("around")))
    for part in done:
        members = members.unionByName(part)

    def pairs(batches):
        for rows in _whole_groups(batches):
            words = rows.column("word").to_pylist()
            n = rows.column("n")
            t, start, span = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("t", "start", "span"))
            reach, opened = start + span, rows.column("open").to_numpy(zero_copy_only=False)
            around = rows.column("around").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            size = np.fromiter(map(len, words), np.int64, len(words))
            short = size == t
            codes, sizes = _codes([w[s:s + p + (len(w) > k)] for w, s, p, k in zip(words, start, span, t, strict=True)])
            # Big-endian bytes of a piece sort as its code points.
            piece = np.ascontiguousarray(codes.astype(">u4")).view(f"S{max(4 * codes.shape[1], 1)}")[:, 0] if codes.shape[1] else np.zeros(len(words), "S1")
            order = np.lexsort((piece, around, opened, span, start, t))
            label = np.stack([around, opened, span, start, t])[:, order]
            group = np.cumsum(np.append(0, (label[:, 1:] != label[:, :-1]).any(axis=0)))
            for i, j in near_in_groups(codes[order], sizes[order], group, short[order]):
                i, j = order[i], order[j]
                shared = _shared(codes, i, j) + start[i]
                own = opened[i] | (shared < reach[i])
                i, j = pa.array(i[own]), pa.array(j[own])
                a, b, of_a, of_b = rows.column("word").take(i), rows.column("word").take(j), n.take(i), n.take(j)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]), pa.concat_arrays([of_a, of_b]),
                                                  pa.concat_arrays([b, a]), pa.concat_arrays([of_b, of_a])],
                                                 ["word", "n", "near", "near_n"])

    dealt = members.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return dealt.mapInArrow(pairs, "word string, n bigint, near string, near_n bigint")


def _shared(codes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Code points that the pieces have in common from their start."""
    differ = codes[i] != codes[j]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), codes.shape[1])


def _whole_groups(batches):
    """The rows of sorted batches as tables that end with a group."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]).combine_chunks()
        if rest is not None:
            rows = pa.concat_tables([rest, rows]).combine_chunks()
        last = [rows.column(c)[-1].as_py() for c in _GROUP]
        same = np.ones(rows.num_rows, bool)
        for c, value in zip(_GROUP, last, strict=True):
            same &= np.asarray(pc.equal(rows.column(c), value))
        cut = int(same.argmax())
        rest = rows.slice(cut)
        if cut:
            yield rows.slice(0, cut).combine_chunks().to_batches()[0]
    if rest is not None:
        yield rest.combine_chunks().to_batches()[0]


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = 7, least_count: int = 2,
               one_in: int = 31) -> DataFrame:
    """(word, n): letter runs of all texts, lower-cased A-Z, with misspellings planted by a hash of id and run.

    A run of h = crc32(id:run) divisible by one_in loses its code point h % length. A null id counts as ''."""
    found = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(
        ascii_lower(F.col(text)), F.lit(rf"[a-zÀ-ÿ]{{{least_length},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    hashed = found.select("run", h.alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    word: Column = F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run"))
    return (hashed.select(word.alias("word")).where(F.char_length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to their ends. Counts grow tenfold a step, so there are few."""
    links, path = storage.stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer, longer_path = storage.stage(
            links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                       F.col("next").isNotNull().alias("moved")), "forms")
        storage.delete(forms.sparkSession, path)
        links, path = longer.select("word", "root"), longer_path
        if longer.where("moved").isEmpty():
            return links


def group(words: DataFrame, ratio: int = RATIO, most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n).

    form is the near word of largest n (ties: the smallest in code-point order) if that n is at least `ratio`
    times the word's, else null; root is where the forms end, the word itself without any. ratio must be
    over 1, so that forms never run in circles. Words are distinct and not null; words of one character
    have near ones too. An empty vocabulary gives no rows."""
    words, _ = storage.stage(words.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near")))
    near = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    met = words.join(near, "word", "left")
    is_form = -F.col("best.order") >= F.lit(ratio) * F.col("n")
    met, _ = storage.stage(met.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.order")).alias("form_n")), "near")
    roots = _roots(met.where("form is not null"))
    return met.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = 7, least_count: int = 2,
             one_in: int = 31, ratio: int = RATIO) -> DataFrame:
    """group() over the vocabulary() of docs. Null and empty texts have no words, long ones are read whole,
    repeated rows count each, other columns are not read; an empty table gives no rows."""
    return group(vocabulary(docs, text, doc_id, least_length, least_count, one_in), ratio)
