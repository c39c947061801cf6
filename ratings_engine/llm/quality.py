"""Text quality by naive Bayes support vectors.

Features are indicators of byte n-grams, of words, and of how many words and immediate repeats of a
word there are (in powers of two), hashed to DIMENSIONS places. Each is scaled by
the log ratio of its counts in the two classes; a linear hinge-loss model on the scaled features,
brought to unit length, is fitted by dual coordinate descent. A logistic curve through the margins
of a fifth of the sample, left out of that fit, turns margins into probabilities.

The fit takes a bounded sample of labelled rows (MAX_ROWS, chosen by a hash of the id) and runs in
one task; the model is one weight per place. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratings_engine.llm.text import mix, pieces, raw, word_bounds, word_hashes

DIMENSIONS = 1 << 18
ORDERS = (1, 2, 3)
MAX_ROWS = 8000
SLICE = 1 << 20
ROUNDS = 12
COST = 1.0
SMOOTHING = 1.0
ACCEPT = 0.7


@dataclass
class Model:
    """ratio: class log-count ratio per feature; weight: of the scaled feature; curve: slope, shift."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    curve: tuple[float, float]

    def probability(self, margin):
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margin + self.curve[1], -500, 500)))


class Indicators:
    """Distinct feature places of texts, slice by slice; keeps two tables of DIMENSIONS between texts."""

    def __init__(self):
        self.seen = np.full(DIMENSIONS, -1, np.int64)
        self.last = np.zeros(DIMENSIONS, np.int32)
        self.number = 0

    def _fresh(self, places: np.ndarray) -> np.ndarray:
        places = places[self.seen[places] != self.number]
        order = np.arange(len(places), dtype=np.int32)
        self.last[places] = order
        places = places[self.last[places] == order]
        self.seen[places] = self.number
        return places

    def of(self, data: np.ndarray, words: np.ndarray) -> np.ndarray:
        self.number += 1
        repeats = np.count_nonzero(words[1:] == words[:-1])
        shape = mix(np.array([len(words).bit_length(), 64 + int(repeats).bit_length()], np.uint64))
        found = [self._fresh((np.concatenate([words, shape]) & np.uint64(DIMENSIONS - 1)).astype(np.int64))]
        for low in range(0, len(data), SLICE):
            piece = data[low:low + SLICE + max(ORDERS) - 1].astype(np.uint32)
            for n in ORDERS:
                count = min(len(piece), SLICE + n - 1) - n + 1
                if count > 0:
                    code = np.full(count, n, np.uint32)
                    for k in range(n):
                        code = (code ^ piece[k:k + count]) * np.uint32(0x01000193)
                    found.append(self._fresh(((code ^ (code >> np.uint32(15))) & np.uint32(DIMENSIONS - 1)).astype(np.int64)))
        return np.concatenate(found)


def indicators(texts: pa.Array):
    """The distinct feature places of each text."""
    places = Indicators()
    for piece in pieces(texts):
        data, offsets = raw(piece)
        starts, ends, owner = word_bounds(data, offsets)
        hashes = mix(word_hashes(data, starts, ends))
        cuts = np.searchsorted(owner, np.arange(len(piece) + 1))
        for i in range(len(piece)):
            yield places.of(data[offsets[i]:offsets[i + 1]], hashes[cuts[i]:cuts[i + 1]])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray,
                            cost: np.ndarray, size: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model over sparse rows of unit length (plus a bias)."""
    weight, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(1)
    norm = np.array([v @ v + 1 for v in values])
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            gradient = signs[i] * (weight[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                alpha[i] = new
                weight[rows[i]] += step * values[i]
                bias += step
    return weight, bias


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve by Newton's method, with Platt's smoothed targets."""
    good, bad = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x, at = np.stack([margins, np.ones_like(margins)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (at - [1.0, 0.0]))
        at = at - step
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def fit_rows(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """With rows of one class only, or none, the model gives every text the share of good rows."""
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        share = min(max(share, 0.01), 0.99)
        flat = np.zeros(DIMENSIONS, np.float32)
        return Model(flat, flat, 0.0, (1.0, float(np.log(share / (1 - share)))))
    counts = [np.full(DIMENSIONS, SMOOTHING) for _ in (0, 1)]
    for row, label in zip(rows, labels, strict=True):
        counts[label][row] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())

    def scaled(row):
        values = ratio[row]
        return values / max(np.sqrt(values @ values), 1e-9)

    values = [scaled(row) for row in rows]
    aside = np.arange(len(rows)) % 5 == 0
    if any(len(set(labels[part].tolist())) < 2 for part in (aside, ~aside)):
        aside = np.zeros(len(rows), bool)
    inside = np.flatnonzero(~aside)
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.bincount(labels[inside], minlength=2) / len(inside)
    cost = COST / (2 * share[labels])
    pick = lambda x: [x[i] for i in inside]
    weight, bias = dual_coordinate_descent(pick(rows), pick(values), signs[inside], cost[inside], DIMENSIONS)
    used = np.flatnonzero(aside) if aside.any() else np.arange(len(rows))
    margins = np.array([weight[rows[i]] @ values[i] + bias for i in used])
    return Model(ratio.astype(np.float32), weight.astype(np.float32), float(bias), _curve(margins, labels[used]))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
        label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most max_rows labelled ids (label 0 or 1; others do not count).

    The sample is broadcast (its size is bounded), so only its texts move; rows of one id and label
    count once, and the features meet in one task. Null texts count as empty."""
    chosen = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
              .select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id", "label").limit(max_rows))
    sample = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
              .join(F.broadcast(chosen), "id").select("id", "label", "text").dropDuplicates(["id", "label"]))

    def featured(batches):
        for batch in batches:
            rows = [x.astype(np.int32) for x in indicators(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int32()),
                 pa.array(rows, pa.list_(pa.int32()))], ["id", "label", "places"])

    def fitted(batches):
        rows, labels_ = [], []
        for batch in batches:
            rows += [x.values.to_numpy().astype(np.int64) for x in batch.column(2)]
            labels_ += batch.column(1).to_pylist()
        model = fit_rows(rows, np.array(labels_, np.int64))
        out = io.BytesIO()
        np.savez(out, ratio=model.ratio, weight=model.weight, rest=[model.bias, *model.curve])
        yield pa.RecordBatch.from_pydict({"model": [out.getvalue()]})

    # A fixed order of rows, so that the same sample gives the same model.
    rows = sample.mapInArrow(featured, "id bigint, label int, places array<int>")
    saved = (rows.repartition(1).sortWithinPartitions("id", "label")
             .mapInArrow(fitted, "model binary").first())
    if saved is None:
        return fit_rows([], np.zeros(0, np.int64))
    parts = np.load(io.BytesIO(bytes(saved[0])))
    bias, slope, shift = parts["rest"]
    return Model(parts["ratio"], parts["weight"], float(bias), (float(slope), float(shift)))


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """docs with the probability of good quality in a column (replaced if there is one of that name).

    Null and empty texts get the probability of a text without features. Equal texts score equally."""
    from pyspark.sql.types import DoubleType, StructField, StructType
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.ratio, (model.ratio.astype(np.float64) * model.weight).astype(np.float32), model.bias, model.curve))
    kept = [c for c in docs.columns if c != column]
    place = kept.index(text)

    def scored(batches):
        ratio, product, bias, curve = shared.value
        squares = ratio.astype(np.float64) ** 2
        for batch in batches:
            margins = np.array([product[x].sum(dtype=np.float64) / max(np.sqrt(squares[x].sum()), 1e-9) + bias
                                for x in indicators(batch.column(place))])
            chance = 1 / (1 + np.exp(-np.clip(curve[0] * margins + curve[1], -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chance, pa.float64())],
                                             [*batch.schema.names, column])

    schema = StructType([*docs.select(*kept).schema.fields, StructField(column, DoubleType())])
    return docs.select(*kept).mapInArrow(scored, schema)
