"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of WINDOW bytes, all of them. In each window one recurrent pass runs
forward and one backward; both states label every byte with a probability per language, and the
document's probabilities are the mean over its bytes. The network is trained in numpy by
backpropagation through time on a bounded sample of labelled rows, in one task; scoring is one pass
without a shuffle, with many windows at a time.

Arrays keep features first and windows last, so that every operation runs over long rows.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ratings_engine.llm.text import raw

WINDOW = 64
HIDDEN = 8
#: Byte values and the filling of a text's last window.
SYMBOLS, FILL = 257, 256
MAX_ROWS = 3000
WINDOWS_PER_ROW = 4
EPOCHS = 12
BATCH = 256
RATE = 0.01
#: Windows scored at a time.
WIDTH = 2048
UNKNOWN = "und"


@dataclass
class Model:
    """weights: per direction input (3H x 257) and recurrent (3H x H); output (L x 2H), shift (L x 1)."""

    languages: list[str]
    weights: list[np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _step(inputs, recurrent, symbols, state, buffer):
    """One step of a direction: (new state, gates, candidate, recurrent part of the candidate)."""
    h = state.shape[0]
    np.take(inputs, symbols, axis=1, out=buffer, mode="clip")
    inner = recurrent @ state
    gates = _sigmoid(buffer[:2 * h] + inner[:2 * h])
    part = inner[2 * h:]
    candidate = gates[:h] * part
    candidate += buffer[2 * h:]
    np.tanh(candidate, out=candidate)
    new = state - candidate
    new *= gates[h:]
    new += candidate
    return new, gates, candidate, part


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(0)
    np.exp(x, out=x)
    x /= x.sum(0)
    return x


def _gradients(weights, symbols, targets, mask):
    """Gradients of the mean cross-entropy over all unmasked positions of a batch (T x B)."""
    steps, width = symbols.shape
    output, shift = weights[4:]
    h = weights[1].shape[1]
    states, kept = [], []
    for direction in (0, 1):
        inputs, recurrent = weights[2 * direction:2 * direction + 2]
        state, run, trace = np.zeros((h, width), np.float32), {}, []
        for t in (range(steps) if direction == 0 else range(steps - 1, -1, -1)):
            before = state
            state, gates, candidate, part = _step(inputs, recurrent, symbols[t], state,
                                                  np.empty((3 * h, width), np.float32))
            run[t] = state
            trace.append((t, before, gates, candidate, part))
        states.append(run)
        kept.append(trace)
    grads = [np.zeros_like(w) for w in weights]
    total, down, loss = mask.sum(), [{}, {}], 0.0
    for t in range(steps):
        both = np.concatenate([states[0][t], states[1][t]])
        chance = _softmax(output @ both + shift)
        loss -= (np.log(np.maximum(chance[targets, np.arange(width)], 1e-9)) * mask[t]).sum()
        chance[targets, np.arange(width)] -= 1
        chance *= mask[t] / total
        grads[4] += chance @ both.T
        grads[5] += chance.sum(1, keepdims=True)
        back = output.T @ chance
        down[0][t], down[1][t] = back[:h], back[h:]
    for direction in (0, 1):
        recurrent = weights[2 * direction + 1]
        carry = np.zeros((h, width), np.float32)
        for t, before, gates, candidate, part in reversed(kept[direction]):
            carry = carry + down[direction][t]
            reset, update = gates[:h], gates[h:]
            of_candidate = carry * (1 - update) * (1 - candidate ** 2)
            of_update = carry * (before - candidate) * update * (1 - update)
            of_reset = of_candidate * part * reset * (1 - reset)
            through = np.concatenate([of_reset, of_update, of_candidate * reset])
            one_hot = np.zeros((width, SYMBOLS), np.float32)
            one_hot[np.arange(width), symbols[t]] = 1
            grads[2 * direction] += np.concatenate([of_reset, of_update, of_candidate]) @ one_hot
            grads[2 * direction + 1] += through @ before.T
            carry = carry * update + recurrent.T @ through
    return grads, loss / total


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text number) of the windows of all texts."""
    sizes = np.diff(offsets)
    each = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), each)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    starts = offsets[owner] + number * WINDOW
    return starts, np.minimum(WINDOW, offsets[owner + 1] - starts), owner


def _symbols(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(T x B symbols, T x B mask)."""
    steps = np.arange(WINDOW)[:, None]
    mask = steps < lengths[None, :]
    at = np.minimum(starts[None, :] + steps, max(len(data) - 1, 0))
    return np.where(mask, data[at], FILL).astype(np.intp), mask


def train(texts: pa.Array, labels: list[str], epochs: int = EPOCHS) -> Model:
    """Fit on evenly spread windows of the given texts. Without texts the model knows no language."""
    languages = sorted(set(labels))
    data, offsets = raw(texts)
    starts, lengths, owner = _windows(data, offsets)
    first = np.searchsorted(owner, np.arange(len(texts)))
    count = np.bincount(owner, minlength=len(texts))
    chosen = np.unique(np.concatenate([
        first[count > 0] + (count[count > 0] - 1) * k // max(WINDOWS_PER_ROW - 1, 1)
        for k in range(WINDOWS_PER_ROW)] or [np.zeros(0, np.int64)])).astype(np.int64)
    rng = np.random.default_rng(7)
    small = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
    weights = [small(3 * HIDDEN, SYMBOLS), small(3 * HIDDEN, HIDDEN), small(3 * HIDDEN, SYMBOLS),
               small(3 * HIDDEN, HIDDEN), small(len(languages), 2 * HIDDEN),
               np.zeros((len(languages), 1), np.float32)]
    if len(languages) < 2 or not len(chosen):
        return Model(languages, weights)
    target = np.searchsorted(np.array(languages), np.array(labels))[owner]
    first_moment = [np.zeros_like(w) for w in weights]
    second_moment = [np.zeros_like(w) for w in weights]
    step, steps = 0, max(1, epochs * -(-len(chosen) // BATCH))
    for _ in range(epochs):
        order = rng.permutation(chosen)
        for low in range(0, len(order), BATCH):
            pick = order[low:low + BATCH]
            symbols, mask = _symbols(data, starts[pick], lengths[pick])
            grads, _ = _gradients(weights, symbols, target[pick], mask)
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            norm = np.sqrt(sum((g ** 2).sum() for g in grads))
            for k, g in enumerate(grads):
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * g
                second_moment[k] = 0.99 * second_moment[k] + 0.01 * g ** 2
                weights[k] = (weights[k] - rate * (first_moment[k] / (1 - 0.9 ** step))
                              / (np.sqrt(second_moment[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return Model(languages, weights)


def _label(model_weights, symbols: np.ndarray):
    """Probabilities (L x B) of each position, last position first."""
    forward_in, forward, backward_in, backward, output, shift = model_weights
    h, width = forward.shape[1], symbols.shape[1]
    buffer = np.empty((3 * h, width), np.float32)
    ahead = np.empty((len(symbols), h, width), np.float32)
    state = np.zeros((h, width), np.float32)
    for t in range(len(symbols)):
        state = _step(forward_in, forward, symbols[t], state, buffer)[0]
        ahead[t] = state
    state = np.zeros((h, width), np.float32)
    of_ahead, of_back = np.ascontiguousarray(output[:, :h]), np.ascontiguousarray(output[:, h:])
    for t in range(len(symbols) - 1, -1, -1):
        state = _step(backward_in, backward, symbols[t], state, buffer)[0]
        yield t, _softmax(of_ahead @ ahead[t] + of_back @ state + shift)


def pooled(model: Model, texts: pa.Array) -> np.ndarray:
    """Mean probabilities over all bytes of each text (texts x languages); 0 for empty texts."""
    data, offsets = raw(texts)
    starts, lengths, owner = _windows(data, offsets)
    sums = np.zeros((len(texts), len(model.languages)))
    for low in range(0, len(starts), WIDTH):
        part = slice(low, low + WIDTH)
        symbols, mask = _symbols(data, starts[part], lengths[part])
        total = np.zeros((len(model.languages), symbols.shape[1]), np.float32)
        for t, chance in _label(model.weights, symbols):
            chance *= mask[t]
            total += chance
        np.add.at(sums, owner[part], total.T)
    return sums / np.maximum(np.diff(offsets), 1)[:, None]


def positions(model: Model, text: str) -> list[str]:
    """The language of every byte of a text."""
    data, offsets = raw(pa.array([text]))
    starts, lengths, _ = _windows(data, offsets)
    symbols, mask = _symbols(data, starts, lengths)
    best = np.zeros(symbols.shape, np.int64)
    for t, chance in _label(model.weights, symbols):
        best[t] = chance.argmax(0)
    return [model.languages[k] for k in best.T[mask.T]]


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        max_rows: int = MAX_ROWS) -> Model:
    """Train on at most max_rows different rows with a language and a text: those of least hash.

    Only hashes are sorted; texts are read again below the largest chosen hash, equal rows once."""
    hashed = (rows.where(F.col(lang).isNotNull() & (F.length(text) > 0))
              .select(F.xxhash64(doc_id, text, lang).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")))
    most = hashed.select("id").distinct().orderBy("id").limit(max_rows).agg(F.max("id")).first()[0]
    sample = hashed.where(F.col("id") <= F.lit(most)).dropDuplicates(["id"])

    def trained(batches):
        texts, labels = [], []
        for batch in batches:
            texts += batch.column(1).to_pylist()
            labels += batch.column(2).to_pylist()
        model = train(pa.array(texts, pa.string()), labels)
        out = io.BytesIO()
        np.savez(out, languages=np.array(model.languages, "U"), **{f"w{k}": w for k, w in enumerate(model.weights)})
        yield pa.RecordBatch.from_pydict({"model": [out.getvalue()]})

    saved = sample.repartition(1).sortWithinPartitions("id", "lang").mapInArrow(trained, "model binary").first()
    if saved is None:
        return train(pa.array([], pa.string()), [])
    parts = np.load(io.BytesIO(bytes(saved[0])))
    return Model(parts["languages"].tolist(), [parts[f"w{k}"] for k in range(6)])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score, the mean probability of that language over the text's bytes.

    Texts that are null or hold no letter, and any text if the model knows no language, get 'und'
    and 0. Columns named lang_pred or score give way; equal texts get equal results."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    place = kept.index(text)

    def predicted(batches):
        known = Model(*shared.value)
        for batch in batches:
            letters = batch.column(len(kept)).to_numpy(zero_copy_only=False).astype(bool)
            if known.languages:
                chance = pooled(known, batch.column(place))
                best, score = chance.argmax(1), np.clip(chance.max(1), 0, 1)
                names = np.where(letters, np.array(known.languages, object)[best], UNKNOWN)
            else:
                names, score = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(names, pa.string()),
                 pa.array(np.where(names == UNKNOWN, 0.0, score), pa.float64())],
                [*batch.schema.names[:len(kept)], "lang_pred", "score"])

    schema = StructType([*docs.select(*kept).schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.select(*kept).withColumn("has letters", letters).mapInArrow(predicted, schema)
