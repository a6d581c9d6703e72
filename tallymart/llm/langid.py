"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of ``WINDOW`` bytes. In each window one recurrent network of
gated units runs forwards and one backwards; their states at a byte give the
probabilities of all languages at that byte. A document's probabilities are the mean
over all bytes of its whole text. The network is trained in numpy by
backpropagation through time on a bounded sample: for each language windows of the
``PER_LANGUAGE`` documents with the smallest hash of their id.

Defined results: a text that is NULL or has no letter is ``und`` with score 0; so is
every text if no language could be learned. Ties go to the language that sorts
first. Repeated rows are labelled alike. Documents without a language are not learned
from. A very long text is read whole, in a block of its own. An empty table gives no rows. Extra
columns are dropped, and kept by ``accepted``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.quality import text_blocks
from tallymart.llm.tables import fold_number, packed, sample_per_value

FOLDS, HELD_OUT_FOLD = 4, 2
UNDETERMINED = "und"
LETTER = r"\p{L}"
PER_LANGUAGE = 400
WINDOWS_PER_DOCUMENT = 2
# More languages than this are an error: the network's output and sample must stay bounded.
MAX_LANGUAGES = 256
WINDOW = 64
UNITS = 8
STEPS = 400
BATCH = 192
RATE = 0.02
# Documents whose language is less certain are rejected by ``accepted``.
LEAST_SCORE = 0.4
BYTES_PER_BLOCK = 2_000_000


@dataclass
class Network:
    """Weights of the two directions and of the output.

    ``inputs`` holds what a byte adds to the gates (update, reset, candidate; ``UNITS``
    each), ``recurrent`` what the state adds.
    """

    languages: list[str]
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.bias]


def sigmoid_inplace(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def new_network(languages: Sequence[str], units: int = UNITS, seed: int = 11) -> Network:
    rng = np.random.default_rng(seed)
    inputs = [rng.normal(0, 0.3, (3 * units, 256)).astype(np.float32) for _ in range(2)]
    recurrent = [rng.normal(0, units**-0.5, (3 * units, units)).astype(np.float32) for _ in range(2)]
    output = rng.normal(0, units**-0.5, (len(languages), 2 * units)).astype(np.float32)
    return Network(list(languages), inputs, recurrent, output, np.zeros((len(languages), 1), np.float32))


def run_direction(
    data: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray, backwards: bool, trace: list | None = None
) -> np.ndarray:
    """States of one direction: (time, units, windows), for bytes of (time, windows)."""
    steps, windows = data.shape
    units = recurrent.shape[1]
    states = np.empty((steps, units, windows), np.float32)
    state = np.zeros((units, windows), np.float32)
    for t in range(steps - 1, -1, -1) if backwards else range(steps):
        gates = np.take(inputs, data[t], axis=1)
        gates[: 2 * units] += recurrent[: 2 * units] @ state
        sigmoid_inplace(gates[: 2 * units])
        update, reset, candidate = gates[:units], gates[units : 2 * units], gates[2 * units :]
        gated = reset * state
        candidate += recurrent[2 * units :] @ gated
        np.tanh(candidate, out=candidate)
        before = state
        # (1 - update) * state + update * candidate
        state = candidate - before
        state *= update
        state += before
        states[t] = state
        if trace is not None:
            trace.append((t, before, update, reset, candidate, gated))
    return states


def position_probabilities(network: Network, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities (languages, time x windows) and the states they come from."""
    both = [run_direction(data, network.inputs[k], network.recurrent[k], bool(k)) for k in (0, 1)]
    units = network.recurrent[0].shape[1]
    states = np.concatenate([s.transpose(1, 0, 2).reshape(units, -1) for s in both])
    scores = network.output @ states
    scores += network.bias
    return softmax_inplace(scores), states


def softmax_inplace(scores: np.ndarray) -> np.ndarray:
    scores -= scores.max(axis=0)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=0)
    return scores


def back_through_time(
    d_states: np.ndarray, data: np.ndarray, recurrent: np.ndarray, trace: list
) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of a direction's input table and recurrent weights, from those of its states."""
    units, windows = recurrent.shape[1], data.shape[1]
    d_inputs, d_recurrent = np.zeros((3 * units, 256), np.float32), np.zeros_like(recurrent)
    d_state = np.zeros((units, windows), np.float32)
    one_hot_rows = np.arange(windows)
    for t, before, update, reset, candidate, gated in reversed(trace):
        d_state = d_state + d_states[t]
        d_candidate = d_state * update * (1 - candidate**2)
        d_update = d_state * (candidate - before) * update * (1 - update)
        d_gated = recurrent[2 * units :].T @ d_candidate
        d_reset = d_gated * before * reset * (1 - reset)
        d_gates = np.concatenate([d_update, d_reset])
        d_recurrent[: 2 * units] += d_gates @ before.T
        d_recurrent[2 * units :] += d_candidate @ gated.T
        one_hot = np.zeros((windows, 256), np.float32)
        one_hot[one_hot_rows, data[t]] = 1
        d_inputs += np.concatenate([d_gates, d_candidate]) @ one_hot
        d_state = d_state * (1 - update) + d_gated * reset + recurrent[: 2 * units].T @ d_gates
    return d_inputs, d_recurrent


def gradients(network: Network, data: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over the positions of the mask, and its gradients in the order of the parameters."""
    steps, windows = data.shape
    units = network.recurrent[0].shape[1]
    traces: list[list] = [[], []]
    both = [run_direction(data, network.inputs[k], network.recurrent[k], bool(k), traces[k]) for k in (0, 1)]
    states = np.concatenate([s.transpose(1, 0, 2).reshape(units, -1) for s in both])
    chances = softmax_inplace(network.output @ states + network.bias)
    target = np.tile(labels, steps)
    weight = (mask.reshape(-1) / max(1, mask.sum())).astype(np.float32)
    columns = np.arange(steps * windows)
    loss = float(-(np.log(chances[target, columns] + 1e-9) * weight).sum())
    chances[target, columns] -= 1
    chances *= weight
    d_states = (network.output.T @ chances).reshape(2, units, steps, windows).transpose(0, 2, 1, 3)
    back = [back_through_time(d_states[k], data, network.recurrent[k], traces[k]) for k in (0, 1)]
    return loss, [
        back[0][0], back[1][0], back[0][1], back[1][1],
        chances @ states.T, chances.sum(axis=1, keepdims=True),
    ]


def train_network(
    windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, languages: Sequence[str],
    steps: int = STEPS, seed: int = 11,
) -> Network:
    """Adam on batches with equally many windows of every language."""
    network = new_network(languages, seed=seed)
    rng = np.random.default_rng(seed)
    by_language = [np.flatnonzero(labels == k) for k in range(len(languages))]
    first = [np.zeros_like(p) for p in network.parameters()]
    second = [np.zeros_like(p) for p in network.parameters()]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(rows, max(1, BATCH // len(languages))) for rows in by_language])
        data = windows[chosen].T
        mask = np.arange(WINDOW)[:, None] < lengths[chosen]
        _, slopes = gradients(network, data, labels[chosen], mask)
        rate = RATE * (1 - (step - 1) / steps)
        for p, g, m, v in zip(network.parameters(), slopes, first, second, strict=True):
            np.clip(g, -1, 1, out=g)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def document_probabilities(network: Network, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(documents, languages): means over all bytes of each text; texts lie end to end in ``data``."""
    count = len(ends)
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    pieces = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(count), pieces)
    ordinal = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = starts[owner] + ordinal * WINDOW
    held = np.minimum(WINDOW, ends[owner] - begin)
    sums = np.zeros((count, len(network.languages)))
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    # Full windows run together; the last window of a text runs among those of its length.
    order = np.argsort(held, kind="stable")
    cuts = np.flatnonzero(np.diff(held[order])) + 1
    for group in np.split(order, cuts) if len(order) else []:
        size = int(held[group[0]])
        for part in range(0, len(group), 4096):
            rows = group[part : part + 4096]
            chances, _ = position_probabilities(network, padded[begin[rows] + np.arange(size)[:, None]])
            pooled = chances.reshape(len(network.languages), size, len(rows)).sum(axis=1, dtype=np.float64)
            np.add.at(sums, owner[rows], pooled.T)
    return np.divide(sums, lengths[:, None], out=sums, where=lengths[:, None] > 0)


def sampled_windows(rows: DataFrame) -> DataFrame:
    """The first window and one from the middle of each text, with its language."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text")), strict=True):
                raw = text.encode()
                for k in range(min(WINDOWS_PER_DOCUMENT, -(-len(raw) // WINDOW))):
                    start = k * len(raw) // WINDOWS_PER_DOCUMENT
                    found.append((doc_id, lang, k, raw[start : start + WINDOW]))
            if found:
                columns = zip(zip(*found, strict=True), (pa.string(), pa.string(), pa.int32(), pa.binary()), strict=True)
                names = ["doc_id", "lang", "k", "window"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

    return rows.select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text").mapInArrow(
        cut, "doc_id string, lang string, k int, window binary"
    )


def train(docs: DataFrame, learn: Column | None = None) -> Network | None:
    """Train on a bounded sample; None if there is no document to learn from."""
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    if learn is not None:
        known = known.filter(learn)
    known = known.filter(F.col("text").rlike(LETTER))
    languages = known.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return None
    names = sorted(row["lang"] for row in languages)
    sample = sample_per_value(known.select("doc_id", "lang").distinct(), "doc_id", "lang", PER_LANGUAGE)
    # The sample has a bounded number of ids and is broadcast; the texts stay where they are.
    rows = known.join(F.broadcast(sample), ["doc_id", "lang"])
    # Repeated rows of one document count once, by the smallest of their texts, and never reach the driver.
    found = sampled_windows(rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))).toArrow()
    found = found.sort_by([(name, "ascending") for name in ("lang", "doc_id", "k", "window")])
    raw = found.column("window").to_pylist()
    windows = np.zeros((len(raw), WINDOW), np.uint8)
    for row, piece in enumerate(raw):
        windows[row, : len(piece)] = np.frombuffer(piece, np.uint8)
    number = {name: k for k, name in enumerate(names)}
    labels = np.array([number[x] for x in found.column("lang").to_pylist()])
    return train_network(windows, np.array([len(x) for x in raw]), labels, names)


def identify(docs: DataFrame, network: Network | None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns with ``lang_pred`` and ``score``, over whole texts."""
    text = F.col("text").cast("string")
    lettered = F.coalesce(text.rlike(LETTER), F.lit(False))
    rows = docs.select(*keep, F.when(lettered, text).alias("_text"))
    schema = rows.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for first, last, data, ends in text_blocks(batch.column("_text"), BYTES_PER_BLOCK):
                kept = [batch.column(name).slice(first, last - first) for name in keep]
                predicted, scores = [UNDETERMINED] * (last - first), np.zeros(last - first)
                if net is not None:
                    chances = document_probabilities(net, data, ends)
                    # An empty row of the block is a text without letters.
                    some = np.diff(ends, prepend=0) > 0
                    best = chances.argmax(axis=1)
                    scores = np.where(some, np.clip(chances.max(axis=1), 0, 1), 0.0)
                    predicted = [net.languages[b] if s else UNDETERMINED for b, s in zip(best, some, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(predicted, pa.string()), pa.array(scores, pa.float64())],
                    names=[*keep, "lang_pred", "score"],
                )

    return rows.mapInArrow(identified, schema)


def held_out(key: str = "doc_id") -> Column:
    return fold_number(key, FOLDS) == HELD_OUT_FOLD


def predict(docs: DataFrame) -> DataFrame:
    """Every document's language, by a network that has not seen the held-out fold."""
    found = identify(docs, train(docs, learn=~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame) -> DataFrame:
    """The documents whose language is told with some certainty, with all their columns."""
    found = identify(packed(docs), train(docs, learn=~held_out()), keep=("row",))
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.filter(sure).select("row.*")
