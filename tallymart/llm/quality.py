"""Quality classifier by nearest-neighbour voting among latent-semantic vectors.

A text's terms are hashed runs of three bytes, once by their shape (capital, small
letter, digit, each punctuation mark as itself) and once by their lower-case letters.
Terms are weighted by log frequency and inverse document frequency; beside them stand the
shares of words that repeat others, lack letters, shout or pile up marks. Both are projected to
the leading singular directions of the labelled documents. The labelled vectors are
broadcast: there are at most ``PER_LABEL`` per label, so their size is bounded. Every
document's cosines with all of them are computed in blocks, and the nearest ones
vote for their label, weighted by similarity.

The model is fitted on a sample: for each label the ``PER_LABEL`` labelled documents
with the smallest hash of their id. Everything else covers all documents and whole texts.

Defined results: a NULL text counts as the empty text; a text without any term, or
without a similar labelled text, scores the mean of the labels' scores, and 0.5 if
nothing is labelled. Labels that are NULL are not learned; of several labels of one
document the largest counts. Repeated rows score alike. A very long text is counted whole, in a
block of its own. An empty table gives no rows. Extra columns are dropped by ``score``
and kept by ``accepted``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm import words
from tallymart.llm.tables import fold_number, packed, sample_per_value

FOLDS, HELD_OUT_FOLD = 5, 0
PER_LABEL = 1000
NEIGHBOURS = 11
DIMENSIONS = 64
# Half of the terms are shapes, half are letters.
TERMS = 4096
# Four shares of words, and their complements.
STYLES = 4
THRESHOLD = 0.3
# Similarities are raised to this power before they weigh a vote.
SHARPNESS = 12
# Texts whose terms are counted together: bytes, unless one text is longer, and rows of counts.
BYTES_PER_BLOCK = 1_000_000
TEXTS_PER_BLOCK = 512

SHAPES = np.zeros(256, np.uint32)
for _byte in range(256):
    _char = chr(_byte)
    if _byte >= 0x80 or _char.islower():
        SHAPES[_byte] = 1
    elif _char.isupper():
        SHAPES[_byte] = 2
    elif _char.isdigit():
        SHAPES[_byte] = 3
    else:
        SHAPES[_byte] = 4 + _byte
LOWER = np.arange(256, dtype=np.uint32)
LOWER[ord("A") : ord("Z") + 1] += 32


def term_counts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of the hashed terms of each text, then its style; texts lie end to end in ``data``."""
    counts = np.zeros((len(ends), TERMS + 2 * STYLES), np.float32)
    half = TERMS // 2
    hashed = []
    for codes, factor in ((SHAPES[data], 0x9E3779B1), (LOWER[data], 0x85EBCA6B)):
        first, second, third = codes[: max(0, len(codes) - 2)], codes[1:-1], codes[2:]
        mixed = (first * np.uint32(65_599) + second) * np.uint32(65_599) + third
        mixed *= np.uint32(factor)
        hashed.append((mixed >> np.uint32(15)) % np.uint32(half))
    start = 0
    for row, end in enumerate(ends.tolist()):
        stop = max(start, end - 2)
        counts[row, :half] = np.bincount(hashed[0][start:stop], minlength=half)
        counts[row, half:TERMS] = np.bincount(hashed[1][start:stop], minlength=half)
        start = end
    counts[:, TERMS:] = word_styles(data, ends)
    return counts


def text_blocks(column: pa.Array, most: int = BYTES_PER_BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and ends of successive texts of at most ``most`` bytes together, or of one text; NULL is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(column), first + TEXTS_PER_BLOCK)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first + 1 : last + 1] - offsets[first]
        first = last


def word_styles(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Shares of each text's words that repeat one of the three words before, that have no letter or
    digit, that have several capitals, and that have several punctuation marks, next to the shares that don't."""
    styles = np.zeros((len(ends), 2 * STYLES), np.float32)
    starts = words.word_starts(words.PRINTED_BYTES[data], ends)
    if not len(starts):
        return styles
    hashes, owner = words.word_hashes(words.PRINTED_BYTES[data], starts), words.owners(starts, ends)
    repeats = np.zeros(len(starts), bool)
    for lag in (1, 2, 3):
        repeats[lag:] |= (hashes[lag:] == hashes[:-lag]) & (owner[lag:] == owner[:-lag])
    shape = SHAPES[data]
    sums = [np.add.reduceat(kind.astype(np.int32), starts) for kind in ((shape > 0) & (shape < 4), shape == 2, shape > 4 + 0x20)]
    total = np.bincount(owner, minlength=len(ends))
    for k, found in enumerate((repeats, sums[0] == 0, sums[1] > 1, sums[2] > 1)):
        share = np.bincount(owner, weights=found, minlength=len(ends)) / np.maximum(total, 1)
        styles[:, 2 * k], styles[:, 2 * k + 1] = np.sqrt(share), np.sqrt(1 - share)
    styles[total == 0] = 0
    return styles


def unit_rows(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def weighted_terms(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of terms and of style, side by side."""
    terms = unit_rows(np.log1p(counts[:, :TERMS]) * idf)
    return np.concatenate([terms, unit_rows(counts[:, TERMS:])], axis=1)


@dataclass
class Model:
    """What a task needs to score texts; its size is bounded by the parameters above."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit_rows(weighted_terms(counts, self.idf) @ self.directions)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Weighted votes of the nearest labelled vectors, for a block of documents."""
        n = len(self.labels)
        prior = np.full(len(counts), self.labels.mean() if n else 0.5)
        if not n:
            return prior
        cosines = self.project(counts) @ self.vectors.T
        nearest = min(NEIGHBOURS, n)
        if nearest < n:
            # The nearest by cosine; of equal cosines any, as they weigh the same, in a stable order.
            chosen = np.argpartition(-cosines, nearest - 1, axis=1)[:, :nearest]
        else:
            chosen = np.broadcast_to(np.arange(n), (len(counts), n))
        weights = np.maximum(np.take_along_axis(cosines, chosen, axis=1).astype(np.float64), 0) ** SHARPNESS
        total = weights.sum(axis=1)
        votes = (weights * self.labels[chosen]).sum(axis=1)
        return np.clip(np.divide(votes, total, out=prior, where=total > 0), 0, 1)


def fit(counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """Latent directions of the labelled documents by a randomized singular value decomposition."""
    documents = max(1, len(counts))
    idf = np.log((1 + documents) / (1 + (counts[:, :TERMS] > 0).sum(axis=0))).astype(np.float32) + 1
    weighted = weighted_terms(counts, idf)
    size = min(dimensions, *weighted.shape) if len(counts) else 1
    rng = np.random.default_rng(7)
    basis = rng.standard_normal((counts.shape[1], size + 10)).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
    _, _, right = np.linalg.svd(weighted @ basis, full_matrices=False)
    directions = np.ascontiguousarray((basis @ right[:size].T).astype(np.float32))
    model = Model(idf, directions, np.zeros((0, size), np.float32), np.asarray(labels, np.float64))
    model.vectors = model.project(counts) if len(counts) else model.vectors
    return model


def counted(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns and the non-zero terms of each text, as numbers and counts."""
    schema = rows.select(
        *keep, F.lit(None).cast("array<int>").alias("terms"), F.lit(None).cast("array<float>").alias("counts")
    ).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, ends in text_blocks(batch.column("text")):
                counts = term_counts(data, ends)
                present = [np.flatnonzero(row).astype(np.int32) for row in counts]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(name).slice(first, last - first) for name in keep),
                        pa.array(present, pa.list_(pa.int32())),
                        pa.array([row[t] for row, t in zip(counts, present, strict=True)], pa.list_(pa.float32())),
                    ],
                    names=[*keep, "terms", "counts"],
                )

    return rows.select(*keep, "text").mapInArrow(count, schema)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None) -> Model:
    """Fit on a bounded sample of the labelled documents that may be learned from."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if learn is not None:
        known = known.filter(learn)
    known = known.groupBy("doc_id").agg(F.max(label).alias("_label"))
    # Labels of documents that are not there are left out before the sample is taken.
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    sample = sample_per_value(known, "doc_id", "_label", PER_LABEL)
    # The sample has a bounded number of ids and is broadcast; the texts stay where they are.
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    # Repeated rows of one document count once, by the smallest of their texts, and never reach the driver.
    rows = rows.groupBy("doc_id", "_label").agg(F.min("text").alias("text"))
    found = counted(rows, ["doc_id", "_label"]).toArrow().sort_by([("doc_id", "ascending")])
    counts = np.zeros((found.num_rows, TERMS + 2 * STYLES), np.float32)
    for row, (terms, values) in enumerate(zip(found.column("terms"), found.column("counts"), strict=True)):
        counts[row, np.asarray(terms.values)] = np.asarray(values.values)
    return fit(counts, found.column("_label").to_numpy().astype(np.float64))


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``score`` of every document: 0 to 1, higher where label 1 is likelier."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = rows.select(*keep, F.lit(0.0).alias("score")).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, ends in text_blocks(batch.column("_text")):
                values = pa.array(shared.value.scores(term_counts(data, ends)), pa.float64())
                kept = [batch.column(name).slice(first, last - first) for name in keep]
                yield pa.RecordBatch.from_arrays([*kept, values], names=[*keep, "score"])

    return rows.mapInArrow(scored, schema)


def held_out(key: str = "doc_id") -> Column:
    return fold_number(key, FOLDS) == HELD_OUT_FOLD


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's score and prediction, by a model that has not seen the held-out fold."""
    model = train(docs, labels, learn=~held_out())
    scored = score(docs, model)
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    model = train(docs, labels, learn=~held_out())
    return score(packed(docs), model, keep=("row",)).filter(F.col("score") >= THRESHOLD).select("row.*")
