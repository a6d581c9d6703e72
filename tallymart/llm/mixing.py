"""Mixing sources to target weights, block by block.

The words of each source are laid end to end, documents in the order of a hash, and
packed into blocks of a fixed number of words (a source's last block may be shorter).
A source's quota is the number of blocks that comes nearest to its target. The mixture
is dealt to output shards of a fixed number of slots: every shard draws its
source counts from a multinomial distribution over what is left of the quotas, so the
quotas are used up exactly. A source's n-th slot
takes the block that a pseudorandom permutation of its block numbers puts at
place n; when all blocks are used, the next round has another permutation. Slots and
blocks are then joined by source and block number.

A quota is at most three times a source's blocks, so no block, and no document, is
taken more than three times. All draws are seeded; repeated runs agree.

Defined results: a NULL text has no words; documents without words are taken 0 times;
a NULL source is a source of its own, sorted last; repeated rows are numbered, dealt to buckets
like other documents, and packed one by one. A very long text reaches into many blocks
and is cut where they end. An empty table gives an empty mixture; without any words all
targets are 0. Columns beside those of documents do not change the mixture.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.tables import kept_table

# Words: runs of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
# What a row of documents consists of; other columns are not looked at.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 128
SHARD_SLOTS = 256
# Sources are a dimension: their sizes and weights are known to the driver.
MAX_SOURCES = 100_000
# Documents that are put in order together, on average.
ROWS_PER_BUCKET = 5_000
# Groups of shards that draw their counts at the driver; each group's shards draw in a task.
# The numbers drawn there, one per group and source, are bounded too.
MAX_SHARD_GROUPS, MAX_DRAWN = 1024, 4_000_000
SEED = 20_240_331


@dataclass(frozen=True)
class Source:
    """A source's place in the order of sources, its words, its target and its quota of blocks."""

    name: str | None
    size: int
    target: float
    blocks: int
    quota: int


def share_targets(sizes: Sequence[int], weights: Sequence[float], most: int = MOST_REPEATS) -> list[float]:
    """Targets in proportion to the weights, none above ``most`` times its source's size.

    What a source cannot take is shared again by weight among those that can.
    """
    total = sum(sizes)
    targets = [0.0] * len(sizes)
    open_, left = [i for i, size in enumerate(sizes)], float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = float(most * sizes[i])
        left -= sum(targets[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def plan_sources(sizes: DataFrame, block_words: int = BLOCK_WORDS) -> list[Source]:
    """The sources in code point order, NULL last, from a table of ``source`` and ``source_size``."""
    found = sizes.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    known = sorted(((row["source"], row["source_size"]) for row in found), key=lambda x: (x[0] is None, x[0] or ""))
    weights = [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(known))]
    targets = share_targets([size for _, size in known], weights)
    planned = []
    for (name, size), target in zip(known, targets, strict=True):
        blocks = math.ceil(size / block_words)
        # Rounded down at a half, so a full target never takes more than three times the blocks.
        quota = min(math.ceil(target / size * blocks - 0.5), MOST_REPEATS * blocks) if size else 0
        planned.append(Source(name, size, target, blocks, quota))
    return planned


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source and size of every document, a digest of all its columns, and a number for each of equal rows."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD))
    columns = [F.col(name) for name in DOCUMENT_COLUMNS if name in docs.columns]
    rows = docs.select("doc_id", "source", words.cast("long").alias("size"), F.xxhash64(*columns).alias("digest"))
    # Equal rows are counted before they are numbered, so none of them are gathered.
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    return counted.select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))


def sources_frame(sizes: DataFrame, planned: Sequence[Source]) -> DataFrame:
    """The plan as a table: ``source_number``, ``source``, ``source_size``, ``target``."""
    rows = [(i, s.name, s.size, s.target) for i, s in enumerate(planned)]
    return sizes.sparkSession.createDataFrame(
        rows, "source_number int, source string, source_size long, target double"
    )


def laid_out(sizes: DataFrame, planned: Sequence[Source]) -> DataFrame:
    """Every document with its source's numbers and ``first_word``, its place among the source's words.

    A source may hold a third of all rows, so its documents are dealt to hash buckets,
    put in order within them, and shifted by the sizes of the buckets before.
    """
    buckets = 1 + sizes.count() // ROWS_PER_BUCKET
    sources = F.broadcast(sources_frame(sizes, planned))
    bucket = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "digest", "copy"), F.lit(buckets))
    rows = (
        sizes.join(sources, sizes["source"].eqNullSafe(sources["source"]))
        .drop(sources["source"])
        .withColumn("bucket", bucket)
    )
    # At most a row per source and bucket, so the shifts are far smaller than the documents.
    before = Window.partitionBy("source_number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        rows.groupBy("source_number", "bucket")
        .agg(F.sum("size").alias("in_bucket"))
        .select("source_number", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("shift"))
    )
    within = (
        Window.partitionBy("source_number", "bucket")
        .orderBy("doc_id", "digest", "copy")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("place", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(shifts, ["source_number", "bucket"])
        .withColumn("first_word", F.col("place") + F.col("shift"))
        .drop("bucket", "place", "shift")
    )


def block_pieces(places: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and block it reaches into: ``block``, ``from_word`` and ``n_words`` of the document."""
    end = F.col("first_word") + F.col("size")
    first = F.floor(F.col("first_word") / F.lit(block_words))
    last = F.floor((end - 1) / F.lit(block_words))
    begin = F.greatest(F.col("first_word"), F.col("block") * block_words)
    stop = F.least(end, (F.col("block") + 1) * block_words)
    return (
        places.filter(F.col("size") > 0)
        .withColumn("block", F.explode(F.sequence(first, last)))
        .withColumn("from_word", begin - F.col("first_word"))
        .withColumn("n_words", stop - begin)
    )


def deal_counts(rng: np.random.Generator, left: np.ndarray, slots: int) -> np.ndarray:
    """How many of the next ``slots`` slots go to each source.

    A multinomial draw in proportion to what is left of the quotas; draws beyond a quota
    are drawn again, so the last slots use up what is left.
    """
    counts = np.zeros_like(left)
    missing = min(slots, int(left.sum()))
    while missing:
        rest = left - counts
        counts = np.minimum(counts + rng.multinomial(missing, rest / rest.sum()), left)
        missing = min(slots, int(left.sum())) - int(counts.sum())
    return counts


def permuted(places: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The images of places under a pseudorandom permutation of ``range(size)``.

    A four-round Feistel network on the next even power of two; results outside the
    range are sent through again until they fall inside.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng([SEED, seed % 2**32, seed >> 32]).integers(1, 2**63, 4, dtype=np.uint64) | np.uint64(1)
    out = places.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        high, low = out[todo] >> np.uint64(half), out[todo] & mask
        for key in keys:
            mixed = (low + key) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= key
            high, low = low, high ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (high << np.uint64(half)) | low
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def dealt_slots(
    spark, planned: Sequence[Source], shard_slots: int = SHARD_SLOTS, seed: int = SEED
) -> DataFrame:
    """The mixture as slots: ``shard``, ``slot``, ``source_number``, ``round`` and ``block``.

    The driver draws the counts of at most ``MAX_SHARD_GROUPS`` groups of shards; shards
    draw their own counts from their group's, in tasks.
    """
    quotas = np.array([s.quota for s in planned], np.int64)
    blocks = np.array([max(1, s.blocks) for s in planned], np.int64)
    shards = math.ceil(int(quotas.sum()) / shard_slots)
    most_groups = max(1, min(MAX_SHARD_GROUPS, MAX_DRAWN // max(1, len(planned))))
    per_group = max(1, math.ceil(shards / most_groups))
    groups, left = [], quotas.copy()
    rng = np.random.default_rng(seed)
    for group in range(math.ceil(shards / per_group)):
        drawn = deal_counts(rng, left, per_group * shard_slots)
        groups.append((group, (quotas - left).tolist(), drawn.tolist()))
        left -= drawn

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                used, remaining = np.array(row.used, np.int64), np.array(row.drawn, np.int64)
                draw = np.random.default_rng([seed, row.group])
                shard = row.group * per_group
                while remaining.sum():
                    counts = deal_counts(draw, remaining, shard_slots)
                    numbers = np.repeat(np.arange(len(counts)), counts)
                    ordinal = np.arange(len(numbers)) - np.repeat(np.cumsum(counts) - counts, counts)
                    ordinal += used[numbers]
                    round_, place = ordinal // blocks[numbers], ordinal % blocks[numbers]
                    block = np.empty_like(place)
                    for key in np.unique(numbers * (MOST_REPEATS + 1) + round_):
                        mine = numbers * (MOST_REPEATS + 1) + round_ == key
                        block[mine] = permuted(place[mine], int(blocks[numbers[mine][0]]), int(key))
                    yield pd.DataFrame(
                        {
                            "shard": shard,
                            "slot": draw.permutation(len(numbers)),
                            "source_number": numbers.astype(np.int32),
                            "round": round_,
                            "block": block,
                        }
                    )
                    used, remaining, shard = used + counts, remaining - counts, shard + 1

    schema = "shard long, slot long, source_number int, round long, block long"
    if not groups:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame(groups, "group long, used array<long>, drawn array<long>")
    parts = min(len(groups), 4 * spark.sparkContext.defaultParallelism)
    return listed.repartition(parts, "group").mapInPandas(deal, schema)


@dataclass(frozen=True)
class Mixture:
    """``documents`` have their sizes, targets and places; ``spans`` are the words that each slot holds."""

    documents: DataFrame
    spans: DataFrame


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> Mixture:
    """Mix the sources of ``docs`` to their target weights.

    Sizes are written to the shared folder, as the plan and the packing both need them.
    """
    sizes = kept_table(measured(docs), "mix-sizes")
    planned = plan_sources(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), block_words)
    places = kept_table(laid_out(sizes, planned), "mix-places")
    slots = dealt_slots(docs.sparkSession, planned, shard_slots, seed)
    # Equal keys are a block's pieces times its at most three slots. Slots grow with the
    # data, though Spark takes them for as small as the plan they are made from.
    spans = block_pieces(places, block_words).join(slots.hint("merge"), ["source_number", "block"])
    return Mixture(places, spans)


def taken_words(mixture: Mixture) -> DataFrame:
    """Per document: size, its source's size and target, and how many words the mixture takes of it."""
    # A document is known by its place; documents without words share places and take nothing.
    key = ["source_number", "first_word"]
    taken = mixture.spans.groupBy(*key).agg(F.sum("n_words").alias("taken"))
    with_words = mixture.documents.filter(F.col("size") > 0).join(taken, key, "left")
    columns = ["doc_id", "size", "source_size", "target"]
    counted = with_words.select(*columns, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    empty = mixture.documents.filter(F.col("size") == 0)
    return counted.unionByName(empty.select(*columns, F.lit(0).cast("long").alias("taken")))


def cut_words(text: str, from_words: Sequence[int], n_words: Sequence[int]) -> list[str]:
    """Runs of words with the white space behind them; what stands before the first word belongs to it."""
    begins = [m.start() for m in re.finditer(WORD, text)]
    begins[:1] = [0] * len(begins[:1])
    begins.append(len(text))
    return [text[begins[a] : begins[a + n]] for a, n in zip(from_words, n_words, strict=True)]


def mixed_texts(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """The mixture as documents: one row per span a slot holds of a document, with the span's
    text and length in place of the document's, and the columns ``shard`` and ``slot``. Further
    columns of a document are in the struct ``others``; equal documents have those of any of them.

    The spans of one row meet its text together. Rows that are equal in all columns have their
    text in common, and each has its own spans, so many of them are no large group.
    """
    key = ["doc_id", "digest"]
    listed = mixture.spans.groupBy(*key, "copy").agg(
        F.collect_list(F.struct("shard", "slot", F.col("from_word").alias("from"), F.col("n_words").alias("n"))).alias(
            "held"
        )
    )
    columns = [F.col(name) for name in DOCUMENT_COLUMNS]
    others = [F.col(f"`{name}`") for name in docs.columns if name not in DOCUMENT_COLUMNS]
    others = F.struct(*others) if others else F.lit(None).cast("struct<>")
    first = docs.select(*columns, others.alias("others"), F.xxhash64(*columns).alias("digest")).dropDuplicates(key)
    same = F.col("l.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("l.digest") == F.col("d.digest"))
    rows = first.alias("d").join(listed.alias("l"), same).select(
        *(F.col(f"d.{name}") for name in DOCUMENT_COLUMNS), "d.others", "l.held"
    )
    spans = (F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("slot"))
    schema = rows.select(*DOCUMENT_COLUMNS, "others", *spans).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                held = row.column("held")[0].as_py()
                texts = cut_words(
                    row.column("text")[0].as_py() or "", [s["from"] for s in held], [s["n"] for s in held]
                )
                made = {
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array(list(map(len, texts)), pa.int64()),
                    "shard": pa.array([s["shard"] for s in held], pa.int64()),
                    "slot": pa.array([s["slot"] for s in held], pa.int64()),
                }
                repeated = pa.array(np.zeros(len(texts), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [made[f.name] if f.name in made else row.column(f.name).take(repeated) for f in schema.fields],
                    names=schema.names,
                )

    return rows.mapInArrow(cut, schema)
