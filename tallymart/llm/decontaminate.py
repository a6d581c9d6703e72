"""Benchmark decontamination by a distributed positional inverted index.

Texts lie end to end in segments of whole documents. A segment's postings, each of its
terms with all positions, are stored as one row of a table; every document is indexed, whole. The
index is built once and answers any number of benchmarks without the texts.

Searching takes windows: ``WINDOW`` consecutive words of a benchmark item, or all words of a
shorter one. In each segment a window's terms are put in order of the length of their
lists there. The list of the rarest, less its offset in the window, gives possible
starts; the next lists, less theirs, are intersected with it in turn, so common terms are only
looked up where all rarer ones agree. A window that lacks a term is dropped at once.
What is left are the exact phrases. With ``slop``, proximity matches are found as well: all words
in order with at most that many others between them.

Terms are 64-bit hashes of words. Windows are broadcast at most ``WINDOWS_PER_PASS`` at a time; of a
larger benchmark every part is searched for in a pass of its own over the index.

Defined results: a word is a run of letters A-Z in either case, digits and characters outside
ASCII. NULL and empty texts have no words, and items without words nothing to be found. No
match spans two documents. Rows that repeat a document are documents of their own; rows that repeat an
item id are parts of one item, and a NULL id counts as the empty one. Very long texts are a
segment of their own. Without documents there are no rows; without items none is contaminated.
Columns other than doc_id, item_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import words
from tallymart.llm.bpe import flat_ranges
from tallymart.llm.quality import text_blocks
from tallymart.llm.tables import kept_table
from tallymart.workspace import shared_folder

WINDOW = 10
WINDOWS_PER_PASS = 500_000
# Bytes of a segment's texts, and of a row group of the index: a reader holds one at a time.
BYTES_PER_SEGMENT = 256_000
INDEX_GROUP_BYTES = 8 << 20

INDEX = (
    "segment long, terms array<long>, ends array<int>, positions array<int>"
    ", firsts array<int>, n_words array<int>, doc_ids array<{}>"
)
SPANS = "array<struct<start: int, stop: int>>"
FOUND = "segment long, ordinal int, doc_id {}, n_words int, items array<long>, spans " + SPANS


def hashed_words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts that lie end to end, and the number of words of each text."""
    parts = words.WORD_BYTES[data]
    starts = words.word_starts(parts, ends)
    counts = np.bincount(words.owners(starts, ends), minlength=len(ends))
    return words.word_hashes(parts, starts).view(np.int64), counts


def postings(terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms, ends of their lists, positions, and the first position of each text.

    A position is left empty behind every text, so that no phrase runs on into the next.
    """
    firsts = np.cumsum(counts) - counts + np.arange(len(counts))
    positions = flat_ranges(firsts, counts)
    order = np.argsort(terms, kind="stable")
    terms = terms[order]
    new = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
    return terms[new], np.append(new[1:], len(terms))[: len(new)], positions[order], firsts


def list_of(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index of all documents: a row a segment, made in one pass without a shuffle."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = INDEX.format(kind)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id")
            for first, last, data, ends in text_blocks(batch.column("text"), BYTES_PER_SEGMENT):
                found, counts = hashed_words(data, ends)
                terms, list_ends, positions, firsts = postings(found, counts)
                numbers = (list_ends, positions, firsts, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        list_of(terms, pa.int64()),
                        *(list_of(x, pa.int32()) for x in numbers),
                        pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), ids.slice(first, last - first)),
                    ],
                    names=["segment", "terms", "ends", "positions", "firsts", "n_words", "doc_ids"],
                )
                number += 1

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(segments, schema)
    path = shared_folder(docs.sparkSession, "postings")
    rows.write.option("parquet.block.size", INDEX_GROUP_BYTES).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct ``item`` and ``terms``: the hashes of every window of every item, numbered by ``item``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, ends in text_blocks(batch.column("text"), BYTES_PER_SEGMENT):
                terms, counts = hashed_words(data, ends)
                windows = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
                starts = flat_ranges(np.cumsum(counts) - counts, windows)
                lengths = np.repeat(np.minimum(counts, size), windows)
                offsets = np.append(0, np.cumsum(lengths))
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(terms[flat_ranges(starts, lengths)], pa.int64())
                )
                owner = pa.array(np.repeat(np.arange(first, last), windows))
                yield pa.RecordBatch.from_arrays([batch.column("item").take(owner), lists], names=["item", "terms"])

    rows = items.select("item", "text").mapInArrow(cut, "item long, terms array<long>")
    return kept_table(rows.distinct(), "windows")


@dataclass
class Windows:
    """Windows of one pass, as term numbers; ``items`` holds those of window ``w`` from ``item_ends[w - 1]`` on."""

    vocabulary: np.ndarray
    terms: np.ndarray
    lengths: np.ndarray
    items: np.ndarray
    item_ends: np.ndarray


def windows_of(rows: pa.Table, size: int) -> Windows:
    """Pack rows of ``item`` and ``terms``; equal windows become one."""
    lists = rows.column("terms").combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat, lengths = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    vocabulary, codes = np.unique(flat, return_inverse=True)
    padded = np.full((len(lengths), size), -1, np.int32)
    at = flat_ranges(np.zeros(len(lengths), np.int64), lengths)
    padded[np.repeat(np.arange(len(lengths)), lengths), at] = codes
    terms, owner = np.unique(padded, axis=0, return_inverse=True)
    order = np.argsort(owner.ravel(), kind="stable")
    item_ends = np.cumsum(np.bincount(owner.ravel(), minlength=len(terms)))
    items = rows.column("item").to_numpy()[order]
    return Windows(vocabulary, terms, (terms >= 0).sum(axis=1), items, item_ends)


class Postings:
    """One segment's lists, for lookups of many (term, position) pairs at once."""

    def __init__(self, terms: np.ndarray, ends: np.ndarray, positions: np.ndarray) -> None:
        self.terms, self.ends = terms, ends.astype(np.int64)
        self.starts = self.ends - np.diff(self.ends, prepend=0)
        self.positions = positions.astype(np.int64)
        self.span = int(self.positions.max(initial=0)) + 2
        # Lists follow each other in order of term number, so all pairs are in order.
        owner = np.repeat(np.arange(len(terms)), self.ends - self.starts)
        self.pairs = owner * self.span + self.positions

    def numbers(self, vocabulary: np.ndarray) -> np.ndarray:
        """The number here of each term of a vocabulary, or -1."""
        if not len(self.terms):
            return np.full(len(vocabulary), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        return np.where(self.terms[at] == vocabulary, at, -1)

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether a term's list has a position."""
        sound = (position >= 0) & (position < self.span)
        wanted = term * self.span + np.where(sound, position, 0)
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return sound & (self.pairs[at] == wanted)

    def following(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The first position of a term at or behind a position, or a very high one."""
        at = np.searchsorted(self.pairs, term * self.span + np.minimum(position, self.span - 1))
        inside = at < self.ends[term]
        return np.where(inside & (position < self.span), self.positions[np.minimum(at, len(self.positions) - 1)], 1 << 40)


def phrases(segment: Postings, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``terms`` and starts of their exact occurrences; all terms are in the segment."""
    rows, length = np.arange(len(terms)), terms.shape[1]
    sizes = (segment.ends - segment.starts)[terms]
    rarest_first = np.argsort(sizes, axis=1, kind="stable")
    anchor = rarest_first[:, 0]
    term = terms[rows, anchor]
    lists = sizes[rows, anchor]
    row = np.repeat(rows, lists)
    start = segment.positions[flat_ranges(segment.starts[term], lists)] - np.repeat(anchor, lists)
    for k in range(1, length):
        offset = rarest_first[row, k]
        fits = segment.holds(terms[row, offset], start + offset)
        row, start = row[fits], start[fits]
    return row, start


def near_phrases(segment: Postings, terms: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and ends of occurrences in order with at most ``slop`` further words inside.

    Of each start the earliest end. Rarer terms must be near before the words are followed in order.
    """
    rows, length = np.arange(len(terms)), terms.shape[1]
    sizes = (segment.ends - segment.starts)[terms]
    rarest_first = np.argsort(sizes, axis=1, kind="stable")
    first = terms[:, 0]
    row = np.repeat(rows, sizes[:, 0])
    start = segment.positions[flat_ranges(segment.starts[first], sizes[:, 0])]
    for k in range(length):
        offset = rarest_first[row, k]
        near = segment.following(terms[row, offset], start + offset)
        fits = near <= start + offset + slop
        row, start = row[fits], start[fits]
    last = start
    for k in range(1, length):
        last = segment.following(terms[row, k], last + 1)
        fits = last <= start + k + slop
        row, start, last = row[fits], start[fits], last[fits]
    return row, start, last + 1


def occurrences(segment: Postings, windows: Windows, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, starts and stops of all occurrences in a segment."""
    numbers = np.append(segment.numbers(windows.vocabulary), -1)
    found = [(np.zeros(0, np.int64),) * 3]
    for length in np.unique(windows.lengths).tolist():
        of_length = np.flatnonzero(windows.lengths == length)
        terms = numbers[windows.terms[of_length, :length]]
        there = (terms >= 0).all(axis=1)
        if not there.any():
            continue
        of_length, terms = of_length[there], terms[there]
        if slop:
            row, start, stop = near_phrases(segment, terms, slop)
        else:
            row, start = phrases(segment, terms)
            stop = start + length
        found.append((of_length[row], start, stop))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def merged(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each owner, overlapping and touching ones joined, in order."""
    if not len(owner):
        return owner, start, stop
    order = np.lexsort((start, owner))
    owner, start, stop = owner[order], start[order], stop[order]
    # Owners lie apart, so one running maximum serves them all.
    reach = np.maximum.accumulate(stop + owner * (1 << 34)) - owner * (1 << 34)
    new = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1]))
    last = np.append(np.flatnonzero(new)[1:], len(owner)) - 1
    return owner[new], start[new], reach[last]


def search(index: DataFrame, windows: DataFrame, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """For every indexed document the items found and the spans of words that are hit.

    ``segment`` and ``ordinal`` tell documents apart; ``items`` are numbers, each once.
    """
    spark = index.sparkSession
    kind = dict(index.dtypes)["doc_ids"].removeprefix("array<")[:-1]
    schema = FOUND.format(kind)
    passes = max(1, -(-windows.count() // WINDOWS_PER_PASS))
    if passes > 1:
        # Parts are dealt by hash; half as many again leaves room for an uneven deal.
        passes = passes * 3 // 2 + 1
    results = None
    for part in range(passes):
        rows = windows.filter(F.pmod(F.xxhash64("item", "terms"), F.lit(passes)) == part)
        shared = spark.sparkContext.broadcast(windows_of(rows.select("item", "terms").toArrow(), size))

        def searched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    yield found_in(batch.slice(k, 1), shared.value, slop)

        found = index.mapInArrow(searched, schema)
        results = found if results is None else results.unionByName(found)
    if passes == 1:
        return results
    one = results.groupBy("segment", "ordinal").agg(
        F.any_value("doc_id").alias("doc_id"),
        F.any_value("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    return one


def found_in(row: pa.RecordBatch, windows: Windows, slop: int) -> pa.RecordBatch:
    """The documents of one segment with what is found in them."""
    arrays = {name: row.column(name).values[slice(*row.column(name).offsets.to_pylist())] for name in row.schema.names[1:]}
    number = {name: arrays[name].to_numpy() for name in ("terms", "ends", "positions", "firsts", "n_words")}
    segment = Postings(number["terms"], number["ends"], number["positions"])
    window, start, stop = occurrences(segment, windows, slop)
    firsts, n = number["firsts"].astype(np.int64), len(number["firsts"])
    owner = np.searchsorted(firsts, start, side="right") - 1
    # With slop, what begins in one text and ends in another is no match.
    inside = stop <= firsts[owner] + number["n_words"][owner]
    window, start, stop, owner = window[inside], start[inside], stop[inside], owner[inside]
    pairs = np.unique(np.stack([owner, window], axis=1), axis=0) if len(owner) else np.zeros((0, 2), np.int64)
    held = np.diff(windows.item_ends, prepend=0)[pairs[:, 1]]
    items = windows.items[flat_ranges(windows.item_ends[pairs[:, 1]] - held, held)]
    named = np.stack([np.repeat(pairs[:, 0], held), items], axis=1)
    named = np.unique(named, axis=0) if len(named) else np.zeros((0, 2), np.int64)
    owner, start, stop = merged(owner, start - firsts[owner], stop - firsts[owner])

    def lists(of: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=n))), pa.int32()), values)

    spans = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(stop, pa.int32())], names=["start", "stop"])
    columns = [
        pa.array(np.full(n, row.column("segment")[0].as_py()), pa.int64()),
        pa.array(np.arange(n), pa.int32()),
        arrays["doc_ids"],
        arrays["n_words"],
        lists(named[:, 0], pa.array(named[:, 1], pa.int64())),
        lists(owner, spans),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "ordinal", "doc_id", "n_words", "items", "spans"])


def numbered_items(benchmark: DataFrame) -> DataFrame:
    """Items with a number for each distinct id."""
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text")
    )
    names = kept_table(rows.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    return rows.join(names, "item_id")


def words_hit(spans: str):
    """The number of words in spans that are in order of their start and may overlap."""
    zero = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach"))

    def add(done, span):
        fresh = F.greatest(span["stop"] - F.greatest(span["start"], done["reach"]), F.lit(0))
        return F.struct((done["hit"] + fresh).alias("hit"), F.greatest(done["reach"], span["stop"]).alias("reach"))

    return F.aggregate(spans, zero, add, lambda done: done["hit"])


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document: its words, those hit by benchmark windows, and the items found in it."""
    index = build_index(docs)
    items = numbered_items(benchmark)
    found = kept_table(search(index, item_windows(items, size), size, slop), "found")
    key = ["segment", "ordinal"]
    # Few documents hold any item; their items are named and put in order as strings.
    held = found.filter(F.size("items") > 0).select(*key, F.explode("items").alias("item"))
    named = held.join(items.select("item", "item_id").distinct(), "item")
    named = named.groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    hit = words_hit("spans").cast("long")
    return found.join(named, key, "left").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLE = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS MATERIALIZED (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS m, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
hits AS MATERIALIZED (
  SELECT DISTINCT r, i, m, words
  FROM (SELECT r, i, m, array_to_string(w[i : i + m - 1], ' ') AS words
        FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
              FROM docs CROSS JOIN (SELECT DISTINCT m FROM windows) WHERE len(w) >= m))
  SEMI JOIN windows USING (m, words)),
words AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS place FROM hits) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits JOIN windows USING (m, words)) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)"""
