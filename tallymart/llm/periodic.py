"""Stretches of words that repeat themselves, found by internal pattern matching.

A run is a stretch with smallest period ``q`` (words ``q`` apart are identical) that holds at least four
periods and six words and that no neighbouring word extends. Texts lie end to end, a separator
of its own behind each. Sorting suffixes by doubling gives the interval of the suffix array that holds all
occurrences of every dyadic block, a stretch of ``b = 2**k`` words that starts at a multiple of ``b``. For each
block a wavelet matrix over the suffix array answers range successor and predecessor: the nearest occurrences
on either side, within a window of ``b`` words. Occurrences that near form an arithmetic progression, and the
step to the nearest is its difference: a candidate period between ``b / 2`` and ``b``. A run of four periods
contains, for the ``b`` next above its period, a whole block with the next occurrence on one side inside the
run too, so every run is found. Neighbouring blocks of one candidate are joined and extended word by word,
by less than a block on each side.

Words are compared by a dictionary of the block's words, hence exactly. Texts are handled in blocks of
about ``BYTES_PER_BLOCK`` bytes; a longer text is a block of its own, whole, at some 30 bytes of memory per byte.

Defined results: words are runs of characters other than blank, tab, newline, vertical tab, form feed
and carriage return. NULL and empty texts have no words, no runs and an empty collapsed text. Runs may
overlap; a word is dropped if any run contains it after its first period. Repeated rows are handled alike,
each on its own. Rows without an id are kept. An empty table gives none. Columns that are not kept
by name are ignored; the results are called ``runs`` and ``collapsed``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.bpe import flat_ranges
from tallymart.llm.quality import text_blocks

LEAST_PERIODS, LEAST_WORDS = 4, 6
BYTES_PER_BLOCK = 500_000
# Words compared in one go when runs are extended.
COMPARED = 1 << 20

WORD = r"[^\x20\x09-\x0D]+"
# Bytes of words, with 0 for separators; the zero byte takes the blank's place, so nothing is lost.
BYTES = np.arange(256, dtype=np.uint8)
BYTES[0] = 0x20
BYTES[[0x20, *range(0x09, 0x0E)]] = 0
BACK = np.arange(256, dtype=np.uint8)
BACK[[0, 0x20]] = 0x20, 0

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def word_pieces(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with one separator behind each, where each begins (one more at the end), and words per text."""
    n = len(ends)
    lengths = np.diff(ends, prepend=0)
    apart = np.zeros(len(data) + n, np.uint8)
    apart[np.arange(len(data)) + np.repeat(np.arange(n), lengths)] = BYTES[data]
    inside = apart > 0
    last = ~inside
    last[1:] &= inside[:-1]
    last[:1] = False
    joined = apart[inside | last]
    owner = np.searchsorted(ends + np.arange(n), np.flatnonzero(last))
    return joined, np.append(0, np.flatnonzero(joined == 0) + 1), np.bincount(owner, minlength=n)


def word_codes(joined: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A number for each distinct word."""
    n = len(offsets) - 1
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)]
    return pa.Array.from_buffers(pa.large_binary(), n, buffers).dictionary_encode().indices.to_numpy()


def sorted_suffixes(sequence: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array, sorted as far as blocks go, and for each block length ``b`` the blocks
    that occur elsewhere too: ``b``, their starts, and the ends of their intervals in the suffix array.

    ``longest`` is the longest text. Only suffixes that are still tied are sorted again.
    """
    n = len(sequence)
    array = np.argsort(sequence, kind="stable")
    ordered = sequence[array]
    new = np.append(True, ordered[1:] != ordered[:-1])
    low = np.empty(n, np.int64)
    high = np.empty(n, np.int64)
    tied = np.arange(n)
    blocks = []
    b = 1
    while True:
        # ``tied`` are places in the array, ``new`` tells which of them begin an interval.
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(tied)))
        # Intervals are contiguous in the array, so their first place and size tell them.
        first = np.repeat(tied[begins], sizes)
        low[array[tied]], high[array[tied]] = first, first + np.repeat(sizes, sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        of_block = array[tied]
        of_block = of_block[of_block % b == 0]
        blocks.append((b, of_block, low[of_block], high[of_block]))
        if not len(tied) or 2 * b > longest:
            return array, blocks
        # No tied suffix holds a separator in its first b words, so there is a word behind them.
        suffixes = array[tied]
        keys = low[suffixes] * n + low[suffixes + b]
        order = np.argsort(keys, kind="stable")
        array[tied], keys = suffixes[order], keys[order]
        new = np.append(True, keys[1:] != keys[:-1])
        b *= 2


class WaveletMatrix:
    """Order statistics of any stretch of a permutation, for many stretches at once."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros = []
        values = values.astype(np.int32)
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[zero], values[~zero]])

    def less(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of ``[low, high)`` are below the bound."""
        count = np.zeros(len(low), np.int32)
        for level, before in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            left, right = before[low], before[high]
            count += np.where(one, right - left, 0)
            low = np.where(one, before[-1] + low - left, left)
            high = np.where(one, before[-1] + high - right, right)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The ``nth`` smallest value of ``[low, high)``, counted from 0."""
        value = np.zeros(len(low), np.int32)
        for before in self.zeros:
            left, right = before[low], before[high]
            one = nth >= right - left
            nth = np.where(one, nth - (right - left), nth)
            low = np.where(one, before[-1] + low - left, left)
            high = np.where(one, before[-1] + high - right, right)
            value = 2 * value + one
        return value


def candidates(sequence: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each block length ``b``: starts of ``b`` words that are identical to those ``period`` further on, and that period."""
    array, blocks = sorted_suffixes(sequence, longest)
    matrix = WaveletMatrix(array)
    length = np.concatenate([np.full(len(start), b, np.int32) for b, start, _, _ in blocks])
    start, low, high = (np.concatenate([x[k] for x in blocks]).astype(np.int32) for k in (1, 2, 3))
    place = matrix.less(low, high, start)
    found = []
    for side in (1, -1):
        there = place + 1 < high - low if side > 0 else place > 0
        at = np.flatnonzero(there)
        other = matrix.smallest(low[at], high[at], place[at] + side)
        period = side * (other - start[at])
        near = (period <= length[at]) & (2 * period > length[at])
        at, period = at[near], period[near]
        found.append((length[at], start[at] if side > 0 else start[at] - period, period))
    lengths, starts, periods = map(np.concatenate, zip(*found, strict=True))
    for b in np.unique(lengths).tolist():
        of = lengths == b
        yield b, starts[of].astype(np.int64), periods[of].astype(np.int64)


def agreeing(sequence: np.ndarray, at: np.ndarray, period: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words in a row, up to ``most``, equal the word a period further on, from ``at`` in steps of 1 or -1."""
    n = len(sequence)
    counts = np.zeros(len(at), np.int64)
    rows = max(1, COMPARED // most)
    ahead = step * np.arange(most)
    for k in range(0, len(at), rows):
        first = at[k : k + rows, None] + ahead
        second = first + period[k : k + rows, None]
        sound = (first >= 0) & (second < n)
        same = sound & (sequence[np.where(sound, first, 0)] == sequence[np.where(sound, second, 0)])
        counts[k : k + rows] = np.where(same.all(axis=1), most, same.argmin(axis=1))
    return counts


def find_runs(sequence: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start, then period. Every text ends with a separator of its own."""
    found = [(np.zeros(0, np.int64),) * 3]
    if len(sequence) > 1:
        for b, start, period in candidates(sequence, longest):
            order = np.lexsort((start, period))
            start, period = start[order], period[order]
            # Stretches of one period that touch are one; starts of a period never decrease.
            new = np.append(True, (period[1:] != period[:-1]) | (start[1:] > start[:-1] + b))
            begins = np.flatnonzero(new)
            stop = start[np.append(begins[1:], len(start)) - 1] + b
            start, period = start[begins], period[begins]
            least = np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
            enough = stop - start + 2 * (b - 1) + period >= least
            start, stop, period, least = start[enough], stop[enough], period[enough], least[enough]
            start = start - agreeing(sequence, start - 1, period, -1, b)
            stop = stop + agreeing(sequence, stop, period, 1, b) + period
            long = stop - start >= least
            found.append((start[long], (stop - start)[long], period[long]))
    start, length, period = map(np.concatenate, zip(*found, strict=True))
    runs = np.unique(np.stack([start, period, length]), axis=1)
    return runs[0], runs[2], runs[1]


def repeats(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, all ``runs`` of each whole text, and the ``collapsed`` text, in one pass without a shuffle."""
    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = rows.select(*keep, F.lit(None).cast(RUNS).alias("runs"), F.lit("").alias("collapsed")).schema

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, ends in text_blocks(batch.column("_text"), BYTES_PER_BLOCK):
                kept = [batch.column(name).slice(first, last - first) for name in keep]
                yield pa.RecordBatch.from_arrays([*kept, *of_texts(data, ends)], names=[*keep, "runs", "collapsed"])

    return rows.mapInArrow(repeated, schema)


def of_texts(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed texts of texts that lie end to end."""
    joined, offsets, counts = word_pieces(data, ends)
    n, texts = len(offsets) - 1, len(ends)
    codes = word_codes(joined, offsets)
    # A text's words and its separator, whose code is like no other.
    firsts = np.cumsum(counts) - counts + np.arange(texts)
    sequence = np.empty(n + texts, np.int64)
    at = flat_ranges(firsts, counts)
    sequence[at] = codes
    sequence[firsts + counts] = n + np.arange(texts)
    start, length, period = find_runs(sequence, int(counts.max(initial=0)))
    owner = np.searchsorted(firsts, start, side="right") - 1
    # Words behind the first period of any run.
    depth = np.zeros(n + texts + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    kept = np.cumsum(depth)[at] == 0
    sizes = np.diff(offsets)
    shown = BACK[joined]
    if not kept.all():
        shown = shown[np.repeat(kept, sizes)]
    borders = np.append(0, np.cumsum(np.where(kept, sizes, 0)))[np.append(0, np.cumsum(counts))]
    # Without the separator behind the last word.
    filled = np.diff(borders) > 0
    mask = np.ones(len(shown), bool)
    mask[borders[1:][filled] - 1] = False
    borders = borders - np.append(0, np.cumsum(filled))
    collapsed = pa.Array.from_buffers(
        pa.large_string(), texts, [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(shown[mask])]
    ).cast(pa.string())
    numbers = [pa.array(x, pa.int64()) for x in (start - firsts[owner], length, period)]
    lists = pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=texts))), pa.int32())
    runs = pa.StructArray.from_arrays(numbers, names=["start", "length", "period"])
    return pa.ListArray.from_arrays(lists, runs), collapsed


def planted(docs: DataFrame) -> DataFrame:
    """Id and text of all documents; of every tenth, by the CRC-32 of its id, the rest of the text
    from some word on repeats itself. A missing id counts as the empty text."""
    digest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), digest.alias("h"))
    chosen = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("words", chosen).withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.expr("CASE WHEN n > 0 THEN (h div 10) % n END"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    again = F.expr("transform(sequence(0L, n - 1), i -> words[int(if(i >= a, a + (i - a) % p, i))])")
    text = F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def strongest(runs: str) -> Column:
    """The run with the most periods, compared exactly; of equals the first."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")

    def better(best, run):
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, none, better)


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document: number of runs, the strongest one, and digests of all runs and of the collapsed text."""
    found = repeats(planted(docs)).withColumn("best", strongest("runs"))
    lines = F.transform(
        "runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    )
    best = F.col("best")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[name].alias(name) for name in ("start", "length", "period")),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
