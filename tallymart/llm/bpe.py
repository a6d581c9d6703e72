"""Byte-level BPE encoding and decoding by a pair occurrence index.

The texts of a batch are cut into pieces by character classes, and equal pieces are
encoded once. All of the batch's distinct pieces are merged together: an index maps
every adjacent pair that has a merge rank to all of its positions; the active
ranks are taken in ascending order; merging one pair removes and adds occurrences
of its neighbours' pairs, and only their lists are updated. A merge only makes
pairs of higher rank, so each rank is taken once and the result equals merging
every piece on its own.

Decoding joins the bytes of the ids' tokens; bytes that are no UTF-8 become U+FFFD.

Defined results: a NULL text is encoded as the empty text, which has no ids. The
added special tokens of the vocabulary are recognised in texts. Repeated rows are
encoded alike. Extra columns are dropped by ``encode`` unless named in ``keep``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of texts handled at once; longer texts are handled alone.
BYTES_PER_BLOCK = 1_000_000
# Ids decoded at once.
IDS_PER_BLOCK = 1_000_000
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# What may follow an apostrophe to make a piece of its own.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The class of every code point, as the splitting pattern sees it."""
    import regex

    classes = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, number in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        found = "".join(regex.findall(pattern, every))
        classes[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = number
    return classes


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, reversed."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and added tokens of a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        ids = spec["model"]["vocab"]
        self.added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.tokens = [b""] * (max([*ids.values(), *self.added.values()]) + 1)
        for text, i in ids.items():
            self.tokens[i] = bytes(map(alphabet.__getitem__, text))
        for text, i in self.added.items():
            self.tokens[i] = text.encode()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.left = [ids[a] for a, _ in merges]
        self.right = [ids[b] for _, b in merges]
        self.merged = [ids[a + b] for a, b in merges]
        self.rank = {pair: r for r, pair in enumerate(zip(self.left, self.right, strict=True))}
        by_byte = {b: ids[c] for c, b in alphabet.items()}
        self.byte_ids = np.array([by_byte[b] for b in range(256)], np.int64)
        # The ranks of pairs of bytes, where all merging starts.
        self.byte_ranks = np.full((256, 256), -1, np.int32)
        for a in range(256):
            for b in range(256):
                self.byte_ranks[a, b] = self.rank.get((by_byte[a], by_byte[b]), -1)
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.token_ends = np.cumsum(lengths)
        self.token_lengths = lengths
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ranges ``start .. start + length - 1``."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def piece_starts(code_points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where pieces start in the concatenated texts, each text on its own.

    A piece is a contraction, or a run of letters, numbers or other characters with a
    blank before it if there is one, or white space up to the last blank of a run.
    """
    n = len(code_points)
    if not n:
        return np.zeros(0, np.int64)
    kind = character_classes()[code_points]
    first = np.zeros(n, bool)
    first[text_starts[text_starts < n]] = True
    same = np.zeros(n, bool)
    same[1:] = (kind[1:] == kind[:-1]) & ~first[1:]
    start = ~same
    # The last white space before a visible character in the same text is cut off its
    # run; if it is a blank, it joins the run behind it.
    space = kind == SPACE
    before_run = np.zeros(n, bool)
    before_run[:-1] = space[:-1] & ~space[1:] & ~first[1:]
    joined = before_run & (code_points == 0x20)
    start |= before_run
    start[1:] &= ~joined[:-1]
    # Contractions start where a run of others starts with an apostrophe and no blank.
    quotes = np.flatnonzero(start & (code_points == 0x27))
    if len(quotes):
        text_end = np.append(text_starts[1:], n)[np.searchsorted(text_starts, quotes, side="right") - 1]
        for suffix in CONTRACTIONS:
            end = quotes + 1 + len(suffix)
            fits = end <= text_end
            for k, letter in enumerate(suffix):
                fits &= code_points[np.minimum(quotes + 1 + k, n - 1)] == ord(letter)
            start[quotes[fits] + 1] = False
            after = end[fits]
            start[after[after < n]] = True
    return np.flatnonzero(start)


def compact(numbers: np.ndarray) -> array:
    """Numbers that are read and set one by one, at four bytes each."""
    return array("i", numbers.astype(np.int32).tobytes())


def merge_pieces(data: np.ndarray, offsets: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, concatenated, and where each piece's ids start (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    symbol = compact(vocab.byte_ids[data])
    last = np.zeros(n + 1, bool)
    last[offsets[1:] - 1] = True
    ranks = np.full(n, -1, np.int32)
    if n > 1:  # a single byte has no pair
        ranks[:-1] = np.where(last[: n - 1], -1, vocab.byte_ranks[data[:-1], data[1:]])
    # The index: rank of a pair -> the positions of its left symbols.
    where: dict[int, array] = {}
    order = np.argsort(ranks, kind="stable").astype(np.int32)
    sorted_ranks = ranks[order]
    present, begins = np.unique(sorted_ranks, return_index=True)
    for rank, begin, end in zip(present.tolist(), begins.tolist(), [*begins[1:].tolist(), n], strict=True):
        if rank >= 0:
            where[rank] = compact(order[begin:end])
    del order, sorted_ranks, ranks
    # Linked lists of symbols; -1 ends a piece. A merged right symbol becomes -1.
    follower = np.arange(1, n + 1, dtype=np.int32)
    follower[last[:n]] = -1
    leader = np.arange(-1, n - 1, dtype=np.int32)
    leader[offsets[:-1][offsets[:-1] < n]] = -1
    follower, leader = compact(follower), compact(leader)

    active = list(where)
    heapq.heapify(active)
    find, lefts, rights, made = vocab.rank.get, vocab.left, vocab.right, vocab.merged
    while active:
        rank = heapq.heappop(active)
        positions = where.pop(rank)
        a, b, new = lefts[rank], rights[rank], made[rank]
        if a == b:
            positions = sorted(positions)  # overlapping occurrences are merged from the left
        for i in positions:
            j = follower[i]
            if symbol[i] != a or j < 0 or symbol[j] != b:
                continue  # one of the two has been merged with another symbol since
            symbol[i], symbol[j] = new, -1
            after = follower[i] = follower[j]
            if after >= 0:
                leader[after] = i
                r = find((new, symbol[after]))
                if r is not None:
                    if r in where:
                        where[r].append(i)
                    else:
                        where[r] = array("i", (i,))
                        heapq.heappush(active, r)
            before = leader[i]
            if before >= 0:
                r = find((symbol[before], new))
                if r is not None:
                    if r in where:
                        where[r].append(before)
                    else:
                        where[r] = array("i", (before,))
                        heapq.heappush(active, r)
    symbols = np.frombuffer(symbol, np.int32)
    alive = symbols >= 0
    counts = np.concatenate([[0], np.cumsum(alive)])
    return symbols[alive].astype(np.uint32), counts[offsets]


def encode_block(texts: Sequence[str], path: str, added: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, concatenated, and where each text's ids start (one more at the end).

    Without ``added``, the vocabulary's added tokens are text like any other.
    """
    vocab = vocabulary(path)
    # Texts are split around added tokens, which are pieces of their own.
    parts, owner, special = list(texts), None, None
    if added and any(token in text for token in vocab.added for text in texts):
        parts, owner, special = split_added(texts, vocab.added)
    joined = "".join(parts)
    code_points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    part_starts = np.cumsum([0, *map(len, parts)])
    starts = piece_starts(code_points, np.unique(part_starts[:-1]))
    data = joined.encode()
    width = 1 + (code_points > 0x7F).astype(np.uint8) + (code_points > 0x7FF) + (code_points > 0xFFFF)
    byte_at = np.zeros(len(code_points) + 1, np.int32)
    np.cumsum(width, out=byte_at[1:])
    if special is not None:
        # Nothing is cut within an added token.
        inside = np.zeros(len(code_points) + 1, bool)
        for k in np.flatnonzero(special >= 0).tolist():
            inside[part_starts[k] + 1 : part_starts[k + 1]] = True
        starts = starts[~inside[starts]]
    offsets = byte_at[np.append(starts, len(code_points))]
    pieces = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    ).dictionary_encode()
    which, distinct = pieces.indices.to_numpy(), pieces.dictionary
    cuts = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1] if len(distinct) else np.zeros(1, np.int64)
    raw = np.frombuffer(distinct.buffers()[2] or b"", np.uint8)[: cuts[-1]] if len(distinct) else np.zeros(0, np.uint8)
    ids, bounds = merge_pieces(raw, cuts, vocab)
    counts = np.diff(bounds)[which]
    piece_of_part = np.searchsorted(starts, part_starts)
    if special is not None:
        # An added token has one id, whatever its bytes would merge to.
        ids = np.concatenate([ids, np.arange(len(vocab.tokens), dtype=np.uint32)])
        first = bounds[which]
        for k in np.flatnonzero(special >= 0).tolist():
            first[piece_of_part[k]], counts[piece_of_part[k]] = bounds[-1] + special[k], 1
    else:
        first = bounds[which]
    flat = ids[flat_ranges(first, counts)]
    ends = np.concatenate([[0], np.cumsum(counts)])[piece_of_part]
    if owner is not None:
        ends = ends[np.searchsorted(owner, np.arange(len(texts) + 1))]
    return flat, ends


def split_added(texts: Sequence[str], added: dict[str, int]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Parts of the texts, the text of each part (one more at the end), and the id of parts that are added tokens."""
    import re

    pattern = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    parts, owner, special = [], [], []
    for number, text in enumerate(texts):
        for k, part in enumerate(pattern.split(text)):
            if part or not k:
                parts.append(part)
                owner.append(number)
                special.append(added[part] if k % 2 else -1)
    return parts, np.array([*owner, len(texts)]), np.array(special, np.int64)


def decode_ids(ids: np.ndarray, path: str) -> str:
    vocab = vocabulary(path)
    parts = []
    for k in range(0, len(ids), IDS_PER_BLOCK):
        some = ids[k : k + IDS_PER_BLOCK]
        lengths = vocab.token_lengths[some]
        parts.append(vocab.token_bytes[flat_ranges(vocab.token_ends[some] - lengths, lengths)].tobytes())
    return b"".join(parts).decode("utf-8", "replace")


def blocks(batch: pa.RecordBatch, column: str, most: int = BYTES_PER_BLOCK) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch whose texts have at most ``most`` bytes together, or one text; NULL is empty.

    Blocks are cut by the lengths alone, so only one block's texts are strings at a time.
    """
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else []
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield batch.slice(first, last - first), texts.slice(first, last - first).to_pylist()
        first = last


def encode(
    docs: DataFrame, path: str | None = None, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """One row per document: the kept columns and ``ids``. A single pass without a shuffle."""
    vocab_path = path or default_vocabulary()
    kept = [name for name in keep if name not in (text, "ids")]
    rows = docs.select(*kept, F.col(text).cast("string").alias("_text"))
    schema = rows.select(*kept, F.lit(None).cast("array<long>").alias("ids")).schema

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(batch, "_text"):
                ids, ends = encode_block(texts, vocab_path)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), lists], names=[*kept, "ids"])

    return rows.mapInArrow(encoded, schema)


def decode(rows: DataFrame, path: str | None = None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and the text that ``ids`` stand for; NULL ids give the empty text."""
    vocab_path = path or default_vocabulary()
    schema = rows.select(*keep, F.lit("").alias("text")).schema

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = (np.array(x or [], np.int64) for x in batch.column("ids").to_pylist())
            texts = pa.array([decode_ids(x, vocab_path) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), texts], names=[*keep, "text"])

    return rows.select(*keep, "ids").mapInArrow(decoded, schema)


def round_trip(docs: DataFrame, path: str | None = None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Number and digest of each document's ids, and the digest of what they decode to.

    Encoding and decoding share one pass, so the ids never leave the task.
    """
    vocab_path = path or default_vocabulary()
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    digests = ("n_tokens long", "ids_sha256 string", "decoded_sha256 string")
    schema = rows.select(
        *keep, *(F.lit(None).cast(kind).alias(name) for name, kind in (d.split() for d in digests))
    ).schema

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(batch, "_text"):
                ids, ends = encode_block(texts, vocab_path)
                ids = ids.astype("<u4")
                each = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                columns = [
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in each], pa.string()),
                    pa.array(
                        [hashlib.sha256(decode_ids(x, vocab_path).encode()).hexdigest() for x in each], pa.string()
                    ),
                ]
                names = [*keep, *(d.split()[0] for d in digests)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *columns], names=names)

    return rows.mapInArrow(digested, schema)
