"""Near-duplicate texts by DartMinHash signatures and banded joining.

A text is the weighted set of its runs of five words; a run that occurs w times has
weight w. The region of an element is its weight times the axis of ranks. Darts fall
into it at rate one per unit, at places that only hashes of the element decide, and
each dart belongs to one of ``COORDINATES`` coordinates. The earliest dart of a
coordinate is its signature; two texts agree in a coordinate with the probability of
their weighted Jaccard similarity. Only ranks up to about ``k ln k + 2k`` darts are looked
at, whatever the length of the text; a text with an empty coordinate is looked at further.

Equal texts are one class. Bands of coordinates are hashed to buckets. In a bucket every
class is compared with the smallest one, the leader, and similar ones are united to
components. Classes outside the main component of a bucket are then compared, block against
block, with all of their bucket that are in other components. So whatever two similar classes
share a bucket, they are united, while near copies of a leader cost one comparison each.
Similarities are exact.

Defined results: words are runs of letters, digits and anything outside ASCII, A-Z in lower
case. A text of fewer than five words is one run of them; a text that is NULL or has no
word links with nothing. Rows without an id are in no group and are kept. Repeated rows
are in one group. An id that stands on different texts is in the groups of all of them; a group
has the smallest id of its texts, and of several texts with this id the one with the smallest
digest is kept, so two groups can have one name. A very long text is signed whole, in a block
of its own. An empty table gives no rows. Other columns are ignored, and kept by
``one_of_each``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm import words
from tallymart.llm.graph import components
from tallymart.llm.quality import text_blocks
from tallymart.llm.tables import kept_table, packed

RUN_WORDS = 5
LEAST_SIMILARITY = 0.8
BANDS, ROWS = 20, 4
COORDINATES = BANDS * ROWS
ELEMENTS_PER_BLOCK = 200_000
BYTES_PER_BLOCK = 1_000_000
DART_STEP = 0xD1B54A32D192ED03


def weighted_runs(data: np.ndarray, ends: np.ndarray, length: int = RUN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's elements, and the text of each, in order of texts and hashes.

    An element is a run of words and the number of its occurrence, so a run of weight w
    has w elements of weight one.
    """
    parts = words.WORD_BYTES[data]
    starts = words.word_starts(parts, ends)
    hashes, owner = words.word_hashes(parts, starts), words.owners(starts, ends)
    counts = np.bincount(owner, minlength=len(ends))
    begin = np.cumsum(counts) - counts
    place = np.arange(len(hashes)) - begin[owner]
    # Runs start at every word with enough words behind it, or at the first of a short text.
    starts_run = (place + length <= counts[owner]) | (place == 0)
    first = np.flatnonzero(starts_run)
    run = np.zeros(len(first), np.uint64)
    for k in range(length):
        inside = place[first] + k < counts[owner[first]]
        # Past the end of a short text nothing is added.
        word = hashes[np.minimum(first + k, max(0, len(hashes) - 1))] if len(hashes) else hashes
        run = words.mix(run * np.uint64(words.FACTOR) + np.where(inside, word, np.uint64(k + 1)))
    owner = owner[first]
    order = np.lexsort((run, owner))
    run, owner = run[order], owner[order]
    same = np.zeros(len(run), bool)
    same[1:] = (run[1:] == run[:-1]) & (owner[1:] == owner[:-1])
    position = np.arange(len(run))
    occurrence = position - np.maximum.accumulate(np.where(same, 0, position)) if len(run) else position
    elements = words.mix(run + occurrence.astype(np.uint64) * np.uint64(DART_STEP))
    return elements, owner


def signatures(elements: np.ndarray, owner: np.ndarray, texts: int, k: int = COORDINATES) -> np.ndarray:
    """(texts, k): the earliest dart of every coordinate; texts without elements get zeros."""
    earliest = np.zeros((texts, k), np.uint64)
    weights = np.bincount(owner, minlength=texts)
    todo = np.flatnonzero(weights)
    reach = (k * math.log(k) + 2 * k) / np.maximum(weights, 1)
    while len(todo):
        wanted = np.zeros(texts, bool)
        wanted[todo] = True
        mine = wanted[owner]
        darts = throw_darts(elements[mine], owner[mine], reach, k)
        ids, where, ranks = darts
        order = np.lexsort((ids, ranks, where))
        where, ids = where[order], ids[order]
        leads = np.ones(len(where), bool)
        leads[1:] = where[1:] != where[:-1]
        filled = np.zeros(texts * k, bool)
        filled[where[leads]] = True
        earliest.reshape(-1)[where[leads]] = ids[leads]
        todo = todo[~filled.reshape(texts, k)[todo].all(axis=1)]
        reach[todo] *= 2
    return earliest


def throw_darts(
    elements: np.ndarray, owner: np.ndarray, reach: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Darts of rank below their text's reach: their ids, text and coordinate as one number, and ranks.

    The ranks of an element's darts are the arrivals of a Poisson process whose steps are
    hashed from the element, so equal elements get equal darts in every text.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rank = np.zeros(len(elements))
    limit = reach[owner]
    number = 0
    while len(elements):
        number += 1
        dart = words.mix(elements + np.uint64(number * DART_STEP % 2**64))
        rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) / 2**53)
        near = rank < limit
        elements, owner, limit, rank, dart = elements[near], owner[near], limit[near], rank[near], dart[near]
        ids = words.mix(dart ^ np.uint64(words.FACTOR))
        found.append((ids, owner * k + (ids % np.uint64(k)).astype(np.int64), rank))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(texts, bands): one hash for the coordinates of each band."""
    grouped = signature.reshape(len(signature), bands, -1)
    hashed = np.zeros(grouped.shape[:2], np.uint64)
    for k in range(grouped.shape[2]):
        hashed = words.mix(hashed * np.uint64(words.FACTOR) + grouped[:, :, k])
    return hashed.view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, a digest of the text and its band hashes, NULL for texts without words."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.md5(F.col("text").cast("binary")).alias("digest"),
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, ends in text_blocks(batch.column("text"), BYTES_PER_BLOCK):
                elements, owner = weighted_runs(data, ends)
                hashed = band_hashes(signatures(elements, owner, len(ends)))
                some = np.bincount(owner, minlength=len(ends)) > 0
                bands = pa.FixedSizeListArray.from_arrays(pa.array(hashed.reshape(-1)), BANDS).cast(pa.list_(pa.int64()))
                bands = pa.array([b if s else None for b, s in zip(bands, some.tolist(), strict=True)], pa.list_(pa.int64()))
                kept = [batch.column(c).slice(first, last - first) for c in ("doc_id", "digest")]
                yield pa.RecordBatch.from_arrays([*kept, bands], names=["doc_id", "digest", "bands"])

    return rows.mapInArrow(sign, "doc_id long, digest string, bands array<long>")


def element_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node``, the sorted bytes of its text's elements and their number, for the wanted nodes (``node``, ``digest``, ``first_id``)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("first_id"),
        F.col("text").cast("string").alias("text"),
        F.md5(F.col("text").cast("binary")).alias("digest"),
    ).join(wanted, ["first_id", "digest"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, ends in text_blocks(batch.column("text"), BYTES_PER_BLOCK):
                elements, owner = weighted_runs(data, ends)
                cuts = np.searchsorted(owner, np.arange(len(ends) + 1))
                sets = [np.sort(elements[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                node = batch.column("node").slice(first, last - first)
                yield pa.RecordBatch.from_arrays([node, pa.array(sets, pa.binary())], names=["node", "elements"])

    found = rows.select("node", "text").mapInArrow(gather, "node long, elements binary")
    # Rows that repeat an id with its text are one.
    once = found.groupBy("node").agg(F.first("elements").alias("elements"))
    return once.withColumn("size", (F.octet_length("elements") / 8).cast("long"))


def verified(pairs: DataFrame, sets: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """The pairs ``a``, ``b`` with their weighted Jaccard ``similarity``, and whether it reaches ``least``."""
    of = lambda side: sets.select(F.col("node").alias(side), F.col("elements").alias(f"of_{side}"))
    rows = pairs.select("a", "b").join(of("b").hint("merge"), "b").join(of("a").hint("merge"), "a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for x, y in zip(batch.column("of_a"), batch.column("of_b"), strict=True):
                one, other = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(one, other, assume_unique=True))
                # Two integers, so the comparison is the same on every machine.
                values.append((common, len(one) + len(other) - common))
            common, union = (np.array(v, np.int64) for v in zip(*values, strict=True)) if values else (np.zeros(0), np.ones(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(common / union), pa.array(common >= least * union)],
                names=["a", "b", "similarity", "similar"],
            )

    return rows.select("a", "b", "of_a", "of_b").mapInArrow(
        compare, "a long, b long, similarity double, similar boolean"
    )


def open_members(parts: DataFrame) -> DataFrame:
    """Members of buckets (``band``, ``hash``, ``node``, ``part``) that are not in the bucket's main part, the one with most members."""
    in_bucket = parts.groupBy("band", "hash", "part").agg(F.count("*").alias("n"))
    main = in_bucket.groupBy("band", "hash").agg(F.max(F.struct("n", "part")).alias("main"))
    main = main.select("band", "hash", F.col("main.part").alias("main"))
    return parts.join(main, ["band", "hash"]).filter(F.col("part") != F.col("main")).drop("main")


def joined_root(roots: dict[int, int], part: int) -> int:
    """The part that stands for all parts united with this one."""
    root = part
    while roots.setdefault(root, root) != root:
        root = roots[root]
    while roots[part] != root:
        roots[part], part = root, roots[part]
    return root


def compared_blocks(
    left: DataFrame, parts: DataFrame, sets: DataFrame, least: float = LEAST_SIMILARITY, spanning: bool = False
) -> DataFrame:
    """Links ``a``, ``b`` of the classes ``left`` over to similar ones of other parts of their buckets.

    Both have ``band``, ``hash``, ``node`` and ``part``. Classes left over and members of a bucket
    are dealt to blocks of about ``ELEMENTS_PER_BLOCK`` elements, and every block of the ones
    meets every block of the others in a task of its own. So a set is shipped once per block it
    meets, not once per pair, and no pair becomes a row but those found: one per class and part.
    In a bucket of two, both have met before. With ``spanning``, a link between parts that links of
    the same two blocks have united is left out, so there are fewer of them than members,
    and what is linked through others stays so.
    """
    bucket = ["band", "hash"]
    sizes = sets.select("node", "size")
    blocks = F.ceil(F.sum("size") / F.lit(ELEMENTS_PER_BLOCK)).cast("int")
    of_left = left.join(sizes, "node").groupBy(*bucket).agg(blocks.alias("left_blocks"))
    of_members = (
        parts.join(of_left.select(*bucket), bucket, "left_semi")
        .join(sizes, "node")
        .groupBy(*bucket)
        .agg(blocks.alias("member_blocks"), F.count("*").alias("members"))
    )
    shape = kept_table(of_left.join(of_members.filter(F.col("members") > 2).drop("members"), bucket), "block-shapes")

    def dealt(rows: DataFrame, own: str, other: str, is_left: bool) -> DataFrame:
        return rows.join(shape, bucket).select(
            *bucket,
            F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block"),
            F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"),
            F.lit(is_left).alias("is_left"),
            "node",
            "part",
        )

    rows = dealt(left, "left", "member", True).unionByName(dealt(parts, "member", "left", False))

    def compare(block: pa.Table) -> pa.Table:
        is_left, node, part = (block.column(c).to_numpy() for c in ("is_left", "node", "part"))
        of = [np.frombuffer(v.as_buffer(), np.uint64) for v in block.column("elements")]
        lefts, members = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        pairs: list[tuple[int, int]] = []
        if len(lefts) and len(members):
            held = np.concatenate([of[m] for m in members])
            known, number = np.unique(held, return_inverse=True)
            size = np.array([len(of[m]) for m in members])
            starts = np.cumsum(size) - size
            marks = np.zeros(len(known), np.int64)
            roots: dict[int, int] = {}
            for x in lefts:
                mine = np.searchsorted(known, of[x])
                mine = mine[known[np.minimum(mine, len(known) - 1)] == of[x]]
                marks[mine] = 1
                common = np.add.reduceat(marks[number], starts)
                marks[mine] = 0
                near = (common >= least * (len(of[x]) + size - common)) & (part[members] != part[x])
                others, first = np.unique(part[members][near], return_index=True)
                for other, y in zip(others.tolist(), node[members][near][first].tolist(), strict=True):
                    one, two = (joined_root(roots, p) for p in (int(part[x]), other))
                    if not spanning or one != two:
                        roots[two] = one
                        pairs.append((int(node[x]), y))
        return pa.table(
            {"a": pa.array([min(p) for p in pairs], pa.int64()), "b": pa.array([max(p) for p in pairs], pa.int64())}
        )

    with_sets = rows.join(sets.select("node", "elements").hint("merge"), "node")
    return with_sets.groupBy(*bucket, "left_block", "member_block").applyInArrow(compare, "a long, b long").distinct()


def similar_links(docs: DataFrame, classes: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """Links ``a``, ``b`` that unite similar classes (``node``, ``digest``, ``first_id``, ``bands``)."""
    buckets = classes.select("node", F.posexplode("bands").alias("band", "hash"))
    shared = buckets.groupBy("band", "hash").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    members = kept_table(buckets.join(shared, ["band", "hash"]), "bucket-members")
    # The class that shares its buckets with most others leads each of them: it is likely to be
    # similar to more of them than any, and leads many buckets of its group at once.
    shares = members.groupBy("node").agg(F.sum("size").alias("shares"))
    led = members.join(shares, "node")
    chief = led.groupBy("band", "hash").agg(F.max_by("node", F.struct("shares", F.col("node"))).alias("leader"))
    led = led.join(chief, ["band", "hash"])
    members = members.drop("size")
    wanted = members.select("node").distinct().join(classes.select("node", "digest", "first_id"), "node")
    sets = kept_table(element_sets(docs, wanted), "element-sets")

    to_leader = led.filter(F.col("node") != F.col("leader")).select(F.col("leader").alias("a"), F.col("node").alias("b"))
    tried = kept_table(verified(kept_table(to_leader.distinct(), "tried-pairs"), sets, least), "tried-links")
    links = tried.filter("similar").select("a", "b")
    parts = members.join(components(links), "node", "left").withColumn("part", F.coalesce("component", "node"))
    parts = kept_table(parts.drop("component"), "bucket-parts")
    apart = compared_blocks(kept_table(open_members(parts), "open-members"), parts, sets, least, spanning=True)
    return links.unionByName(kept_table(apart, "last-links"))


def grouped(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """``doc_id``, ``group_id`` (the smallest id of its group), ``kept`` and the text's ``digest``, for every row."""
    rows = kept_table(signed(docs), "signed")
    known = rows.filter(F.col("doc_id").isNotNull() & F.col("bands").isNotNull())
    # Ids name no class, as one may stand on different texts; a number is fixed once it is written.
    texts = known.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    classes = kept_table(texts.withColumn("node", F.monotonically_increasing_id()), "text-classes")
    links = kept_table(similar_links(docs, classes, least), "similar-links")
    united = kept_table(classes.join(components(links), "node").select("digest", "first_id", "component"), "united-texts")
    chiefs = united.groupBy("component").agg(F.min(F.struct("first_id", "digest")).alias("chief"))
    alone = classes.join(united.select("digest"), "digest", "left_anti")
    of_text = (
        united.join(chiefs, "component")
        .select("digest", "chief")
        .unionByName(alone.select("digest", F.struct("first_id", "digest").alias("chief")))
        .select(F.col("digest").alias("of_digest"), F.col("chief.first_id").alias("group"), F.col("chief.digest").alias("kept_digest"))
    )
    own: Column = F.col("doc_id")
    in_group = F.col("doc_id").isNotNull() & F.col("bands").isNotNull()
    joined = rows.join(of_text, F.when(in_group, F.col("digest")) == F.col("of_digest"), "left")
    group = F.when(in_group, F.col("group")).otherwise(own)
    kept = F.when(in_group, (own == F.col("group")) & (F.col("digest") == F.col("kept_digest"))).otherwise(True)
    return joined.select("doc_id", group.alias("group_id"), kept.alias("kept"), "digest")


def near_duplicates(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    return grouped(docs, least).select("doc_id", "group_id", "kept")


def one_of_each(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """The documents of which one stays per group, with all their columns.

    Of rows that repeat a kept id and text one stays; rows without an id all stay.
    """
    found = kept_table(grouped(docs, least), "grouped")
    stays = found.filter("kept").groupBy("doc_id", "digest").agg(F.count("*").alias("rows"))
    rows = packed(docs).select(
        "row", F.col("doc_id").alias("id"), F.md5(F.col("text").cast("string").cast("binary")).alias("text_digest")
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("text_digest").eqNullSafe(F.col("digest"))
    kept = rows.join(stays, same)
    once = kept.filter((F.col("rows") == 1) | F.col("id").isNull())
    again = kept.filter((F.col("rows") > 1) & F.col("id").isNotNull()).dropDuplicates(["id", "text_digest"])
    return once.unionByName(again).select("row.*")


_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_CAPITALS}', '{_SMALL}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), runs AS (
  SELECT doc_id, unnest(CASE WHEN len(w) < {RUN_WORDS} THEN [array_to_string(w, ' ')] ELSE list_transform(
    range(1, len(w) - {RUN_WORDS - 2}), lambda i: array_to_string(w[i : i + {RUN_WORDS - 1}], ' ')) END) AS run
  FROM w WHERE len(w) > 0
), weighed AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL
), sizes AS (SELECT doc_id, sum(n) AS size FROM weighed GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS m
  FROM weighed a JOIN weighed b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE m >= {LEAST_SIMILARITY} * (x.size + y.size - m)
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), groups AS (SELECT id, min(other) AS group_id FROM reach GROUP BY id)
SELECT d.doc_id, g.group_id, d.doc_id = g.group_id AS kept FROM documents d JOIN groups g ON g.id = d.doc_id
"""
