"""Merkle manifest of a dataset, with proofs, by a tree of SHA-256 midstates.

Every document is a leaf. Per source the leaves ascend by id; three consecutive nodes
become their parent until one remains, the source's subroot, and the subroots in order of
their sources become the root in the same way. A parent keeps the hash state before
each of its child slots. Folding a leaf to the root resumes the state before its slot
with the replacement and the siblings right of it only; what lies left of it is in the state.

Trees are cut into blocks of ``FAN_OUT ** LEVELS_PER_BLOCK`` consecutive nodes. Blocks are dealt
over all tasks whatever their source, their roots are the nodes of the next tier, and
states above a block travel to its leaves as a path, so no task sees more than a few blocks.

Defined results: NULL fields are hashed as ``-``. Documents without an id come first, and
their id counts as the empty text where its remainder decides on tampering. Rows with equal ids
ascend by leaf; equal rows are leaves of their own. Documents without a source are a source,
the first. A very long text is hashed whole within its row. An empty table has
no rows. Columns other than doc_id, source, lang, n_chars and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm import sha_states as sha
from tallymart.llm.tables import fold_number, kept_table

FAN_OUT = 3
LEVELS_PER_BLOCK = 7
# Nodes hashed together; blocks are taken until there are as many.
NODES_PER_STEP = 8192
# Words of one level of a path: slot, number of children, state before the slot, children.
LEVEL_WORDS = 2 + 8 + 8 * FAN_OUT
ENDINGS = sha.endings(FAN_OUT)

NODE = "g long, pos long, n long, digest binary"
PATH = "g long, pos long, path binary, subroot binary, root binary"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    """The digest of a document's fields, with a given text."""
    fields = [field(F.col(name)) for name in ("doc_id", "source", "lang", "n_chars")]
    return F.unhex(F.sha2(F.concat(*fields, field(text)), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """Source, id, leaf and, where tampering changes it, the tampered leaf of every document."""
    text = F.col("text").cast("string")
    tampered = (fold_number("doc_id", 2) == 0) & text.contains("\n")
    rows = docs.select(
        F.col("source").cast("string").alias("source"),
        "doc_id",
        leaf_of(text).alias("leaf"),
        F.when(tampered, leaf_of(F.replace(text, F.lit("\n"), F.lit("")))).alias("tampered"),
    )
    return kept_table(rows, "leaves")


def numbered(rows: DataFrame) -> DataFrame:
    """Leaves with ``g``, the number of their source, ``pos`` within it, and ``n``, its leaves.

    Rows are put in order by ranges, so a large source spans many tasks; each range
    counts its sources, and offsets come from these counts. Equal rows differ by their place in
    the stored table alone, so that many of them are spread too.
    """
    order = ["source", "doc_id", "leaf", "_tie"]
    sorted_rows = kept_table(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("_at", 33)
    parts = sorted_rows.groupBy(F.col("source").alias("_source"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    of_source = Window.partitionBy("_source")
    before = of_source.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "*",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(of_source).alias("n"),
        F.min("_part").over(of_source).alias("_home"),
    )
    # A source counts in the range it begins in; there are no more totals than ranges.
    homes = parts.filter(F.col("_part") == F.col("_home"))
    totals = homes.groupBy("_home").agg(F.count("*").alias("_sources"))
    earlier = Window.orderBy("_home").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_home", F.coalesce(F.sum("_sources").over(earlier), F.lit(0)).alias("_earlier"))
    within = Window.partitionBy("_home").orderBy("_source")
    numbers = homes.select("_source", "_home", (F.row_number().over(within) - 1).alias("_within")).join(totals, "_home")
    numbers = numbers.select(F.col("_source").alias("_named"), (F.col("_earlier") + F.col("_within")).alias("g"))
    parts = kept_table(
        parts.join(numbers, F.col("_source").eqNullSafe(F.col("_named"))).drop("_named", "_home", "_rows"), "sources"
    )
    same = (part == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    return sorted_rows.join(parts, same).select(
        "g", (F.col("_before") + F.col("_at") - F.col("_first")).alias("pos"), "n", "doc_id", "leaf", "tampered"
    )


@dataclass
class Layer:
    """Parents of one level over the nodes that are still below their root.

    ``node`` has for each node of the level its place among those, or -1; ``parent`` and
    ``slot`` are by these places. ``states`` are the hash states before each child slot.
    """

    node: np.ndarray
    parent: np.ndarray
    slot: np.ndarray
    count: np.ndarray
    children: np.ndarray
    states: np.ndarray


def grow(digests: np.ndarray, group: np.ndarray, pos: np.ndarray, levels: np.ndarray) -> tuple[list[Layer], np.ndarray]:
    """Layers of the trees of several groups, and the root of each; nodes are in order of group and place."""
    layers: list[Layer] = []
    roots = np.zeros((8, len(levels)), np.uint32)
    while True:
        kept = levels[group] > len(layers)
        roots[:, group[~kept]] = digests[:, ~kept]
        if not kept.any():
            return layers, roots
        node = np.where(kept, np.cumsum(kept) - 1, -1)
        digests, group, pos = digests[:, kept], group[kept], pos[kept]
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (pos[1:] // FAN_OUT != pos[:-1] // FAN_OUT)
        parent, slot = np.cumsum(new) - 1, pos % FAN_OUT
        count = np.bincount(parent)
        children = np.zeros((8, FAN_OUT, len(count)), np.uint32)
        children[:, slot, parent] = digests
        states = np.empty((8, FAN_OUT, len(count)), np.uint32)
        final = np.empty((8, len(count)), np.uint32)
        state = np.broadcast_to(sha.START, final.shape)
        for k in range(FAN_OUT):
            states[:, k] = state
            state = sha.resume(state, sha.hex_block(children[:, k]))
            ends = count == k + 1
            final[:, ends] = state[:, ends]
        layers.append(Layer(node, parent, slot, count, children, states))
        digests, group, pos = sha.resume(final, ENDINGS[:, count]), group[new], pos[new] // FAN_OUT


class Fold:
    """Leaves on their way to the root, and the digests of their siblings so far."""

    def __init__(self, replacement: np.ndarray) -> None:
        self.value = replacement.copy()
        self.proof = np.repeat(sha.START, replacement.shape[1], axis=1)
        self.siblings = np.zeros(replacement.shape[1], np.int64)

    def step(self, rows: np.ndarray, slot: np.ndarray, count: np.ndarray, state: np.ndarray, children: np.ndarray) -> None:
        """One level up for some leaves: the state before the slot, the replacement, the siblings right of it."""
        state = sha.resume(state, sha.hex_block(self.value[:, rows]))
        for k in range(1, FAN_OUT):
            right = (slot < k) & (k < count)
            if right.any():
                state[:, right] = sha.resume(state[:, right], sha.hex_block(children[:, k, right]))
        self.value[:, rows] = sha.resume(state, ENDINGS[:, count])
        for k in range(FAN_OUT):
            other = (slot != k) & (k < count)
            if other.any():
                at = rows[other]
                self.proof[:, at] = sha.resume(self.proof[:, at], sha.hex_block(children[:, k, other]))
                self.siblings[at] += 1

    def proofs(self) -> np.ndarray:
        most = int(self.siblings.max(initial=0))
        return sha.resume(self.proof, sha.endings(most)[:, self.siblings])


def climb(layers: list[Layer], nodes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each layer: the leaves below it, and slot, number of children, state and children on their way."""
    rows, at = np.arange(nodes), np.arange(nodes)
    for layer in layers:
        inside = layer.node[at]
        rows, inside = rows[inside >= 0], inside[inside >= 0]
        parent, slot = layer.parent[inside], layer.slot[inside]
        yield rows, slot, layer.count[parent], layer.states[:, slot, parent], layer.children[:, :, parent]
        at = parent


@dataclass
class Blocks:
    """Some whole blocks: their nodes in order, and a row for each block."""

    nodes: pa.Table
    group: np.ndarray
    pos: np.ndarray
    levels: np.ndarray
    heads: pa.Table
    paths: pa.Table

    def grow(self, digests: np.ndarray) -> tuple[list[Layer], np.ndarray]:
        return grow(digests, self.group, self.pos, self.levels)

    def upper(self) -> tuple[np.ndarray, np.ndarray]:
        """The levels above each block, padded to the most, and how many there are."""
        raw = [np.frombuffer(path or b"", "<u4") for path in self.paths.column("path").to_pylist()]
        depth = np.array([len(x) // LEVEL_WORDS for x in raw], np.int64)
        levels = np.zeros((len(raw), int(depth.max(initial=0)), LEVEL_WORDS), np.uint32)
        for k, x in enumerate(raw):
            levels[k, : depth[k]] = x.reshape(-1, LEVEL_WORDS)
        return levels, depth


def levels_of(n: np.ndarray, most: int) -> np.ndarray:
    """Levels of a block in a tree of ``n`` nodes: all, or as many as leave one node."""
    return np.searchsorted(FAN_OUT ** np.arange(most), n)


def whole_blocks(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[Blocks]:
    """Sorted rows cut at borders of blocks, some blocks together. A block's path, if any, comes first."""

    def cut(rows: pa.Table) -> Blocks:
        is_path = rows.column("kind").to_numpy() == 0
        nodes, paths = rows.filter(pa.array(~is_path)), rows.filter(pa.array(is_path))
        g, block = nodes.column("g").to_numpy(), nodes.column("block").to_numpy()
        first = np.ones(len(g), bool)
        first[1:] = (g[1:] != g[:-1]) | (block[1:] != block[:-1])
        heads = nodes.filter(pa.array(first))
        pos = nodes.column("pos").to_numpy() - block * FAN_OUT**levels
        return Blocks(nodes, np.cumsum(first) - 1, pos, levels_of(heads.column("n").to_numpy(), levels), heads, paths)

    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        if held.num_rows < NODES_PER_STEP:
            continue
        held = held.combine_chunks()
        g, block = held.column("g").to_numpy(), held.column("block").to_numpy()
        border = np.flatnonzero((g[1:] != g[:-1]) | (block[1:] != block[:-1]))
        if len(border):
            end = int(border[-1]) + 1
            yield cut(held.slice(0, end))
            held = held.slice(end)
    if held is not None and held.num_rows:
        yield cut(held.combine_chunks())


def in_blocks(
    nodes: DataFrame, paths: DataFrame | None, levels: int, work: Callable[[Blocks], pa.RecordBatch], schema: str
) -> DataFrame:
    """Deal blocks, each with its path, over tasks; a block has a bounded number of nodes."""
    block = F.expr(f"pos div {FAN_OUT**levels}")
    rows = nodes.withColumns({"kind": F.lit(1), "block": block})
    if paths is not None:
        heads = paths.select("g", F.col("pos").alias("block"), "path", "subroot", "root", F.lit(0).alias("kind"))
        rows = rows.unionByName(heads, allowMissingColumns=True)
    rows = rows.repartition("g", "block").sortWithinPartitions("g", "block", "kind", "pos")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in whole_blocks(batches, levels):
            yield work(blocks)

    return rows.mapInArrow(task, schema)


def block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """The next tier: one node for each block of nodes."""

    def work(blocks: Blocks) -> pa.RecordBatch:
        _, roots = blocks.grow(sha.from_binary(blocks.nodes.column("digest")))
        n = blocks.heads.column("n").to_numpy()
        columns = [
            blocks.heads.column("g").combine_chunks(),
            blocks.heads.column("block").combine_chunks(),
            pa.array(-(-n // FAN_OUT**levels)),
            sha.to_binary(roots),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["g", "pos", "n", "digest"])

    return in_blocks(nodes, None, levels, work, NODE)


def tiers(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes, their blocks' roots, and so on until every tree has one node."""
    found = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        found.append(kept_table(block_roots(found[-1], levels), "blocks"))
        most = -(-most // FAN_OUT**levels)
        if most <= 1:
            return found


def node_paths(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """The path from every node to the root: the levels within its block, then those of the block."""

    def work(blocks: Blocks) -> pa.RecordBatch:
        digests = sha.from_binary(blocks.nodes.column("digest"))
        layers, _ = blocks.grow(digests)
        own = [[] for _ in range(len(blocks.group))]
        for rows, slot, count, state, children in climb(layers, len(own)):
            words = np.concatenate([slot[None], count[None], state, children.transpose(1, 0, 2).reshape(-1, len(rows))])
            for row, level in zip(rows.tolist(), words.T.astype("<u4"), strict=True):
                own[row].append(level.tobytes())
        heads = blocks.paths.column("path").to_pylist()
        path = [b"".join([*own[i], heads[k]]) for i, k in enumerate(blocks.group.tolist())]
        columns = [blocks.nodes.column("g"), blocks.nodes.column("pos"), pa.array(path, pa.binary())]
        roots = [blocks.paths.column(name).take(pa.array(blocks.group)) for name in ("subroot", "root")]
        columns = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in [*columns, *roots]]
        return pa.RecordBatch.from_arrays(columns, names=["g", "pos", "path", "subroot", "root"])

    return in_blocks(nodes, above, levels, work, PATH)


def tree_paths(tree: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """Paths of the blocks of a tree's lowest tier, from those of its root."""
    paths = above
    for nodes in reversed(tree[1:-1]):
        paths = kept_table(node_paths(nodes, paths, levels), "paths")
    return paths


def folded(rows: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """Every leaf with its proof's digest and the root that its replacement folds to."""

    def work(blocks: Blocks) -> pa.RecordBatch:
        digests = sha.from_binary(blocks.nodes.column("digest"))
        replacement = sha.from_binary(blocks.nodes.column("replacement"))
        layers, _ = blocks.grow(digests)
        fold = Fold(replacement)
        for step in climb(layers, digests.shape[1]):
            fold.step(*step)
        upper, depth = blocks.upper()
        for k in range(upper.shape[1]):
            at = np.flatnonzero(depth[blocks.group] > k)
            words = upper[blocks.group[at], k].T
            children = words[10:].reshape(FAN_OUT, 8, -1).transpose(1, 0, 2)
            fold.step(at, words[0].astype(np.int64), words[1].astype(np.int64), words[2:10], children)
        subroot, root = (sha.from_binary(blocks.paths.column(name))[:, blocks.group] for name in ("subroot", "root"))
        columns = [
            blocks.nodes.column("doc_id").combine_chunks(),
            *map(sha.to_hex, (digests, subroot, root, fold.proofs(), fold.value)),
            pa.array((fold.value == root).all(axis=0)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    nodes = rows.select(
        "g", "pos", "n", F.col("leaf").alias("digest"), F.coalesce("tampered", "leaf").alias("replacement"), "doc_id"
    )
    kind = dict(rows.dtypes)["doc_id"]
    strings = ", ".join(f"{name} string" for name in names[1:6])
    return in_blocks(nodes, paths, levels, work, f"doc_id {kind}, {strings}, verified boolean")


def manifest(docs: DataFrame, levels: int = LEVELS_PER_BLOCK) -> DataFrame:
    """One row per document: its leaf, subroot and root, its proof's digest, and what it folds to."""
    rows = numbered(leaves(docs))
    sources = tiers(rows.select("g", "pos", "n", F.col("leaf").alias("digest")), levels)
    subroots = sources[-1]
    n = subroots.count()
    if not n:
        return folded(rows, docs.sparkSession.createDataFrame([], PATH), levels)
    tops = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.lit(n).cast("long").alias("n"), "digest")
    whole = tiers(tops, levels)
    root = whole[-1].select(
        "g",
        F.lit(0).cast("long").alias("pos"),
        F.lit(b"").alias("path"),
        F.col("digest").alias("subroot"),
        F.col("digest").alias("root"),
    )
    of_sources = node_paths(tops, tree_paths(whole, root, levels), levels)
    above = of_sources.drop("g", "subroot").withColumnRenamed("pos", "g").join(
        subroots.select("g", F.col("digest").alias("subroot")), "g"
    )
    above = kept_table(above.select("g", F.lit(0).cast("long").alias("pos"), "path", "subroot", "root"), "paths")
    return folded(rows, tree_paths(sources, above, levels), levels)


def _field_sql(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(concat(strlen({text}), ':', {text}), '-')"


def _leaf_sql(text: str) -> str:
    fields = [_field_sql(name) for name in ("doc_id", "source", "lang", "n_chars")]
    return f"sha256({' || '.join([*fields, _field_sql(text)])})"


# The CRC-32 of a text of digits; 3988292384 and 4294967295 are the fixed values of that code.
_CRC_SQL = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, c: xor(crc >> 8, crc_bytes[1 + (xor(crc, c) & 255)])))"""

ORACLE = f"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc_bytes),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS r,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
          CASE WHEN {_CRC_SQL} & 1 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS replacement
        FROM documents CROSS JOIN crc)),
nodes AS (
  SELECT source, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3),
subroots AS MATERIALIZED (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 3),
folds AS (
  SELECT r, source, 0 AS level, pos, replacement AS value, '' AS proof FROM leaves
  UNION ALL
  SELECT r, f.source, f.level + 1, f.pos // 3,
    sha256(string_agg(CASE WHEN s.pos = f.pos THEN value ELSE s.digest END, '' ORDER BY s.pos)),
    proof || coalesce(string_agg(CASE WHEN s.pos <> f.pos THEN s.digest END, '' ORDER BY s.pos), '')
  FROM folds f JOIN nodes s ON s.source IS NOT DISTINCT FROM f.source AND s.level = f.level AND s.pos // 3 = f.pos // 3
  WHERE s.n > 1 GROUP BY r, f.source, f.level, f.pos, value, proof),
folded AS (
  SELECT r, 0 AS level, b.pos, b.subroot, f.value, f.proof
  FROM (SELECT r, source, max_by(value, level) AS value, max_by(proof, level) AS proof FROM folds GROUP BY r, source) f
  JOIN subroots b ON b.source IS NOT DISTINCT FROM f.source
  UNION ALL
  SELECT r, f.level + 1, f.pos // 3, subroot,
    sha256(string_agg(CASE WHEN s.pos = f.pos THEN value ELSE s.digest END, '' ORDER BY s.pos)),
    proof || coalesce(string_agg(CASE WHEN s.pos <> f.pos THEN s.digest END, '' ORDER BY s.pos), '')
  FROM folded f JOIN tops s ON s.level = f.level AND s.pos // 3 = f.pos // 3
  WHERE s.n > 1 GROUP BY r, f.level, f.pos, subroot, value, proof),
ends AS (
  SELECT r, any_value(subroot) AS subroot, max_by(value, level) AS value, max_by(proof, level) AS proof FROM folded GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, value AS folded_root, value = root AS verified
FROM leaves JOIN ends USING (r) CROSS JOIN (SELECT digest AS root FROM tops WHERE n = 1)"""
