"""Near-duplicate vectors by sorted projection passes and an exact comparison of what they leave apart.

Equal vectors are one class first. In each pass the classes are ordered
lexicographically by the concatenated signs of random projections, and every vector is
compared with the next ones of a bounded window: similar vectors share long runs of
signs, so they come to lie close in some pass. Pairs are verified by their cosine in
double precision, and each vector passes on its nearest verified pair on either side; these
chains of all passes are united to components.

A window sees only part of a large group, and a pair that no window meets may be joined
by no chain. So the passes only shorten what follows, which is exact: vectors are dealt to the
cells of pivots and these to units of bounded size, and every vector is compared with all units
whose cell may hold one within reach, by the angles to the pivots. Of the links found
there, those between two components are added, once per pair of components and units.
Without structure that the angles can use this compares all pairs, in blocks.

Then whatever a vector is linked to lies in its component, so all vectors of a component are
compared in square blocks, and links are counted. Blocks of a large component are separate
groups; nothing but counts leaves them.

Windows end with their partition. Partitions are ranges that differ from pass to
pass, so what one pass cuts the others compare.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite
components link with nothing and are components of their own. Rows that repeat an id
are vectors of their own: each is compared, has its links and its component, and rows of one id
may lie in different ones. Rows without an id link with nothing, have no component
and are kept. Vectors of different lengths never link. An empty table has no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.graph import components
from tallymart.llm.tables import kept_table

LEAST_COSINE = 0.9
PASSES = 16
WINDOW = 256
# Signs per pass. Ten billion vectors fill 33 of them.
SIGNS = 48
BLOCK = 1024
# Vectors of a unit: more of them as vectors grow in number, as each is sent to all units near it.
LEAST_UNIT, MOST_UNIT, UNITS = 8192, 65536, 64
# Stands behind the bytes of a vector of floats.
FLOATS = b"f"
MAX_PIVOTS = 1024
# Against the rounding of products and of arc cosines.
PRODUCT_SLACK, ANGLE_SLACK = 1e-9, 1e-6
SEED = 97


def is_sound() -> Column:
    """Whether a row has an id and a vector of finite numbers that are not all zero."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & some, F.lit(False))


def packed_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` as bytes, for every sound row.

    Where the table holds floats, vectors are moved as such, with one byte behind them that
    tells so; all arithmetic is in double precision either way.
    """
    short = dict(embeddings.dtypes)["embedding"] == "array<float>"
    rows = embeddings.filter(is_sound()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Adding 0 makes the two zeros one.
            vectors = [np.asarray(x.values) + 0.0 for x in batch.column("embedding")]
            vectors = [x.astype(np.float32).tobytes() + FLOATS if short else x.tobytes() for x in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(vectors, pa.binary())], names=["vec_id", "vector"]
            )

    return rows.mapInArrow(pack, "vec_id long, vector binary")


def unit_matrix(vectors: list[bytes]) -> np.ndarray:
    """Vectors of one length as unit rows in double precision; scaled first, against overflow."""
    rows = np.frombuffer(b"".join(vectors), np.uint8).reshape(len(vectors), -1)
    if rows.shape[1] % 4:
        rows = np.ascontiguousarray(rows[:, :-1]).view(np.float32).astype(np.float64)
    else:
        rows = rows.view(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def components_in(length: int) -> int:
    """The components of a vector of so many bytes."""
    return length // 4 if length % 4 else length // 8


def by_length(vectors: list[bytes]) -> Iterator[np.ndarray]:
    """Row numbers of vectors of equal length."""
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths):
        yield np.flatnonzero(lengths == length)


def signed_keys(vectors: list[bytes], passes: int, signs: int, seed: int = SEED) -> np.ndarray:
    """(vectors, passes): the concatenated signs of random projections, as numbers in their order."""
    keys = np.zeros((len(vectors), passes), np.int64)
    weights = 1 << np.arange(signs - 1, -1, -1, dtype=np.int64)
    for rows in by_length(vectors):
        unit = unit_matrix([vectors[r] for r in rows])
        for k in range(passes):
            directions = np.random.default_rng([seed, k, unit.shape[1]]).standard_normal((unit.shape[1], signs))
            keys[rows, k] = ((unit @ directions) > 0) @ weights
    return keys


def projected(classes: DataFrame, passes: int = PASSES, signs: int = SIGNS) -> DataFrame:
    """Every class once per pass: ``pass``, ``signs``, ``node`` and ``vector``."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = signed_keys(batch.column("vector").to_pylist(), passes, signs)
            for k in range(passes):
                numbers = pa.array(np.full(batch.num_rows, k), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [numbers, pa.array(keys[:, k]), batch.column("node"), batch.column("vector")],
                    names=["pass", "signs", "node", "vector"],
                )

    return classes.select("node", "vector").mapInArrow(project, "pass int, signs long, node long, vector binary")


def window_links(nodes: np.ndarray, vectors: list[bytes], first: int, window: int, least: float) -> list[tuple[int, int]]:
    """Verified pairs of rows and the ``window`` rows behind them, for pairs that end at ``first`` or later.

    Of each row the nearest on either side: what several rows share, they pass on from one to the next.
    """
    found = []
    for rows in by_length(vectors):
        unit = unit_matrix([vectors[r] for r in rows])
        step = 2 * window
        for start in range(0, len(rows), step):
            left, right = rows[start : start + step], rows[start : start + step + window]
            cosines = unit[start : start + step] @ unit[start : start + step + window].T
            a, b = np.nonzero(cosines >= least)
            near = (right[b] > left[a]) & (right[b] - left[a] <= window) & (right[b] >= first)
            a, b = left[a[near]], right[b[near]]
            # Pairs come in order of a, then b: the first of an a is its nearest, as is the last of a b.
            order = np.argsort(b, kind="stable")
            ahead = np.append(True, a[1:] != a[:-1])[: len(a)]
            behind = np.zeros(len(b), bool)
            behind[order] = np.append(b[order][1:] != b[order][:-1], True)[: len(b)]
            chain = ahead | behind
            found += zip(nodes[a[chain]].tolist(), nodes[b[chain]].tolist(), strict=True)
    return found


def pass_links(
    classes: DataFrame, passes: int = PASSES, window: int = WINDOW, signs: int = SIGNS, least: float = LEAST_COSINE
) -> DataFrame:
    """Verified pairs ``a``, ``b`` of all passes."""
    rows = projected(classes, passes, signs)
    # Ranges over the signs and a hash split even a run of equal signs over many tasks.
    tie = F.xxhash64("node", "pass")
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        rows.withColumn("tie", tie)
        .repartitionByRange(parts, "pass", "signs", "tie")
        .sortWithinPartitions("pass", "signs", "tie")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_pass, held_nodes, held_vectors = None, np.zeros(0, np.int64), []
        for batch in batches:
            numbers = batch.column("pass").to_numpy()
            for k in np.unique(numbers):
                part = batch.filter(pa.array(numbers == k))
                if held_pass != k:
                    held_pass, held_nodes, held_vectors = k, np.zeros(0, np.int64), []
                nodes = np.concatenate([held_nodes, part.column("node").to_numpy()])
                vectors = held_vectors + part.column("vector").to_pylist()
                links = window_links(nodes, vectors, len(held_nodes), window, least)
                if links:
                    a, b = (pa.array(x, pa.int64()) for x in zip(*links, strict=True))
                    yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])
                held_nodes, held_vectors = nodes[-window:], vectors[-window:]

    return ordered.select("pass", "node", "vector").mapInArrow(compare, "a long, b long").distinct()


def angles(products: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(products, -1, 1))


@dataclass
class Cells:
    """Cells of the vectors of one length, by their nearest pivot."""

    pivots: np.ndarray
    # Per cell: the number of its vectors, their smallest and largest angle to the pivot, its units and the first of them.
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    units: np.ndarray
    first: np.ndarray

    def near(self, unit: np.ndarray, cell: np.ndarray, least: float) -> np.ndarray:
        """(vectors, cells): whether a cell may hold a vector within reach of each of the given ones, which are in ``cell``.

        What lies within the angle t of x has an angle to any pivot that differs by t at most. And the
        border of the cells of the pivots p and c is the plane at right angles to p - c, from which x
        in the cell of p lies ``arcsin((p - c).x / |p - c|)`` away.
        """
        reach = np.arccos(min(1.0, max(-1.0, least)))
        products = unit @ self.pivots.T
        angle = angles(products)
        near = (angle <= self.high + reach + ANGLE_SLACK) & (angle >= self.low - reach - ANGLE_SLACK) & (self.rows > 0)
        if least >= 0:
            apart = np.linalg.norm(self.pivots[:, None] - self.pivots, axis=2)
            ahead = products[np.arange(len(unit)), cell][:, None] - products
            near &= ahead <= apart[cell] * np.sin(reach) + PRODUCT_SLACK
        # Its own cell, whatever the rounding.
        near[np.arange(len(unit)), cell] = True
        return near


def choose_pivots(classes: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Pivots by the length of vectors in bytes: vectors with the smallest hash of their node."""
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(count).select("vector").toArrow()
    vectors = sample.column("vector").to_pylist()
    return {len(vectors[rows[0]]): unit_matrix([vectors[r] for r in rows]) for rows in by_length(vectors)} if vectors else {}


def placed(parts: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Every vector with its cell and its angle to the pivot; lengths without a pivot are a cell each, around nothing."""
    shared = parts.sparkSession.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector").to_pylist()
            cell, angle = np.zeros(len(vectors), np.int32), np.zeros(len(vectors))
            for rows in by_length(vectors):
                around = shared.value.get(len(vectors[rows[0]]))
                if around is not None:
                    products = unit_matrix([vectors[r] for r in rows]) @ around.T
                    cell[rows] = products.argmax(axis=1)
                    angle[rows] = angles(products.max(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(angle)], names=["node", "part", "vector", "cell", "angle"]
            )

    return parts.select("node", "part", "vector").mapInArrow(
        place, "node long, part long, vector binary, cell int, angle double"
    )


def cells_of(rows: DataFrame, pivots: dict[int, np.ndarray], unit_rows: int) -> dict[int, Cells]:
    """The cells by the length of vectors in bytes, from one summary per cell."""
    summary = rows.groupBy(F.octet_length("vector").alias("length"), "cell").agg(
        F.count("*").alias("rows"), F.min("angle").alias("low"), F.max("angle").alias("high")
    )
    cells, first = {}, 0
    for length, group in summary.toPandas().sort_values(["length", "cell"]).groupby("length"):
        around = pivots.get(int(length), np.zeros((1, components_in(int(length)))))
        counts, low, high = np.zeros(len(around), np.int64), np.zeros(len(around)), np.zeros(len(around))
        counts[group.cell], low[group.cell], high[group.cell] = group.rows, group.low, group.high
        units = -(-counts // unit_rows)
        cells[int(length)] = Cells(around, counts, low, high, units, first + np.cumsum(units) - units)
        first += int(units.sum())
    return cells


def left_out_links(parts: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """Pairs ``a``, ``b`` of different parts that hold vectors within reach of each other, of all ``node``, ``part``, ``vector``."""
    total = parts.count()
    unit_rows = max(LEAST_UNIT, min(MOST_UNIT, total // UNITS))
    pivots = choose_pivots(parts, max(1, min(MAX_PIVOTS, total // (2 * unit_rows))))
    rows = kept_table(placed(parts, pivots), "vector-cells")
    shared = parts.sparkSession.sparkContext.broadcast(cells_of(rows, pivots, unit_rows))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once per unit it must meet; two units meet under the smaller number first."""
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector").to_pylist()
            place, cell = batch.column("place").to_numpy(), batch.column("cell").to_numpy()
            for of_length in by_length(vectors):
                cells = shared.value[len(vectors[of_length[0]])]
                mine = cell[of_length]
                own = cells.first[mine] + place[of_length] % cells.units[mine]
                near = cells.near(unit_matrix([vectors[r] for r in of_length]), mine, least)
                for c in np.flatnonzero(near.any(axis=0)):
                    chosen = np.flatnonzero(near[:, c])
                    sent = batch.select(["node", "part", "vector"]).take(pa.array(of_length[chosen]))
                    for unit in range(cells.first[c], cells.first[c] + cells.units[c]):
                        i, j = np.minimum(own[chosen], unit), np.maximum(own[chosen], unit)
                        arrays = [pa.array(i), pa.array(j), pa.array(own[chosen] == i), *sent.columns]
                        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "is_left", "node", "part", "vector"])

    def compare(group: pa.Table) -> pa.Table:
        is_left, part = group.column("is_left").to_numpy(), group.column("part").to_numpy()
        left = np.flatnonzero(is_left)
        # A unit meets itself with one side only.
        right = left if group.column("i")[0] == group.column("j")[0] else np.flatnonzero(~is_left)
        pairs = np.zeros((0, 2), np.int64)
        if len(left) and len(right):
            unit = unit_matrix(group.column("vector").to_pylist())
            others, of_others = unit[right], part[right]
            for start in range(0, len(left), BLOCK):
                rows = left[start : start + BLOCK]
                for behind in range(0, len(right), LEAST_UNIT):
                    a, b = np.nonzero(unit[rows] @ others[behind : behind + LEAST_UNIT].T >= least)
                    a, b = part[rows][a], of_others[behind : behind + LEAST_UNIT][b]
                    apart = a != b
                    found = np.stack([np.minimum(a, b)[apart], np.maximum(a, b)[apart]], axis=1)
                    if len(found):
                        pairs = np.unique(np.concatenate([pairs, found]), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    place = F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(2**31))
    dealt = rows.select("node", "part", "vector", "cell", place.alias("place")).mapInArrow(
        deal, "i long, j long, is_left boolean, node long, part long, vector binary"
    )
    return dealt.groupBy("i", "j").applyInArrow(compare, "a long, b long").distinct()


def linked_counts(members: DataFrame, least: float = LEAST_COSINE, block: int = BLOCK) -> DataFrame:
    """Per ``node`` of a component: how many vectors lie within reach, itself and its equals included.

    ``members`` has ``component``, ``node``, ``vector`` and ``copies``. Components up to the block
    size share groups; a larger one is cut into blocks, and each pair of blocks is a group.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    total = members.count()
    bins = 1 + total // block
    cut = F.col("size") > block
    blocks = F.when(cut, F.ceil(F.col("size") / F.lit(block))).otherwise(1).cast("int")
    rows = (
        members.join(sizes, "component")
        .withColumn("blocks", blocks)
        # A negative number stands for a group of small components.
        .withColumn("group", F.when(cut, F.col("component")).otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(bins))))
        .withColumn("big", cut)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    # A block meets every block, as the left side of its row and the right side of its column.
    left = rows.withColumn("i", F.col("own")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = rows.withColumn("j", F.col("own")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = ["big", "group", "i", "j"]
    needed = [*key, "component", "node", "vector", "copies"]

    def count(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        reach = np.zeros(len(a), np.int64)
        if len(a) and len(b):
            for mine in by_length(a.vector.tolist()):
                other = np.flatnonzero(b.vector.str.len() == len(a.vector.iloc[mine[0]]))
                if not len(other):
                    continue
                unit = unit_matrix(b.vector.iloc[other].tolist())
                groups, copies = b.component.to_numpy()[other], b.copies.to_numpy()[other]
                for start in range(0, len(mine), block):
                    part = mine[start : start + block]
                    near = (unit_matrix(a.vector.iloc[part].tolist()) @ unit.T) >= least
                    near &= a.component.to_numpy()[part][:, None] == groups
                    # A vector reaches itself, whatever its rounding.
                    near |= a.node.to_numpy()[part][:, None] == b.node.to_numpy()[other]
                    reach[part] = near @ copies
        return pd.DataFrame({"node": a.node, "reach": reach})

    # New names for one side of the two, which come from the same rows.
    other_side = right.select(*(F.col(name).alias(name) for name in needed))
    counted = (
        left.select(*needed)
        .groupBy(*key)
        .cogroup(other_side.groupBy(*key))
        .applyInPandas(count, "node long, reach long")
    )
    return counted.groupBy("node").agg(F.sum("reach").alias("reach"))


def near_duplicates(
    embeddings: DataFrame, least: float = LEAST_COSINE, passes: int = PASSES, window: int = WINDOW
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row."""
    sound = kept_table(packed_vectors(embeddings), "vectors")
    # Equal vectors are a class. Ids name no class, as one may stand on different vectors.
    classes = sound.groupBy("vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = kept_table(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    links = kept_table(pass_links(classes, passes, window, SIGNS, least), "vector-links")
    found = kept_table(components(links), "vector-components")
    parts = classes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("part"), "vector")
    left_out = kept_table(left_out_links(kept_table(parts, "vector-parts"), least), "vector-links-left-out")
    if not left_out.isEmpty():
        stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = kept_table(components(stars.unionByName(left_out)), "vector-components-joined")
    members = kept_table(classes.join(found, "node"), "vector-members")
    counts = linked_counts(members.select("component", "node", "vector", "copies"), least)
    smallest = members.groupBy("component").agg(F.min("first_id").alias("least_id"))
    of_class = (
        classes.select("vector", "node", "copies", "first_id")
        .join(found, "node", "left")
        .join(smallest, "component", "left")
        .join(counts, "node", "left")
        .select(
            "vector",
            F.coalesce("least_id", "first_id").alias("component_id"),
            (F.coalesce("reach", "copies") - 1).cast("long").alias("n_links"),
        )
    )
    linked = sound.join(of_class, "vector").select("vec_id", "n_links", "component_id")
    own = F.col("vec_id").cast("long")
    alone = embeddings.filter(~is_sound()).select(
        own.alias("vec_id"), F.lit(0).cast("long").alias("n_links"), own.alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return linked.unionByName(alone).withColumn("kept", kept)


ORACLE = f"""
WITH RECURSIVE rows AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
v AS MATERIALIZED (
  SELECT r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM rows
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {LEAST_COSINE}
), reach(id, other) AS (
  SELECT r, r FROM rows
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), components AS (SELECT id, min(vec_id) AS component_id FROM reach JOIN rows ON r = other GROUP BY id)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, coalesce(e.vec_id = c.component_id, true) AS kept
FROM rows e JOIN components c ON c.id = e.r
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = e.r
"""
