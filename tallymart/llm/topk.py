"""Exact top-k search by inner product: a Voronoi join of queries and data.

Pivots cut the space into cells, and a summary of each cell of data is made: how far its
vectors lie from the pivot at most, and the smallest of these distances. By these, every query
knows bounds: an inner product with a data vector at distance d from the pivot c lies within
``q.c - |q| d`` and ``q.c + |q| d``. The lower bounds of all summaries give a score that the query
reaches k times whichever row it leaves out. Its most promising cell is searched first, which
gives the score of its k-th best row so far; then only those cells whose upper bound
reaches that score.

Cells are cut into blocks of bounded size, each in one place. Queries, which are few, are sent to
the blocks they need, and stream past the block's rows, so neither a large cell nor a popular one
is more than the work of its blocks, and data rows are moved once for each of the two
searches. Blocks return no row below a score that the query is known to reach k times.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite components take no part;
nor do rows without an id. Every row with a query's id asks for itself, and all rows but itself are its
candidates, equal and equally named ones included. Vectors of different lengths have no
inner product and do not meet. Ties go to the smaller id. Fewer candidates than k give fewer
rows, an empty table none. A product beyond 64 bits is an error. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.tables import kept_table

SCALE = 1024
K = 10
QUERY_EVERY = 100
# Rows that queries stream past together, and queries scored at once.
DATA_BLOCK, QUERY_BLOCK = 8192, 512
# Pivots are vectors of a bounded sample, one for so many rows.
ROWS_PER_PIVOT, MAX_PIVOTS = 1024, 1024

DATA = "row long, vec_id long, components int, vector binary"
PLACED = f"{DATA}, cell int, distance double, size double"
FOUND = "asker long, query_id long, vec_id long, score long"


def packed(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``row``, ``vec_id``, ``components`` and ``vector``, the components' ``floor(scale * x)`` in 4 bytes each, or 8 where needed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            lengths = np.diff(np.asarray(lists.offsets)) if len(lists) else np.zeros(0, np.int64)
            ends = np.cumsum(lengths)
            exact = np.floor(scale * flat)
            if np.abs(exact).max(initial=0) >= 2.0**63:
                raise OverflowError("a component is beyond 64 bits")
            numbers = exact.astype(np.int64)
            vectors = []
            for end, n in zip(ends.tolist(), lengths.tolist(), strict=True):
                vector = numbers[end - n : end]
                small = np.abs(vector).max() < 2**31 if n else True
                vectors.append(vector.astype(np.int32 if small else np.int64).tobytes())
            columns = [batch.column("row"), batch.column("vec_id"), pa.array(lengths, pa.int32()), pa.array(vectors, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "components", "vector"])

    return usable(embeddings).mapInArrow(pack, DATA)


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows with an id and a vector of finite numbers, as lists of doubles, numbered."""
    vector = F.col("embedding").cast("array<double>")
    infinite = float("inf")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    rows = embeddings.filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & sound
    )
    return rows.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding")
    )


def matrix(vectors: list[bytes], components: int) -> np.ndarray:
    """Packed vectors of one length as rows of integers."""
    if all(len(v) == 4 * components for v in vectors):
        return np.frombuffer(b"".join(vectors), np.int32).reshape(-1, components).astype(np.int64)
    rows = [np.frombuffer(v, np.int32 if len(v) == 4 * components else np.int64) for v in vectors]
    return np.array(rows, np.int64).reshape(-1, components)


def by_components(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each length of vectors and the rows that have it."""
    for n in np.unique(numbers).tolist():
        yield n, np.flatnonzero(numbers == n)


def choose_pivots(vectors: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Pivots by length: the vectors of the ``count`` rows with the smallest hash."""
    sample = vectors.orderBy(F.xxhash64("vec_id", "vector"), "vec_id", "vector").limit(count).select("components", "vector")
    found = sample.distinct().toArrow()
    listed = found.column("vector").to_pylist()
    lengths = found.column("components").to_numpy()
    return {n: np.unique(matrix([listed[r] for r in rows], n), axis=0).astype(np.float64) for n, rows in by_components(lengths)}


def nearest(pivots: np.ndarray | None, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell, distance to its pivot and length of each row; without a pivot the cell is one around nothing."""
    x = rows.astype(np.float64)
    sizes = np.sqrt((x**2).sum(axis=1))
    if pivots is None:
        return np.zeros(len(x), np.int64), sizes, sizes
    square = sizes[:, None] ** 2 - 2 * x @ pivots.T + (pivots**2).sum(axis=1)
    cell = square.argmin(axis=1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1)), sizes


def placed(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Every vector with its cell, its distance to the pivot and its length."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, distance, size = (np.zeros(batch.num_rows) for _ in range(3))
            listed = batch.column("vector").to_pylist()
            for n, rows in by_components(batch.column("components").to_numpy()):
                of = nearest(shared.value.get(n), matrix([listed[r] for r in rows], n))
                cell[rows], distance[rows], size[rows] = of
            arrays = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(distance), pa.array(size)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in PLACED.split(", ")])

    return vectors.mapInArrow(place, PLACED)


@dataclass
class Cells:
    """Summaries of the cells of vectors of one length, by the cell's number; bounded like the pivots."""

    pivots: np.ndarray
    radius: np.ndarray
    rows: np.ndarray
    # The distances of the k + 1 rows of each cell that lie nearest to the pivot, or infinite.
    near: np.ndarray

    def bounds(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries, cells): the highest product a cell can hold; and per query a score that k rows besides its own reach."""
        x = queries.astype(np.float64)
        sizes = np.sqrt((x**2).sum(axis=1))
        products = x @ self.pivots.T
        # A little wider than the bounds, against rounding.
        slack = 1e-9 * (1 + np.abs(products) + sizes[:, None] * np.minimum(self.radius, 1e300))
        high = np.where(self.rows > 0, products + sizes[:, None] * self.radius + slack, -np.inf)
        low = products[:, :, None] - sizes[:, None, None] * self.near - slack[:, :, None]
        low = np.where(np.isfinite(self.near), low, -np.inf).reshape(len(x), -1)
        if low.shape[1] <= k:
            return high, np.full(len(x), -np.inf)
        return high, np.partition(low, low.shape[1] - k - 1, axis=1)[:, -(k + 1)]


def summaries(rows: DataFrame, pivots: dict[int, np.ndarray], k: int) -> dict[int, Cells]:
    """Cells by length of vectors; k + 1 distances a cell, as a query may meet its own row."""
    order = Window.partitionBy("components", "cell").orderBy("distance")
    closest = rows.select("components", "cell", "distance").withColumn("nth", F.row_number().over(order))
    closest = closest.filter(F.col("nth") <= k + 1).toPandas()
    sizes = rows.groupBy("components", "cell").agg(F.max("distance").alias("radius"), F.count("*").alias("rows")).toPandas()
    cells = {}
    for n, group in sizes.groupby("components"):
        around = pivots.get(int(n), np.zeros((1, int(n))))
        one = Cells(around, np.zeros(len(around)), np.zeros(len(around), np.int64), np.full((len(around), k + 1), np.inf))
        one.radius[group.cell], one.rows[group.cell] = group.radius, group.rows
        mine = closest[closest.components == n]
        one.near[mine.cell, mine.nth - 1] = mine.distance
        cells[int(n)] = one
    return cells


def best(scores: np.ndarray, askers: np.ndarray, rows: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Query numbers and columns of each query's k best rows but its own, none below ``least``; equal scores in order of columns."""
    chosen = []
    for number, mine in enumerate(scores):
        found = np.flatnonzero((mine >= least[number]) & (rows != askers[number]))
        if len(found) > k:
            edge = np.partition(mine[found], len(found) - k)[len(found) - k]
            found = found[mine[found] >= edge]
        chosen.append(found[np.argsort(-mine[found], kind="stable")[:k]])
    counts = [len(c) for c in chosen]
    return np.repeat(np.arange(len(counts)), counts), np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integers: in floating point where every sum is exact there, else in 64-bit integers."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if largest < 2**63:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    if max(map(abs, exact.ravel()), default=0) >= 2**63:
        raise OverflowError("an inner product is beyond 64 bits")
    return exact.astype(np.int64)


def asks(queries: DataFrame, cells: dict[int, Cells], k: int, first: bool) -> DataFrame:
    """Each query once per cell it needs: its most promising one, or all others that its score so far leaves.

    ``least`` is a score that k rows are known to reach; before the first search by the summaries only.
    """
    shared = queries.sparkSession.sparkContext.broadcast(cells)
    names = ["row", "vec_id", "components", "vector", "cell", "least"]

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("vector").to_pylist()
            reached = batch.column("reached").to_numpy(zero_copy_only=False)
            for n, rows in by_components(batch.column("components").to_numpy()):
                if n not in shared.value:
                    continue
                for start in range(0, len(rows), QUERY_BLOCK):
                    part = rows[start : start + QUERY_BLOCK]
                    high, low = shared.value[n].bounds(matrix([listed[r] for r in part], n), k)
                    least = np.maximum(np.nan_to_num(reached[part], nan=-np.inf), low)
                    favourite = high.argmax(axis=1)
                    wanted = high >= least[:, None]
                    wanted[np.arange(len(part)), favourite] = False
                    if first:
                        wanted = np.zeros_like(wanted)
                        wanted[np.arange(len(part)), favourite] = True
                    wanted &= shared.value[n].rows > 0
                    query, cell = np.nonzero(wanted)
                    sent = batch.select(names[:4]).take(pa.array(part[query]))
                    arrays = [*sent.columns, pa.array(cell.astype(np.int32)), pa.array(least[query])]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return queries.select("row", "vec_id", "components", "vector", "reached").mapInArrow(
        needed, f"{DATA}, cell int, least double"
    )


def searched(rows: DataFrame, sizes: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """The k best rows of every block for every query that needs the block's cell."""
    key = ["components", "cell", "block"]
    blocks = sizes.select("components", "cell", F.ceil(F.col("rows") / F.lit(DATA_BLOCK)).cast("int").alias("blocks"))
    asked = blocks.join(asking.select("components", "cell").distinct(), ["components", "cell"])
    place: Column = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    data = rows.join(asked, ["components", "cell"]).select(
        *key[:2], place.alias("block"), F.lit(0).alias("kind"), "row", "vec_id", "vector", F.lit(None).cast("double").alias("least")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    queries = asking.join(asked, ["components", "cell"]).select(
        *key[:2], every.alias("block"), F.lit(1).alias("kind"), "row", "vec_id", "vector", "least"
    )
    together = data.unionByName(queries).repartition(*key).sortWithinPartitions(*key, "kind", "vec_id", "row")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, block = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(name).to_numpy() for name in (*key, "kind")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if begin == end:
                    continue
                part, now = batch.slice(begin, end - begin), tuple(marks[:3, begin].tolist())
                if now != held_key:
                    held_key, held, block = now, [], None
                if marks[3, begin] == 0:
                    # Rows that go on in the next batch come before the first query.
                    held.append(part)
                    continue
                if not held:
                    continue
                if block is None:
                    of_block = pa.Table.from_batches(held)
                    vectors = matrix(of_block.column("vector").to_pylist(), now[0])
                    block = vectors, of_block.column("row").to_numpy(), of_block.column("vec_id").to_numpy()
                for start in range(0, part.num_rows, QUERY_BLOCK):
                    yield answers(part.slice(start, QUERY_BLOCK), now[0], *block, k)

    return together.mapInArrow(solve, FOUND)


def answers(
    queries: pa.RecordBatch, components: int, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int
) -> pa.RecordBatch:
    """The best rows of one block, which is in order of ids, for some queries."""
    scores = inner_products(matrix(queries.column("vector").to_pylist(), components), vectors)
    askers = queries.column("row").to_numpy()
    number, column = best(scores, askers, rows, queries.column("least").to_numpy(), k)
    columns = [askers[number], queries.column("vec_id").to_numpy()[number], ids[column], scores[number, column]]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in FOUND.split(", ")])


def top_k(queries: DataFrame, data: DataFrame, k: int = K, rows_per_pivot: int = ROWS_PER_PIVOT) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k best rows of ``data``; queries are rows of ``data``, too."""
    pivots = choose_pivots(data, max(1, min(MAX_PIVOTS, data.count() // rows_per_pivot)))
    rows = kept_table(placed(data, pivots), "topk-data")
    sizes = kept_table(rows.groupBy("components", "cell").agg(F.count("*").alias("rows")), "topk-sizes")
    cells = summaries(rows, pivots, k)
    order = Window.partitionBy("asker").orderBy(F.col("score").desc(), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    fresh = queries.withColumn("reached", F.lit(None).cast("double"))
    asking = kept_table(asks(fresh, cells, k, True), "topk-first-asks")
    first = kept_table(ranked(searched(rows, sizes, asking, k)), "topk-first")
    reached = first.filter(F.col("rank") == k).select(F.col("asker").alias("row"), F.col("score").cast("double").alias("reached"))
    asking = kept_table(asks(queries.join(reached, "row", "left"), cells, k, False), "topk-asks")
    found = first.drop("rank").unionByName(searched(rows, sizes, asking, k))
    return ranked(found).select("query_id", "rank", "vec_id", "score")


def search(embeddings: DataFrame, every: int = QUERY_EVERY, k: int = K) -> DataFrame:
    """The rows whose id is divisible by ``every`` against all rows."""
    vectors = kept_table(packed(embeddings), "topk-vectors")
    return top_k(vectors.filter(F.col("vec_id") % every == 0), vectors, k)


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % {QUERY_EVERY} = 0 AND q.r <> d.r AND len(q.e) = len(d.e)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
