"""Exact top-k inner products with a pivot-distance index.

Vectors are turned into whole numbers and lifted by one more component so that all have the same length; then the
largest inner product is the smallest distance. Each vector is keyed by its nearest pivot and its distance to it; sorted by
that key, the rows of a pivot form annuli, stored in blocks of at most BLOCK_ROWS rows. A search first looks into
the annulus a query lies in, which gives a bound on its k-th best distance. By the triangle inequality a block whose distances
to its pivot are all further from the query's distance than the bound cannot hold a better row. The blocks that are
left are visited in the order of how near they may come, the bound shrinking, until none can matter.

Pivots come from a bounded sample; any pivots give exact results. Queries are handled in blocks as well: each task
has one block of queries and a bounded number of blocks of the index, and its best rows are merged at the end.

Vectors with a very large component (``|scale * x| >= 2 ** 31``) would blow up the annuli of all others, so the index does not hold them.
They are kept in blocks of their own, met by every block of queries, and as queries they meet every block of the index; only
scores that rounding leaves open are computed again with whole numbers of any size.

Defined results: a row without id, without vector, or with a null or non-finite component takes no part. A score beyond 64 bits is
returned as the nearest long, ranks go by the true score. Shorter vectors count as filled up with zeros. Ties go to the smaller id.
Rows with the query's id are no candidates; a repeated query row is answered as often as it occurs, candidates that share an
id are each ranked. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.session import fresh_path

PIVOTS = 64
SAMPLE_ROWS = 4096
BLOCK_ROWS = 256
QUERY_ROWS = 1024
SLICE_BLOCKS = 64
_BLOCK = "block long, pivot int, near double, far double, n int, ids binary, rows binary"
_EXACT = float(1 << 53)


def finite(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """The rows that take part."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & fine)


def in_index(v: Column, scale: int) -> Column:
    return F.forall(v, lambda x: F.abs(x.cast("double")) * scale < float(1 << 31))


def wide_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, v`` with the components as doubles, for the rows that take part but have no place in the index."""
    v = F.col(vector_col)
    rows = finite(vectors, id_col, vector_col).where(~in_index(v, scale))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: x.cast("double")).alias("v"))


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, v`` with ``v = floor(scale * x)`` per component, for the rows of the index."""
    v = F.col(vector_col)
    rows = finite(vectors, id_col, vector_col).where(in_index(v, scale))
    scaled = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("v"))


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of integers, short ones filled up with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), dim), dtype=np.int32)
    out[np.repeat(np.arange(len(vectors)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


@dataclass
class Space:
    """What all tasks share: the pivots, the number of components and the largest squared length."""

    dim: int
    longest: float
    pivots: np.ndarray

    def lift(self, rows: np.ndarray) -> np.ndarray:
        rows = rows.astype(np.float64)
        return np.column_stack([rows, np.sqrt(np.maximum(self.longest - (rows * rows).sum(axis=1), 0.0))])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        squares = (lifted * lifted).sum(axis=1)[:, None] - 2 * lifted @ self.pivots.T + (self.pivots**2).sum(axis=1)
        return np.sqrt(np.maximum(squares, 0.0))

    def slack(self) -> float:
        """More than rounding can change a distance by."""
        return 1e-5 * (1.0 + np.sqrt(self.longest))


def choose_space(rows: DataFrame, pivots: int = PIVOTS) -> Space | None:
    """Pivots are the centres of a few rounds of k-means over at most SAMPLE_ROWS rows, chosen by a hash of the id."""
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    dim, longest = rows.agg(F.max(F.size("v")), F.max(squares)).first()
    if dim is None:
        return None
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toArrow().column("v").combine_chunks()
    space = Space(dim, float(longest), np.zeros((1, dim + 1)))
    points = space.lift(matrix(sample, dim))
    centres = points[np.random.default_rng(0).permutation(len(points))[:pivots]]
    for _ in range(5):
        space.pivots = centres
        nearest = space.distances(points).argmin(axis=1)
        centres = np.array([points[nearest == p].mean(axis=0) if (nearest == p).any() else c for p, c in enumerate(centres)])
    space.pivots = centres
    return space


def _key(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = sent.value
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column("v"), space.dim)
                away = space.distances(space.lift(rows))
                pivot = away.argmin(axis=1)
                row = pa.array([r.tobytes() for r in rows], pa.binary())
                dist = pa.array(away[np.arange(len(rows)), pivot])
                yield pa.record_batch([batch.column("vec_id"), pa.array(pivot.astype(np.int32)), dist, row],
                                      ["vec_id", "pivot", "dist", "row"])

    return run


def _block(most: int, by_pivot: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids, pivots, dists, rows = zip(*held)
            held.clear()
            number += 1
            values = (number, pivots[0], min(dists), max(dists), len(ids), np.array(ids, np.int64).tobytes(), b"".join(rows))
            types = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary())
            return pa.record_batch([pa.array([x], t) for x, t in zip(values, types)], [c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "pivot", "dist", "row"))):
                if held and (len(held) == most or by_pivot and held[0][1] != row[1]):
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    return run


def build_blocks(rows: DataFrame, sent, path: str, most: int, by_pivot: bool = True) -> DataFrame:
    """Write rows in order of pivot and distance, ``most`` to a block; many equal vectors fill many blocks."""
    spark = rows.sparkSession
    keyed = rows.mapInArrow(_key(sent), "vec_id long, pivot int, dist double, row binary")
    ordered = keyed.repartitionByRange("pivot", "dist", "vec_id").sortWithinPartitions("pivot", "dist", "vec_id")
    ordered.mapInArrow(_block(most, by_pivot), _BLOCK).write.parquet(path)
    return spark.read.parquet(path)


class Search:
    """The running result of one block of queries."""

    def __init__(self, ids: bytes, rows: bytes, space: Space, k: int, floor: np.ndarray | None = None):
        self.space, self.k = space, k
        self.ids = np.frombuffer(ids, np.int64)
        self.rows = np.frombuffer(rows, np.int32).reshape(len(self.ids), space.dim)
        lifted = self.rows.astype(np.float64)
        self.squares = (lifted * lifted).sum(axis=1)
        # a query has 0 in the added component
        self.away = space.distances(np.column_stack([lifted, np.zeros(len(lifted))]))
        self.floor = np.full(len(self.ids), -np.inf) if floor is None else floor.copy()
        self.found = [np.empty(0, np.int64) for _ in range(3)]  # query, score, row id
        self.pending: list[list[np.ndarray]] = []

    def reach(self) -> np.ndarray:
        """How far away a row may be that reaches the k-th best score so far."""
        squares = self.squares + self.space.longest - 2 * self.floor
        return np.sqrt(np.maximum(squares, 0.0)) + self.space.slack()

    def wanted(self, pivot: int, near: float, far: float) -> np.ndarray:
        away, reach = self.away[:, pivot], self.reach()
        return np.flatnonzero((away + reach >= near) & (away - reach <= far))

    def visit(self, ids: bytes, rows: bytes, queries: np.ndarray) -> None:
        ids = np.frombuffer(ids, np.int64)
        rows = np.frombuffer(rows, np.int32).reshape(len(ids), self.space.dim)
        if self.space.longest < _EXACT:
            scores = self.rows[queries].astype(np.float64) @ rows.astype(np.float64).T
        else:
            scores = self.rows[queries].astype(np.int64) @ rows.astype(np.int64).T
        good = (scores >= self.floor[queries, None]) & (ids[None, :] != self.ids[queries, None])
        q, r = np.nonzero(good)
        self.pending.append([queries[q], scores[q, r].astype(np.int64), ids[r]])
        if sum(len(p[0]) for p in self.pending) > 8 * self.k * len(self.ids) or len(self.pending) == 1 and not len(self.found[0]):
            self.settle()

    def settle(self) -> None:
        query, score, row = (np.concatenate(x) for x in zip(self.found, *self.pending))
        order = np.lexsort((row, -score, query))
        query, score, row = query[order], score[order], row[order]
        begins = np.searchsorted(query, np.arange(len(self.ids)))
        place = np.arange(len(query)) - begins[query]
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])
        best = place < self.k
        self.found, self.pending = [query[best], score[best], row[best]], []


def _bounds(sent, k: int):
    """Look into each query block's home annuli; give the blocks of floors and the intervals that are left."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        space, first = sent.value, group.iloc[0]
        search = Search(first["q_ids"], first["q_rows"], space, k)
        for ids, rows in zip(group["ids"], group["rows"]):
            search.visit(ids, rows, np.arange(len(search.ids)))
        search.settle()
        reach = search.reach()[:, None]
        low, high = (search.away - reach).min(axis=0), (search.away + reach).max(axis=0)
        return pd.DataFrame(
            {"q_block": first["q_block"], "pivot": np.arange(len(low), dtype=np.int32), "low": low, "high": high,
             "floors": [search.floor.tobytes()] * len(low)}
        )

    return run


def _search(sent, k: int):
    columns = ("q_block", "q", "query_id", "vec_id", "score")

    def run(asked: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or group.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
        space, first = sent.value, asked.iloc[0]
        search = Search(first["q_ids"], first["q_rows"], space, k, np.frombuffer(first["floors"], np.float64))

        def nearest(block) -> float:
            away = search.away[:, block.pivot]
            return float(np.maximum(np.maximum(block.near - away, away - block.far), 0.0).min())

        blocks = sorted(((nearest(b), i, b) for i, b in enumerate(group.itertuples())), key=lambda x: x[:2])
        for lowest, _, block in blocks:
            if lowest > search.reach().max():
                break
            queries = search.wanted(block.pivot, block.near, block.far)
            if len(queries):
                search.visit(block.ids, block.rows, queries)
        search.settle()
        query, score, row = search.found
        return pd.DataFrame(
            {"q_block": first["q_block"], "q": query, "query_id": search.ids[query], "vec_id": row, "score": score}
        )

    return run


_WIDE = "block long, ids binary, rows binary, width int"
_OPEN = "q_block long, q long, query_id long, vec_id long, score long, place string"


def _wide_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most BLOCK_ROWS vectors a block, filled up with zeros to the widest of them."""
    number = (1 << 62) + (TaskContext.get().partitionId() << 40)
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            some, number = batch.slice(at, BLOCK_ROWS), number + 1
            vectors = some.column("v").to_pylist()
            rows = np.zeros((len(vectors), max(map(len, vectors))))
            for row, v in zip(rows, vectors):
                row[: len(v)] = v
            ids = some.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
            values = (number, ids.tobytes(), rows.tobytes(), rows.shape[1])
            yield pa.record_batch([pa.array([x], t) for x, t in zip(values, (pa.int64(), pa.binary(), pa.binary(), pa.int32()))],
                                  [c.split()[0] for c in _WIDE.split(", ")])


def place_of(score: int) -> str:
    """Text that sorts as whole numbers of any size do, the largest first."""
    digits = str(abs(score))
    rising = f"{len(digits):05d}{digits}"
    return "1" + rising if score < 0 else "0" + rising.translate(str.maketrans("0123456789", "9876543210"))


def _wide_scores(k: int, scale: int):
    """Per pair of blocks the ``k`` best rows of each query, exact."""

    def decoded(rows: bytes, width: int | None, count: int, dim: int):
        """Scaled components as floats, and a function that gives a row as whole numbers."""
        wide = width is not None and not np.isnan(width)
        held = np.frombuffer(rows, np.float64 if wide else np.int32).reshape(count, -1)
        full = np.zeros((count, dim))
        with np.errstate(over="ignore"):
            full[:, : held.shape[1]] = np.floor(held * float(scale)) if wide else held

        def whole(i: int) -> list[int]:
            # a component too large to be scaled as a float is a whole number
            return [int(f) if np.isfinite(f) else int(x) * scale for f, x in zip(full[i], held[i])] + [0] * (dim - held.shape[1])

        return full, whole

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for pair in frame.itertuples():
                q_ids, ids = np.frombuffer(pair.q_ids, np.int64), np.frombuffer(pair.ids, np.int64)
                sizes = [len(pair.q_rows) // len(q_ids) // (8 if pair.q_width == pair.q_width else 4),
                         len(pair.rows) // len(ids) // (8 if pair.width == pair.width else 4)]
                dim = max(sizes)
                a, whole_a = decoded(pair.q_rows, pair.q_width, len(q_ids), dim)
                b, whole_b = decoded(pair.rows, pair.width, len(ids), dim)
                with np.errstate(over="ignore", invalid="ignore"):
                    about = a @ b.T
                    wrong = (np.abs(a) @ np.abs(b).T) * ((dim + 2) * 2.0**-51)
                out = []
                for q in range(len(q_ids)):
                    others = np.flatnonzero(ids != q_ids[q])
                    low, high = about[q, others] - wrong[q, others], about[q, others] + wrong[q, others]
                    if len(others) > k and np.isfinite(low).all() and np.isfinite(high).all():
                        others = others[high >= np.partition(low, -k)[-k]]
                    left = whole_a(q)
                    exact = sorted((-sum(x * y for x, y in zip(left, whole_b(i))), int(ids[i])) for i in others)[:k]
                    out += [(pair.q_block, q, q_ids[q], row, max(min(-s, 2**63 - 1), -(2**63)), place_of(-s)) for s, row in exact]
                yield pd.DataFrame(out, columns=[c.split()[0] for c in _OPEN.split(", ")])

    return run


def wide_scores(queries: DataFrame, blocks: DataFrame, k: int, scale: int) -> DataFrame:
    """Every block of queries with every given block: ``q_block, q, query_id, vec_id, score, place``.

    A block of queries goes to every slice of the blocks; pairs are made and scored one after the other.
    """
    slices = max(1, -(-blocks.count() // SLICE_BLOCKS))
    dealt = blocks.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("long"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))
    work = queries.withColumn("slice", F.explode(every)).join(dealt, "slice")
    return work.select("q_block", "q_ids", "q_rows", "q_width", "ids", "rows", "width").mapInPandas(_wide_scores(k, scale), _OPEN)


def _with_wide(vectors, wide, is_query, k, scale, id_col, vector_col, queries, blocks) -> DataFrame:
    """Scores of pairs with a vector that the index does not hold."""
    spark = vectors.sparkSession
    paths = [fresh_path(spark, f"wide-{name}") for name in ("blocks", "queries")]
    asking = wide_vectors(vectors.where(is_query), id_col, vector_col, scale)
    for rows, path in zip((wide, asking), paths):
        rows.mapInArrow(_wide_block, _WIDE).write.parquet(path)
    stored, asked = (spark.read.parquet(path) for path in paths)
    asked = asked.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("width").alias("q_width"))
    narrow = F.lit(None).cast("int")
    usual = queries.select("q_block", "q_ids", "q_rows", narrow.alias("q_width"))
    indexed = blocks.select("block", "ids", "rows", narrow.alias("width"))
    to_wide = wide_scores(usual.unionByName(asked), stored, k, scale)
    return to_wide.unionByName(wide_scores(asked, indexed, k, scale))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product for each query row."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id_col, vector_col, scale)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    space = choose_space(rows)
    wide = wide_vectors(vectors, id_col, vector_col, scale)
    has_wide = bool(wide.take(1))
    if space is None:
        if not has_wide:
            return empty
        # an index without rows
        space = Space(1, 0.0, np.zeros((1, 2)))
    sent = spark.sparkContext.broadcast(space)
    blocks = build_blocks(rows, sent, fresh_path(spark, "pivot-index"), BLOCK_ROWS)
    wanted = whole_vectors(vectors.where(is_query), id_col, vector_col, scale)
    queries = build_blocks(wanted, sent, fresh_path(spark, "pivot-queries"), QUERY_ROWS, by_pivot=False)
    queries = queries.select(F.col("block").alias("q_block"), "pivot", "near", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"))
    # the home of a block of queries is the annulus its first query lies in
    order = Window.partitionBy("pivot").orderBy("near", F.col("block").asc_nulls_first())
    marks = blocks.select("pivot", "near", "block", F.lit(None).cast("long").alias("q_block"))
    marks = marks.unionByName(queries.select("pivot", "near", F.lit(None).cast("long").alias("block"), "q_block"))
    before = F.last("block", ignorenulls=True).over(order)
    after = F.first("block", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    home = marks.select("q_block", F.coalesce(before, after).alias("block")).where(F.col("q_block").isNotNull())
    payload = blocks.select("block", "ids", "rows")
    started = home.join(payload, "block").join(queries.select("q_block", "q_ids", "q_rows"), "q_block")
    path = fresh_path(spark, "pivot-bounds")
    bounds = started.groupBy("q_block").applyInPandas(
        _bounds(sent, k), "q_block long, pivot int, low double, high double, floors binary"
    )
    bounds.write.parquet(path)
    bounds = spark.read.parquet(path)
    slices = max(1, -(-blocks.count() // SLICE_BLOCKS))
    left = bounds.join(blocks.select("block", "pivot", "near", "far"), "pivot").where(
        (F.col("near") <= F.col("high")) & (F.col("far") >= F.col("low"))
    )
    left = left.select("q_block", "block", "pivot", "near", "far")
    path = fresh_path(spark, "pivot-work")
    left.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("long")).write.parquet(path)
    work = spark.read.parquet(path)
    # a block of queries goes once to each slice in which a block is left to look at, not along with every block of the index
    floors = bounds.where(F.col("pivot") == 0).select("q_block", "floors")
    asked = queries.select("q_block", "q_ids", "q_rows").join(floors, "q_block")
    asked = asked.join(spark.read.parquet(path).select("q_block", "slice").distinct(), "q_block")
    best = asked.groupBy("q_block", "slice").cogroup(work.join(payload, "block").groupBy("q_block", "slice")).applyInPandas(
        _search(sent, k), "q_block long, q long, query_id long, vec_id long, score long"
    )
    order = [F.desc("score"), "vec_id"]
    if has_wide:
        best = best.withColumn("place", F.lit(None).cast("string"))
        extra = _with_wide(vectors, wide, is_query, k, scale, id_col, vector_col, queries, blocks)
        # scores of the index fit a long, so their places can be told from them
        digits = F.abs(F.when(F.col("place").isNull(), F.col("score"))).cast("string")
        rising = F.concat(F.lpad(F.length(digits).cast("string"), 5, "0"), digits)
        told = F.when(F.col("score") < 0, F.concat(F.lit("1"), rising)).otherwise(
            F.concat(F.lit("0"), F.translate(rising, "0123456789", "9876543210"))
        )
        best = best.unionByName(extra).withColumn("place", F.coalesce("place", told))
        order = ["place", "vec_id"]
    place = F.row_number().over(Window.partitionBy("q_block", "q").orderBy(*order))
    ranked = best.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
