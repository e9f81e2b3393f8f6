"""Codes for vectors, one codebook entry per part; a GNAT over the entries finds the nearest one.

Components become whole numbers, vectors are cut into equal parts, and each part position has a codebook that starts with
the parts of the smallest ids and is moved to the floored means of its members in a few rounds. In each round every task
assigns its vectors and sends one row of sums per entry and component; the driver sees sums and codebooks only, whose
size is parts x entries x components, whatever the number of vectors.

The nearest entry is found in a GNAT: a node has split points, every other entry belongs to its nearest split point, and
for each pair of a split point and a child the node keeps the range of distances from the point to the child's entries. If the
distance of a query to a split point, less or more the best distance so far, lies strictly outside a range, the whole
child is out. Square roots are rounded down for lower and up for upper bounds, so nothing is lost by rounding and entries
at an equal distance stay in; the entries that are left are compared by whole squared distances, ties to the lower index.

Whole numbers stay exact at any size: numpy's 64 bits where no square can overflow, Python's numbers elsewhere, and sums
travel in digits of 40 bits.

Defined results: rows whose vector is null or has a null or non-finite component are left out. Shorter vectors, empty ones
included, count as filled up with zeros to the longest length, which counts as filled up to a multiple of the parts. Rows that
share an id are all coded; among the first entries they come in the order of their vectors, null ids last. With fewer
vectors than entries, codebooks have as many entries as there are vectors. An error beyond the range of long is the largest
long. An empty table gives an empty result. Other columns than id, vector and label are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.text import run_starts
from eventlake.session import fresh_path

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
FANOUT, LEAF = 6, 6
LONGEST = (1 << 63) - 1
# a label with at least this share of all rows is hot; so there are at most as many hot labels
HOT_SHARE = 1000
_DIGIT = 40
_SLACK = 2.0**-40
_CODED = "vec_id long, label_key binary, code string, error long"


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whole squared distances of all rows of one matrix to all rows of another."""
    away = points[:, None, :] - others[None, :, :]
    return (away * away).sum(axis=2)


def below(squares: np.ndarray) -> np.ndarray:
    """Numbers that are not above the square roots."""
    if squares.dtype == object:
        return np.array([math.isqrt(x) for x in squares.ravel()], dtype=object).reshape(squares.shape)
    return np.sqrt(squares.astype(np.float64)) * (1 - _SLACK)


def above(squares: np.ndarray) -> np.ndarray:
    """Numbers that are not below the square roots."""
    if squares.dtype == object:
        return np.array([math.isqrt(x) + 1 for x in squares.ravel()], dtype=object).reshape(squares.shape)
    return np.sqrt(squares.astype(np.float64)) * (1 + _SLACK)


class Node:
    """Split points, their children, and ranges of distances from each point to each child's entries."""

    def __init__(self, entries: np.ndarray, members: np.ndarray):
        self.splits, self.children = members, []
        if len(members) <= LEAF:
            return
        # points far from one another: each next one is the entry furthest from those chosen
        chosen = [0]
        nearest = squared(entries[members], entries[members[:1]])[:, 0]
        while len(chosen) < FANOUT and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squared(entries[members], entries[members[chosen[-1:]]])[:, 0])
        if len(chosen) == 1:  # all entries are alike
            return
        self.splits = members[np.sort(np.array(chosen))]
        rest = np.setdiff1d(members, self.splits)
        if len(rest):
            home = squared(entries[rest], entries[self.splits]).argmin(axis=1)
            for child in range(len(self.splits)):
                inside = rest[home == child]
                if len(inside):
                    far = squared(entries[self.splits], entries[inside])
                    self.children.append((child, below(far.min(axis=1)), above(far.max(axis=1)), Node(entries, inside)))


class Gnat:
    """Nearest entry by whole squared distance, ties to the lower index."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = Node(entries, np.arange(len(entries)))
        self.seen = 0  # how many distances searches took

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry for each row."""
        self.points = points
        self.index = np.full(len(points), len(self.entries), dtype=np.int64)
        self.best = np.full(len(points), -1, dtype=points.dtype)
        self._visit(self.root, np.arange(len(points)))
        return self.index, self.best

    def _visit(self, node: Node, rows: np.ndarray) -> None:
        away = squared(self.points[rows], self.entries[node.splits])
        self.seen += away.size
        first = away.argmin(axis=1)  # splits are in ascending order, so the first of equal ones
        least, entry = away[np.arange(len(rows)), first], node.splits[first]
        best, index = self.best[rows], self.index[rows]
        better = (index == len(self.entries)) | (least < best) | ((least == best) & (entry < index))
        self.best[rows] = np.where(better, least, best)
        self.index[rows] = np.where(better, entry, index)
        if not node.children:
            return
        low, high = below(away), above(away)
        # the child a row lies in comes first, as it makes the best distance small
        for home in (True, False):
            for child, near, far, below_it in node.children:
                at = np.flatnonzero((first == child) == home)
                reach = above(self.best[rows[at]])[:, None]
                outside = (low[at] - reach > far) | (high[at] + reach < near)
                at = at[~outside.any(axis=1).astype(bool)]
                if len(at):
                    self._visit(below_it, rows[at])


@dataclass
class Codebooks:
    """Entries per part: ``entries[part][entry]`` is a list of whole numbers."""

    entries: list[list[list[int]]]
    width: int

    def digest(self) -> str:
        numbers = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


class Coder:
    """Trees over all codebooks, in numbers wide enough for the rows at hand."""

    def __init__(self, books: Codebooks):
        self.books = books
        self.largest = [max((abs(x) for entry in part for x in entry), default=0) for part in books.entries]
        self.trees: dict[tuple[int, bool], Gnat] = {}

    def tree(self, part: int, small: bool) -> Gnat:
        if (part, small) not in self.trees:
            entries = np.array(self.books.entries[part], dtype=np.int64 if small else object)
            self.trees[part, small] = Gnat(entries.reshape(len(self.books.entries[part]), self.books.width))
        return self.trees[part, small]

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance per row and part."""
        width = self.books.width
        codes = np.empty((len(rows), len(self.books.entries)), dtype=np.int64)
        errors = np.empty(codes.shape, dtype=rows.dtype)
        for part, largest in enumerate(self.largest):
            points = rows[:, part * width : (part + 1) * width]
            small = rows.dtype != object and (largest + int(np.abs(points).max(initial=0))) ** 2 * width < 1 << 53
            codes[:, part], found = self.tree(part, small).nearest(points if small else points.astype(object))
            errors = errors if small else errors.astype(object)
            errors[:, part] = found
        return codes, errors


def whole_rows(vectors: pa.Array, dim: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and ``floor(scale * x)`` per component: rows that fit into 64 bits, then the others."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = np.zeros((len(vectors), dim))
    values[np.repeat(np.arange(len(vectors)), lengths), column] = flat
    small = (np.abs(values) < 2.0**40 / scale).all(axis=1)
    at = np.flatnonzero(small)
    if len(at):
        yield at, np.floor(values[at] * scale).astype(np.int64)
    at = np.flatnonzero(~small)
    if len(at):
        # a whole number times the scale is exact in Python, however large
        exact = [[math.floor(x * scale) if abs(x) < 2.0**52 else int(x) * scale for x in row] for row in values[at].tolist()]
        yield at, np.array(exact, dtype=object).reshape(len(at), dim)


def gathered(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``most`` bytes, so that the steps of a search are shared by many rows."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _digits(value: int) -> list[int]:
    """Digits of 40 bits with the sign of the value, lowest first."""
    sign, rest, out = (-1 if value < 0 else 1), abs(value), []
    while rest or not out:
        out.append(sign * (rest & ((1 << _DIGIT) - 1)))
        rest >>= _DIGIT
    return out


def _sums(sent, scale: int):
    """One row per entry, component and digit of the sums of a task's vectors; component -1 is their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        coder, width = Coder(books), books.width
        parts, entries = len(books.entries), len(books.entries[0])
        total = np.zeros((parts, entries, width + 1), dtype=object)
        for batch in gathered(batches):
            for _, rows in whole_rows(batch.column("v"), parts * width, scale):
                codes, _ = coder.assign(rows)
                for part in range(parts):
                    order = np.argsort(codes[:, part], kind="stable")
                    used = codes[order, part]
                    begins = np.flatnonzero(run_starts(used))
                    points = rows[order, part * width : (part + 1) * width]
                    total[part, used[begins], :width] += np.add.reduceat(points, begins, axis=0).astype(object)
                    total[part, used[begins], width] += np.diff(np.append(begins, len(used))).astype(object)
        out = []
        for part, entry in zip(*np.nonzero(total[:, :, width])):
            for component in range(width + 1):
                for digit, value in enumerate(_digits(int(total[part, entry, component]))):
                    out.append((part, entry, component if component < width else -1, digit, value))
        columns = [pa.array([int(row[i]) for row in out], pa.int64() if i == 4 else pa.int32()) for i in range(5)]
        yield pa.record_batch(columns, ["part", "entry", "component", "digit", "value"])

    return run


def _codes(sent, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        coder, names = Coder(books), [f"{i:02x}" for i in range(256)]
        for batch in gathered(batches):
            codes, errors = [""] * batch.num_rows, [0] * batch.num_rows
            for at, rows in whole_rows(batch.column("v"), len(books.entries) * books.width, scale):
                found, away = coder.assign(rows)
                for row, code, error in zip(at, found.tolist(), away.astype(object).sum(axis=1)):
                    codes[row], errors[row] = "".join([names[c] for c in code]), min(int(error), LONGEST)
            yield pa.record_batch(
                [batch.column("vec_id"), batch.column("label_key"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label_key", "code", "error"],
            )

    return run


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``vec_id, label_key, v`` for the rows whose vector has finite components only."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = vectors.where(v.isNotNull() & finite)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label_key"), v.alias("v"))


def first_codebooks(rows: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """Parts of the vectors with the smallest ids; at most ``entries`` rows reach the driver."""
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-longest // parts))
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries)
    seeds: dict[int, list[int]] = {}
    for at, whole in whole_rows(first.toArrow().column("v").combine_chunks(), parts * width, scale):
        seeds |= zip(at.tolist(), whole.tolist())
    ordered = [seeds[i] for i in sorted(seeds)]
    return Codebooks([[s[p * width : (p + 1) * width] for s in ordered] for p in range(parts)], width)


def refine(rows: DataFrame, books: Codebooks, scale: int) -> Codebooks:
    """Each entry that vectors chose becomes the floored mean of their parts."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    partial = rows.select("v").mapInArrow(_sums(sent, scale), "part int, entry int, component int, digit int, value long")
    summed = partial.groupBy("part", "entry", "component", "digit").agg(F.sum("value").alias("value")).collect()
    sums: dict[tuple[int, int, int], int] = {}
    for row in summed:
        key = (row["part"], row["entry"], row["component"])
        sums[key] = sums.get(key, 0) + (row["value"] << (_DIGIT * row["digit"]))
    entries = [[list(entry) for entry in part] for part in books.entries]
    for (part, entry, component), value in sums.items():
        if component >= 0:
            entries[part][entry][component] = value // sums[part, entry, -1]
    return Codebooks(entries, books.width)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """The codebooks of the rows of ``kept_vectors``; None without rows."""
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    books = first_codebooks(rows, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = refine(rows, books, scale)
    return books


def add_label_errors(coded: DataFrame) -> DataFrame:
    """Add the sum of errors over equal labels to a stored table of codes.

    Sums are made before they are joined. The sums of hot labels, at most ``HOT_SHARE`` rows, are broadcast, so that rows of
    such a label stay where they are; rows of other labels meet their sum by a shuffle.
    """
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label_key").agg(F.least(exact, F.lit(LONGEST).cast("decimal(38,0)")).cast("long").alias("label_error"),
                                          F.count(F.lit(1)).alias("n"))
    sums = sums.select(F.col("label_key").alias("of_label"), "label_error", "n")
    total = coded.count()
    hot = sums.where(F.col("n") * HOT_SHARE >= total).drop("n")
    same = coded["label_key"].eqNullSafe(F.col("of_label"))
    return (
        coded.join(F.broadcast(hot), same)
        .drop("of_label")
        .unionByName(
            coded.join(F.broadcast(hot.select("of_label")), same, "left_anti")
            .join(sums.where(F.col("n") * HOT_SHARE < total).drop("n"), same)
            .drop("of_label")
        )
    )


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
           id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per vector."""
    spark = vectors.sparkSession
    rows = kept_vectors(vectors, id_col, vector_col, F.col(label_col).cast("string").cast("binary"))
    books = train(rows, parts, entries, rounds, scale)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    path = fresh_path(spark, "vector-codes")
    rows.mapInArrow(_codes(spark.sparkContext.broadcast(books), scale), _CODED).write.parquet(path)
    coded = add_label_errors(spark.read.parquet(path))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
