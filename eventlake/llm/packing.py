"""Pack pieces of documents into sequences of several permitted lengths, best fit with variable capacity.

Documents longer than the largest length are cut into pieces of that length and a rest, so nothing is lost.
Pieces are packed in windows of a bounded number of pieces, in decreasing length: a piece goes into the open
bin it fills best; if none has room, a bin opens. All lengths are optimised together: pieces fall into classes by the smallest length that holds them, and
each window is packed once for every choice of a length to open per class (six for three lengths); every subset of lengths is
among these, as is every single length. After packing every bin is made as small as its contents allow. The cheapest
result of the window counts. A window holds a bounded number of rows of one input partition, so memory is
bounded and no document is shuffled; a task leaves at most its last bins less full than they might be.

Defined results: null texts and length 0 give no piece. Repeated rows are packed as often as they occur. Ties
go by id, then by position in the input. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_PIECES = 16_384
WINDOW_BYTES = 32 << 20


@dataclass(frozen=True)
class Lengths:
    """Permitted sequence lengths and what a sequence costs.

    A sequence of length n costs ``n + fixed + n * n / quadratic``: its tokens, what each sequence costs
    besides, and the part of attention that grows with the square.
    """

    permitted: tuple[int, ...] = (1024, 2048, 4096)
    fixed: float = 32.0
    quadratic: float = 65536.0

    def cost(self, length: int) -> float:
        return length + self.fixed + length * length / self.quadratic

    def smallest(self, contents: int) -> int:
        return min(n for n in self.permitted if n >= contents)


@dataclass
class Bin:
    capacity: int
    used: int = 0
    pieces: list[int] = field(default_factory=list)


def best_fit(lengths: list[int], order: list[int], open_at: Callable[[int], int]) -> list[Bin]:
    """Place pieces in the given order; ``open_at`` names the capacity for a piece that fits no open bin."""
    bins: list[Bin] = []
    room: list[int] = []  # the distinct amounts of room, sorted
    with_room: dict[int, list[int]] = {}
    for piece in order:
        need = lengths[piece]
        at = bisect_left(room, need)
        if at < len(room):
            left = room[at]
            stack = with_room[left]
            number = stack.pop()
            if not stack:
                del with_room[left]
                room.pop(at)
        else:
            number = len(bins)
            bins.append(Bin(open_at(need)))
            left = bins[number].capacity
        bins[number].used += need
        bins[number].pieces.append(piece)
        left -= need
        if left:
            if left not in with_room:
                insort(room, left)
                with_room[left] = []
            with_room[left].append(number)
    return bins


def pack_window(lengths: list[int], options: Lengths) -> list[Bin]:
    """The cheapest packing of a window over all choices of the length that opens for each class of pieces, bins downsized."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    permitted = sorted(options.permitted)
    best: tuple[float, list[Bin]] | None = None
    classes = sorted({bisect_left(permitted, n) for n in lengths})
    for opened in product(*[permitted[c:] for c in classes]):
        at_class = dict(zip(classes, opened))

        def open_at(need: int, at_class: dict[int, int] = at_class) -> int:
            return at_class[bisect_left(permitted, need)]

        bins = best_fit(lengths, order, open_at)
        for b in bins:
            b.capacity = options.smallest(b.used)
        total = sum(options.cost(b.capacity) for b in bins)
        if best is None or total < best[0]:
            best = (total, bins)
    return best[1] if best else []


def _pack(options: Lengths, with_text: bool):
    def rows_of(window: pa.Table, number: int) -> pa.RecordBatch:
        window = window.combine_chunks()
        bins = pack_window(window.column("length").to_pylist(), options)
        taken = [p for b in bins for p in b.pieces]
        lengths = window.column("length").to_pylist()
        ids, slots, begins, capacities = [], [], [], []
        first = (TaskContext.get().partitionId() << 40) + (number << 20)
        for k, b in enumerate(bins):
            at = 0
            for slot, piece in enumerate(b.pieces):
                ids.append(first + k)
                slots.append(slot)
                begins.append(at)
                capacities.append(b.capacity)
                at += lengths[piece]
        out = window.take(pa.array(taken, pa.int64())).combine_chunks()
        names = ("doc_id", "start", "length", *(("text",) if with_text else ()))
        columns = [out.column(n).combine_chunks() for n in names]
        more = [pa.array(ids, pa.int64()), pa.array(capacities, pa.int64()), pa.array(slots, pa.int64()), pa.array(begins, pa.int64())]
        return pa.record_batch(columns + more, [*names, "bin_id", "capacity", "slot", "bin_start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        pieces = size = number = 0
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                held.append(batch)
                pieces += batch.num_rows
                size += batch.get_total_buffer_size() * batch.num_rows // max(1, whole.num_rows)
                if pieces >= WINDOW_PIECES or size >= WINDOW_BYTES:
                    yield rows_of(pa.Table.from_batches(held), number)
                    held, pieces, size, number = [], 0, 0, number + 1
        if held:
            yield rows_of(pa.Table.from_batches(held), number)

    return run


def pack(docs: DataFrame, options: Lengths | None = None) -> DataFrame:
    """Pack rows of ``doc_id, length`` (and ``words``, an array of that many, if there is one).

    One row per piece: ``doc_id, start, length`` (the piece within its document), ``bin_id``, ``capacity``
    (of the bin), ``slot`` (place in the bin), ``bin_start`` (where the piece begins in the bin) and, with ``words``,
    ``text``: the piece's words, joined as they are.
    """
    options = options or Lengths()
    most = max(options.permitted)
    with_text = "words" in docs.columns
    begins = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(most).cast("long"))

    def piece(start: Column) -> Column:
        # the text is cut here, before rows multiply, so that no piece carries the whole document
        parts = [start.alias("start"), F.least(F.lit(most).cast("long"), F.col("length") - start).alias("length")]
        if with_text:
            words = F.slice("words", (start + 1).cast("int"), F.lit(most))
            parts.append(F.array_join(words, "").alias("text"))
        return F.struct(*parts)

    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.where(F.col("length") > 0).select(doc_id, F.explode(F.transform(begins, piece)).alias("piece"))
    schema = "doc_id long, start long, length long" + (", text string" if with_text else "")
    schema += ", bin_id long, capacity long, slot long, bin_start long"
    return rows.select("doc_id", "piece.*").mapInArrow(_pack(options, with_text), schema)
