"""Fill-in-middle over texts stored as seekable compressed frames.

A store has one row per document: its UTF-8 text as independent zstandard frames of at most ``FRAME_BYTES`` bytes, cut between
code points, and the number of units (code points) up to the end of each frame. A range of units is read by a binary search
in those counts, and only the frames it touches are decompressed. The transformation reads the frames that hold the two
cuts to place them, then streams ordered frames into the frames of the output; digests stream ordered frames as well, so a
task holds compressed frames and one open frame, never a second copy of a long text.

The output of ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, that of ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>``
middle, that of ``plain`` the text. A text that holds a mark stays plain, so marks in an output are found again without doubt
and the text is rebuilt from the output and its form alone.

No step shuffles: a document is one row from the first to the last. A lost task is run again from the table before it.

Defined results: a null text is an empty one; empty texts are plain with 0 units. A null id counts as the empty text in the
hashes. Repeated rows are all kept and transformed alike. An empty table gives an empty store and an empty result. Bytes
that are no UTF-8 are kept as they are; each byte that does not continue a code point counts as a unit. Columns other than
the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.text import slices, texts_of

FRAME_BYTES = 1 << 16
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = "1"
PLAIN_FROM, SPM_BELOW = 90, 20  # per cent

STORE = "doc_id long, ends array<bigint>, frames array<binary>"
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, ends array<bigint>, frames array<binary>"
_TYPES = {"long": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}


def _begins(data: bytes) -> np.ndarray:
    """True for each byte that begins a code point."""
    return (np.frombuffer(data, np.uint8) & 0xC0) != 0x80


def units(data: bytes) -> int:
    return len(data) if data.isascii() else int(np.count_nonzero(_begins(data)))


def byte_of_unit(data: bytes, unit: int) -> int:
    """Where the given unit begins; the length of the data for the unit behind the last."""
    if unit == 0 or data.isascii():
        return unit
    begins = np.flatnonzero(_begins(data))
    return int(begins[unit]) if unit < len(begins) else len(data)


class FrameWriter:
    """Takes bytes in any portions and makes frames of them."""

    def __init__(self, most: int = FRAME_BYTES):
        import zstandard

        self._compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.most = most

    def frames(self, portions: Iterable[bytes]) -> tuple[list[int], list[bytes]]:
        """Units up to the end of each frame, and the frames."""
        ends: list[int] = []
        frames: list[bytes] = []
        rest = b""

        def put(piece: bytes) -> None:
            ends.append((ends[-1] if ends else 0) + units(piece))
            frames.append(self._compress(piece))

        for portion in portions:
            rest = rest + portion if rest else portion
            at = 0
            while len(rest) - at > self.most:
                end = at + self.most
                while end > at and rest[end] & 0xC0 == 0x80:
                    end -= 1
                end = end if end > at else at + self.most
                put(rest[at:end])
                at = end
            rest = rest[at:]
        if rest:
            put(rest)
        return ends, frames


class FrameReader:
    """Units of a stored text, frame by frame; the last frame read stays open."""

    def __init__(self, ends: list[int], frames: list[bytes]):
        self.ends, self.stored = ends, frames
        self.n = ends[-1] if ends else 0
        self._open = (-1, b"")

    def frame(self, number: int) -> bytes:
        if self._open[0] != number:
            import zstandard

            self._open = (number, zstandard.ZstdDecompressor().decompress(self.stored[number]))
        return self._open[1]

    def read(self, begin: int, end: int) -> Iterator[bytes]:
        """The units from ``begin`` to ``end`` in order; only frames that hold some of them are decompressed."""
        number = bisect_right(self.ends, begin)
        while begin < end:
            first = self.ends[number - 1] if number else 0
            upto = min(end, self.ends[number])
            data = self.frame(number)
            if begin > first or upto < self.ends[number]:
                data = data[byte_of_unit(data, begin - first) : byte_of_unit(data, upto - first)]
            yield data
            begin, number = upto, number + 1
            # frames without a unit go on with the unit before them
            while begin == end and number < len(self.ends) and self.ends[number] == end:
                yield self.frame(number)
                number += 1

    def find(self, mark: bytes, begin: int = 0) -> int:
        """The first unit at or behind ``begin`` where an ASCII mark stands, or -1; also across the border of frames."""
        tail, seen = b"", begin
        for data in self.read(begin, self.n):
            joined = tail + data
            at = joined.find(mark)
            if at >= 0:
                # what the mark has in the tail is ASCII, a unit a byte
                return seen - (len(tail) - at) if at < len(tail) else seen + units(joined[len(tail) : at])
            seen += units(data)
            tail = joined[max(0, len(joined) - len(mark) + 1) :]
        return -1

    def sha256(self, *ranges: tuple[int, int]) -> str:
        digest = hashlib.sha256()
        for begin, end in ranges:
            for data in self.read(begin, end):
                digest.update(data)
        return digest.hexdigest()


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """The first four groups of 32 bits of the id's digest."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def plan(doc_id: int | None, text: FrameReader) -> tuple[str, int, int]:
    """The form of a document and its two cuts, in units."""
    h1, h2, h3, h4 = draws(doc_id)
    if text.n == 0 or h3 % 100 >= PLAIN_FROM or any(text.find(mark) >= 0 for mark in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", 0, 0
    first, second = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
    return "spm" if h4 % 100 < SPM_BELOW else "psm", first, second


def arranged(text: FrameReader, form: str, first: int, second: int) -> Iterator[bytes]:
    """The output as a stream."""
    prefix, middle, suffix = (0, first), (first, second), (second, text.n)
    if form == "plain":
        parts = [(b"", (0, text.n))]
    elif form == "psm":
        parts = [(PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)]
    else:
        parts = [(SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle)]
    for mark, (begin, end) in parts:
        if mark:
            yield mark
        yield from text.read(begin, end)


def original_ranges(output: FrameReader, form: str) -> list[tuple[int, int]]:
    """The ranges of the output that give the text again, in the text's order."""
    if form == "plain":
        return [(0, output.n)]
    size = len(PREFIX)
    last = output.find(MIDDLE, size)
    middle = (last + size, output.n)
    if form == "psm":
        cut = output.find(SUFFIX, size)
        return [(size, cut), middle, (cut + size, last)]
    cut = output.find(PREFIX, size)
    return [(cut + size, last), middle, (size, cut)]


def _records(rows: Iterator[tuple], schema: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of rows whose frames, the last column, have at most ``most`` bytes, or of a single row beyond that."""
    names, types = zip(*(c.split() for c in schema.split(", ")))
    types = [_TYPES[t] for t in types]
    held, size = [], 0
    for row in rows:
        weight = 64 + (sum(map(len, row[-1])) if isinstance(row[-1], list) else 0)
        if held and size + weight > most:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names=list(names))
            held, size = [], 0
        held.append(row)
        size += weight
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names=list(names))


def _mapped(rows_of: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], schema: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _records(rows_of(batches), schema)

    return run


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    writer = FrameWriter()
    for whole in batches:
        for batch in slices(whole, "text"):
            texts = batch.column("text").cast(pa.large_binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                yield (doc_id, *writer.frames([text.as_py()]))


def _stored(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows one by one, so that only one text's frames are Python objects."""
    for batch in batches:
        for row in zip(*(batch.column(c) for c in (*columns, "ends", "frames"))):
            *values, ends, frames = (v.as_py() for v in row)
            yield (*values, FrameReader(ends, frames))


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    writer = FrameWriter()
    for doc_id, text in _stored(batches, "doc_id"):
        form, first, second = plan(doc_id, text)
        sizes = (None, None) if form == "plain" else (first, second - first)
        yield (doc_id, text.n, form, *sizes, *writer.frames(arranged(text, form, first, second)))


_DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
_TEXTS = "doc_id long, form string, output string, restored string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for *row, output in _stored(batches, "doc_id", "n", "form", "prefix_chars", "middle_chars"):
        ranges = original_ranges(output, row[2])
        yield (*row, output.sha256((0, output.n)), output.sha256(*ranges))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for doc_id, form, output in _stored(batches, "doc_id", "form"):
        ranges = original_ranges(output, form)
        restored = b"".join(data for r in ranges for data in output.read(*r))
        yield doc_id, form, b"".join(output.read(0, output.n)).decode(errors="replace"), restored.decode(errors="replace")


def write_store(docs: DataFrame, path: str) -> DataFrame:
    """Write all texts as frames to a new table and read it: ``doc_id, ends, frames``."""
    texts_of(docs).mapInArrow(_mapped(_compress, STORE), STORE).write.option("compression", "none").parquet(path)
    return docs.sparkSession.read.parquet(path)


def transform(store: DataFrame) -> DataFrame:
    """Form, sizes and output per stored document; the output is stored as frames like the text."""
    return store.select("doc_id", "ends", "frames").mapInArrow(_mapped(_transform, RESULT), RESULT)


def digests(transformed: DataFrame) -> DataFrame:
    """Digests of the outputs and of the texts rebuilt from them."""
    return transformed.mapInArrow(_mapped(_digest, _DIGESTS), _DIGESTS)


def texts(transformed: DataFrame) -> DataFrame:
    """``doc_id, form, output, restored`` as plain texts, for use in training."""
    return transformed.select("doc_id", "form", "ends", "frames").mapInArrow(_mapped(_texts, _TEXTS), _TEXTS)


def stored_text(store: DataFrame, begin: int, end: int) -> DataFrame:
    """``doc_id, part``: the units from ``begin`` to ``end`` of each stored text, reading only the frames that hold them."""
    schema = "doc_id long, part string"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text in _stored(batches, "doc_id"):
            yield doc_id, b"".join(text.read(min(begin, text.n), min(end, text.n))).decode(errors="replace")

    return store.select("doc_id", "ends", "frames").mapInArrow(_mapped(rows, schema), schema)


def index(store: DataFrame) -> DataFrame:
    """What a store holds: ``doc_id, n, frames, stored_bytes`` per document."""
    stored = F.aggregate("frames", F.lit(0).cast("long"), lambda total, x: total + F.octet_length(x))
    return store.select(
        "doc_id",
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n"),
        F.size("frames").alias("frames"),
        stored.alias("stored_bytes"),
    )
