"""Words, hashes and Arrow helpers shared by the operators of this package.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; case folding is that of A-Z only.
Null texts count as empty texts everywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LONG_WORD = 64


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, _UPPER, _LOWER)


def word_count(text: Column) -> Column:
    """Number of words of a text as long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of a documents frame, nulls as empty texts; other columns are left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice has at most ``max_bytes`` of text, or a single row beyond that."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for row, length in enumerate(lengths):
        if total and total + length > max_bytes:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += int(length)
    if batch.num_rows > begin:
        yield batch.slice(begin)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each text begins (one more entry than texts)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    with np.errstate(over="ignore"):
        values = values + _STEP
        values = (values ^ (values >> np.uint64(30))) * _MIX1
        values = (values ^ (values >> np.uint64(27))) * _MIX2
    return values ^ (values >> np.uint64(31))


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word in ``data``, and how many words each text has. No word crosses texts."""
    inside = np.ones(len(data) + 1, dtype=bool)
    inside[:-1] = (data != 32) & ((data < 9) | (data > 13))
    inside[-1] = False
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True  # a text begins here, so a word that touches it begins or ends here as well
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    begins = inside & (first | ~before)
    ends = before & (first | ~inside)
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return start, end, np.diff(np.searchsorted(start, offsets))


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word; bytes are taken column by column, so cost follows the bytes."""
    length = end - start
    out = length.astype(np.uint64)
    clipped = np.minimum(length, _LONG_WORD + 1)  # longer words count as one byte too long, so that sizes are sorted
    order = np.argsort(-clipped, kind="stable")
    at, sizes = start[order], clipped[order]
    acc = np.zeros(len(order), dtype=np.uint64)
    usual = int(np.searchsorted(-sizes, -_LONG_WORD, side="left"))  # longer words come first
    with np.errstate(over="ignore"):
        for j in range(int(sizes[usual]) if usual < len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -j, side="left"))
            acc[usual:n] = (acc[usual:n] + low[at[usual:n] + j] + np.uint64(1)) * _STEP
    for i in range(usual):
        word = low[at[i] : end[order[i]]].tobytes()
        acc[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    with np.errstate(over="ignore"):
        out[order] = acc + out[order] * _MIX2
    return mix(out)


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of several columns of hashes; order matters."""
    acc = np.zeros(len(parts[0]), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            acc = (acc ^ part) * _MIX1 + _STEP
    return mix(acc)


def run_starts(values: np.ndarray) -> np.ndarray:
    """True where a value of a sorted array differs from the one before it."""
    out = np.ones(len(values), dtype=bool)
    if len(values) > 1:
        out[1:] = values[1:] != values[:-1]
    return out
