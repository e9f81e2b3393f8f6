"""Context-tree weighting over bytes: code length per byte, and a unigram base for comparison.

Each byte is eight binary decisions, and every decision (the bits of the byte seen so far) has its own context tree
over the preceding ``depth`` bytes. A node estimates its bit with Krichevsky and Trofimov's estimator; the
weighted probability of a node is the mean of its own estimate and the product of its children's, so estimates of
all depths are mixed by how well they coded the training texts. Block probabilities depend on counts only, so training
is counting: Spark counts all byte strings of length ``depth + 1`` of all training texts, and sums of these are
the counts of every node.

Every context that occurs in a training text is a node, so the tree grows with the corpus and no evidence is left out. It is a
table: byte strings are dealt out by the ``TOP + 1`` bytes before the coded one, so a task has whole subtrees and works
through them block by block; what they add to the nodes of ``TOP`` bytes is summed by Spark, and these upper levels, which
the alphabet bounds to 65,536 contexts, are weighted on the driver. A second pass over the subtrees goes downwards and gives the
probability of every byte string that occurs in any text, held-out texts included. The ``HOT_GRAMS`` commonest are sent to
the tasks that score; the others are joined. Both ways give the same score, so the bound only decides how many rows travel.

Each text begins after ``depth`` marks 0xFF and ends with one; no UTF-8 text has that byte. The mark is coded
too, so probabilities of all texts add up to 1, and the empty text has a score.

The base: words and one end mark per text, with additive smoothing by counts over all training words. Words are
told apart by a 64-bit hash. Words that make up ``HEAD_SHARE`` of all are sent to the tasks (at most
``1 / HEAD_SHARE`` words); others are joined.

Defined results: null texts are empty; a null id is held out (crc32 of the empty text is 0). Repeated rows are each counted
and scored. Without training texts all counts are 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.text import crc_bucket, fold, run_starts, slices, text_bytes, texts_of, word_bounds, word_hashes
from eventlake.session import fresh_path

DEPTH = 5
TOP = 2
BLOCK_GRAMS = 1 << 16
HOT_GRAMS = 1 << 19
HEAD_SHARE = 1 / (1 << 20)
MARK = 0xFF
SMOOTH = 0.1
_END_KEY = 0
_WORD, _GRAM = 0, 1
_MERGE_AT = 1 << 21


class Tally:
    """Counts of 64-bit values, merged as they come."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, values: np.ndarray, weight: int = 1) -> None:
        found, counts = np.unique(values, return_counts=True)
        self.parts.append((found, counts * weight))
        self.held += len(found)
        if self.held > _MERGE_AT:
            self.merge()

    def merge(self) -> None:
        if not self.parts:
            return
        values, counts = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        starts = np.flatnonzero(run_starts(values))
        if len(values):
            self.parts = [(values[starts], np.add.reduceat(counts, starts))]
        self.held = len(starts)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        values, counts = self.parts[0] if self.parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
        self.parts, self.held = [], 0
        return values, counts


def with_marks(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with ``depth`` marks before each text and one after it, and the places that are coded."""
    n = len(offsets) - 1
    number = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    out = np.full(len(data) + (depth + 1) * n, MARK, dtype=np.uint8)
    out[np.arange(len(data), dtype=np.int64) + depth + (depth + 1) * number] = data
    coded = np.ones(len(out), dtype=bool)
    begins = offsets[:-1] + (depth + 1) * np.arange(n, dtype=np.int64)
    for j in range(depth):
        coded[begins + j] = False
    return out, np.flatnonzero(coded)


def gram_codes(marked: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The byte at each place with the ``depth`` bytes before it, the earliest in the highest byte."""
    code = np.zeros(len(marked), dtype=np.uint64)
    for j in range(depth + 1):
        code[j:] |= marked[: len(marked) - j].astype(np.uint64) << np.uint64(8 * j)
    return code[places]


def _counts(depth: int):
    def rows(kind: int, values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(values), kind, dtype=np.int32))
        return pa.record_batch(
            [kinds, pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["kind", "key", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams, texts = Tally(), Tally(), 0
        for whole in batches:
            for batch in slices(whole, "text"):
                held = batch.column("held_out")
                data, offsets = text_bytes(batch.column("text").filter(held))
                grams.add(gram_codes(*with_marks(data, offsets, depth), depth), 0)
                data, offsets = text_bytes(batch.column("text").filter(pc.invert(held)))
                low = fold(data)
                words.add(word_hashes(low, *word_bounds(low, offsets)[:2]))
                grams.add(gram_codes(*with_marks(data, offsets, depth), depth))
                texts += len(offsets) - 1
                for kind, tally in ((_WORD, words), (_GRAM, grams)):
                    if tally.held > _MERGE_AT // 2:
                        yield rows(kind, *tally.take())
        yield rows(_WORD, *words.take())
        yield rows(_GRAM, *grams.take())
        if texts:
            yield rows(_WORD, np.array([_END_KEY], np.uint64), np.array([texts]))

    return run


def count_corpus(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``kind, key, n``: how often each word and each byte string of ``depth + 1`` occurs.

    Texts marked ``held_out`` (none without that column) add no counts; byte strings of theirs alone have n = 0.
    """
    held_out = F.col("held_out") if "held_out" in texts.columns else F.lit(False)
    counted = texts.select("text", held_out.alias("held_out")).mapInArrow(_counts(depth), "kind int, key long, n long")
    path = fresh_path(texts.sparkSession, "lm-counts")
    counted.groupBy("kind", "key").agg(F.sum("n").alias("n")).write.parquet(path)
    return texts.sparkSession.read.parquet(path)


_LN2 = float(np.log(2.0))
_SMALL = np.cumsum(np.concatenate(([0.0], np.log(np.arange(0, 4096) + 0.5))))  # ln of gamma(n + 1/2) / gamma(1/2)
_WHOLE = np.cumsum(np.concatenate(([0.0], np.log(np.arange(1, 4096)))))  # ln of n!


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series; exact to rounding from 4096 on."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of Krichevsky and Trofimov's probability of a string with so many zeros and ones."""

    def half(n: np.ndarray) -> np.ndarray:
        big = np.maximum(n, 4096)
        return np.where(n < 4096, _SMALL[np.minimum(n, 4095)], _log_gamma(big + 0.5) - 0.5 * np.log(np.pi))

    both = zeros + ones
    whole = np.where(both < 4096, _WHOLE[np.minimum(both, 4095)], _log_gamma(np.maximum(both, 4096) + 1.0))
    return half(zeros) + half(ones) - whole


@dataclass
class Level:
    """Bit decisions of the contexts of one length, sorted by ``codes``: context, then the bits of the byte so far after a 1."""

    codes: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray  # ln of the weighted probability
    own: np.ndarray  # how much of it is the node's own estimate
    one: np.ndarray  # the own estimate that a one follows


def level(codes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, product: np.ndarray | None) -> Level:
    """A level from its counts and the sum of its children's ``weighted``; None for the deepest level."""
    kt = log_kt(zeros, ones)
    weighted = kt if product is None else np.logaddexp(kt, product) - _LN2
    own = np.ones(len(kt)) if product is None else np.exp(kt - _LN2 - weighted)
    return Level(codes, zeros, ones, weighted, own, (ones + 0.5) / (zeros + ones + 1.0))


def code_mask(d: int) -> np.uint64:
    """The bits of a code at level ``d``: ``d`` bytes of context and one of decision."""
    return np.uint64((1 << (8 * (d + 1))) - 1)


def decision_codes(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decisions of each byte string one after the other, and the bit that each took."""
    byte, k = (grams & np.uint64(255))[:, None], np.arange(8, dtype=np.uint64)
    prefix = (np.uint64(1) << k) | (byte >> (np.uint64(8) - k))
    bits = (byte >> (np.uint64(7) - k)) & np.uint64(1)
    return ((grams & ~np.uint64(255))[:, None] | prefix).reshape(-1), bits.reshape(-1).astype(np.int64)


def sums(codes: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct codes, sorted, and the sum of each column of values per code."""
    found, place = np.unique(codes, return_inverse=True)
    return found, *(np.bincount(place, weights=v, minlength=len(found)) for v in values)


def parent_sums(of: Level, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the level above level ``d``, their counts, and the sum of their children's ``weighted``."""
    codes, zeros, ones, product = sums(of.codes & code_mask(d - 1), of.zeros, of.ones, of.weighted)
    return codes, zeros.astype(np.int64), ones.astype(np.int64), product


def subtrees(grams: np.ndarray, n: np.ndarray, depth: int) -> list[Level]:
    """Levels ``min(TOP, depth) + 1`` to ``depth``, the deepest first, from all byte strings of whole subtrees."""
    codes, bits = decision_codes(grams)
    times = np.repeat(n, 8)
    codes, zeros, ones = sums(codes, times * (1 - bits), times * bits)
    levels = [level(codes, zeros.astype(np.int64), ones.astype(np.int64), None)]
    for d in range(depth, min(TOP, depth) + 1, -1):
        levels.append(level(*parent_sums(levels[-1], d)))
    return levels


def mix_level(of: Level, d: int, above: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of a level, the mixture of estimates down to it, and the share left to longer contexts."""
    mixed, share = 0.0, 1.0
    if above is not None:
        place = np.searchsorted(above[0], of.codes & code_mask(d - 1))
        mixed, share = above[1][place], above[2][place]
    return of.codes, mixed + share * of.own * of.one, share * (1.0 - of.own)


def gram_logs(grams: np.ndarray, mixtures: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 of the probability of each string's last byte after the others; ``mixtures`` from the root down.

    A decision is mixed down to the longest context that has it; the share of longer contexts, which have no counts, goes to 1/2.
    """
    codes, bits = decision_codes(grams)
    p, todo = np.full(len(codes), 0.5), np.arange(len(codes))
    for d in range(len(mixtures) - 1, -1, -1):
        known, mixed, share = mixtures[d]
        if not len(known) or not len(todo):
            continue
        looked = codes[todo] & code_mask(d)
        place = np.minimum(np.searchsorted(known, looked), len(known) - 1)
        found = known[place] == looked
        p[todo[found]] = mixed[place[found]] + 0.5 * share[place[found]]
        todo = todo[~found]
    p = np.where(bits == 1, p, 1.0 - p)
    return np.log10(np.clip(p, 1e-300, 1.0)).reshape(-1, 8).sum(axis=1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Byte strings and counts in blocks that hold whole subtrees; rows come sorted by ``part``."""
    held: list[pa.RecordBatch] = []
    size = 0

    def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return table["gram"].to_numpy().view(np.uint64), table["n"].to_numpy()

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK_GRAMS:
            table = pa.Table.from_batches(held)
            part = table["part"].to_numpy()
            cut = int(np.searchsorted(part, part[-1], side="left"))
            if cut:
                yield arrays(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
            size = table.num_rows - cut
    if size:
        yield arrays(pa.Table.from_batches(held))


def _upper_sums(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams, n in _blocks(batches):
            seen = n > 0
            if not seen.any():
                continue
            last = subtrees(grams[seen], n[seen], depth)[-1]
            if depth > TOP:
                codes, zeros, ones, product = parent_sums(last, TOP + 1)
            else:
                codes, zeros, ones, product = last.codes, last.zeros, last.ones, np.zeros(len(last.codes))
            columns = [pa.array(c) for c in (codes.view(np.int64), zeros, ones, product)]
            yield pa.record_batch(columns, ["code", "zeros", "ones", "product"])

    return run


def _all_logs(upper, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams, n in _blocks(batches):
            mixtures, seen = list(upper.value), n > 0
            if depth > TOP and seen.any():
                for d, of in enumerate(reversed(subtrees(grams[seen], n[seen], depth)), TOP + 1):
                    mixtures.append(mix_level(of, d, mixtures[-1]))
            logs = gram_logs(grams, mixtures)
            yield pa.record_batch([pa.array(grams.view(np.int64)), pa.array(n), pa.array(logs)], ["key", "n", "log"])

    return run


def gram_table(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``key, n, log`` for every byte string of ``count_corpus``: log10 of the probability of its last byte after the others."""
    spark = counts.sparkSession
    part = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << (8 * min(TOP + 1, depth))) - 1))
    grams = counts.where(F.col("kind") == _GRAM).select(F.col("key").alias("gram"), "n", part.alias("part"))
    grams = grams.repartition("part").sortWithinPartitions("part")
    rows = grams.mapInArrow(_upper_sums(depth), "code long, zeros long, ones long, product double")
    rows = rows.groupBy("code").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "product")])
    rows = rows.toArrow().sort_by("code")  # at most 255 decisions of contexts of TOP bytes
    lowest = min(TOP, depth)
    product = rows["product"].to_numpy() if depth > TOP else None
    levels = [level(rows["code"].to_numpy().view(np.uint64), rows["zeros"].to_numpy(), rows["ones"].to_numpy(), product)]
    for d in range(lowest, 0, -1):
        levels.append(level(*parent_sums(levels[-1], d)))
    mixtures: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for d, of in enumerate(reversed(levels)):
        mixtures.append(mix_level(of, d, mixtures[-1] if mixtures else None))
    sent = spark.sparkContext.broadcast(mixtures)
    path = fresh_path(spark, "lm-grams")
    grams.mapInArrow(_all_logs(sent, depth), "key long, n long, log double").write.parquet(path)
    return spark.read.parquet(path)


def least_hot(grams: DataFrame, most: int) -> int:
    """A count that at most ``most`` byte strings reach; they are counted by the leading 7 bits of their counts."""
    drop = F.greatest(F.length(F.bin("n")) - 7, F.lit(0))
    floor = F.call_function("shiftleft", F.call_function("shiftright", F.col("n"), drop), drop)
    total, least = 0, (1 << 62)
    for bound, times in sorted(grams.groupBy(floor.alias("floor")).count().collect(), reverse=True):
        total += times
        if total > most:
            break
        least = bound
    return least


class Node:
    """Counts of all bit decisions of the contexts of one level: arrays of (contexts, 256), entry 0 unused."""

    def __init__(self, bytes_seen: np.ndarray):
        sums = np.zeros((len(bytes_seen), 512), dtype=np.int64)
        sums[:, 256:] = bytes_seen
        for bits in range(7, -1, -1):
            low, high = 1 << bits, 2 << bits
            sums[:, low:high] = sums[:, 2 * low : 2 * high : 2] + sums[:, 2 * low + 1 : 2 * high : 2]
        zeros, ones = sums[:, 0::2], sums[:, 1::2]
        self.log_kt = log_kt(zeros, ones)
        self.log_kt[:, 0] = 0.0
        self.one = ((ones + 0.5) / (zeros + ones + 1.0)).astype(np.float32)


class Model:
    """A small tree in memory, with one more child per node for contexts it leaves out; ``gram_table`` is tested against it.

    ``child`` leads from a context to the one a byte longer, ``table`` has log10 of the
    probability of each byte after the longest context that is a node.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], depth: int):
        self.depth = depth
        sizes = [len(contexts) for contexts, _ in levels]
        first = np.concatenate(([0], np.cumsum(sizes))) + 1  # 0 stands for "no node", so longer contexts have larger numbers
        nodes = [Node(seen) for _, seen in levels]
        self.child = np.zeros((int(first[-1]), 256), dtype=np.int32)
        parents = [np.zeros(0, np.int64)]
        for d in range(1, len(levels)):
            contexts = levels[d][0]
            parent = np.searchsorted(levels[d - 1][0], contexts & np.uint64((1 << (8 * (d - 1))) - 1))
            self.child[first[d - 1] + parent, (contexts >> np.uint64(8 * (d - 1))).astype(np.int64)] = first[d] + np.arange(
                sizes[d], dtype=np.int32
            )
            parents.append(parent)
        # from the deepest level up: weighted probabilities, and how much of each is the node's own estimate
        rest: list[Node | np.ndarray | None] = [None] * len(levels)
        own: list[np.ndarray] = [np.empty(0)] * len(levels)
        below = None
        for d in range(len(levels) - 1, -1, -1):
            node = nodes[d]
            if d == depth:
                own[d], below = np.ones_like(node.one), node.log_kt
                continue
            left, product = levels[d][1].copy(), np.zeros_like(node.log_kt)
            if d + 1 < len(levels) and sizes[d + 1]:
                np.subtract.at(left, parents[d + 1], levels[d + 1][1])
                np.add.at(product, parents[d + 1], below)
            rest[d] = Node(left)
            weighted = np.logaddexp(node.log_kt, product + rest[d].log_kt) - _LN2
            own[d], below = np.exp(node.log_kt - _LN2 - weighted).astype(np.float32), weighted
            rest[d] = rest[d].one
        # from the root down: the mixture along the path, and the share that longer contexts have
        rows, mixed, share = [np.zeros((1, 256), np.float32)], None, None
        for d, node in enumerate(nodes):
            came, open_share = (mixed[parents[d]], share[parents[d]]) if d else (0.0, 1.0)
            mixed, share = came + open_share * own[d] * node.one, open_share * (1.0 - own[d])
            nodes[d] = own[d] = None
            rows.append(_byte_logs(mixed if rest[d] is None else mixed + share * rest[d]).astype(np.float32))
        self.table = np.concatenate(rows)

    def contexts(self, marked: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The longest context before each place that is a node."""
        child, step = self.child.reshape(-1), 1 << 16
        longest = np.ones(len(places), dtype=np.int32)
        for begin in range(0, len(places), step):  # blocks that stay in the processor's cache
            where = places[begin : begin + step]
            at, best = np.ones(len(where), dtype=np.int32), longest[begin : begin + step]
            for d in range(1, self.depth + 1):
                at = child.take((at << 8) | marked[where - d])
                np.maximum(best, at, out=best)
        return longest

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 of the probability of each text."""
        marked, places = with_marks(data, offsets, self.depth)
        logs = self.table.reshape(-1).take((self.contexts(marked, places) << 8) | marked[places])
        begins = offsets[:-1] + np.arange(len(offsets) - 1)
        return np.add.reduceat(logs.astype(np.float64), begins) if len(begins) else np.empty(0)


def _byte_logs(one: np.ndarray) -> np.ndarray:
    """log10 of each byte's probability from the probability of a one at each of its decisions."""
    logs = np.zeros((len(one), 1))
    for bits in range(8):
        p = np.clip(one[:, 1 << bits : 2 << bits], 1e-300, 1 - 1e-16)
        logs = np.stack([logs + np.log10(1 - p), logs + np.log10(p)], axis=2).reshape(len(one), 2 << bits)
    return logs


def train(counts: DataFrame, depth: int = DEPTH, node_share: float = 0.0) -> Model:
    """The tree in the driver's memory, for small corpora; nodes are contexts with ``node_share`` of the training bytes."""
    grams = counts.where(F.col("kind") == _GRAM).select(F.col("key").alias("gram"), "n")
    total = grams.agg(F.sum("n")).first()[0] or 0
    least = max(1, int(total * node_share))
    levels: list[tuple[np.ndarray, np.ndarray]] = []
    for d in range(depth + 1):
        code = F.col("gram").bitwiseAND(F.lit((1 << (8 * (d + 1))) - 1))
        seen = grams.groupBy(code.alias("gram")).agg(F.sum("n").alias("n"))
        context = F.shiftrightunsigned("gram", 8)
        of_context = Window.partitionBy("context")  # at most 256 rows
        seen = seen.select(context.alias("context"), F.col("gram").bitwiseAND(F.lit(255)).alias("byte"), "n")
        seen = seen.withColumn("total", F.sum("n").over(of_context)).where(F.col("total") >= least)
        rows = seen.select("context", "byte", "n").toPandas()
        contexts, number = np.unique(rows["context"].to_numpy(np.int64).astype(np.uint64), return_inverse=True)
        table = np.zeros((len(contexts), 256), dtype=np.int64)
        table[number, rows["byte"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
        if d == 0 and not len(contexts):
            contexts, table = np.zeros(1, np.uint64), np.zeros((1, 256), np.int64)
        if d and not len(contexts):
            break
        levels.append((contexts, table))
    return Model(levels, depth)


_SCORED = (
    "row long, doc_id long, held_out boolean, n_bytes long, n_tokens long, known long, base double, score double, "
    "kind int, key long, n long"
)


def _rare_rows(row: int, kind: int, number: np.ndarray, place: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """Rows ``row, kind, key, n`` for keys to be joined: ``keys[place]`` occurs in text ``number``."""
    pairs, times = np.unique(number * len(keys) + place, return_counts=True)
    m = len(pairs)
    columns = [pa.array(row + pairs // max(1, len(keys)))]
    columns += [pa.nulls(m, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
    columns += [pa.array(np.full(m, kind, dtype=np.int32))]
    columns += [pa.array(keys[pairs % max(1, len(keys))].view(np.int64)), pa.array(times.astype(np.int64))]
    return pa.record_batch(columns, [c.split()[0] for c in _SCORED.split(", ")])


def _look_up(wanted: np.ndarray, keys: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is among the sorted keys, and its log or 0."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=bool), np.zeros(len(wanted))
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[place] == wanted
    return found, np.where(found, logs[place], 0.0)


def _score(hot, head, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in slices(whole, "text"):
                data, offsets = text_bytes(batch.column("text"))
                low = fold(data)
                start, end, per_text = word_bounds(low, offsets)
                n = batch.num_rows
                number = np.repeat(np.arange(n), per_text)
                found, inverse = np.unique(word_hashes(low, start, end), return_inverse=True)
                in_head, value = _look_up(found, *head.value)
                known = np.bincount(number, weights=in_head[inverse], minlength=n)
                base = np.bincount(number, weights=value[inverse], minlength=n)
                grams = pa.array(gram_codes(*with_marks(data, offsets, depth), depth)).dictionary_encode()
                codes, at = grams.dictionary.to_numpy(), grams.indices.to_numpy().astype(np.int64)
                is_hot, value = _look_up(codes, *hot.value)
                of_text = np.repeat(np.arange(n), np.diff(offsets) + 1)
                empty = pa.nulls(n, pa.int64())
                yield pa.record_batch(
                    [
                        pa.array(row + np.arange(n, dtype=np.int64)),
                        batch.column("doc_id"),
                        batch.column("held_out"),
                        pa.array(np.diff(offsets).astype(np.int64)),
                        pa.array(per_text.astype(np.int64) + 1),
                        pa.array(known.astype(np.int64)),
                        pa.array(base),
                        pa.array(np.bincount(of_text, weights=value[at], minlength=n)),
                        pa.nulls(n, pa.int32()),
                        empty,
                        empty,
                    ],
                    [c.split()[0] for c in _SCORED.split(", ")],
                )
                rare = ~in_head[inverse]
                yield _rare_rows(row, _WORD, number[rare], inverse[rare], found)
                rare = ~is_hot[at]
                yield _rare_rows(row, _GRAM, of_text[rare], at[rare], codes)
                row += n

    return run


def score_documents(docs: DataFrame, depth: int = DEPTH, held_out_of: int = 10, hot_grams: int = HOT_GRAMS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte`` per document.

    Trained on documents whose ``crc32(doc_id as text) mod held_out_of`` is not 0; all are scored.
    """
    spark = docs.sparkSession
    texts = texts_of(docs).withColumn("held_out", crc_bucket(F.col("doc_id"), held_out_of) == 0)
    counts = count_corpus(texts, depth)
    grams = gram_table(counts, depth)
    cold = F.col("n") < least_hot(grams, hot_grams)
    words = counts.where(F.col("kind") == _WORD).select("key", F.col("n").alias("c"))
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    log_c = F.log10(F.col("c") + SMOOTH)
    frequent = F.col("c") >= max(1.0, total * HEAD_SHARE)
    head = words.where(frequent).toPandas().sort_values("key", key=lambda k: k.to_numpy().view(np.uint64))
    ends = int(head.loc[head["key"] == _END_KEY, "c"].sum())
    if not ends:  # the end mark may be too rare to be in the head
        ends = (words.where(F.col("key") == _END_KEY).agg(F.sum("c")).first()[0]) or 0
    context = spark.sparkContext
    keys = head["key"].to_numpy(np.int64).view(np.uint64)
    top = grams.where(~cold).select("key", "log").toArrow()  # at most hot_grams rows, keys of 48 bits
    order = np.argsort(top["key"].to_numpy())
    hot = context.broadcast((top["key"].to_numpy()[order].view(np.uint64), top["log"].to_numpy()[order]))
    del top
    sent = (hot, context.broadcast((keys, np.log10(head["c"].to_numpy(float) + SMOOTH))))
    path = fresh_path(spark, "lm-scores")
    texts.mapInArrow(_score(*sent, depth), _SCORED).write.parquet(path)
    scored = spark.read.parquet(path)
    rare = scored.where(F.col("kind") == _WORD).select("row", "key", "n")
    rare = rare.join(words.where(~frequent), "key").groupBy("row")
    rare = rare.agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * log_c).alias("more_base"))
    more = scored.where(F.col("kind") == _GRAM).select("row", "key", F.col("n").alias("times"))
    more = more.join(grams.where(cold).select("key", "log"), "key").groupBy("row")
    more = more.agg(F.sum(F.col("times") * F.col("log")).alias("more_score"))
    documents = scored.where(F.col("kind").isNull()).drop("kind", "key", "n").join(rare, "row", "left").join(more, "row", "left")
    documents = documents.withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
    known = F.col("known") + F.coalesce("more_known", F.lit(0)) + (1 if ends else 0)
    unknown = (F.col("n_tokens") - F.col("n_known")) * float(np.log10(SMOOTH))
    documents = documents.withColumn("n_known", known.cast("long"))
    end_log = float(np.log10(ends + SMOOTH)) if ends else 0.0
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0)) + end_log + unknown
    norm = float(np.log10(total + SMOOTH * (distinct + 1)))
    return documents.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (base - F.col("n_tokens") * norm).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") / float(np.log10(2.0)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
