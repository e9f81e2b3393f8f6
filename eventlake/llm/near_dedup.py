"""Near-duplicates by bottom-k sketches of word shingles from one hash function.

A document's set is its distinct shingles of WORDS words, each hashed once; the ``k`` smallest hashes are its sketch. Documents
with equal sets are one node. Then:

1. Inverted lists. Two sets of the similarity asked for share at least ``c`` of their retained values (exactly so if sketches
   are whole sets, else but for a chance below ``MISS``). So they share one of the ``k - c + 1`` rarest of each, and only
   those are listed. Values that only one node retains make no list; a passage that many documents share is never
   among the rarest of documents that differ elsewhere.
2. Leaders. In each list every member is compared with the most central member, the one whose values most nodes share. Groups
   of thousands of copies are mostly settled by as many comparisons. Members linked to one leader have one label.
3. The rest. Lists that still have several labels compare all members of different labels, in cells, so that long lists are
   spread over tasks; a pair is looked at in its first common list only. Only pairs become rows that pass the estimate and a
   certain bound on how many values they differ in, from parity bits of the full sets.
4. A pair passes if its similarity, estimated from the sketch of the union, is not below what MISS of true links fall short of; it is a
   link if the exact similarity of the full sets reaches it.
5. Components of the links, by alternating large and small stars.

Defined results: null and empty texts have no shingles and link with nothing. Fewer than WORDS words make one
shingle. Equal texts, repeated rows among them, are linked. The id of a component is its smallest document id; null ids are ignored
for that, and a row with a null id is kept only if its component has no other id. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.text import combine, fold, mix, run_starts, slices, text_bytes, texts_of, word_bounds, word_hashes
from eventlake.session import fresh_path
from eventlake.sources.tables import drop_path

WORDS = 5
K = 64
MISS = 1e-7
ROUNDS = 2
CELL_ROWS = 256
ODD_BITS = 512
BITMAP_BITS = 1 << 26


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text one after the other, and where each text begins."""
    data, offsets = text_bytes(texts)
    low = fold(data)
    start, end, per_text = word_bounds(low, offsets)
    hashes = word_hashes(low, start, end)
    n = len(texts)
    number = np.repeat(np.arange(n, dtype=np.int64), per_text)
    values, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    if len(hashes) >= words:
        whole = np.flatnonzero(number[words - 1 :] == number[: len(number) - words + 1])
        values.append(combine([hashes[whole + j] for j in range(words)]))
        owners.append(number[whole])
    first = np.cumsum(per_text) - per_text
    for size in range(1, words):
        short = np.flatnonzero(per_text == size)
        values.append(mix(combine([hashes[first[short] + j] for j in range(size)]) + np.uint64(size)))
        owners.append(short)
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = run_starts(value) | run_starts(owner)
    value, owner = value[fresh], owner[fresh]
    return value, np.searchsorted(owner, np.arange(n + 1))


def set_name(values: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _lists(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - begins
    place = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values[place].view(np.int64)))


def odd_sketches(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each set ODD_BITS bits: whether an odd number of its values falls into a bucket.

    Two sets differ in at least as many values as their sketches differ in bits.
    """
    n = len(begins) - 1
    owner = np.repeat(np.arange(n), np.diff(begins))
    bucket = (values >> np.uint64(20)).astype(np.int64) & (ODD_BITS - 1)
    odd = np.bincount(owner * ODD_BITS + bucket, minlength=n * ODD_BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, ODD_BITS), axis=1).view(np.int64)


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                values, begins = shingles(batch.column("text"))
                names = [set_name(values[a:b]) if b > a else None for a, b in zip(begins[:-1], begins[1:])]
                sketch = _lists(values, begins[:-1], np.minimum(begins[1:], begins[:-1] + k))
                odd = pa.FixedSizeListArray.from_arrays(pa.array(odd_sketches(values, begins).reshape(-1)), ODD_BITS // 64)
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array(np.diff(begins)), pa.array(names, pa.binary()), sketch,
                     odd.cast(pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "node", "sketch", "odd"],
                )

    return run


def tail_cut(threshold: float, k: int) -> int:
    """The largest count that fewer than MISS of draws of ``k`` values at the threshold's similarity fall short of (binomial tail)."""
    below, least = 0.0, 0
    while least < k:
        below += math.comb(k, least) * threshold**least * (1 - threshold) ** (k - least)
        if below > MISS:
            break
        least += 1
    return least


def least_shared(size: int, threshold: float, k: int) -> int:
    """How many retained values a set with a sketch of ``size`` shares with any set of the threshold's similarity.

    A smaller set's partner is retained whole as well, so the bound is certain. Otherwise the shared values are drawn
    from the union without replacement; the binomial tail is above that chance.
    """
    certain = math.ceil(threshold * size - 1e-9)
    if size <= threshold * k:
        return certain
    return max(1, min(certain, tail_cut(threshold, k)))


def estimate(a: Column, b: Column, k: int) -> Column:
    """Similarity from the union's sketch: the share of its values that both sketches have."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    return F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union)


def close_sizes(a: Column, b: Column, threshold: float) -> Column:
    return F.least(a, b) >= threshold * F.greatest(a, b) - 1e-9


def may_be_close(a: Column, b: Column, threshold: float) -> Column:
    """False for sets that differ in more values than sets of the similarity asked for can; never false for those.

    ``a`` and ``b`` have ``n_shingles`` and ``odd``.
    """
    differ = sum(F.bit_count(a["odd"][i].bitwiseXOR(b["odd"][i])) for i in range(ODD_BITS // 64))
    return differ <= (a["n_shingles"] + b["n_shingles"]) * ((1 - threshold) / (1 + threshold)) + 1e-9


def inverted_lists(nodes: DataFrame, threshold: float, k: int) -> DataFrame:
    """``value, node, n_shingles, weight, prefix``: the lists of the rarest retained values.

    ``weight`` says how much a node's values are shared; ``prefix`` has all values the node is listed under.
    """
    postings = nodes.select("node", "n_shingles", F.explode("sketch").alias("value"))
    shared = postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
    held = postings.join(shared, "value").groupBy("node", "n_shingles").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("held")  # at most k
    )
    least = F.array(*[F.lit(least_shared(s, threshold, k)) for s in range(k + 1)])
    size = F.least(F.col("n_shingles"), F.lit(k)).cast("int")
    listed = F.size("held") - F.get(least, size) + 1  # the rarest are those that no list holds
    rows = held.withColumn("listed", listed).where(F.col("listed") > 0)
    prefix = F.transform(F.slice("held", 1, F.greatest(F.col("listed"), F.lit(0))), lambda x: x["value"])
    weight = F.aggregate("held", F.lit(0).cast("long"), lambda total, x: total + x["df"])
    rows = rows.select("node", "n_shingles", weight.alias("weight"), prefix.alias("prefix"))
    rows = rows.select("*", F.explode("prefix").alias("value"))
    size = rows.groupBy("value").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    return rows.join(size, "value")


def _full_sets(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value
        for whole in batches:
            for batch in slices(whole, "text"):
                slot = batch.column("slot").to_numpy()
                batch = batch.filter(pa.array((bitmap[slot >> 3] >> (slot & 7)) & 1 == 1))
                if batch.num_rows:
                    values, begins = shingles(batch.column("text"))
                    names = [set_name(values[a:b]) if b > a else None for a, b in zip(begins[:-1], begins[1:])]
                    full = _lists(values, begins[:-1], begins[1:])
                    yield pa.record_batch([batch.column("doc_id"), pa.array(names, pa.binary()), full], ["doc_id", "node", "full"])

    return run


def full_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, full`` for the wanted ``node, first_id``, from the texts, which stay where they are.

    Ids are marked in a bitmap of fixed size, so tasks read texts of wanted nodes and some others; the join
    drops the others.
    """
    spark = texts.sparkSession
    def slot(doc_id: str) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(F.col(doc_id), F.lit(-1))), F.lit(BITMAP_BITS))

    # buckets of 32,768 bits are numbered from 1, for slots from 1 on
    marks = wanted.select((slot("first_id") + 1).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
    marks = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bitmap = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for bucket, bits in marks.collect():  # at most BITMAP_BITS bits
        bitmap[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bits, np.uint8)
    sent = spark.sparkContext.broadcast(bitmap)
    rows = texts.select("doc_id", "text", slot("doc_id").alias("slot"))
    rows = rows.mapInArrow(_full_sets(sent), "doc_id long, node binary, full array<bigint>")
    # by node alone, so that rows alike are dropped where they meet
    found = rows.join(wanted, "node").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    return found.select("node", "full").dropDuplicates(["node"])


class Linker:
    """Checks pairs of nodes; sketches and full sets are tables."""

    def __init__(self, sketches: DataFrame, sets: DataFrame, threshold: float, k: int):
        self.sketches, self.sets, self.threshold, self.k = sketches, sets, threshold, k
        self.least = tail_cut(threshold, k) / k - 1e-9

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs ``a, b`` that the bound on differing values and the estimate let pass."""
        facts = F.struct("n_shingles", "odd")
        a = self.sketches.select(F.col("node").alias("a"), facts.alias("a_facts"))
        b = self.sketches.select(F.col("node").alias("b"), facts.alias("b_facts"))
        # the narrow bound first, so that wider columns travel for fewer pairs
        close = may_be_close(F.col("a_facts"), F.col("b_facts"), self.threshold)
        pairs = pairs.join(a, "a").join(b, "b").where(close).select("a", "b")
        a = self.sketches.select(F.col("node").alias("a"), F.col("sketch").alias("a_sketch"))
        b = self.sketches.select(F.col("node").alias("b"), F.col("sketch").alias("b_sketch"))
        found = pairs.join(a, "a").join(b, "b")
        return found.where(estimate(F.col("a_sketch"), F.col("b_sketch"), self.k) >= self.least).select("a", "b")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets reach the threshold."""
        a = self.sets.select(F.col("node").alias("a"), F.col("full").alias("a_full"))
        b = self.sets.select(F.col("node").alias("b"), F.col("full").alias("b_full"))
        found = pairs.join(b, "b").join(a, "a")
        both = F.size(F.array_intersect("a_full", "b_full"))
        found = found.select("a", "b", both.alias("both"), (F.size("a_full") + F.size("b_full") - both).alias("either"))
        percent = round(self.threshold * 100)
        return found.where(100 * F.col("both") >= percent * F.col("either")).select("a", "b").distinct()


def leader_pairs(lists: DataFrame, threshold: float) -> DataFrame:
    """Each member of a list that has several labels with the most central member that is not of the commonest label.

    Without labels (the first round) that is the most central member. Ties go to the smaller node.
    """
    best = F.min_by(F.struct("node", "n_shingles", "label"), F.struct(-F.col("weight"), "node"))
    leaders = lists.where("open").groupBy("value").agg(best.alias("leader"))
    pairs = lists.join(leaders, "value").where(
        (F.col("label") != F.col("leader.label")) & close_sizes(F.col("n_shingles"), F.col("leader.n_shingles"), threshold)
    )
    a, b = F.col("leader.node"), F.col("node")
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def relabel(lists: DataFrame, links: DataFrame) -> DataFrame:
    """Lists that have several labels left, members labelled by the smallest node they are linked to.

    ``open`` marks the members that do not have the list's smallest label; the next leader is one of them.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("linked"))
    rows = lists.drop("label", "open").join(label, "node", "left")
    rows = rows.withColumn("label", F.least("node", F.coalesce("linked", "node"))).drop("linked")
    # one step more: the label of the label
    more = rows.select(F.col("node").alias("label"), F.col("label").alias("next")).distinct()
    rows = rows.join(more, "label", "left").withColumn("label", F.coalesce("next", "label")).drop("next")
    span = rows.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    rows = rows.join(span.where(F.col("low") != F.col("high")), "value")
    return rows.withColumn("open", F.col("label") != F.col("low")).drop("low", "high")


def remaining_pairs(lists: DataFrame, sketches: DataFrame, linker: Linker) -> DataFrame:
    """All pairs of different labels in the lists, each in the first list of both, whose estimate passes.

    A list has ``members / CELL_ROWS`` tiles; a cell joins two of them, so a long list is many cells.
    """
    tiles = F.ceil(F.col("members") / CELL_ROWS)
    rows = lists.join(sketches.select("node", "sketch", "odd"), "node")
    rows = rows.withColumn("facts", F.struct("n_shingles", "odd"))
    rows = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    cell = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1),
        lambda other: F.struct(F.least("tile", other).alias("i"), F.greatest("tile", other).alias("j")),
    )
    rows = rows.select("value", "node", "n_shingles", "label", "prefix", "sketch", "facts", "tile", F.explode(cell).alias("cell"))
    a, b = rows.alias("a"), rows.alias("b")
    meets = (
        (F.col("a.value") == F.col("b.value"))
        & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.node") < F.col("b.node"))
        & (F.col("a.label") != F.col("b.label"))
        & (F.col("a.cell.i") == F.least("a.tile", "b.tile"))
        & (F.col("a.cell.j") == F.greatest("a.tile", "b.tile"))
        & close_sizes(F.col("a.n_shingles"), F.col("b.n_shingles"), linker.threshold)
        & may_be_close(F.col("a.facts"), F.col("b.facts"), linker.threshold)
        & (F.array_min(F.array_intersect("a.prefix", "b.prefix")) == F.col("a.value"))
        & (estimate(F.col("a.sketch"), F.col("b.sketch"), linker.k) >= linker.least)
    )
    return a.join(b, meets).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of a link: the smallest node it can reach.

    Large and small stars in turn (each node points its neighbours to the smallest of them) until nothing changes. A
    step is a grouped minimum and a join, and its result a table.
    """
    spark = links.sparkSession

    last = None

    def stored(df: DataFrame) -> tuple[DataFrame, tuple]:
        nonlocal last
        path = fresh_path(spark, "near-stars")
        df.distinct().write.parquet(path)
        release(spark, last)
        last = path
        df = spark.read.parquet(path)
        mark = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return df, tuple(mark)

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Edges ``u > v``; every ``u`` joins its neighbours (the larger or the smaller) to its least neighbour."""
        around = edges.select("u", "v")
        if large:
            around = around.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        joined = around.join(least, "u")
        if large:
            joined = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            return joined.where(F.col("u") != F.col("v"))
        moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v"))

    edges, mark = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while mark[0]:
        edges, after = stored(star(star(edges, large=True), large=False))
        if after == mark:
            break
        mark = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def release(spark: SparkSession, *paths: str | None) -> None:
    """Remove intermediate tables that nothing reads any longer, and let the shuffles of finished jobs go.

    Spark keeps shuffle files until the driver's garbage collector finds their jobs unused, which with much free memory is long
    after. What comes later reads tables only, so a lost executor does not ask for either.
    """
    for path in paths:
        if path:
            drop_path(spark, path)
    spark.sparkContext._jvm.System.gc()


def classes(docs: DataFrame, threshold: float = 0.85, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, node`` per document."""
    spark = docs.sparkSession
    texts = texts_of(docs)

    held: dict[str, str] = {}

    def table(df: DataFrame, label: str) -> DataFrame:
        """Write a table and read it; the earlier one of that label has been read for the last time."""
        path = fresh_path(spark, label)
        df.write.parquet(path)
        release(spark, held.get(label))
        held[label] = path
        return spark.read.parquet(path)

    signed = texts.mapInArrow(_sign(k), "doc_id long, n_shingles long, node binary, sketch array<bigint>, odd array<bigint>")
    signed = table(signed, "near-sketches")
    nodes = signed.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("first_id"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch"),
        F.first("odd").alias("odd"),
    )
    nodes = table(nodes, "near-nodes")
    signed = table(signed.drop("sketch", "odd"), "near-sketches")
    lists = table(inverted_lists(nodes, threshold, k), "near-lists")
    members = lists.select("node").distinct()
    wanted = table(nodes.join(members, "node", "left_semi"), "near-members")
    nodes = table(nodes.select("node", "first_id"), "near-nodes")
    sets = table(full_sets(texts, wanted.select("node", "first_id")), "near-sets")
    linker = Linker(wanted.select("node", "n_shingles", "sketch", "odd"), sets, threshold, k)
    links = None
    lists = lists.withColumn("label", F.col("node")).withColumn("open", F.lit(True))
    for _ in range(ROUNDS):
        likely = table(linker.likely(leader_pairs(lists, threshold)), "near-likely")
        found = linker.links(likely)
        links = table(found if links is None else links.unionByName(found).distinct(), "near-links")
        lists = table(relabel(lists, links), "near-lists")
    likely = table(remaining_pairs(lists, linker.sketches, linker).distinct(), "near-likely")
    links = table(links.unionByName(linker.links(likely)), "near-links")
    release(spark, *(held.pop(label) for label in ("near-lists", "near-members", "near-sets", "near-likely")))
    roots = components(links)
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = table(named.join(smallest, "root").select("node", "component_id"), "near-classes")
    release(spark, held.pop("near-nodes"), held.pop("near-links"))
    result = signed.join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    result = result.withColumn("component_id", component)
    return result.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "node"
    )


def keep_one(docs: DataFrame, threshold: float = 0.8, k: int = K) -> DataFrame:
    """The documents without near copies: of each component the one with the smallest id, all columns as they were.

    Of rows that repeat that id one stays. Rows without an id cannot be told apart and stay unless they are near a
    document with one.
    """
    chosen = classes(docs, threshold, k).where("kept").groupBy(F.col("doc_id").alias("chosen"))
    path = fresh_path(docs.sparkSession, "near-kept")
    chosen.agg(F.count(F.lit(1)).alias("times")).write.parquet(path)
    chosen = docs.sparkSession.read.parquet(path)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"))
    once = (F.col("times") == 1) | F.col("chosen").isNull()
    kept = rows.join(chosen.where(once), F.col("id").eqNullSafe(F.col("chosen")), "left_semi").select("row")
    if not chosen.where(~once).isEmpty():
        again = rows.join(chosen.where(~once), F.col("id") == F.col("chosen"))
        kept = kept.unionByName(again.groupBy("id").agg(F.first("row").alias("row")).select("row"))
    return kept.select("row.*")
