"""URL filter: host and path rules decide, mined association rules judge the rest.

URLs that a listed rule decides are the labelled ones. Every URL becomes the set of all its tokens: top level domain and every
other host label, every path segment with its place, file extension, every query key. Spark's FP-growth mines the token
combinations that go with a verdict; rules below the support or confidence asked for, and rules that a more
general one makes superfluous, are pruned. The rest form an inverted index: each rule is posted under
its rarest token, and a URL's tokens look up the rules it may match.

Two things keep mining within bounds and lose no rule. A token below the support can be in no rule. A token that only goes with
one verdict is a rule by itself that makes all its combinations superfluous, so it is no item of the mining. What is left of a URL is
one whole transaction. FP-growth gives all its combinations; if a URL has more than WIDTH such tokens, these may be too many, and
the sets are mined level by level instead, without those that cannot be part of a rule that stays. The rules are the same.

Support is a number of URLs, ``min_count``, whatever the size of the table; only beyond ``min_count * most_items`` labelled URLs does it
grow, as FP-growth keeps the frequent items on the driver.

Defined results: a null URL, or one without ``://``, has an empty host and path and no tokens, matches no
rule and gets the default verdict. Repeated rows are judged alike and all kept; each counts. With no labelled URL there
are no mined rules and the default holds. Columns other than the id and the URL are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.text import ascii_lower
from eventlake.session import fresh_path

WIDTH = 12
# copies of one transaction that one row stands for when they are written out for the mining
_COPIES = 1 << 16


@dataclass(frozen=True)
class Rule:
    """``host/path-prefix`` with the verdict for matching URLs; fits the host and all its subdomains."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule; among equally long ones the one with the longer host. Null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r.pattern), -len(r.host), r.pattern))
    found = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.pattern)).otherwise(found)
    return found


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens ``field=value`` of a URL; positions of path segments count from 1, empty parts do not."""

    def parts(text: Column, separator: str) -> Column:
        return F.filter(F.split(text, separator), lambda x: x != "")

    def named(name: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.concat(F.lit(f"{name}="), x))

    labels = parts(host, r"\.")
    kind = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    return F.array_distinct(
        F.concat(
            named("tld", F.slice(labels, F.greatest(F.size(labels), F.lit(1)), 1)),
            named("label", F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0)))),
            F.transform(
                parts(path, "/"), lambda x, i: F.concat(F.lit("seg"), (i + 1).cast("string"), F.lit("="), x)
            ),
            named("kind", F.filter(F.array(kind), lambda x: x != "")),
            named("key", F.filter(F.transform(parts(query, "&"), lambda x: F.regexp_extract(x, "(?s)^[^=]*", 0)), lambda x: x != "")),
        )
    )


def transactions(sets: DataFrame, items: DataFrame) -> DataFrame:
    """``tokens, verdict, n``: the tokens of each set that are among ``items``, all of them, sorted.

    ``sets`` has ``tokens, verdict, n`` with ``n`` URLs each, ``items`` has ``token``.
    """
    rows = sets.select(F.col("tokens").alias("all"), "verdict", "n", F.explode("tokens").alias("token"))
    kept = rows.join(items, "token").groupBy("all", "verdict", "n").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    return kept.groupBy("tokens", "verdict").agg(F.sum("n").alias("n"))


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = fresh_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def mined_sets(rows: DataFrame, least: int) -> DataFrame:
    """``tokens, verdict, freq``: token sets with (or, verdict null, whatever) the verdict of ``least`` URLs or more.

    Sets that are missing can only make rules that a more general one makes superfluous.
    """
    rows = _stored(rows, "url-transactions")
    number, width = rows.agg(F.sum("n"), F.max(F.size("tokens"))).first()
    if not number:
        return rows.select("tokens", "verdict", F.col("n").alias("freq"))
    return frequent_sets(rows, least, number) if width <= WIDTH else free_sets(rows, least)


def frequent_sets(rows: DataFrame, least: int, number: int) -> DataFrame:
    """All sets of transactions of ``number`` URLs, by FP-growth."""
    # n copies, made from arrays of bounded length
    lots = rows.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _COPIES))))
    left = F.least(F.col("n") - F.col("lot") * _COPIES, F.lit(_COPIES))
    copies = lots.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
    items = copies.select(F.array_append("tokens", F.concat(F.lit("verdict="), "verdict")).alias("items"))
    # the half keeps rounding from asking for one URL more
    mined = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / number).fit(items).freqItemsets
    return mined.select(
        F.sort_array(F.filter("items", lambda x: ~x.startswith("verdict="))).alias("tokens"),
        F.expr("substr(get(filter(items, x -> startswith(x, 'verdict=')), 0), 9)").alias("verdict"),
        "freq",
    ).where(F.size("tokens") > 0)


def free_sets(rows: DataFrame, least: int) -> DataFrame:
    """Sets of whole transactions, however wide, one token more at a level; only those that a rule that stays may have.

    A set that is in as many URLs as one with a token less says nothing more than that one, nor does any set that holds
    it; a set that goes with one verdict only makes all larger ones superfluous. Neither grows. So tokens that always come together cost
    a pair each, not their combinations. Sets of one level that differ in their last token meet within their transaction.
    """
    rows = _stored(rows.withColumn("id", F.monotonically_increasing_id()), "url-numbered")
    numbers = rows.select("id", "verdict", "n")
    held = rows.select("id", F.explode("tokens").alias("token")).select("id", F.array("token").alias("tokens"))
    alive, found, level = None, None, 1
    while True:
        by_verdict = held.join(numbers, "id").groupBy("tokens", "verdict").agg(F.sum("n").alias("freq"))
        sums = by_verdict.groupBy("tokens").agg(
            F.sum("freq").alias("total"), F.max("freq").alias("most"), F.collect_list(F.struct("verdict", "freq")).alias("parts")
        )
        sums = sums.where(F.col("most") >= least)
        if alive is not None:
            less = F.transform(F.sequence(F.lit(0), F.size("tokens") - 1), lambda i: F.filter("tokens", lambda _, j: j != i))
            part = alive.select(F.col("tokens").alias("part"), F.col("total").alias("part_total"))
            parts = sums.select("tokens", F.explode(less).alias("part")).join(part, "part").groupBy("tokens")
            free = parts.agg(F.count(F.lit(1)).alias("parts_alive"), F.min("part_total").alias("least_part"))
            sums = sums.join(free, "tokens").where((F.col("parts_alive") == level) & (F.col("least_part") > F.col("total")))
        sums = _stored(sums.select("tokens", "total", "most", "parts"), "url-level")
        all_verdicts = F.array_append("parts", F.struct(F.lit(None).cast("string").alias("verdict"), F.col("total").alias("freq")))
        mined = sums.select("tokens", F.inline(all_verdicts)).where(F.col("freq") >= least)
        found = mined if found is None else found.unionByName(mined)
        alive = sums.where(F.col("most") < F.col("total"))
        if alive.isEmpty():
            return found
        held = _stored(held.join(alive.select("tokens"), "tokens", "left_semi"), "url-held")
        ends = held.select("id", F.slice("tokens", 1, level - 1).alias("start"), F.element_at("tokens", -1).alias("end"))
        a, b = ends.alias("a"), ends.alias("b")
        pairs = a.join(b, (F.col("a.id") == F.col("b.id")) & (F.col("a.start") == F.col("b.start")) & (F.col("a.end") < F.col("b.end")))
        held = pairs.select("a.id", F.concat("a.start", F.array("a.end", "b.end")).alias("tokens"))
        level += 1


def mine_rules(
    labelled: DataFrame, min_count: int = 10, min_confidence: float = 0.8, most_items: int = 1_000_000
) -> DataFrame:
    """Association rules ``tokens, verdict, hits, total`` from rows of ``tokens, verdict``.

    ``hits`` of ``total`` URLs with all these tokens have the verdict; hits reach ``min_count``, or the ``most_items``-th part of
    the labelled URLs if that is more. A rule goes if a rule of fewer of its tokens, for the same verdict, is at least as sure.
    """
    spark = labelled.sparkSession
    path = fresh_path(spark, "url-sets")
    labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    sets = spark.read.parquet(path)
    number = sets.agg(F.sum("n")).first()[0] or 0
    least = max(min_count, -(-number // most_items))
    single = sets.select(F.explode("tokens").alias("token"), "verdict", "n").groupBy("token").agg(
        F.sum("n").alias("total"), F.min("verdict").alias("verdict"), (F.min("verdict") == F.max("verdict")).alias("pure")
    )
    path = fresh_path(spark, "url-items")
    single.where(F.col("total") >= least).write.parquet(path)
    single = spark.read.parquet(path)
    pure = single.where("pure").select(F.array("token").alias("tokens"), "verdict", F.col("total").alias("hits"), "total")
    mined = mined_sets(transactions(sets, single.where("not pure").select("token")), least)
    totals = mined.where(F.col("verdict").isNull()).select("tokens", F.col("freq").alias("total"))
    found = (
        mined.where(F.col("verdict").isNotNull())
        .join(totals, "tokens")
        .where(F.col("freq") >= F.col("total") * min_confidence)
        .select("tokens", "verdict", F.col("freq").alias("hits"), "total")
    )
    # each rule looks for the rules of one token less, two tokens less and so on: no more subsets than were mined, or 2 ** WIDTH
    subsets = F.transform(
        F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size("tokens")) - 2),
        lambda mask: F.filter("tokens", lambda _, i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1)) == 1),
    )
    wider = found.where(F.size("tokens") > 1).select(
        F.col("tokens").alias("rule"), "verdict", "hits", "total", F.explode(subsets).alias("tokens")
    )
    general = found.select("tokens", "verdict", F.col("hits").alias("g_hits"), F.col("total").alias("g_total"))
    superfluous = (
        wider.join(general, ["tokens", "verdict"])
        .where(F.col("g_hits") * F.col("total") >= F.col("hits") * F.col("g_total"))
        .select(F.col("rule").alias("tokens"), "verdict")
        .distinct()
    )
    return found.join(superfluous, ["tokens", "verdict"], "left_anti").unionByName(pure)


def match_rules(profiles: DataFrame, rules: DataFrame) -> DataFrame:
    """Best rule per distinct token set: ``tokens, verdict``; token sets that match none are missing.

    The surest rule wins, then the one seen more often, the one with more tokens, the smaller tokens and
    the smaller verdict.
    """
    frequency = profiles.select(F.explode("tokens").alias("token")).groupBy("token").count()
    postings = (
        rules.withColumn("token", F.explode("tokens"))
        .join(frequency, "token")
        .groupBy(F.col("tokens").alias("rule"), "verdict", "hits", "total")
        .agg(F.min(F.struct("count", "token"))["token"].alias("token"))
    )
    looked_up = profiles.select("tokens", F.explode("tokens").alias("token")).join(postings, "token")
    matched = looked_up.where(F.size(F.array_except("rule", "tokens")) == 0)
    order = F.struct(
        -(F.col("hits") / F.col("total")), -F.col("total"), -F.size("rule"), F.col("rule"), F.col("verdict")
    )
    return matched.groupBy("tokens").agg(F.min_by("verdict", order).alias("mined"))


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "block",
    min_count: int = 10,
    min_confidence: float = 0.8,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, decided_by`` for every row.

    ``decided_by`` is ``rule``, ``mined`` or ``default``.
    """
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.pattern, r.verdict)]) if rules else None
    url = F.col("url")
    judged = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    judged = judged.withColumns({"host": host_of(url), "path": path_of(url)})
    judged = judged.select(
        "page_id",
        "host",
        "path",
        rule_for(F.col("host"), F.col("path"), rules).alias("rule"),
        url_tokens(url, F.col("host"), F.col("path")).alias("tokens"),
    )
    listed = verdicts[F.col("rule")] if rules else F.lit(None).cast("string")
    judged = judged.withColumn("listed", listed)
    labelled = judged.where(F.col("listed").isNotNull()).select("tokens", F.col("listed").alias("verdict"))
    profiles = judged.where(F.col("listed").isNull()).select("tokens").distinct()
    best = match_rules(profiles, mine_rules(labelled, min_count, min_confidence))
    names = ("page_id", "host", "path", "rule", "verdict", "decided_by")
    by_rule = judged.where(F.col("listed").isNotNull()).select(
        "page_id", "host", "path", "rule", F.col("listed").alias("verdict"), F.lit("rule").alias("decided_by")
    )
    by_method = (
        judged.where(F.col("listed").isNull())
        .join(best, "tokens", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("mined", F.lit(default)).alias("verdict"),
            F.when(F.col("mined").isNull(), "default").otherwise("mined").alias("decided_by"),
        )
    )
    return by_rule.unionByName(by_method).select(*names)
