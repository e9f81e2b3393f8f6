"""Secret scanning through a ledger of content-addressed blobs.

Every version of every text is a blob, named by the SHA-256 of its content. The ledger says which rule, in which
version, has scanned which blob and what it found. A run scans only the pairs of blob and rule version that
the ledger lacks, appends them, and joins the findings back to all paths that hold the blob. So copies are
scanned once, unchanged history never again, and a new rule version scans each blob once.

Everything is DataFrame code. Positions come from the gaps between matches: a text is split at the matches, and the
lengths of gaps and matches add up to begins and ends, in code points, the end exclusive.

Defined results: null texts count as empty and have no findings. Repeated rows each get the findings of their blob.
Matches of one kind never overlap; different kinds may. An empty table appends nothing. Other columns are
ignored, ids may be null.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sources.tables import path_exists

LEDGER = "blob binary, rule string, version string, spans array<struct<start:int,end:int>>"
_SPANS = "array<struct<start:int,end:int>>"
# matches placed at a time; appending to one array copies it, so a text's spans grow by pieces
_PIECE = 256


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret. ``least`` characters of ``group`` make a match count; a text without any of ``needles``
    (if given) has no match, which is cheap to see."""

    kind: str
    pattern: str
    version: str = "1"
    group: int = 0
    least: int = 0
    needles: tuple[str, ...] = ()

    def may_match(self, text: Column) -> Column:
        if self.needles:
            return reduce(lambda a, b: a | b, [text.contains(n) for n in self.needles]) & text.rlike(self.pattern)
        return text.rlike(self.pattern)


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
# the least length can be part of a pattern where a failing match could not hide a passing one
RULES = (
    SecretRule(
        "assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6, needles=("=", ":")
    ),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}", needles=("AKIA",)),
    SecretRule("hex", r"[0-9a-f]{24,}"),
    # header, perhaps lines on its encryption, body and footer; the header alone where no footer follows the body
    SecretRule(
        "private_key",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
        r"(?:(?:[\x20\x09-\x0D]*Proc-Type: [0-9A-Z,]+[\x20\x09-\x0D]+DEK-Info: [A-Z0-9-]+,[0-9A-Fa-f]+)?"
        r"[A-Za-z0-9+/=\\\x20\x09-\x0D]*-----END [A-Z ]*PRIVATE KEY-----)?",
        version="2",
        needles=("PRIVATE KEY-----",),
    ),
    SecretRule("repo_token", r"gh[pousr]_[A-Za-z0-9]{36,}", needles=("gh",)),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", needles=("xox",)),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needles=("eyJ",)),
    SecretRule("url_login", r"://[A-Za-z0-9._-]+:[^\x20\x09-\x0D/@]{3,}@", needles=("://",)),
)
BASE = ("assign", "access", "hex")


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def match_spans(text: Column, rule: SecretRule) -> Column:
    """Begin and end of each match that counts, in order; an empty array if there is none."""
    gaps, hits = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    sizes = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    parts = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.size(hits)), lambda x: F.length(x)).alias("gap"),
        F.transform(hits, lambda x: F.length(x)).alias("hit"),
        F.transform(sizes, lambda x: F.length(x)).alias("counts"),
    )

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + part["hit"]
        span = F.struct(start.alias("start"), end.alias("end"))
        out = F.when(part["counts"] >= rule.least, F.array_append(state["out"], span)).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    none = F.array().cast(_SPANS)

    def begin(at: Column, kind: str) -> Column:
        return F.struct(at.alias("at"), F.array().cast(kind).alias("out")).cast(f"struct<at:int,out:{kind}>")

    def piece(state: Column, first: Column) -> Column:
        some = F.slice(parts, first, _PIECE)
        spans = F.aggregate(some, begin(state["at"], _SPANS), step, lambda inner: inner["out"])
        upto = F.aggregate(some, state["at"], lambda at, part: at + part["gap"] + part["hit"])
        return F.struct(upto.alias("at"), F.array_append(state["out"], spans).alias("out"))

    firsts = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts), F.lit(_PIECE))).otherwise(F.array().cast("array<int>"))
    found = F.aggregate(firsts, begin(F.lit(0), f"array<{_SPANS}>"), piece, lambda state: F.flatten(state["out"]))
    return F.when(rule.may_match(text), found).otherwise(none)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(LEDGER).parquet(path)
    columns = (column.split(" ", 1) for column in LEDGER.split(", "))
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns])


def scan_unseen(texts: DataFrame, ledger_path: str, rules: tuple[SecretRule, ...] = RULES) -> None:
    """Scan what the ledger lacks for rows of ``doc_id, text`` and append it.

    One row stands for all of the same content; rows alike in id and text may be scanned twice, which readers of
    the ledger allow for, as they do for two runs at once.
    """
    spark = texts.sparkSession
    keyed = texts.select("doc_id", "text", blob_id(F.col("text")).alias("blob"))
    wanted = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    seen = read_ledger(spark, ledger_path).groupBy("blob").agg(
        F.collect_set(F.concat_ws("@", "rule", "version")).alias("seen")
    )
    blobs = keyed.groupBy("blob").agg(F.min("doc_id").alias("chosen")).join(seen, "blob", "left")
    lacking = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    unseen = blobs.select(F.col("blob").alias("b"), "chosen", lacking.alias("lacking")).where(F.size("lacking") > 0)
    rows = keyed.join(unseen, (keyed["blob"] == unseen["b"]) & keyed["doc_id"].eqNullSafe(unseen["chosen"]))
    scans = [
        F.when(
            F.array_contains("lacking", f"{r.kind}@{r.version}"),
            F.struct(
                F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), match_spans(F.col("text"), r).alias("spans")
            ),
        )
        for r in rules
    ]
    done = rows.select("blob", F.explode(F.array_compact(F.array(*scans))).alias("scan"))
    done.select("blob", "scan.*").write.mode("append").parquet(ledger_path)


def findings(spark: SparkSession, ledger_path: str, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """``blob, spans`` for blobs with a finding: kind, start and end, by start and then by order of the rules."""
    current = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    rows = read_ledger(spark, ledger_path).where((F.size("spans") > 0) & (current[F.col("rule")] == F.col("version")))
    rows = rows.groupBy("blob", "rule").agg(F.first("spans").alias("spans"))
    rows = rows.select("blob", "rule", place[F.col("rule")].alias("place"), F.explode("spans").alias("s"))
    span = F.struct("s.start", "place", "s.end", F.col("rule").alias("kind"))
    return rows.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def scan_documents(texts: DataFrame, ledger_path: str, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """``doc_id, blob, spans`` for every row of ``doc_id, text``; brings the ledger up to date first."""
    scan_unseen(texts, ledger_path, rules)
    found = findings(texts.sparkSession, ledger_path, rules)
    keyed = texts.select("doc_id", blob_id(F.col("text")).alias("blob"))
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    return keyed.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (sorted by start) replaced by a mark; overlapping spans share one."""

    def step(state: Column, span: Column) -> Column:
        before = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        out = F.when(span["start"] >= state["at"], F.concat(state["out"], before, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, rest)


def redact_documents(docs: DataFrame, ledger_path: str, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """All rows and columns of a documents frame, secrets replaced in ``text``.

    A text that matches no rule needs no finding and stays where it is; only the others are joined to the
    ledger.
    """
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    scan_unseen(rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), text.alias("text")), ledger_path, rules)
    suspect = reduce(lambda a, b: a | b, [r.may_match(text) for r in rules])
    found = findings(docs.sparkSession, ledger_path, rules)
    held = rows.where(suspect).select("row", blob_id(text).alias("blob")).join(found, "blob", "left")
    clean = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(redact(text, F.col("spans")))
    changed = held.select(F.col("row").withField("text", clean).alias("row"))
    return rows.where(~suspect).unionByName(changed).select("row.*")
