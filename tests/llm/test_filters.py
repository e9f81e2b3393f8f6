"""URL filter, quality rules, quality classifier, secret scan and token counts on small inputs."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from eventlake.llm import quality_classifier, quality_rules, queries, secret_scan, token_counts, url_filter
from eventlake.session import fresh_path

PAGES = "page_id long, url string, verdict string, tokens string, rule string"
RULES = [
    url_filter.Rule("org/", "allow"),
    url_filter.Rule("bad.org/x", "block"),
    url_filter.Rule("com/de/", "block"),
    url_filter.Rule("com/fr/", "allow"),
]


def judge(spark, urls, **options):
    pages = spark.createDataFrame([(i, u, "x", "x", "x") for i, u in enumerate(urls)], PAGES)
    return {r.page_id: r for r in url_filter.judge_urls(pages, RULES, **options).collect()}


def test_url_rules_and_mined_rules(spark):
    urls = [f"http://s{i}.a.com/{'de' if i % 2 else 'fr'}/{i}" for i in range(40)]
    urls += [
        "HTTP://Sub.BAD.org/xyz?q#f",
        "http://bad.org/y",
        "http://evilbad.org/x",
        "http://bad.org",
        "http://m.net/de/1",
        "http://m.net/fr/1",
        "http://m.net/it/1",
        None,
        "no scheme/de/",
        "",
        "http://",
        "a://b\nc.com/de/\n?x",
    ]
    got = judge(spark, urls)
    assert len(got) == len(urls)
    assert (got[40].host, got[40].path, got[40].rule, got[40].verdict) == ("sub.bad.org", "/xyz", "bad.org/x", "block")
    assert (got[41].rule, got[41].verdict) == ("org/", "allow")
    assert got[42].rule == "org/"  # not a subdomain of bad.org
    assert (got[43].path, got[43].rule) == ("", None)  # an empty path does not start with a slash
    assert [(got[i].verdict, got[i].decided_by) for i in (44, 45, 46)] == [
        ("block", "mined"),
        ("allow", "mined"),
        ("block", "default"),
    ]
    for i in (47, 48, 49, 50):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == ("", "", None, "block")
    assert (got[51].host, got[51].path) == ("b\nc.com", "/de/\n")


def test_url_filter_without_labels_and_empty(spark):
    assert judge(spark, []) == {}
    got = judge(spark, ["http://m.net/de/1", "http://m.net/de/1"], default="allow")
    assert [r.verdict for r in got.values()] == ["allow", "allow"]


def test_url_tokens_hold_every_part(spark):
    url = F.col("u")
    rows = spark.createDataFrame(
        [("http://A.b.c.Org:80//x/y.d/z.html?k=1&k=2&&l&=3#f?g=1",), ("http://",), ("none",), (None,), ("a://b",)], "u string"
    )
    got = rows.select(url_filter.url_tokens(url, url_filter.host_of(url), url_filter.path_of(url)).alias("t")).collect()
    assert got[0].t == ["tld=org:80", "label=a", "label=b", "label=c", "seg1=x", "seg2=y.d", "seg3=z.html", "kind=html", "key=k", "key=l"]
    assert [r.t for r in got[1:]] == [[], [], [], ["tld=b"]]


def test_a_rule_on_any_part_is_mined(spark):
    # labelled by the first segment; only the part named goes along with it
    urls = [f"http://s.com/{'de' if i % 2 else 'fr'}/{'old' if i % 2 else 'new'}/{i}" for i in range(40)]
    urls += [f"http://{'spam' if i % 2 else 'good'}.w.com/{'de' if i % 2 else 'fr'}/{i}" for i in range(40)]
    urls += [f"http://s.com/{'de' if i % 2 else 'fr'}/?a={i}&{'x' if i % 2 else 'y'}=1" for i in range(40)]
    asked = ["http://m.net/it/old/1", "http://m.net/it/new/1", "http://a.good.m.net", "http://spam.net", "http://m.net?z=1&y", "http://m.net?x"]
    got = judge(spark, urls + asked, default="none")
    assert [got[120 + i].verdict for i in range(6)] == ["block", "allow", "allow", "block", "allow", "block"]
    # 20 URLs are enough in a table of any size, 9 are not
    more = [f"http://s.com/{'de' if i % 2 else 'fr'}/x/{i}" for i in range(4000)] + [f"http://s.com/de/{i}/rare" for i in range(9)]
    got = judge(spark, urls + asked + more + ["http://m.net/a/b/rare"], default="none")
    assert [got[120 + i].verdict for i in range(6)] == ["block", "allow", "allow", "block", "allow", "block"]
    assert got[len(urls) + len(asked) + len(more)].decided_by == "default"


def brute_rules(rows, least, confidence):
    from itertools import combinations

    sets = {}
    for tokens, verdict in rows:
        for size in range(1, len(tokens) + 1):
            for chosen in combinations(sorted(tokens), size):
                sets.setdefault(chosen, {}).setdefault(verdict, 0)
                sets[chosen][verdict] += 1
    found = {(t, v): (n, sum(by.values())) for t, by in sets.items() for v, n in by.items()}
    found = {k: (n, total) for k, (n, total) in found.items() if n >= least and n >= total * confidence}
    return {
        (t, v, n, total) for (t, v), (n, total) in found.items()
        if not any(w == v and set(s) < set(t) and m * total >= n * all_ for (s, w), (m, all_) in found.items())
    }


def test_mined_rules_equal_brute_force_and_wide_urls_end(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(400):
        tokens = [f"t{k}" for k in range(9) if rng.random() < 0.4]
        rows.append((tokens, "allow" if {"t1", "t2"} <= set(tokens) or rng.random() < 0.2 else "block"))
    rows += [(["t1", "only"], "allow")] * 30 + [([], "block")] * 5
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    for least, confidence in ((10, 0.8), (40, 0.6)):
        got = {(tuple(r.tokens), r.verdict, r.hits, r.total) for r in url_filter.mine_rules(df, least, confidence).collect()}
        assert got == brute_rules(rows, least, confidence) and got
    wide = [([f"w{k:02d}" for k in range(60)], v) for v in ("allow", "block") for _ in range(30)] + [(["w59"], "allow")] * 200
    df = spark.createDataFrame(wide, "tokens array<string>, verdict string")
    assert {tuple(r.tokens) for r in url_filter.mine_rules(df).collect()} == {("w59",)}


def test_rules_of_wide_urls_hold_tokens_from_all_over_the_url(spark):
    rng, rows = random.Random(5), []
    for _ in range(300):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        tokens = ["a"] * a + [f"m{k:02d}" for k in range(40)] + ["z"] * b + [f"t{k}" for k in range(4) if rng.random() < 0.5]
        rows.append((tokens, "allow" if a and b or rng.random() < 0.1 else "block"))
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    got = {(tuple(r.tokens), r.verdict, r.hits, r.total) for r in url_filter.mine_rules(df).collect()}
    assert (("a", "z"), "allow") in {r[:2] for r in got}
    # one of the tokens that always come together stands for all in the plain search; each makes rules of its own
    rest = [([t for t in tokens if t[0] != "m" or t == "m00"], v) for tokens, v in rows]
    wanted = brute_rules(rest, 10, 0.8)
    of_m = {(tuple(sorted(f"m{k:02d}" if t == "m00" else t for t in s)), *x) for s, *x in wanted for k in range(40)}
    assert got == of_m
    # narrow URLs give the same sets both ways
    narrow = [(sorted(t for t in tokens if t[0] != "m"), v) for tokens, v in rows]
    df = spark.createDataFrame([(t, v, 1) for t, v in narrow], "tokens array<string>, verdict string, n long")
    every = {(tuple(r.tokens), r.verdict, r.freq) for r in url_filter.frequent_sets(df, 10, len(narrow)).collect()}
    free = {(tuple(r.tokens), r.verdict, r.freq) for r in url_filter.free_sets(df, 10).collect()}
    assert free <= every and {x for x in every if len(x[0]) == 1} <= free


def test_quality_rules_edges(spark, documents):
    prose = " ".join(f"word{i % 97}x{i}" for i in range(300))
    repeated = " ".join(["a b c d e f g"] * 30)
    rows = [(i, prose, "s") for i in range(60)]
    rows += [(100, None, None), (101, "", "s"), (102, " \n\t ", "s"), (103, repeated, "s"), (104, "### " * 40, "t"), (None, prose, "s")]
    rows += [(105, "one\none\n\n\ntwo three\none", "s"), (106, "w " * 200_000, "s")]
    got = {r.doc_id: r for r in quality_rules.judge(documents(rows)).collect()}
    assert got[0].kept and got[None].kept and not got[0].base_failed
    assert all(got[i].n_words == 0 and got[i].base_failed for i in (100, 101, 102))
    assert (got[103].n_words, got[103].n_repeat_words) == (210, 210)
    assert got[105].n_dup_lines == 2
    assert got[106].n_repeat_words == 200_000 and not got[104].kept
    assert quality_rules.judge(documents([])).count() == 0


def prose(rng, n_words, letters=(4, 6), per_line=12, symbol_every=0):
    """Random words; with ``symbol_every`` every so manyth word has a symbol."""
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(*letters))) for _ in range(n_words)]
    words = [w + "#" if symbol_every and i % symbol_every == 0 else w for i, w in enumerate(words)]
    return "\n".join(" ".join(words[i : i + per_line]) for i in range(0, n_words, per_line))


def test_every_measure_rejects_what_the_base_rule_keeps_and_groups_differ(spark, documents):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(90, 110)), "plain") for i in range(120)]
    # a noisy source: short and long words, symbols, texts of many lengths
    rows += [(1000 + i, prose(rng, rng.choice([20, 90, 400, 1500]), rng.choice([(2, 4), (4, 8), (9, 14)]), symbol_every=rng.choice([3, 5, 40])), "noisy") for i in range(120)]
    odd = {
        "short words": prose(rng, 100, (1, 2)),
        "long words": prose(rng, 100, (9, 12)),
        "many words": prose(rng, 3000),
        "few words": prose(rng, 12),
        "symbols": prose(rng, 100, symbol_every=2),
        "lines": "\n".join(line for _ in range(9) for line in (prose(rng, 10, per_line=99), "again")),
        "repeats": " ".join([prose(rng, 50)] + [prose(rng, 10)] * 2 + [prose(rng, 50)]),
    }
    rows += [(2000 + k, text, "plain") for k, text in enumerate(odd.values())]
    rows += [(3000 + k, text, "noisy") for k, text in enumerate(odd.values())]
    judged = quality_rules.judge(documents(rows))
    got = {r.doc_id: r for r in judged.collect()}
    assert not any(got[2000 + k].base_failed for k in range(len(odd)))
    named = {name: got[2000 + k] for k, name in enumerate(odd)}
    reasons = {
        name: {limit for limit in quality_rules.LIMITS
               if (r[limit[4:]] > r[limit] if limit.startswith("max") else r[limit[4:]] < r[limit])}
        for name, r in named.items()
    }
    assert reasons == {
        "short words": {"min_word_length"},
        "long words": {"max_word_length"},
        "many words": {"max_length_class"},
        "few words": {"min_length_class"},
        "symbols": {"max_symbol_rate"},
        "lines": {"max_dup_line_rate"},
        "repeats": {"max_repeat_rate"},
    }
    assert not any(r.kept for r in named.values())
    # the same documents are usual in the noisy source, but for those that repeat themselves
    noisy = {name for k, name in enumerate(odd) if got[3000 + k].kept}
    assert {"long words", "many words", "few words", "symbols"} <= noisy
    assert all(got[i].kept for i in range(120))
    fences = {r.source: r for r in judged.collect()}
    assert fences["plain"].max_word_length < fences["noisy"].max_word_length
    assert fences["plain"].max_symbol_rate < fences["noisy"].max_symbol_rate
    assert fences["plain"].max_length_class < fences["noisy"].max_length_class


def test_quality_sketches_merge_exactly(spark, documents):
    random.seed(1)
    rows = [(i, " ".join("x" * random.randint(1, 12) for _ in range(random.randint(5, 60))), f"s{i % 3}") for i in range(200)]
    rated = quality_rules.rates(quality_rules.measures(documents(rows)))
    parts = [quality_rules.sketch(rated.where(F.col("doc_id") % 2 == p)) for p in (0, 1)]
    keys = ["lang", "source"]
    merged = quality_rules.merge(parts[0].unionByName(parts[1]), keys)
    assert sorted(merged.collect(), key=str) == sorted(quality_rules.sketch(rated).select(merged.columns).collect(), key=str)


def test_classifier_learns_and_handles_edges(spark, documents):
    random.seed(2)
    good = [" ".join(random.choice(("tree", "river", "stone", "cloud")) + str(random.randint(0, 50)) for _ in range(40)) for _ in range(150)]
    bad = [" ".join(f"BUY{random.randint(0, 50)}!!!" for _ in range(40)) for _ in range(60)]
    rows = [(i, t, "s") for i, t in enumerate(good + bad)] + [(900, "", "s"), (901, None, "s"), (None, good[0], "s"), (902, "x " * 300_000, "s")]
    docs = documents(rows)
    labels = [(i, int(i < 150), 0) for i in range(210)] + [(0, 1, 0), (1, 0, 0), (None, 0, 0), (5, None, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_classifier.score_documents(docs, quality_classifier.train(docs, labels)).collect()}
    held = [r for i, r in got.items() if i is not None and i < 210 and r.held_out]
    assert held and all(r.predicted == int(r.doc_id < 150) for r in held)
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values()) and got[900].score == got[901].score
    one_class = quality_classifier.train(docs, labels.where("quality = 1 and doc_id > 5"))
    assert {r.score for r in quality_classifier.score_documents(docs, one_class).collect()} == {0.5}
    nothing = documents([])
    assert quality_classifier.score_documents(nothing, quality_classifier.train(nothing, labels)).count() == 0


def test_fit_reaches_the_optimum_of_the_dual():
    """Duality gap against a plain solver: projected gradients on the full dual problem."""
    rng, size, cost = np.random.default_rng(5), 40, 0.5
    labels = rng.integers(0, 2, 60)
    rows = [np.flatnonzero(rng.random(size) < np.where(np.arange(size) % 2 == y, 0.25, 0.15)) for y in labels]
    model = quality_classifier.fit(rows, labels, cost=cost, rounds=5000)
    counts = np.ones((2, 1 << quality_classifier.BITS))
    for places, label in zip(rows, labels):
        counts[label][places] += 1
    ratio = (np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum()))[:size]
    values = np.zeros((60, size + 1))
    for i, places in enumerate(rows):
        values[i, places] = ratio[places] / np.sqrt(max(1, len(places)))
        values[i, size] = 1.0
    sign = np.where(labels == 1, 1.0, -1.0)
    bound = np.where(labels == 1, cost * 30 / (labels == 1).sum(), cost * 30 / (labels == 0).sum())
    signed = values * sign[:, None]
    products = signed @ signed.T
    dual, step = np.zeros(60), 1.0 / np.linalg.eigvalsh(products).max()
    for _ in range(50_000):
        dual = np.clip(dual + step * (1.0 - products @ dual), 0.0, bound)
    best = dual.sum() - 0.5 * dual @ products @ dual
    weights = np.append(np.divide(model.weights[:size], ratio, where=ratio != 0, out=np.zeros(size)), model.bias)
    found = 0.5 * weights @ weights + bound @ np.maximum(0.0, 1.0 - signed @ weights)
    assert best * (1 - 1e-4) <= found <= best * 1.002


def test_classifier_on_given_tables(spark):
    rows = queries.quality_classes(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id"
    )
    held = rows.where("held_out").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_secret_spans(spark, documents):
    key = "AKIA" + "A" * 16
    texts = [
        "x token = 'abcdefg' and token:abc password=secretpassword",
        "secret:token:abcdef",  # the failing match hides the inner one
        f"é😀 {key} é api_key: \"{'0f' * 14}\"",
        f"{key} -----BEGIN RSA PRIVATE KEY----- ghp_{'z' * 36}",
        None,
        "",
        "AKIA123 token=12345 " + "0123456789abcdef" * 1,
    ]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[0], "s"), (0, texts[0], "s"), (50, "a1 " * 400_000 + key, "s")]
    docs = documents(rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ledger = fresh_path(spark, "test-ledger")
    got = secret_scan.scan_documents(docs, ledger)
    digest = {r.doc_id: r for r in queries.secret_digest(got).collect()}
    assert got.count() == len(rows)
    assert digest[0].spans == "assign:2:18,assign:34:57" == digest[None].spans
    assert digest[1].spans == ""
    assert digest[2].spans == f"access:3:23,assign:26:{26 + 10 + 28},hex:36:64"
    assert digest[3].spans.startswith("access:0:20,private_key:21:52,repo_token:53")
    assert digest[3].base_sha256 == hashlib.sha256(b"access:0:20").hexdigest()
    assert all(digest[i].spans == "" and digest[i].base_sha256 == hashlib.sha256(b"").hexdigest() for i in (4, 5, 6))
    assert digest[50].spans == "access:1200000:1200020"
    # nothing new, then a new document, then a new rule version
    before = secret_scan.read_ledger(spark, ledger).count()
    secret_scan.scan_documents(docs, ledger)
    assert secret_scan.read_ledger(spark, ledger).count() == before
    more = docs.unionByName(spark.createDataFrame([(60, "new text")], "doc_id long, text string"))
    secret_scan.scan_documents(more, ledger)
    assert secret_scan.read_ledger(spark, ledger).count() == before + len(secret_scan.RULES)
    changed = (secret_scan.SecretRule("access", r"AKIA[A-Z]{16,}", version="2"), *secret_scan.RULES[2:])
    again = secret_scan.scan_documents(more, ledger, changed)
    assert {r.doc_id for r in again.where(F.size("spans") > 0).collect()} == {2, 3, 50}
    blobs = more.select("text").distinct().count()
    assert secret_scan.read_ledger(spark, ledger).where("version = '2'").select("blob").distinct().count() == blobs


def test_whole_private_keys_are_one_span(spark, documents):
    body = "MIIEow" + "aB3/+\n" * 400 + "=="
    kinds = ["", "RSA ", "ENCRYPTED "]
    texts = [f"x -----BEGIN {k}PRIVATE KEY-----\n{body}\n-----END {k}PRIVATE KEY----- y" for k in kinds]
    texts.append("x -----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0AF1\n\n" + body + "\n-----END RSA PRIVATE KEY----- y")
    texts.append("x -----BEGIN PRIVATE KEY-----\\nabc\\n-----END PRIVATE KEY----- y")
    texts.append("x -----BEGIN PRIVATE KEY----- y: never ended. -----END PRIVATE KEY-----")
    docs = documents([(i, t, "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r.text for r in secret_scan.redact_documents(docs, fresh_path(spark, "test-ledger")).collect()}
    assert [got[i] for i in range(5)] == ["x [SECRET] y"] * 5
    assert got[5] == "x [SECRET] y: never ended. -----END PRIVATE KEY-----"


def test_spans_of_very_many_matches(spark, documents):
    text = "".join(f"é{'ab' * (12 + i % 3)}é" if i % 4 else "token=abc " for i in range(1300))
    docs = documents([(1, text, "s"), (2, "0" * 24, "s")])
    got = {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in secret_scan.scan_documents(docs, fresh_path(spark, "test-ledger")).collect()}
    assert got[1] == [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]{24,}", text)] and len(got[1]) == 975
    assert got[2] == [(0, 24, "hex")]


def test_secret_redaction(spark, documents):
    docs = documents([(1, "a token=abcdefgh b AKIA" + "B" * 16, "s"), (2, "clean", "s"), (3, None, "s")])
    got = {r.doc_id: r for r in secret_scan.redact_documents(docs, fresh_path(spark, "test-ledger")).collect()}
    assert got[1].text == "a [SECRET] b [SECRET]" and got[2].text == "clean" and got[3].text is None
    assert got[1].spans == "x" and docs.columns == list(got[1].asDict())
    empty = secret_scan.redact_documents(documents([]), fresh_path(spark, "test-ledger"))
    assert empty.count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_match_the_library(spark, documents, name):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(name)
    texts = ["Hello world", "it's   a\n\n test\t ", "naïve Übung çédille", "日本語 text", "x<|endoftext|>y", "a\x1cb\x85c", "", None, "😀 ok '' 's", "12 34 ab12", "word " * 50_000]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[0], "s"), (0, texts[0], "s")]
    cache = fresh_path(spark, "test-cache")
    got = token_counts.count_tokens(documents(rows), cache, path, limit=3).collect()
    library = Tokenizer.from_file(path)
    library.no_truncation()
    want = {i: len(library.encode(t or "", add_special_tokens=False)) for i, t in enumerate(texts)}
    assert len(got) == len(rows)
    for r in got:
        i = r.doc_id or 0
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[i] or "").encode()), want[i], want[i] > 3)


def test_token_cache_is_used(spark, documents):
    path, cache = queries.tokenizer_path(), fresh_path(spark, "test-cache")
    token_counts.append_misses(documents([(1, "one", "s"), (2, "two", "s"), (3, "one", "s"), (4, None, "s"), (5, "", "s")]), cache, path)
    rows = spark.read.parquet(cache)
    assert rows.count() == 3
    # a stored count is believed, so a hit is visible
    rows.withColumn("n_tokens", F.col("n_tokens") + 100).write.parquet(cache + "-changed")
    got = token_counts.count_tokens(documents([(7, "two", "s"), (8, "three", "s")]), cache + "-changed", path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {7: 101, 8: 1}
    assert token_counts.count_tokens(documents([]), fresh_path(spark, "test-cache"), path).count() == 0
