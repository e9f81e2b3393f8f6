"""Vector codes, language identification and fill-in-middle against brute force and on edge cases."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from eventlake.llm import fill_in_middle as fim
from eventlake.llm import language_id as lid
from eventlake.llm import vector_codes as vc
from eventlake.session import fresh_path

VECTORS = "vec_id long, embedding array<double>, label int, code string, error string, v string, part string"


# --- vector codes


def plain_codes(rows, parts, entries, rounds, scale=256):
    """Codes by comparing every part with every entry, in Python's whole numbers."""
    kept = [(i, e, lab) for i, e, lab in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max(len(e) for _, e, _ in kept) // parts))
    whole = [[math.floor(x * scale) if abs(x) < 1e15 else int(x) * scale for x in e] + [0] * (parts * width - len(e)) for _, e, _ in kept]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [
                [sum(col) // len(members[i]) for col in zip(*members[i])] if i in members else e for i, e in enumerate(books[p])
            ]
    out, by_label = [], Counter()
    for (i, _, lab), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        error = min(sum(d for d, _ in found), vc.LONGEST)
        by_label[lab] += error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, lab))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, c, e, min(by_label[lab], vc.LONGEST), digest) for i, c, e, lab in out)


def coded(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], VECTORS).repartition(3)
    return Counter(tuple(r) for r in vc.encode(frame, **options).collect())


@pytest.mark.parametrize("options", [dict(parts=2, entries=40, rounds=2), dict(parts=3, entries=9, rounds=3), dict(parts=1, entries=1, rounds=1)])
def test_codes_equal_a_search_through_all_entries(spark, options):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=6).round(2).tolist(), int(i) % 3 or None) for i in rng.permutation(400)]
    assert coded(spark, rows, **options) == plain_codes(rows, **options)


def test_codes_of_odd_vectors(spark):
    rows = [
        (3, [0.5, -0.25, 1.0, 2.0], 1),
        (3, [0.5, -0.25, 1.0, 1.0], 1),  # a repeated id
        (4, [0.5, -0.25, 1.0, 2.0], None),  # a repeated vector
        (None, [9.0, 9.0, 9.0, 9.0], None),
        (5, [], 2),
        (6, [1.0], 2),
        (7, None, 2),
        (8, [1.0, None, 0.0, 0.0], 2),
        (9, [math.nan, 1.0, 0.0, 0.0], 2),
        (10, [math.inf, 1.0, 0.0, 0.0], 2),
        (1, [3.4e38, -3.4e38, 1e9, 0.0], 4),  # finite, squares far beyond 64 bits
        (2, [2.0**31, 5.0, -(2.0**40), 1e300], 4),
        (11, [2.0**31 + 1, 5.0, -(2.0**40), 0.001], 4),
        (12, [0.004, 0.0039, -0.0001, 0.0], 5),
    ]
    for entries in (2, 5, 64):
        options = dict(parts=2, entries=entries, rounds=2)
        assert coded(spark, rows, **options) == plain_codes(rows, **options)
    assert vc.encode(spark.createDataFrame([], VECTORS)).collect() == []
    with pytest.raises(ValueError):
        coded(spark, rows, entries=300)


def test_tree_leaves_out_subtrees_and_keeps_ties():
    rng = np.random.default_rng(1)
    centres = rng.integers(-10_000, 10_000, size=(12, 3))
    entries = (centres[rng.integers(0, 12, 200)] + rng.integers(-30, 30, size=(200, 3))).astype(np.int64)
    entries[150:] = entries[:50]  # equal entries: the lower index wins
    points = (centres[rng.integers(0, 12, 500)] + rng.integers(-40, 40, size=(500, 3))).astype(np.int64)
    tree = vc.Gnat(entries)
    index, best = tree.nearest(points)
    full = vc.squared(points, entries)
    assert (index == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert tree.seen < full.size / 3
    exact = vc.Gnat(entries.astype(object))
    assert (exact.nearest(points.astype(object))[0] == index).all()
    grid = np.array([[x, y] for x in range(5) for y in range(5)], dtype=np.int64) * 2
    middles = np.array([[x, y] for x in range(9) for y in range(9)], dtype=np.int64)
    assert (vc.Gnat(grid).nearest(middles)[0] == vc.squared(middles, grid).argmin(axis=1)).all()


def test_sums_of_hot_and_rare_labels(spark):
    rows = [(i, b"hot" if i % 3 else (b"%d" % i if i % 2 else None), "00", i) for i in range(3000)]
    rows.append((5000, b"one", "00", vc.LONGEST))
    frame = spark.createDataFrame(rows, "vec_id long, label_key binary, code string, error long")
    total = Counter()
    for _, label, _, error in rows:
        total[label] += error
    found = {r["vec_id"]: r["label_error"] for r in vc.add_label_errors(frame).collect()}
    assert found == {i: total[label] for i, label, _, _ in rows}


# --- fill-in-middle


def plain_fim(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def fim_texts():
    long = "Grüße 𝄞 an alle. " * 30_000
    texts = [None, "", "a", "é", "𝄞", "<P>", "a<S>b", "x<M", "<", "<<<S", ">P>", "no marks", "\x00\n", long, "z" * fim.FRAME_BYTES,
             "é" * fim.FRAME_BYTES, "a" * (fim.FRAME_BYTES - 2) + "<P>" + "b" * 9, "a" * (fim.FRAME_BYTES - 1) + "𝄞" * 9]
    return [(i * 31 + k, t) for i in range(12) for k, t in enumerate(texts)] + [(None, "no id"), (7, "twice"), (7, "twice")]


def test_outputs_digests_and_restored_texts(spark, documents):
    rows = fim_texts()
    store = fim.write_store(documents([(i, t, "s") for i, t in rows]), fresh_path(spark, "test-frames"))
    done = fim.transform(store)
    expected = Counter()
    for i, text in rows:
        n, form, a, m, output = plain_fim(i, text)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (output, text or "")]
        expected[(i, n, form, a, m, *digests)] += 1
    assert Counter(map(tuple, fim.digests(done).collect())) == expected
    assert {form for _, _, form, *_ in expected} == {"plain", "psm", "spm"}
    found = Counter(map(tuple, fim.texts(done).collect()))
    assert found == Counter((i, plain_fim(i, t)[1], plain_fim(i, t)[4], t or "") for i, t in rows)
    parts = Counter(map(tuple, fim.stored_text(store, 3, 70_000).collect()))
    assert parts == Counter((i, (t or "")[3:70_000]) for i, t in rows)
    held = fim.index(store)
    assert Counter((r["doc_id"], r["n"]) for r in held.collect()) == Counter((i, len(t or "")) for i, t in rows)
    assert held.agg(F.max("frames")).first()[0] > 5
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    empty = fim.write_store(documents([]), fresh_path(spark, "test-frames"))
    assert fim.digests(fim.transform(empty)).collect() == [] and fim.index(empty).collect() == []


@pytest.mark.parametrize("most", [4, 5, 7, 64])
def test_frames_are_seekable(most):
    text = "a<Pé𝄞>b<S>cd€" * 9 + "<M>"
    data = text.encode()
    ends, frames = fim.FrameWriter(most).frames([data[:3], data[3:50], b"", data[50:]])
    assert ends[-1] == len(text) and ends == sorted(ends)
    reader = fim.FrameReader(ends, frames)
    opened = []
    inner = reader.frame
    reader.frame = lambda number: opened.append(number) or inner(number)
    for begin in range(0, len(text), 5):
        for end in range(begin, len(text) + 1, 7):
            opened.clear()
            assert b"".join(reader.read(begin, end)).decode() == text[begin:end]
            # nothing but the frames that hold the units
            assert all((ends[f - 1] if f else 0) < end and begin < ends[f] for f in opened)
    for mark in (b"<P>", b"<S>", b"<M>", b">b<"):
        for begin in range(len(text)):
            assert reader.find(mark, begin) == text.find(mark.decode(), begin)


def test_bytes_that_are_no_utf8_survive():
    data = b"\xff\x80\x80" * 50 + b"<" + b"\x80" * 40
    ends, frames = fim.FrameWriter(8).frames([data])
    reader = fim.FrameReader(ends, frames)
    assert b"".join(reader.read(0, reader.n)) == data
    assert reader.sha256((0, reader.n)) == hashlib.sha256(data).hexdigest()


# --- language


def plain_grams(text):
    """N-grams of one to three signs with a letter, borders only at the ends, as strings."""
    signs = " " + "".join(c.lower()[0] if c.isalpha() else " " for c in text) + " "
    out = Counter(c for c in signs if c != " ")
    out.update(signs[i : i + 2] for i in range(len(signs) - 1) if signs[i : i + 2].strip())
    out.update(signs[i : i + 3] for i in range(len(signs) - 2) if signs[i + 1] != " " and signs[i : i + 3] != f" {signs[i + 1]} ")
    return out


def test_gram_counts(monkeypatch):
    texts = ["", " ", "a", "Ab", "ab cd", "x1y", "Ünïcode ß İ 中文 ǅ", "a" * 50, "the end."]
    for portion in (1 << 18, 1, 2, 3, 7):
        monkeypatch.setattr(lid, "_PORTION", portion)
        for text in texts:
            counts = lid.gram_counts(text)
            grams = plain_grams(text)
            assert counts.sum() == sum(grams.values())
            assert (counts > 0).sum() <= len(grams) and bool(counts.any()) == any(c.isalpha() for c in text)
            assert sorted(counts[counts > 0])[-1:] >= sorted(grams.values())[-1:]
    assert (lid.gram_counts("ab") != lid.gram_counts("ba")).any()
    assert (lid.gram_counts("Straße 1") == lid.gram_counts("straße!")).all()


def lang_docs():
    words = {
        "aa": "the of and to in is that it was for on are as with his they".split(),
        "bb": "der die und in den von zu das mit sich des auf für ist im dem".split(),
        "cc": "ще не вмерла україни ні слава ні воля".split(),
    }
    rng = np.random.default_rng(2)
    rows = []
    for i in range(240):
        lang = ("aa", "bb", "cc")[i % 3]
        rows.append((i, " ".join(rng.choice(words[lang], int(rng.integers(5, 60)))), lang))
    return rows


def lang_frame(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.withColumns({c: F.lit("x") for c in ("learn", "digest", "score", "held_out", "place", "key", "n", "source")})


def test_languages_are_told_apart_and_learning_ignores_held_out_rows(spark):
    rows = lang_docs()
    rows += [(1000, None, "aa"), (1001, "", None), (1002, "12 %$ 34", "bb"), (None, "der die das und", None), (3, "the of and", "aa")]
    rows += [(2000 + i, "der die das und " * 20, "bb") for i in range(50)]  # copies
    # held-out rows with a wrong language must not matter
    buckets = {i: (zlib.crc32(str(i).encode()) % 4) for i, _, _ in rows if i is not None}
    lies = [(i, t, "zz" if buckets.get(i) == 2 else lang) for i, t, lang in rows]
    frame, other = lang_frame(spark, rows), lang_frame(spark, lies)
    model = lid.train(frame, ~lid.held_out())
    found = lid.predict(frame, model).collect()
    assert Counter((r["doc_id"], r["lang_pred"], r["score"]) for r in found) == Counter(
        (r["doc_id"], r["lang_pred"], r["score"]) for r in lid.predict(other, lid.train(other, ~lid.held_out())).collect()
    )
    truth = {(i, lang) for i, _, lang in lang_docs()}
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == lang for i, lang in truth)
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0.0 and by_id[i]["rejected"] for i in (1000, 1001, 1002))
    assert by_id[None]["lang_pred"] == "bb" and not by_id[None]["held_out"]
    assert all(0.0 <= r["score"] <= 1.0 for r in found) and len(found) == len(rows)
    assert sum(r["rejected"] for r in found) < len(found) / 10
    # a script that no centroid knows is far from all of them
    stranger = lid.predict(lang_frame(spark, [(1, "ἐν ἀρχῇ ἦν ὁ λόγος " * 10, None)]), model).first()
    assert stranger["rejected"] and stranger["lang_pred"] in ("aa", "bb", "cc")


def test_scores_are_cosines_with_the_nearest_centroid(spark):
    frame = lang_frame(spark, lang_docs())
    model = lid.train(frame, ~lid.held_out(), clusters=2)
    texts = {i: t for i, t, _ in lang_docs()}
    learned = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 4 != 2]
    frequency = sum((lid.gram_counts(t) > 0).astype(int) for t in learned)
    idf = np.log((1 + len(learned)) / (1 + frequency)) + 1
    assert np.allclose(idf, model.idf) and len(model.of) == 6
    for r in lid.predict(frame, model).collect():
        counts = lid.gram_counts(texts[r["doc_id"]])
        vector = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
        cosine = model.centroids.astype(float) @ vector / np.sqrt((vector**2).sum())
        assert r["score"] == pytest.approx(cosine.max(), abs=1e-5)
        assert cosine[[model.langs[k] == r["lang_pred"] for k in model.of]].max() >= cosine.max() - 1e-6


def test_language_without_anything_to_learn(spark):
    none = lang_frame(spark, [(1, "some words", None), (2, None, "aa")])
    assert {r["lang_pred"] for r in lid.predict(none, lid.train(none, ~lid.held_out())).collect()} == {"und"}
    empty = lang_frame(spark, [])
    assert lid.predict(empty, lid.train(empty, ~lid.held_out())).collect() == []
