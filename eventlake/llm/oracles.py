"""DuckDB equivalents of this package's queries, where SQL can express them.

Written from the definitions, by other means than the jobs: item sets by grouping sets instead of FP-growth, all pairs of
vectors instead of an index, all pairs that share a shingle instead of sketches, exact counts instead of merged sketches.
"""

from __future__ import annotations

from eventlake.llm import quality_rules, secret_scan, url_filter

WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def lower(column: str) -> str:
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def url_filters(rules: list[url_filter.Rule], default: str = "block", least: int = 10, confidence: float = 0.8) -> str:
    """All subsets of the frequent tokens of a URL are counted; tokens that decide alone are not set apart."""
    listed = ", ".join(f"('{r.pattern}', '{r.host}', '{r.path}', '{r.verdict}')" for r in rules)
    return rf"""
WITH listed(pattern, rule_host, rule_path, verdict) AS (VALUES {listed}),
parts AS (
  SELECT page_id, url,
    {lower(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') AS query
  FROM pages),
cut AS (
  SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS segments,
    regexp_extract(path, '\.([A-Za-z0-9]{{1,5}})$', 1) AS kind,
    list_filter(list_transform(string_split(query, '&'), lambda x: string_split(x, '=')[1]), lambda x: x <> '') AS keys
  FROM parts),
judged AS (
  SELECT page_id, host, path,
    list_sort(list_distinct(
      list_transform(labels, lambda x, i: CASE WHEN i = len(labels) THEN 'tld=' ELSE 'label=' END || x)
      || list_transform(segments, lambda x, i: 'seg' || i || '=' || x)
      || CASE WHEN kind <> '' THEN ['kind=' || kind] ELSE [] END
      || list_transform(keys, lambda x: 'key=' || x))) AS tokens,
    (SELECT first({{'rule': pattern, 'verdict': verdict}} ORDER BY length(pattern) DESC, length(rule_host) DESC, pattern)
     FROM listed WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS hit
  FROM cut),
labelled AS (SELECT row_number() OVER () AS row, tokens, hit.verdict AS verdict FROM judged WHERE hit IS NOT NULL),
single AS (SELECT row, verdict, unnest(tokens) AS token FROM labelled),
frequent AS (SELECT token FROM single GROUP BY token HAVING count(*) >= {least}),
narrow AS (SELECT row, any_value(verdict) AS verdict, list(token ORDER BY token) AS tokens FROM single JOIN frequent USING (token) GROUP BY row),
sets AS (
  SELECT list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS tokens, verdict, mask FROM (
    SELECT tokens, verdict, unnest(range(1, CAST(1 << len(tokens) AS BIGINT))) AS mask FROM narrow)),
counted AS (SELECT tokens, verdict, count(*) AS hits FROM sets GROUP BY ALL),
mined AS (SELECT *, sum(hits) OVER (PARTITION BY tokens) AS total FROM counted),
sure AS (SELECT * FROM mined WHERE hits >= {least} AND hits >= total * {confidence}),
pruned AS (
  SELECT * FROM sure a WHERE NOT EXISTS (
    SELECT 1 FROM sure b WHERE b.verdict = a.verdict AND len(b.tokens) < len(a.tokens)
      AND list_has_all(a.tokens, b.tokens) AND b.hits * a.total >= a.hits * b.total)),
open AS (SELECT DISTINCT tokens FROM judged WHERE hit IS NULL),
best AS (
  SELECT o.tokens, first(p.verdict ORDER BY p.hits / p.total DESC, p.total DESC, len(p.tokens) DESC, p.tokens, p.verdict) AS verdict
  FROM open o JOIN pruned p ON list_has_all(o.tokens, p.tokens) GROUP BY o.tokens)
SELECT j.page_id, j.host, j.path, j.hit.rule AS rule,
  coalesce(j.hit.verdict, b.verdict, '{default}') AS verdict,
  CASE WHEN j.hit IS NOT NULL THEN 'rule' WHEN b.verdict IS NOT NULL THEN 'mined' ELSE 'default' END AS decided_by
FROM judged j LEFT JOIN best b ON j.hit IS NULL AND b.tokens = j.tokens"""


def secret_scans() -> str:
    """Matches one after the other: places of the n-th match from the text before it."""
    parts = []
    for place, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, i,
    regexp_extract_all(text, '{pattern}', 0)[i] AS hit, regexp_extract_all(text, '{pattern}', {rule.group})[i] AS counted,
    {rule.least} AS least, text
  FROM docs, range(1, len(regexp_extract_all(text, '{pattern}', 0)) + 1) r(i) WHERE regexp_matches(text, '{pattern}')""")
    named = "kind || ':' || start || ':' || (start + length(hit))"
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({' UNION ALL '.join(parts)}),
placed(doc_id, place, kind, i, hit, counted, least, text, start, upto) AS (
  SELECT *, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM (SELECT doc_id, place, kind, 0, '', '', 1, text FROM hits WHERE i = 1)
  UNION ALL
  SELECT h.*, p.upto + instr(substr(h.text, p.upto + 1), h.hit) - 1, p.upto + instr(substr(h.text, p.upto + 1), h.hit) - 1 + length(h.hit)
  FROM placed p JOIN hits h ON h.doc_id = p.doc_id AND h.place = p.place AND h.i = p.i + 1),
good AS (SELECT * FROM placed WHERE i > 0 AND length(counted) >= least)
SELECT d.doc_id,
  count(*) FILTER (WHERE kind = 'assign') AS n_assign,
  count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg({named}, ',' ORDER BY start, place) FILTER (WHERE place < {len(secret_scan.BASE)}), '')) AS base_sha256,
  coalesce(string_agg({named}, ',' ORDER BY start, place), '') AS spans
FROM docs d LEFT JOIN good g ON g.doc_id = d.doc_id GROUP BY d.doc_id"""


def exact_top_k() -> str:
    return """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 20"""


def quality_filters() -> str:
    rate = {
        "word_length": "100 * word_chars // greatest(n_words, 1)",
        "length_class": "CASE WHEN n_words = 0 THEN 0 ELSE 8 * (length(bin(n_words)) - 1) + ((8 * n_words) >> (length(bin(n_words)) - 1)) - 8 END",
        "symbol_rate": "1000 * n_symbols // greatest(word_chars, 1)",
        "dup_line_rate": "1000 * n_dup_lines // greatest(n_lines, 1)",
        "repeat_rate": "1000 * n_repeat_words // greatest(n_words, 1)",
    }
    bucket = "(v >> greatest(length(bin(v)) - {b}, 0)) << greatest(length(bin(v)) - {b}, 0)".format(b=quality_rules.BITS)
    values = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, CAST({m} AS BIGINT) AS v FROM rated" for m in rate)

    def bound(limit: str) -> str:
        side, measure = limit.split("_", 1)
        fence = quality_rules.MEASURES[measure]
        away = f"{fence.reach} * greatest(q3 - q1, {fence.slack})"
        return f"max({f'q3 + {away}' if side == 'max' else f'q1 - {away}'}) FILTER (WHERE measure = '{measure}') AS {limit}"

    def fences(name: str, keys: str) -> str:
        group = f"{keys}, measure" if keys else "measure"
        select, by = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
        return f"""{name} AS (
  SELECT {select}max(n) AS n, {', '.join(map(bound, quality_rules.LIMITS))} FROM (
    SELECT {group}, count(*) AS n, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM valued GROUP BY {group}) {by})"""

    chosen = ", ".join(
        f"CAST(CASE WHEN f.n >= {quality_rules.MIN_ROWS} THEN f.{x} WHEN c.n >= {quality_rules.MIN_ROWS} THEN c.{x} "
        f"ELSE w.{x} END AS BIGINT) AS {x}"
        for x in quality_rules.LIMITS
    )
    within = " AND ".join(
        f"{x.split('_', 1)[1]} {'<=' if x.startswith('max') else '>='} {x}" for x in quality_rules.LIMITS
    )
    return rf"""
WITH docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '{WORD}')) AS word,
    generate_subscripts(regexp_extract_all(text, '{WORD}'), 1) AS place FROM docs),
windows AS (
  SELECT doc_id, place, [word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w] AS gram,
    lead(word, 4) OVER w IS NOT NULL AS whole FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
twice AS (
  SELECT doc_id, place FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows WHERE whole) WHERE n > 1),
covered AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, place + j AS place FROM twice, range(5) r(j)) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
repeats AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, lang, source,
    len(regexp_extract_all(text, '{WORD}')) AS n_words,
    length(regexp_replace(text, '{WS}', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM docs d LEFT JOIN repeats r ON r.doc_id = d.doc_id LEFT JOIN covered c ON c.doc_id = d.doc_id),
rated AS (SELECT *, {', '.join(f'{e} AS {m}' for m, e in rate.items())} FROM counted),
valued AS (SELECT *, {bucket} AS b FROM ({values})),
{fences('fine', 'lang, source')}, {fences('coarse', 'lang')}, {fences('whole', '')},
judged AS (
  SELECT r.*, {chosen}, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM rated r LEFT JOIN fine f ON f.lang IS NOT DISTINCT FROM r.lang AND f.source IS NOT DISTINCT FROM r.source
  LEFT JOIN coarse c ON c.lang IS NOT DISTINCT FROM r.lang CROSS JOIN whole w)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {within} AS kept,
  {', '.join(quality_rules.LIMITS)} FROM judged"""


def near_duplicates(percent: int = 85) -> str:
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({lower("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i : i + 4] END AS s
  FROM words, range(1, greatest(len(w) - 3, 2)) r(i) WHERE len(w) > 0 AND i <= greatest(len(w) - 4, 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= {percent} * (x.n + y.n - s.n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id, min(r.other) = d.doc_id AS kept
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id GROUP BY d.doc_id, z.n"""


def code_compression(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """All entries are compared with all parts in every round."""

    def assigned(book: str) -> str:
        return f"""
  SELECT row, vec_id, label, part, c, m % {entries} AS entry, m // {entries} AS away FROM (
    SELECT a.row, any_value(a.vec_id) AS vec_id, any_value(a.label) AS label, a.part, any_value(a.c) AS c,
      min({entries} * list_sum(list_transform(range(1, len(a.c) + 1), lambda i: (a.c[i] - b.c[i]) * (a.c[i] - b.c[i]))) + b.entry) AS m
    FROM cut a JOIN {book} b ON b.part = a.part GROUP BY a.row, a.part)"""

    steps = "".join(
        f"""
of{r} AS MATERIALIZED ({assigned(f"book{r}")}),
mean{r} AS (
  SELECT part, entry, list(floor_mean ORDER BY i) AS c FROM (
    SELECT part, entry, i, CAST(sum(c[i]) - (((sum(c[i]) % count(*)) + count(*)) % count(*)) AS BIGINT) // count(*) AS floor_mean
    FROM of{r}, range(1, len(c) + 1) r(i) GROUP BY part, entry, i) GROUP BY part, entry),
book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m ON m.part = b.part AND m.entry = b.entry),"""
        for r in range(rounds)
    )
    return f"""
WITH finite AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT row, vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS c FROM finite, range({parts}) p(part)),
book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, c FROM cut WHERE row <= {entries}),{steps}
coded AS MATERIALIZED ({assigned(f"book{rounds}")}),
rows AS (
  SELECT row, any_value(vec_id) AS vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
    CAST(sum(away) AS BIGINT) AS error FROM coded GROUP BY row),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM rows, books"""


def fill_in_middles() -> str:
    def draw(i: int) -> str:
        return f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}"

    plain = "form = 'plain'"
    return f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, n, {', '.join(map(draw, range(4)))} FROM texts),
formed AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1, n - b) AS s FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN {plain} THEN NULL ELSE CAST(a AS BIGINT) END AS prefix_chars,
  CASE WHEN {plain} THEN NULL ELSE CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
    AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""


def llm_oracles() -> dict[str, str]:
    from eventlake.llm.queries import URL_RULES

    return {
        "op1_url_filters": url_filters(URL_RULES),
        "op4_secret_scans": secret_scans(),
        "op5_exact_top_k": exact_top_k(),
        "op7_quality_rules": quality_filters(),
        "op8_near_duplicates": near_duplicates(),
        "op12_code_compression": code_compression(),
        "op13_fill_in_middle": fill_in_middles(),
    }
