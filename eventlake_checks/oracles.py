"""

Each oracle starts from the driver's ``events`` view with the same column derivations as the
fixtures and then computes its result with plain SQL: windows where the Spark jobs aggregate,
joins where they collapse first, and so on.
"""

from __future__ import annotations

from eventlake.operators.quality import declared_tests

AS_OF = "TIMESTAMP '2024-01-31 03:00:00'"
NULL_KEY = "_dbt_utils_surrogate_key_null_"
KNOWN = (
    "'PushEvent', 'PullRequestEvent', 'IssuesEvent', 'IssueCommentEvent', 'WatchEvent', 'ForkEvent', "
    "'CreateEvent', 'DeleteEvent', 'MemberEvent', 'ReleaseEvent', 'PullRequestReviewEvent'"
)

EV = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS n,
    CASE event_type
      WHEN 'click' THEN CASE WHEN event_id % 5 = 0 THEN 'CreateEvent' ELSE 'PushEvent' END
      WHEN 'view' THEN CASE WHEN event_id % 4 = 0 THEN 'ForkEvent' ELSE 'WatchEvent' END
      WHEN 'purchase' THEN 'PullRequestEvent'
      WHEN 'error' THEN CASE WHEN event_id % 6 = 0 THEN 'IssueCommentEvent' ELSE 'IssuesEvent' END
      WHEN 'signup' THEN CASE WHEN event_id % 7 = 0 THEN 'GollumEvent' ELSE 'MemberEvent' END
    END AS event_type,
    user_id AS actor_id,
    'user' || user_id || CASE WHEN user_id % 10 = 0 THEN '[bot]' ELSE '' END
      || CASE WHEN user_id % 9 = 0 AND ts >= TIMESTAMP '2024-01-16' THEN '-v2' ELSE '' END AS actor_login,
    CASE WHEN user_id % 25 = 0 THEN 'User' END AS actor_type,
    k AS repo_id,
    'org' || (k % 10) || '/' || CASE WHEN k % 7 = 0 THEN 'test-' ELSE '' END || 'repo' || k AS repo_name,
    CASE k % 4 WHEN 0 THEN 'Python' WHEN 1 THEN 'Go' WHEN 2 THEN 'Rust' END AS language,
    ts AS created_at, value,
    strftime(ts, '%Y-%m-%d-') || hour(ts) || '.json.gz' AS source_file,
    date_trunc('hour', ts) + INTERVAL 65 MINUTE AS loaded_at
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""

GAPPY = """gappy AS (
  SELECT event_id, n, event_type, created_at, value, source_file, loaded_at,
    CASE WHEN n % 103 <> 0 THEN actor_id END AS actor_id,
    CASE WHEN n % 103 <> 0 THEN actor_login END AS actor_login,
    CASE WHEN n % 103 <> 0 THEN actor_type END AS actor_type,
    CASE WHEN n % 101 <> 0 THEN repo_id END AS repo_id,
    CASE WHEN n % 101 <> 0 THEN repo_name END AS repo_name
  FROM ev)"""

LATE = """late AS (
  SELECT * REPLACE (loaded_at + CASE WHEN n % 97 = 0 THEN INTERVAL 3 HOUR ELSE INTERVAL 0 HOUR END AS loaded_at)
  FROM ev)"""


def doubled(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT * FROM {source} UNION ALL
  SELECT * REPLACE (loaded_at + INTERVAL 1 HOUR AS loaded_at) FROM {source} WHERE n % 50 = 0)"""


DUP = doubled("ev", "dup")

LH = """lh AS (
  SELECT strftime(hr, '%Y-%m-%d-') || hour(hr) || '.json.gz' AS file_name,
    hr + CASE WHEN attempt = 1 THEN INTERVAL 65 MINUTE ELSE INTERVAL 95 MINUTE END AS load_ts, hr AS file_hour, row_count,
    row_count * 300 AS file_size_bytes, status,
    CASE WHEN status <> 'SUCCESS' THEN 'timeout' END AS error_message,
    CASE WHEN status = 'RETRY' THEN h % 3 ELSE 0 END AS retry_count,
    CASE WHEN status <> 'FAILED' THEN CAST(row_count % 17 AS DOUBLE) + 0.25 END AS load_duration_seconds,
    'loader' AS loaded_by
  FROM (
    SELECT hr, h, attempt, status, CASE WHEN status = 'FAILED' THEN 0 ELSE n END AS row_count
    FROM (
      SELECT hr, h, n, attempt,
        CASE WHEN h % 31 = 0 AND attempt = 1 THEN 'FAILED' WHEN h % 41 = 0 AND h % 31 <> 0 THEN 'RETRY' ELSE 'SUCCESS' END AS status
      FROM (VALUES (1), (2)) a(attempt), (
        SELECT date_trunc('hour', ts) AS hr, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) // 3600 AS h, count(*) AS n
        FROM events GROUP BY ALL)
      WHERE h % 53 <> 0 AND (attempt = 1 OR h % 62 = 0))))"""

LATEST = "la AS (SELECT * FROM lh QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY load_ts DESC) = 1)"

FILES = """files AS (
  SELECT DISTINCT source_file AS file_name, date_trunc('hour', created_at) AS file_hour FROM ev)"""


def key(*columns: str) -> str:
    parts = " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_KEY}')" for c in columns)
    return f"md5({parts})"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({part} * 100.0 / {whole} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def rnd(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def query(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((EV, *ctes)) + "\n" + body


def actors(source: str, name: str) -> str:
    """Staged actors: the latest event of each actor joined with its time span."""
    return f"""{name} AS (
  SELECT l.actor_id, l.actor_login, l.cls AS actor_type, first_seen_at, last_seen_at,
    date_diff('day', first_seen_at, last_seen_at) AS days_active
  FROM (
    SELECT *, row_number() OVER (PARTITION BY actor_id ORDER BY created_at DESC, actor_login, cls) AS rn,
      min(created_at) OVER (PARTITION BY actor_id) AS first_seen_at,
      max(created_at) OVER (PARTITION BY actor_id) AS last_seen_at
    FROM (SELECT *, coalesce(actor_type, CASE WHEN actor_login ILIKE '%bot%' THEN 'Bot' ELSE 'User' END) AS cls
          FROM {source} WHERE actor_id IS NOT NULL AND actor_login IS NOT NULL)) l
  WHERE rn = 1)"""


# type-2 versions of actors in event time
HISTORY = f"""SELECT {key('actor_id')} AS actor_key, actor_id, actor_login, actor_type, created_at AS valid_from,
  coalesce(nxt, TIMESTAMP '2099-12-31') AS valid_to, nxt IS NULL AS is_current
FROM (
  SELECT *, lead(created_at) OVER (PARTITION BY actor_id ORDER BY created_at, actor_login, actor_type, event_id) AS nxt
  FROM (
    SELECT *, lag(actor_login || '|' || actor_type) OVER
      (PARTITION BY actor_id ORDER BY created_at, actor_login, actor_type, event_id) AS prev
    FROM (SELECT * REPLACE (coalesce(actor_type, CASE WHEN actor_login ILIKE '%bot%' THEN 'Bot' ELSE 'User' END) AS actor_type) FROM ev))
  WHERE prev IS NULL OR prev <> actor_login || '|' || actor_type)"""


def repos(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT repo_id, repo_name, split_part(repo_name, '/', 1) AS repo_owner,
    split_part(repo_name, '/', 2) AS repo_short_name, first_event_at, last_event_at,
    date_diff('day', first_event_at, last_event_at) AS days_active
  FROM (
    SELECT *, row_number() OVER (PARTITION BY repo_id ORDER BY created_at DESC, repo_name) AS rn,
      min(created_at) OVER (PARTITION BY repo_id) AS first_event_at,
      max(created_at) OVER (PARTITION BY repo_id) AS last_event_at
    FROM {source} WHERE repo_id IS NOT NULL AND repo_name IS NOT NULL)
  WHERE rn = 1)"""


def types(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT event_type, count(*) AS event_count, count(DISTINCT actor_id) AS unique_actors,
    count(DISTINCT repo_id) AS unique_repos, min(created_at) AS first_occurrence,
    max(created_at) AS last_occurrence,
    {pct('count(*)', f'(SELECT count(*) FROM {source} WHERE event_type IS NOT NULL)')} AS percent_of_total_events,
    CASE event_type
      WHEN 'PushEvent' THEN 'Code push to repository'
      WHEN 'PullRequestEvent' THEN 'Pull request opened/closed/reopened'
      WHEN 'IssuesEvent' THEN 'Issue opened/closed/reopened'
      WHEN 'IssueCommentEvent' THEN 'Comment added to issue/PR'
      WHEN 'WatchEvent' THEN 'User starred repository'
      WHEN 'ForkEvent' THEN 'Repository forked'
      WHEN 'CreateEvent' THEN 'Branch or tag created'
      WHEN 'DeleteEvent' THEN 'Branch or tag deleted'
      WHEN 'MemberEvent' THEN 'Collaborator added'
      WHEN 'ReleaseEvent' THEN 'Release published'
      WHEN 'PullRequestReviewEvent' THEN 'PR review submitted'
      ELSE 'Other event type' END AS event_description
  FROM {source} WHERE event_type IS NOT NULL GROUP BY event_type)"""


def dim_actor(source: str, name: str, valid_from: str = AS_OF) -> str:
    return f"""{name} AS (
  SELECT {key('actor_id')} AS actor_key, *, actor_type = 'Bot' AS is_bot, {valid_from} AS valid_from,
    TIMESTAMP '2099-12-31' AS valid_to, true AS is_current FROM {source})"""


def dim_repo(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {key('repo_id')} AS repo_key, *, repo_name ILIKE '%test%' OR repo_name ILIKE '%example%' AS is_test_repo
  FROM {source})"""


def dim_type(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {key('event_type')} AS event_type_key, *,
    CASE WHEN event_type IN ('PushEvent', 'PullRequestEvent', 'IssuesEvent') THEN 'Activity'
      WHEN event_type IN ('CreateEvent', 'DeleteEvent') THEN 'Repository Management'
      WHEN event_type IN ('WatchEvent', 'ForkEvent') THEN 'Engagement'
      WHEN event_type IN ('MemberEvent', 'ReleaseEvent') THEN 'Collaboration'
      ELSE 'Other' END AS event_category
  FROM {source})"""


def fact(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {key('event_id')} AS event_key, event_id, {key('actor_id')} AS actor_key,
    {key('repo_id')} AS repo_key, {key('event_type')} AS event_type_key, event_type, actor_id,
    actor_login, repo_id, repo_name, created_at, CAST(created_at AS DATE) AS event_date,
    {big('hour(created_at)')} AS event_hour, left(dayname(created_at), 3) AS event_day_of_week,
    {big('week(created_at)')} AS event_week, {big('month(created_at)')} AS event_month,
    {big('year(created_at)')} AS event_year, source_file, loaded_at
  FROM {source} WHERE event_id IS NOT NULL AND created_at IS NOT NULL)"""


SA, SR, ST = actors("ev", "sa"), repos("ev", "sr"), types("ev", "st")
DA, DR, DT = dim_actor("sa", "da"), dim_repo("sr", "dr"), dim_type("st", "dt")
FA = fact("ev", "fa")
STAR = (SA, SR, ST, DA, DR, DT, FA)

# type-2 merge of the full snapshot into the dimension as of the 10th
SCD = (
    actors("(SELECT * FROM ev WHERE loaded_at < TIMESTAMP '2024-01-10')", "sb"),
    dim_actor("sb", "db", "TIMESTAMP '2024-01-10'"),
    """scd AS (
  SELECT db.* REPLACE (
      CASE WHEN changed THEN db.last_seen_at ELSE greatest(db.last_seen_at, s.last_seen_at) END AS last_seen_at,
      CASE WHEN changed THEN db.days_active
        ELSE date_diff('day', db.first_seen_at, greatest(db.last_seen_at, s.last_seen_at)) END AS days_active,
      CASE WHEN changed THEN TIMESTAMP '2024-01-31 03:00:00' ELSE db.valid_to END AS valid_to,
      NOT changed AS is_current)
  FROM db JOIN (
    SELECT da.*, db.actor_login <> da.actor_login OR db.actor_type <> da.actor_type AS changed
    FROM da JOIN db USING (actor_id)) s USING (actor_id)
  UNION ALL
  SELECT da.* FROM da LEFT JOIN db USING (actor_id)
  WHERE db.actor_id IS NULL OR db.actor_login <> da.actor_login OR db.actor_type <> da.actor_type)""",
)


def incremental(target: str, source: str) -> str:
    """Rows of ``target`` not in ``source``, then ``source``."""
    columns = "event_id, event_key, actor_key, event_date, source_file, loaded_at"
    return f"""SELECT {columns} FROM {target} WHERE event_id NOT IN (SELECT event_id FROM {source})
UNION ALL SELECT {columns} FROM {source}"""


# --- declared tests -------------------------------------------------------------------------

MESSY = (GAPPY, doubled("gappy", "messy"))
SUITE_MODELS = (
    *MESSY,
    LH,
    actors("messy", "stg_actors"),
    repos("messy", "stg_repositories"),
    types("messy", "stg_event_types"),
    dim_actor("stg_actors", "da0"),
    dim_repo("stg_repositories", "dr0"),
    dim_type("stg_event_types", "dt0"),
    fact("messy", "fa0"),
    f"dim_actor AS (SELECT *, {AS_OF} AS created_ts, {AS_OF} AS updated_ts FROM da0)",
    f"dim_repository AS (SELECT *, {AS_OF} AS created_ts, {AS_OF} AS updated_ts FROM dr0)",
    f"dim_event_type AS (SELECT *, {AS_OF} AS created_ts, {AS_OF} AS updated_ts FROM dt0)",
    f"fact_events AS (SELECT *, {AS_OF} AS created_ts FROM fa0)",
    "stg_events AS (SELECT * FROM messy)",
    "load_history AS (SELECT * FROM lh)",
    "raw_events AS (SELECT event_id AS raw_data, source_file AS file_name, loaded_at AS load_ts FROM ev)",
)


def _suite() -> str:
    parts = []
    for t in declared_tests():
        column, model = t.column, t.model
        if t.test == "not_null":
            failing = f"SELECT 1 FROM {model} WHERE {column} IS NULL"
        elif t.test == "unique":
            failing = f"SELECT 1 FROM {model} WHERE {t.among} AND {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1"
        elif t.test == "accepted_values":
            values = ", ".join(f"'{v}'" for v in t.values)
            failing = f"SELECT DISTINCT {column} FROM {model} WHERE {column} NOT IN ({values})"
        else:
            failing = (
                f"SELECT DISTINCT c.{column} FROM {model} c LEFT JOIN {t.parent} p ON c.{column} = p.{column} "
                f"WHERE p.{column} IS NULL AND c.{column} IS NOT NULL"
            )
        parts.append(
            f"SELECT '{model}' AS model_name, '{t.test}' AS test_name, '{column}' AS column_name, "
            f"count(*) AS failures FROM ({failing})"
        )
    union = "\nUNION ALL ".join(parts)
    return f"""suite AS (
  SELECT *, 'warn' AS severity, CASE WHEN failures = 0 THEN 'pass' ELSE 'warn' END AS status
  FROM ({union}))"""


SUITE = (*SUITE_MODELS, _suite())


def check_row(name: str, status: str, value: str, severity: str, message: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, {status} AS status, CAST({value} AS DOUBLE) AS value, "
        f"{severity} AS severity, CASE WHEN {severity} IS NOT NULL THEN {message} END AS message FROM ({source})"
    )


CHECK_FRESH = check_row(
    "raw_freshness",
    "CASE WHEN age < 2 THEN 'FRESH' ELSE 'STALE' END",
    "age",
    "CASE WHEN age >= 4 THEN 'ERROR' WHEN age >= 2 THEN 'WARNING' END",
    "'newest load is ' || age || 'h old'",
    f"SELECT date_diff('hour', max(loaded_at), {AS_OF}) AS age FROM ev",
)
CHECK_DUP = check_row(
    "duplicates",
    "CASE WHEN x = 0 THEN 'OK' ELSE 'FAILED' END",
    "x",
    "CASE WHEN x > 0 THEN 'ERROR' END",
    "x || ' event ids occur more than once'",
    "SELECT count(*) AS x FROM (SELECT event_id FROM dup GROUP BY event_id HAVING count(*) > 1)",
)
CHECK_LOADS = check_row(
    "recent_failures",
    "CASE WHEN x = 0 THEN 'OK' ELSE 'FAILED' END",
    "x",
    "CASE WHEN x > 0 THEN 'WARNING' END",
    "x || ' loads failed in the last 72h'",
    f"SELECT count(*) FILTER (WHERE status = 'FAILED' AND load_ts >= {AS_OF} - INTERVAL 72 HOUR) AS x FROM lh",
)
CHECK_DIMS = check_row(
    "missing_dimensions",
    "CASE WHEN x = 0 THEN 'OK' ELSE 'FAILED' END",
    "x",
    "CASE WHEN x > 0 THEN 'WARNING' END",
    "x || ' dimension keys or ids are missing'",
    "SELECT " + " + ".join(
        f"count(*) FILTER (WHERE {c} IS NULL)"
        for c in ("actor_key", "repo_key", "event_type_key", "actor_id", "repo_id", "event_type")
    ) + " AS x FROM fd",
)


def daily_flags(source: str, since: str, low: float, high: float) -> str:
    return f"""SELECT event_date, daily_events, {rnd('m', 0)} AS avg_before,
  {rnd('daily_events * CAST(100.0 AS DOUBLE) / m', 1)} AS pct_of_avg,
  CASE WHEN daily_events < {low} * m THEN 'LOW' WHEN daily_events > {high} * m THEN 'HIGH' ELSE 'NORMAL' END AS anomaly_flag
FROM (
  SELECT event_date, daily_events, avg(daily_events) OVER (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS m
  FROM (SELECT CAST(created_at AS DATE) AS event_date, count(*) AS daily_events FROM {source}
        WHERE created_at >= {since} GROUP BY ALL))"""


CHECK_VOLUME = check_row(
    "volume_anomaly",
    "CASE WHEN pct_of_avg < 80 OR pct_of_avg > 120 THEN 'ANOMALY' ELSE 'OK' END",
    "pct_of_avg",
    "CASE WHEN pct_of_avg < 80 OR pct_of_avg > 120 THEN 'WARNING' END",
    "daily_events || ' events are ' || pct_of_avg || '% of the average'",
    "SELECT * FROM (" + daily_flags("fd", "TIMESTAMP '2024-01-24'", 0.8, 1.2) + ") WHERE event_date = DATE '2024-01-30'",
)


def tier(unit: str, bounds: list[tuple[str, int]]) -> str:
    age = f"date_diff('{unit}', last_loaded, {AS_OF})"
    return "CASE " + " ".join(f"WHEN {age} < {b} THEN '{n}'" for n, b in bounds) + " ELSE 'STALE' END"


def _freshness(rule: str, expression: str) -> str:
    return f"""SELECT last_loaded, date_diff('minute', last_loaded, {AS_OF}) AS minutes_behind,
  date_diff('hour', last_loaded, {AS_OF}) AS hours_behind, {expression} AS freshness, '{rule}' AS rule
FROM (SELECT max(loaded_at) AS last_loaded FROM ev)"""


def _source_freshness(name: str, source: str, column: str) -> str:
    age = f"CAST(epoch({AS_OF}) - epoch(x) AS BIGINT)"
    return f"""SELECT '{name}' AS source_name, x AS last_loaded, {age} AS age_seconds,
  CASE WHEN x IS NULL OR {age} > 14400 THEN 'error' WHEN {age} > 7200 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max({column}) AS x FROM {source})"""


def hour_list(start: str, stop: str) -> str:
    return f"SELECT unnest(generate_series({start}, {stop}, INTERVAL 1 HOUR)) AS expected_hour"


def _series(name: str, start: str, stop: str, only: str = "true") -> str:
    return f"SELECT '{name}' AS series, expected_hour FROM ({hour_list(start, stop)}) WHERE {only}"


FILE_OF_HOUR = "strftime(expected_hour, '%Y-%m-%d-') || hour(expected_hour) || '.json.gz'"
SPLIT = "TIMESTAMP '2024-01-28'"
LAST_WEEK = f"wk AS (SELECT expected_hour, {FILE_OF_HOUR} AS file_name FROM ({hour_list(AS_OF + ' - INTERVAL 168 HOUR', AS_OF + ' - INTERVAL 1 HOUR')}))"

_MISSING_SPEC = [("Missing Event IDs", "event_id"), ("Missing Event Types", "event_type"),
                 ("Missing Actors", "actor_id"), ("Missing Repos", "repo_id")]


def _report_lines() -> str:
    stamp = "strftime({}, '%Y-%m-%d %H:%M:%S')"
    lines = [
        ("Coverage", "Total Events", "SELECT count(*) FROM gappy"),
        ("Coverage", "Date Range", "SELECT " + stamp.format("min(created_at)") + " || ' to ' || "
         + stamp.format("max(created_at)") + " FROM gappy"),
    ]
    lines += [("Data Completeness", t, f"SELECT count(*) FROM gappy WHERE {c} IS NULL") for t, c in _MISSING_SPEC]
    lines += [
        ("Entity Counts", "Unique Developers", "SELECT count(DISTINCT actor_id) FROM gappy"),
        ("Entity Counts", "Unique Repositories", "SELECT count(DISTINCT repo_id) FROM gappy"),
        ("Entity Counts", "Event Types", "SELECT count(DISTINCT event_type) FROM gappy"),
        ("Load Status", "Files Loaded", "SELECT count(*) FROM lh WHERE status = 'SUCCESS'"),
        ("Load Status", "Load Failures", "SELECT count(*) FROM lh WHERE status = 'FAILED'"),
    ]
    return "\nUNION ALL ".join(
        f"SELECT {big(str(i + 1))} AS line_no, '{section}' AS section, '{label}' AS label, "
        f"CAST(({sql}) AS VARCHAR) AS value"
        for i, (section, label, sql) in enumerate(lines)
    )


def _counts(models: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS model_name, count(*) AS row_count FROM {cte}" for name, cte in models.items()
    )


_MODELS = {"raw_events": "ev", "load_history": "lh", "stg_events": "ev", "dim_actor": "da",
           "dim_repository": "dr", "dim_event_type": "dt", "fact_events": "fa"}

_JSON = (
    "'{' || CASE WHEN actor_type IS NULL THEN '\"actor\":{\"id\":' || actor_id || ',\"login\":\"' || actor_login || '\"}' "
    "ELSE '\"actor\":{\"id\":' || actor_id || ',\"login\":\"' || actor_login || '\",\"type\":\"' || actor_type || '\"}' END "
    "|| ',\"created_at\":\"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') || '\",\"id\":\"' || event_id "
    "|| '\",\"payload\":{' "
    "|| CASE WHEN event_type IN ('IssuesEvent', 'IssueCommentEvent') THEN '\"action\":\"opened\",' ELSE '' END "
    "|| '\"distinct_size\":' || (n % 3) "
    "|| CASE WHEN event_type IN ('IssuesEvent', 'IssueCommentEvent') THEN ',\"issue\":{\"id\":' || (n * 10 + 1) || '}' ELSE '' END "
    "|| CASE WHEN event_type = 'PullRequestEvent' THEN ',\"pull_request\":{\"id\":' || (n * 10) || '}' ELSE '' END "
    "|| ',\"ref\":\"refs/heads/b' || (repo_id % 3) || '\",\"size\":' || (n % 5) || ',\"value\":' || "
    "regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') || '},\"public\":true,\"repo\":{\"id\":' || repo_id "
    "|| CASE WHEN language IS NULL THEN '' ELSE ',\"language\":\"' || language || '\"' END "
    "|| ',\"name\":\"' || repo_name || '\",\"url\":\"https://example.org/' || repo_name || '\"},\"type\":\"' || event_type || '\"}'"
)


def build_oracles() -> dict[str, str]:
    o: dict[str, str] = {}

    # sources, sinks, ingest
    o["scan_hourly_ndjson"] = query(
        f"SELECT event_id, event_type, repo_name, source_file AS file_name, {AS_OF} AS load_ts FROM ev"
    )
    o["skip_malformed_lines"] = query(
        """SELECT source_file AS file_name, count(*) AS line_count,
  count(*) FILTER (WHERE n % 109 = 0) AS blank_count,
  count(*) FILTER (WHERE n % 107 = 0 AND n % 109 <> 0) AS malformed_count,
  count(*) FILTER (WHERE n % 107 <> 0 AND n % 109 <> 0) AS parsed_count
FROM ev GROUP BY source_file"""
    )
    o["well_formed_rows"] = query(
        "SELECT event_id, event_type, source_file AS file_name FROM ev WHERE n % 107 <> 0 AND n % 109 <> 0"
    )
    o["validate_required_fields"] = query(
        """SELECT source_file AS file_name,
  count(*) FILTER (WHERE actor_id IS NOT NULL AND repo_id IS NOT NULL) AS valid_count,
  count(*) FILTER (WHERE actor_id IS NULL OR repo_id IS NULL) AS invalid_count
FROM gappy GROUP BY source_file""",
        GAPPY,
    )
    o["strip_nul_chars"] = query(
        "SELECT event_id, replace(actor_login || chr(0) || event_type || chr(0), chr(0), '') AS cleaned FROM ev"
    )
    o["expected_hours"] = query(
        f"""SELECT series, expected_hour, file_name, coalesce(event_count, 0) AS event_count
FROM (SELECT *, {FILE_OF_HOUR} AS file_name FROM (
  {_series('loaded_span', '(SELECT min(file_hour) FROM lh)', '(SELECT max(file_hour) FROM lh)')}
  UNION ALL {_series('last_days', AS_OF + ' - INTERVAL 168 HOUR', AS_OF + ' - INTERVAL 1 HOUR')}
  UNION ALL {_series('midnights', "TIMESTAMP '2024-01-25'", "TIMESTAMP '2024-01-31'", 'hour(expected_hour) = 0')}
  UNION ALL {_series('trailing', AS_OF + ' - INTERVAL 744 HOUR', AS_OF)}))
LEFT JOIN (SELECT source_file AS file_name, count(*) AS event_count FROM ev GROUP BY ALL) USING (file_name)""",
        LH,
    )
    o["hour_file_name"] = query(
        """SELECT date_trunc('hour', created_at) AS file_hour, count(*) AS event_count,
  any_value(source_file) AS file_name, date_trunc('hour', min(created_at)) AS parsed_hour
FROM ev GROUP BY date_trunc('hour', created_at)"""
    )
    o["discover_files"] = query(
        f"SELECT file_name, file_hour FROM files WHERE file_hour >= {AS_OF} - INTERVAL 600 HOUR AND file_hour < {AS_OF}",
        FILES,
    )
    unloaded = "file_name NOT IN (SELECT file_name FROM lh WHERE status = 'SUCCESS')"
    o["next_unloaded_file"] = query(
        f"""SELECT file_name, file_hour FROM files
WHERE file_hour >= {AS_OF} - INTERVAL 72 HOUR AND file_hour < {AS_OF} AND {unloaded}
ORDER BY file_hour DESC LIMIT 1""",
        FILES,
        LH,
    )
    o["unloaded_files"] = query(f"SELECT file_name, file_hour FROM files WHERE {unloaded}", FILES, LH)
    o["load_once"] = query("SELECT event_id, source_file AS file_name FROM ev")
    o["bulk_append"] = query("SELECT source_file AS file_name, count(*) AS row_count FROM ev GROUP BY source_file")
    o["record_loads"] = query(
        f"""SELECT file_name, {AS_OF} AS load_ts, file_hour, row_count,
  CASE WHEN status <> 'FAILED' THEN file_size_bytes END AS file_size_bytes,
  CASE WHEN status = 'FAILED' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN status = 'FAILED' THEN left(repeat('timeout ', 200), 1000) END AS error_message,
  {big('0')} AS retry_count, load_duration_seconds, loaded_by FROM lh""",
        LH,
    )
    gone = "file_name = '2024-01-15-3.json.gz'"
    o["delete_file_events"] = query(
        f"""SELECT 'raw_events' AS table_name, count(*) FILTER (WHERE source_{gone.replace('file_name', 'file')}) AS deleted_rows,
  count(*) FILTER (WHERE NOT (source_{gone.replace('file_name', 'file')})) AS kept_rows FROM ev
UNION ALL SELECT 'load_history', count(*) FILTER (WHERE {gone}), count(*) FILTER (WHERE NOT ({gone})) FROM lh""",
        LH,
    )
    o["archive_old_loads"] = query(
        f"""SELECT CASE WHEN status = 'SUCCESS' AND load_ts < {AS_OF} - INTERVAL 10 DAY THEN 'archived' ELSE 'kept' END AS part,
  file_name, file_hour, load_ts, status, row_count FROM lh""",
        LH,
    )
    o["last_successful_load"] = query(
        "SELECT file_name, file_hour FROM lh WHERE status = 'SUCCESS' ORDER BY file_hour DESC LIMIT 1", LH
    )
    o["backfill"] = query(
        f"""SELECT wk.file_name, wk.expected_hour,
  CASE WHEN b.file_name IS NOT NULL THEN 'skipped' WHEN c.n IS NOT NULL THEN 'loaded' ELSE 'skipped' END AS outcome,
  CASE WHEN b.file_name IS NOT NULL THEN 'already loaded' WHEN c.n IS NOT NULL THEN 'success' ELSE 'missing' END AS reason,
  CASE WHEN b.file_name IS NULL THEN coalesce(c.n, 0) ELSE 0 END AS row_count
FROM wk
LEFT JOIN (SELECT file_name FROM lh WHERE status = 'SUCCESS' AND file_hour < {SPLIT}) b USING (file_name)
LEFT JOIN (SELECT source_file AS file_name, count(*) AS n FROM ev GROUP BY ALL) c USING (file_name)""",
        LH,
        LAST_WEEK,
    )
    o["backfill_summary"] = query(
        f"""SELECT count(*) AS total_files, count(*) FILTER (WHERE outcome = 'loaded') AS loaded_files,
  count(*) FILTER (WHERE outcome = 'skipped') AS skipped_files,
  count(*) FILTER (WHERE outcome = 'failed') AS failed_files,
  {big("coalesce(sum(row_count) FILTER (WHERE outcome = 'loaded'), 0)")} AS loaded_rows,
  (SELECT count(*) FROM ev) AS stored_events,
  (SELECT count(*) FROM lh WHERE status = 'SUCCESS') AS success_loads,
  (SELECT count(*) FROM lh WHERE status = 'FAILED') AS failure_loads,
  (SELECT min(created_at) FROM ev) AS earliest_event, (SELECT max(created_at) FROM ev) AS latest_event,
  (SELECT count(*) FROM ev) > 0 AND (SELECT count(*) FROM lh WHERE status = 'SUCCESS') > 0 AS is_valid
FROM (
  SELECT wk.file_name, la.row_count,
    CASE WHEN la.file_hour < {SPLIT} AND status = 'SUCCESS' THEN 'skipped'
      WHEN la.file_hour >= {SPLIT} AND status = 'SUCCESS' AND row_count > 0 THEN 'loaded'
      WHEN la.file_hour >= {SPLIT} AND status = 'FAILED' THEN 'failed' ELSE 'skipped' END AS outcome
  FROM wk LEFT JOIN la USING (file_name))""",
        LH,
        LATEST,
        LAST_WEEK,
    )
    o["latest_events"] = query(
        """SELECT event_id, event_type, created_at, actor_id, repo_id FROM ev
WHERE created_at >= TIMESTAMP '2024-01-24' AND event_type = 'PushEvent'
ORDER BY created_at DESC, event_id LIMIT 1000"""
    )
    o["raw_sample"] = query(f"SELECT event_id, {_JSON} AS raw_json FROM ev ORDER BY event_id LIMIT 10")
    o["table_contract"] = query(
        f"SELECT model_name AS table_name, row_count, 'PASS' AS status, 'as declared' AS note FROM ({_counts(_MODELS)})",
        LH,
        *STAR,
    )

    # staging
    o["stg_events"] = query(
        """SELECT event_id, event_type, actor_id, actor_login, actor_type, repo_id, repo_name, created_at,
  source_file, loaded_at FROM ev"""
    )
    o["classify_actor"] = query(
        """SELECT event_id, actor_login, CASE WHEN actor_type IS NOT NULL THEN actor_type
  WHEN lower(actor_login) LIKE '%bot%' THEN 'Bot' ELSE 'User' END AS actor_type FROM ev"""
    )
    o["stg_actors"] = query("SELECT * FROM sa", SA)
    o["stg_repositories"] = query("SELECT * FROM sr", SR)
    o["stg_event_types"] = query("SELECT * FROM st", ST)
    o["payload_fields"] = query(
        """SELECT event_id, event_type, n % 5 AS push_size,
  CASE WHEN event_type = 'PullRequestEvent' THEN n * 10 END AS pull_request_id,
  CASE WHEN event_type IN ('IssuesEvent', 'IssueCommentEvent') THEN n * 10 + 1 END AS issue_id,
  CASE WHEN event_type IN ('IssuesEvent', 'IssueCommentEvent') THEN 'opened' END AS issue_action,
  'https://example.org/' || repo_name AS repo_url FROM ev"""
    )

    # marts
    o["surrogate_key"] = query(
        f"""SELECT event_id, {key('event_id')} AS event_key, {key('actor_id')} AS actor_key,
  {key('repo_id', 'actor_type')} AS pair_key FROM gappy""",
        GAPPY,
    )
    o["fact_events_full"] = query("SELECT * FROM fa", FA)
    o["fact_events_incremental"] = query(
        incremental("base", "delta"),
        FA,
        "base AS (SELECT * FROM fa WHERE loaded_at < TIMESTAMP '2024-01-20')",
        "delta AS (SELECT * FROM fa WHERE loaded_at > (SELECT max(loaded_at) FROM base))",
    )
    o["upsert_by_key"] = query(
        """SELECT event_id, created_at, loaded_at, value + 1 AS value FROM ev WHERE created_at >= TIMESTAMP '2024-01-19'
UNION ALL
SELECT event_id, created_at, loaded_at, value FROM ev WHERE created_at < TIMESTAMP '2024-01-19'"""
    )
    o["late_arrival_overlap"] = query(
        incremental("base", "delta"),
        LATE,
        fact("late", "fl"),
        "base AS (SELECT * FROM fl WHERE loaded_at < TIMESTAMP '2024-01-20')",
        "delta AS (SELECT * FROM fl WHERE created_at > (SELECT max(created_at) - INTERVAL 2 HOUR FROM base))",
    )
    o["dedup_by_key"] = query(
        """SELECT event_id, created_at, source_file, loaded_at FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY loaded_at DESC, source_file) AS rn FROM dup)
WHERE rn = 1""",
        DUP,
    )
    o["dim_actor_full"] = query("SELECT * FROM da", SA, DA)
    o["dim_actor_incremental"] = query(
        "SELECT * FROM db UNION ALL SELECT * FROM da WHERE actor_id NOT IN (SELECT actor_id FROM db)",
        SA,
        DA,
        actors("(SELECT * FROM ev WHERE loaded_at < TIMESTAMP '2024-01-02')", "sb"),
        dim_actor("sb", "db", "TIMESTAMP '2024-01-02'"),
    )
    o["dim_actor_scd2"] = query("SELECT * FROM scd", SA, DA, *SCD)
    o["dim_actor_scd2_history"] = query(HISTORY)
    o["dim_actor_scd2_batches"] = query(
        """SELECT v.*, first_seen_at, last_seen_at, date_diff('day', first_seen_at, last_seen_at) AS days_active, is_bot FROM (
  SELECT h.actor_key, h.valid_from, any_value(h.actor_id) AS actor_id, any_value(h.actor_login) AS actor_login,
    any_value(h.actor_type) AS actor_type, any_value(h.valid_to) AS valid_to, any_value(h.is_current) AS is_current
  FROM hist h GROUP BY ALL) v
JOIN (SELECT h.actor_key, h.valid_from, max(e.created_at) AS last_seen_at, any_value(h.actor_type) = 'Bot' AS is_bot,
    (SELECT min(created_at) FROM ev f WHERE f.actor_id = any_value(h.actor_id)) AS first_seen_at
  FROM hist h JOIN ev e ON e.actor_id = h.actor_id AND e.created_at >= h.valid_from AND e.created_at < h.valid_to
  GROUP BY ALL) USING (actor_key, valid_from)""",
        "hist AS (" + HISTORY + ")",
    )
    o["dim_event_type_batches"] = query("SELECT * FROM dt", ST, DT)
    o["event_types_approximate"] = query(
        "SELECT event_type, event_count, unique_actors, unique_repos, TRUE AS near_unique_actors, TRUE AS near_unique_repos FROM st", ST
    )
    o["dim_repository"] = query("SELECT * FROM dr", SR, DR)
    o["dim_event_type"] = query("SELECT * FROM dt", ST, DT)
    o["fact_push_events"] = query(
        f"""SELECT {key('event_id')} AS event_key, event_id, actor_id, repo_id, created_at, n % 5 AS commits_count,
  {big('1')} AS branches_pushed, n % 3 AS distinct_sizes FROM ev WHERE event_type = 'PushEvent'"""
    )
    o["mart_layout"] = query(
        "SELECT event_date, count(*) AS event_count, count(DISTINCT repo_key) AS repo_count FROM fa GROUP BY event_date",
        FA,
    )
    o["layout_lookups"] = query(
        "\nUNION ALL ".join(
            (
                f"SELECT 'repository' AS lookup, count(*) AS row_count FROM fa WHERE repo_key = {key('7')}",
                f"SELECT 'actor', count(*) FROM fa WHERE actor_key = {key('25')}",
                "SELECT 'event', count(*) FROM fa WHERE event_id = '500'",
                "SELECT 'failed loads', count(*) FROM lh WHERE status = 'FAILED' AND file_hour >= TIMESTAMP '2024-01-20'",
                "SELECT 'current actors', count(*) FROM scd WHERE is_current",
            )
        ),
        SA,
        DA,
        *SCD,
        FA,
        LH,
    )
    o["new_duplicate_keys"] = query(
        f"SELECT event_id, {big('2')} AS row_count FROM ev WHERE CAST(event_id AS BIGINT) % 50 = 0"
    )

    # reports
    o["raw_overview"] = query(
        """SELECT count(*) AS total_events, count(DISTINCT event_id) AS distinct_events,
  count(DISTINCT actor_id) AS unique_actors, count(DISTINCT repo_id) AS unique_repositories,
  min(created_at) AS earliest_event, max(created_at) AS latest_event,
  date_diff('day', min(created_at), max(created_at)) AS days_of_data FROM ev"""
    )
    o["null_profile"] = query(
        "\nUNION ALL ".join(
            f"""SELECT '{field}' AS field, count(*) FILTER (WHERE {column} IS NULL) AS null_count,
  {pct(f'count(*) FILTER (WHERE {column} IS NULL)', 'count(*)')} AS null_percent FROM gappy"""
            for field, column in (
                ("id", "event_id"),
                ("type", "event_type"),
                ("actor", "actor_id"),
                ("repo", "repo_id"),
                ("created_at", "created_at"),
            )
        ),
        GAPPY,
    )
    o["event_type_distribution"] = query(
        f"""SELECT event_type, count(*) AS event_count, count(DISTINCT actor_id) AS unique_actors,
  count(DISTINCT repo_id) AS unique_repos, min(created_at) AS first_occurrence, max(created_at) AS last_occurrence,
  {pct('count(*)', '(SELECT count(*) FROM ev)')} AS percent_of_total FROM ev GROUP BY event_type"""
    )
    o["top_repositories"] = query(
        """SELECT repo_id, repo_name, count(*) AS total_events, count(DISTINCT actor_id) AS unique_contributors,
  count(DISTINCT event_type) AS event_type_count, min(created_at) AS first_event, max(created_at) AS last_event,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_type_list
FROM ev GROUP BY repo_id, repo_name ORDER BY total_events DESC, repo_id, repo_name LIMIT 50"""
    )
    o["top_developers"] = query(
        """SELECT actor_id, actor_login, actor_type, count(*) AS total_events,
  count(DISTINCT repo_id) AS repositories_contributed_to, count(DISTINCT event_type) AS event_types,
  min(created_at) AS first_event, max(created_at) AS last_event
FROM ev GROUP BY actor_id, actor_login, actor_type
ORDER BY total_events DESC, actor_id, actor_login, actor_type NULLS LAST LIMIT 50"""
    )
    span = "created_at >= DATE '2024-01-08' AND created_at < DATE '2024-01-22'"
    o["top_repositories_over"] = query(
        f"""SELECT repo_id, repo_name, count(*) AS total_events, count(DISTINCT actor_id) AS unique_contributors,
  count(DISTINCT event_type) AS event_type_count, min(created_at) AS first_event, max(created_at) AS last_event,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_type_list
FROM ev WHERE {span} GROUP BY repo_id, repo_name ORDER BY total_events DESC, repo_id, repo_name LIMIT 50"""
    )
    o["top_developers_over"] = query(
        f"""SELECT actor_id, actor_login, actor_type, count(*) AS total_events,
  count(DISTINCT repo_id) AS repositories_contributed_to, count(DISTINCT event_type) AS event_types,
  min(created_at) AS first_event, max(created_at) AS last_event
FROM ev WHERE {span} GROUP BY actor_id, actor_login, actor_type
ORDER BY total_events DESC, actor_id, actor_login, actor_type NULLS LAST LIMIT 50"""
    )
    o["event_rate_from_sketches"] = query(
        f"""SELECT min(c) AS min_per_minute, max(c) AS max_per_minute, {rnd('avg(c)', 2)} AS avg_per_minute, TRUE AS near_quantiles
FROM (SELECT count(*) AS c FROM ev WHERE {span} GROUP BY date_trunc('minute', created_at))"""
    )
    o["daily_activity"] = query(
        f"""SELECT CAST(created_at AS DATE) AS activity_date, count(*) AS daily_events,
  count(DISTINCT actor_id) AS unique_developers, count(DISTINCT repo_id) AS unique_repositories,
  count(DISTINCT event_type) AS event_types, min(created_at) AS earliest_event, max(created_at) AS latest_event,
  {rnd('count(*) / 24.0', 0)} AS avg_events_per_hour FROM ev GROUP BY CAST(created_at AS DATE)"""
    )
    o["hourly_pattern"] = query(
        f"""SELECT {big('hour(created_at)')} AS utc_hour, count(*) AS total_events, {rnd('count(*) / 30.0', 0)} AS avg_per_day,
  count(DISTINCT actor_id) AS total_actors, count(DISTINCT repo_id) AS total_repos FROM ev GROUP BY hour(created_at)"""
    )
    o["language_distribution"] = query(
        """SELECT language, count(*) AS event_count, count(DISTINCT repo_id) AS repo_count FROM ev
WHERE language IS NOT NULL GROUP BY language ORDER BY event_count DESC, language LIMIT 30"""
    )
    o["event_rate_per_minute"] = query(
        f"""SELECT min(c) AS min_per_minute, CAST(quantile_cont(c, 0.25) AS DOUBLE) AS p25_per_minute,
  CAST(quantile_cont(c, 0.5) AS DOUBLE) AS median_per_minute, CAST(quantile_cont(c, 0.75) AS DOUBLE) AS p75_per_minute,
  max(c) AS max_per_minute, {rnd('avg(c)', 2)} AS avg_per_minute
FROM (SELECT count(*) AS c FROM ev GROUP BY date_trunc('minute', created_at))"""
    )
    o["quality_report_rows"] = query(_report_lines(), GAPPY, LH)
    o["duplicate_events"] = query(
        "SELECT event_id, count(*) AS occurrence_count FROM dup GROUP BY event_id HAVING count(*) > 1", DUP
    )
    o["future_events"] = query(
        """SELECT event_type, count(*) AS future_count, max(created_at) AS latest_event FROM ev
WHERE created_at > TIMESTAMP '2024-01-30 12:00:00' GROUP BY event_type"""
    )
    joined = "fa LEFT JOIN da USING (actor_key) LEFT JOIN dr USING (repo_key) LEFT JOIN dt USING (event_type_key)"
    o["star_join_rollup"] = query(
        f"""SELECT fa.event_date, dt.event_type, dt.event_category, da.actor_login, da.is_bot, dr.repo_name,
  count(*) AS event_count FROM {joined} GROUP BY ALL
ORDER BY event_count DESC, 1, 2, 3, 4, 5, 6 LIMIT 10""",
        *STAR,
    )
    at_event = """fv AS (
  SELECT f.*, coalesce(v.actor_login, e.actor_login) AS login_then, coalesce(v.is_bot, e.is_bot) AS bot_then
  FROM fa f ASOF LEFT JOIN {versions} v ON v.actor_id = f.actor_id AND f.created_at >= v.valid_from
  LEFT JOIN (SELECT * FROM {versions} QUALIFY row_number() OVER (PARTITION BY actor_id ORDER BY valid_from) = 1) e
    ON e.actor_id = f.actor_id)"""
    over_scd = (*STAR, *(c for c in SCD if c not in STAR), at_event.format(versions="scd"))
    o["star_join_rollup_at_event"] = query(
        """SELECT event_date, dt.event_type, dt.event_category, login_then AS actor_login, bot_then AS is_bot, dr.repo_name,
  count(*) AS event_count FROM fv LEFT JOIN dr USING (repo_key) LEFT JOIN dt USING (event_type_key) GROUP BY ALL
ORDER BY event_count DESC, 1, 2, 3, 4, 5, 6 LIMIT 10""",
        *over_scd,
    )
    o["developer_daily_at_event"] = query(
        """SELECT event_date, login_then AS actor_login, count(*) AS events, count(DISTINCT repo_key) AS repos_touched
FROM fv GROUP BY event_date, login_then""",
        *over_scd,
    )
    o["bot_share_at_event"] = query(
        f"""SELECT bot_then AS is_bot, count(*) AS event_count, count(DISTINCT actor_key) AS actor_count,
  {pct('count(*)', '(SELECT count(*) FROM fa)')} AS percent_of_events FROM fv GROUP BY bot_then""",
        *STAR,
        "hist AS (SELECT *, actor_type = 'Bot' AS is_bot FROM (" + HISTORY + "))",
        at_event.format(versions="hist"),
    )
    o["mart_top_repositories"] = query(
        f"""SELECT dr.repo_name, count(*) AS event_count, count(DISTINCT fa.actor_key) AS unique_contributors,
  count(DISTINCT dt.event_type) AS event_types FROM {joined} GROUP BY dr.repo_name
ORDER BY event_count DESC, dr.repo_name NULLS LAST LIMIT 20""",
        *STAR,
    )
    o["developer_daily"] = query(
        f"""SELECT fa.event_date, da.actor_login, count(*) AS events, count(DISTINCT fa.repo_key) AS repos_touched
FROM {joined} GROUP BY fa.event_date, da.actor_login""",
        *STAR,
    )
    o["category_distribution"] = query(
        f"""SELECT dt.event_category, dt.event_type, count(*) AS event_count,
  {pct('count(*)', '(SELECT count(*) FROM fa)')} AS percent_of_events FROM {joined}
GROUP BY dt.event_category, dt.event_type""",
        *STAR,
    )
    cells = ", ".join(f"count(*) FILTER (WHERE event_hour = {h}) AS h{h:02d}" for h in range(24))
    o["activity_heatmap"] = query(f"SELECT event_date, {cells} FROM fa GROUP BY event_date", FA)
    o["new_developers"] = query(
        """SELECT actor_id, actor_login, actor_type, first_seen_at FROM sa
WHERE first_seen_at >= TIMESTAMP '2024-01-02' AND first_seen_at < TIMESTAMP '2024-01-03'""",
        SA,
    )
    trend = ["PushEvent", "PullRequestEvent", "IssuesEvent"]
    o["type_trend"] = query(
        "SELECT CAST(created_at AS DATE) AS event_date, "
        + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS \"{t}\"" for t in trend)
        + " FROM ev WHERE event_type IN ('PushEvent', 'PullRequestEvent', 'IssuesEvent') GROUP BY 1"
    )
    o["bot_share"] = query(
        f"""SELECT da.is_bot, count(*) AS event_count, count(DISTINCT fa.actor_key) AS actor_count,
  {pct('count(*)', '(SELECT count(*) FROM fa)')} AS percent_of_events
FROM fa LEFT JOIN da USING (actor_key) GROUP BY da.is_bot""",
        *STAR,
    )
    recent = """(SELECT '{kind}' AS entity_kind, {col} AS entity_id, min(created_at) AS first_event_at,
  max(created_at) AS last_event_at, count(*) AS event_count FROM ev GROUP BY {col}
  HAVING min(created_at) >= TIMESTAMP '2024-01-02' AND min(created_at) < TIMESTAMP '2024-01-03'
  ORDER BY event_count DESC, entity_id LIMIT 20)"""
    o["recently_active"] = query(
        "SELECT * FROM "
        + recent.format(kind="repository", col="repo_id")
        + " UNION ALL SELECT * FROM "
        + recent.format(kind="actor", col="actor_id")
    )
    o["activity_trend"] = query(
        "\nUNION ALL ".join(
            f"SELECT CAST(date_trunc('{g}', created_at) AS TIMESTAMP) AS period_start, count(*) AS event_count, "
            f"'{g}' AS grain FROM ev GROUP BY 1"
            for g in ("hour", "day", "week", "month")
        )
    )
    o["model_row_counts"] = query(_counts(_MODELS), LH, *STAR)

    # load monitoring
    o["loads_by_hour"] = query(
        f"""SELECT date_trunc('hour', file_hour) AS load_hour, count(*) AS files_loaded, {big('sum(row_count)')} AS total_rows
FROM lh WHERE status = 'SUCCESS' GROUP BY 1""",
        LH,
    )
    o["load_status_distribution"] = query(
        f"""SELECT status, count(*) AS file_count, {big('sum(row_count)')} AS total_rows,
  {pct('count(*)', '(SELECT count(*) FROM lh)')} AS percentage FROM lh GROUP BY status""",
        LH,
    )
    o["load_duration_by_status"] = query(
        f"""SELECT status, count(*) AS attempt_count, {rnd('avg(load_duration_seconds)', 2)} AS avg_duration_seconds,
  min(load_duration_seconds) AS min_duration_seconds, max(load_duration_seconds) AS max_duration_seconds
FROM lh WHERE load_duration_seconds IS NOT NULL GROUP BY status""",
        LH,
    )
    o["load_duration_quantiles"] = query(
        f"""SELECT status, count(*) AS attempt_count, {rnd('avg(load_duration_seconds)', 2)} AS avg_duration_seconds,
  min(load_duration_seconds) AS min_duration_seconds, max(load_duration_seconds) AS max_duration_seconds, TRUE AS near_quantiles
FROM lh WHERE load_duration_seconds IS NOT NULL GROUP BY status""",
        LH,
    )
    failure_columns = "file_name, file_hour, status, error_message, retry_count, load_ts"
    o["retry_candidates"] = query(
        f"""SELECT {failure_columns} FROM la WHERE status IN ('FAILED', 'RETRY')
AND load_ts >= {AS_OF} - INTERVAL 7 DAY""",
        LH,
        LATEST,
    )
    o["load_freshness"] = query(
        f"""SELECT max(file_hour) AS latest_loaded_hour, max(load_ts) AS load_timestamp,
  date_diff('hour', max(file_hour), {AS_OF}) AS hours_behind,
  date_diff('minute', max(file_hour), {AS_OF}) AS minutes_behind FROM lh WHERE status = 'SUCCESS'""",
        LH,
    )
    o["missing_hours"] = query(
        f"""SELECT expected_hour, CASE WHEN la.file_name IS NULL THEN 'MISSING' ELSE 'FAILED' END AS status,
  la.file_name, la.row_count
FROM ({hour_list('(SELECT min(file_hour) FROM lh)', AS_OF)}) LEFT JOIN la ON la.file_hour = expected_hour
WHERE expected_hour >= {AS_OF} - INTERVAL 30 DAY AND (la.file_name IS NULL OR la.status <> 'SUCCESS')""",
        LH,
        LATEST,
    )
    o["unloaded_hours"] = query(
        f"""SELECT expected_hour AS hour_value, {FILE_OF_HOUR} AS expected_file_name
FROM ({hour_list(AS_OF + ' - INTERVAL 744 HOUR', AS_OF)})
WHERE expected_hour NOT IN (SELECT file_hour FROM lh)""",
        LH,
    )
    stats = """(SELECT avg(row_count) AS m, stddev_samp(row_count) AS s FROM lh WHERE status = 'SUCCESS' AND row_count > 0)"""
    flags = f"""SELECT file_name, file_hour, row_count, {rnd('m', 0)} AS expected_avg,
  CASE WHEN row_count < m - 2 * s THEN 'LOW' WHEN row_count > m + 2 * s THEN 'HIGH' ELSE 'NORMAL' END AS anomaly
FROM lh, {stats} WHERE status = 'SUCCESS'"""
    o["row_count_anomalies"] = query(f"{flags} AND row_count > 0 AND abs(row_count - m) > 2 * s", LH)
    o["row_count_flags"] = query(flags, LH)
    o["last_loaded_files"] = query(
        """SELECT file_name, file_hour, row_count, load_duration_seconds, load_ts FROM lh
WHERE status = 'SUCCESS' ORDER BY file_hour DESC LIMIT 24""",
        LH,
    )
    o["recent_loads"] = query(
        f"""SELECT file_name, file_hour, row_count, status, load_duration_seconds, load_ts FROM lh
WHERE load_ts >= {AS_OF} - INTERVAL 7 DAY""",
        LH,
    )
    o["load_failures"] = query(
        f"""SELECT {failure_columns} FROM lh WHERE status = 'FAILED' OR status = 'RETRY'
ORDER BY load_ts DESC, file_name LIMIT 20""",
        LH,
    )
    o["load_daily_summary"] = query(
        f"""SELECT CAST(date_trunc('day', file_hour) AS TIMESTAMP) AS load_date, count(*) AS files_loaded,
  count(*) FILTER (WHERE status = 'SUCCESS') AS success_count,
  count(*) FILTER (WHERE status IN ('FAILED', 'RETRY')) AS failed_count, {big('sum(row_count)')} AS total_rows_loaded,
  avg(load_duration_seconds) AS avg_load_time_seconds, max(load_ts) AS last_load_time FROM lh GROUP BY 1""",
        LH,
    )
    o["file_load_stats"] = query(
        f"""SELECT CAST(date_trunc('day', file_hour) AS TIMESTAMP) AS load_date, count(*) AS files_loaded,
  {big('sum(row_count)')} AS total_events, avg(row_count) AS avg_events_per_file, min(row_count) AS min_events,
  max(row_count) AS max_events, {rnd('avg(load_duration_seconds)', 2)} AS avg_load_time
FROM lh WHERE status = 'SUCCESS' GROUP BY 1""",
        LH,
    )
    o["load_performance"] = query(
        f"""SELECT CAST(load_ts AS DATE) AS load_date, count(*) AS files_loaded, {big('sum(row_count)')} AS total_events,
  avg(load_duration_seconds) AS avg_load_time_seconds, max(load_duration_seconds) AS max_load_time_seconds,
  min(load_duration_seconds) AS min_load_time_seconds, count(*) FILTER (WHERE status = 'FAILED') AS failed_loads
FROM lh WHERE load_ts >= TIMESTAMP '2024-01-24' GROUP BY 1""",
        LH,
    )
    o["load_volume"] = query(
        f"""SELECT {big('sum(row_count)')} AS total_events, count(*) AS files_loaded, max(load_ts) AS last_load_time
FROM lh WHERE status = 'SUCCESS'""",
        LH,
    )
    o["load_success_rate"] = query(
        f"""SELECT load_date, {pct('good', 'files')} AS success_percent, rows_loaded,
  {big('sum(rows_loaded) OVER (ORDER BY load_date)')} AS cumulative_rows
FROM (
  SELECT CAST(file_hour AS DATE) AS load_date, count(*) AS files, count(*) FILTER (WHERE status = 'SUCCESS') AS good,
    {big("coalesce(sum(row_count) FILTER (WHERE status = 'SUCCESS'), 0)")} AS rows_loaded FROM lh GROUP BY 1)""",
        LH,
    )

    # data quality
    o["freshness_status"] = query(
        _freshness("hours", tier("hour", [("FRESH", 1), ("OK", 2), ("WARN", 4)]))
        + "\nUNION ALL "
        + _freshness("minutes", tier("minute", [("FRESH", 60), ("WARN", 120)]))
    )
    o["source_freshness"] = query(
        _source_freshness("raw_events", "ev", "loaded_at")
        + "\nUNION ALL "
        + _source_freshness("load_history", "lh", "load_ts"),
        LH,
    )
    o["staging_freshness"] = query(
        f"""SELECT latest_event, date_diff('hour', latest_event, {AS_OF}) AS hours_behind
FROM (SELECT max(created_at) AS latest_event FROM ev) WHERE date_diff('hour', latest_event, {AS_OF}) > 2"""
    )
    o["event_trend_7d"] = query(
        """SELECT CAST(created_at AS DATE) AS event_date, count(*) AS daily_events,
  count(DISTINCT actor_id) AS unique_actors, count(DISTINCT repo_id) AS unique_repos
FROM ev WHERE created_at >= TIMESTAMP '2024-01-24' GROUP BY 1"""
    )
    o["fact_integrity"] = query(
        """SELECT count(*) AS total_facts, count(*) - count(event_id) AS missing_event_ids,
  count(*) - count(actor_key) AS missing_actor_keys, count(*) - count(repo_key) AS missing_repo_keys,
  count(*) - count(event_type_key) AS missing_event_type_keys, count(DISTINCT event_id) AS distinct_events,
  CASE WHEN count(DISTINCT event_id) = count(*) THEN 'VALID' ELSE 'DUPLICATES' END AS grain_status FROM fd""",
        DUP,
        fact("dup", "fd"),
    )
    today = "TIMESTAMP '2024-01-30'"
    completeness = [
        ("Dimensions", "dim_actor", "scd", "is_current", "actor_id"),
        ("Dimensions", "dim_repository", "dr", "true", "repo_id"),
        ("Dimensions", "dim_event_type", "dt", "true", "event_type"),
        ("Facts", "fact_events", "fa", f"created_at >= {today}", "event_id"),
    ]
    o["dimension_completeness"] = query(
        "\nUNION ALL ".join(
            f"""SELECT '{kind}' AS check_type, '{name}' AS table_name, count(*) AS total_rows,
  count(*) FILTER (WHERE {cond}) AS current_rows, {pct(f'count(*) FILTER (WHERE {cond})', 'count(*)', 1)} AS pct_current,
  count(*) - count({col}) AS missing_ids FROM {cte}"""
            for kind, name, cte, cond, col in completeness
        ),
        *STAR,
        *SCD,
    )
    o["quality_summary"] = query(
        f"""SELECT *, {pct('passed_checks', 'total_checks', 1)} AS pass_rate FROM (
  SELECT 'Declared tests' AS assessment, count(*) AS total_checks, count(*) FILTER (WHERE status = 'pass') AS passed_checks FROM suite
  UNION ALL SELECT 'Fact grain', 1, CASE WHEN count(DISTINCT event_id) = count(*) THEN 1 ELSE 0 END FROM fact_events
  UNION ALL SELECT 'Dimension completeness', 3, (SELECT count(*) > 0 FROM dim_actor)::BIGINT
    + (SELECT count(*) > 0 FROM dim_repository)::BIGINT + (SELECT count(*) > 0 FROM dim_event_type)::BIGINT)""",
        *SUITE,
    )
    o["hourly_anomaly"] = query(
        f"""SELECT event_hour, event_count, {rnd('m', 0)} AS avg_before,
  {rnd('event_count * CAST(100.0 AS DOUBLE) / m', 1)} AS pct_of_avg,
  CASE WHEN event_count < 0.8 * m THEN 'LOW' WHEN event_count > 1.2 * m THEN 'HIGH' ELSE 'NORMAL' END AS anomaly_flag
FROM (
  SELECT event_hour, event_count, avg(event_count) OVER (ORDER BY event_hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS m
  FROM (SELECT date_trunc('hour', created_at) AS event_hour, count(*) AS event_count FROM fa
        WHERE created_at >= TIMESTAMP '2024-01-23 20:00:00' GROUP BY 1))
WHERE event_hour >= TIMESTAMP '2024-01-29 20:00:00'""",
        FA,
    )
    o["daily_volume_anomaly"] = query(daily_flags("fa", "TIMESTAMP '2024-01-01'", 0.95, 1.05), FA)
    o["check_raw_freshness"] = query(CHECK_FRESH)
    o["check_duplicates"] = query(CHECK_DUP, DUP)
    o["check_missing_dimensions"] = query(
        "\nUNION ALL ".join(
            f"""SELECT '{name}' AS dimension, count(*) - count({keycol}) AS missing_keys,
  count(*) - count({natural}) AS missing_ids FROM fg"""
            for name, keycol, natural in (
                ("actor", "actor_key", "actor_id"),
                ("repo", "repo_key", "repo_id"),
                ("event_type", "event_type_key", "event_type"),
            )
        ),
        GAPPY,
        fact("gappy", "fg"),
    )
    o["check_load_failures"] = query(CHECK_LOADS, LH)
    o["dq_report"] = query(
        "\nUNION ALL ".join([CHECK_FRESH, CHECK_DUP, CHECK_DIMS, CHECK_VOLUME, CHECK_LOADS]),
        LH,
        DUP,
        fact("dup", "fd"),
    )
    checked = ["event_id", "event_type", "actor_id", "actor_login", "repo_id", "repo_name", "created_at"]
    o["test_not_null"] = query(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM gappy" for c in checked
        ),
        GAPPY,
    )
    o["test_unique"] = query(
        "SELECT event_id, count(*) AS row_count FROM dup GROUP BY event_id HAVING count(*) > 1", DUP
    )
    o["test_accepted_values"] = query(
        f"SELECT event_type, count(*) AS row_count FROM ev WHERE event_type NOT IN ({KNOWN}) GROUP BY event_type"
    )
    o["test_relationships"] = query(
        """SELECT fa.actor_key, count(*) AS row_count FROM fa LEFT JOIN db ON fa.actor_key = db.actor_key
WHERE db.actor_key IS NULL AND fa.actor_key IS NOT NULL GROUP BY fa.actor_key""",
        FA,
        actors("(SELECT * FROM ev WHERE loaded_at < TIMESTAMP '2024-01-02')", "sb"),
        dim_actor("sb", "db"),
    )
    o["test_scd2_single_current"] = query(
        "SELECT actor_id, count(*) AS current_count FROM scd GROUP BY actor_id HAVING count(*) > 1", SA, DA, *SCD
    )
    o["test_type_coverage"] = query(
        f"SELECT DISTINCT event_type FROM fa WHERE event_type NOT IN (SELECT event_type FROM dt WHERE event_type IN ({KNOWN}))",
        *STAR,
    )
    o["run_dq_suite"] = query("SELECT * FROM suite", *SUITE)
    runs = f"""SELECT count(*) AS n FROM (
    SELECT status, row_number() OVER (ORDER BY file_hour) - row_number() OVER (PARTITION BY status = 'FAILED' ORDER BY file_hour) AS island
    FROM (SELECT * FROM lh WHERE file_hour BETWEEN {AS_OF} - INTERVAL 7 DAY AND {AS_OF}
      QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY load_ts DESC) = 1)) WHERE status = 'FAILED' GROUP BY island"""
    metrics = [
        ("data_freshness_hours", f"SELECT date_diff('hour', max(loaded_at), {AS_OF}) FROM ev", 2, 4),
        ("consecutive_load_failures", f"SELECT coalesce(max(n), 0) FROM ({runs})", 1, 3),
        ("duplicate_events",
         "SELECT count(*) FROM (SELECT event_id FROM fact_events GROUP BY event_id HAVING count(*) > 1)", 1, 1),
        ("missing_dimension_percent",
         "SELECT " + pct("count(*) FILTER (WHERE actor_id IS NULL OR repo_id IS NULL OR event_type IS NULL)", "count(*)")
         + " FROM fact_events", 1, 5),
        ("test_failures", "SELECT count(*) FROM suite WHERE status <> 'pass'", 1, 1),
    ]
    o["grade_metrics"] = query(
        "SELECT *, CASE WHEN value >= error_at THEN 'ERROR' WHEN value >= warn_at THEN 'WARNING' ELSE 'OK' END AS grade FROM ("
        + "\nUNION ALL ".join(
            f"SELECT '{name}' AS metric, CAST(({sql}) AS DOUBLE) AS value, CAST({w} AS DOUBLE) AS warn_at, "
            f"CAST({e} AS DOUBLE) AS error_at"
            for name, sql, w, e in metrics
        )
        + ")",
        *SUITE,
    )
    o["min_rows_per_day"] = query(
        "SELECT CAST(created_at AS DATE) AS event_date, count(*) AS row_count FROM ev GROUP BY 1 HAVING count(*) < 330"
    )

    # streaming: the rows a finished stream must have written
    o["stream_ingest_files"] = o["load_once"]
    o["stream_dedup"] = query("SELECT event_id, event_type, created_at FROM ev")
    o["stream_hourly_counts"] = query(
        """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, event_count
FROM (SELECT date_trunc('hour', created_at) AS window_start, event_type, count(*) AS event_count FROM ev GROUP BY ALL)
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(created_at) FROM ev) - INTERVAL 2 HOUR"""
    )
    o["stream_hourly_anomaly"] = query(
        f"""SELECT series, event_hour, event_count, {rnd('m', 0)} AS avg_before,
  {rnd('event_count * CAST(100.0 AS DOUBLE) / m', 1)} AS pct_of_avg,
  CASE WHEN event_count < 0.8 * m THEN 'LOW' WHEN event_count > 1.2 * m THEN 'HIGH' ELSE 'NORMAL' END AS anomaly_flag
FROM (
  SELECT *, avg(event_count) OVER (PARTITION BY series ORDER BY event_hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS m
  FROM (SELECT event_type AS series, date_trunc('hour', created_at) AS event_hour, count(*) AS event_count FROM ev GROUP BY ALL))
WHERE event_hour + INTERVAL 1 HOUR <= (SELECT max(created_at) FROM ev) - INTERVAL 2 HOUR"""
    )
    o["stream_dedup_stored"] = o["stream_dedup"]
    o["stream_late_data"] = query(
        """SELECT event_id, created_at, loaded_at,
  CASE WHEN loaded_at > created_at + INTERVAL 2 HOUR THEN 'late' ELSE 'kept' END AS part FROM late""",
        LATE,
    )
    o["stream_upsert_marts"] = query(
        "SELECT event_id, event_key, event_date, actor_key, is_bot, loaded_at FROM fa LEFT JOIN da USING (actor_key)",
        SA,
        DA,
        FA,
    )

    # pipeline and scalars
    steps = [("ingest", "done", "ev"), ("staging", "done", "ev"), ("fact", "done", "ev"), ("dim_actor", "done", "hist"),
             ("dim_repository", "done", "sr"), ("dim_event_type", "done", "st")]
    o["run_pipeline"] = query(
        "\nUNION ALL ".join(
            f"SELECT {big(str(i + 1))} AS step_no, '{s}' AS step, '{status}' AS status, count(*) AS row_count FROM {cte}"
            for i, (s, status, cte) in enumerate(steps)
        )
        # the unknown event type fails accepted_values in staging and in the type dimension
        + f"""
UNION ALL SELECT {big('7')}, 'tests', CASE WHEN x = 0 THEN 'pass' ELSE 'warn' END, x FROM (
  SELECT 2 * count(DISTINCT event_type) AS x FROM ev WHERE event_type NOT IN ({KNOWN}))
UNION ALL SELECT {big('8')}, 'freshness', 'pass', {big('1')}""",
        # the actor dimension has a row per version, in event time
        "hist AS (" + HISTORY + ")",
        SR,
        ST,
    )
    o["scalar_semantics"] = query(
        f"""SELECT event_id, actor_id AS json_long, actor_type AS json_text, true AS json_null_present,
  false AS half_is_json,
  '{{"a":' || actor_id || CASE WHEN actor_type IS NULL THEN '' ELSE ',"t":"' || actor_type || '"' END || '}}' AS json_string,
  CAST(created_at AS DATE) AS event_date, {big('hour(created_at)')} AS event_hour,
  left(dayname(created_at), 3) AS event_day_of_week, {big('week(created_at)')} AS event_week,
  {big('month(created_at)')} AS event_month, {big('year(created_at)')} AS event_year,
  {', '.join(f"CAST(date_trunc('{u}', created_at) AS TIMESTAMP) AS trunc_{u}" for u in ('minute', 'hour', 'day', 'week', 'month'))},
  {', '.join(f"date_diff('{u}', created_at, {AS_OF}) AS diff_{u}" for u in ('minute', 'hour', 'day'))},
  created_at + INTERVAL 65 MINUTE AS plus_interval, {rnd('value / 8', 1)} AS rounded, abs(value - 50) AS distance,
  coalesce(actor_type, 'none') AS coalesced, actor_login ILIKE '%BOT]%' AS is_bracket_bot,
  split_part(repo_name, '/', 1) AS part_one, split_part(repo_name, '/', 3) AS part_missing,
  lpad(CAST(hour(created_at) AS VARCHAR), 2, '0') AS padded_hour, left(actor_login, 5) AS login_head,
  {key('event_id')} AS md5_key, source_file AS file_name FROM ev"""
    )
    return o
