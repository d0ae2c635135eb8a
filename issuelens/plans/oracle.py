"""The registered queries as DuckDB SQL over the driver's tables.

Each string first derives the canonical tables with the rules of
``plans/proxies.py`` (as CTEs), then states the query on its own terms, by
another route than the engine's plan where there is one: pivots as filtered
aggregates over a fixed status list, the synthetic "Created" step as a row of
its own under ``UNION ALL`` with ``LAG`` and ``MAX(step)``, the left join as
matches plus rows without a match.  Column names match the Spark results, and
every string can be made a view.
"""

from __future__ import annotations

from issuelens.plans import params as P
from issuelens.plans import proxies as X


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


KEY = f"{_q(X.PROJECT + '-')} || CAST({{}} AS VARCHAR)"

CTE = {}
CTE["jira_changelog"] = f"""jira_changelog AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         {KEY.format('user_id')} AS issue_key,
         ts AS created,
         'acct-' || CAST(user_id AS VARCHAR) AS author_account_id,
         'User ' || CAST(user_id AS VARCHAR) AS author_display_name,
         'status' AS field, 'jira' AS field_type,
         COALESCE(LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), {_q(X.FIRST_STATUS)}) AS from_value,
         COALESCE(LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), {_q(X.FIRST_STATUS)}) AS from_string,
         event_type AS to_value, event_type AS to_string
  FROM events)"""

CTE["jira_issues"] = f"""jira_issues AS (
  SELECT {KEY.format('c_custkey')} AS key,
         c_name AS summary,
         CASE WHEN c_acctbal < 0 THEN 'Blocked' WHEN c_acctbal < 5000 THEN 'In Progress' ELSE 'Done' END AS current_status,
         c_mktsegment AS issue_type,
         CASE WHEN c_acctbal >= 0 THEN 'Nation ' || CAST(c_nationkey AS VARCHAR) END AS assignee,
         TIMESTAMP '{X.ISSUE_EPOCH}' + to_minutes(c_custkey) AS created,
         TIMESTAMP '{X.ISSUE_EPOCH}' + to_minutes(c_custkey) + to_days(c_nationkey) AS updated
  FROM customer)"""

CTE["pull_requests"] = f"""pull_requests AS (
  SELECT o_orderkey AS id, CAST(o_orderkey AS INTEGER) AS number,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
              WHEN o_orderpriority = '1-URGENT' THEN {KEY.format('o_custkey')} || ': urgent fix'
              WHEN o_orderpriority = '2-HIGH' THEN {KEY.format('o_custkey')} || ' and ' || {KEY.format('o_orderkey')} || ': high'
              WHEN o_orderpriority = '3-MEDIUM' THEN {_q(X.PROJECT.lower() + '-')} || CAST(o_custkey AS VARCHAR) || ' medium change'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {KEY.format('o_custkey + 100000')} || ' unspecified'
              ELSE 'chore: low priority' END AS title,
         'user' || CAST(o_custkey AS VARCHAR) AS user_login,
         CASE WHEN o_orderstatus <> 'O' THEN 'closed' ELSE 'open' END AS state,
         o_orderdate AS created_at,
         o_orderdate + to_minutes(o_custkey) AS updated_at,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_minutes(o_custkey) END AS closed_at,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_minutes(o_custkey) END AS merged_at,
         'pull/' || CAST(o_orderkey AS VARCHAR) AS html_url
  FROM orders)"""

_COMMIT_ORDER = ", ".join(X.COMMIT_ORDER)

CTE["commits_landed"] = f"""commits_landed AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sha,
         l_orderkey AS pull_request_id, CAST(l_orderkey AS INTEGER) AS pull_request_number,
         'dev' || CAST(l_suppkey AS VARCHAR) AS author_name,
         'dev' || CAST(l_suppkey AS VARCHAR) || '@example.org' AS author_email,
         l_shipdate AS author_date,
         'dev' || CAST(l_partkey AS VARCHAR) AS committer_name,
         'dev' || CAST(l_partkey AS VARCHAR) || '@example.org' AS committer_email,
         l_shipdate AS commit_date,
         'change ' || l_returnflag || l_linestatus || ' qty ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS message,
         'commit/' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS html_url,
         {_COMMIT_ORDER}
  FROM lineitem)"""

_COMMIT_COLS = ("sha, pull_request_id, pull_request_number, author_name, author_email, author_date, "
                "committer_name, committer_email, commit_date, message, html_url")


def _dedupe_commits(name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT {_COMMIT_COLS} FROM commits_landed WHERE {where}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY sha, pull_request_id ORDER BY {_COMMIT_ORDER}) = 1)"""


CTE["pull_request_commits"] = _dedupe_commits("pull_request_commits")


def _lookup_values() -> str:
    rows = ", ".join(f"({_q(s)}, {_q(t)}, {_q(c)}, {_q(k)})" for s, t, c, k in X.status_lookup_rows())
    return f"status_lookup AS (SELECT * FROM (VALUES {rows}) AS v(source, target, classification, type))"


CTE["status_lookup"] = _lookup_values()

DEPENDS = {"pull_request_commits": ["commits_landed"]}


def with_tables(names: list[str], body: str, extra: list[str] | None = None) -> str:
    order: list[str] = []
    for n in names:
        for d in DEPENDS.get(n, []):
            if d not in order:
                order.append(d)
        if n not in order:
            order.append(n)
    parts = [CTE[n] for n in order] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n" + body


STEP_WINDOW = "PARTITION BY issue_key ORDER BY created, TRY_CAST(id AS BIGINT), id"

# Q2: every loaded issue's history is its creation (step 0) followed by its
# status changes (steps 1, 2, …); a row's previous time is that of the row
# before it, and the chain length is one more than the issue's last step.
_Q2_CTES = [
    f"""changes AS (
      SELECT issue_key, from_string AS source, to_string AS target, created AS at,
             ROW_NUMBER() OVER ({STEP_WINDOW}) AS step
      FROM jira_changelog WHERE field = 'status')""",
    """history AS (
      SELECT c.issue_key, 0 AS step, 'Created' AS source, c.source AS target, i.created AS at
      FROM changes c JOIN jira_issues i ON i.key = c.issue_key WHERE c.step = 1
      UNION ALL
      SELECT c.issue_key, c.step, c.source, c.target, c.at
      FROM changes c WHERE c.issue_key IN (SELECT key FROM jira_issues))""",
    """with_created AS (
      SELECT h.issue_key, h.step, h.source, h.target,
             LAG(h.at) OVER (PARTITION BY h.issue_key ORDER BY h.step) AS previous_timestamp,
             h.at AS transition_timestamp,
             MAX(h.step) OVER (PARTITION BY h.issue_key) + 1 AS chain_length,
             i.issue_type, i.current_status
      FROM history h JOIN jira_issues i ON i.key = h.issue_key)""",
]


def _q2_select(where: str) -> str:
    return f"""SELECT t.issue_key, t.step, t.source, t.target, t.previous_timestamp, t.transition_timestamp,
       CAST(epoch_us(t.transition_timestamp) - epoch_us(t.previous_timestamp) AS DOUBLE) / 1000000 AS duration_seconds,
       t.chain_length, t.issue_type, t.current_status, lk.classification, lk.type
FROM with_created t
JOIN status_lookup lk ON t.source = lk.source AND t.target = lk.target
WHERE {where}"""


_Q2_TABLES = ["jira_changelog", "jira_issues", "status_lookup"]
_Q3_CTES = _Q2_CTES + [
    f"tr AS ({_q2_select('t.step > 0')})",
    """col AS (SELECT issue_key, step, source, target,
              LAG(target) OVER (PARTITION BY issue_key ORDER BY step) AS pt,
              ROW_NUMBER() OVER (PARTITION BY issue_key ORDER BY step) AS rn FROM tr)""",
    "kept AS (SELECT issue_key, step, source, target FROM col WHERE rn = 1 OR pt IS DISTINCT FROM target)",
]

_STATUS_ROWS = "h AS (SELECT issue_key, to_string AS status, created FROM jira_changelog WHERE field = 'status')"


def _parsed_commit_text() -> str:
    fmt_ok = "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')"
    fmt_bad = "strftime(l_shipdate, '%d/%m/%Y')"
    return (f"CASE WHEN l_returnflag = {_q(P.BAD_DATE_FLAG[0])} AND l_linestatus = {_q(P.BAD_DATE_FLAG[1])} "
            f"THEN {fmt_bad} ELSE {fmt_ok} END")


def _upsert_body(kind: str) -> str:
    t_where = f"l_shipdate < TIMESTAMP '{P.UPSERT_TARGET_BEFORE}'"
    s_where = f"l_shipdate >= TIMESTAMP '{P.UPSERT_SOURCE_FROM}'"
    extra = [_dedupe_commits("t", t_where), _dedupe_commits("s", s_where)]
    cols = [c.strip() for c in _COMMIT_COLS.split(",")]
    keys = ["sha", "pull_request_id"]
    if kind == "nothing":
        body = ("SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS "
                "(SELECT 1 FROM t WHERE t.sha = s.sha AND t.pull_request_id = s.pull_request_id)")
    else:
        keep = set(P.UPSERT_KEEP) if kind == "keep" else set()
        sel = []
        for c in cols:
            if c in keys:
                sel.append(f"COALESCE(s.{c}, t.{c}) AS {c}")
            elif c in keep:
                sel.append(f"CASE WHEN t.sha IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}")
            else:
                sel.append(f"CASE WHEN s.sha IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
        body = (f"SELECT {', '.join(sel)} FROM t FULL OUTER JOIN s "
                "ON t.sha = s.sha AND t.pull_request_id = s.pull_request_id")
    return with_tables(["commits_landed"], body, extra)


def _links_body() -> str:
    k = "CAST({} AS VARCHAR)"
    key = lambda e: f"{_q(X.PROJECT + '-')} || {k.format(e)}"
    edges = f"""e AS (
  SELECT {key('c_custkey')} AS s, {key('c_custkey + 1')} AS t, 'Blocks' AS link_type FROM cl
  UNION ALL SELECT {key('c_custkey + 2')}, {key('c_custkey')}, 'Relates' FROM cl WHERE c_nationkey % 2 = 0
  UNION ALL SELECT {key('c_custkey')}, {key('c_custkey + 3')}, '' FROM cl WHERE c_nationkey % 3 = 0
  UNION ALL SELECT {key('c_custkey + 4')}, {key('c_custkey')}, '' FROM cl WHERE c_nationkey % 3 = 0
  UNION ALL SELECT {key('c_custkey - 1')}, {key('c_custkey')}, 'Blocks' FROM cl WHERE c_custkey % 2 = 1)"""
    return (f"WITH cl AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal <= 9000),\n{edges}\n"
            f"SELECT DISTINCT s AS source_issue_key, t AS target_issue_key, link_type, "
            f"TIMESTAMP '{X.LOAD_TIME}' AS created_at FROM e")


def _flatten_body() -> str:
    n = "CAST(id AS BIGINT)"
    items = f"""items AS (
  SELECT id, issue_key, created, {n} AS n, author_account_id, author_display_name,
         'status' AS field, 'jira' AS field_type, from_value, from_string, to_value, to_string
  FROM jira_changelog WHERE {n} % {P.NO_ITEMS_EVERY} <> 0
  UNION ALL
  SELECT id, issue_key, created, {n}, author_account_id, author_display_name,
         'priority', 'jira', NULL, NULL, CAST({n} % 5 AS VARCHAR), 'P' || CAST({n} % 5 AS VARCHAR)
  FROM jira_changelog WHERE {n} % {P.NO_ITEMS_EVERY} <> 0 AND to_string = 'purchase')"""
    body = f"""SELECT id, issue_key, date_trunc('millisecond', created) AS created,
       CASE WHEN n % {P.NO_AUTHOR_EVERY} = 0 THEN '' ELSE author_account_id END AS author_account_id,
       CASE WHEN n % {P.NO_AUTHOR_EVERY} = 0 THEN '' ELSE author_display_name END AS author_display_name,
       field, field_type, from_value, from_string, to_value, to_string
FROM items"""
    return with_tables(["jira_changelog"], body, [items])


def _incremental_body() -> str:
    run = (f"CASE WHEN ts < TIMESTAMP '{P.RUN_SPLITS[0]}' THEN 1 "
           f"WHEN ts < TIMESTAMP '{P.RUN_SPLITS[1]}' THEN 2 ELSE 3 END")
    return f"""WITH b AS (SELECT *, {run} AS run FROM events),
r AS (SELECT *, MIN(run) OVER (PARTITION BY user_id) AS first_run,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM b)
SELECT {KEY.format('user_id')} AS issue_key, event_id AS last_event_id, event_type AS status, value,
       ts AS updated_at,
       TIMESTAMP '{X.LOAD_TIME}' + to_days(CAST(first_run AS INTEGER)) AS created_at,
       TIMESTAMP '{X.LOAD_TIME}' + to_days(CAST(run AS INTEGER)) AS loaded_at
FROM r WHERE rn = 1"""


# The proxy changelog's statuses are the event types (the engine finds them itself).
STATUSES = ("click", "error", "purchase", "signup", "view")


def _pivot_body(attrs: str, parts: list[tuple[str, str]], where: str = "TRUE") -> str:
    """Issue attributes and one filtered aggregate per (function, name suffix) and status."""
    cells = ", ".join(f'{fn}(h.created) FILTER (WHERE h.status = {_q(v)}) AS "{v}{suffix}"'
                      for v in STATUSES for fn, suffix in parts)
    return f"""SELECT {attrs}, {cells}
FROM jira_issues i JOIN h ON h.issue_key = i.key
WHERE {where} GROUP BY {attrs}"""


def oracle_sql() -> dict[str, str]:
    W = with_tables
    q: dict[str, str] = {}
    attrs = "i.key, i.summary, i.current_status, i.issue_type, i.assignee"
    q["status_timeline"] = W(["jira_changelog", "jira_issues"], _pivot_body(
        attrs, [("MIN", "_min"), ("MAX", "_max")]), [_STATUS_ROWS])
    q["status_values"] = W(["jira_changelog"],
                           "SELECT DISTINCT to_string AS status FROM jira_changelog WHERE field = 'status'")
    q["status_first_seen"] = W(["jira_changelog", "jira_issues"], _pivot_body(attrs, [("MIN", "")]), [_STATUS_ROWS])
    q["status_last_seen"] = W(["jira_changelog", "jira_issues"], _pivot_body("i.key", [("MAX", "")]), [_STATUS_ROWS])
    q["single_issue_status"] = W(["jira_changelog", "jira_issues"], _pivot_body(
        "i.key", [("MIN", "")], f"i.key = {_q(P.SINGLE_ISSUE)}"), [_STATUS_ROWS])
    q["status_steps"] = W(["jira_changelog"], f"""SELECT issue_key, id, created, from_string, to_string,
       ROW_NUMBER() OVER ({STEP_WINDOW}) AS step, LAG(created) OVER ({STEP_WINDOW}) AS prev_created
FROM jira_changelog WHERE field = 'status'""")
    q["status_transitions"] = W(_Q2_TABLES, _q2_select("t.step > 0"), _Q2_CTES)
    q["status_transitions_with_created"] = W(_Q2_TABLES, _q2_select("t.step >= 0"), _Q2_CTES)
    q["collapsed_transitions"] = W(_Q2_TABLES, "SELECT * FROM kept", _Q3_CTES)
    q["status_chains"] = W(_Q2_TABLES, """SELECT tr.*, labels.chain, ids.chain_id
FROM tr JOIN labels ON tr.issue_key = labels.issue_key JOIN ids ON labels.chain = ids.chain""", _Q3_CTES + [
        """labels AS (SELECT issue_key, arg_min(source, step) || ' > ' || string_agg(target, ' > ' ORDER BY step) AS chain
                 FROM kept GROUP BY issue_key)""",
        "ids AS (SELECT chain, ROW_NUMBER() OVER (ORDER BY MIN(issue_key)) AS chain_id FROM labels GROUP BY chain)"])
    q["issue_attributes"] = W(["jira_issues"], "SELECT key, summary, current_status, issue_type, assignee, created, updated FROM jira_issues")
    q["json_scalars"] = "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"
    q["pull_requests_with_commits"] = W(["pull_requests", "pull_request_commits"], """SELECT pr.id, pr.number, pr.state, pr.merged_at, c.sha, c.commit_date, c.message
FROM pull_requests pr LEFT JOIN pull_request_commits c ON c.pull_request_id = pr.id""")
    q["merged_pr_issue_keys"] = W(["pull_requests", "pull_request_commits"], """SELECT t.*, c.sha, c.commit_date, c.message, t2.jira_key
FROM named t2 JOIN cols t USING (number) JOIN pull_request_commits c ON c.pull_request_id = t2.id
UNION ALL
SELECT t.*, NULL, NULL, NULL, t2.jira_key FROM named t2 JOIN cols t USING (number)
WHERE NOT EXISTS (SELECT 1 FROM pull_request_commits c WHERE c.pull_request_id = t2.id)""", [
        f"""named AS (
  SELECT id, number, list_filter(regexp_extract_all(title, '(?i){X.PROJECT}-[0-9]{{1,5}}'), lambda k: k <> '')[1] AS jira_key
  FROM pull_requests
  WHERE merged_at IS NOT NULL AND state = 'closed' AND regexp_matches(title, '(?i){X.PROJECT}-[0-9]'))""",
        "cols AS (SELECT number, title, state, created_at, merged_at FROM pull_requests)"])
    q["commits_of_pull_request"] = W(["pull_request_commits"], f"""SELECT * EXCLUDE (pull_request_id, pull_request_number)
FROM pull_request_commits c
WHERE EXISTS (SELECT 1 FROM pull_request_commits m WHERE m.sha = c.sha AND m.pull_request_number = {int(P.PR_NUMBER)})
  AND NOT EXISTS (SELECT 1 FROM pull_request_commits e WHERE e.sha = c.sha AND e.pull_request_id < c.pull_request_id)""")
    q["recent_issues"] = W(["jira_issues"], f"""SELECT key, summary FROM jira_issues
WHERE updated >= TIMESTAMP '{P.RECENT_AS_OF}' - INTERVAL {int(P.RECENT_DAYS)} DAY""")
    q["issue_links"] = _links_body()
    q["upsert_update"] = _upsert_body("update")
    q["upsert_keep_columns"] = _upsert_body("keep")
    q["upsert_do_nothing"] = _upsert_body("nothing")
    q["high_watermark"] = W(["pull_requests"], """SELECT COALESCE(MAX(updated_at), TIMESTAMP '2000-01-01 00:00:00') AS high_watermark,
       strftime(COALESCE(MAX(updated_at), TIMESTAMP '2000-01-01 00:00:00'), '%Y-%m-%dT%H:%M:%SZ') AS high_watermark_iso
FROM pull_requests""")
    q["issue_watermark"] = W(["jira_issues"], """SELECT date_trunc('minute', MAX(updated)) AS watermark,
       strftime(MAX(updated), '%Y-%m-%d %H:%M') AS watermark_text FROM jira_issues""")
    q["newer_than"] = W(["pull_requests"], f"SELECT * FROM pull_requests WHERE updated_at > TIMESTAMP '{P.NEWER_THAN}'")
    q["since_minute"] = W(["jira_issues"], f"""SELECT key, updated FROM jira_issues
WHERE updated >= date_trunc('minute', TIMESTAMP '{P.SINCE}')""")
    q["key_duplicates"] = W(["commits_landed"], """SELECT sha, pull_request_id, COUNT(*) AS n FROM commits_landed
GROUP BY sha, pull_request_id HAVING COUNT(*) > 1""")
    q["orphan_commits"] = W(["pull_requests", "pull_request_commits"], f"""SELECT sha, parent AS pull_request_id FROM (
  SELECT sha, CASE WHEN ends_with(sha, '-{P.STRAY_LINE}') THEN -pull_request_id ELSE pull_request_id END AS parent
  FROM pull_request_commits) c
WHERE NOT EXISTS (SELECT 1 FROM pull_requests p WHERE p.id = c.parent)""")
    q["unparsable_dates"] = W(["commits_landed"], f"""SELECT sha, pull_request_id, author_date_text FROM (
  SELECT c.sha, c.pull_request_id, {_parsed_commit_text()} AS author_date_text
  FROM commits_landed c) x
WHERE author_date_text IS NOT NULL AND TRY_STRPTIME(author_date_text, '%Y-%m-%dT%H:%M:%SZ') IS NULL""")
    bad = "author_date_text IS NOT NULL AND TRY_STRPTIME(author_date_text, '%Y-%m-%dT%H:%M:%SZ') IS NULL"
    q["load_profiles"] = W(["commits_landed"], f"""SELECT COALESCE(load, 'all') AS load, CAST(SUM(n) AS BIGINT) AS n_rows,
       CAST(SUM(n) FILTER (WHERE sha IS NULL) AS BIGINT) AS n_null_keys, CAST(SUM(bad) AS BIGINT) AS n_unparsable,
       COUNT(sha) AS n_keys, COUNT(sha) FILTER (WHERE n > 1) AS n_repeated, TRUE AS sketch_near
FROM (SELECT load, sha, pull_request_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE {bad}) AS bad FROM (
  SELECT CAST(c.pull_request_id % 2 AS VARCHAR) AS load, c.pull_request_id,
         CASE WHEN NOT ends_with(c.sha, '-{P.STRAY_LINE}') THEN c.sha END AS sha, {_parsed_commit_text()} AS author_date_text
  FROM commits_landed c) x GROUP BY load, sha, pull_request_id) k
GROUP BY ROLLUP (load)""")
    q["normalized_commits"] = W(["commits_landed"], f"""SELECT sha, pull_request_id, pull_request_number, author_name, author_email,
       CASE WHEN l_returnflag = {_q(P.BAD_DATE_FLAG[0])} AND l_linestatus = {_q(P.BAD_DATE_FLAG[1])} THEN NULL ELSE author_date END AS author_date,
       committer_name, committer_email, commit_date, message, html_url
FROM commits_landed""")
    q["normalized_pull_requests"] = W(["pull_requests"], "SELECT * FROM pull_requests")
    q["pull_request_ingest"] = W(["pull_requests"], f"""SELECT id, number, title, user_login,
       CASE WHEN id % {P.RELANDED} = 0 THEN 'relanded' ELSE state END AS state, created_at,
       CASE WHEN id % {P.RELANDED} = 0 THEN updated_at + INTERVAL 1 DAY ELSE updated_at END AS updated_at,
       closed_at, merged_at, html_url FROM pull_requests""")
    q["issue_ingest"] = f"""WITH links AS ({_links_body()}),
n AS (SELECT source_issue_key AS key, COUNT(*) AS n FROM links GROUP BY source_issue_key),
{CTE["jira_issues"]}
SELECT i.key, i.summary, i.current_status, COALESCE(n.n, 0) AS n_links,
       TIMESTAMP '{X.LOAD_TIME}' + to_days(CASE WHEN k % {P.RELANDED} = 0 THEN 1 ELSE 0 END) AS created_at,
       TIMESTAMP '{X.LOAD_TIME}' + to_days(CASE WHEN k % {P.RELANDED} <= 1 THEN 1 ELSE 0 END) AS updated_at
FROM (SELECT *, CAST(split_part(key, '-', 2) AS BIGINT) AS k FROM jira_issues) i LEFT JOIN n ON n.key = i.key"""
    q["timeline_csv"] = W(["jira_changelog", "jira_issues"], """SELECT i.key, i.current_status,
       MIN(h.created) FILTER (WHERE h.status = 'view') AS view_min,
       MAX(h.created) FILTER (WHERE h.status = 'view') AS view_max
FROM jira_issues i JOIN h ON h.issue_key = i.key GROUP BY i.key, i.current_status""", [_STATUS_ROWS])
    q["transitions_csv_lookup"] = q["status_transitions"]
    q["lookup_gaps"] = W(["jira_changelog", "status_lookup"], """SELECT from_string AS source, to_string AS target, COUNT(*) AS n
FROM jira_changelog c WHERE field = 'status' AND NOT EXISTS (
  SELECT 1 FROM status_lookup l WHERE l.source = c.from_string AND l.target = c.to_string)
GROUP BY from_string, to_string""")
    q["flatten_changelog"] = _flatten_body()
    q["incremental_upsert"] = _incremental_body()
    iso = lambda c: f"strftime({c}, '%Y-%m-%dT%H:%M:%SZ')"
    cut = f"page % {P.CUT_PAGES[0]} = {P.CUT_PAGES[1]}"
    q["landed_quarantine"] = W(["pull_requests"], f"""SELECT page,
       CASE WHEN {cut} AND page % {P.REPAIRED_PAGES[0]} <> {P.REPAIRED_PAGES[1]} THEN 0 ELSE n END AS n_loaded,
       CASE WHEN {cut} THEN 1 ELSE 0 END AS n_quarantined,
       CASE WHEN {cut} THEN md5(substr(text, 1, CAST(length(text) * {P.CUT_PERCENT} // 100 AS BIGINT))) END AS text_md5
FROM (SELECT id // {P.PAGE_SIZE} AS page, COUNT(*) AS n, CAST(to_json(list({{
    'id': id, 'number': number, 'title': title, 'user': {{'login': user_login}}, 'state': state,
    'created_at': {iso('created_at')}, 'updated_at': {iso('updated_at')}, 'closed_at': {iso('closed_at')},
    'merged_at': {iso('merged_at')}, 'html_url': html_url}} ORDER BY id)) AS VARCHAR) AS text
  FROM pull_requests GROUP BY id // {P.PAGE_SIZE}) p""")
    again = f"pull_request_id % {P.RELANDED} = 0"
    q["commit_ingest"] = W(["pull_request_commits"], f"""SELECT sha, pull_request_id, pull_request_number, author_name, author_email,
       CASE WHEN NOT contains(message, 'change {"".join(P.BAD_DATE_FLAG)}') THEN author_date END AS author_date, committer_name,
       committer_email, commit_date, CASE WHEN {again} THEN 'again: ' || message ELSE message END AS message, html_url
FROM pull_request_commits""")
    q["changelog_ingest"] = q["flatten_changelog"]
    first, other = f"k % {P.RELANDED} <> 0", f"k % {P.OTHER_PROJECT_EVERY} = 0"
    q["load_counters"] = W(["jira_issues", "pull_request_commits"], f"""SELECT 'jira_issues' AS into_table, 0 AS batch,
       COUNT(*) FILTER (WHERE {first}) + COUNT(*) FILTER (WHERE {first} AND {other}) AS elements, 0 AS quarantined,
       COUNT(*) FILTER (WHERE {first}) AS inserted, 0 AS updated FROM i
UNION ALL SELECT 'jira_issues', 1, COUNT(*) FILTER (WHERE k % {P.RELANDED} <= 1)
       + COUNT(*) FILTER (WHERE k % {P.RELANDED} <= 1 AND {other}), 0,
       COUNT(*) FILTER (WHERE NOT ({first})), COUNT(*) FILTER (WHERE k % {P.RELANDED} = 1) FROM i
UNION ALL SELECT 'jira_changelog', 0, (SELECT COUNT(*) FROM events), 0, COUNT(*), 0 FROM changes
UNION ALL SELECT 'pull_request_commits', 0, COUNT(*), 0, COUNT(*), 0 FROM pull_request_commits WHERE pull_request_id % 2 = 0
UNION ALL SELECT 'pull_request_commits', 1, COUNT(*) FILTER (WHERE pull_request_id % 2 = 1 OR {again}), 0,
       COUNT(*) FILTER (WHERE pull_request_id % 2 = 1), COUNT(*) FILTER (WHERE {again}) FROM pull_request_commits""",
                           ["i AS (SELECT CAST(split_part(key, '-', 2) AS BIGINT) AS k FROM jira_issues)",
                            f"changes AS ({_flatten_body()})"])
    q["latest_versions"] = f"""SELECT {KEY.format('user_id')} AS issue_key, event_id AS last_event_id, event_type AS status, value,
       ts AS updated_at FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
    q["bulk_merge"] = q["upsert_update"]
    kind = lambda v: f"CASE n % {P.MEMBER_KINDS} WHEN 0 THEN '' WHEN 1 THEN NULL ELSE {v} END"
    q["changelog_members"] = W(["jira_changelog"], f"""SELECT id, issue_key, date_trunc('millisecond', created) AS created,
       '' AS author_account_id, '' AS author_display_name, field, field_type, {kind('from_value')} AS from_value,
       {kind('from_string')} AS from_string, '' AS to_value, to_string
FROM (SELECT *, CAST(id AS BIGINT) AS n FROM jira_changelog) c WHERE n % {P.CUT_RECORD_EVERY} <> 0""")
    at = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
    q["timeline_map"] = W(["jira_changelog", "jira_issues"], f"""SELECT {attrs},
       string_agg(s.status || ' ' || {at('s.lo')} || ' ' || {at('s.hi')}, '; ' ORDER BY s.status) AS times, COUNT(*) AS n_statuses
FROM jira_issues i JOIN (SELECT issue_key, status, MIN(created) AS lo, MAX(created) AS hi FROM h GROUP BY issue_key, status) s
  ON s.issue_key = i.key GROUP BY {attrs}""", [_STATUS_ROWS])
    labels = """SELECT issue_key, arg_min(source, step) || ' > ' || string_agg(target, ' > ' ORDER BY step) AS chain, COUNT(*) AS n
    FROM kept GROUP BY issue_key"""
    loads = [f"""load{n} AS (WITH jira_changelog AS (SELECT * FROM every_change WHERE {where}),
  {", ".join(_Q3_CTES)}
  {labels})""" for n, where in ((1, f"created < TIMESTAMP '{P.RUN_SPLITS[1]}'"), (2, "TRUE"))]
    rank = lambda n: (f"SELECT chain, MIN(issue_key) AS first_key, MIN(n) AS n_steps, {n} AS load, "  # noqa: E731
                      f"ROW_NUMBER() OVER (ORDER BY MIN(issue_key)) AS r FROM load{n}")
    q["chain_dictionary"] = "WITH " + ",\n".join([
        CTE["jira_changelog"].replace("jira_changelog AS (", "every_change AS (", 1), CTE["jira_issues"], CTE["status_lookup"], *loads,
        f"one AS ({rank(1)} GROUP BY chain)",
        f"two AS ({rank(2)} WHERE chain NOT IN (SELECT chain FROM one) GROUP BY chain)"]) + """
SELECT d.chain_id, d.first_key, d.n_steps, d.load, d.chain, (SELECT COUNT(*) FROM load2 WHERE load2.chain = d.chain) AS n_issues
FROM (SELECT chain, first_key, n_steps, load, r AS chain_id FROM one
  UNION ALL SELECT chain, first_key, n_steps, load, r + (SELECT COUNT(*) FROM one) FROM two) d"""
    asked = ", ".join(map(_q, P.SQL_STATUSES))
    q["sql_functions"] = W(["jira_changelog", "jira_issues", "pull_request_commits"], f"""SELECT 'status' AS kind, i.key, h.status AS value, MIN(h.created) AS at
FROM jira_issues i JOIN h ON h.issue_key = i.key WHERE i.key = {_q(P.SINGLE_ISSUE)} AND h.status IN ({asked}) GROUP BY i.key, h.status
UNION ALL SELECT 'commit', c.sha, c.message, NULL FROM ({q["commits_of_pull_request"]}) c
UNION ALL SELECT 'recent', r.key, r.summary, NULL FROM ({q["recent_issues"]}) r""", [_STATUS_ROWS])
    return q
