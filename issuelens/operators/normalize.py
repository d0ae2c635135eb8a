"""Flatten landed payloads into table rows (PRJ-1..PRJ-6, PRJ-8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens import schemas
from issuelens.functions.text import or_empty, strip_quotes
from issuelens.functions.timefmt import parse_iso_utc, parse_jira_ts, try_parse_iso_utc
from issuelens.functions.variant import document, elements, text_or


def normalize_pull_requests(raw: DataFrame, keep=()) -> DataFrame:
    """PRJ-1: PR objects → ``pull_requests`` rows (``user.login`` → ``user_login``).
    ``keep``: extra raw columns carried through (e.g. landing order)."""
    return raw.select(
        F.col("id").cast("long").alias("id"), F.col("number").cast("int").alias("number"),
        "title", F.col("user.login").alias("user_login"), "state",
        parse_iso_utc("created_at").alias("created_at"),
        parse_iso_utc("updated_at").alias("updated_at"),
        parse_iso_utc("closed_at").alias("closed_at"),
        parse_iso_utc("merged_at").alias("merged_at"), "html_url", *keep)


def normalize_commits(raw: DataFrame, keep=()) -> DataFrame:
    """PRJ-2/PRJ-3: commit objects → ``pull_request_commits`` rows; dates that
    do not parse become NULL (FN-7); columns in table order."""
    return raw.select(
        F.col("sha").cast("string").alias("sha"),
        F.col("pull_request_id").cast("long").alias("pull_request_id"),
        F.col("pull_request_number").cast("int").alias("pull_request_number"),
        F.col("commit.author.name").alias("author_name"),
        F.col("commit.author.email").alias("author_email"),
        try_parse_iso_utc("commit.author.date").alias("author_date"),
        F.col("commit.committer.name").alias("committer_name"),
        F.col("commit.committer.email").alias("committer_email"),
        try_parse_iso_utc("commit.committer.date").alias("commit_date"),
        F.col("commit.message").alias("message"), "html_url", *keep)


def normalize_issues(raw: DataFrame, as_of: Column | None = None, keep=()) -> DataFrame:
    """PRJ-4: ``key``, ``id`` and ``fields`` as raw JSON text, plus load times."""
    now = as_of if as_of is not None else F.current_timestamp().cast("timestamp_ntz")
    return raw.select("key", "id", "fields", now.alias("created_at"), now.alias("updated_at"), *keep)


def explode_issue_page(page: DataFrame, keep=()) -> DataFrame:
    """SRC-3: issue search envelope → one row per issue."""
    return page.select(F.posexplode("issues").alias("_ipos", "i"), *keep).select("i.*", "_ipos", *keep)


def changelog_histories(raw: DataFrame, keep=()) -> DataFrame:
    """SRC-4: one row per history entry from either the v2 shape
    (``changelog.histories``) or the v3 shape (``values``)."""
    key = F.coalesce(F.col("issue_key"), F.col("key"))
    entries = F.coalesce(F.col("changelog.histories"), F.col("values"),
                         F.array().cast(T.ArrayType(schemas.HISTORY)))
    return raw.select(key.alias("issue_key"), F.posexplode(entries).alias("entry_pos", "h"), *keep)


def flatten_changelog(raw: DataFrame, keep=()) -> DataFrame:
    """PRJ-5: one row per (entry, item); an entry without items gives no rows;
    missing author or item name → ``''``; from/to values keep NULL (cleared)."""
    hist = changelog_histories(raw, keep)
    items = hist.select("issue_key", "entry_pos", "h.id", "h.created", "h.author",
                        F.posexplode("h.items").alias("item_pos", "it"), *keep)
    return items.select(
        F.col("id"), F.col("issue_key"),
        parse_jira_ts("created").alias("created"),
        or_empty("author.accountId").alias("author_account_id"),
        or_empty("author.displayName").alias("author_display_name"),
        or_empty("it.field").alias("field"),
        or_empty("it.fieldtype").alias("field_type"),
        F.col("it.from").alias("from_value"), F.col("it.fromString").alias("from_string"),
        F.col("it.to").alias("to_value"), F.col("it.toString").alias("to_string"),
        "entry_pos", "item_pos", *keep)


def changelog_members(records: DataFrame, col: str, keep=()) -> DataFrame:
    """PRJ-5 on the records' JSON text, by VARIANT: a missing author, name or value is ``''``
    and an explicit null is NULL (a value that was cleared), in every member.  Text
    that is no JSON gives no rows."""
    doc = records.select(document(F.col(col)).alias("_d"), *keep)
    d = F.col("_d")
    key = F.coalesce(F.try_variant_get(d, "$.issue_key", "string"), F.try_variant_get(d, "$.key", "string"))
    entries = F.coalesce(elements(d, "$.changelog.histories"), elements(d, "$.values"))
    hist = doc.select(key.alias("issue_key"), F.posexplode(entries).alias("entry_pos", "_h"), *keep)
    items = hist.select("issue_key", "entry_pos", "_h", F.posexplode(elements(F.col("_h"), "$.items")).alias("item_pos", "_i"), *keep)
    h, i, none = F.col("_h"), F.col("_i"), F.lit("")
    return items.select(
        F.try_variant_get(h, "$.id", "string").alias("id"), "issue_key",
        parse_jira_ts(F.try_variant_get(h, "$.created", "string")).alias("created"),
        text_or(h, "$.author.accountId", none).alias("author_account_id"),
        text_or(h, "$.author.displayName", none).alias("author_display_name"),
        *[text_or(i, f"$.{name}", none).alias(c) for c, name in (
            ("field", "field"), ("field_type", "fieldtype"), ("from_value", "from"), ("from_string", "fromString"),
            ("to_value", "to"), ("to_string", "toString"))],
        "entry_pos", "item_pos", *keep)


def item_order(latest_by=()) -> list[Column]:
    """The order of a key's items, the last of which counts: by landing, then the first by position."""
    return [F.col(c) for c in latest_by] + [-F.col("entry_pos"), -F.col("item_pos")]


def first_item_per_key(flat: DataFrame, latest_by=()) -> DataFrame:
    """§2.14-9: two items of one field in one entry collide on (id, field);
    the first by position wins.  With ``latest_by`` (landing order columns)
    a later landed copy of the entry wins over an earlier one."""
    from issuelens.operators.upsert import dedupe_first, dedupe_last
    if latest_by:
        out = dedupe_last(flat, ["id", "field"], item_order(latest_by))
    else:
        out = dedupe_first(flat, ["id", "field"], ["entry_pos", "item_pos"])
    return out.drop("entry_pos", "item_pos")


def extract_links(issues: DataFrame) -> DataFrame:
    """PRJ-6: ``fields.issuelinks`` → (source, target, type) edges.

    ``outwardIssue`` gives (this → other), ``inwardIssue`` gives (other →
    this); one element may give both; a missing type name becomes ``''``.
    """
    links = F.from_json(F.get_json_object("fields", "$.issuelinks"), schemas.ISSUE_LINKS)
    el = issues.select("key", F.explode(links).alias("l"))
    name = or_empty(F.col("l.type.name"))
    both = F.array(
        F.struct(F.col("key").alias("s"), F.col("l.outwardIssue.key").alias("t"),
                 F.col("l.outwardIssue").isNotNull().alias("ok")),
        F.struct(F.col("l.inwardIssue.key").alias("s"), F.col("key").alias("t"),
                 F.col("l.inwardIssue").isNotNull().alias("ok")))
    edges = el.select(name.alias("link_type"), F.explode(both).alias("e")).filter("e.ok")
    return edges.select(F.col("e.s").alias("source_issue_key"),
                        F.col("e.t").alias("target_issue_key"), "link_type")


def strip_json_quotes(df: DataFrame) -> DataFrame:
    """PRJ-8: strip leading/trailing quotes from every string column."""
    out = []
    for f in df.schema.fields:
        if f.dataType.simpleString() == "string":
            out.append(strip_quotes(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
