"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each builds the canonical tables from the driver's tables (``proxies``) and
runs a library query over them; ``plans/oracle.py`` has the matching SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens import schemas
from issuelens.functions.timefmt import as_of_lit, iso_z, try_parse_iso_utc
from issuelens.operators import filters, quality
from issuelens.operators.bulk import merge_bucketed, write_bucketed
from issuelens.operators.normalize import (
    changelog_members, first_item_per_key, flatten_changelog, normalize_commits, normalize_pull_requests)
from issuelens.operators.sequence import resolve_strategy
from issuelens.operators.stage import materialize
from issuelens.operators.upsert import upsert
from issuelens.plans import chains, issues as issue_q, params as P, proxies as X
from issuelens.plans import pull_requests as pr_q, sql_functions, timeline, transitions
from issuelens.plans.chain_store import ChainStore, chain_places
from issuelens.session import apply_session_defaults, scratch_path, shuffles_freed
from issuelens.sources.landed import NTZ_MICROS, parse_json_column, read_transition_lookup
from issuelens.sources.sinks import write_csv
from issuelens.sources.tables import COMPRESSION, Warehouse
from issuelens.streaming.incremental import Load, run_incremental, run_latest
from issuelens.streaming.ingest import ingest_issues, ingest_pull_requests
from issuelens.streaming.quarantine import read_loads, read_quarantine

Query = Callable[[SparkSession, str], DataFrame]

#: Codec of landed JSON texts (Spark reads them as they are).
LANDED_CODEC = "gzip"


def _prep(spark: SparkSession) -> None:
    apply_session_defaults(spark)


def _tables(spark, sf):
    _prep(spark)
    return X.issues(spark, sf), X.changelog(spark, sf)


def q_status_timeline(spark, sf):
    i, c = _tables(spark, sf)
    return timeline.status_timeline(i, c)


def q_status_values(spark, sf):
    _prep(spark)
    return timeline.status_values(X.changelog(spark, sf))


def q_status_first_seen(spark, sf):
    i, c = _tables(spark, sf)
    return timeline.status_first_seen(i, c)


def q_status_last_seen(spark, sf):
    i, c = _tables(spark, sf)
    return timeline.status_last_seen(i, c)


def q_single_issue_status(spark, sf):
    i, c = _tables(spark, sf)
    return timeline.single_issue_status(i, c, P.SINGLE_ISSUE)


def q_status_steps(spark, sf):
    _prep(spark)
    return transitions.number_steps(X.changelog(spark, sf))


def q_status_transitions(spark, sf):
    i, c = _tables(spark, sf)
    return transitions.status_transitions(i, c, X.status_lookup(spark))


def q_status_transitions_with_created(spark, sf):
    i, c = _tables(spark, sf)
    return transitions.status_transitions(i, c, X.status_lookup(spark), include_created=True)


def q_collapsed_transitions(spark, sf):
    i, c = _tables(spark, sf)
    strategy = resolve_strategy(transitions.status_history(c), ["issue_key"])
    tr = transitions.status_transitions(i, c, X.status_lookup(spark), strategy=strategy)
    return chains.collapse_repeats(tr, strategy=strategy)


def q_status_chains(spark, sf):
    i, c = _tables(spark, sf)
    return chains.status_chains(i, c, X.status_lookup(spark))


def q_issue_attributes(spark, sf):
    _prep(spark)
    return timeline.issue_attributes(X.issues(spark, sf))


def q_json_scalars(spark, sf):
    _prep(spark)
    ev = X.table(spark, sf, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").alias("k"))


def _prs_commits(spark, sf):
    _prep(spark)
    return X.pull_requests(spark, sf), X.pull_request_commits(spark, sf)


def q_pull_requests_with_commits(spark, sf):
    prs, commits = _prs_commits(spark, sf)
    p = prs.select("id", "number", "state", "merged_at")
    c = commits.select("pull_request_id", "sha", "commit_date", "message")
    return pr_q.pull_requests_with_commits(p, c).drop("pull_request_id")


def q_merged_pr_issue_keys(spark, sf):
    prs, commits = _prs_commits(spark, sf)
    return pr_q.merged_pr_issue_keys(prs, commits, X.PROJECT)


def q_commits_of_pull_request(spark, sf):
    prs, prc = _prs_commits(spark, sf)
    return pr_q.commits_of_pull_request_from_table(prs, prc, P.PR_NUMBER)


def q_recent_issues(spark, sf):
    _prep(spark)
    return issue_q.recent_issues(X.issues(spark, sf), P.RECENT_DAYS, P.RECENT_AS_OF)


def q_issue_links(spark, sf):
    _prep(spark)
    return issue_q.issue_links(X.issues(spark, sf), as_of=X.LOAD_TIME)


def _upsert(spark, sf, keep=(), on_conflict="update"):
    _prep(spark)
    target = X.pull_request_commits(
        spark, sf, F.col("l_shipdate") < F.lit(P.UPSERT_TARGET_BEFORE).cast("timestamp_ntz"),
        name="pull_request_commits_existing")
    source, late = X.commits_to_load(spark, sf, F.col("l_shipdate") >= F.lit(P.UPSERT_SOURCE_FROM).cast("timestamp_ntz"))
    return upsert(target, source, schemas.KEYS["pull_request_commits"], keep_cols=keep,
                  on_conflict=on_conflict, order=X.COMMIT_ORDER, late=late)


def q_upsert_update(spark, sf):
    return _upsert(spark, sf)


def q_upsert_keep_columns(spark, sf):
    return _upsert(spark, sf, keep=P.UPSERT_KEEP)


def q_upsert_do_nothing(spark, sf):
    return _upsert(spark, sf, on_conflict="nothing")


def q_high_watermark(spark, sf):
    _prep(spark)
    return issue_q.high_watermark(X.pull_requests(spark, sf))


def q_issue_watermark(spark, sf):
    _prep(spark)
    return issue_q.issue_watermark(X.issues(spark, sf))


def q_newer_than(spark, sf):
    _prep(spark)
    return filters.newer_than(X.pull_requests(spark, sf), P.NEWER_THAN)


def q_since_minute(spark, sf):
    _prep(spark)
    attrs = timeline.issue_attributes(X.issues(spark, sf)).select("key", "updated")
    return filters.since_minute(attrs, P.SINCE, "updated")


def q_key_duplicates(spark, sf):
    _prep(spark)
    return quality.key_duplicates(X.commits_landed(spark, sf), schemas.KEYS["pull_request_commits"])


def q_orphan_commits(spark, sf):
    """All commits against all PRs; those of one line number name a PR that does not exist."""
    prs, commits = _prs_commits(spark, sf)
    stray = F.col("sha").endswith(f"-{P.STRAY_LINE}")
    parent = F.when(stray, -F.col("pull_request_id")).otherwise(F.col("pull_request_id"))
    return quality.orphans(commits.select("sha", parent.alias("pull_request_id")), prs, "pull_request_id", "id")


def _landed_commit_json(spark, sf) -> DataFrame:
    """Landed commit objects (JSON text) built from ``lineitem``; one flag
    combination carries day/month/year dates that do not parse."""
    li = X.table(spark, sf, "lineitem")
    bad = (F.col("l_returnflag") == P.BAD_DATE_FLAG[0]) & (F.col("l_linestatus") == P.BAD_DATE_FLAG[1])
    date_text = F.when(bad, F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise(iso_z("l_shipdate"))
    cols = X.commit_fields()

    def person(n, e, d):
        return F.struct(cols[n].alias("name"), cols[e].alias("email"), d.alias("date"))
    obj = F.struct(
        cols["sha"].alias("sha"), cols["html_url"].alias("html_url"),
        F.struct(cols["message"].alias("message"),
                 person("author_name", "author_email", date_text).alias("author"),
                 person("committer_name", "committer_email", iso_z("l_shipdate")).alias("committer"))
        .alias("commit"),
        cols["pull_request_id"].alias("pull_request_id"),
        cols["pull_request_number"].alias("pull_request_number"))
    return li.select(F.to_json(obj).alias("json"))


def q_unparsable_dates(spark, sf):
    _prep(spark)
    raw = parse_json_column(_landed_commit_json(spark, sf), "json", schemas.COMMIT_RAW)
    rows = raw.select("sha", "pull_request_id", F.col("commit.author.date").alias("author_date_text"))
    return quality.unparsable(rows, "author_date_text", try_parse_iso_utc("author_date_text"))


def q_load_profiles(spark, sf):
    """Profiles of two loads of landed commits (by parity of the pull request; commits of one
    line number lose their sha) and of both together, from one scan, beside the exact
    counts of keys; ``sketch_near``: the sketch is within 5 percent of them."""
    _prep(spark)
    raw = parse_json_column(_landed_commit_json(spark, sf), "json", schemas.COMMIT_RAW)
    rows = raw.select(
        F.when(~F.col("sha").endswith(f"-{P.STRAY_LINE}"), F.col("sha")).alias("sha"), "pull_request_id",
        F.pmod("pull_request_id", F.lit(2)).cast("string").alias("load"), F.col("commit.author.date").alias("date_text"))
    bad = F.col("date_text").isNotNull() & try_parse_iso_utc("date_text").isNull()
    # Both passes read what is parsed once.
    rows = materialize(rows.select("sha", "pull_request_id", "load", bad.alias("bad")), "profiled", COMPRESSION)
    keys = schemas.KEYS["pull_request_commits"]
    loads = materialize(quality.profile(rows, keys, {"n_unparsable": F.col("bad")}, ["load"]), "profiles")
    both = quality.merge_profiles(loads).select(F.lit("all").alias("load"), *[c for c in loads.columns if c != "load"])
    exact = materialize(quality.key_counts(rows, keys, ["load"]), "key-counts")
    # A key's pull request names its load, so the loads share no key.
    total = exact.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_keys", "n_repeated")])
    exact = exact.unionByName(total.withColumn("load", F.lit("all")))
    near = F.abs(F.hll_sketch_estimate("keys") - F.col("n_keys")) * 20 <= F.col("n_keys")
    return (loads.unionByName(both).join(exact, "load")
            .select("load", "n_rows", "n_null_keys", "n_unparsable", "n_keys", "n_repeated", near.alias("sketch_near")))


def q_normalized_commits(spark, sf):
    _prep(spark)
    raw = parse_json_column(_landed_commit_json(spark, sf), "json", schemas.COMMIT_RAW)
    return normalize_commits(raw)


def _landed_pr(prs: DataFrame) -> DataFrame:
    """Landed PR objects (nested columns, times as text)."""
    return prs.select(
        "id", "number", "title", F.struct(F.col("user_login").alias("login")).alias("user"), "state",
        iso_z("created_at").alias("created_at"), iso_z("updated_at").alias("updated_at"),
        iso_z("closed_at").alias("closed_at"), iso_z("merged_at").alias("merged_at"), "html_url")


def q_normalized_pull_requests(spark, sf):
    _prep(spark)
    raw = _landed_pr(X.pull_requests(spark, sf)).select(F.to_json(F.struct("*")).alias("json"))
    return normalize_pull_requests(parse_json_column(raw, "json", schemas.PR_RAW))


def q_pull_request_ingest(spark, sf):
    """All PRs, landed newest first in two runs from two folders, some again in a
    later and some in an older version; the table holds each PR's latest version."""
    _prep(spark)
    root = scratch_path(spark, "pr-ingest")
    prs = X.pull_requests(spark, sf)
    later = prs.where(F.col("id") % P.RELANDED == 0).withColumns({
        "state": F.lit("relanded"), "updated_at": F.timestamp_add("DAY", F.lit(1), F.col("updated_at"))})
    older = prs.where(F.col("id") % P.RELANDED == 1).withColumns({
        "state": F.lit("stale"), "updated_at": F.timestamp_add("DAY", F.lit(-1), F.col("updated_at"))})
    split = F.lit(P.NEWER_THAN).cast("timestamp_ntz")
    mine = F.col("id") % 2 == 0  # the other half lands in a second folder
    runs = [prs.where(F.col("updated_at") > split), prs.where(F.col("updated_at") <= split).union(later).union(older)]
    spark.createDataFrame([], schemas.COMMIT_RAW).write.json(f"{root}/commits")
    for rows in runs:
        for folder, part in (("a", rows.where(mine)), ("b", rows.where(~mine))):
            _landed_pr(part).write.mode("append").json(f"{root}/{folder}")
            store = ingest_pull_requests(spark, f"{root}/{folder}", f"{root}/commits", f"{root}/warehouse",
                                         f"{root}/checkpoint-{folder}", multi_line=False)
    return store.read("pull_requests")


def _landed_pages(prs: DataFrame) -> DataFrame:
    """(page, text): PR pages as JSON arrays, one text each."""
    raw = _landed_pr(prs)
    page = F.call_function("div", F.col("id"), F.lit(P.PAGE_SIZE)).alias("page")
    one = F.struct(*[F.col(c) for c in raw.columns])
    return raw.groupBy(page).agg(F.to_json(F.array_sort(F.collect_list(one)), {"ignoreNullFields": "false"}).alias("text"))


def _of(numbers):
    return F.col("page") % numbers[0] == numbers[1]


def q_landed_quarantine(spark, sf):
    """PR pages of which some land cut off, and some of those later again whole: of each
    page the rows in the table, and what the quarantine holds."""
    _prep(spark)
    root = scratch_path(spark, "quarantine")
    pages = _landed_pages(X.pull_requests(spark, sf))
    cut = F.expr(f"substr(text, 1, cast(length(text) * {P.CUT_PERCENT} div 100 as int))")
    first = pages.select(F.when(_of(P.CUT_PAGES), cut).otherwise(F.col("text")).alias("value"))
    spark.createDataFrame([], "value string").write.text(f"{root}/commits")
    for texts in (first, pages.where(_of(P.REPAIRED_PAGES)).select(F.col("text").alias("value"))):
        texts.write.mode("append").text(f"{root}/prs")
        store = ingest_pull_requests(spark, f"{root}/prs", f"{root}/commits", f"{root}/warehouse", f"{root}/checkpoint",
                                     multi_line=False)
    page = lambda c: F.call_function("div", c, F.lit(P.PAGE_SIZE)).alias("page")
    rows = store.read("pull_requests").select(page(F.col("id")), F.lit(1).alias("row"), F.lit(None).cast("string").alias("text"))
    first_id = F.regexp_extract("text", '"id":(\\d+)', 1).cast("long")
    aside = read_quarantine(store).select(page(first_id), F.lit(0).alias("row"), F.md5("text").alias("text"))
    return rows.union(aside).groupBy("page").agg(
        F.sum("row").alias("n_loaded"), F.count("text").alias("n_quarantined"), F.max("text").alias("text_md5"))


def q_commit_ingest(spark, sf):
    """All commits, landed as pages in two runs, those of every tenth PR again."""
    _prep(spark)
    store = _commit_store(spark, sf)
    return store.read("pull_request_commits")


def _commit_store(spark, sf):
    root = scratch_path(spark, "commit-ingest")
    spark.createDataFrame([], "value string").write.text(f"{root}/prs")
    pr = F.col("l_orderkey")
    late, again = pr % 2 == 1, pr % P.RELANDED == 0  # RELANDED is even: of these none is late
    message = F.when(F.col("pull_request_id") % 2 == 1, F.col("message")).otherwise(F.concat(F.lit("again: "), "message"))
    for where, text in ((~late, F.col("message")), (late | again, message)):
        with shuffles_freed(spark):
            rows = X.commits_by_page(spark, sf, where, P.PAGE_SIZE).withColumn("message", text)
            _commit_pages(rows).write.mode("append").text(f"{root}/commits", compression=LANDED_CODEC)
        store = ingest_pull_requests(spark, f"{root}/prs", f"{root}/commits", f"{root}/warehouse", f"{root}/checkpoint",
                                     multi_line=False)
    return store


def _commit_pages(commits: DataFrame) -> DataFrame:
    """Commit pages as JSON arrays, by ``page``; one kind of commit has dates that do not parse."""
    bad = F.col("message").contains(f"change {''.join(P.BAD_DATE_FLAG)}")
    date_text = F.when(bad, F.date_format("author_date", "dd/MM/yyyy")).otherwise(iso_z("author_date"))

    def person(kind, date):
        return F.struct(F.col(f"{kind}_name").alias("name"), F.col(f"{kind}_email").alias("email"), date.alias("date")).alias(kind)
    obj = F.struct("sha", "html_url", F.struct("message", person("author", date_text), person("committer", iso_z("commit_date")))
                   .alias("commit"), "pull_request_id", "pull_request_number")
    return commits.groupBy("page").agg(F.to_json(F.collect_list(obj)).alias("value")).select("value")


def q_changelog_ingest(spark, sf):
    """The changelog of both landings of ``issue_ingest``, in both API shapes."""
    _prep(spark)
    return _issue_store(spark, sf).read("jira_changelog")


def q_load_counters(spark, sf):
    """What the batches of the issue and the commit loads read, inserted and updated."""
    _prep(spark)
    loads = read_loads(_issue_store(spark, sf)).union(read_loads(_commit_store(spark, sf)))
    return loads.where(F.col("table") != "jira_links").select(
        F.col("table").alias("into_table"), "batch", "elements", "quarantined", "inserted", "updated")


def _landed_issues(issues: DataFrame) -> DataFrame:
    """Issue search envelopes of one issue each, as JSON text lines."""
    return issues.select(F.format_string('{"issues": [{"key": "%s", "id": "%s", "fields": %s}]}', "key", "id", "fields")
                         .alias("value"))


def _other_project(issues: DataFrame) -> DataFrame:
    """Some of the issues once more, as those of a project that is not loaded."""
    fields = F.replace("fields", F.lit(f'"project":{{"key":"{X.PROJECT}"}}'), F.lit('"project":{"key":"OTHER"}'))
    return issues.where(F.col("id").cast("long") % P.OTHER_PROJECT_EVERY == 0).withColumns({
        "key": F.replace("key", F.lit(X.PROJECT), F.lit("OTHER")), "fields": fields})


def _issue_store(spark, sf):
    root = scratch_path(spark, "issue-ingest")
    issues, changelog = X.issues(spark, sf), _nested_changelog(spark, sf)
    first = F.col("id").cast("long") % P.RELANDED != 0
    changelog.select(F.col("json").alias("value")).write.text(f"{root}/changelog", compression=LANDED_CODEC)
    again = issues.where(F.col("id").cast("long") % P.RELANDED == 1)
    for n, rows in enumerate((issues.where(first), issues.where(~first).union(again))):
        _landed_issues(rows.union(_other_project(rows))).write.mode("append").text(f"{root}/issues", compression=LANDED_CODEC)
        day = F.timestamp_add("DAY", F.lit(n), as_of_lit(X.LOAD_TIME))
        store = ingest_issues(spark, f"{root}/issues", f"{root}/changelog", f"{root}/warehouse", f"{root}/checkpoint",
                              as_of=day, multi_line_issues=False, project=X.PROJECT)
    return store


def q_issue_ingest(spark, sf):
    """All issues of the project, landed in two runs among those of another one, some again;
    load times tell the runs."""
    _prep(spark)
    store = _issue_store(spark, sf)
    rows = store.read("jira_issues")
    n = store.read("jira_links").groupBy(F.col("source_issue_key").alias("key")).agg(F.count(F.lit(1)).alias("n_links"))
    return (timeline.issue_attributes(rows).select("key", "summary", "current_status")
            .join(rows.select("key", "created_at", "updated_at"), "key").join(n, "key", "left")
            .withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))))


def q_timeline_csv(spark, sf):
    """Q1 through the sorted CSV sink and back."""
    i, c = _tables(spark, sf)
    path = scratch_path(spark, "timeline-csv")
    out = timeline.status_timeline(i, c)
    write_csv(out.select("key", "current_status", "view_min", "view_max"), path, order_by=["key"])
    return spark.read.schema("key string, current_status string, view_min timestamp_ntz, view_max timestamp_ntz") \
        .option("header", True).option("timestampNTZFormat", NTZ_MICROS).csv(path)


def q_transitions_csv_lookup(spark, sf):
    """Q2 with the lookup written to and read from its CSV file."""
    i, c = _tables(spark, sf)
    path = scratch_path(spark, "lookup-csv")
    write_csv(X.status_lookup(spark), path)
    return transitions.status_transitions(i, c, read_transition_lookup(spark, path))


def q_lookup_gaps(spark, sf):
    _prep(spark)
    hist = filters.status_changes(X.changelog(spark, sf))
    return quality.lookup_gaps(hist, X.status_lookup(spark), "from_string", "to_string")


def _nested_changelog(spark, sf) -> DataFrame:
    """Changelog records in both API shapes, one history entry per status change."""
    c = X.changelog(spark, sf)
    n = F.col("id").cast("long")
    status_item = F.struct(F.col("field").alias("field"), F.col("field_type").alias("fieldtype"),
                           F.col("from_value").alias("from"), F.col("from_string").alias("fromString"),
                           F.col("to_value").alias("to"), F.col("to_string").alias("toString"))

    def prio(v):
        return F.struct(F.lit("priority").alias("field"), F.lit("jira").alias("fieldtype"),
                        F.lit(None).cast("string").alias("from"), F.lit(None).cast("string").alias("fromString"),
                        v.cast("string").alias("to"), F.concat(F.lit("P"), v.cast("string")).alias("toString"))
    purchase = F.col("to_string") == "purchase"
    items = F.when(n % P.NO_ITEMS_EVERY == 0, F.array().cast(T.ArrayType(schemas.CHANGE_ITEM))).otherwise(
        F.filter(F.array(status_item, F.when(purchase, prio(n % 5)), F.when(purchase, prio(n % 5 + 1))),
                 lambda x: x.isNotNull()))
    author = F.when(n % P.NO_AUTHOR_EVERY != 0, F.struct(
        F.col("author_account_id").alias("accountId"), F.col("author_display_name").alias("displayName")))
    created = F.concat(F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000"))
    h = F.array(F.struct(F.col("id").alias("id"), created.alias("created"), author.alias("author"),
                         items.alias("items")))
    user = F.regexp_extract("issue_key", r"-(\d+)$", 1).cast("long")
    v2 = F.to_json(F.struct(F.col("issue_key").alias("key"), F.struct(h.alias("histories")).alias("changelog")))
    v3 = F.to_json(F.struct(F.col("issue_key").alias("issue_key"), h.alias("values"), F.lit(1).alias("total")))
    return c.select(F.when(user % 2 == 0, v2).otherwise(v3).alias("json"))


def q_flatten_changelog(spark, sf):
    _prep(spark)
    raw = parse_json_column(_nested_changelog(spark, sf), "json", schemas.CHANGELOG_RAW)
    return first_item_per_key(flatten_changelog(raw))


ISSUE_STATUS = T.StructType([
    T.StructField("issue_key", T.StringType()), T.StructField("last_event_id", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("updated_at", T.TimestampNTZType()), T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("loaded_at", T.TimestampNTZType())])


def q_incremental_upsert(spark, sf):
    """Three scheduled ``availableNow`` runs, each after more events landed."""
    _prep(spark)
    root = scratch_path(spark, "incremental")
    landing, ckpt = f"{root}/landing", f"{root}/_checkpoint"
    store = Warehouse(spark, f"{root}/warehouse")
    ev = X.table(spark, sf, "events")
    raw_schema = ev.schema
    bounds = [None, *P.RUN_SPLITS, None]
    for run in (1, 2, 3):
        lo, hi = bounds[run - 1], bounds[run]
        part = ev
        if lo is not None:
            part = part.filter(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            part = part.filter(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
        part.write.mode("append").option("timestampNTZFormat", NTZ_MICROS).json(landing)
        as_of = as_of_lit(X.LOAD_TIME)
        as_of = F.timestamp_add("DAY", F.lit(run), as_of)

        def rows(batch, as_of=as_of):
            return batch.select(
                F.concat(F.lit(X.PROJECT + "-"), F.col("user_id").cast("string")).alias("issue_key"),
                F.col("event_id").alias("last_event_id"), F.col("event_type").alias("status"), "value",
                F.col("ts").alias("updated_at"), as_of.alias("created_at"), as_of.alias("loaded_at"))
        load = Load("issue_status", rows, ["issue_key"], ["updated_at", "last_event_id"], ["created_at"], schema=ISSUE_STATUS)
        run_incremental(spark, landing, store, raw_schema, load, ckpt)
    return store.read("issue_status", ISSUE_STATUS)


def q_latest_versions(spark, sf):
    """Each issue's last event, kept in a stream's state over three runs that land the last
    period first, and in each run part of what had landed before."""
    _prep(spark)
    root = scratch_path(spark, "latest")
    store = Warehouse(spark, f"{root}/warehouse")
    ev = X.table(spark, sf, "events")
    one, two = (F.lit(t).cast("timestamp_ntz") for t in P.RUN_SPLITS)
    periods = [F.col("ts") >= two, F.col("ts") < one, (F.col("ts") >= one) & (F.col("ts") < two)]
    columns = [F.concat(F.lit(X.PROJECT + "-"), F.col("user_id").cast("string")).alias("issue_key"),
               F.col("event_id").alias("last_event_id"), F.col("event_type").alias("status"), "value", F.col("ts").alias("updated_at")]
    schema = T.StructType([f for f in ISSUE_STATUS if f.name not in ("created_at", "loaded_at")])
    load = Load("issue_status", lambda rows: rows.select(*columns), ["issue_key"], ["updated_at", "last_event_id"],
                version_col="updated_at", schema=schema)
    landed = F.lit(False)
    for n, period in enumerate(periods):
        again = landed & (F.col("event_id") % len(periods) == n)
        ev.where(period | again).write.mode("append").option("timestampNTZFormat", NTZ_MICROS).json(f"{root}/landing")
        landed = landed | period
        run_latest(spark, f"{root}/landing", store, ev.schema, load, f"{root}/checkpoint")
    return store.read("issue_status", schema)


def q_changelog_members(spark, sf):
    """Changelog items whose from values are missing, null or present, from records of which
    some are cut off."""
    _prep(spark)
    c = X.changelog(spark, sf)
    n = F.col("id").cast("long")
    member = lambda name, v: F.when(n % P.MEMBER_KINDS == 0, "").when(n % P.MEMBER_KINDS == 1, f',"{name}":null').otherwise(
        F.concat(F.lit(f',"{name}":"'), v, F.lit('"')))
    created = F.concat(F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000"))
    text = F.concat(F.lit('{"key":"'), "issue_key", F.lit('","values":[{"id":"'), "id", F.lit('","created":"'), created,
                    F.lit('","items":[{"field":"status","fieldtype":"jira"'), member("from", F.col("from_value")),
                    member("fromString", F.col("from_string")), F.lit(',"toString":"'), "to_string", F.lit('"}]}]}'))
    cut = F.when(n % P.CUT_RECORD_EVERY == 0, F.substring(text, 1, 60)).otherwise(text)
    return changelog_members(c.select(cut.alias("json")), "json").drop("entry_pos", "item_pos")


def q_timeline_map(spark, sf):
    """Q1 with the statuses as data; the map is written out as text."""
    i, c = _tables(spark, sf)
    out = timeline.status_timeline_map(i, c)
    day = lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    times = F.transform(F.map_entries("times"), lambda e: F.concat(
        e["key"], F.lit(" "), day(e["value"]["first"]), F.lit(" "), day(e["value"]["last"])))
    return out.withColumns({"n_statuses": F.size("times").cast("long"), "times": F.array_join(times, "; ")})


def q_chain_dictionary(spark, sf):
    """Chain ids over two loads, of the changes up to a day and of all; with the chains'
    texts and the number of issues that have each after the second."""
    i, c = _tables(spark, sf)
    store = ChainStore(spark, scratch_path(spark, "chains"))
    lookup = X.status_lookup(spark)
    early = c.where(F.col("created") < F.lit(P.RUN_SPLITS[1]).cast("timestamp_ntz"))
    store.extend(chain_places(i, early, lookup), 1)
    now = store.extend(chain_places(i, c, lookup), 2)
    n = now.groupBy("chain_id").agg(F.count(F.lit(1)).alias("n_issues"))
    return (store.ids().select("chain_id", "first_key", "n_steps", "load").join(store.texts(), "chain_id")
            .join(n, "chain_id", "left").withColumn("n_issues", F.coalesce("n_issues", F.lit(0).cast("long"))))


def q_sql_functions(spark, sf):
    """Q5, Q6 and Q7 as SQL table functions with bound values."""
    prs, commits = _prs_commits(spark, sf)
    i, c = _tables(spark, sf)
    by_commit, pr_commits = pr_q.commit_views(commits)
    for name, df in {"jira_issues": i, "jira_changelog": c, "pull_requests": prs, "commits": by_commit, "pr_commits": pr_commits}.items():
        df.createOrReplaceTempView(name)
    sql_functions.register_functions(spark)
    times = sql_functions.status_times(spark, P.SINGLE_ISSUE, list(P.SQL_STATUSES))
    return (times.select(F.lit("status").alias("kind"), "key", F.col("status").alias("value"), F.col("first_seen").alias("at"))
            .union(sql_functions.commits_of(spark, P.PR_NUMBER).select(F.lit("commit"), "sha", "message", F.lit(None)))
            .union(sql_functions.updated_within(spark, P.RECENT_DAYS, P.RECENT_AS_OF).select(
                F.lit("recent"), "key", "summary", F.lit(None))))


def q_bulk_merge(spark, sf):
    """``upsert_update`` by a merge join with a bucketed table, and the result saved like it."""
    _prep(spark)
    name = f"commits_{uuid.uuid4().hex[:12]}"
    keys = schemas.KEYS["pull_request_commits"]
    target = X.pull_request_commits(
        spark, sf, F.col("l_shipdate") < F.lit(P.UPSERT_TARGET_BEFORE).cast("timestamp_ntz"), name="pull_request_commits_existing")
    write_bucketed(target, name, keys, P.BULK_BUCKETS)
    batch = X.commits_landed(spark, sf, F.col("l_shipdate") >= F.lit(P.UPSERT_SOURCE_FROM).cast("timestamp_ntz"))
    merged = merge_bucketed(spark, name, batch, X.COMMIT_ORDER_COLS, latest=False)
    return write_bucketed(merged, f"{name}_merged", keys, P.BULK_BUCKETS, laid_out=True)


QUERIES: dict[str, Query] = {
    "status_timeline": q_status_timeline,
    "status_values": q_status_values,
    "status_first_seen": q_status_first_seen,
    "status_last_seen": q_status_last_seen,
    "single_issue_status": q_single_issue_status,
    "status_steps": q_status_steps,
    "status_transitions": q_status_transitions,
    "status_transitions_with_created": q_status_transitions_with_created,
    "collapsed_transitions": q_collapsed_transitions,
    "status_chains": q_status_chains,
    "issue_attributes": q_issue_attributes,
    "json_scalars": q_json_scalars,
    "pull_requests_with_commits": q_pull_requests_with_commits,
    "merged_pr_issue_keys": q_merged_pr_issue_keys,
    "commits_of_pull_request": q_commits_of_pull_request,
    "recent_issues": q_recent_issues,
    "issue_links": q_issue_links,
    "upsert_update": q_upsert_update,
    "upsert_keep_columns": q_upsert_keep_columns,
    "upsert_do_nothing": q_upsert_do_nothing,
    "high_watermark": q_high_watermark,
    "issue_watermark": q_issue_watermark,
    "newer_than": q_newer_than,
    "since_minute": q_since_minute,
    "key_duplicates": q_key_duplicates,
    "orphan_commits": q_orphan_commits,
    "unparsable_dates": q_unparsable_dates,
    "load_profiles": q_load_profiles,
    "normalized_commits": q_normalized_commits,
    "normalized_pull_requests": q_normalized_pull_requests,
    "pull_request_ingest": q_pull_request_ingest,
    "issue_ingest": q_issue_ingest,
    "timeline_csv": q_timeline_csv,
    "transitions_csv_lookup": q_transitions_csv_lookup,
    "lookup_gaps": q_lookup_gaps,
    "flatten_changelog": q_flatten_changelog,
    "incremental_upsert": q_incremental_upsert,
    "landed_quarantine": q_landed_quarantine,
    "commit_ingest": q_commit_ingest,
    "changelog_ingest": q_changelog_ingest,
    "load_counters": q_load_counters,
    "latest_versions": q_latest_versions,
    "changelog_members": q_changelog_members,
    "timeline_map": q_timeline_map,
    "chain_dictionary": q_chain_dictionary,
    "sql_functions": q_sql_functions,
    "bulk_merge": q_bulk_merge,
}
