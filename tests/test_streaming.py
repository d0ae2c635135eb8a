import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import fixture_path
from issuelens import schemas
from issuelens.operators.normalize import normalize_pull_requests
from issuelens.operators.upsert import RULES
from issuelens.plans.issues import high_watermark
from issuelens.sources.landed import PULL_REQUEST_PAGES
from issuelens.sources.tables import Warehouse, bucket_of
from issuelens.streaming import incremental as inc
from issuelens.streaming.quarantine import read_loads, read_quarantine

PRS = inc.Load("pull_requests", lambda rows: normalize_pull_requests(rows, keep=inc.LANDED), order=["updated_at", *inc.LANDED],
               **RULES["pull_requests"])


def _land(path, name, objs, cut=0):
    os.makedirs(path, exist_ok=True)
    text = "\n".join(json.dumps(o) for o in objs)
    with open(os.path.join(path, name), "w") as f:
        f.write(text[:-cut] if cut else text + "\n")


def _prs():
    with open(fixture_path("pull_requests_page.json")) as f:
        return json.load(f)


def _load(store, root, landing="landing", ckpt="ckpt", multi_line=False, **kw):
    inc.load_pages(store, f"{root}/{landing}", PULL_REQUEST_PAGES, [PRS], f"{root}/{ckpt}", multi_line, **kw)


def _run(spark, root, files, buckets=16):
    store = Warehouse(spark, f"{root}/wh", buckets)
    for i, objs in enumerate(files):
        _land(f"{root}/landing", f"page-{i:03d}.json", objs)
        _load(store, root)
    return store


def _rows(store, name="pull_requests"):
    return sorted(tuple(r) for r in store.read(name).collect())


def _files(store, name="pull_requests"):
    """Files of each bucket folder, with their times."""
    out = {}
    for folder, _, names in os.walk(store.path(name).removeprefix("file:")):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.basename(folder), set()).add((n, os.stat(os.path.join(folder, n)).st_mtime_ns))
    return out


def test_batches_equal_one_batch(spark, tmp_dir):
    prs = _prs()
    a = _run(spark, f"{tmp_dir}/a", [prs[:3], prs[3:6], prs[6:]])
    b = _run(spark, f"{tmp_dir}/b", [prs], buckets=5)
    assert _rows(a) == _rows(b) and len(_rows(a)) == 9
    assert sorted((r.batch, r.elements, r.inserted, r.updated) for r in read_loads(a).collect()) == [
        (0, 3, 3, 0), (1, 3, 3, 0), (2, 3, 3, 0)]
    before = _files(a)
    _load(a, f"{tmp_dir}/a")  # no new files: nothing to do
    assert _files(a) == before


def test_a_batch_rewrites_only_its_buckets(spark, tmp_dir):
    prs = _prs()
    store = _run(spark, tmp_dir, [prs], buckets=64)
    before = _files(store)
    ids = spark.createDataFrame([(p["id"],) for p in prs], "id long").select("id", bucket_of(["id"], 64).alias("b"))
    place = {r.id: f"bucket={r.b}" for r in ids.collect()}
    touched = {place[prs[0]["id"]], place[prs[1]["id"]]}
    newer = [dict(p, title="retitled", updated_at="2025-01-01T00:00:00Z") for p in prs[:2]]
    _land(f"{tmp_dir}/landing", "page-100.json", newer)
    _load(store, tmp_dir)
    after = _files(store)
    assert {k for k in after if after[k] != before.get(k)} == touched and set(after) == set(before)
    assert [r.updated for r in read_loads(store).where("batch = 1").collect()] == [2]
    assert store.rows("pull_requests").where("load_batch = 1").count() == 2


def test_versions_by_time_not_by_landing(spark, tmp_dir):
    prs = _prs()
    newer = dict(prs[0], title="PROJ-12 retitled", updated_at="2024-02-01T00:00:00Z")
    older = dict(prs[2], title="ignored: older", updated_at="2023-01-01T00:00:00Z")
    store = _run(spark, tmp_dir, [prs, [newer, older]])
    got = {r["id"]: r["title"] for r in store.read("pull_requests").collect()}
    assert got[1001] == "PROJ-12 retitled" and got[1003] == prs[2]["title"]


def test_unseen_older_id_is_kept(spark, tmp_dir):
    """Pages are fetched newest first: the older page lands one run later."""
    prs = _prs()
    store = _run(spark, tmp_dir, [prs[6:], prs[3:6], prs[:3]])
    assert store.read("pull_requests").count() == 9


def test_second_landing_folder_on_one_table(spark, tmp_dir):
    prs = _prs()
    store = Warehouse(spark, f"{tmp_dir}/wh")
    _land(f"{tmp_dir}/a", "page-0.json", prs[:5])
    _land(f"{tmp_dir}/b", "page-0.json", prs[5:])
    _load(store, tmp_dir, "a", "ck-a")
    _load(store, tmp_dir, "b", "ck-b")
    assert store.read("pull_requests").count() == 9
    assert store.rows("pull_requests").select("load_stream").distinct().count() == 2


def test_reset_checkpoint_merges_again(spark, tmp_dir):
    prs = _prs()
    store = Warehouse(spark, f"{tmp_dir}/wh")
    _land(f"{tmp_dir}/a", "page-0.json", prs[:5])
    _load(store, tmp_dir, "a", "ck-1")
    _land(f"{tmp_dir}/a", "page-1.json", prs[5:])
    _load(store, tmp_dir, "a", "ck-2")  # starts at batch 0 again
    assert store.read("pull_requests").count() == 9


def test_bucket_number_of_a_written_table_stays(spark, tmp_dir):
    prs = _prs()
    store = _run(spark, tmp_dir, [prs[:5]], buckets=7)
    again = _run(spark, tmp_dir, [prs[:5], prs[5:]], buckets=32)
    assert again.buckets("pull_requests") == 7 and len(_rows(store)) == 9


@pytest.mark.parametrize("when", ["before staging", "before replacing", "while replacing"])
def test_batch_that_fails_is_replayed(spark, tmp_dir, monkeypatch, when):
    """A run that ends in the middle of a batch; the next one finishes it."""
    prs = _prs()
    store = _run(spark, tmp_dir, [prs[:5]])
    newer = [dict(p, title="again", updated_at="2025-01-01T00:00:00Z") for p in prs[:3]]
    _land(f"{tmp_dir}/landing", "page-100.json", newer + prs[5:])
    real = Warehouse.replace_buckets

    def fail(self, name, rows):
        if when == "while replacing":  # one folder is in place, another is gone
            some = sorted(r[0] for r in rows.select("bucket").distinct().collect())
            real(self, name, rows.where(F.col("bucket") == some[0]))
            gone = f"{self.path(name)}/bucket={some[-1]}".removeprefix("file:")
            os.rename(gone, f"{tmp_dir}/gone")
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        if when == "before staging":
            m.setattr(inc, "stage_load", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        else:
            m.setattr(Warehouse, "replace_buckets", fail)
        with pytest.raises(Exception, match="lost"):
            _load(store, tmp_dir)
    _load(store, tmp_dir)
    whole = _run(spark, f"{tmp_dir}/whole", [prs, newer])
    assert _rows(store) == _rows(whole)
    assert sorted((r.batch, r.inserted, r.updated) for r in read_loads(store).collect()) == [(0, 5, 0), (1, 4, 3)]


def test_replayed_batch_changes_nothing(spark, tmp_dir):
    prs = _prs()
    store = _run(spark, tmp_dir, [prs[:5], prs[3:]])
    before, loads = _rows(store), sorted(map(tuple, read_loads(store).collect()))
    write = inc.batch_writer(store, f"{tmp_dir}/ckpt", [PRS], pages=PULL_REQUEST_PAGES, landing=f"{tmp_dir}/landing")
    texts = spark.read.text(f"{tmp_dir}/landing/page-001.json").withColumn("_file", F.input_file_name())
    write(texts, 1)
    assert _rows(store) == before and sorted(map(tuple, read_loads(store).collect())) == loads


def test_empty_table_reads_typed(spark, tmp_dir):
    store = Warehouse(spark, tmp_dir)
    df = store.read("jira_links")
    assert df.count() == 0 and df.schema == schemas.JIRA_LINKS
    hw = high_watermark(store.read("pull_requests")).first()
    assert hw["high_watermark"] == dt.datetime(2000, 1, 1) and hw["high_watermark_iso"] == "2000-01-01T00:00:00Z"
    assert read_quarantine(store).count() == 0 and read_loads(store).count() == 0


# -- pages that cannot be loaded -----------------------------------------------------------------------------------

def test_cut_page_is_put_aside_and_loaded_when_whole(spark, tmp_dir):
    prs = _prs()
    store = Warehouse(spark, f"{tmp_dir}/wh")
    for n, (rows, cut) in enumerate(((prs[:3], 0), (prs[3:6], 25), (prs[6:], 0))):
        text = json.dumps(rows)
        os.makedirs(f"{tmp_dir}/landing", exist_ok=True)
        with open(f"{tmp_dir}/landing/page-{n}.json", "w") as f:
            f.write(text[:len(text) - cut])
    _load(store, tmp_dir, multi_line=True)
    got = {r[0] for r in _rows(store)}
    assert got == {p["id"] for p in prs[:3] + prs[6:]}  # no row without key, none of the cut page
    aside = read_quarantine(store).collect()
    assert [(r.reason, r.text, os.path.basename(r.file)) for r in aside] == [
        ("unparsable", json.dumps(prs[3:6])[:-25], "page-1.json")]
    with open(f"{tmp_dir}/landing/page-1-again.json", "w") as f:
        json.dump(prs[3:6], f)
    _load(store, tmp_dir, multi_line=True)
    assert {r[0] for r in _rows(store)} == {p["id"] for p in prs}
    assert sum(r.quarantined for r in read_loads(store).collect()) == 1 == read_quarantine(store).count()


@pytest.mark.parametrize("text,reason", [
    (" \n", "unparsable"), ("null", "no key"), ("<html>busy</html>", "unparsable"), ('{"message": "rate limited"}', "no key"),
    ('[{"id": 5}, {"id": "six"}]', "unparsable"), ('[{"id": 5}, null]', "no key"), ('{"id": 5} {"id": 6}', "unparsable"),
    ('[{"id": 5, "title": "a"}', "unparsable"), ("[]", None), ('﻿[{"id": 5}]\n', None)])
def test_kinds_of_pages(spark, tmp_dir, text, reason):
    os.makedirs(f"{tmp_dir}/landing")
    with open(f"{tmp_dir}/landing/p.json", "w") as f:
        f.write(text)
    store = Warehouse(spark, f"{tmp_dir}/wh")
    _load(store, tmp_dir, multi_line=True)
    aside = read_quarantine(store).collect()
    assert [(r.reason, r.text) for r in aside] == ([(reason, text)] if reason else [])
    assert [r[0] for r in _rows(store)] == ([5] if "﻿" in text else [])


def test_other_pages_that_cannot_be_loaded(spark, tmp_dir):
    """Commits, issues and changelog records: no row without key, and every text is kept."""
    from issuelens.streaming.ingest import ingest_issues, ingest_pull_requests
    cases = {
        "commits": (['{"sha": "a", "pull_request_id": 1}', '[{"sha": "b", "pull_request_id": 1}, {"sha": "c"}]', '{"sha": "d", "pull'], 2),
        "issues": (['{"issues": [{"key": "A-1", "fields": {"a": {"b": 1}}}]}', '{"errorMessages": ["busy"]}',
                    '{"issues": [{"key": "A-2", "fields": {}}, {"id": "3"}]}', '{"issues": [{"key": "A-3", "fi'], 3),
        "changelog": (['{"key": "A-1"}', '{"key": "A-1", "values": [{"id": "1", "created": "2024-01-01T00:00:00.000+0000", "items": [{"field": "status"}]}]}',
                       '{"key": "A-2", "values": [{"created": "x", "items": []}]}', '{"values": [{"id": "7", "items": []}]}', '{"key": "A-4", "val'], 3)}
    for folder, (lines, _) in cases.items():
        os.makedirs(f"{tmp_dir}/{folder}")
        with open(f"{tmp_dir}/{folder}/p.json", "w") as f:
            f.write("\n\n".join(lines) + "\n")
    os.makedirs(f"{tmp_dir}/prs")
    ingest_pull_requests(spark, f"{tmp_dir}/prs", f"{tmp_dir}/commits", f"{tmp_dir}/wh", f"{tmp_dir}/ck", multi_line=False)
    store = ingest_issues(spark, f"{tmp_dir}/issues", f"{tmp_dir}/changelog", f"{tmp_dir}/wh", f"{tmp_dir}/ck",
                          as_of="2024-02-01 00:00:00", multi_line_issues=False)
    assert [r[0] for r in _rows(store, "pull_request_commits")] == ["a"]
    assert [r[0] for r in _rows(store, "jira_issues")] == ["A-1"]
    assert [(r[0], r[1], r[5]) for r in _rows(store, "jira_changelog")] == [("1", "A-1", "status")]
    aside = {}
    for r in read_quarantine(store).collect():
        aside.setdefault(os.path.basename(r.landing), []).append(r.text)
    for folder, (lines, bad) in cases.items():
        assert sorted(aside[folder]) == sorted(lines[-bad:])


def test_changelog_items_without_field_name_survive_partitioning(spark, tmp_dir):
    from issuelens.streaming.ingest import ingest_issues
    os.makedirs(f"{tmp_dir}/issues")
    os.makedirs(f"{tmp_dir}/changelog")
    with open(f"{tmp_dir}/changelog/p.json", "w") as f:
        f.write('{"key": "A-1", "values": [{"id": "1", "items": [{"toString": "x"}, {"field": "a/b=c", "toString": "y"}]}]}\n')
    for day in ("2024-02-01", "2024-02-02"):
        store = ingest_issues(spark, f"{tmp_dir}/issues", f"{tmp_dir}/changelog", f"{tmp_dir}/wh", f"{tmp_dir}/ck-{day}", as_of=f"{day} 00:00:00")
    assert sorted((r["field"], r["to_string"]) for r in store.read("jira_changelog").collect()) == [("", "x"), ("a/b=c", "y")]
