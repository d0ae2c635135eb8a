"""Latest versions kept in a stream's state."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from issuelens.sources.tables import Warehouse
from issuelens.streaming import incremental as inc

RAW = "id long, version long, body string"
LOAD = inc.Load("things", lambda rows: rows.select("id", "version", "body"), ["id"], ["version", "body"], version_col="version")


def _setup(spark, root):
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(RAW)
    load = inc.replace(LOAD, schema=schema)
    return Warehouse(spark, f"{root}/wh", 8), schema, load


def _land(root, n, rows):
    os.makedirs(f"{root}/landing", exist_ok=True)
    with open(f"{root}/landing/{n:03d}.json", "w") as f:
        f.writelines(json.dumps(dict(zip(("id", "version", "body"), r))) + "\n" for r in rows)


def _newest(rows):
    best = {}
    for r in rows:
        if r[0] is not None and (r[0] not in best or r[1:] > best[r[0]][1:]):
            best[r[0]] = r
    return sorted(best.values())


def _files(seed, n=6):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(40), rnd.randrange(30), rnd.choice("xyz")) for _ in range(300)]
    files = [rows[i::n] for i in range(n)]
    files[2] += files[0][:20]                                     # landed again
    files[3] += [(k, -5, "late") for k in range(20)]              # late, older than all
    files[4] += [(None, 3, "no key"), (100, 1, "a"), (100, 1, "b")]
    return files


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_replays_late_and_unordered_versions(spark, tmp_dir, per_trigger):
    store, schema, load = _setup(spark, tmp_dir)
    files, seen = _files(1), []
    for n, rows in enumerate(files):
        _land(tmp_dir, n, rows)
        seen += rows
        if n % 2:
            inc.run_latest(spark, f"{tmp_dir}/landing", store, schema, load, f"{tmp_dir}/ck", per_trigger)
            assert sorted(map(tuple, store.read("things", schema).collect())) == _newest(seen)


def test_restart_in_the_middle_of_a_batch(spark, tmp_dir, monkeypatch):
    store, schema, load = _setup(spark, tmp_dir)
    files = _files(2)
    for n, rows in enumerate(files[:3]):
        _land(tmp_dir, n, rows)
    run = lambda: inc.run_latest(spark, f"{tmp_dir}/landing", store, schema, load, f"{tmp_dir}/ck", 1)
    run()
    for n, rows in enumerate(files[3:]):
        _land(tmp_dir, n + 3, rows)
    real, calls = Warehouse.replace_buckets, []

    def fail(self, name, rows):
        calls.append(name)
        if len(calls) == 2:
            real(self, name, rows.where(F.col("bucket") % 2 == 0))
            raise RuntimeError("lost")
        real(self, name, rows)
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "replace_buckets", fail)
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    assert sorted(map(tuple, store.read("things", schema).collect())) == _newest(sum(files, []))


def test_only_changed_keys_leave_the_state(spark, tmp_dir):
    """A batch of one key writes that key's bucket, whatever has landed before."""
    store, schema, load = _setup(spark, tmp_dir)
    _land(tmp_dir, 0, [(k, 1, "a") for k in range(50)])
    run = lambda: inc.run_latest(spark, f"{tmp_dir}/landing", store, schema, load, f"{tmp_dir}/ck")
    run()
    _land(tmp_dir, 1, [(7, 2, "b"), (7, 0, "c")])
    run()
    assert [tuple(r) for r in store.rows("things", schema).where("load_batch = 1").select("id", "version", "body").collect()] == [(7, 2, "b")]
