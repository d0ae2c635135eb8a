"""N-gram Jaccard join and collision-counting search against brute force."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from issuelens.llm import collision_ann as A
from issuelens.llm.common import text_bytes
from issuelens.llm.ngram_join import _hub_links, connected, jaccard_components
from issuelens.llm.shingles import Bands, set_ids, shingle_sets, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def families(seed, bases=14, variants=12, lengths=(1, 2, 4, 6, 9, 13, 20, 40, 120)):
    rnd = random.Random(seed)
    out = []
    for _ in range(bases):
        base = [rnd.choice(["ab", "Cd", "é", "ß"]) + str(rnd.randint(0, 80)) for _ in range(rnd.choice(lengths))]
        for _ in range(variants):
            x = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5, 9])):
                if x:
                    i = rnd.randrange(len(x))
                    x[i:i + rnd.randint(0, 1)] = rnd.choice([[], [f"z{rnd.randint(0, 10 ** 6)}"]])
            out.append(rnd.choice(["", " ", "\n"]) + rnd.choice([" ", "\t", "  "]).join(x))
    return out


def brute_components(rows, k, percent):
    """(doc_id, n, component) per row; rows of one id are one document."""
    sets = [shingles(t, k) for _, t in rows]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    number = lambda i: -math.inf if i is None else i
    for a in range(len(rows)):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * union:
                x, y = root(number(rows[a][0])), root(number(rows[b][0]))
                parent[max(x, y)] = min(x, y)
    out = []
    for (i, _), s in zip(rows, sets):
        c = root(number(i)) if s else number(i)
        out.append((i, len(s), None if c == -math.inf else c))
    return out


@pytest.mark.parametrize("k,percent,seed", [(3, 90, 1), (5, 80, 2), (3, 90, 3)])
def test_join_equals_brute_force(spark, k, percent, seed):
    texts = families(seed) + [None, "", " \n ", "a", "A", "a b", "a  B", " ".join(f"w{i}" for i in range(20_000))]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    rows += [rows[5], (rows[9][0], rows[30][1]), (None, rows[12][1]), (None, "only here at all")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_shingles int, c string")
    got = [tuple(r) for r in jaccard_components(df.repartition(6), k, percent).collect()]
    assert sorted(got, key=str) == sorted(brute_components(rows, k, percent), key=str)


def test_join_of_nothing(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (2, 70)])
def test_signatures_miss_no_link(k, percent):
    texts = families(11, bases=30)
    raw, at = text_bytes(pa.array(texts))
    h, off = shingle_sets(raw, at, k)
    sets = [shingles(t, k) for t in texts]
    assert np.diff(off).tolist() == [len(s) for s in sets]
    ids = set_ids(h, off)
    who, sig = signatures(h, off, Bands(percent))
    signed = [set() for _ in texts]
    for w, s in zip(who.tolist(), sig.tolist()):
        signed[w].add(s)
    links = 0
    for a in range(len(texts)):
        for b in range(a):
            assert (ids[a] == ids[b]) == (sets[a] == sets[b])
            if sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links += 1
                assert signed[a] & signed[b]
    assert links > 30


def test_hub_links_open_what_the_bound_allows():
    import pandas as pd
    rng = np.random.default_rng(4)
    hub = set(range(100))
    members = []
    for c in range(150):
        gone = set(rng.choice(100, rng.integers(0, 30), replace=False).tolist())
        new = set((1000 + rng.integers(0, 60, rng.integers(0, 30))).tolist())
        members.append((c, (hub - gone) | new))
    up, down = 190, 10
    near = lambda a, b: len(a ^ b) * up <= (len(a) + len(b)) * down
    often = {t for n, (_, s) in enumerate(members) for t in s if any(t in o for m, (_, o) in enumerate(members) if m != n)}
    rows = pd.DataFrame([(c, len(s), near(s, hub), len(s - often), np.array(sorted((s & often) ^ hub), np.int64), True, True)
                         for c, s in members], columns=["c", "n", "linked", "alone", "diff", "a", "b"])
    parent = {c: ("hub" if near(s, hub) else c) for c, s in members}
    root = lambda x: x if parent.get(x, x) == x else root(parent[x])
    for x, y in _hub_links(rows, up, down):
        a, b = root(x), root(y)
        parent[b if a == "hub" else a] = a if a == "hub" else b
    for c, s in members:
        for d, t in members:
            if near(s, t):
                assert root(c) == root(d)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (7, 7), (200, 100)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["component"] for r in connected(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100, 200: 100}


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 24)).astype(np.float32)
    x[10:60] = x[5]  # a repeated vector: ties go to the smaller id
    rows = [(i, [float(v) for v in x[i]], 0, 1.0) for i in range(len(x))]
    odd = [(900, None, 0, 0.0), (950, [0.0] * 24, 0, 0.0), (1000, [float("nan")] * 24, 0, 0.0),
           (1050, [None] + [1.0] * 23, 0, 0.0), (1100, [float("inf")] * 24, 0, 0.0), (None, [1.0] * 24, 0, 0.0),
           (1150, [], 0, 0.0)]
    df = spark.createDataFrame(rows + odd + rows[:30], "vec_id long, embedding array<float>, label int, score double")
    got = A.nearest(df, df["vec_id"] % 50 == 0).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(by) == list(range(0, 900, 50))
    v = x.astype(np.float64)
    hits = 0
    for q in by:
        cos = (v * v[q]).sum(axis=1) / np.sqrt((v * v).sum(axis=1) * (v[q] * v[q]).sum())
        want = [i for i in np.lexsort((np.arange(900), -np.round(cos, 14))).tolist() if i != q][:5]
        found = [by[q][r] for r in range(1, 6)]
        assert all(abs(s - cos[i]) < 1e-12 for i, s in found) and found == sorted(found, key=lambda p: (-p[1], p[0]))
        hits += len(set(want) & {i for i, _ in found})
    assert [i for i, _ in by[50].values()] == [5, 10, 11, 12, 13]
    assert hits / (5 * len(by)) >= 0.9


def test_search_near_a_vector_of_a_third_of_the_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 64)).astype(np.float32).astype(np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = u @ u.T
    np.fill_diagonal(cos, -2)
    hot = 7
    asked = np.flatnonzero((cos[hot] > 0.2) & (cos[hot] < 0.45)).tolist()
    rows = [(i, v, i in asked) for i, v in enumerate(x.tolist())] + [(2000 + i, x[hot].tolist(), False) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, asked boolean")
    by = {}
    for r in A.nearest(df, df["asked"]).collect():
        by.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(by) == asked and len(asked) > 50
    copies = [hot] + list(range(2000, 3000))
    hits = 0
    for q in asked:
        every = np.concatenate([cos[q], np.full(1000, cos[q, hot])])
        want = np.lexsort((np.arange(3000), -np.round(every, 12)))[:5].tolist()
        found = [by[q][r][0] for r in range(1, 6)]
        held = [i for i in found if i in copies]
        assert held == copies[:len(held)]
        hits += len(set(want) & set(found))
    assert hits / (5 * len(asked)) >= 0.9


def test_recall_of_the_registered_query():
    import pandas as pd
    rows = pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet").rename(columns={"embedding": "vector"})
    ask = rows[rows["vec_id"] % 50 == 0]
    v = np.array(rows["vector"].tolist(), np.float64)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = A.search_block(ask, rows, 5)
    hits = 0
    for place, i in zip(np.flatnonzero(rows["vec_id"] % 50 == 0), ask["vec_id"]):
        cos = u @ u[place]
        cos[place] = -2
        hits += (got[got["query_id"] == i]["score"] >= np.sort(cos)[-5] - 1e-9).sum()
    assert hits / (5 * len(ask)) >= 0.98


def test_copies_keep_their_ids_and_ties():
    import pandas as pd
    v = [[1.0, 0.0], [0.0, 1.0], [1.0, 0.0], [1.0, 0.0], [-0.0, 1.0], [1.0, 1.0]]
    rows = pd.DataFrame({"vec_id": [9, 4, 3, 5, 2, 8], "vector": v})
    ask = pd.DataFrame({"vec_id": [3, 8], "vector": [v[2], v[5]]})
    got = A.search_block(ask, rows, 4)
    assert got[got["query_id"] == 3]["vec_id"].tolist() == [5, 9, 8, 2]
    assert got[got["query_id"] == 8]["vec_id"].tolist() == [2, 3, 4, 5]


def test_search_of_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], schema)
    got = [tuple(r)[:3] for r in A.nearest(few, few["vec_id"] == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 1)]
    none = spark.createDataFrame([], schema)
    assert A.nearest(none, none["vec_id"] % 50 == 0).count() == 0


def test_sketches_bound_differences():
    from issuelens.llm.ngram_join import CELLS, sketch
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (0, 1, 5, 300, 40_000)]
    sets += [np.unique(np.concatenate([s[: len(s) // 2], rnd.integers(0, 1 << 63, 40, dtype=np.uint64)])) for s in sets]
    off = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    table = sketch(np.concatenate(sets), off).astype(int)
    assert table.shape == (len(sets), CELLS)
    for a, s in enumerate(sets):
        for b, t in enumerate(sets):
            assert np.abs(table[a] - table[b]).sum() <= len(np.setxor1d(s, t))


def test_large_sets_that_share_a_passage_do_not_pass_the_sketches():
    import pandas as pd
    from issuelens.llm import ngram_join as J
    rng = np.random.default_rng(9)
    whole = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    passage, base = whole(200), whole(4_200)
    unrelated = [np.union1d(passage, whole(n)) for n in (1_700, 2_500, 3_000, 4_000, 5_500, 40_000)]
    sets = [*unrelated, base, np.union1d(base[:-200], whole(150)), base[:3_600]]
    off = np.cumsum([0] + [len(s) for s in sets])
    short = J.sketch(np.concatenate(sets), off)
    sized = J.sized_sketches(np.concatenate(sets), off)
    assert [len(x) for x in sized] == [256, 512, 512, 1024, 1024, 4096, 1024, 1024, 512]

    def found(sketches):
        rows = pd.DataFrame({"c": range(len(sets)), "n": [len(s) for s in sets], "sketch": sketches, "a": True, "b": True})
        return sorted(J._may_link(rows, 180, 20).tolist())

    assert found(sized) == [6, 7, 8]
    assert {1, 2, 3} <= set(found([x.tobytes() for x in short]))  # what 64 counts let through


def test_sketches_of_different_lengths_bound_differences():
    from issuelens.llm import ngram_join as J
    rng = np.random.default_rng(10)
    hot = (np.arange(700, dtype=np.uint64) << np.uint64(20)) | np.uint64(5)  # one count beyond 255
    for n in (513, 1_025, 3_000, 40_000):
        a = np.unique(np.concatenate([hot, rng.integers(0, 1 << 63, n, dtype=np.uint64)]))
        b = a[rng.random(len(a)) < 0.8]
        both = [J.sized_sketches(x, np.array([0, len(x)]))[0] for x in (a, b)]
        cells = min(map(len, both))
        x, y = (J._folded([s], cells)[0].astype(int) for s in both)
        assert (y == J.sketch(b, np.array([0, len(b)]), cells)[0]).all() and np.abs(x - y).sum() <= len(a) - len(b)


def test_signatures_of_copies_are_not_met_again(spark, monkeypatch):
    from issuelens.llm.common import Stages
    written, write = {}, Stages.write

    def counted(self, name, df):
        out = write(self, name, df)
        written[name] = out.count()
        return out

    monkeypatch.setattr(Stages, "write", counted)
    one, two = (" ".join(f"{x}{i}" for i in range(300)) for x in "ab")
    rows = [(i, one) for i in range(40)] + [(50 + i, two) for i in range(40)] + [(None, two), (None, None)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted(tuple(r) for r in got if r["doc_id"] is not None and r["doc_id"] < 50) == [(i, 296, 0) for i in range(40)]
    assert {r["component_id"] for r in got if r["doc_id"] is None or r["doc_id"] >= 50} == {None}
    # Only class two's null id stands for more than one row, whose sets differ.
    assert written["met"] == 0
