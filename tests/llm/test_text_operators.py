"""Line dedup, quality rules, mixing and URL rules against plain Python."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from issuelens.operators.stage import materialize
from issuelens.llm import line_dedup, mixing, quality_rules as Q, url_filters as U
from issuelens.llm.queries import SITE_RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept int, h1 int"
LONG = " ".join(f"w{i}" for i in range(30_000))


def rows_of(texts, langs=("en", "de", None), sources=("a", "b", "c", None)):
    """Rows with nulls, ties, repeated rows and columns that clash with results."""
    out = [(i, t, langs[i % len(langs)], sources[i % len(sources)], 1, "x", 0, 0) for i, t in enumerate(texts)]
    return out + [out[3], (None, "a b c", None, None, None, None, None, None), (None, None, "en", "a", 0, None, 1, 1)]


def texts(seed=1, n=60):
    rnd = random.Random(seed)
    line = lambda: " ".join(rnd.choice(["Alpha", "beta", "gämma", "x#y", "the"]) + str(rnd.randint(0, 99))
                            for _ in range(rnd.randint(1, 14)))
    common = [line() + " padding to make this line long enough" for _ in range(6)]
    out = [None, "", "\n", " \t ", "one", LONG]
    while len(out) < n:
        out.append("\n".join(rnd.choice([line(), rnd.choice(common), "  " + rnd.choice(common).upper() + "\t"])
                             for _ in range(rnd.randint(1, 12))))
    return out


def brute_line_dedup(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    number = lambda i: -1 if i is None else i
    docs = collections.defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs[key(line)].add(number(r[0]))
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if len(docs[key(x)]) < min_docs or number(r[0]) == max(docs[key(x)])]
        out.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_line_dedup_equals_brute_force(spark):
    rows = rows_of(texts())
    out = line_dedup.line_dedup(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert set(out.columns) == set(SCHEMA.replace(",", "").split()[::2]) | {"n_lines", "n_dropped"}
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()]
    key = lambda r: (str(r[0]), r[1])
    assert sorted(got, key=key) == sorted(brute_line_dedup(rows), key=key)
    assert any(r[3] for r in got)


def test_line_dedup_of_nothing(spark):
    assert line_dedup.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    base = (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))
    return base + (base[0] < 10 or 100 * base[4] > 20 * base[0],)


def test_quality_base_counts_equal_brute_force(spark):
    some = [*texts(2), "a b c d e f a b c d e x a b c d e", "x x x x x x x x x x x", "la la la la la la " * 9,
            "p q\np q\n\n \np q\nr"]
    rows = rows_of(some)
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in Q.base_statistics(df, "text", "s_").select(
        "text", *["s_" + b for b in Q.BASE], "s_base_failed").collect()]
    want = [(r[1], *brute_base(r[1])) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_quality_estimate_equals_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5)) * 300)
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "g string, " + ", ".join(f"{c} double" for c in Q.X))
    est = Q._estimate(Q._moments(df, ["g"]), 1.0)
    got = np.array([r[0] for r in df.join(est, "g").orderBy(*Q.X).select(Q._distance()).collect()])
    cov = np.cov(x.T, bias=True) + np.diag((np.array(Q.FLOORS) * Q.GRAIN) ** 2)
    d = x - x.mean(axis=0)
    want = np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)[np.lexsort(x.T[::-1])]
    assert np.allclose(got, want, rtol=1e-8)


def test_quality_rejects_outliers_only(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    good = [" ".join(word() for _ in range(rnd.randint(30, 200))) for _ in range(150)]
    bad = [" ".join(word() + "###" for _ in range(80)) for _ in range(20)]
    rows = [(i, t, "en", "s", 1, "", 0, 0) for i, t in enumerate(good + bad)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = {r["doc_id"]: r["kept"] for r in Q.score_rows(df).collect()}
    assert [kept[i] for i in range(170)] == [True] * 150 + [False] * 20
    out = Q.quality_rules(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == list(range(150))


def test_quality_of_odd_rows(spark):
    rows = rows_of(texts(4))
    df = spark.createDataFrame(rows, SCHEMA)
    out = Q.quality_rules(df)
    assert out.columns == df.columns and 0 < out.count() < len(rows)
    assert Q.score_rows(df).count() == len(rows)
    assert Q.quality_rules(df.limit(0)).count() == 0


def brute_mix(rows):
    size = lambda r: len(WORD.findall(r[1] or ""))
    total = collections.Counter()
    for r in rows:
        total[r[3]] += size(r)
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    capped, level = set(), 0.0
    while True:  # share what capped sources leave
        free = [s for s in order if s not in capped]
        if not free:
            break
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if 2 * total[s] < level * weight[s]}
        if not over:
            break
        capped |= over
    target = {s: 2.0 * total[s] if s in capped else level * weight[s] for s in order}
    return total, target


def test_mix_targets_and_takings(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join("w" for _ in range(rnd.randint(0, 60))) + f" {i}", None, rnd.choice(["a", "b", "c", "é", None]),
             1, "x", 2, 3) for i in range(2000)] + [(5, None, None, "z", 0, None, 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    total, target = brute_mix(rows)
    out = mixing.mix_sources(df)
    assert set(out.columns) == set(df.columns) | {"size", "source_size", "target", "copies"}
    got = out.collect()
    assert len(got) == len(rows)
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == total[r["source"]] and math.isclose(r["target"], target[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["size"] * r["copies"]
    assert all(abs(taken[s] - target[s]) <= 61 for s in target)
    again = {(r["doc_id"], r["text"]): r["copies"] for r in mixing.mix_sources(df.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["text"]): r["copies"] for r in got}
    # the picked documents are those before one threshold in hash order
    mark = lambda r: hashlib.md5(
        f"{r['doc_id']}|{hashlib.md5((r['text'] or '').encode()).hexdigest()}".encode()).hexdigest()
    for s in ("a", "b", "c"):
        picked = [r["copies"] for r in sorted((r for r in got if r["source"] == s), key=mark)]
        assert picked == sorted(picked, reverse=True)


def test_mix_of_odd_tables(spark):
    odd = mixing.mix_sources(spark.createDataFrame(rows_of(texts(6)), SCHEMA))
    assert odd.count() == len(rows_of(texts(6))) and odd.where("copies is null").count() == 0
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = mixing.mix_sources(spark.createDataFrame([(1, None, None, None, 0, "", 0, 0)], SCHEMA)).first()
    assert (blank["size"], blank["target"], blank["copies"]) == (0, 0.0, 0)


def test_mix_repeats_empty_texts_of_a_capped_source_twice_at_most(spark):
    rows = [(i, ("", " \n", None)[i % 3], None, "a", 0, "x", 0, 0) for i in range(200)]
    rows += [(200, "one two three", None, "a", 0, "x", 0, 0)]
    rows += [(i, "w " * 50, None, "b", 0, "x", 0, 0) for i in range(300, 340)]
    got = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).where("source = 'a'").collect()
    assert {r["target"] for r in got} == {6.0} and {r["copies"] for r in got} == {2}


URLS = [None, "", "nonsense", "http://Example.COM/en/x", "https://www.example.com/en/1?x=/en/", "http://a.net/es/#f",
        "http://a.net/ES/", "http://net/fr/1", "http://notnet/fr/", "http://x.com", "http://x.com?y", "http://x.com/",
        "https://u@b.example.com/en/", "http://spam-farm.org/x", "http://a.spam-farm.example.org/", "ftp://casino.org/",
        "http://h.org/a/ads/b", "http://h.org/adsx/", "http://ünï.example.com/en/ü", "http://a.org/://b.com/",
        "http://a.net/es/\nx", "http://h.org/" + "a/" * 5000 + "ads/"]


def brute_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    fits = []
    for r in SITE_RULES:
        h, _, p = r.name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(r)
    best = max(fits, key=lambda r: len(r.name), default=None)
    blocked = any(re.search(p.pattern, host + path) for p in U.DEFAULT_PATTERNS)
    return host, path, best and best.name, best.action if best else "block" if blocked else "allow"


@pytest.mark.parametrize("repeat", [1, 40])
def test_url_rules_equal_brute_force(spark, repeat):
    rows = [(n, u, "h", "p") for n, u in enumerate(URLS * repeat)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, extra string").repartition(4)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.url_filter(df, SITE_RULES).collect()}
    assert got == {n: brute_url(u) for n, u, *_ in rows}


def test_url_rules_without_tokens(spark):
    df = spark.createDataFrame([(1, "http://a.org/zz9")], "page_id long, url string")
    rule = U.PatternRule("block", r"z+9$")
    assert U.url_filter(df, (), (rule,)).first()["verdict"] == "block"
    assert U.url_filter(df.limit(0), SITE_RULES).count() == 0


def test_native_operators_use_no_python(spark):
    df = spark.createDataFrame(rows_of(texts(1, 12)), SCHEMA).coalesce(2)
    path = materialize(df, "native-test")
    for out in (line_dedup.line_dedup(path), Q.quality_rules(path)):
        plan = out._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
