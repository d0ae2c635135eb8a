"""Conversation repair, source divergence and SimHash against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from issuelens.llm import dialogue_repair as R
from issuelens.llm import divergence as D
from issuelens.llm import simhash as S
from issuelens.llm.common import Stages
from issuelens.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SOLID = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")


# -- conversations -------------------------------------------------------------------------------------------------

def faults(rows):
    """First fault of each (role, text): b, d, t or none."""
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        out.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def ordered(rows):
    """Rows (turn, role, text) as the operator takes them."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def plain_repair(rows):
    """(cost, audit, lines) least by cost and then audit, over all edits: one label for each
    prefix of rows and end of the pattern, as whole strings."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def put(best, end, label):
        if end not in best or label < best[end]:
            best[end] = label

    def inserts(best):
        for _ in range(4):
            for end, (cost, audit, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    if role[0] in after[end]:
                        put(best, role[0], (cost + 3, audit + "I", lines + (f"{role}:",)))
        return best

    best = inserts({"": (0, "", ())})
    for (role, text), fault in zip(rows, faults(rows)):
        new = {}
        for end, (cost, audit, lines) in best.items():
            put(new, end, (cost + 4, audit + "D", lines))
            if fault in ("b", "d"):
                continue
            cut = 3 if fault == "t" else 0
            if role[:1] and role[:1] in after[end]:
                put(new, role[:1], (cost + cut, audit + "K", lines + (f"{role}:{text}",)))
            for other in ("user", "assistant"):
                if other[0] in after[end]:
                    put(new, other[0], (cost + 3 + cut, audit + "R", lines + (f"{other}:{text}",)))
        best = inserts(new)
    return min(best[end] for end in ("", "a") if end in best)


def plain_summary(rows):
    rows = ordered(rows)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(r, x) for _, r, x in rows]
    kinds = Counter(faults(pairs))
    cost, audit, lines = plain_repair(pairs)
    illegal = sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, kinds["b"], kinds["d"], kinds["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def summary(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key int, pos int")
    found, edits = R.repair(df)
    out = found.join(R.digests(edits), "key").collect()
    return {r.key: tuple(r[c] for c in COLUMNS) for r in out}


def check_repair(spark, rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by["" if c is None else f"={c}"].append((t, r, x))
    got = summary(spark, [(*r, 0, 0) for r in rows])
    assert set(got) == set(by)
    for key, own in by.items():
        assert got[key] == plain_summary(own), key


def random_rows(rnd, conv, n, roles, p_cut=0.2, p_same=0.1):
    out = []
    for t in range(n):
        text = rnd.choice(["", " ", None]) if rnd.random() < 0.08 else f"t{rnd.randrange(10 ** 6)}" + ("" if rnd.random() < p_cut else ".")
        out.append((conv, t, rnd.choice(roles), "same." if rnd.random() < p_same else text))
    return out


def test_label_costs_equal_enumeration():
    """The reference itself: all edit strings of few rows, tried one by one."""
    rnd = random.Random(1)
    for _ in range(150):
        rows = [(rnd.choice(["user", "assistant", "system", "x"]), rnd.choice(["a.", "b.", "c", " "])) for _ in range(rnd.randint(0, 3))]
        fault, best = faults(rows), None
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            for ops in itertools.product("DKRr", repeat=len(rows)):
                roles, cost, audit = "", 0, ""
                for i, n in enumerate(gaps):
                    for _ in range(n):
                        roles += "a" if roles[-1:] == "u" else "u"
                        audit, cost = audit + "I", cost + 3
                    if i < len(rows):
                        op = ops[i]
                        audit += op.upper()
                        cost += {"D": 4, "K": 0}.get(op, 3) + (3 if fault[i] == "t" and op != "D" else 0)
                        cost += 1000 if fault[i] in ("b", "d") and op != "D" else 0
                        roles += {"D": "", "K": rows[i][0][0], "R": "u", "r": "a"}[op]
                if GOOD.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
        assert best == plain_repair(rows)[:2]


def test_repair_equals_brute_force(spark):
    rnd = random.Random(2)
    rows = []
    for conv in range(60):
        roles = rnd.choice([["user", "assistant"], ["user", "assistant", "system"], ["user", None, "tool", "", "assistant"]])
        rows += random_rows(rnd, conv, rnd.choice([1, 2, 3, 5, 9, 20]), roles, rnd.choice([0, 0.3, 1]))
    rows += [(None, 3, "user", "a."), (None, None, "assistant", "b."), (None, None, "user", "c."), (None, 9, "user", "a.")]
    rows += [(500, 1, "user", "x."), (500, 1, "assistant", "y."), (500, 1, "user", "x."), (501, None, None, None)]
    rows += [(502, 0, "user", "w " * 50_000 + "."), (502, 1, "assistant", "w " * 50_000)]
    check_repair(spark, rows)


@pytest.mark.parametrize("roles,chunk,passes,fan", [
    (["user", "assistant"], 4, 4, 1024), (["user", "assistant", "system", "tool"], 3, 2, 4), (["tool", None], 5, 1, 3)])
def test_long_conversations_are_cut_into_chunks(spark, monkeypatch, roles, chunk, passes, fan):
    """Chunks, fix-up passes, the tree of effects and its several levels."""
    monkeypatch.setattr(R, "CHUNK", chunk)
    monkeypatch.setattr(R, "PASSES", passes)
    monkeypatch.setattr(R, "FAN", fan)
    rnd = random.Random(chunk)
    rows = [r for conv, n in enumerate((40, 61, 17, 3, 90)) for r in random_rows(rnd, conv, n, roles, 0.2, 0.05)]
    rows += [(9, t, "user", "same.") for t in range(50)]  # only the first is no repeat: costs are not forgotten
    check_repair(spark, rows)


def test_effects_are_those_of_runs():
    rnd = random.Random(5)
    for _ in range(200):
        one, two = (bytes(48 + rnd.randrange(9) for _ in range(rnd.randint(0, 6))) for _ in range(2))
        v = list(R.END)
        assert R.after_effect(R.effect(one), v) == list(R.run_back(one, tuple(v)) if one else R.level(R.END))
        both = R.joined_effects(R.effect(two), R.effect(one))
        assert R.after_effect(both, v) == R.after_effect(R.effect(one + two), v)


def plain_damage(rows):
    out = []
    for c, t, r, x in rows:
        sign = lambda v: " " if v is None else str(v)
        r, x = sign(r), sign(x)
        fate = zlib.crc32(f"{sign(c)}:{sign(t)}".encode()) % 20
        if fate == 1:
            x = ""
        if fate == 2:
            x = re.sub("[.!?]", "", x)
        out += [(c, t, "user" if fate == 4 else r, x)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def test_repair_query(spark, tmp_dir):
    rnd = random.Random(7)
    rows = [r for conv in range(150) for r in random_rows(rnd, conv, rnd.randint(1, 8), ["user", "assistant", "system"])]
    rows += [(None, None, None, None), (None, 1, "user", "a."), (7, None, "user", "b.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_dir}/conversations.parquet")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_conversation_repair"](spark, tmp_dir).collect()}
    by = defaultdict(list)
    for c, t, r, x in plain_damage(rows):
        by[c].append((t, r, x))
    assert set(got) == {r[0] for r in rows}
    for c, value in got.items():
        assert value == plain_summary(by[c]), c


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found, edits = R.repair(df)
    assert found.collect() == [] and R.digests(edits).collect() == []


# -- divergence ----------------------------------------------------------------------------------------------------

def plain_divergence(rows, min_docs=10, top=10):
    texts, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        own = Counter(TERM.findall((text or "").translate(LOWER)))
        counts[lang, source].update(own)
        texts[lang].update(own.keys())
    out = []
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in texts[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        every = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        share = lambda n, total: 1 + 10 ** 9 * (n + 2) // (total + 2 * len(kept))
        p = {s: [share(counts[lang, s][t], sum(counts[lang, s][u] for u in kept)) for t in kept] for s in sources}
        q = [share(every[t], sum(every.values())) for t in kept]
        for s in sources:
            pairs = sorted((-sum(map(gap, p[s], p[o])), o.encode()) for o in sources if o != s)
            said = sorted((-gap(a, b), t.encode()) for t, a, b in zip(kept, p[s], q) if counts[lang, s][t] and a > b)[:top]
            for part, found in (("pair", pairs), ("term", said)):
                out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)]
    return sorted(out)


def corpus(seed=3, n=500):
    rnd = random.Random(seed)
    vocabulary = [rnd.choice("abcdeÉß") + rnd.choice("xyzW") + rnd.choice("klm中") for _ in range(150)]
    rows = []
    for _ in range(n):
        words = [rnd.choice(vocabulary) + rnd.choice(["", ",", "3", "-"]) for _ in range(rnd.randint(0, 60))]
        rows.append((rnd.choice(["de", "fr", None]), rnd.choice([None, "s1", "s2", "é", "z", "q", "k"]),
                     rnd.choice([None, "", " ".join(words), "\x00".join(words)])))
    return rows + [("xx", "a", None), ("xx", "b", "one two"), ("yy", "only", "a b c"), ("de", "s1", "word " * 30_000)]


@pytest.mark.parametrize("block,size,held", [(64, 1 << 14, 1 << 18), (2, 50, 30)])
def test_divergence_equals_brute_force(spark, monkeypatch, block, size, held):
    monkeypatch.setattr(D, "BLOCK", block)
    monkeypatch.setattr(D, "TERMS", size)
    monkeypatch.setattr(D, "HELD", held)
    rows = corpus()
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, source string, text string, term string").repartition(5)
    assert sorted(tuple(r) for r in D.divergence(df).collect()) == plain_divergence(rows)


def test_divergence_of_one_term_and_of_nothing(spark):
    rows = [("en", s, "Word") for s in ("a", "b") for _ in range(6)] + [("en", "c", "rare")]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(tuple(r) for r in D.divergence(df).collect()) == plain_divergence(rows)
    assert D.divergence(df.limit(0)).collect() == []


def test_shares_are_exact_for_large_counts(spark):
    from pyspark.sql import functions as F
    rows = [(c, n) for n in (3, 10 ** 9 + 7, 10 ** 15 + 37) for c in (2, n // 3, n - 1, n)]
    df = spark.createDataFrame(rows, "c long, n long").select("c", "n", D.share(F.col("c"), F.col("n")).alias("p"))
    assert all(r.p == 1 + 10 ** 9 * r.c // r.n for r in df.collect())


# -- simhash -------------------------------------------------------------------------------------------------------

def plain_fingerprint(text, k=3):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keys, prints):
    parent = {k: k for k in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(keys)):
        for b in np.flatnonzero(np.bitwise_count(prints[:a] ^ prints[a]) <= 2):
            x, y = root(keys[a]), root(keys[b])
            parent[max(x, y)] = min(x, y)
    return [root(k) for k in keys]


def test_simhash_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for base in range(25):
        words = [rnd.choice("abcdeÉ") + str(rnd.randrange(50)) for _ in range(rnd.choice([1, 2, 3, 4, 8, 60, 300]))]
        for _ in range(rnd.randint(1, 6)):
            own = [w.upper() if rnd.random() < 0.2 else w for w in words]
            if rnd.random() < 0.5:
                own[rnd.randrange(len(own))] = f"n{rnd.randrange(9)}"
            rows.append((len(rows) * 7 % 991, rnd.choice([" ", "\t", " \n"]).join(own)))
    rows += [(2000, None), (2001, ""), (2002, " \x0b"), (2003, "w " * 30_000), (2004, "W\t" * 30_000), rows[3], (rows[4][0], rows[40][1]),
             (None, rows[12][1]), (None, "only here")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.fingerprint, r.component_id) for r in S.simhash_components(df).collect())
    prints = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    keys = [-1 if i is None else i for i, _ in rows]
    roots = plain_components(keys, prints)
    want = sorted(((i is not None, i or 0), f"{int(p):016x}", None if c < 0 else c) for (i, _), p, c in zip(rows, prints, roots))
    assert got == want


@pytest.mark.parametrize("parts,crowd", [(3, 128), (2, 128), (4, 128), (3, 8), (2, 40), (3, 0)])
def test_links_of_dense_clusters(spark, monkeypatch, parts, crowd):
    """Clusters of many distinct fingerprints, biased bits, and the way around them."""
    monkeypatch.setattr(S, "CROWD", crowd)
    rnd = random.Random(parts)
    prints = {0, 1, 3, (1 << 64) - 1, 1 << 63}
    for bits in (4, 9, 9, 20):
        base, loose = rnd.getrandbits(64), rnd.sample(range(64), bits)
        prints |= {base ^ sum(1 << b for b in loose if rnd.random() < 0.5) for _ in range(150)}
    prints |= {rnd.getrandbits(64) & rnd.getrandbits(64) & rnd.getrandbits(64) for _ in range(200)}
    signed = sorted(int(np.uint64(p).view(np.int64)) for p in prints)
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = S.near_fingerprints(fps, Stages(spark), parts).collect()
    assert all(((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 2 for r in links)
    parent = {p: p for p in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        x, y = root(r.u), root(r.v)
        parent[max(x, y)] = min(x, y)
    assert [root(p) for p in signed] == plain_components(signed, np.array(signed).view(np.uint64))


def test_thresholds_are_the_cheapest():
    rnd = np.random.default_rng(1)
    for parts, total in ((2, 1), (3, 0), (4, -1)):
        costs = np.cumsum(rnd.integers(1, 100, (parts, 4, 50)), axis=1) * 1.0
        costs[:, 0] = 0
        taus, cost = S.allocate(costs, total)
        assert (taus.sum(axis=0) == total).all()
        for n in range(50):
            best = min(sum(costs[i, t + 1, n] for i, t in enumerate(ts)) for ts in itertools.product(range(-1, 3), repeat=parts) if sum(ts) == total)
            assert cost[n] == best == sum(costs[i, t + 1, n] for i, t in enumerate(taus[:, n]))


def test_simhash_of_nothing(spark):
    assert S.simhash_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_fingerprint_hash_is_the_one_of_spark(spark):
    from pyspark.sql import functions as F
    text = "Words, Ünïcode, 中文"
    h = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert int(S.shingle_hashes(text.encode(), 9).view(np.int64)[0]) == spark.range(1).select(
        F.xxhash64(F.lit(text.translate(LOWER)))).first()[0] != h
