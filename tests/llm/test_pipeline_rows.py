"""All rows of the pipeline's run() against the stages done plainly, one after the other."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece

import corpus_pipeline
from issuelens.llm import quality_rules as Q
from issuelens.llm.queries import tokenizer_path
from test_duplicates_and_search import brute_components
from test_text_operators import brute_base, brute_line_dedup, brute_mix

FIELDS = ("doc_id", "text", "lang", "source", "n_chars")


def plain_quality(rows):
    """Limits, then a covariance determinant estimate per source from exact distances."""
    base = [brute_base(r[1]) for r in rows]
    upper = [sum("A" <= c <= "Z" for c in r[1] or "") for r in rows]
    nw = np.maximum([b[0] for b in base], 1.0)
    chars = np.maximum([b[1] for b in base], 1.0)
    x = np.stack([np.log(chars / nw), np.log1p(10 * np.array([b[2] for b in base]) / nw), np.log1p(100 * np.array([b[3] for b in base]) / nw),
                  np.log1p(10 * np.array([b[4] for b in base]) / nw), np.log1p(10 * np.array(upper) / chars)], axis=1)
    floors = np.array(Q.FLOORS)
    kept = np.zeros(len(rows), bool)
    for s in {r[3] for r in rows}:
        mine = np.array([i for i, r in enumerate(rows) if r[3] == s and not base[i][5]], int)
        assert len(mine) >= Q.MIN_GROUP
        z = x[mine]
        spread = (np.quantile(z, 0.75, axis=0) - np.quantile(z, 0.25, axis=0)) / 1.349
        d2 = (((z - np.median(z, axis=0)) ** 2) / (spread ** 2 + floors ** 2)).sum(axis=1)

        def distances(part, factor):
            c = np.cov(z[part].T, bias=True) * factor + np.diag(floors ** 2)
            d = z - z[part].mean(axis=0)
            return np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)
        for _ in range(Q.STEPS):
            d2 = distances(np.argsort(d2, kind="stable")[:int(len(z) * Q.PART)], Q.CONSISTENCY)
        d2 = distances(d2 <= Q.REWEIGHT_AT, Q.REWEIGHTED)
        assert not ((d2 > Q.REJECT_AT / 2) & (d2 < Q.REJECT_AT * 2)).any()  # clear cases only: the two estimates differ a little
        kept[mine] = d2 <= Q.REJECT_AT
    return [r for r, k in zip(rows, kept) if k]


def plain_mix(rows):
    total, target = brute_mix(rows)
    mark = lambda r: int(hashlib.md5(f"{r[0]}|{hashlib.md5((r[1] or '').encode()).hexdigest()}".encode()).hexdigest()[:15], 16) >> 20
    out = []
    for s in total:
        mine = sorted((r for r in rows if r[3] == s), key=mark)
        whole = int(target[s] // total[s]) if total[s] else 0
        left, upto, more = target[s] - whole * total[s], 0, 0
        for n, r in enumerate(mine):
            size = brute_base(r[1])[0]
            if left > 0 and upto + size > left:
                more = n + (size - (left - upto) < left - upto)
                break
            upto += size
        for n, r in enumerate(mine):
            out += [r] * (whole + (n < more))
    return out


def documents():
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(12) for _ in range(6)]
    texts = []
    for n in range(200):
        lines = [prose(rnd.randint(15, 60)) for _ in range(rnd.randint(1, 4))]
        if rnd.random() < 0.3:
            lines.insert(rnd.randrange(len(lines) + 1), rnd.choice(shared))
        texts.append("\n".join(lines))
    for n in range(40):  # exact and near copies
        words = texts[rnd.randrange(60)].split(" ")
        if n % 2:
            words[rnd.randrange(len(words))] = word()
        texts.append(" ".join(words))
    texts += [" ".join(word() + "###" for _ in range(80)) for _ in range(8)]    # outliers
    texts += [None, "", " \n", "too short", "la la la la la la " * 9]          # limits
    texts += [prose(30_000), "\n".join([prose(20)] * 2 + [shared[0].upper()])]
    return [(i * 3 + 1, t, "en", "ab"[i % 2] if i % 5 else "c", len(t or "")) for i, t in enumerate(texts)]


def test_run_equals_plain_stages(spark, tmp_dir):
    rows = documents()
    pq.write_table(pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(zip(
        FIELDS, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())))}), f"{tmp_dir}/documents.parquet")
    kept = plain_quality(rows)
    assert 5 < len(rows) - len(kept) < 40
    lines = [(i, t, *r[2:]) for r, (i, t, _, _) in zip(kept, brute_line_dedup(kept))]
    assert sum(a[1] != b[1] for a, b in zip(kept, lines)) > 20
    comps = brute_components([(r[0], r[1]) for r in lines], 5, 80)
    near = [r for r, (i, n, c) in zip(lines, comps) if c == i]
    assert 20 < len(lines) - len(near) < 60
    mixed = plain_mix(near)
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    ids = [lib.encode(r[1] or "", add_eos=True) for r in mixed]
    want = [(r[0], r[2], r[3], tuple(i), lib.decode(i)) for r, i in zip(mixed, ids)]
    out = corpus_pipeline.run(spark, tmp_dir)
    got = [(r["doc_id"], r["lang"], r["source"], tuple(r["ids"]), r["decoded"]) for r in out.collect()]
    assert sorted(got) == sorted(want)
