"""Encoding, token files, language id, quality classifier and the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from issuelens.llm import cotraining as C, language_id as L, range_coder as R, token_files as W
from issuelens.llm.piece_bpe import PrefixEncoder, encode_texts, merge_all
from issuelens.operators.stage import materialize

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "  two  spaces ", "\n\t", "▁", "a▁b", "ａﬁ", "執 🙂 梦\x00", "</s> <unk> <0x41>", "a" * 3000,
       "the " * 4000, "no-break space and thin", "<|endoftext|> x <|endoftext|>", "don't we'll 1,234.5 !!??",
       "tab\tx  y   z    w", "x y  z", "é ß ÷ × ñ", " lead", "trail "]


def randomized(seed, n):
    rnd = random.Random(seed)
    letters = "abcdeghinorst ehr    \n\t▁éß梦🙂.,'1"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_prefix_tables_equal_library():
    enc, lib = PrefixEncoder(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for t in [t or "" for t in ODD] + randomized(1, 3000):
        assert enc.encode(t).tolist() == lib.encode(t, add_eos=True), t


def test_compatibility_is_merging_from_scratch():
    enc = PrefixEncoder(PIECES)
    rnd = random.Random(2)
    tokens = [t for t in enc.cost if 1 < len(t) < 6 and merge_all(list(t), enc.cost) == [t]]
    for _ in range(3000):
        a, b = rnd.choice(tokens), rnd.choice(tokens)
        assert enc.compatible(a, b) == (merge_all([*a, *b], enc.cost) == [a, b])


def test_encoding_rows(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(0, ODD[3], None, 2), (None, "b", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, extra int")
    out = encode_texts(df.repartition(3), PIECES, carry=["doc_id", "ids", "extra", "text"])
    assert out.columns == ["doc_id", "extra", "text", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        ids = lib.encode(r["text"] or "", add_eos=True)
        assert (r["ids"], r["decoded"]) == (ids, lib.decode(ids))
    assert encode_texts(df.limit(0), PIECES).count() == 0


def test_worker_tables_stay_small(monkeypatch):
    enc = PrefixEncoder(PIECES)
    monkeypatch.setattr(enc, "stretch", lambda s: b"\0\0\0\0")
    for a in range(0, 250_000, 1000):
        enc.encode(" ".join(f"w{i}" for i in range(a, a + 1000)))
        assert len(enc.known) + len(enc.older) <= 200_000


@pytest.mark.parametrize("before, after", [("10000", 1000), ("0", 1000), ("7", 7)])
def test_arrow_batches_of_whole_texts_are_small(spark, before, after):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, before)
    try:
        out = encode_texts(spark.range(2500).selectExpr("id AS doc_id", "'a b' AS text").coalesce(1), PIECES)
        assert int(spark.conf.get(name)) == after
        assert out.count() == 2500
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize("n", [0, 1, 7, R.BLOCK - 1, R.BLOCK, R.BLOCK + 1, 3 * R.BLOCK + 11])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, R.MAX_ID, n), rng.zipf(1.2, n) % 50_000, np.full(n, 65_535), np.zeros(n, int)):
        blocks = R.encode(ids)
        assert len(blocks) == -(-n // R.BLOCK)
        assert (R.decode(blocks, n) == ids).all()


def test_coder_predicts_and_checks():
    ids = np.tile(np.arange(300) * 7 % 5000, 40)
    blocks = R.encode(ids)
    assert sum(map(len, blocks)) < 0.5 * 2 * len(ids)
    # a block can be read alone
    assert (R.decode([blocks[1]], R.BLOCK) == ids[R.BLOCK:2 * R.BLOCK]).all()
    broken = bytearray(blocks[0])
    broken[100] ^= 8
    with pytest.raises(ValueError):
        R.decode([bytes(broken), *blocks[1:]], len(ids))
    with pytest.raises(ValueError):
        R.encode([R.MAX_ID])


def test_stretches_equal_library():
    tok, lib = W.StretchTokenizer(BYTES), Tokenizer.from_file(BYTES)
    texts = [t or "" for t in ODD] + randomized(5, 2000)
    for t, ids in zip(texts, tok.encode(texts, 0)):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids + [0], t


def test_stretches_of_mixed_characters_equal_library():
    tok, lib = W.StretchTokenizer(BYTES), Tokenizer.from_file(BYTES)
    rnd = random.Random(13)
    parts = [*"abcXYZ  \n\n\t'’.,!?-_019×÷éǅɏɐ梦🙂\u0301\x1c\x00\x7f\x85\u00a0\u2003²٣\r\x0b", "'s", "'ll", " The",
             "<|endoftext|>", "<|end", "oftext|>", "  ", " \n", "\r\n", " '"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    for t, ids in zip(texts, tok.encode(texts, 0)):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids + [0], t
    assert tok.encode([], 0) == []


def test_known_words_go_to_the_library_once():
    tok, lib = W.StretchTokenizer(BYTES), Tokenizer.from_file(BYTES)
    asked = []

    class Library:
        def encode_batch_fast(self, texts, **options):
            asked.append(sum(map(len, texts)))
            return lib.encode_batch_fast(texts, **options)

    tok.library = Library()
    words = [f"{a}{b}{c}" for a in ("xo", "qua", "ler") for b in ("min", "dro", "vex") for c in ("a", "ik", "ost")]
    tok.encode(["in " + " ".join(words)], 0)
    first = sum(asked)
    texts = [" " + f"{sign} ".join(words) for sign in (".", ",", "!", ").")]
    got = tok.encode(texts, 0)
    assert sum(asked) - first < 60
    assert [g.tolist() for g in got] == [lib.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def test_coder_cuts_passes_evenly(monkeypatch):
    monkeypatch.setattr(R, "LANES", 4)
    sizes, whole = [], R._encode_lanes
    monkeypatch.setattr(R, "_encode_lanes", lambda ids, lanes: sizes.append(lanes) or whole(ids, lanes))
    ids = np.random.default_rng(1).zipf(1.3, 9 * R.BLOCK + 5) % 50_000
    assert (R.decode(R.encode(ids), ids.size) == ids).all()
    assert sizes == [5, 5]


def test_token_files(spark, tmp_dir):
    lib = Tokenizer.from_file(BYTES)
    rows = [(i * 37 % 101 - 5, t, "docs") for i, t in enumerate(ODD + randomized(6, 80))] + [(None, "x", "y"), (3, "b", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    W.write_token_files(df, f"{tmp_dir}/ids", BYTES)
    got = W.read_token_files(spark, f"{tmp_dir}/ids").collect()
    want = sorted((r[0] is not None, r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for r in rows
                  for ids in [lib.encode(r[1] or "", add_special_tokens=False).ids + [0]])
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered]).tolist()[:-1]
    ids = [r["doc_id"] for r in ordered]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    W.write_token_files(df.limit(0), f"{tmp_dir}/none", BYTES)
    assert W.read_token_files(spark, f"{tmp_dir}/none").count() == 0


def test_phrases_equal_brute_force():
    rnd = random.Random(8)
    text = lambda n: "".join(rnd.choice("abc  ,é") for _ in range(n)).encode()
    samples = {"x": text(300), "y": text(200).replace(b"a", b"c")}
    model = L.build_automata(samples)
    queries = [b"", b"a", text(50), text(1500), b"zzz", b"q a q"]
    raw = np.frombuffer(b"".join(queries), np.uint8)
    at = np.cumsum([0] + [len(q) for q in queries])
    got = L.count_phrases(model, raw, at)
    fold = lambda b: [int(model.classes[c]) for c in b]
    for col, lang in enumerate(model.langs):
        sample = [int(model.classes[c]) for c in L._folded(np.frombuffer(samples[lang], np.uint8))]
        known = {tuple(sample[i:j]) for i in range(len(sample)) for j in range(i + 1, min(i + 40, len(sample)) + 1)}
        for row, q in enumerate(queries):
            phrases = 0
            for start in range(0, len(q), L.RUN):
                current = ()
                for c in fold(q[start:start + L.RUN]):
                    begin = not current
                    if current + (c,) in known:
                        current += (c,)
                    else:
                        begin, current = True, ((c,) if (c,) in known else ())
                    phrases += begin and c != 1
            assert got[row, col] == phrases


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    out = L.identify(docs).withColumn("held", L.fold("doc_id") == 1)
    rows = out.where("held and lang is not null").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    rows = [(1, None, "en", 1), (2, "", "en", 1), (3, "123 ,.", "de", 1), (4, "the cat sat on the mat", "en", 1),
            (None, "die katze saß auf der matte", "de", 1), (4, "the cat sat on the mat", "en", 1), (6, "梦", None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred int")
    model = L.learn(df, "text", "lang", "doc_id")
    got = {r["text"]: r["lang_pred"] for r in L.predict(df, model).collect()}
    assert [got[r[1]] for r in rows[:5]] == ["und", "und", "und", "en", "de"]
    none = L.learn(df.limit(0), "text", "lang", "doc_id")
    assert {r["lang_pred"] for r in L.predict(df, none).collect()} == {"und"}
    assert L.predict(df.limit(0), model).count() == 0


def test_co_training_learns_from_the_other_view():
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 1500)
    a = (y[:, None] + rng.normal(0, 0.8, (1500, 4))).astype(np.float32)
    b = (y[:, None] + rng.normal(0, 0.8, (1500, 4))).astype(np.float32)
    label = np.where(np.arange(1500) < 60, y, -1)
    model = C.co_train(a, b, label)
    p = model.score(a, b)[2]
    assert np.mean((p >= 0.5) == y) > 0.9
    assert C.co_train(a, b, np.full(1500, -1)).content is None


def test_quality_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = C.train(docs, labels)
    rows = C.score(docs, model).join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.5
    odd = spark.createDataFrame([(None, None, None, None, None, 1), (1, "", "en", None, -5, 2), (1, "", "en", None, -5, 2)],
                                "doc_id long, text string, lang string, source string, n_chars long, score int")
    assert C.score(odd, model).where("score between 0 and 1").count() == 3
    assert C.classify(odd.limit(0), labels.limit(0)).count() == 0
    assert C.classify(odd, labels.limit(0)).count() == 3


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", "en", "src1", 0)], docs.schema)
    docs = materialize(docs.union(docs.limit(3)).union(odd), "pipeline-test")
    names, seen = [n for n, _ in corpus_pipeline.STAGES], {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), "pipeline-test")
        if name != names[-1]:
            assert out.columns == docs.columns
        seen[name] = (docs, out)
        docs = out
    before, after = seen["quality_rules"]
    assert 0 < after.count() < before.count()
    before, after = seen["line_dedup"]
    assert after.count() == before.count() and after.where("n_chars <> length(text)").count() == 0
    before, after = seen["near_duplicates"]
    assert after.select("doc_id").distinct().count() == after.count() <= before.count()
    before, after = seen["source_mix"]
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r["doc_id"]: r["text"] for r in after.collect()}
    final = docs.collect()
    assert len(final) == after.count()
    assert all(r["ids"] == lib.encode(texts[r["doc_id"]] or "", add_eos=True) for r in final)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    rnd = random.Random(12)
    text = lambda: [rnd.choice("bcdfg") + str(rnd.randint(0, 10 ** 6)) for _ in range(120)]
    near = lambda t, i: " ".join(t[:i] + ["other"] + t[i + 1:])
    a, b, c, d, e, f = (text() for _ in range(6))
    rows = [(i, near(a, i)) for i in range(20, 60)] + [(None, " ".join(a))]     # a null id among near copies
    rows += [(i, near(b, i)) for i in range(60, 80)]                            # a group of ids alone
    rows += [(5, " ".join(c)), (5, near(c, 3)), (5, near(c, 9)), (6, near(c, 70))]   # near copies of one id
    rows += [(None, " ".join(d)), (None, near(d, 8)), (200, near(d, 50))]       # another group with null ids
    rows += [(None, " ".join(e)), (5, " ".join(f)), (5, " ".join(f)), (None, None), (None, None), (8, "")]
    df = spark.createDataFrame([(i, t, "src") for i, t in rows], "doc_id long, text string, source string")
    out = corpus_pipeline.near_duplicates_stage(spark, df.repartition(5), SF)
    assert out.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    group = lambda t: [(i, x) for i, x in got if x and len(set(x.split()) & set(t)) > 100]
    assert group(a) == [(None, " ".join(a))]
    assert group(b) == [(60, near(b, 60))]
    assert [i for i, _ in group(c)] == [5]
    assert [i for i, _ in group(d)] == [None]
    assert group(e) == [(None, " ".join(e))] and group(f) == [(5, " ".join(f))]
    assert sorted((i is None, t) for i, t in got if not t) == [(False, ""), (True, None)] and len(got) == 8


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "pipeline-test")
    assert docs.count() == 0
