"""N-gram Jaccard join by token groups.

Documents are sets of word shingles; two are linked when their Jaccard
similarity is high enough; the result is each document's connected component.

1. Equal sets become one class, so any number of exact copies is one row.
2. Each set is signed by blocks of its hash range (``shingles.signatures``);
   similar sets share a signature at least.  Signatures are counted, without
   their sets and, but for few, once for each class, so that those of exact
   copies are not met again; the sets that hold one of those met again are found
   in a second reading, behind a bitmap that lets few others through.
3. Every shared signature names its best-connected class as hub; the classes
   of its signatures are the hub's group.  Sets that only share a passage meet
   there too; a sketch of counts of tokens by hash bounds how near two
   sets can be from below (their counts' differences add up to no more than the
   tokens in which they differ), and only classes that the bound lets be similar
   to another of the group stay in it.  A larger set has more counts, as few
   would let large sets pass that share nothing.  Each is compared with the hub once,
   which leaves the tokens in which it differs from the hub.  Classes similar
   to the hub are linked by that.
4. Pairs of which one is not similar to the hub can only be similar if their
   differences overlap.  The group's members are filed in the order of their
   numbers of differences, some at a time, with the union of their difference
   tokens; an unlinked member's overlap with the union bounds its overlap with
   each of them, and only where the bound allows a link are they opened and
   compared.  Of the links found a spanning forest is kept.
5. Components of the links, by large-star and small-star rounds.

No step makes the pairs of a group: a group has one row per member, is dealt
into blocks of bounded size when large, and hot signatures, hubs and classes
only meet partial aggregates and plain joins of written tables, which adaptive
execution splits.  The result is exact (up to collisions of 64-bit hashes).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens.llm.common import MIN_LONG, Stages, doc_key, release_memory, ship_package, small_batches, text_bytes
from issuelens.llm.piece_bpe import slices
from issuelens.llm.shingles import Bands, set_ids, shingle_sets, signatures
from issuelens.operators.stage import materialize

GROUP = 32            # members whose differences share one union
BLOCK_ROWS = 4096     # members of a hub that meet in one task
SMALL = 256           # hubs with fewer members share tasks
BITMAP_BITS, MOST_BITS = 27, 29   # of a bitmap: as many as have room for its values, 64 MB at most
CELLS, MOST_CELLS = 64, 4096      # counts of a sketch, a byte each
PER_CELL = 8          # tokens for which a sketch has a count


def _each(rows: DataFrame, schema: str, make, columns: tuple[str, ...]) -> DataFrame:
    """``make(batch, raw, at)`` gives the output columns of each slice of texts."""
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                yield pa.RecordBatch.from_arrays(make(batch, *text_bytes(batch.column("text"))), list(columns))
        whole = batch = None
        release_memory()
    return rows.mapInArrow(run, schema)


def _ids(rows: DataFrame, words: int) -> DataFrame:
    """(key, n, c): size and id of each row's set."""
    def make(batch, raw, at):
        h, off = shingle_sets(raw, at, words)
        return [batch.column("key"), pa.array(np.diff(off)), pa.array(set_ids(h, off).view(np.int64))]
    return _each(rows, "key bigint, n bigint, c bigint", make, ("key", "n", "c"))


def _signatures(rows: DataFrame, words: int, percent: int, reps) -> DataFrame:
    """(sig): all signatures of the rows whose key the bitmap lets through."""
    def make(batch, raw, at):
        return [pa.array(signatures(*shingle_sets(*_wanted(batch, reps), words), Bands(percent))[1].view(np.int64))]
    return _each(rows, "sig bigint", make, ("sig",))


def _signed(rows: DataFrame, words: int, percent: int, reps, some) -> DataFrame:
    """(c, sig): the signatures of the same rows that the second bitmap lets through, with their sets."""
    def make(batch, raw, at):
        h, off = shingle_sets(*_wanted(batch, reps), words)
        who, sig = signatures(h, off, Bands(percent))
        sig = sig.view(np.int64)
        keep = in_bitmap(some.value, sig)
        return [pa.array(set_ids(h, off).view(np.int64)[who[keep]]), pa.array(sig[keep])]
    return _each(rows, "c bigint, sig bigint", make, ("c", "sig"))


def _wanted(batch, some):
    """Bytes and offsets of the texts whose key the bitmap lets through."""
    keys = np.asarray(batch.column("key").to_numpy(zero_copy_only=False), np.int64)
    return text_bytes(batch.column("text").filter(pa.array(in_bitmap(some.value, keys))))


def _tokens(rows: DataFrame, words: int, some) -> DataFrame:
    """(token): the tokens of the rows whose key the bitmap lets through."""
    def make(batch, raw, at):
        return [pa.array(shingle_sets(*_wanted(batch, some), words)[0].view(np.int64))]
    return _each(rows, "token bigint", make, ("token",))


def sketch(h: np.ndarray, off: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Tokens of each set by the low bits of their hashes, 255 at most."""
    n = len(off) - 1
    cell = np.repeat(np.arange(n) * cells, np.diff(off)) + (h & np.uint64(cells - 1)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=n * cells), 255).astype(np.uint8).reshape(n, cells)


def sized_sketches(h: np.ndarray, off: np.ndarray) -> list[bytes]:
    """The sketch of each set, with a count for each ``PER_CELL`` tokens (a power of two)."""
    out = []
    for a, b in zip(off.tolist(), off[1:].tolist()):
        cells = 1 << max(0, (b - a - 1) // PER_CELL).bit_length()
        cells = min(max(cells, CELLS), MOST_CELLS)
        out.append(sketch(h[a:b], np.array([0, b - a]), cells).tobytes())
    return out


def _folded(sketches: list[bytes], cells: int) -> np.ndarray:
    """Sketches of one length as those of ``cells`` counts, a row each."""
    table = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1, cells)
    return np.minimum(table.sum(axis=1, dtype=np.int32), 255).astype(np.int16)


def _sketches(rows: DataFrame, words: int, some) -> DataFrame:
    """(c, n, sketch) of the rows whose key the bitmap lets through."""
    def make(batch, raw, at):
        h, off = shingle_sets(*_wanted(batch, some), words)
        return [pa.array(set_ids(h, off).view(np.int64)), pa.array(np.diff(off)),
                pa.array(sized_sketches(h, off), pa.binary())]
    return _each(rows, "c bigint, n bigint, sketch binary", make, ("c", "n", "sketch"))


def _sets(rows: DataFrame, words: int, some, met) -> DataFrame:
    """(c, n, tokens) of the same rows: the tokens that the second bitmap lets through
    (those met more than once); the others only count in ``n``."""
    def make(batch, raw, at):
        h, off = shingle_sets(*_wanted(batch, some), words)
        keep = in_bitmap(met.value, h.view(np.int64))
        ends = np.concatenate([[0], np.cumsum(keep)])[off].astype(np.int32)
        return [pa.array(set_ids(h, off).view(np.int64)), pa.array(np.diff(off)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(h[keep].view(np.int64)))]
    return _each(rows, "c bigint, n bigint, tokens array<bigint>", make, ("c", "n", "tokens"))


def bitmap(rows: DataFrame, col: str) -> np.ndarray:
    """Bits at the low bits of a long column's values: eight for each of the (written) rows,
    from 16 MB to 64 MB, however many rows.  It only spares work: what it lets through is
    checked again, and when it fills up everything passes."""
    bits = min(max(BITMAP_BITS, (8 * rows.count()).bit_length()), MOST_BITS)
    at = F.col(col).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.expr(f"shiftleft(1L, cast({col} & 63 as int))")
    words = (rows.select(F.shiftright(at, 6).cast("int").alias("w"), bit.alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out.view(np.uint64)


def in_bitmap(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & (64 * len(words) - 1)
    return (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _hub_links(h: pd.DataFrame, up: int, down: int) -> list[tuple[int, int]]:
    """Links among one hub's rows (c, n, linked, alone, diff, a, b) that do not follow
    from links to the hub, as a spanning forest.  ``diff`` holds the tokens in which
    a row differs from the hub's and that others may share, ``alone`` the number
    of its tokens that no other set holds.  ``a`` marks rows that ask (if not
    linked), ``b`` rows that are filed."""
    ask = h[h["a"] & ~h["linked"]]
    filed = h[h["b"]].copy()
    if not len(ask) or not len(filed):
        return []
    filed["size"] = filed["diff"].map(len) + filed["alone"]
    filed = filed.sort_values(["size", "c"], kind="stable")
    diffs, b_size = filed["diff"].tolist(), filed["size"].to_numpy(np.int64)
    b_n, b_c = filed["n"].to_numpy(np.int64), filed["c"].tolist()
    a_diff = [np.asarray(d) for d in ask["diff"]]
    a_c, a_n = ask["c"].tolist(), ask["n"].to_numpy(np.int64)
    a_len = np.array([len(d) for d in a_diff], np.int64)
    a_size = a_len + ask["alone"].to_numpy(np.int64)
    flat = np.concatenate(a_diff).astype(np.int64)
    owner = np.repeat(np.arange(len(a_diff)), a_len)
    parent: dict[int, int] = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    for c, linked in zip(h["c"].tolist(), h["linked"].tolist()):
        if linked:
            parent[c] = "hub"
    links = []
    for g in range(0, len(diffs), GROUP):
        members = range(g, min(g + GROUP, len(diffs)))
        union = np.unique(np.concatenate([np.asarray(diffs[m], np.int64) for m in members]))
        inside = np.isin(flat, union)
        overlap = np.bincount(owner[inside], minlength=len(a_diff))
        low, most = b_size[members[0]], b_n[g:members[-1] + 1].max()
        can = (a_size + low - 2 * overlap) * up <= (a_n + most) * down
        if not can.any():
            continue
        chosen = np.flatnonzero(can)
        mine = can[owner] & inside
        tokens, of = flat[mine], owner[mine]
        for m in members:  # the group is opened
            both = np.bincount(of[np.isin(tokens, diffs[m])], minlength=len(a_diff))[chosen]
            apart = a_size[chosen] + b_size[m] - 2 * both
            for i in chosen[apart * up <= (a_n[chosen] + b_n[m]) * down].tolist():
                x, y = root(a_c[i]), root(b_c[m])
                if x != y:
                    parent[y if x == "hub" else x] = x if x == "hub" else y
                    links.append((a_c[i], b_c[m]))
    return links


def _dealt(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Members (hub, c, linked, ``carried``) of hubs dealt to tasks (g, x, y): small hubs share
    one; a large hub's unlinked members (``a``) meet all its members (``b``) block by block."""
    counts = rows.groupBy("hub").agg(F.count(F.lit(1)).alias("members"),
                                     F.sum(F.when(F.col("linked"), 0).otherwise(1)).alias("open"))
    work = materialize(counts.where((F.col("open") > 0) & (F.col("members") > 1)), "hub-sizes")
    total = work.agg(F.sum("members")).first()[0] or 0
    shared = max(1, total // BLOCK_ROWS)
    rows = rows.join(work, "hub")
    names = ["hub", "c", "linked", *carried]
    small = rows.where(F.col("members") < SMALL).select(
        F.pmod(F.xxhash64("hub"), F.lit(shared)).alias("g"), F.lit(-1).cast("long").alias("x"),
        F.lit(-1).cast("long").alias("y"), *names, F.lit(True).alias("a"), F.lit(True).alias("b"))
    large = rows.where(F.col("members") >= SMALL).withColumns({
        "blocks": F.ceil(F.col("members") / BLOCK_ROWS).cast("long")})
    large = large.withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    asks = large.where(~F.col("linked")).withColumn("y", every).select(
        F.col("hub").alias("g"), F.col("own").alias("x"), "y", *names, F.lit(True).alias("a"), F.lit(False).alias("b"))
    files = large.withColumn("x", every).select(
        F.col("hub").alias("g"), "x", F.col("own").alias("y"), *names, F.lit(False).alias("a"), F.lit(True).alias("b"))
    return small.union(asks).union(files)


def _residual(diffs: DataFrame, up: int, down: int) -> DataFrame:
    """Links (c, other) between members of a hub beyond those to the hub."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, h in rows.groupby("hub", sort=False):
            links.extend(_hub_links(h, up, down))
        return pd.DataFrame(links, columns=["c", "other"], dtype=np.int64)

    return _dealt(diffs, ["n", "alone", "diff"]).groupBy("g", "x", "y").applyInPandas(run, "c bigint, other bigint")


def _may_link(h: pd.DataFrame, up: int, down: int) -> np.ndarray:
    """Of one hub's rows (c, n, sketch, a, b) the asking ones that may be similar to another."""
    filed = h[h["b"]]
    ask = h[h["a"]]
    if not len(filed) or not len(ask):
        return np.zeros(0, np.int64)
    f_c, f_n = filed["c"].to_numpy(np.int64), filed["n"].to_numpy(np.int64)
    a_c, a_n = ask["c"].to_numpy(np.int64), ask["n"].to_numpy(np.int64)
    f_sketch, a_sketch = filed["sketch"].tolist(), ask["sketch"].tolist()
    f_len, a_len = np.array([len(x) for x in f_sketch]), np.array([len(x) for x in a_sketch])
    found = np.zeros(len(a_c), bool)
    for long in np.unique(f_len).tolist():
        rows = np.flatnonzero(f_len == long)
        low, high = f_n[rows].min(), f_n[rows].max()
        near = ((low - a_n) * up <= (low + a_n) * down) & ((a_n - high) * up <= (a_n + high) * down)
        for own in np.unique(a_len[near & ~found]).tolist():
            asking = np.flatnonzero(near & ~found & (a_len == own))
            cells = min(long, own)  # both sides as the shorter sketch
            table = _folded([f_sketch[i] for i in rows.tolist()], cells)
            mine = _folded([a_sketch[i] for i in asking.tolist()], cells)
            c, n = f_c[rows], f_n[rows]
            for i, counts in zip(asking.tolist(), mine):
                fits = np.flatnonzero((np.abs(n - a_n[i]) * up <= (n + a_n[i]) * down) & (c != a_c[i]))
                if fits.size:
                    apart = np.abs(table[fits] - counts).sum(axis=1, dtype=np.int64)
                    found[i] = (apart * up <= (n[fits] + a_n[i]) * down).any()
    return a_c[found]


def _near_members(pairs: DataFrame, sketches: DataFrame, up: int, down: int) -> DataFrame:
    """The (hub, c) of ``pairs`` that may be similar to the hub or another of its members."""
    hubs = pairs.select("hub", F.col("hub").alias("c")).distinct()
    rows = pairs.union(hubs).join(sketches, "c").withColumn("linked", F.lit(False))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = [(hub, c) for hub, h in rows.groupby("hub", sort=False) for c in _may_link(h, up, down).tolist()]
        return pd.DataFrame(out, columns=["hub", "c"], dtype=np.int64)

    found = _dealt(rows, ["n", "sketch"]).groupBy("g", "x", "y").applyInPandas(run, "hub bigint, c bigint")
    return found.where("c <> hub").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of undirected ``edges`` (u, v); a component is
    named by its smallest node.

    Large-star and small-star rounds until the edges are stars.  A node with many
    edges only meets a partial minimum and a join that adaptive execution splits.
    """
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star")
        star = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .where("u <> v").distinct())
        star = materialize(star, "edges")
        low = materialize(star.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        edges = (star.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = materialize(edges, "edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return materialize(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), "components")


def _holders(pairs: DataFrame, classes: DataFrame, stages: Stages, name: str):
    """Bitmap (broadcast) of the ids that stand for the classes of ``pairs``."""
    used = pairs.select("c").union(pairs.select(F.col("hub").alias("c"))).distinct()
    wanted = stages.write(name, used.join(classes, "c").select(F.col("rep").alias("key")).distinct())
    return pairs.sparkSession.sparkContext.broadcast(bitmap(wanted, "key"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, text_col: str = "text",
                       id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``.

    Two documents are linked when ``100 * |A and B| >= percent * |A or B|`` for
    their sets of ``words``-word shingles.  Fewer words make one shingle; a null
    or blank text has none and is linked with nothing.  Rows that share an id are
    one document with several sets: their components are one.  A null id counts
    as one id below all others and comes back as null.  A very long text is shingled
    whole, in one task.  Only the two named columns are read.  An empty table gives an
    empty table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    bands = Bands(percent)
    texts = docs.select(doc_key(id_col).alias("key"), F.col(text_col).alias("text"))
    stages = Stages(spark)
    plain = stages.write("set-ids", _ids(texts, words))
    classes = stages.write("classes", plain.where("n > 0").groupBy("c").agg(F.min("key").alias("rep")))

    # One row stands for a class (few others pass, and rows of its id).  A signature met
    # twice may still be of copies of one set; those go below.
    reps = spark.sparkContext.broadcast(bitmap(classes, "rep"))
    met = stages.write("met", _signatures(texts, words, percent, reps).groupBy("sig").agg(F.count(F.lit(1)).alias("w"))
                       .where("w > 1").select("sig"))
    some = spark.sparkContext.broadcast(bitmap(met, "sig"))
    signed = stages.write("signed", _signed(texts, words, percent, reps, some).distinct())
    stages.drop("met")
    reps.destroy()
    some.destroy()
    shared = stages.write("shared", signed.groupBy("sig").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("w")).where("lo <> hi").select("sig", "w"))
    members = stages.write("members", signed.join(shared, "sig"))
    stages.drop("signed", "shared")
    # Classes in the order of their members' numbers of meetings, ties by a hash: every
    # signature of a group that the first class holds has it as hub.
    order = F.shiftleft(F.sum("w"), 20) + F.first("c").bitwiseAND(F.lit((1 << 20) - 1))
    weight = stages.write("weight", members.groupBy("c").agg(order.alias("pop")))
    hubs = stages.write("hubs", members.join(weight, "c").groupBy("sig").agg(F.max_by("c", "pop").alias("hub")))
    pairs = stages.write("pairs", members.join(hubs, "sig").where("c <> hub").select("hub", "c").distinct())
    stages.drop("members", "weight", "hubs")

    # The sets are made again for the classes that meet a hub, from one id each: first
    # their sketches, then, for those that may be similar to another, their tokens.
    some = _holders(pairs, classes, stages, "met-classes")
    sketches = stages.write("sketches", _sketches(texts, words, some).groupBy("c").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    pairs = stages.write("near-pairs", _near_members(pairs, sketches, bands.up, bands.down))
    stages.drop("pairs", "met-classes", "sketches")
    some = _holders(pairs, classes, stages, "wanted")
    # A token that only one of them holds differs from every other set: it need not travel.
    tokens = stages.write("tokens", _tokens(texts, words, some).groupBy("token").agg(F.count(F.lit(1)).alias("w"))
                          .where("w > 1").select("token"))
    met = spark.sparkContext.broadcast(bitmap(tokens, "token"))
    sets = stages.write("sets", _sets(texts, words, some, met).groupBy("c").agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens"))
        .withColumn("alone", F.col("n") - F.size("tokens")))
    stages.drop("wanted", "tokens")
    left = pairs.join(sets, "c")
    hub_sets = sets.select(F.col("c").alias("hub"), F.col("n").alias("hub_n"), F.col("tokens").alias("hub_tokens"),
                           F.col("alone").alias("hub_alone"))
    diff = F.concat(F.array_except("tokens", "hub_tokens"), F.array_except("hub_tokens", "tokens"))
    diffs = left.join(hub_sets, "hub").select("hub", "c", "n", "hub_n", "alone", "hub_alone", diff.alias("diff"))
    apart = F.size("diff") + F.col("alone") + F.col("hub_alone")
    near = apart * F.lit(bands.up) <= (F.col("n") + F.col("hub_n")) * F.lit(bands.down)
    diffs = stages.write("differences", diffs.select("hub", "c", "n", near.alias("linked"), "alone", "diff"))
    stages.drop("sets", "near-pairs")

    links = stages.write("links", diffs.where("linked").select("c", F.col("hub").alias("other")).union(
        _residual(diffs, bands.up, bands.down)))
    stages.drop("differences")
    one, two = classes.select("c", F.col("rep").alias("u")), classes.select(F.col("c").alias("other"), F.col("rep").alias("v"))
    edges = links.join(one, "c").join(two, "other").select("u", "v")
    # Several sets of one id: the sets' representatives are linked through the id.
    several = (plain.where("n > 0").groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
               .where("lo <> hi").select("key"))
    ids = (plain.where("n > 0").join(several, "key").join(classes, "c")
           .select(F.col("key").alias("u"), F.col("rep").alias("v")))
    comps = connected(edges.union(ids))
    placed = plain.join(classes, "c", "left")
    out = (placed.join(comps, placed["rep"] == comps["node"], "left")
           .select(F.when(F.col("key") != MIN_LONG, F.col("key")).alias("doc_id"), F.col("n").alias("n_shingles"),
                   F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("key")).alias("component")))
    return out.select("doc_id", "n_shingles",
                      F.when(F.col("component") != MIN_LONG, F.col("component")).alias("component_id"))
