"""SimHash near-duplicates by the generalised pigeonhole principle.

1. A text's 64-bit fingerprint has the bits that more than half of its shingles'
   XXH64 hashes have.  Equal fingerprints become one row.
2. Bits that go together over all fingerprints (one 64 x 64 table of counts) are
   grouped into partitions.  With thresholds ``t_i`` of -1 or more that add up to
   ``LINK - partitions + 1``, two fingerprints within ``LINK`` bits differ in at
   most ``t_i`` bits of some partition ``i``, whatever the thresholds; -1 leaves
   a partition out.
3. Every fingerprint chooses its own thresholds by dynamic programming over the
   partitions: the cost of a threshold is its probes and the candidates that they
   are estimated to meet (the fingerprint's bucket, counted, times the odds of
   the bits that a probe flips).  Crowded buckets so get -1.
4. Probes meet the buckets' fingerprints in a plain join, and the candidates are
   verified.  Before that the probes are counted against the buckets' sizes.
5. Fingerprints whose probes would meet more than ``CROWD`` candidates (clusters of
   many distinct, near fingerprints) go another exact way, with everything in
   their buckets: two fingerprints are within two bits exactly if some 64-bit
   value is within one bit of both, so each files itself under the 65 such
   values.  A value can hold 65 fingerprints at most.
6. Components of the links.

The result is exact whatever the partitions and thresholds are, and no step makes
the pairs of a group: candidates are at most ``CROWD`` a fingerprint.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from issuelens.llm.common import LOWER, MIN_LONG, UPPER, Stages, doc_key, ship_package
from issuelens.llm.ngram_join import connected
from issuelens.llm.piece_bpe import slices

BITS = 64
LINK = 2                 # differing bits of linked fingerprints; step 5 is made for two
SEED = 42
CROWD = 128              # candidates and probes of a fingerprint before it goes the other way
FEW = 1 << 24            # fingerprints up to which three partitions cost less than two
SPAN = 1 << 16           # shingles whose bits are counted at once
_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle of a UTF-8 text, repeats included."""
    found = text.translate(_TO_LOWER).split()  # bytes.split() cuts at exactly the white space meant here
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-words] + 1])
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1:].tolist())),
                       np.uint64, len(starts))


def fingerprint(text: bytes, words: int = 3) -> int:
    """The fingerprint as an unsigned number; 0 without words."""
    h = shingle_hashes(text, words)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, h.size, SPAN):
        ones += bit_table(h[at:at + SPAN]).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > h.size, bitorder="little").view("<u8")[0])


def bit_table(values: np.ndarray) -> np.ndarray:
    """(n, 64) zeros and ones, lowest bit first."""
    raw = np.ascontiguousarray(values).astype("<u8", copy=False).view(np.uint8)
    return np.unpackbits(raw.reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs: DataFrame, words: int = 3, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(key, fp) of every row; see ``simhash_components``."""
    rows = docs.select(doc_key(id_col).alias("key"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [fingerprint(t or b"", words) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(np.array(found, np.uint64).view(np.int64))], ["key", "fp"])
    return rows.mapInArrow(run, "key bigint, fp bigint")


def bit_counts(fps: DataFrame) -> np.ndarray:
    """How many fingerprints have bits i and j (64 x 64 numbers, whatever the input)."""
    def run(batches):
        both = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            bits = bit_table(batch.column("fp").to_numpy().view(np.uint64)).astype(np.float64)
            both += (bits.T @ bits).astype(np.int64)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(both[i, j])], ["i", "j", "n"])

    out = np.zeros((BITS, BITS), np.int64)
    for i, j, n in fps.mapInArrow(run, "i bigint, j bigint, n bigint").groupBy("i", "j").agg(F.sum("n")).collect():
        out[i, j] = out[j, i] = n
    return out


def group_bits(both: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about the same number, correlated ones together."""
    p = np.diag(both) / max(total, 1)
    cov = both / max(total, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    tie = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(tie, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        group = [max(sorted(free), key=lambda b: tie[b, sorted(free)].sum())]
        free.remove(group[0])
        while len(group) < BITS * (k + 1) // parts - BITS * k // parts:
            group.append(max(sorted(free), key=lambda b: tie[b, group].sum()))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def mask_of(bits: Sequence[int]) -> int:
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


def allocate(costs: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of least cost.  ``costs[i, t + 1]`` holds the rows' costs of threshold
    ``t`` (-1 to LINK) in partition ``i``; the thresholds of a row add up to
    ``total``.  Returns (thresholds by partition and row, costs)."""
    parts, kinds, n = costs.shape
    spent = total + parts  # thresholds counted from -1
    best = np.full((spent + 1, n), np.inf)
    best[0] = 0
    choice = np.zeros((parts, spent + 1, n), np.int64)
    for i in range(parts):
        new = np.full_like(best, np.inf)
        for s in range(spent + 1):
            for t in range(min(kinds - 1, s) + 1):
                cost = best[s - t] + costs[i, t]
                less = cost < new[s]
                new[s][less], choice[i, s][less] = cost[less], t
        best = new
    out, at = np.zeros((parts, n), np.int64), np.full(n, spent)
    for i in reversed(range(parts)):
        out[i] = choice[i, at, np.arange(n)] - 1
        at = at - out[i] - 1
    return out, best[spent]


def _probes(queries: DataFrame, groups: list[list[int]], share: np.ndarray) -> DataFrame:
    """(part, value, fp) for each probe of each query (fp, n0, n1, ...); a query that
    is estimated to meet a crowd has one row with part -1."""
    parts, total = len(groups), LINK - len(groups) + 1
    masks = [np.uint64(mask_of(g) & (1 << BITS) - 1) for g in groups]
    flips = [{t: np.array([sum(1 << b for b in pick) for n in range(t + 1) for pick in combinations(g, n)], np.uint64)
              for t in range(LINK + 1)} for g in groups]

    def run(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            own = bit_table(fps)
            odds = np.where(own == 1, (1 - share) / np.maximum(share, 1e-6), share / np.maximum(1 - share, 1e-6))
            costs = np.zeros((parts, LINK + 2, len(fps)))
            for i, g in enumerate(groups):
                n = batch.column(f"n{i}").to_numpy()
                s, sq = odds[:, g].sum(axis=1), (odds[:, g] ** 2).sum(axis=1)
                for t, met in enumerate((n, n * (1 + s), n * (1 + s + (s * s - sq) / 2))):
                    costs[i, t + 1] = flips[i][t].size + met
            taus, cost = allocate(costs, total)
            crowd = cost > CROWD
            out = [(np.full(crowd.sum(), -1, np.int32), fps[crowd], fps[crowd])]
            for i in range(parts):
                for t in range(LINK + 1):
                    mine = fps[(taus[i] == t) & ~crowd]
                    value = ((mine & masks[i])[:, None] ^ flips[i][t][None, :]).ravel()
                    out.append((np.full(value.size, i, np.int32), value, np.repeat(mine, flips[i][t].size)))
            part, value, fp = (np.concatenate(x) for x in zip(*out))
            for a in range(0, len(part), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(part[a:a + (1 << 18)]), pa.array(
                    value[a:a + (1 << 18)].view(np.int64)), pa.array(fp[a:a + (1 << 18)].view(np.int64))],
                    ["part", "value", "fp"])
    return queries.mapInArrow(run, "part int, value bigint, fp bigint")


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))).between(1, LINK)


def near_fingerprints(fps: DataFrame, stages: Stages, parts: int | None = None) -> DataFrame:
    """Links (u, v) between distinct fingerprints (fp); every two within ``LINK`` bits are
    linked or joined by links over others that are."""
    number = fps.count()
    parts = parts or (3 if number <= FEW else 2)
    both = bit_counts(fps)
    groups = group_bits(both, number, parts)
    share = np.diag(both) / max(number, 1)
    masks = F.array(*[F.lit(mask_of(g)).cast("long") for g in groups])
    filed = fps.select("fp", F.posexplode(masks).alias("part", "mask")).select(
        "part", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
    sizes = stages.write("buckets", filed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")))
    crowded = sizes.where("n > 1")
    counts = [F.coalesce(F.max(F.when(F.col("part") == i, F.col("n"))), F.lit(1)).alias(f"n{i}") for i in range(parts)]
    queries = filed.join(crowded, ["part", "value"]).groupBy("fp").agg(*counts)
    if LINK - parts + 1 > 0:  # the thresholds reach other buckets: no fingerprint is alone for sure
        rest = fps.join(queries.select("fp"), "fp", "left_anti")
        queries = queries.union(rest.select("fp", *[F.lit(1).cast("long").alias(f"n{i}") for i in range(parts)]))
    probes = stages.write("probes", _probes(queries, groups, share))
    meets = probes.where("part >= 0").join(sizes, ["part", "value"]).groupBy("fp").agg(F.sum("n").alias("n"))
    dense = stages.write("dense", probes.where("part < 0").select("fp").union(
        meets.where(F.col("n") > CROWD).select("fp")).distinct())
    # Buckets above the bound are only met by fingerprints that go the other way.
    open_ = filed.join(sizes.where(F.col("n") <= CROWD).select("part", "value"), ["part", "value"])
    asks = probes.where("part >= 0").join(dense, "fp", "left_anti").select("part", "value", F.col("fp").alias("v"))
    found = asks.join(open_.withColumnRenamed("fp", "u"), ["part", "value"]).where(_near("u", "v")).select("u", "v")
    links = stages.write("near", found.distinct())

    theirs = filed.join(dense, "fp").select("part", "value").distinct()
    around = stages.write("around", filed.join(theirs, ["part", "value"], "left_semi").select("fp").distinct())
    one_off = F.array(F.lit(0).cast("long"), *[F.lit(mask_of([b])).cast("long") for b in range(BITS)])
    spots = around.select("fp", F.explode(one_off).alias("bit")).select(
        F.col("fp").bitwiseXOR(F.col("bit")).alias("spot"), "fp")
    shared = spots.groupBy("spot").agg(F.min("fp").alias("u"), F.max("fp").alias("hi")).where("u <> hi").select("spot", "u")
    stars = spots.join(shared, "spot").where("fp <> u").select("u", F.col("fp").alias("v")).distinct()
    return links.union(stages.write("stars", stars))


def simhash_components(docs: DataFrame, words: int = 3, text_col: str = "text", id_col: str = "doc_id",
                       parts: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 lowercase hex digits)
    and ``component_id``, the smallest id reachable by fingerprints that differ in
    two bits or fewer.

    Texts are read whole, with A-Z lower-cased; a very long one is hashed in one
    task, its bits counted in spans.  Fewer words than ``words`` make one shingle.
    A null or blank text has the fingerprint 0, which links like any other.  Rows
    that share an id are one document with several fingerprints: their components
    are one.  A null id counts as one id below all others and comes back as null.
    Only the two named columns are read, whatever else ``docs`` holds.  An empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    stages = Stages(spark)
    plain = stages.write("fingerprints", fingerprints(docs, words, text_col, id_col))
    classes = stages.write("fingerprint-classes", plain.groupBy("fp").agg(F.min("key").alias("rep")))
    links = near_fingerprints(classes.select("fp"), stages, parts)
    one, two = classes.select(F.col("fp").alias("u"), F.col("rep").alias("a")), classes.select(
        F.col("fp").alias("v"), F.col("rep").alias("b"))
    edges = links.join(one, "u").join(two, "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    several = plain.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("key")
    ids = plain.join(several, "key").join(classes, "fp").select(F.col("key").alias("u"), F.col("rep").alias("v"))
    comps = connected(edges.union(ids))
    named = classes.join(comps, classes["rep"] == comps["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component"))
    return plain.join(named, "fp").select(
        F.when(F.col("key") != MIN_LONG, F.col("key")).alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component") != MIN_LONG, F.col("component")).alias("component_id"))
