"""Approximate nearest neighbours by collision counting.

Every vector (scaled to length 1) is projected on ``projections`` random
directions.  A block of vectors holds one sorted array per direction.  Around a
query's own projections windows are opened and widened step by step (virtual
rehashing); a vector that lies in the window of at least ``threshold`` of the
directions is a candidate and its exact measure is computed.  The widening of a
block stops when enough candidates are verified.

Vectors and queries are dealt into blocks of bounded size; a task holds one
block of each, and only each query's best rows leave it.  A vector block's
arrays are built where it is searched.  Equal vectors of a block are one row of
its arrays with the smallest of their ids: they count once towards the verified
part, so a vector repeated in a third of all rows ends no widening early.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelens.llm.common import ship_package
from issuelens.operators.stage import materialize

PROJECTIONS = 96
THRESHOLD = 0.60        # part of the directions a candidate must collide in
FIRST, GROWTH, LAST = 0.25, 1.25, 2.2   # half window: first, factor, last
VERIFY = 0.20           # part of a block's distinct vectors after which widening stops
BLOCK_ROWS, QUERY_ROWS = 4096, 1024
SEED = 20


def directions(dim: int, projections: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, projections))


class Block:
    """Sorted projection arrays of a block of vectors, kept as each vector's place in
    each array: a window is a run of places, and a vector collides where its place
    lies in the run."""

    def __init__(self, vectors: np.ndarray, projections: int = PROJECTIONS):
        self.vectors = vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.dirs = directions(vectors.shape[1], projections)
        proj = (vectors / self.norms[:, None]) @ self.dirs
        order = np.argsort(proj, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(proj, order, axis=0).T)
        places = np.empty(order.shape, np.uint16)  # a block has fewer rows than that
        np.put_along_axis(places, order, np.arange(len(vectors), dtype=np.uint16)[:, None], axis=0)
        self.places = np.ascontiguousarray(places.T)

    def windows(self, centres: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """First places and lengths of each query's windows of this half width."""
        lo = np.stack([np.searchsorted(s, c - half, "left") for s, c in zip(self.sorted, centres.T)], axis=1)
        hi = np.stack([np.searchsorted(s, c + half, "right") for s, c in zip(self.sorted, centres.T)], axis=1)
        return lo.astype(np.uint16), (hi - lo).astype(np.uint16)

    def candidates(self, queries: np.ndarray, least: int):
        """(query, rows) for each query: the rows that collide often enough, in windows
        widened until there are ``least`` of them or the last width is reached."""
        need = math.ceil(THRESHOLD * len(self.places))
        count = np.uint8 if len(self.places) < 256 else np.uint16
        centres = queries @ self.dirs
        open_ = np.arange(len(queries))
        half = FIRST
        while open_.size:
            starts, lengths = self.windows(centres[open_], half)
            wait = []
            for q, lo, n in zip(open_.tolist(), starts, lengths):
                inside = (self.places - lo[:, None]) < n[:, None]  # unsigned: below the window wraps around
                found = np.flatnonzero(np.add.reduce(inside.view(np.uint8), axis=0, dtype=count) >= need)
                if found.size >= least:
                    yield q, found
                elif half >= LAST:
                    yield q, np.arange(self.places.shape[1])
                else:
                    wait.append(q)
            open_ = np.array(wait, np.int64)
            half *= GROWTH


def collapse(vectors: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct vectors; the ids by vector and, per vector, in the order given; each
    vector's first place among them and their number."""
    vectors = np.ascontiguousarray(vectors + 0.0)  # -0.0 equals 0.0
    whole = vectors.view(np.dtype((np.void, vectors.shape[1] * vectors.itemsize))).ravel()
    _, sample, which, count = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
    return vectors[sample], ids[np.argsort(which, kind="stable")], np.cumsum(count) - count, count


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's ``k`` best verified rows of one block, other rows than its own."""
    if not len(queries) or not len(rows):
        return pd.DataFrame({"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64),
                             "score": np.array([], float)})
    rows = rows.sort_values("vec_id", kind="stable")
    vectors, ids, first, count = collapse(np.array(rows["vector"].tolist(), dtype=np.float64),
                                          rows["vec_id"].to_numpy(np.int64))
    block = Block(vectors)
    asked = np.array(queries["vector"].tolist(), dtype=np.float64)
    lengths = np.sqrt((asked * asked).sum(axis=1))
    query_ids = queries["vec_id"].tolist()
    least = min(len(vectors), max(k + 1, math.ceil(VERIFY * len(vectors)) + k))
    out = []
    for n, found in block.candidates(asked / lengths[:, None], least):
        found = found[(ids[first[found]] != query_ids[n]) | (count[found] > 1)]
        score = (block.vectors[found] @ asked[n]) / (block.norms[found] * lengths[n])
        if found.size > k:  # the best, and all that may tie with the last of them
            near = score >= np.partition(score, -k)[-k] - 1e-9
            found = found[near]
        # Summed in one fixed order, so that equal vectors have equal scores.
        score = (block.vectors[found] * asked[n]).sum(axis=1) / (block.norms[found] * lengths[n])
        # Each vector's smallest ids; one more than k, as the query's own may be among them.
        each = np.minimum(count[found], k + 1)
        at = np.repeat(first[found], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        own, score = ids[at], np.repeat(score, each)
        own, score = own[own != query_ids[n]], score[own != query_ids[n]]
        best = np.lexsort((own, -score))[:k]
        out.append(pd.DataFrame({"query_id": query_ids[n], "vec_id": own[best], "score": score[best]}))
    return pd.concat(out)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """For each query row its ``k`` nearest other rows by cosine: ``query_id``, ``rank``
    (from 1), ``vec_id``, ``score``.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without an id, take no part, as queries or candidates; so do
    vectors of another length than the query's.  Rows with the query's id are
    the query's own.  Rows that repeat an id count once per distinct vector.
    Ties go to the smaller id.  An empty table gives an empty table.
    """
    ship_package(vectors.sparkSession)
    parts = F.transform(vector_col, lambda x: x.cast("double"))
    usable = (F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
              & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
              & F.exists("vector", lambda x: x != 0))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), parts.alias("vector"), is_query.alias("query"))
            .where(usable).withColumn("dim", F.size("vector")))
    rows = materialize(rows.distinct(), "vectors")
    sizes = rows.agg(F.count(F.lit(1)), F.sum(F.col("query").cast("int"))).first()
    n_blocks = max(1, -(-(sizes[0] or 0) // BLOCK_ROWS))
    q_blocks = max(1, -(-(sizes[1] or 0) // QUERY_ROWS))
    mark = F.xxhash64("vec_id", "vector")
    nth = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    data = rows.withColumn("block", F.pmod(mark, F.lit(n_blocks))).withColumn("qblock", nth(q_blocks))
    asked = (rows.where("query").withColumn("qblock", F.pmod(F.xxhash64(mark), F.lit(q_blocks)))
             .withColumn("block", nth(n_blocks)))
    key = ["dim", "block", "qblock"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return search_block(left, right, k)

    local = (asked.select(*key, "vec_id", "vector").groupBy(*key)
             .cogroup(data.select(*key, "vec_id", "vector").groupBy(*key))
             .applyInPandas(run, "query_id bigint, vec_id bigint, score double"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
