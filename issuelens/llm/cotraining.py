"""Quality classifier by co-training of two views.

The content view sees the text's bytes (hashed byte trigrams and three shares);
the metadata view sees language, source and length only.  Both start from the
same labelled rows.  In each round every view marks the unlabelled rows of
which it is surest and hands them, with its labels, to the other view.  At the
end each view is calibrated on labelled rows that it did not learn from, and
the calibrated log-odds are added (each view's evidence over the base rate).

Only the classifiers are fitted on samples: ``LABELLED`` labelled and
``UNLABELLED`` other rows, picked by hash, whatever the size of the corpus.
Their features (not their texts) come to the driver.  All documents are scored,
each by its whole text.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens.llm.common import ship_package, text_bytes
from issuelens.llm.piece_bpe import slices
from issuelens.operators.stage import materialize

LABELLED, UNLABELLED = 3000, 3000   # rows that the classifiers are fitted on
ROUNDS, PER_ROUND = 3, 150          # pseudo-labels that a view hands over in a round, at most
GRAMS, SHARES, META = 1024, 3, 128
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def content_features(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Trigram shares, largest trigram share, upper-case and punctuation shares per text."""
    n = len(at) - 1
    out = np.zeros((n, GRAMS + SHARES), np.float32)
    wide = raw.astype(np.uint32)
    grams = np.zeros(max(raw.size - 2, 0), np.int64)
    if grams.size:
        grams[:] = ((wide[:-2] * 2654435761 + wide[1:-1] * 40503 * 65599 + wide[2:] * 2246822519) >> 22) % GRAMS
    upper, punct = np.cumsum(np.concatenate([[0], (raw >= 65) & (raw <= 90)])), np.cumsum(
        np.concatenate([[0], _PUNCT[raw]]))
    for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        if b - a > 2:
            out[k, :GRAMS] = np.bincount(grams[a:b - 2], minlength=GRAMS) / (b - a - 2)
            out[k, GRAMS] = out[k, :GRAMS].max()
        if b > a:
            out[k, GRAMS + 1] = (upper[b] - upper[a]) / (b - a)
            out[k, GRAMS + 2] = (punct[b] - punct[a]) / (b - a)
    return out


def metadata_features(langs: list, sources: list, sizes: list) -> np.ndarray:
    """One-hot hashed language and source and length bins per row; nulls are values too."""
    out = np.zeros((len(langs), META), np.float32)
    for k, (lang, source, size) in enumerate(zip(langs, sources, sizes)):
        out[k, zlib.crc32(repr(("lang", lang)).encode()) % 32] = 1
        out[k, 32 + zlib.crc32(repr(("source", source)).encode()) % 64] = 1
        out[k, 96 + min(31, int(2 * np.log2(1 + max(0, size or 0))))] = 1
    return out


@dataclass
class Logistic:
    """Standardised logistic regression, with a calibration line."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        # Summed row by row, so that a score does not depend on the rows beside it.
        return ((x - self.mean) / self.scale * self.weights).sum(axis=1) + self.bias

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.raw(x) + self.shift, -12, 12)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.02, steps: int = 150) -> Logistic:
    """Gradient descent with momentum on the mean log loss plus an L2 penalty."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    w, b = np.zeros(x.shape[1], np.float64), 0.0
    vw, vb, rate = np.zeros_like(w), 0.0, 0.3 / max(1.0, np.sqrt((z * z).sum(axis=1).mean() / 20))
    for _ in range(steps):
        e = _sigmoid(z @ w + b) - y
        vw = 0.9 * vw - rate * (z.T @ e / len(y) + penalty * w)
        vb = 0.9 * vb - rate * e.mean()
        w, b = w + vw, b + vb
    return Logistic(mean, scale, w, b)


def calibrate(model: Logistic, x: np.ndarray, y: np.ndarray, steps: int = 300) -> None:
    """Line through the raw scores that fits held-out labels (Platt scaling)."""
    r = model.raw(x)
    spread = r.std() + 1e-9
    z, a, c = r / spread, 1.0, 0.0
    for _ in range(steps):
        e = _sigmoid(a * z + c) - y
        a, c = a - 0.5 * ((e * z).mean() + 0.001 * a), c - 0.5 * e.mean()
    model.slope, model.shift = a / spread, c


@dataclass
class CoTrained:
    content: Logistic | None
    metadata: Logistic | None
    prior: float      # log-odds of good labels

    def score(self, content: np.ndarray, metadata: np.ndarray):
        """(content, metadata, combined) probabilities."""
        if self.content is None:
            p = np.full(len(content), _sigmoid(self.prior))
            return p, p, p
        a, b = self.content.logit(content), self.metadata.logit(metadata)
        return _sigmoid(a), _sigmoid(b), _sigmoid(a + b - self.prior)


def co_train(content: np.ndarray, metadata: np.ndarray, label: np.ndarray, rounds: int = ROUNDS,
             per_round: int = PER_ROUND) -> CoTrained:
    """``label``: 1 good, 0 bad, -1 unlabelled.  Every third labelled row is kept for
    calibration.  Without labels of both kinds the model is the base rate."""
    known = np.flatnonzero(label >= 0)
    rate = (label[known].sum() + 1) / (len(known) + 2)
    prior = float(np.log(rate / (1 - rate)))
    held, use = known[::3], np.setdiff1d(known, known[::3])
    if min((label[use] == 1).sum(), (label[use] == 0).sum()) < 2 or len(np.unique(label[held])) < 2:
        return CoTrained(None, None, prior)
    views = [content, metadata]
    mine = [use.copy(), use.copy()]
    labels = [label[use].astype(float), label[use].astype(float)]
    free = np.flatnonzero(label < 0)
    for _ in range(rounds + 1):
        models = [fit(v[m], y) for v, m, y in zip(views, mine, labels)]
        if len(free) == 0 or _ == rounds:
            break
        taken = []
        for v in (0, 1):
            p = _sigmoid(models[v].raw(views[v][free]))
            n = min(per_round, len(free) // 4)
            order = np.argsort(p, kind="stable")
            bad, good = order[:max(1, int(n * (1 - rate)))], order[len(order) - int(n * rate):]
            bad, good = bad[p[bad] < 0.1], good[p[good] > 0.9]
            mine[1 - v] = np.concatenate([mine[1 - v], free[bad], free[good]])
            labels[1 - v] = np.concatenate([labels[1 - v], np.zeros(len(bad)), np.ones(len(good))])
            taken += [*free[bad], *free[good]]
        free = np.setdiff1d(free, taken)
    for m, v in zip(models, views):
        calibrate(m, v[held], label[held].astype(float))
    return CoTrained(models[0], models[1], prior)


def _share(rows: int, of: int) -> float:
    return min(1.0, 1.5 * rows / max(of, 1) + 50 / max(of, 1))


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with ``mark``, a hash of all that the features come from: rows of one mark are equal."""
    told = F.to_json(F.struct("doc_id", "lang", "source", F.col("text").isNull().alias("no_text")))
    return rows.withColumn("mark", F.xxhash64(told, "text"))


def sample(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """The bounded sample: (doc_id, mark, label), label -1 for rows without one.  Of rows that
    share an id the one with the smallest mark stands for it; of labels that contradict
    each other the smaller counts."""
    one = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1))
           .groupBy("doc_id").agg(F.min(label_col).cast("int").alias("label")))
    part = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    ids = materialize(docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("mark").alias("mark")), "quality-ids")
    n_labels, n_docs = one.count(), ids.count()
    known = (one.where(part < _share(LABELLED, n_labels)).join(ids, "doc_id")
             .orderBy(F.xxhash64("mark", F.lit(1)), "doc_id").limit(LABELLED))
    other = (ids.where(part < _share(2 * UNLABELLED, n_docs)).join(one, "doc_id", "left_anti")
             .orderBy(F.xxhash64("mark", F.lit(1)), "doc_id").limit(UNLABELLED).withColumn("label", F.lit(-1)))
    return materialize(known.select("doc_id", "mark", "label").union(other.select("doc_id", "mark", "label")), "quality-sample")


_NAMES = ["doc_id", "text", "lang", "source", "size"]


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw, at = text_bytes(batch.column("text"))
    return content_features(raw, at), metadata_features(*[batch.column(c).to_pylist() for c in ("lang", "source", "size")])


def _prepared(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       size.alias("size"))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> CoTrained:
    """The two views, trained on a bounded sample of ``docs`` and their ``labels`` (0 or 1).

    The sample and the model are the same whatever the order and the partitions of the
    rows: rows are picked by hash, and of rows that share an id one stands for it (see
    ``sample``).  Rows without an id are not learned from.  Other labels than 0 and 1,
    and labels of ids that ``docs`` lacks, are not used; without labels of both kinds the
    model is the base rate.  A very long text is read whole, in one task.
    """
    ship_package(docs.sparkSession)
    rows = _marked(_prepared(docs))
    picked = sample(rows, labels, label_col)
    # The sample has at most LABELLED + UNLABELLED rows, so its ids may be broadcast.
    texts = rows.join(F.broadcast(picked), ["doc_id", "mark"]).dropDuplicates(["doc_id"])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                content, metadata = _views(batch)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("label"),
                    pa.array([x.tobytes() for x in content], pa.binary()),
                    pa.array([x.tobytes() for x in metadata], pa.binary())], ["doc_id", "label", "content", "metadata"])

    features = materialize(texts.select(*_NAMES, "label").mapInArrow(
        run, "doc_id bigint, label int, content binary, metadata binary"), "quality-features")
    got = features.orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    view = lambda c, n: (np.stack([np.frombuffer(r[c], np.float32) for r in got]) if got
                         else np.zeros((0, n), np.float32))
    return co_train(view("content", GRAMS + SHARES), view("metadata", META),
                    np.array([r["label"] for r in got], np.int64))


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``p_content``, ``p_metadata``, ``score``
    (0 to 1, how good) and ``kept`` (from one half).  A null text is an empty one; null language and source
    are values of their own; an empty table gives an empty table."""
    ship_package(docs.sparkSession)
    share = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[
        T.StructField(c, T.DoubleType()) for c in ("p_content", "p_metadata", "score")],
        T.StructField("kept", T.BooleanType())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                for start in range(0, batch.num_rows, 2048):
                    rows = batch.slice(start, 2048)
                    a, b, both = share.value.score(*_views(rows))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id"), pa.array(a, pa.float64()), pa.array(b, pa.float64()),
                         pa.array(both, pa.float64()), pa.array(both >= 0.5)], schema.names)

    return _prepared(docs).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """Train on ``docs`` and ``labels`` and score all of ``docs``: see ``train`` and ``score``.
    Repeated rows and rows that share an id are each scored by their own text; columns of
    ``docs`` other than id, text, language and source are not read."""
    return score(docs, train(docs, labels, label_col))
