"""Quality rules: fixed limits, then robust multivariate outliers.

Every text gets word, symbol and repetition counts inside its own row (nothing
is exploded).  The counts become a vector of five transformed statistics.  Per
language and source a minimum-covariance-determinant estimate of centre and
covariance is found by concentration steps: distances to the current estimate,
the three quarters of the rows that are nearest, their mean and covariance, and
again; then one reweighting step.  A row is rejected when its Mahalanobis
distance to its group's estimate is too large.

A concentration step is one aggregate: the moments are summed by group and bin
of the distance, and the bins of a group that hold its nearest rows are added
up.  So a language and source with a third of all rows is only ever a partial
aggregate, and at most a few hundred sums per group meet in one task.  The
statistics are whole multiples of 1/1024 held in doubles, so sums are exact (up
to some ten million rows of a group) and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelens.llm.common import UPPER, WHITE, words
from issuelens.operators.sizing import has_at_most
from issuelens.operators.stage import materialize

SYMBOLS = "#*$%&|<>"
GRAIN = 1024.0
#: Least standard deviation of each statistic, so that a statistic that is 0 in
#: nearly all rows of a group does not reject every other row.
FLOORS = (0.10, 0.25, 0.25, 0.25, 0.25)
DIMS = len(FLOORS)
PART = 0.75            # part of a group's rows that the estimate rests on
CONSISTENCY = 1.42     # makes the covariance of that part fit all rows (5 dimensions, normal)
REWEIGHT_AT = 12.83    # 0.975 point of chi-square with 5 degrees
REWEIGHTED = 1.06
REJECT_AT = 40.0       # squared distance of an outlier: a normal row in ten million has more
STEPS = 4
MIN_GROUP = 50
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
X = [f"__qr_x{i}" for i in range(DIMS)]
M = [f"__qr_m{i}" for i in range(DIMS)]
LOWER_CELLS = [(i, j) for i in range(DIMS) for j in range(i + 1)]


def _l(i: int, j: int) -> str:
    return f"__qr_l{i}{j}"


def repeat_words(hashes: Column, windows: str, dup: str) -> Column:
    """Words covered by windows that occur at least twice: ``dup`` is the sorted
    array of (hash, position) where there are any, else null."""
    n = F.size(dup)
    same = F.filter(dup, lambda x, i: (
        ((i > 0) & (F.get(F.col(dup), i - 1)["h"] == x["h"])) |
        ((i < n - 1) & (F.get(F.col(dup), i + 1)["h"] == x["h"]))))
    return F.array_sort(F.transform(same, lambda x: x["i"]))


def base_statistics(docs: DataFrame, text_col: str, prefix: str = "__qr_", window: int = 5) -> DataFrame:
    """``docs`` with the five base counts (long) as ``prefix`` + name, the letter
    case count, and ``prefix + base_failed``.  A null text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    p = prefix
    df = docs.withColumn(p + "t", text)
    lines = F.filter(F.split(p + "t", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    df = df.withColumns({
        p + "w": F.transform(words(F.col(p + "t")), lambda w: F.xxhash64(w)),
        p + "lines": lines,
        p + "chars": F.length(F.translate(p + "t", WHITE, "")).cast("long"),
        p + "n_symbols": (F.length(p + "t") - F.length(F.translate(p + "t", SYMBOLS, ""))).cast("long"),
        p + "upper": (F.length(p + "t") - F.length(F.translate(p + "t", UPPER, ""))).cast("long")})
    w = F.col(p + "w")
    at = F.sequence(F.lit(0), F.size(w) - window)
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
    df = df.withColumns({
        p + "n_words": F.size(w).cast("long"),
        p + "h": F.when(F.size(w) >= window, hashes).otherwise(F.array().cast("array<bigint>")),
        p + "word_chars": F.col(p + "chars"),
        p + "n_dup_lines": (F.size(p + "lines") - F.size(F.array_distinct(p + "lines"))).cast("long")})
    h = F.col(p + "h")
    df = df.withColumn(p + "dup", F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    df = df.withColumn(p + "pos", F.when(F.col(p + "dup").isNotNull(), repeat_words(h, p + "h", p + "dup")))
    pos = F.col(p + "pos")
    covered = F.aggregate(
        F.transform(pos, lambda x, k: F.when(k == 0, window).otherwise(F.least(F.lit(window), x - F.get(pos, k - 1)))),
        F.lit(0), lambda a, x: a + x)
    df = df.withColumn(p + "n_repeat_words", F.when(pos.isNull(), 0).otherwise(covered).cast("long"))
    df = df.withColumn(p + "base_failed", (F.col(p + "n_words") < 10) |
                       (100 * F.col(p + "n_repeat_words") > 20 * F.col(p + "n_words")))
    return df.drop(*[p + c for c in ("t", "w", "lines", "chars", "h", "dup", "pos")])


def _statistics(p: str) -> list[Column]:
    n = F.greatest(F.col(p + "n_words"), F.lit(1)).cast("double")
    per_word = lambda c, k: F.log1p(k * F.col(p + c) / n)
    raw = [F.log(F.greatest(F.col(p + "word_chars"), F.lit(1)) / n), per_word("n_symbols", 10.0),
           per_word("n_dup_lines", 100.0), per_word("n_repeat_words", 10.0),
           F.log1p(10.0 * F.col(p + "upper") / F.greatest(F.col(p + "word_chars"), F.lit(1)))]
    return [F.round(x * GRAIN) for x in raw]


#: Rows of a table by group up to which it is broadcast (some 20 numbers each: 20 MB).
BROADCAST_GROUPS = 100_000
SALTS = 64


def _by_group(rows: DataFrame, small: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``small``, a written table of one row per group ``g``.  It is
    broadcast if its count allows; else every group meets its rows in ``SALTS`` parts, so
    no task gets all rows of a group."""
    if has_at_most(small, BROADCAST_GROUPS):
        return rows.join(F.broadcast(small), "g", how)
    part = F.monotonically_increasing_id() % SALTS
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    return (rows.withColumn("__qr_part", part).join(small.withColumn("__qr_part", every), ["g", "__qr_part"], how)
            .drop("__qr_part"))


def _groups(rows: DataFrame, min_group: int) -> DataFrame:
    """Each row's group: (language, source); for a small one the rest of its
    language; for a small rest all such rows."""
    g1 = F.struct(F.lit(0).alias("k"), F.col("lang").alias("a"), F.col("source").alias("b"))
    g2 = F.struct(F.lit(1).alias("k"), F.col("lang").alias("a"), F.lit(None).cast("string").alias("b"))
    g3 = F.struct(F.lit(2).alias("k"), F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    sizes = rows.groupBy("lang", "source").agg(F.sum(F.when(F.col("ok"), 1).otherwise(0)).alias("n"))
    over = Window.partitionBy("lang")
    rest = F.sum(F.when(F.col("n") < min_group, F.col("n")).otherwise(0)).over(over)
    named = sizes.withColumn("rest", rest).select(
        "lang", "source", F.when(F.col("n") >= min_group, g1).when(F.col("rest") >= min_group, g2)
        .otherwise(g3).alias("g"))
    return named.withColumn("g", F.to_json("g"))


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(x).alias(f"s{i}") for i, x in enumerate(X)]
    aggs += [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"c{i}{j}") for i, j in LOWER_CELLS]
    return rows.groupBy(*by).agg(*aggs)


def _estimate(sums: DataFrame, factor: float) -> DataFrame:
    """Centre and Cholesky factor of the (floored) covariance, from sums per group."""
    n = F.col("n")
    df = sums.select("g", *[(F.col(f"s{i}") / n).alias(M[i]) for i in range(DIMS)],
                     *[((F.col(f"c{i}{j}") / n - (F.col(f"s{i}") / n) * (F.col(f"s{j}") / n)) * factor
                        + ((FLOORS[i] * GRAIN) ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in LOWER_CELLS])
    for i, j in LOWER_CELLS:
        dot = F.lit(0.0)
        for k in range(j):
            dot = dot + F.col(_l(i, k)) * F.col(_l(j, k))
        # The floors keep every pivot at least the floor's square, but for rounding.
        df = df.withColumn(_l(i, j), F.sqrt(F.greatest(F.col(f"c{i}{j}") - dot, F.lit(1.0))) if i == j
                           else (F.col(f"c{i}{j}") - dot) / F.col(_l(j, j)))
    return df.select("g", *M, *[_l(i, j) for i, j in LOWER_CELLS])


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    y: list[Column] = []
    for i in range(DIMS):
        v = F.col(X[i]) - F.col(M[i])
        for k in range(i):
            v = v - F.col(_l(i, k)) * y[k]
        y.append(v / F.col(_l(i, i)))
    out = y[0] * y[0]
    for v in y[1:]:
        out = out + v * v
    return out


def _start(rows: DataFrame) -> DataFrame:
    """First estimate: median and quartile range of each statistic on its own."""
    cells = rows.select("g", F.posexplode(F.array(*[F.floor(F.col(x) / 16).cast("int") for x in X])).alias("d", "v"))
    counts = cells.groupBy("g", "d", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("g", "d")
    upto = F.sum("n").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.withColumns({"upto": upto, "all": F.sum("n").over(w)})
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("v"))) * 16.0 + 8.0
    spread = counts.groupBy("g", "d").agg(at(0.5).alias("m"), ((at(0.75) - at(0.25)) / 1.349).alias("sd"))
    flat = spread.groupBy("g").agg(
        *[F.max(F.when(F.col("d") == i, F.col("m"))).alias(M[i]) for i in range(DIMS)],
        *[F.max(F.when(F.col("d") == i, F.sqrt(F.col("sd") ** 2 + (FLOORS[i] * GRAIN) ** 2))).alias(_l(i, i))
          for i in range(DIMS)])
    return flat.withColumns({_l(i, j): F.lit(0.0) for i, j in LOWER_CELLS if i != j})


def _concentrate(rows: DataFrame, est: DataFrame) -> DataFrame:
    d2 = F.floor(F.log(_distance() + 1e-6) * 8).cast("int").alias("bin")
    binned = _moments(_by_group(rows, est).select("g", d2, *X), ["g", "bin"])
    w = Window.partitionBy("g")
    before = F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    near = binned.withColumns({"before": before, "all": F.sum("n").over(w)}).where(
        F.col("before") < F.col("all") * PART)
    sums = near.groupBy("g").agg(*[F.sum(c).alias(c) for c in near.columns if c not in ("g", "bin", "before", "all")])
    return _estimate(sums, CONSISTENCY)


ROW = "__qr_row"


def score_rows(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang",
               source_col: str = "source", min_group: int = MIN_GROUP, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, base counts, ``base_failed``, ``distance2`` and
    ``kept``; with ``carry`` also the whole row as a struct (``__qr_row``).

    Texts are read once: their statistics are written (with the rows, if carried),
    and the estimates read only the narrow columns of that.  A group (language and source)
    with fewer than ``min_group`` rows that pass the limits is judged with the rest of its
    language, and a small rest with all such rows, as an estimate of few rows is none.

    A null text has no words; null languages and sources are values of their own; rows that
    are equal have equal results, each its own row; a very long text is some arrays in
    one row; an empty table gives an empty table."""
    p = "__qr_"
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW)] if carry else []
    stats = base_statistics(docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), *whole),
        "text", p)
    stats = stats.select("doc_id", "lang", "source", *[F.col(p + b).alias(b) for b in BASE],
                         F.col(p + "base_failed").alias("base_failed"), (~F.col(p + "base_failed")).alias("ok"),
                         *[x.alias(n) for x, n in zip(_statistics(p), X)], *[ROW] * carry)
    stats = materialize(stats, "quality-stats")
    groups = materialize(_groups(stats, min_group), "quality-groups")
    # The group's name by language and source, itself a table of one row per group.
    pair = F.to_json(F.struct("lang", "source"))
    rows = _by_group(stats.withColumn("g", pair), groups.select(pair.alias("g"), F.col("g").alias("__qr_g"))).drop("g")
    rows = rows.withColumnRenamed("__qr_g", "g")
    fit = materialize(rows.where("ok").select("g", *X), "quality-rows")
    est = materialize(_start(fit), "quality-start")
    for _ in range(STEPS):
        est = materialize(_concentrate(fit, est), "quality-step")
    near = _by_group(fit, est).where(_distance() <= REWEIGHT_AT).select("g", *X)
    est = materialize(_estimate(_moments(near, ["g"]), REWEIGHTED), "quality-estimate")
    scored = _by_group(rows, est, "left").withColumn("distance2", F.when(F.col("ok"), _distance()))
    # A group without rows that pass the limits has no estimate, and no row to judge.
    kept = F.col("ok") & (F.coalesce("distance2", F.lit(0.0)) <= REJECT_AT)
    return scored.select("doc_id", "lang", "source", *BASE, "base_failed", "distance2", kept.alias("kept"),
                         *[ROW] * carry)


def quality_rules(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang",
                  source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    Null and empty texts have no words and go; null languages and sources are
    groups of their own; identical rows share their verdict; an empty table
    gives an empty table.  No text is shuffled: a row's verdict comes from its
    own statistics and its group's estimate.
    """
    scored = score_rows(docs, text_col, id_col, lang_col, source_col, carry=True)
    return scored.where("kept").select(f"{ROW}.*")
