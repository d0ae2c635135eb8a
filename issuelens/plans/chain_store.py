"""Status chains by fingerprint, with ids that stay over loads (AGG-8, AGG-9).

A chain is told by sums of a hash of each (place, status), which partial
aggregates add up, so a history of any length makes neither a label per row nor an
array.  The dictionary gives each distinct chain an id once; a later load looks its
chains up and numbers only those it has not seen, after the last id.  The statuses
of a chain are stored once, as rows, from the first issue that has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens import schemas
from issuelens.operators.sequence import global_rank, resolve_strategy, sequence_rows
from issuelens.operators.stage import materialize
from issuelens.plans.chains import collapse_repeats
from issuelens.plans.transitions import status_history, status_transitions
from issuelens.session import path_exists

CHAIN_IDS = T.StructType([
    T.StructField("fingerprint", T.StringType()), T.StructField("chain_id", T.LongType()),
    T.StructField("first_key", T.StringType()), T.StructField("n_steps", T.LongType()), T.StructField("load", T.IntegerType())])
CHAIN_STEPS = T.StructType([
    T.StructField("chain_id", T.LongType()), T.StructField("place", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("load", T.IntegerType())])


def chain_places(issues: DataFrame, changelog: DataFrame, lookup: DataFrame, strategy: str = "auto",
                 lookup_how: str = "inner") -> DataFrame:
    """(issue_key, place, source, target): the kept transitions of each issue, numbered."""
    strategy = resolve_strategy(status_history(changelog), ["issue_key"], strategy)
    tr = materialize(status_transitions(issues, changelog, lookup, strategy=strategy, lookup_how=lookup_how), "transitions")
    kept = collapse_repeats(tr, strategy=strategy)
    placed = sequence_rows(kept, ["issue_key"], ["step"], step_col="place", strategy=strategy)
    return materialize(placed.select("issue_key", "place", "source", "target"), "chain-places")


def fingerprints(places: DataFrame) -> DataFrame:
    """(issue_key, fingerprint, n_steps): one partial aggregate.  Four sums of 32 bits each
    of two hashes cannot overflow below two thousand million steps."""
    low = F.lit(0xFFFFFFFF)
    sums = []
    for h in (F.xxhash64("place", "target"), F.xxhash64("target", F.lit("chain"), "place")):
        sums += [F.sum(h.bitwiseAND(low)), F.sum(F.shiftrightunsigned(h, 32))]
    first = F.min_by("source", "place")
    told = F.md5(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *[s.cast("string") for s in sums],
                             F.coalesce(F.concat(F.lit("="), first), F.lit(""))))
    return places.groupBy("issue_key").agg(told.alias("fingerprint"), F.count(F.lit(1)).alias("n_steps"))


class ChainStore:
    """The dictionary and the chains' statuses, as Parquet by load below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            return schemas.empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).parquet(path)

    def _write(self, name: str, rows: DataFrame) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load")
         .parquet(f"{self.root}/{name}"))

    def ids(self) -> DataFrame:
        return self._read("chain_ids", CHAIN_IDS)

    def steps(self) -> DataFrame:
        """(chain_id, place, status, load); place 0 is the first source."""
        return self._read("chain_steps", CHAIN_STEPS)

    def extend(self, places: DataFrame, load: int) -> DataFrame:
        """Number the chains that no earlier load had, by their smallest issue key, and return
        (issue_key, chain_id) of the load's issues.  A load that is run again writes
        the same rows again; loads are numbered upwards."""
        known = self.ids().where(F.col("load") < load)
        prints = materialize(fingerprints(places), "chain-prints")
        firsts = prints.groupBy("fingerprint").agg(F.min("issue_key").alias("first_key"), F.first("n_steps").alias("n_steps"))
        fresh = firsts.join(known.select("fingerprint"), "fingerprint", "left_anti")
        last = known.agg(F.coalesce(F.max("chain_id"), F.lit(0))).first()[0]
        ranked = global_rank(fresh, ["first_key"], name="n")
        ranked = materialize(ranked.select("fingerprint", (F.col("n") + last).alias("chain_id"), "first_key", "n_steps",
                                           F.lit(load).alias("load")), "new-chains")
        told = places.join(ranked.select(F.col("first_key").alias("issue_key"), "chain_id"), "issue_key")
        first = told.where("place = 1").select("chain_id", F.lit(0).cast("long").alias("place"), F.col("source").alias("status"))
        rest = told.select("chain_id", "place", F.col("target").alias("status"))
        # The dictionary last: ids without statuses are never read.
        self._write("chain_steps", first.union(rest).withColumn("load", F.lit(load)))
        self._write("chain_ids", ranked)
        every = known.select("fingerprint", "chain_id").union(ranked.select("fingerprint", "chain_id"))
        return prints.join(every, "fingerprint").select("issue_key", "chain_id")

    def texts(self) -> DataFrame:
        """(chain_id, chain): the text of each distinct chain, made once."""
        places = F.transform(F.array_sort(F.collect_list(F.struct("place", "status"))), lambda x: x["status"])
        return self.steps().groupBy("chain_id").agg(F.array_join(places, " > ").alias("chain"))
