"""Jobs from landed files to sorted result files.

``ingest`` loads what has landed into a warehouse folder; ``timeline`` and
``chains`` read the warehouse's tables and write the CSV results.  Each applies
the session settings, and with ``input_bytes`` those of a cluster of that load.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from issuelens.plans.chains import status_chains
from issuelens.plans.timeline import status_timeline
from issuelens.session import apply_session_defaults, cluster_settings
from issuelens.sources.landed import read_transition_lookup
from issuelens.sources.sinks import write_csv
from issuelens.sources.tables import BUCKETS, Warehouse
from issuelens.streaming.ingest import ingest_issues, ingest_pull_requests


def prepare(spark: SparkSession, input_bytes: int | None = None) -> None:
    apply_session_defaults(spark)
    for k, v in (cluster_settings(input_bytes) if input_bytes else {}).items():
        spark.conf.set(k, v)


def ingest(spark: SparkSession, landing: str, warehouse: str, checkpoints: str, provider: str = "github",
           project: str | None = None, as_of=None, input_bytes: int | None = None, buckets: int = BUCKETS) -> Warehouse:
    """Load ``landing``'s ``pull_requests``, ``commits``, ``issues`` and ``changelog`` folders.
    ``buckets`` counts for tables that are first written."""
    prepare(spark, input_bytes)
    ingest_pull_requests(spark, f"{landing}/pull_requests", f"{landing}/commits", warehouse, checkpoints, provider,
                         buckets=buckets)
    return ingest_issues(spark, f"{landing}/issues", f"{landing}/changelog", warehouse, checkpoints, as_of=as_of,
                         project=project, buckets=buckets)


def timeline(spark: SparkSession, warehouse: str, out: str, input_bytes: int | None = None) -> None:
    """First and last time of each issue in each status, sorted by issue key (SNK-3)."""
    prepare(spark, input_bytes)
    store = Warehouse(spark, warehouse)
    write_csv(status_timeline(store.read("jira_issues"), store.read("jira_changelog")), out, ["key"])


def chains(spark: SparkSession, warehouse: str, lookup: str, out: str, input_bytes: int | None = None,
           lookup_how: str = "inner") -> None:
    """Classified transitions with their issue's chain, sorted by issue and step (SNK-4)."""
    prepare(spark, input_bytes)
    store = Warehouse(spark, warehouse)
    rows = status_chains(store.read("jira_issues"), store.read("jira_changelog"), read_transition_lookup(spark, lookup),
                         lookup_how=lookup_how)
    write_csv(rows, out, ["issue_key", "step"])
