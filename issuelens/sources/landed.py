"""Landed API payloads (SRC-1..SRC-4) and the lookup file (SRC-6).

Pages fetched from the code host / issue tracker land as JSON files.  They are
read as text, a page a file (``multi_line``) or a line, and parsed with fixed
schemas (no inference).  A page is one element or an array of them.  A page that
is cut off, is no JSON, holds values of other types or an element without its
keys is not loaded in part: it comes back with a ``reason`` and its whole text, for
the quarantine (``streaming.quarantine``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens import schemas
from issuelens.operators.normalize import explode_issue_page

NTZ_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Pages:
    """What pages of one kind hold: the schema of an element, and whether one has its keys."""
    element: T.StructType
    has_keys: Callable[[Column], Column]


def _no_null(entries: Column, key: str) -> Column:
    return F.forall(entries, lambda e: e[key].isNotNull())


PULL_REQUEST_PAGES = Pages(schemas.PR_RAW, lambda e: e["id"].isNotNull())
COMMIT_PAGES = Pages(schemas.COMMIT_RAW, lambda e: e["sha"].isNotNull() & e["pull_request_id"].isNotNull())
ISSUE_PAGES = Pages(schemas.ISSUE_PAGE, lambda e: e["issues"].isNotNull() & _no_null(e["issues"], "key"))
# A record without history is one of an issue that never changed.
CHANGELOG_PAGES = Pages(schemas.CHANGELOG_RAW, lambda e: F.coalesce(e["issue_key"], e["key"]).isNotNull() & F.coalesce(
    _no_null(F.coalesce(e["changelog"]["histories"], e["values"]), "id"), F.lit(True)))


def parse_pages(texts: DataFrame, pages: Pages, col: str = "value") -> DataFrame:
    """``texts`` with ``page`` (array of elements) and ``reason``: null, or why the page
    cannot be loaded (``unparsable``, ``no key``)."""
    body = F.btrim(F.col(col), F.lit(" \t\r\n\ufeff"))
    listed = F.when(body.startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    schema = T.StructType([T.StructField("page", T.ArrayType(pages.element)), T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.concat(F.lit('{"page":'), listed, F.lit("}")), schema, {"columnNameOfCorruptRecord": CORRUPT})
    out = texts.withColumn("_parsed", parsed)
    page = F.col("_parsed.page")
    whole = F.coalesce(F.forall(page, lambda e: F.coalesce(pages.has_keys(e), F.lit(False))), F.lit(False))
    reason = (F.when((body == "") | F.col(f"_parsed.{CORRUPT}").isNotNull() | page.isNull(), "unparsable")
              .when(~whole, "no key"))
    return out.select(*texts.columns, page.alias("page"), reason.alias("reason"))


def page_rows(parsed: DataFrame, keep=()) -> DataFrame:
    """The elements of the pages that can be loaded, with ``_el``, their place in the page."""
    good = parsed.where("reason IS NULL")
    return good.select(F.posexplode("page").alias("_el", "_e"), *keep).select("_e.*", "_el", *keep)


def page_texts(reader, path: str, multi_line: bool) -> DataFrame:
    """The text of each page below ``path``; ``reader`` is ``spark.read`` or ``readStream``.
    Blank lines between pages are none; a blank file is a page that was cut off (one of no
    bytes at all is not read by Spark)."""
    texts = reader.format("text").option("wholetext", multi_line).load(path).select(
        "value", F.col("_metadata.file_path").alias("_file"))
    return texts if multi_line else texts.where(F.length(F.btrim("value", F.lit(" \t\r"))) > 0)


def _read(spark: SparkSession, pages: Pages, path: str, multi_line: bool) -> DataFrame:
    return page_rows(parse_pages(page_texts(spark.read, path, multi_line), pages)).drop("_el")


def read_pull_request_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SRC-1."""
    return _read(spark, PULL_REQUEST_PAGES, path, multi_line)


def read_commit_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SRC-2: landed commits carry ``pull_request_id`` / ``pull_request_number``."""
    return _read(spark, COMMIT_PAGES, path, multi_line)


def read_issue_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SRC-3: search envelopes → one row per issue, ``fields`` as raw JSON text."""
    return explode_issue_page(_read(spark, ISSUE_PAGES, path, multi_line)).drop("_ipos")


def read_changelog_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """SRC-4: changelog records of either API shape (see ``flatten_changelog``)."""
    return _read(spark, CHANGELOG_PAGES, path, multi_line)


def parse_json_column(df: DataFrame, col: str, schema) -> DataFrame:
    """The same payload schemas applied to JSON text already in a column."""
    return df.select(F.from_json(F.col(col), schema).alias("_r")).select("_r.*")


def read_transition_lookup(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: the (source, target) → classification, type CSV (header row)."""
    return spark.read.schema(schemas.STATUS_LOOKUP).option("header", True).csv(path)
