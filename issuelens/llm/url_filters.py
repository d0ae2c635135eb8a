"""URL filter rules looked up by their rarest literal token.

Every rule is a regular expression over host + path with the literal tokens
(ASCII letter and digit runs) that each match must hold.  The tokens' numbers
of URLs are counted over the whole table, each rule is filed under its rarest
token, the tokens of each distinct URL fetch the rules filed under them, and
only those run their expression.  Rules without a token are tried on all URLs.

The index is a plain equi-join on the token: a small rule list is broadcast by
Spark's own size check, a large one is joined by shuffle, where a common token
is split by adaptive execution (it is nobody's rarest token unless it is the
only one).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.llm.common import ascii_lower
from issuelens.operators.stage import materialize

TARGET = "__uf_target"


@dataclass(frozen=True)
class SiteRule:
    """A host with its subdomains, and the start of the path (``example.com/en/``)."""
    action: str
    name: str

    @property
    def pattern(self) -> str:
        return r"^(?:[^/]*\.)?" + _quoted(self.name)

    @property
    def tokens(self) -> list[str]:
        whole = self.name if not self.name[-1:].isalnum() else re.sub(r"[0-9A-Za-z]+$", "", self.name)
        return re.findall("[0-9A-Za-z]+", whole)


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over host + path and literal tokens of each match."""
    action: str
    pattern: str
    tokens: Sequence[str] = field(default_factory=tuple)


def _quoted(text: str) -> str:
    return re.sub(r"([^0-9A-Za-z/])", r"\\\1", text)


# Pattern rules used where no site rule fits.
DEFAULT_PATTERNS = (
    PatternRule("block", r"^(?:[^/]*\.)?spam-farm\.", ("spam", "farm")),
    PatternRule("block", r"^(?:[^/]*\.)?casino\.", ("casino",)),
    PatternRule("block", r"^[^/]*/(?:.*/)?ad/", ("ad",)),
    PatternRule("block", r"^[^/]*/(?:.*/)?ads/", ("ads",)),
    PatternRule("block", r"^(?:[^/]*\.)?adserver\.", ("adserver",)),
    PatternRule("block", r"^(?:[^/]*\.)?tracker\.", ("tracker",)),
    PatternRule("block", r"^[^/]*/(?:.*/)?login/", ("login",)),
    PatternRule("block", r"^[^/]*/(?:.*/)?wp-admin/", ("wp", "admin")),
    PatternRule("block", r"^[^/]*/(?:.*/)?cgi-bin/", ("cgi", "bin")),
    PatternRule("block", r"^(?:[^/]*\.)?xxx(?:/|$)", ("xxx",)),
    PatternRule("block", r"^[^/]*/(?:.*/)?porn/", ("porn",)),
)


def url_parts(url) -> tuple:
    """(host, path) of a URL column: both empty when it is null or has no ``://``."""
    known = F.coalesce(url, F.lit(""))
    form = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(known, form, 1)), F.regexp_extract(known, form, 2)


def _rule_table(spark, sites: Sequence[SiteRule], patterns: Sequence[PatternRule]) -> DataFrame:
    rows = [(n, r.action, r.name, r.pattern, list(r.tokens), len(r.name)) for n, r in enumerate(sites)]
    rows += [(len(sites) + n, r.action, None, r.pattern, list(r.tokens), 0) for n, r in enumerate(patterns)]
    return spark.createDataFrame(
        rows, "no int, action string, name string, pattern string, tokens array<string>, length int")


def url_filter(pages: DataFrame, sites: Sequence[SiteRule], patterns: Sequence[PatternRule] = DEFAULT_PATTERNS,
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, the longest fitting site rule (null: none) and the
    verdict: that rule's action, else ``block`` if a blocking pattern matches,
    else ``default``.

    The four columns replace input columns of these names.  Null URLs and URLs
    without ``://`` have empty host and path.  Of equal site rules the first
    listed wins.  Repeated URLs are judged once and share the verdict; an empty
    table gives an empty table.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col))
    base = pages.withColumns({"__uf_host": host, "__uf_path": path})
    base = base.withColumn(TARGET, F.concat("__uf_host", "__uf_path"))
    targets = base.select(TARGET).distinct()
    tokens = F.array_distinct(F.filter(F.split(TARGET, "[^0-9A-Za-z]+"), lambda t: t != ""))
    urls = materialize(targets.select(TARGET, tokens.alias("tokens")), "urls")

    rules = _rule_table(spark, sites, patterns)
    used = rules.select("no", F.explode("tokens").alias("token"))
    counts = (urls.select(F.explode("tokens").alias("token"))
              .join(used.select("token").distinct(), "token", "left_semi")
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    rarest = (used.join(counts, "token", "left")
              .groupBy("no").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("r"))
              .select("no", F.col("r.token").alias("token")))
    index = materialize(rules.drop("tokens").join(rarest, "no", "left"), "url-rules")

    fetched = (urls.select(TARGET, F.explode("tokens").alias("token"))
               .join(index.where(F.col("token").isNotNull()), "token").drop("token"))
    unfiled = sorted(i for i, r in enumerate([*sites, *patterns]) if not r.tokens)
    if unfiled:  # tried on every URL: one literal list, no join
        free = [[*sites, *patterns][i] for i in unfiled]
        listed = F.array(*[F.struct(
            F.lit(i).alias("no"), F.lit(r.action).alias("action"),
            F.lit(getattr(r, "name", None)).cast("string").alias("name"), F.lit(r.pattern).alias("pattern"),
            F.lit(len(getattr(r, "name", ""))).alias("length")) for i, r in zip(unfiled, free)])
        tried = urls.select(TARGET, F.inline(listed)).select(fetched.columns)
        fetched = fetched.unionByName(tried)
    hits = fetched.where(F.expr(f"{TARGET} rlike pattern"))
    site = F.col("name").isNotNull()
    best = F.max(F.when(site, F.struct(F.col("length"), (-F.col("no")).alias("first"), F.col("name"), F.col("action"))))
    found = hits.groupBy(TARGET).agg(
        best.alias("__uf_best"),
        F.max(F.when(~site & (F.col("action") == "block"), 1).otherwise(0)).alias("__uf_block"))
    out = base.join(materialize(found, "url-hits"), TARGET, "left")
    verdict = F.coalesce(F.col("__uf_best.action"),
                         F.when(F.col("__uf_block") == 1, "block").otherwise(default))
    out = out.withColumns({"host": F.col("__uf_host"), "path": F.col("__uf_path"),
                           "rule": F.col("__uf_best.name"), "verdict": verdict})
    return out.drop(TARGET, "__uf_host", "__uf_path", "__uf_best", "__uf_block")
