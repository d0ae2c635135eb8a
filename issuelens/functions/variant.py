"""Members of JSON documents by the VARIANT type (FN-1..FN-3): a missing member and an
explicit null are told apart, which text extraction cannot do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def document(text: str | Column) -> Column:
    """The document; NULL where the text is no JSON."""
    return F.try_parse_json(text)


def member(doc: Column, path: str) -> Column:
    """The member at ``path`` as VARIANT: NULL if it is missing, a variant null if it is null."""
    return F.try_variant_get(doc, path, "variant")


def text_or(doc: Column, path: str, missing: Column) -> Column:
    """The member as text: ``missing`` where there is none, NULL where it is null.  What is
    no scalar is given as JSON text."""
    m = member(doc, path)
    text = F.coalesce(F.try_variant_get(doc, path, "string"), F.to_json(m))
    return F.when(F.is_variant_null(m), F.lit(None)).when(m.isNull(), missing).otherwise(text)


def elements(doc: Column, path: str) -> Column:
    """The elements of an array member; NULL if it is none."""
    return F.try_variant_get(doc, path, "array<variant>")
