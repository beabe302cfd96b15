"""Reading JSON documents that are parsed once, into a variant column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CONTAINER = "^(OBJECT|ARRAY)"


def with_variant(df: DataFrame, document: str, name: str = "_document") -> DataFrame:
    """``df`` with ``document`` parsed; NULL for what is not JSON.

    The paths taken from the result share this one parse: Spark keeps a costly column that several expressions read.
    """
    return df.withColumn(name, F.try_parse_json(document))


def _at(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "variant")


def _is_container(found: Column) -> Column:
    return F.schema_of_variant(found).rlike(_CONTAINER)


def scalar_at(document: Column, path: str) -> Column:
    """The scalar at ``path`` as text; NULL for a missing path, an object or an array.

    Numbers are written as the variant holds them: 1.50 is 1.5.
    """
    return F.when(~_is_container(_at(document, path)), F.try_variant_get(document, path, "string"))


def fragment_at(document: Column, path: str) -> Column:
    """The object or array at ``path`` as JSON text, keys of an object in order; NULL for a scalar or a missing path."""
    found = _at(document, path)
    return F.when(_is_container(found), F.to_json(found))


def texts_at(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "array<string>")


def explode_at(df: DataFrame, document: str, path: str, value: str = "value") -> DataFrame:
    """One row per element of the array at ``path``, as text; rows without elements drop out."""
    elements = df.sparkSession.tvf.variant_explode(_at(F.col(document).outer(), path))
    found = elements.select(F.try_variant_get("value", "$", "string").alias(value))
    return df.lateralJoin(found)
