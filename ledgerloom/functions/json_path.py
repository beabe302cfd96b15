"""Reading JSON text by path: scalars, fragments and array elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CONTAINER = "^(OBJECT|ARRAY)"


def _kind(document: Column, path: str) -> Column:
    at_path = F.try_variant_get(F.try_parse_json(document), path, "variant")
    return F.schema_of_variant(at_path)


def json_value(document: Column, path: str) -> Column:
    """The scalar at ``path`` as text; NULL for a missing path, an object or an array.

    Only text that looks like a container is parsed again, to tell it from a string.
    """
    text = F.get_json_object(document, path)
    return F.when(text.isNull() | ~text.rlike(r"^[\[{]"), text).when(
        ~_kind(document, path).rlike(_CONTAINER), text
    )


def json_query(document: Column, path: str) -> Column:
    """The object or array at ``path`` as JSON text; NULL for a scalar or a missing path."""
    text = F.get_json_object(document, path)
    return F.when(text.rlike(r"^[\[{]") & _kind(document, path).rlike(_CONTAINER), text)


def json_array(document: Column, path: str) -> Column:
    return F.from_json(F.get_json_object(document, path), "array<string>")


def explode_json(df: DataFrame, document: str, path: str, value: str = "value") -> DataFrame:
    """One row per element of the array at ``path``; rows without elements drop out."""
    return df.withColumn(value, F.explode(json_array(F.col(document), path)))
