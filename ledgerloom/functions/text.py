"""Text predicates and functions. Names compare without regard to case throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_text(name: Column, part: str) -> Column:
    return F.contains(F.lower(name), F.lit(part.lower()))


def starts_with_text(name: Column, prefix: str) -> Column:
    return F.startswith(F.lower(name), F.lit(prefix.lower()))


def same_text(name: Column, other: str) -> Column:
    return F.lower(name) == other.lower()


def first_spelling(name: Column) -> Column:
    """Aggregate: of names that are the same but for their case, the first one.

    A set of the spellings stays in a hash aggregate, which a minimum of texts would not.
    """
    return F.array_min(F.collect_set(name))


def first_letter(name: Column) -> Column:
    return F.lower(F.left(name, F.lit(1)))


def inside_parentheses(name: Column) -> Column:
    """The text after the first ``(`` up to, not including, the last character.

    Without a ``(`` this is the name less its last character.
    """
    start = F.instr(name, "(")
    return F.substring(name, start + 1, F.length(F.rtrim(name)) - start - 1)


def sort_list(text: Column, separator: str = ",") -> Column:
    """Sort a comma-separated list and write ``separator`` after every element, the last too.

    Elements compare without regard to case, then by character code.
    """
    parts = F.transform(
        F.split(text, ","), lambda part: F.struct(F.lower(part).alias("k"), part.alias("v"))
    )
    ordered = F.transform(F.array_sort(parts), lambda part: part["v"])
    return F.concat(F.array_join(ordered, separator), F.lit(separator))


def joined(parts: Column, separator: str = ",") -> Column:
    return F.array_join(parts, separator)
