"""Date parts, month edges and the written forms of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Russian month names, January to December, alone and after a day number.
MONTHS_RU = [
    "январь", "февраль", "март", "апрель", "май", "июнь",
    "июль", "август", "сентябрь", "октябрь", "ноябрь", "декабрь",
]
MONTHS_RU_OF = [
    "января", "февраля", "марта", "апреля", "мая", "июня",
    "июля", "августа", "сентября", "октября", "ноября", "декабря",
]


def third_of_year(day: Column) -> Column:
    """1 for January to April, 2 for May to August, 3 for the rest."""
    return F.ceil(F.month(day) / 4).cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def dotted_date(day: Column) -> Column:
    """``05.03.2013``"""
    return F.date_format(day, "dd.MM.yyyy")


def month_name_en(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def _by_month(names: list[str], day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), F.month(day))


def month_name_ru(day: Column) -> Column:
    return _by_month(MONTHS_RU, day)


def long_date_en(day: Column) -> Column:
    """``Tuesday, March 5, 2013``"""
    return F.date_format(day, "EEEE, MMMM d, yyyy")


def long_date_ru(day: Column) -> Column:
    """``5 марта 2013 г.``"""
    return F.concat_ws(
        " ",
        F.dayofmonth(day).cast("string"),
        _by_month(MONTHS_RU_OF, day),
        F.year(day).cast("string"),
        F.lit("г."),
    )
