"""Column expressions shared by the operators. All are built-in Spark expressions (codegen, no UDFs).

Spark 4 runs with ANSI mode on: text that may not be a number or a date always goes through ``try_*``
so that bad input becomes NULL (the reference's database did the same silently).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from phenolith import config as C


def try_cast(c: Column, dtype: str) -> Column:
    """CAST that gives NULL instead of failing on bad input."""
    return c.try_cast(dtype)


def lit_date(d: str) -> Column:
    return F.lit(d).cast("date")


def date_unknown() -> Column:
    """1900-01-01: the event happened, its date is unknown."""
    return F.lit(C.DATE_UNKNOWN)


def null_date() -> Column:
    return F.lit(None).cast("date")


def to_number(c: Column) -> Column:
    """Text -> double, NULL when not numeric."""
    return try_cast(c, "double")


def iso_date(c: Column) -> Column:
    """``%Y-%m-%d`` text -> date, NULL when not a date."""
    return F.try_to_date(c, "yyyy-M-d")


def uk_date(c: Column) -> Column:
    """``%d/%m/%Y`` text (record files) -> date; '' and bad input -> NULL."""
    return F.try_to_date(F.nullif(c, F.lit("")), "d/M/yyyy")


def year_start(year: Column) -> Column:
    """January 1st of a (fractional) year, rounded half to even like the reference's ROUND on doubles;
    NULL outside years 1-9999 (checked before the casts, which would fail under ANSI mode)."""
    y = F.rint(year)
    return F.when(y.between(1, 9999), F.make_date(y.cast("int"), F.lit(1), F.lit(1)))


def dated_by_year(year_text: Column) -> Column:
    """A positive year gives its January 1st; zero, negative, missing or not numeric -> 1900-01-01."""
    y = to_number(year_text)
    return F.when(y > 0, year_start(y)).otherwise(date_unknown())


def dated_by_age(age_text: Column, yob_text: Column) -> Column:
    """The test is on the age; the date is January 1st of round(age + year of birth).
    A positive age with an unknown year of birth gives NULL (not the sentinel)."""
    age = to_number(age_text)
    return F.when(age > 0, year_start(age + to_number(yob_text))).otherwise(date_unknown())


def source_label(field_id: Column, compat: bool = False) -> Column:
    """hospital / death / primary care / cancer / self-report. ``compat`` lists 41240 instead of
    41210, so secondary procedures fall to self-report as in the reference's CASE (Q2)."""
    hospital = C.LABEL_HOSPITAL_FIELDS_COMPAT if compat else tuple(
        f for f, s in C.FIELD_SOURCE.items() if s == "ehr_hospital")
    return (
        F.when(field_id.isin(*hospital), F.lit("ehr_hospital"))
        .when(field_id.isin(*[f for f, s in C.FIELD_SOURCE.items() if s == "ehr_death"]), F.lit("ehr_death"))
        .when(field_id.isin(*[f for f, s in C.FIELD_SOURCE.items() if s == "ehr_primary_care"]),
              F.lit("ehr_primary_care"))
        .when(field_id.isin(*[f for f, s in C.FIELD_SOURCE.items() if s == "ehr_cancer"]), F.lit("ehr_cancer"))
        .otherwise(F.lit(C.LABEL_SELF_REPORT))
    )


def country(centre_text: Column) -> Column:
    """assessment centre -> S / W / E (unknown centres, including NULL, are England)."""
    centre = try_cast(centre_text, "int")
    return (
        F.when(centre.isin(*C.SCOTTISH_CENTRES), F.lit("S"))
        .when(centre.isin(*C.WELSH_CENTRES), F.lit("W"))
        .otherwise(F.lit("E"))
    )


def birth_date(yob_text: Column, mob_text: Column, day: int = 1) -> Column:
    """date of birth from year and month text, on a fixed day (Q4: 1 by default)."""
    y = try_cast(yob_text, "int")
    m = try_cast(mob_text, "int")
    ok = y.between(1, 9999) & m.between(1, 12)
    return F.when(ok, F.make_date(y, m, F.lit(day)))


def word_start_pattern(word: str) -> str:
    """The word at the start of the text or after white space."""
    w = re.escape(word)
    return rf"\s{w}|^{w}"


def unified_read_code(read_2: Column, read_3: Column) -> Column:
    """L4: read_2 when only it is present, read_3 when only it is present, else NULL."""
    return (
        F.when(read_2.isNotNull() & read_3.isNull(), read_2)
        .when(read_2.isNull() & read_3.isNotNull(), read_3)
    )


def not_in_dates(c: Column, dates) -> Column:
    """True unless ``c`` is one of ``dates``; NULL dates are kept."""
    return ~F.coalesce(c.isin(*[F.lit(d).cast("date") for d in dates]), F.lit(False))
