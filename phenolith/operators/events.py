"""Event-store queries (E1-E8) and first events.

First events aggregate before they join: (eid, phenotype, field_id) -> MIN(eventdate) runs as a partial
(map-side) plus final aggregation, so a participant with very many events is reduced inside each task
before the shuffle; only then is the (much smaller) result joined to the cohort for membership and the
birth-date clamp. A sentinel date wins the minimum (it is the earliest date), as in the reference (Q1).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith import config as C
from phenolith.functions import exprs as X


def _people(df: DataFrame, eids: DataFrame | None) -> DataFrame:
    return df if eids is None else df.join(eids.select("eid").distinct(), "eid", "left_semi")


# ----------------------------------------------------------------------------------------------
# E1-E8
# ----------------------------------------------------------------------------------------------

def individuals_by_phenotype(events: DataFrame, phenotype: str) -> DataFrame:
    """Distinct people with a phenotype."""
    return events.where(F.col("phenotype") == phenotype).select("eid").distinct()


def phenotype_entries(events: DataFrame) -> DataFrame:
    """Distinct phenotypes present."""
    return events.select("phenotype").distinct()


def phenotypes_by_field(events: DataFrame, field_id: int) -> DataFrame:
    """Distinct phenotypes present for one field (one partition folder in the store)."""
    return events.where(F.col("field_id") == field_id).select("phenotype").distinct()


def events_by_field(events: DataFrame, fields: Iterable[int] | None = None,
                    phenotypes: Iterable[str] | None = None) -> DataFrame:
    """Events filtered by optional field and phenotype lists."""
    df = events
    if fields is not None:
        df = df.where(F.col("field_id").isin(*list(fields)))
    if phenotypes is not None:
        df = df.where(F.col("phenotype").isin(*list(phenotypes)))
    return df


def events_of_selection(events: DataFrame, selection: DataFrame) -> DataFrame:
    """E4 for a selection of the catalogue (C9-C11, any rows with ``variable_name``). The selection, bounded by the definitions,
    is broadcast; where it comes from a stored table (``Study.stored_catalogue``) its names prune the folders at run time."""
    names = selection.select(F.col("variable_name").alias("phenotype")).distinct()
    return events.join(F.broadcast(names), "phenotype", "left_semi").select(*events.columns)


def cohort_eids(cohort: DataFrame) -> DataFrame:
    """People in the cohort."""
    return cohort.select("eid").distinct()


def patient_cohort(cohort: DataFrame, eids: DataFrame) -> DataFrame:
    """Cohort rows of the given people."""
    return _people(cohort, eids)


# ----------------------------------------------------------------------------------------------
# F1-F3
# ----------------------------------------------------------------------------------------------

def earliest(events: DataFrame) -> DataFrame:
    """The earliest date per (eid, phenotype, field_id). Mergeable: the earliest dates of two sets of events together are the
    earliest of their earliest dates (``sources.first_store`` keeps them so)."""
    return events.groupBy("eid", "phenotype", "field_id").agg(F.min("eventdate").alias("eventdate"))


def label_first(first: DataFrame, cohort: DataFrame, compat: bool = False, clamp: bool = True) -> DataFrame:
    """F2 + F3 on earliest dates: the people of the cohort, the source label, no date before birth."""
    joined = first.join(cohort.select("eid", "dob"), "eid", "inner")
    d = F.col("eventdate")
    if clamp:
        d = F.when((d <= F.col("dob")) & X.not_in_dates(d, C.CLAMP_EXEMPT_DATES), F.col("dob")).otherwise(d)
    return joined.select(
        "eid", "phenotype", "field_id",
        X.source_label(F.col("field_id"), compat).alias("field_id_label"),
        d.alias("eventdate"),
    )


def first_events(events: DataFrame, cohort: DataFrame, compat: bool = False, clamp: bool = True) -> DataFrame:
    """F1 + F2 + F3: first event per (eid, phenotype, field) for people in the cohort, with the source
    label; an event on or before the date of birth (other than the two sentinels) becomes the birth date.
    ``compat`` reproduces the reference's label list (secondary procedures -> self-report, Q2)."""
    return label_first(earliest(events), cohort, compat, clamp)


# ----------------------------------------------------------------------------------------------
# F11
# ----------------------------------------------------------------------------------------------

def phenotype_first(first: DataFrame, phenotypes: Iterable[str] | str | None = None,
                    fields: Iterable[int] | None = None, first_only: bool = True) -> DataFrame:
    """first events read back for analysis; sentinel dates removed (D1), then - with
    ``first_only`` - the earliest remaining event per (eid, phenotype). Ties go to the smallest
    field_id; a group whose dates are all NULL keeps its smallest field_id with a NULL date."""
    if isinstance(phenotypes, str):
        phenotypes = [phenotypes]
    df = first.select("eid", "phenotype", "eventdate", "field_id")
    if phenotypes is not None:
        df = df.where(F.col("phenotype").isin(*list(phenotypes)))
    if fields is not None:
        df = df.where(F.col("field_id").isin(*list(fields)))
    df = df.where(X.not_in_dates(F.col("eventdate"), C.SURVEY_PLACEHOLDER_DATES))
    if not first_only:
        return df
    # the earliest date (NULLs last), then the smallest field, as one 64-bit key: days since 1970 in
    # the high half, field_id in the low half. ``min`` over a long runs as a hash aggregate with
    # map-side combining (a struct or text minimum would force a sort-based aggregate)
    days = F.coalesce(F.datediff(F.col("eventdate"), F.lit("1970-01-01").cast("date")), F.lit(_NO_DATE))
    key = F.shiftleft(days.cast("long"), 32) + F.col("field_id").cast("long")
    best = df.groupBy("eid", "phenotype").agg(F.min(key).alias("_k"))
    hi = F.shiftright(F.col("_k"), 32)  # arithmetic shift: exact for dates before 1970 too
    return best.select(
        "eid", "phenotype",
        F.when(hi != _NO_DATE, F.date_add(F.lit("1970-01-01").cast("date"), hi.cast("int"))).alias("eventdate"),
        F.col("_k").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("field_id"),
    )


_NO_DATE = (1 << 31) - 1  # sorts after every real day number; field ids are non-negative 32-bit ints
