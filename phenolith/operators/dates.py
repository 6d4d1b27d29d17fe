"""Date helpers over the derived tables."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith import config as C
from phenolith.functions import exprs as X

log = logging.getLogger(__name__)


def _people(df: DataFrame, eids: DataFrame | None) -> DataFrame:
    return df if eids is None else df.join(eids.select("eid").distinct(), "eid", "left_semi")


def clean_survey_dates(df: DataFrame, date_col: str = "eventdate",
                       dates: Iterable[str] = C.SURVEY_PLACEHOLDER_DATES) -> DataFrame:
    """Drop rows whose date is a placeholder; rows with a NULL date stay."""
    return df.where(X.not_in_dates(F.col(date_col), tuple(dates)))


def clean_hospital_dates(df: DataFrame, date_cols: Iterable[str] = ("admidate", "disdate", "epistart", "epiend"),
                         dates: Iterable[str] = C.HOSPITAL_PLACEHOLDER_DATES) -> tuple[DataFrame, list[str]]:
    """The same over several date columns; returns the frame and the columns that were absent."""
    dates = tuple(dates)
    absent = []
    for c in date_cols:
        if c in df.columns:
            df = df.where(X.not_in_dates(F.col(c), dates))
        else:
            absent.append(c)
            log.info("date column %r not present", c)
    return df, absent


def baseline_date(cohort: DataFrame, eids: DataFrame | None = None, check: bool = True) -> DataFrame:
    """D3: assessment date per person; a person that occurs twice is an error unless ``check`` is off."""
    df = _people(cohort, eids).select("eid", X.iso_date(F.col("f53")).alias("date_baseline_assessment"))
    if check:
        assert_unique_people(df)
    return df


def assert_unique_people(df: DataFrame) -> None:
    """Duplicates of a person are an error (one distributed aggregate, one row back)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("eid").alias("d")).first()
    if r.n != r.d:
        raise ValueError(f"{r.n - r.d} duplicate eid rows")


def time_since_baseline(df: DataFrame, cohort: DataFrame, id_col: str = "eid", date_col: str = "eventdate") -> DataFrame:
    """Days from the assessment to the event (inner join: people without a cohort row drop out)."""
    b = baseline_date(cohort).withColumnRenamed("eid", id_col)
    return df.join(b, id_col, "inner").withColumn(
        "time_since_baseline", F.datediff(F.col(date_col), F.col("date_baseline_assessment")))


def date_of_death(cohort: DataFrame, eids: DataFrame | None = None, drop_alive: bool = True,
                  check: bool = True) -> DataFrame:
    """Death date per person, optionally only the dead."""
    df = _people(cohort, eids).select("eid", F.col("f40000").alias("dod"))
    if check:
        assert_unique_people(df)
    return df.where(F.col("dod").isNotNull()) if drop_alive else df


def date_of_birth(cohort: DataFrame, eids: DataFrame | None = None, check: bool = True) -> DataFrame:
    """Birth date per person."""
    df = _people(cohort, eids).select("eid", "dob")
    if check:
        assert_unique_people(df)
    return df


def min_censor_date(compat: bool = False) -> dt.date:
    """The earliest censoring date over the four sources (a handful of constants, driver side).

    The reference takes the minimum of ``dd-mm-yyyy`` strings (28-02-2016); ``compat`` reproduces that,
    the default is the true earliest date (Q3)."""
    groups = (C.PRIMARY_CARE_CENSORING, C.HOSPITAL_EHR_CENSORING, C.CANCER_CENSORING, C.DEATH_CENSORING)
    if compat:
        text = min(min(g.values()) for g in groups)
        return dt.datetime.strptime(text, "%d-%m-%Y").date()
    return min(dt.datetime.strptime(v, "%d-%m-%Y").date() for g in groups for v in g.values())
