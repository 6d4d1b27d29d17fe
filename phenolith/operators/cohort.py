"""The one-row-per-person cohort table (F4-F9) and its merge with first events.

The reference fills the table with one UPDATE ... JOIN per column (16 scans of the long table plus six
over the GP tables and a temporary table). Here the inputs are projected to narrow shapes and reduced by
``groupBy(eid)`` aggregations with map-side partial aggregation (a participant holding many GP rows is
reduced inside each task), joined on the key they are already partitioned by. People come from the long
table only (everyone with any survey row), as ``SELECT DISTINCT eid``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith import config as C
from phenolith.functions import exprs as X
from phenolith.sources.records import Sources

# GP tables in increasing priority for the provider column (the reference's last UPDATE wins)
_GP_PRIORITY = ("gp_registrations", "gp_clinical", "gp_prescriptions")

COHORT_COLUMNS = (
    "eid", "f31", "f34", "f52", "f53", "f54", "country", "dob", "f21003", "f189", "f21001", "f50", "f21002",
    "f95", "f94", "f20116", "f20117", "f21000", "f40000", "gp_ehr", "gp_ehr_data_provider",
    "gp_ehr_single_reg", "gp_ehr_deduct_date",
)


def baseline_cohort(sources: Sources, birth_day: int = 1, gp_tables: tuple[str, ...] = _GP_PRIORITY) -> DataFrame:
    """F4-F9. ``birth_day`` is the day of the month used for the date of birth (Q4);
    ``gp_tables`` the tables that set the GP-record flag (Q5: the three tables by default).

    Two aggregations keyed by eid: (1) over *all* rows of the long table and the GP tables with numeric
    buffers only (presence, flags, providers, registration count, deduction date) - a hash aggregate with
    map-side combining; (2) the text values of the 16 cohort fields, over the visit-0 rows of those fields
    only (about 16 rows per person), pivoted by conditional ``min``. Both come out hash-partitioned by eid,
    so their left join adds no further shuffle."""
    b = sources.baseline
    parts = [b.select("eid", F.lit(0).alias("src"), F.lit(None).cast("int").alias("provider"),
                      F.lit(None).cast("date").alias("deduct"))]
    for rank, name in enumerate(_GP_PRIORITY, start=1):
        t = getattr(sources, name)
        parts.append(t.select(
            "eid", F.lit(rank).alias("src"), F.col("data_provider").cast("int").alias("provider"),
            (F.col("deduct_date") if name == "gp_registrations" else F.lit(None)).cast("date").alias("deduct")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)

    src = F.col("src")
    flag_ranks = [r for r, n in enumerate(_GP_PRIORITY, start=1) if n in gp_tables]
    people = u.groupBy("eid").agg(
        F.max(F.when(src == 0, 1).otherwise(0)).alias("_in_baseline"),
        F.max(F.when(src.isin(*flag_ranks), 1).otherwise(0)).alias("_gp"),
        *[F.min(F.when(src == r, F.col("provider"))).alias(f"_p{r}") for r in range(1, len(_GP_PRIORITY) + 1)],
        F.sum(F.when(src == 1, 1).otherwise(0)).alias("_n_reg"),
        F.min(F.when(src == 1, F.col("deduct"))).alias("_deduct"),
    ).where(F.col("_in_baseline") == 1)

    cohort_rows = b.where(F.col("field").isin(*C.COHORT_FIELDS) & (F.col("i") == 0) & (F.col("n") == 0))
    values = cohort_rows.groupBy("eid").agg(
        *[F.min(F.when(F.col("field") == f, F.col("value"))).alias(f"f{f}") for f in C.COHORT_FIELDS])

    single = F.col("_n_reg") == 1
    out = people.join(values, "eid", "left").withColumns({
        "country": X.country(F.col("f54")),
        "dob": X.birth_date(F.col("f34"), F.col("f52"), birth_day),
        "gp_ehr": F.col("_gp"),
        "gp_ehr_data_provider": F.coalesce(*[F.col(f"_p{r}") for r in range(len(_GP_PRIORITY), 0, -1)]),
        "gp_ehr_single_reg": F.when(single, 1).otherwise(0),
        "gp_ehr_deduct_date": F.when(single, F.col("_deduct")),
        "f40000": X.iso_date(F.col("f40000")),
    })
    return out.select(*[F.col(c).cast("int").alias(c) if c.startswith("gp_ehr") and c != "gp_ehr_deduct_date"
                        else F.col(c) for c in COHORT_COLUMNS])


# ----------------------------------------------------------------------------------------------
# cohort x first events
# ----------------------------------------------------------------------------------------------

_FULL = (
    ("f31", "sex"), ("f53", "date_baseline_assessment"), ("f54", "AssessmentCentre"), ("f21003", "age_baseline"),
    ("f189", "TownsendIndex"), ("f21001", "BMI"), ("f50", "height"), ("f21002", "weight"), ("f95", "sys_bp"),
    ("f94", "diast_bp"), ("f20116", "smoking_status"), ("f20117", "alcohol_status"),
    ("f21000", "ethnic_background"), ("f40000", "death_date"),
)
_BASIC = (("f31", "sex"), ("f53", "date_baseline_assessment"), ("f54", "AssessmentCentre"),
          ("f21003", "age_baseline"), ("f40000", "death_date"))


def sex_label(sex: F.Column) -> F.Column:
    """'female' for 0, 'male' otherwise - including NULL, as the reference's IF does."""
    return F.when(X.try_cast(sex, "double") == 0, F.lit("female")).otherwise(F.lit("male"))


def cohort_phenotype_first(cohort: DataFrame, first: DataFrame, basic: bool = False) -> DataFrame:
    """every cohort row kept (left join); the full or the basic column set."""
    renames = _BASIC if basic else _FULL
    head = ["eid", "country", "dob", "gp_ehr", "gp_ehr_data_provider"]
    if basic:
        head += ["gp_ehr_single_reg", "gp_ehr_deduct_date"]
    c = cohort.select(*head, *[F.col(s).alias(t) for s, t in renames],
                      sex_label(F.col("f31")).alias("sex_label"))
    f = first.select("eid", "field_id_label", "phenotype", "field_id", "eventdate")
    ordered = head + ["sex", "sex_label"] + [t for _, t in renames[1:]] + \
        ["field_id_label", "phenotype", "field_id", "eventdate"]
    return c.join(f, "eid", "left").select(*ordered)
