"""Registered queries: one Spark plan and (where SQL can state it) one DuckDB oracle per operator id.

Every query reads the test tables of ``sf_dir`` through the derived record views, so its work grows with
them; nothing is sampled or capped. Queries that write (L3, L8, E5, E6, X18) use a fresh folder below the
session's checkpoint directory (shared storage on a cluster).

The catalogue operators C1-C12 and the driver-side constants (D7, L2 on one name) read only the small
definition folder or fixed values; they are covered by unit tests instead of being registered here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolith import config as C
from phenolith.operators import codes as K
from phenolith.operators import cohort as CO
from phenolith.operators import dates as D
from phenolith.operators import describe as R
from phenolith.operators import events as EV
from phenolith.operators import extract as XT
from phenolith.plans import oracle as O
from phenolith.plans.pipeline import Study, build_tables, extract_phenotypes
from phenolith.session import ensure_checkpoint_dir, scratch_path
from phenolith.sources import records as L
from phenolith.schemas import RECORD_COLUMNS
from phenolith.sources import views
from phenolith.sources.first_store import FirstEventStore
from phenolith.sources.records import Sources
from phenolith.sources.store import EventStore

Query = Callable[[SparkSession, str], DataFrame]

# fixed parameters of the registered queries (definitions of our own catalogue)
PHENOTYPE = "renal_decline"
E4_FIELDS = (41202, 42040)
E4_PHENOTYPES = ("renal_decline", "sugar_disorder")
E3_FIELD = 41204
GROUP = "Circulatory"
BIOMARKER_TAG, SERUM, PLASMA = "glucose", ("v4i..", "s8i..", "E0r.."), ("e1r..", "s8i..")
DRUG_WORD = "ring"
R6_COLUMN, R6_MIN, R6_MAX = "f189", -500.0, 5000.0
R6_COLUMNS = ("f34", "f52", "f53", "f54", "f21003", "f189", "f21001", "f50", "f21002", "f95", "f94", "f20116", "f20117", "f21000")
R6_LIMITS = {"f189": (-500.0, 5000.0), "f21003": (40.0, None), "f21001": (None, 30.0), "f53": (0.0, 1.0)}
SELF_REPORT = (20001, 20002, 20004)
NONSTANDARD_AGE, NONSTANDARD_BASELINE = (6150,), (6150, 22167)


def _study(spark: SparkSession, sf_dir: str) -> Study:
    ensure_checkpoint_dir(spark)
    return Study.fixture(spark, sf_dir)


def _matches_of(study: Study, qual_type: str | None = None, match: str | None = None):
    m = study.matches
    if qual_type is not None:
        m = m.where((F.col("qual_type") == qual_type) & ~F.col("field_id").isin(*C.STANDARD_FIELDS))
    if match is not None:
        m = m.where(F.col("match") == match)
    return m


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _ev(**kw) -> str:
    return O.events_sql(**kw)


# ---------------------------------------------------------------------------------------------
# L: loading and normalisation
# ---------------------------------------------------------------------------------------------

_L1_SQL = views.oracle_ctes(["raw_wide"]) + "\nUNION ALL\n".join(
    f"SELECT CAST(eid AS BIGINT) AS eid, CAST({f} AS INTEGER) AS field, CAST({i} AS INTEGER) AS i, "
    f"CAST({n} AS INTEGER) AS n, CAST(\"{c}\" AS VARCHAR) AS value FROM raw_wide "
    f"WHERE \"{c}\" IS NOT NULL AND \"{c}\" <> ''"
    for c in views.WIDE_COLUMNS for f, i, n in [L.parse_field_name(c)])


@register("l1_wide_to_long", _L1_SQL)
def l1_wide_to_long(spark, sf_dir):
    return L.wide_to_long(views.raw_views(spark, sf_dir)["raw_wide"])


@register("l3_load_hesin", O.with_views("SELECT eid, ins_index, epistart, epiend, admidate, disdate FROM raw_hesin"))
def l3_load_hesin(spark, sf_dir):
    path = scratch_path(spark, "hesin_tsv")
    L.write_record_tsv(views.raw_view(spark, sf_dir, "raw_hesin"), path)
    return L.read_record_tsv(spark, path, "hesin")


#: Text that needs care in a delimited file, as SQL for Spark and DuckDB: quotes, separators, a backslash at the end, line breaks.
def _odd_text(breaks: bool) -> str:
    lines = "'two' || chr(10) || 'lines, ' || chr(34) || 'quoted' || chr(34)" if breaks else "' spaces '"
    return ("CASE CAST(eid % 6 AS int) WHEN 0 THEN chr(34) || 'in quotes' || chr(34) || CAST(eid AS string) WHEN 1 THEN 'a' || chr(9) || 'tab, comma' "
            f"WHEN 2 THEN 'back' || chr(92) WHEN 3 THEN {lines} WHEN 4 THEN '5' || chr(34) || ' bandage' END")


_WIDE_ODD = f"SELECT *, {_odd_text(True)} AS note FROM raw_wide"
_L1_CSV_SQL = (views.oracle_ctes(["raw_wide"]).rstrip() + f", odd AS ({_WIDE_ODD})\n" + "\nUNION ALL\n".join(
    f"SELECT CAST(eid AS BIGINT) AS eid, {f} AS field, {i} AS i, {n} AS n, CAST({c} AS VARCHAR) AS value FROM odd WHERE {c} <> ''"
    for c, (f, i, n) in [*((f'"{c}"', L.parse_field_name(c)) for c in views.WIDE_COLUMNS), ("note", (4079, 2, 1))]))


@register("l1_wide_csv", _L1_CSV_SQL)
def l1_wide_csv(spark, sf_dir):
    """The wide file with odd text, written as quoted, compressed CSV and read back."""
    wide = views.raw_views(spark, sf_dir)["raw_wide"]
    path = scratch_path(spark, "wide_csv")
    L.write_wide_csv(wide.withColumn("4079-2.1", F.expr(_odd_text(True))), path)
    return L.wide_csv_to_long(spark, path)


def _register_load(table: str) -> None:
    """A record file with odd text in columns of its own, written, and loaded with every column."""
    note = _odd_text(breaks=table in ("hesin_oper", "death_cause"))
    source = {"gp_clinical": "gp_clinical", "gp_registrations": "gp_registrations"}.get(table, f"raw_{table}")

    @register(f"l3_{table}_all_columns", O.with_views(f"SELECT *, 'D' || CAST(eid % 4 AS string) AS dsource, {note} AS note FROM {source}"))
    def load(spark, sf_dir):
        raw = views.raw_views(spark, sf_dir)
        path, root = scratch_path(spark, f"{table}_tsv"), scratch_path(spark, "loaded")
        odd = raw[f"raw_{table}"].withColumn("dsource", F.expr("'D' || CAST(eid % 4 AS string)")).withColumn("note", F.expr(note))
        L.write_record_tsv(odd, path)
        L.load_table(spark, path, table, root, raw["raw_baseline"])
        return spark.read.parquet(f"{root}/{table}")


for _table in RECORD_COLUMNS:
    _register_load(_table)

_BAD_HESIN = """SELECT CAST(eid AS string) AS eid, CASE WHEN ins_index % 7 = 0 THEN 'x' || CAST(ins_index AS string) ELSE CAST(ins_index AS string) END AS ins_index,
  CASE WHEN ins_index % 11 = 0 THEN '31/02/2010' WHEN ins_index % 13 = 0 THEN '2010-01-01 ' || chr(34) END AS epistart,
  '' AS epiend, '01/02/2010' AS admidate, CASE WHEN eid % 5 = 0 THEN 'soon' END AS disdate FROM raw_hesin"""


@register("l3_rejects", O.with_views("""
SELECT 'ins_index' AS "column", ins_index AS value, 'not an integer' AS reason FROM bad WHERE TRY_CAST(ins_index AS BIGINT) IS NULL
UNION ALL SELECT 'epistart', epistart, 'not a date' FROM bad WHERE epistart IS NOT NULL
UNION ALL SELECT 'disdate', disdate, 'not a date' FROM bad WHERE disdate IS NOT NULL""".strip(), {"bad": _BAD_HESIN}))
def l3_rejects(spark, sf_dir):
    """Every value that the load turns to NULL, with its column and the reason (file and line are left out: they follow the layout)."""
    raw = views.raw_views(spark, sf_dir)
    path, root = scratch_path(spark, "hesin_tsv"), scratch_path(spark, "loaded")
    L.write_record_tsv(spark.sql(_BAD_HESIN.replace("raw_hesin", "{raw_hesin}"), raw_hesin=raw["raw_hesin"]), path)
    L.load_table(spark, path, "hesin", root, raw["raw_baseline"])
    return L.rejects(spark, root).select("column", "value", "reason")


@register("l4_read_code", O.with_views("SELECT eid, read_2, read_3, read_code FROM gp_clinical"))
def l4_read_code(spark, sf_dir):
    return _study(spark, sf_dir).sources.gp_clinical.select("eid", "read_2", "read_3", "read_code")


@register("l5_gp_clinical", O.with_views("SELECT * FROM gp_clinical"))
def l5_gp_clinical(spark, sf_dir):
    return _study(spark, sf_dir).sources.gp_clinical


@register("l6_gp_registrations", O.with_views("SELECT * FROM gp_registrations"))
def l6_gp_registrations(spark, sf_dir):
    return _study(spark, sf_dir).sources.gp_registrations


@register("l7_field_lookup", O.with_views(
    "SELECT b1.eid, b1.i, b1.n, b1.value, b2.value AS year_value FROM raw_baseline b1 LEFT JOIN raw_baseline b2 "
    "ON b2.eid = b1.eid AND b2.i = b1.i AND b2.n = b1.n AND b2.field = 20008 WHERE b1.field = 20002"))
def l7_field_lookup(spark, sf_dir):
    b = _study(spark, sf_dir).sources.baseline
    rec = b.where(F.col("field") == 20002).select("eid", "i", "n", "value")
    return L.field_same_slot(rec, b, 20008, "year_value")


@register("l8_append_events", O.with_views(_ev()))
def l8_append_events(spark, sf_dir):
    s = _study(spark, sf_dir)
    store = EventStore(spark, scratch_path(spark, "phenotypes"))
    hits = XT.value_hits(s.sources, s.matches, s.info)  # one for all
    store.append(XT.extract_hospital(s.sources, s.matches, info=s.info, hits=hits))
    store.append(XT.extract_death(s.sources, s.matches, info=s.info, hits=hits)
                 .unionByName(XT.extract_primary_care(s.sources, s.matches, info=s.info))
                 .unionByName(XT.extract_survey(s.sources, s.matches, info=s.info, hits=hits)))
    return store.read()


# ---------------------------------------------------------------------------------------------
# X: extraction
# ---------------------------------------------------------------------------------------------

@register("x1_year_qualified", O.with_views(_ev(fields=SELF_REPORT)))
def x1_year_qualified(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_survey(s.sources, s.matches, fields=SELF_REPORT)


@register("x2_selfreport_cancer", O.with_views(_ev(fields=[20001])))
def x2_selfreport_cancer(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_self_report(s.sources, s.matches, 20001)


@register("x3_selfreport_illness", O.with_views(_ev(fields=[20002])))
def x3_selfreport_illness(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_self_report(s.sources, s.matches, 20002)


@register("x4_selfreport_operation", O.with_views(_ev(fields=[20004])))
def x4_selfreport_operation(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_self_report(s.sources, s.matches, 20004)


def _nonstandard_sql(rules: tuple[str, ...]) -> str:
    return O.with_views(O.events_sql(rules=rules))


@register("x5_age_qualified", _nonstandard_sql(("age",)))
def x5_age_qualified(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_survey(s.sources, _matches_of(s, "age"))


@register("x6_baseline_qualified", _nonstandard_sql(("baseline",)))
def x6_baseline_qualified(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_survey(s.sources, _matches_of(s, "baseline"))


@register("x7_undated", O.with_views(_ev(fields=[6150], undated=True)))
def x7_undated(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_undated(s.sources, s.matches, [6150])


@register("x8_nonstandard_dispatch", _nonstandard_sql(("age", "baseline", "year", "biomarker")))
def x8_nonstandard_dispatch(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_nonstandard(s.sources, s.matches)


@register("x9_cancer_registry", O.with_views(_ev(fields=[40006])))
def x9_cancer_registry(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_cancer_registry(s.sources, s.matches)


@register("x10_hospital_diagnoses", O.with_views(_ev(fields=[41202, 41204])))
def x10_hospital_diagnoses(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_hospital_diagnoses(s.sources, s.matches)


@register("x11_hospital_procedures", O.with_views(_ev(fields=[41200, 41210])))
def x11_hospital_procedures(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_hospital_procedures(s.sources, s.matches)


@register("x12_death_causes", O.with_views(_ev(fields=[40001, 40002])))
def x12_death_causes(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_death(s.sources, s.matches)


@register("x12_bucketed_tables", O.with_views(_ev(fields=[41202, 41204, 41200, 41210, 40001, 40002])))
def x12_bucketed_tables(spark, sf_dir):
    """X10, X11 and X12 over stored tables in buckets, joined without a shuffle."""
    s = _study(spark, sf_dir)
    root = scratch_path(spark, "bucketed")
    s.sources.store(root, buckets=8)
    stored = Sources.open(spark, root)
    return XT.extract_hospital(stored, s.matches).unionByName(XT.extract_death(stored, s.matches))


@register("x13_gp_diagnoses", O.with_views(_ev(fields=[42040])))
def x13_gp_diagnoses(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_primary_care(s.sources, s.matches)


@register("x14_baseline_biomarker", _nonstandard_sql(("biomarker",)))
def x14_baseline_biomarker(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_survey(s.sources, _matches_of(s, match="biomarker"))


_X15_SQL = f"""SELECT CAST(eid AS BIGINT) AS eid, phenotype, CAST(42040 AS INTEGER) AS field_id, read_code AS field_value, eventdate,
  TRY_CAST(CASE data_provider WHEN 2 THEN value2 ELSE value1 END AS FLOAT) AS data_value
FROM gp_clinical JOIN (VALUES {", ".join(f"('{BIOMARKER_TAG}_{kind}', '{c}')" for kind, own in (("serum", SERUM), ("plasma", PLASMA)) for c in own)})
  AS wanted(phenotype, read_code) USING (read_code)
WHERE data_provider IS DISTINCT FROM 2 OR value3 IS NULL OR value3 IN {O.listed(O.GP_UNITS)}"""


@register("x15_gp_biomarker", O.with_views(_X15_SQL))
def x15_gp_biomarker(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_gp_biomarker(s.sources, BIOMARKER_TAG, SERUM, PLASMA)


@register("x16_one_phenotype", O.with_views(_ev(phenotypes=[PHENOTYPE])))
def x16_one_phenotype(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.extract_phenotype(s.sources, s.matches, PHENOTYPE)


@register("x17_all_phenotypes", O.with_views(_ev()))
def x17_all_phenotypes(spark, sf_dir):
    s = _study(spark, sf_dir)
    return extract_phenotypes(s, testing=True)


@register("x18_skip_extracted", O.with_views(_ev()))
def x18_skip_extracted(spark, sf_dir):
    """Extract one definition, then everything with skip: each (phenotype, field) lands once."""
    s = _study(spark, sf_dir)
    store = EventStore(spark, scratch_path(spark, "phenotypes"))
    extract_phenotypes(s, [PHENOTYPE], store=store, testing=False)
    extract_phenotypes(s, store=store, testing=False)
    return store.read()


@register("x18_refresh", O.with_views(_ev()))
def x18_refresh(spark, sf_dir):
    """Stale rows for two (phenotype, field) pairs are replaced by a refresh of that definition."""
    s = _study(spark, sf_dir)
    store = EventStore(spark, scratch_path(spark, "phenotypes"))
    extract_phenotypes(s, store=store, testing=False)
    stale = store.read().where((F.col("phenotype") == PHENOTYPE) & F.col("field_id").isin(41202, 42040))
    store.append(stale.withColumn("eventdate", F.lit("2001-01-01").cast("date")))
    extract_phenotypes(s, [PHENOTYPE], store=store, refresh=True, testing=False)
    return store.read()


@register("x18_changed_codes", O.with_views(_ev()))
def x18_changed_codes(spark, sf_dir):
    """A first run with other code lists (codes missing, codes too many, one type changed, a field too many), then one with the
    definitions as they are: pairs whose codes changed are extracted again, the field that is listed no longer goes."""
    s = _study(spark, sf_dir)
    odd = F.xxhash64("phenotype", "field_id", "code") % 3 == 0
    m = s.matches.where(~odd | (F.col("phenotype") != PHENOTYPE))
    m = m.withColumn("type", F.when((F.col("phenotype") == "sugar_disorder") & (F.col("field_id") == 42040), F.lit("prevalent")).otherwise(F.col("type")))
    extra = s.matches.where((F.col("phenotype") == "sugar_disorder") & (F.col("field_id") == 41202))
    m = m.unionByName(extra.withColumn("phenotype", F.lit(PHENOTYPE)).withColumn("field_id", F.lit(41200)))
    store = EventStore(spark, scratch_path(spark, "phenotypes"))
    extract_phenotypes(replace(s, matches=m, _info=None), store=store, testing=False)
    extract_phenotypes(s, store=store, testing=False)
    return store.read()


@register("x19_diagnoses_of_people", O.with_views(
    "SELECT DISTINCT eid, diag_icd10 FROM raw_hesin_diag WHERE diag_icd10 IS NOT NULL "
    "AND eid IN (SELECT eid FROM raw_death)"))
def x19_diagnoses_of_people(spark, sf_dir):
    s = _study(spark, sf_dir)
    return XT.hospital_diagnoses_for(s.sources, s.sources.death)


@register("x20_drug_word", O.with_views(
    f"SELECT * FROM raw_prescription_lines WHERE regexp_matches(drug_name, '\\s{DRUG_WORD}|^{DRUG_WORD}')"))
def x20_drug_word(spark, sf_dir):
    every_line = replace(_study(spark, sf_dir).sources, gp_prescriptions=views.raw_view(spark, sf_dir, "raw_prescription_lines"))
    return XT.prescriptions_with_word(every_line, DRUG_WORD)


# ---------------------------------------------------------------------------------------------
# E: event-store queries
# ---------------------------------------------------------------------------------------------

_EVENTS_CTE = {"phenotypes": _ev()}


def _stored_cohort(study: Study) -> DataFrame:
    """The cohort table, computed once and read back: for queries that use it more than once."""
    path = scratch_path(study.spark, "baseline_cohort")
    study.cohort().write.parquet(path)
    return study.spark.read.parquet(path)


def _store(spark, sf_dir) -> EventStore:
    """All events, extracted into a store of their own."""
    store = EventStore(spark, scratch_path(spark, "phenotypes"))
    extract_phenotypes(_study(spark, sf_dir), store=store, testing=False)
    return store


@register("e1_people_with_phenotype", O.with_views(
    f"SELECT DISTINCT eid FROM phenotypes WHERE phenotype = '{PHENOTYPE}'", _EVENTS_CTE))
def e1_people_with_phenotype(spark, sf_dir):
    return EV.individuals_by_phenotype(_store(spark, sf_dir).read(), PHENOTYPE)


@register("e2_phenotypes_present", O.with_views("SELECT DISTINCT phenotype FROM phenotypes", _EVENTS_CTE))
def e2_phenotypes_present(spark, sf_dir):
    return EV.phenotype_entries(_store(spark, sf_dir).read())


@register("e3_phenotypes_for_field", O.with_views(
    f"SELECT DISTINCT phenotype FROM phenotypes WHERE field_id = {E3_FIELD}", _EVENTS_CTE))
def e3_phenotypes_for_field(spark, sf_dir):
    return EV.phenotypes_by_field(_store(spark, sf_dir).read(), E3_FIELD)


@register("e4_events_by_field", O.with_views(
    f"SELECT * FROM phenotypes WHERE field_id IN {tuple(E4_FIELDS)} AND phenotype IN {tuple(E4_PHENOTYPES)}",
    _EVENTS_CTE))
def e4_events_by_field(spark, sf_dir):
    return EV.events_by_field(_store(spark, sf_dir).read(), E4_FIELDS, E4_PHENOTYPES)


@register("e4_events_of_group", O.with_views(
    "SELECT * FROM phenotypes WHERE phenotype IN ('composite_risk', 'heart_rhythm')", _EVENTS_CTE))
def e4_events_of_group(spark, sf_dir):
    selection = K.phenotypes_by_category(_study(spark, sf_dir).stored_catalogue, GROUP)
    return EV.events_of_selection(_store(spark, sf_dir).read(), selection)


@register("e5_delete_phenotype", O.with_views(
    f"SELECT * FROM phenotypes WHERE phenotype <> '{PHENOTYPE}'", _EVENTS_CTE))
def e5_delete_phenotype(spark, sf_dir):
    store = _store(spark, sf_dir)
    store.delete_phenotype(PHENOTYPE)
    return store.read()


@register("e6_delete_phenotype_field", O.with_views(
    f"SELECT * FROM phenotypes WHERE NOT (phenotype = '{PHENOTYPE}' AND field_id = {E3_FIELD})", _EVENTS_CTE))
def e6_delete_phenotype_field(spark, sf_dir):
    store = _store(spark, sf_dir)
    store.delete(PHENOTYPE, E3_FIELD)
    return store.read()


_COHORT_CTE = {"baseline_cohort": O.cohort_sql()}


@register("e7_cohort_people", O.with_views("SELECT DISTINCT eid FROM baseline_cohort", _COHORT_CTE))
def e7_cohort_people(spark, sf_dir):
    return EV.cohort_eids(_study(spark, sf_dir).cohort())


@register("e8_cohort_of_people", O.with_views(
    "SELECT * FROM baseline_cohort WHERE eid IN (SELECT eid FROM raw_death)", _COHORT_CTE))
def e8_cohort_of_people(spark, sf_dir):
    s = _study(spark, sf_dir)
    return EV.patient_cohort(s.cohort(), s.sources.death)


# ---------------------------------------------------------------------------------------------
# F: first events and cohort
# ---------------------------------------------------------------------------------------------

_FIRST_CTES = {"phenotypes": _ev(), "baseline_cohort": O.cohort_sql()}
_FIRST_CTES_F = {**_FIRST_CTES, "phenotype_first": O.first_sql()}


@register("f1_first_events", O.with_views(O.first_sql(), _FIRST_CTES))
def f1_first_events(spark, sf_dir):
    return _study(spark, sf_dir).first_events()


#: What is left in the store after the changes of ``f1_updated_first_events``.
_F1_CHANGED = f"""SELECT * FROM extracted WHERE phenotype <> '{PHENOTYPE}' OR field_id <> {E3_FIELD}
UNION ALL SELECT * REPLACE (CAST(eventdate - 30 AS DATE) AS eventdate) FROM extracted WHERE phenotype = 'sugar_disorder'"""


@register("f1_updated_first_events", O.with_views(
    O.first_sql(), {"extracted": _ev(), "phenotypes": _F1_CHANGED, "baseline_cohort": O.cohort_sql()}))
def f1_updated_first_events(spark, sf_dir):
    """First events kept up to date while the store changes: a first definition, the others, rows that a refresh takes back,
    earlier events, and a deleted pair."""
    s = _study(spark, sf_dir)
    store = EventStore(spark, scratch_path(spark, "phenotypes"))
    state = FirstEventStore(spark, scratch_path(spark, "earliest"))

    def shifted(phenotype: str, days: int) -> DataFrame:
        return store.read().where(F.col("phenotype") == phenotype).withColumn("eventdate", F.date_sub("eventdate", days))

    for change in (
        lambda: extract_phenotypes(s, [PHENOTYPE], store=store, testing=False),
        lambda: extract_phenotypes(s, store=store, testing=False),
        lambda: store.append(shifted(PHENOTYPE, 1000)),
        lambda: extract_phenotypes(s, [PHENOTYPE], store=store, refresh=True, testing=False),
        lambda: store.append(shifted("sugar_disorder", 30)),
        lambda: store.delete(PHENOTYPE, E3_FIELD),
    ):
        change()
        state.update(store)
    return state.first_events(s.cohort())


@register("f2_source_labels_compat", O.with_views(O.first_sql(compat=True), _FIRST_CTES))
def f2_source_labels_compat(spark, sf_dir):
    return _study(spark, sf_dir).first_events(compat=True)


@register("f3_clamped_to_birth", O.with_views(
    "SELECT f.* FROM phenotype_first f JOIN baseline_cohort c ON c.eid = f.eid WHERE f.eventdate = c.dob",
    _FIRST_CTES_F))
def f3_clamped_to_birth(spark, sf_dir):
    s = _study(spark, sf_dir)
    cohort = _stored_cohort(s)
    first = s.first_events(cohort=cohort)
    return first.join(cohort.select("eid", "dob"), "eid").where(F.col("eventdate") == F.col("dob")).drop("dob")


@register("f4_cohort", O.with_views("SELECT * FROM baseline_cohort", _COHORT_CTE))
def f4_cohort(spark, sf_dir):
    return _study(spark, sf_dir).cohort()


@register("f5_country", O.with_views("SELECT eid, f54, country FROM baseline_cohort", _COHORT_CTE))
def f5_country(spark, sf_dir):
    return _study(spark, sf_dir).cohort().select("eid", "f54", "country")


@register("f6_date_of_birth", O.with_views("SELECT eid, f34, f52, dob FROM baseline_cohort", _COHORT_CTE))
def f6_date_of_birth(spark, sf_dir):
    return _study(spark, sf_dir).cohort().select("eid", "f34", "f52", "dob")


@register("f7_gp_record_flag", O.with_views("SELECT eid, gp_ehr FROM baseline_cohort", _COHORT_CTE))
def f7_gp_record_flag(spark, sf_dir):
    return _study(spark, sf_dir).cohort().select("eid", "gp_ehr")


@register("f8_gp_provider", O.with_views("SELECT eid, gp_ehr_data_provider FROM baseline_cohort", _COHORT_CTE))
def f8_gp_provider(spark, sf_dir):
    return _study(spark, sf_dir).cohort().select("eid", "gp_ehr_data_provider")


@register("f9_single_registration", O.with_views(
    "SELECT eid, gp_ehr_single_reg, gp_ehr_deduct_date FROM baseline_cohort", _COHORT_CTE))
def f9_single_registration(spark, sf_dir):
    return _study(spark, sf_dir).cohort().select("eid", "gp_ehr_single_reg", "gp_ehr_deduct_date")


#: Cohort columns under their names in the merged table; those of the short form first.
_F10_NAMES = {"f53": "date_baseline_assessment", "f54": "AssessmentCentre", "f21003": "age_baseline", "f40000": "death_date"}
_F10_MORE = {"f189": "TownsendIndex", "f21001": "BMI", "f50": "height", "f21002": "weight", "f95": "sys_bp", "f94": "diast_bp",
             "f20116": "smoking_status", "f20117": "alcohol_status", "f21000": "ethnic_background"}


def _f10_sql(basic: bool) -> str:
    dropped = ["f34", "f52", *(_F10_MORE if basic else ["gp_ehr_single_reg", "gp_ehr_deduct_date"])]
    names = {"f31": "sex", **_F10_NAMES, **({} if basic else _F10_MORE)}
    return f"""SELECT person.* EXCLUDE ({", ".join(dropped)}) RENAME ({", ".join(f"{a} AS {b}" for a, b in names.items())}),
  if(TRY_CAST(f31 AS DOUBLE) = 0, 'female', 'male') AS sex_label, field_id_label, phenotype, field_id, eventdate
FROM baseline_cohort AS person LEFT JOIN phenotype_first USING (eid)"""


@register("f10_cohort_first_events", O.with_views(_f10_sql(False), _FIRST_CTES_F))
def f10_cohort_first_events(spark, sf_dir):
    s = _study(spark, sf_dir)
    cohort = _stored_cohort(s)
    return CO.cohort_phenotype_first(cohort, s.first_events(cohort=cohort))


@register("f10_cohort_first_events_basic", O.with_views(_f10_sql(True), _FIRST_CTES_F))
def f10_cohort_first_events_basic(spark, sf_dir):
    s = _study(spark, sf_dir)
    cohort = _stored_cohort(s)
    return CO.cohort_phenotype_first(cohort, s.first_events(cohort=cohort), basic=True)


@register("f10_bucketed_people", O.with_views(_f10_sql(False), _FIRST_CTES_F))
def f10_bucketed_people(spark, sf_dir):
    """The whole workflow with cohort, earliest dates and first events in buckets of eid; F1 and F10 join them without a shuffle."""
    return build_tables(_study(spark, sf_dir), scratch_path(spark, "run"), buckets=8).cohort_phenotype_first


_F11_SQL = (
    "SELECT eid, phenotype, eventdate, field_id FROM (SELECT eid, phenotype, eventdate, field_id, "
    "row_number() OVER (PARTITION BY eid, phenotype ORDER BY eventdate ASC NULLS LAST, field_id ASC) AS rn "
    "FROM phenotype_first WHERE eventdate IS NULL OR eventdate NOT IN "
    "(DATE '1900-01-01', DATE '1901-01-01', DATE '2037-07-07')) t WHERE rn = 1")


@register("f11_phenotype_first", O.with_views(_F11_SQL, _FIRST_CTES_F))
def f11_phenotype_first(spark, sf_dir):
    return EV.phenotype_first(_study(spark, sf_dir).first_events())


# ---------------------------------------------------------------------------------------------
# D: dates
# ---------------------------------------------------------------------------------------------

@register("d1_clean_event_dates", O.with_views(
    "SELECT * FROM phenotypes WHERE eventdate IS NULL OR eventdate NOT IN "
    "(DATE '1900-01-01', DATE '1901-01-01', DATE '2037-07-07')", _EVENTS_CTE))
def d1_clean_event_dates(spark, sf_dir):
    return D.clean_survey_dates(_store(spark, sf_dir).read())


@register("d2_clean_hospital_dates", O.with_views(
    "SELECT * FROM raw_hesin WHERE " + " AND ".join(
        f"({c} IS NULL OR {c} NOT IN (DATE '1800-01-01', DATE '1801-01-01', DATE '2037-07-07'))"
        for c in ("admidate", "disdate", "epistart", "epiend"))))
def d2_clean_hospital_dates(spark, sf_dir):
    return D.clean_hospital_dates(_study(spark, sf_dir).sources.hesin)[0]


@register("d3_baseline_date", O.with_views(
    "SELECT eid, CAST(try_strptime(f53, '%Y-%m-%d') AS DATE) AS date_baseline_assessment FROM baseline_cohort",
    _COHORT_CTE))
def d3_baseline_date(spark, sf_dir):
    return D.baseline_date(_study(spark, sf_dir).cohort())


@register("d4_time_since_baseline", O.with_views(
    "SELECT f.eid, f.phenotype, f.eventdate, f.field_id, CAST(try_strptime(c.f53, '%Y-%m-%d') AS DATE) "
    "AS date_baseline_assessment, CAST(date_diff('day', CAST(try_strptime(c.f53, '%Y-%m-%d') AS DATE), "
    "f.eventdate) AS INTEGER) AS time_since_baseline FROM (" + _F11_SQL + ") f JOIN baseline_cohort c ON c.eid = f.eid", _FIRST_CTES_F))
def d4_time_since_baseline(spark, sf_dir):
    s = _study(spark, sf_dir)
    cohort = _stored_cohort(s)
    return D.time_since_baseline(EV.phenotype_first(s.first_events(cohort=cohort)), cohort)


@register("d5_date_of_death", O.with_views(
    "SELECT eid, f40000 AS dod FROM baseline_cohort WHERE f40000 IS NOT NULL", _COHORT_CTE))
def d5_date_of_death(spark, sf_dir):
    return D.date_of_death(_study(spark, sf_dir).cohort())


@register("d6_date_of_birth", O.with_views("SELECT eid, dob FROM baseline_cohort", _COHORT_CTE))
def d6_date_of_birth(spark, sf_dir):
    return D.date_of_birth(_study(spark, sf_dir).cohort())


# ---------------------------------------------------------------------------------------------
# R: reports
# ---------------------------------------------------------------------------------------------

@register("r1_count_people", O.with_views(
    f"SELECT (SELECT count(DISTINCT eid) FROM phenotypes WHERE phenotype = '{PHENOTYPE}') AS n_phenotypes, "
    f"(SELECT count(DISTINCT eid) FROM phenotype_first WHERE phenotype = '{PHENOTYPE}') AS n_phenotype_first",
    _FIRST_CTES_F))
def r1_count_people(spark, sf_dir):
    events = _store(spark, sf_dir).read()
    return R.count_people(events, _study(spark, sf_dir).first_events(events=events), PHENOTYPE)


@register("r2_report_by_field", O.with_views(
    f"""SELECT field_id, title, count(DISTINCT eid) AS num_patients, count(*) AS num_events
FROM phenotypes JOIN lkp_fields USING (field_id) WHERE phenotype = '{PHENOTYPE}' GROUP BY ALL""",
    {**_EVENTS_CTE, "lkp_fields": views.lkp_fields_sql()}))
def r2_report_by_field(spark, sf_dir):
    return R.report_by_field(_store(spark, sf_dir).read(), views.lkp_fields(spark), PHENOTYPE)


def _r3_sql(compat: bool) -> str:
    return O.with_views(
        f"""SELECT coalesce(label, 'selfreport') AS field_id_label, count(DISTINCT eid) AS num_patients, count(*) AS num_events
FROM phenotypes LEFT JOIN {O.labels_sql(compat)} USING (field_id) WHERE phenotype = '{PHENOTYPE}' GROUP BY ALL""", _EVENTS_CTE)


@register("r3_report_by_category", _r3_sql(False))
def r3_report_by_category(spark, sf_dir):
    return R.report_by_category(_store(spark, sf_dir).read(), PHENOTYPE)


@register("r3_report_by_category_compat", _r3_sql(True))
def r3_report_by_category_compat(spark, sf_dir):
    return R.report_by_category(_store(spark, sf_dir).read(), PHENOTYPE, compat=True)


@register("r3_report_of_adult_definitions", O.with_views(
    f"""SELECT phenotype, coalesce(label, 'selfreport') AS field_id_label, count(DISTINCT eid) AS num_patients, count(*) AS num_events
FROM phenotypes LEFT JOIN {O.labels_sql(False)} USING (field_id)
WHERE phenotype NOT IN ('bowel_tumour', 'newborn_jaundice') GROUP BY ALL""", _EVENTS_CTE))
def r3_report_of_adult_definitions(spark, sf_dir):
    selection = K.all_phenotypes(_study(spark, sf_dir).stored_catalogue, include_cancer=False, include_neonatal=False)
    return R.report_of_selection(_store(spark, sf_dir).read(), selection)


_R4_SQL = (
    "SELECT eid, CASE sex WHEN '0' THEN 'F' WHEN '1' THEN 'M' ELSE sex END AS sex, yob, mob, date_assess, "
    "assess_centre, country, dob, age_assess, depriv, bmi, height, weight, sysbp, diasbp, "
    "CASE smoking WHEN '0' THEN 'Never' WHEN '1' THEN 'Ex' WHEN '2' THEN 'Current' ELSE smoking END AS smoking, "
    "CASE alcohol WHEN '0' THEN 'Never' WHEN '1' THEN 'Ex' WHEN '2' THEN 'Current' ELSE alcohol END AS alcohol, "
    "CASE ethnic WHEN '1' THEN 'White' WHEN '2' THEN 'Mixed' WHEN '3' THEN 'Asian' WHEN '4' THEN 'Black' "
    "WHEN '5' THEN 'Chinese' WHEN '6' THEN 'Other' ELSE ethnic END AS ethnic, dod, gp_ehr, gp_ehr_data_provider, "
    "gp_ehr_single_reg, gp_ehr_deduct_date FROM ("
    "SELECT eid, f31 AS sex, f34 AS yob, f52 AS mob, f53 AS date_assess, f54 AS assess_centre, country, dob, "
    "f21003 AS age_assess, f189 AS depriv, f21001 AS bmi, f50 AS height, f21002 AS weight, f95 AS sysbp, "
    "f94 AS diasbp, CASE WHEN f20116 <> '-3' THEN f20116 END AS smoking, "
    "CASE WHEN f20117 <> '-3' THEN f20117 END AS alcohol, "
    "CASE WHEN NOT starts_with(f21000, '-') THEN substr(f21000, 1, 1) END AS ethnic, f40000 AS dod, gp_ehr, "
    "gp_ehr_data_provider, gp_ehr_single_reg, gp_ehr_deduct_date FROM baseline_cohort) r")


@register("r4_recode_cohort", O.with_views(_R4_SQL, _COHORT_CTE))
def r4_recode_cohort(spark, sf_dir):
    return R.recode_cohort(_study(spark, sf_dir).cohort())


def _r5_sql() -> str:
    num = [c for c in C.TABLE_ONE_COLUMNS if c not in C.TABLE_ONE_CATEGORICAL and c != "sex"]
    cat = [c for c in C.TABLE_ONE_COLUMNS if c in C.TABLE_ONE_CATEGORICAL or c == "sex"]
    g = ("SELECT grp, " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in C.TABLE_ONE_COLUMNS) +
         " FROM (SELECT COALESCE(CAST(sex AS VARCHAR), 'missing') AS grp, * FROM r4 UNION ALL "
         "SELECT 'Overall' AS grp, * FROM r4) u")
    parts = ["SELECT grp, 'n' AS variable, CAST(NULL AS VARCHAR) AS level, count(*) AS n, CAST(NULL AS BIGINT) AS missing, "
             "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS sd, CAST(NULL AS DOUBLE) AS pct FROM g GROUP BY grp"]
    for c in num:
        x = f"TRY_CAST({c} AS DOUBLE)"
        parts.append(f"SELECT grp, '{c}' AS variable, CAST(NULL AS VARCHAR) AS level, count({x}) AS n, "
                     f"CAST(sum(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing, round(avg({x}), 6) AS mean, "
                     f"round(stddev_samp({x}), 6) AS sd, CAST(NULL AS DOUBLE) AS pct FROM g GROUP BY grp")
    for c in cat:
        parts.append(
            f"SELECT l.grp, '{c}' AS variable, l.level, l.n, m.missing, CAST(NULL AS DOUBLE) AS mean, "
            "CAST(NULL AS DOUBLE) AS sd, round(CAST(l.n AS DOUBLE) * 100.0 / CAST(sum(l.n) OVER (PARTITION BY l.grp) AS DOUBLE), 6) "
            "AS pct FROM "
            f"(SELECT grp, {c} AS level, count(*) AS n FROM g WHERE {c} IS NOT NULL GROUP BY grp, {c}) l LEFT JOIN "
            f"(SELECT grp, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM g GROUP BY grp) m "
            "ON m.grp = l.grp")
    return O.with_views("\nUNION ALL\n".join(parts), {**_COHORT_CTE, "r4": _R4_SQL, "g": g})


@register("r5_table_one", _r5_sql())
def r5_table_one(spark, sf_dir):
    return R.table_one(R.recode_cohort(_stored_cohort(_study(spark, sf_dir))))


def _r6_select(column: str, minimum: float | None, maximum: float | None) -> str:
    x = f"TRY_CAST({column} AS DOUBLE)"
    fin = f"{x} IS NOT NULL AND isfinite({x})"
    q = ", ".join(f"round(quantile_cont(x, {p / 100}), 6) AS decile_{p}" for p in R.R6_PERCENTILES)

    def outside(sign: str, limit: float | None) -> str:
        return f"CAST({'NULL' if limit is None else f'sum(CASE WHEN x {sign} {limit} THEN 1 ELSE 0 END)'} AS BIGINT)"

    return (
        f"SELECT '{column}' AS variable, a.count_all, a.count_missing, a.count_invalid, b.min, b.max, b.count_below_min, b.count_above_max, "
        + ", ".join(f"b.decile_{p}" for p in R.R6_PERCENTILES) + ", b.median, b.std, b.IQR FROM "
        f"(SELECT count(*) AS count_all, CAST(sum(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS count_missing, "
        f"CAST(sum(CASE WHEN {column} IS NOT NULL AND ({x} IS NULL OR isnan({x})) THEN 1 ELSE 0 END) AS BIGINT) "
        "AS count_invalid FROM baseline_cohort) a, "
        f"(SELECT round(min(x), 6) AS min, round(max(x), 6) AS max, {outside('<', minimum)} AS count_below_min, "
        f"{outside('>', maximum)} AS count_above_max, {q}, "
        "round(quantile_cont(x, 0.5), 6) AS median, round(stddev_pop(x), 6) AS std, "
        "round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) AS IQR "
        f"FROM (SELECT {x} AS x FROM baseline_cohort WHERE {fin}) f) b")


@register("r6_column_profile", O.with_views(
    f"SELECT * EXCLUDE (variable) FROM ({_r6_select(R6_COLUMN, R6_MIN, R6_MAX)})", _COHORT_CTE))
def r6_column_profile(spark, sf_dir):
    return R.describe_values(_study(spark, sf_dir).cohort(), R6_COLUMN, R6_MIN, R6_MAX)


@register("r6_all_columns", O.with_views(
    "\nUNION ALL\n".join(_r6_select(c, *R6_LIMITS.get(c, (None, None))) for c in R6_COLUMNS), _COHORT_CTE))
def r6_all_columns(spark, sf_dir):
    return R.describe_columns(_stored_cohort(_study(spark, sf_dir)), R6_COLUMNS, R6_LIMITS)
