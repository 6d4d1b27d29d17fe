"""Event extraction (X1-X20): record scan -> code match -> date rule -> the six ``phenotypes`` columns.

The reference runs one SQL statement per (definition, field) with the codes pasted into ``IN`` lists or
anchored regular expressions. Here every source table is scanned **once for all definitions** (the long survey table
three times: answers, qualifiers, years of birth):

* exact codes (self-report answers, Read codes): broadcast equi-join on (field_id, code), case-sensitive;
* prefix codes (ICD-10, OPCS-4, registry): records repeat a small dictionary of values. The distinct (field, value) pairs - an
  index that a load stores, else one aggregate over the records - are matched once, folding case: each value is expanded
  into its prefixes of the code lengths in use and joined to a *minimal cover* of the codes. Records then take one equi-join
  by (field, value), whatever the number of definitions; no record is expanded. Index and records are first cut to the values that
  start with a code (:func:`codes.may_match`, a condition that Spark moves into the scans): other records are never shuffled;
* the date rule is a column expression keyed on field and type; qualifier values come from left joins
  on the long table (same visit/slot, or the participant's visit-0 values).

The match table is bounded by the definition files, the matched values by codes in use times definitions that list them. Both are
broadcast only after their bytes are checked (:func:`codes.broadcast_if_small`); beyond that the joins shuffle.
Large-large joins (episodes, participants' qualifiers) are shuffle joins left to AQE, whose skew-join
rule splits a hot participant's partition.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith import config as C
from phenolith.functions import exprs as X
from phenolith.operators import codes as K
from phenolith.schemas import PHENOTYPE_COLUMNS
from phenolith.session import scratch_path
from phenolith.sources.records import Sources

HOSPITAL_DIAG_FIELDS = (C.F_HOSP_DIAG_MAIN, C.F_HOSP_DIAG_SEC)
HOSPITAL_OPER_FIELDS = (C.F_HOSP_OPER_MAIN, C.F_HOSP_OPER_SEC)
DEATH_FIELDS = (C.F_DEATH_PRIMARY, C.F_DEATH_SECONDARY)


def _out(df: DataFrame, eventdate, data_value=None) -> DataFrame:
    """Project to the six output columns with their table types."""
    return df.select(
        F.col("eid").cast("bigint").alias("eid"),
        F.col("phenotype"),
        F.col("field_id").cast("int").alias("field_id"),
        F.col("field_value").cast("string").alias("field_value"),
        eventdate.cast("date").alias("eventdate"),
        (data_value if data_value is not None else F.lit(None)).cast("float").alias("data_value"),
    )


def empty_events(spark) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in zip(
        PHENOTYPE_COLUMNS, ["bigint", "string", "int", "string", "date", "float"])))


def _restrict(matches: DataFrame, fields: Iterable[int], kind: str | None = None,
              types: Iterable[str] | None = None) -> DataFrame:
    m = matches.where(F.col("field_id").isin(*fields))
    if kind is not None:
        m = m.where(F.col("match") == kind)
    if types is not None:
        m = m.where(F.col("type").isin(*types))
    return m


def _probe(matches: DataFrame, cols: list[str], info: K.MatchInfo) -> DataFrame:
    # the bytes of the whole match table bound every filtered part of it
    return K.broadcast_if_small(matches.select(*cols), info.n_bytes)


def _info(matches: DataFrame, info: K.MatchInfo | None) -> K.MatchInfo:
    return info if info is not None else K.match_info(matches)


# ----------------------------------------------------------------------------------------------
# matching primitives
# ----------------------------------------------------------------------------------------------

def match_exact(records: DataFrame, matches: DataFrame, value_col: str = "field_value",
                info: K.MatchInfo | None = None) -> DataFrame:
    """Records (with ``field_id`` and ``value_col``) x exact codes; one row per matching (definition, type)."""
    m = _probe(matches.where(F.col("match") == "exact"),
               ["field_id", "code", "phenotype", "type", "qual_type", "qual_field"], _info(matches, info))
    return records.join(m, (records["field_id"] == m["field_id"]) & (records[value_col] == m["code"]), "inner") \
        .drop(m["field_id"]).drop("code")


def value_hits(sources: Sources, matches: DataFrame, info: K.MatchInfo | None = None) -> DataFrame:
    """The matched values of the prefix fields (:func:`codes.match_values`), written once (small: distinct values times the
    definitions that list them) and with a broadcast hint if their bytes allow it."""
    info = _info(matches, info)
    spark = matches.sparkSession
    if not info.prefix_lengths:
        return K.match_values(matches.select("field_id", F.col("code").alias("field_value")), matches, info)
    path = scratch_path(spark, "value-hits")
    found = K.match_values(sources.coded_values().where(K.may_match(info)), matches, info)
    found.write.parquet(path)
    return K.broadcast_if_small(spark.read.schema(found.schema).parquet(path))


def match_prefix(records: DataFrame, hits: DataFrame, info: K.MatchInfo | None = None) -> DataFrame:
    """Records (with ``field_id`` and ``field_value``) x matched values: one row per (definition, type) that lists them. With the
    facts of the match table (or of one that holds more), records without a hit are dropped in the scan."""
    if info is not None:
        records = records.where(K.may_match(info))
    return records.join(hits, ["field_id", "field_value"], "inner")


# ----------------------------------------------------------------------------------------------
# Hospital diagnoses and procedures (one join with the episodes table for both)
# ----------------------------------------------------------------------------------------------

def extract_hospital(sources: Sources, matches: DataFrame,
                     fields: Iterable[int] = HOSPITAL_DIAG_FIELDS + HOSPITAL_OPER_FIELDS,
                     info: K.MatchInfo | None = None, hits: DataFrame | None = None) -> DataFrame:
    fields, info = tuple(fields), _info(matches, info)
    hits = value_hits(sources, matches, info) if hits is None else hits
    out = None
    for hesin, diag, oper in sources.parts("hospital"):  # one part, or those of bucketed tables
        rows = _hospital_events(hesin, diag, oper, fields, hits, apart=sources.families is not None, info=info)
        out = rows if out is None else out.unionByName(rows)
    return out


def _hospital_events(hesin: DataFrame, diag: DataFrame, oper: DataFrame, fields: tuple[int, ...], hits: DataFrame,
                     apart: bool, info: K.MatchInfo | None = None) -> DataFrame:
    """Diagnoses and procedures joined to their episodes: once for both, or ``apart`` where the tables are bucketed (each join
    then works without a shuffle, and a union of both would hide the buckets)."""
    parts = []
    diag_levels = [lv for lv, f in enumerate(HOSPITAL_DIAG_FIELDS, start=1) if f in fields]
    oper_levels = [lv for lv, f in enumerate(HOSPITAL_OPER_FIELDS, start=1) if f in fields]
    if diag_levels:
        parts.append(diag.where(F.col("level").isin(*diag_levels)).select(
            "eid", "ins_index",
            F.when(F.col("level") == 1, F.lit(C.F_HOSP_DIAG_MAIN))
            .when(F.col("level") == 2, F.lit(C.F_HOSP_DIAG_SEC)).alias("field_id"),
            F.col("diag_icd10").alias("field_value"), X.null_date().alias("opdate")))
    if oper_levels:  # plain level filters reach the Parquet reader; the derived field_id would not
        parts.append(oper.where(F.col("level").isin(*oper_levels)).select(
            "eid", "ins_index",
            F.when(F.col("level") == 1, F.lit(C.F_HOSP_OPER_MAIN))
            .when(F.col("level") == 2, F.lit(C.F_HOSP_OPER_SEC)).alias("field_id"),
            F.col("oper4").alias("field_value"), "opdate"))
    if not apart and len(parts) == 2:
        parts = [parts[0].unionByName(parts[1])]
    episodes = hesin.select("eid", "ins_index", "admidate", "epistart")
    out = None
    for recs in parts:
        recs = recs.where(F.col("field_id").isin(*fields) & F.col("field_value").isNotNull())
        joined = match_prefix(recs, hits, info).join(episodes, ["eid", "ins_index"], "inner")
        is_diag = F.col("field_id").isin(*HOSPITAL_DIAG_FIELDS)
        eventdate = (
            F.when(is_diag & (F.col("type") == "prevalent"), X.date_unknown())
            .when(is_diag, F.coalesce("admidate", "epistart"))
            .otherwise(F.coalesce("opdate", "admidate", "epistart", X.date_unknown()))
        )
        rows = _out(joined, eventdate)
        out = rows if out is None else out.unionByName(rows)
    return out


def extract_hospital_diagnoses(sources: Sources, matches: DataFrame, level: int | None = None,
                               prevalent: bool | None = None) -> DataFrame:
    """Main (level 1 -> 41202) and/or secondary (level 2 -> 41204), incident and/or prevalent."""
    fields = {1: (C.F_HOSP_DIAG_MAIN,), 2: (C.F_HOSP_DIAG_SEC,), None: HOSPITAL_DIAG_FIELDS}[level]
    if prevalent is not None:
        matches = matches.where(F.col("type") == ("prevalent" if prevalent else "any"))
    return extract_hospital(sources, matches, fields)


def extract_hospital_procedures(sources: Sources, matches: DataFrame, level: int | None = None) -> DataFrame:
    """X11: main (41200) and/or secondary (41210) procedures."""
    fields = {1: (C.F_HOSP_OPER_MAIN,), 2: (C.F_HOSP_OPER_SEC,), None: HOSPITAL_OPER_FIELDS}[level]
    return extract_hospital(sources, matches, fields)


# ----------------------------------------------------------------------------------------------
# Causes of death (joined to the death records on eid only -> two death rows double the output)
# ----------------------------------------------------------------------------------------------

def extract_death(sources: Sources, matches: DataFrame, fields: Iterable[int] = DEATH_FIELDS,
                  info: K.MatchInfo | None = None, hits: DataFrame | None = None) -> DataFrame:
    fields, info = tuple(fields), _info(matches, info)
    hits = value_hits(sources, matches, info) if hits is None else hits
    out = None
    for death, cause in sources.parts("deaths"):
        rows = _death_events(death, cause, fields, hits, info)
        out = rows if out is None else out.unionByName(rows)
    return out


def _death_events(death: DataFrame, cause: DataFrame, fields: tuple[int, ...], hits: DataFrame,
                  info: K.MatchInfo | None = None) -> DataFrame:
    levels = [lv for lv, f in enumerate(DEATH_FIELDS, start=1) if f in fields]
    recs = cause.where(F.col("level").isin(*levels)).select(
        "eid",
        F.when(F.col("level") == 1, F.lit(C.F_DEATH_PRIMARY))
        .when(F.col("level") == 2, F.lit(C.F_DEATH_SECONDARY)).alias("field_id"),
        F.col("cause_icd10").alias("field_value"),
    ).where(F.col("field_id").isin(*fields) & F.col("field_value").isNotNull())
    hit = match_prefix(recs, hits, info)
    # pre-aggregate the death records to (eid, date, multiplicity): the join becomes many-to-one and
    # the reference's row multiplication is restored by a local generate after it
    deaths = death.groupBy("eid", "date_of_death").agg(F.count(F.lit(1)).cast("int").alias("_k"))
    joined = hit.join(deaths, "eid", "inner")
    joined = joined.withColumn("_r", F.explode(F.array_repeat(F.lit(0), F.col("_k"))))
    return _out(joined, F.col("date_of_death"))


# ----------------------------------------------------------------------------------------------
# GP diagnoses, incident and prevalent from one join
# ----------------------------------------------------------------------------------------------

def extract_primary_care(sources: Sources, matches: DataFrame, prevalent: bool | None = None,
                         info: K.MatchInfo | None = None) -> DataFrame:
    info = _info(matches, info)
    m = _restrict(matches, (C.F_GP_CLINICAL,), "exact")
    if prevalent is not None:
        m = m.where(F.col("type") == ("prevalent" if prevalent else "any"))
    recs = sources.gp_clinical.select(
        "eid", F.lit(C.F_GP_CLINICAL).alias("field_id"), F.col("read_code").alias("field_value"), "eventdate"
    ).where(F.col("field_value").isNotNull())
    if info.gp_codes is not None:  # few codes: the scan skips row groups without them (records.write_by_code)
        recs = recs.where(F.col("field_value").isin(*info.gp_codes) if info.gp_codes else F.lit(False))
    hit = match_exact(recs, m, info=info)
    eventdate = F.when(F.col("type") == "prevalent", X.date_unknown()) \
        .otherwise(F.coalesce(F.col("eventdate"), X.date_unknown()))
    return _out(hit, eventdate)


# ----------------------------------------------------------------------------------------------
# Answers in the long survey table
# ----------------------------------------------------------------------------------------------

def _rule(qual_type) -> F.Column:
    """Date rule per matched survey row: self-report year fields, registry, biomarker, or the
    qualifier type of a non-standard field (age / baseline / year). Anything else yields no rows."""
    fid = F.col("field_id")
    return (
        F.when(fid.isin(*C.SELF_REPORT_YEAR_FIELD), F.lit("year"))
        .when(fid == C.F_CANCER_REGISTRY, F.lit("registry"))
        .when(F.col("match") == "biomarker", F.lit("biomarker"))
        .when(fid.isin(*C.STANDARD_FIELDS), F.lit(None))
        .when(qual_type.isin("age", "baseline", "year"), qual_type)
    )


def _qualifier_field() -> F.Column:
    """The field that dates a hit by its rule."""
    fid = F.col("field_id")
    expr = F.when(F.col("_rule") == "registry", F.lit(C.F_CANCER_REG_DATE)) \
        .when(F.col("_rule").isin("biomarker", "baseline"), F.lit(C.F_ASSESS_DATE))
    for answer, year in C.SELF_REPORT_YEAR_FIELD.items():
        expr = expr.when(fid == answer, F.lit(year))
    return expr.when(F.col("_rule").isin("age", "year"), F.col("qual_field"))


def _slot_key(n, field) -> F.Column:
    """(slot, field) as one 64-bit key."""
    return F.shiftleft(n.cast("bigint"), 32).bitwiseOR(field.cast("bigint"))


def extract_survey(sources: Sources, matches: DataFrame, fields: Iterable[int] | None = None,
                   undated: bool = False, info: K.MatchInfo | None = None, hits: DataFrame | None = None) -> DataFrame:
    """X1-X9, X14 over the long table in one pass for all definitions.

    ``undated`` applies X7 instead (no date, no qualifier) to the exact-matched rows."""
    fields = None if fields is None else tuple(fields)
    non_survey = set(HOSPITAL_DIAG_FIELDS + HOSPITAL_OPER_FIELDS + DEATH_FIELDS + (C.F_GP_CLINICAL,))
    m = matches.where(~F.col("field_id").isin(*non_survey))
    if fields is not None:
        m = m.where(F.col("field_id").isin(*fields))
    # a static field filter: partition pruning on a long table stored by field, and union-branch pruning on
    # the fixture views
    info = _info(matches, info)
    kinds = ("exact",) if undated else ("exact", "prefix", "biomarker")
    used = {kind: [f for f in info.kind_fields(kind) if f not in non_survey and (fields is None or f in fields)
                   and (kind != "prefix" or f == C.F_CANCER_REGISTRY)] for kind in kinds}
    columns = ["field_id", "field_value", "match", "phenotype", "type", "qual_type", "qual_field"]
    probe = m.where(F.col("match") == "exact").withColumn("field_value", F.col("code")).select(*columns)
    if used.get("prefix"):
        registry = value_hits(sources, matches, info) if hits is None else hits
        listed = m.where(F.col("match") == "prefix").select("field_id", "phenotype", "type").distinct()
        probe = probe.unionByName(registry.where(F.col("field_id").isin(*used["prefix"])).join(
            listed, ["field_id", "phenotype", "type"], "left_semi").withColumn("match", F.lit("prefix")).select(*columns))
    # a biomarker takes all values of its field, under a key of its own; others go by their value
    probe = probe.withColumn("_code", F.concat(F.lit("="), F.col("field_value")))
    probe = probe.unionByName(m.where(F.col("match") == "biomarker").withColumns(
        {"field_value": F.lit(None).cast("string"), "_code": F.lit("*")}).select(*columns, "_code")).drop("field_value")

    answers = sources.baseline.select("eid", F.col("field").alias("field_id"), "i", "n", F.col("value").alias("field_value"))
    by_value = sorted({*used["exact"], *used.get("prefix", ())})
    measured = used.get("biomarker", [])
    code = F.concat(F.lit("="), F.col("field_value"))
    if measured:
        code = F.when(F.col("field_id").isin(*[f for f in measured if f not in by_value]), F.lit("*")).otherwise(code)
    rows = answers.where(F.col("field_id").isin(*sorted({*by_value, *measured}))).withColumn("_code", code)
    if both := [f for f in measured if f in by_value]:  # fields that some definitions match and others measure
        rows = rows.unionByName(answers.where(F.col("field_id").isin(*both)).withColumn("_code", F.lit("*")))
    hits = rows.join(K.broadcast_if_small(probe), ["field_id", "_code"], "inner").drop("_code")
    if undated:
        return _out(hits, X.null_date())
    hits = hits.withColumn("_rule", _rule(F.col("qual_type"))).where(F.col("_rule").isNotNull())

    # one left join for the qualifiers of all rules: the assessment date of visit 0 for a baseline rule, else the
    # qualifier field of the record's own (visit, slot). Slot and field are packed into one key: it needs a data
    # column, so the scan keeps its static field list and no copy of the hits is planned to prune it further.
    rule = F.col("_rule")
    at_baseline = rule == "baseline"
    hits = hits.withColumns({
        "_visit": F.when(at_baseline, F.lit(0)).otherwise(F.col("i")),
        "_key": _slot_key(F.when(at_baseline, F.lit(0)).otherwise(F.col("n")), _qualifier_field())})
    q_fields = sorted(set(info.qual_fields) | set(C.SELF_REPORT_YEAR_FIELD.values())
                      | {C.F_CANCER_REG_DATE, C.F_ASSESS_DATE})
    qual = sources.baseline.where(F.col("field").isin(*q_fields)).select(
        "eid", F.col("i").alias("_visit"), _slot_key(F.col("n"), F.col("field")).alias("_key"), F.col("value").alias("_q"))
    dated = hits.join(qual, ["eid", "_visit", "_key"], "left")

    # an age rule needs the year of birth too; rows of other rules match nobody, and stay
    # spread by eid
    born = sources.baseline.where((F.col("field") == C.F_YOB) & (F.col("i") == 0) & (F.col("n") == 0)).select(
        "eid", F.col("value").alias("_yob"))
    dated = dated.withColumn("_aged", rule == "age")
    left, right = dated.alias("h"), born.alias("b")
    rows = left.join(right, (F.col("h.eid") == F.col("b.eid")) & F.col("h._aged"), "left").select("h.*", "b._yob")

    eventdate = (
        F.when(rule == "year", X.dated_by_year(F.col("_q")))
        .when(rule == "age", X.dated_by_age(F.col("_q"), F.col("_yob")))
        .when(rule.isin("baseline", "registry", "biomarker"), X.iso_date(F.col("_q")))
    )
    return _out(rows, eventdate)


def extract_self_report(sources: Sources, matches: DataFrame, field_id: int) -> DataFrame:
    """X2 (20001), X3 (20002), X4 (20004): answers dated by the year field of the same visit and slot."""
    return extract_survey(sources, matches, fields=(field_id,))


def extract_cancer_registry(sources: Sources, matches: DataFrame) -> DataFrame:
    """Registry codes (prefix) dated by field 40005 of the same visit and slot."""
    return extract_survey(sources, matches, fields=(C.F_CANCER_REGISTRY,))


def extract_undated(sources: Sources, matches: DataFrame, fields: Iterable[int]) -> DataFrame:
    """Exact answers without a date."""
    return extract_survey(sources, matches, fields=fields, undated=True)


def extract_nonstandard(sources: Sources, matches: DataFrame) -> DataFrame:
    """Every non-standard field through its qualifier (age -> X5, baseline -> X6, year -> X1,
    biomarker -> X14); fields without a usable qualifier yield nothing (listed by the lint)."""
    ns = matches.where(~F.col("field_id").isin(*C.STANDARD_FIELDS))
    return extract_survey(sources, ns)


# ----------------------------------------------------------------------------------------------
# GP biomarker values
# ----------------------------------------------------------------------------------------------

def extract_gp_biomarker(sources: Sources, tag: str, serum_codes: Iterable[str], plasma_codes: Iterable[str]) -> DataFrame:
    """Measurement rows for serum and plasma code lists as ``<tag>_serum`` / ``<tag>_plasma``.
    The scan skips row groups without any of the codes. Provider 2 reports value2 with unit value3, the others value1 without unit; a unit must be NULL or
    one of the accepted units. Both lists probe one table, which Spark broadcasts if it is small (a code in both gives two rows)."""
    spark = sources.gp_clinical.sparkSession
    rows = [(c, f"{tag}_serum") for c in dict.fromkeys(serum_codes)] + \
           [(c, f"{tag}_plasma") for c in dict.fromkeys(plasma_codes)]
    lists = spark.createDataFrame(rows, "code string, phenotype string")
    g = sources.gp_clinical.select(
        "eid", F.col("read_code").alias("code"), "eventdate",
        F.when(F.col("data_provider") == 2, F.col("value2")).otherwise(F.col("value1")).alias("_v"),
        F.when(F.col("data_provider") == 2, F.col("value3")).alias("_unit"),
    ).where(F.col("_unit").isNull() | F.col("_unit").isin(*C.BIOMARKER_UNITS))
    g = g.where(F.col("code").isin(*{c for c, _ in rows}) if rows else F.lit(False))
    hit = g.join(lists, "code", "inner").withColumn("field_id", F.lit(C.F_GP_CLINICAL)) \
        .withColumnRenamed("code", "field_value")
    return _out(hit, F.col("eventdate"), X.try_cast(F.col("_v"), "float"))


# ----------------------------------------------------------------------------------------------
# Whole definitions
# ----------------------------------------------------------------------------------------------

def extract_all(sources: Sources, matches: DataFrame, phenotypes: Iterable[str] | None = None,
                fields: Iterable[int] | None = None, info: K.MatchInfo | None = None) -> DataFrame:
    """X17 (and X16 for one definition): all requested definitions and fields, one pass per source.

    Complex definitions, SNOMED and prescription fields are already absent from the match table;
    ``fields`` restricts to the listed fields (fields a definition does not define yield nothing)."""
    m = matches
    if phenotypes is not None:
        m = m.where(F.col("phenotype").isin(*list(phenotypes)))
    if fields is not None:
        m = m.where(F.col("field_id").isin(*list(fields)))
    info = _info(matches, info)  # of the unfiltered table: a superset is harmless
    hits = value_hits(sources, m, info)
    return (
        extract_hospital(sources, m, info=info, hits=hits)
        .unionByName(extract_death(sources, m, info=info, hits=hits))
        .unionByName(extract_primary_care(sources, m, info=info))
        .unionByName(extract_survey(sources, m, info=info, hits=hits))
    )


def extract_phenotype(sources: Sources, matches: DataFrame, phenotype: str) -> DataFrame:
    """Every field of one definition as one frame."""
    return extract_all(sources, matches, phenotypes=[phenotype])


# ----------------------------------------------------------------------------------------------
# X19 / X20
# ----------------------------------------------------------------------------------------------

def hospital_diagnoses_for(sources: Sources, people: DataFrame) -> DataFrame:
    """Distinct (eid, diagnosis) of the given people over main and secondary diagnoses."""
    d = sources.hesin_diag.where(F.col("diag_icd10").isNotNull()).select("eid", "diag_icd10")
    return d.join(people.select("eid").distinct(), "eid", "left_semi").distinct()


def prescriptions_with_word(sources: Sources, word: str) -> DataFrame:
    """Prescriptions whose drug name has ``word`` at its start or after white space."""
    return sources.gp_prescriptions.where(F.col("drug_name").rlike(X.word_start_pattern(word)))
