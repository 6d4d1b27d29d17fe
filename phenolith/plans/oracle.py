"""

Set-based and independent of the engine: the definition files become one ``VALUES`` table of codes, matched to the
distinct values of the records with ``=`` or ``starts_with`` over the **full** code lists (no prefix cover), and every
source is one statement for all definitions. Field numbers, dates and labels are stated here again, not imported, so
that a wrong constant in the engine shows. The definition folder is read with PyYAML on the driver: this is test tooling.
"""

from __future__ import annotations

import glob
import os
from collections.abc import Iterable

import yaml

from phenolith.operators.codes import DEFAULT_DEFINITIONS
from phenolith.sources import views

UNKNOWN = "DATE '1900-01-01'"
YEAR_OF = {20001: 20006, 20002: 20008, 20004: 20010}
REGISTRY, REGISTRY_DATE = 40006, 40005
BIRTH_YEAR, VISIT_DATE = 34, 53
DIAGNOSES, OPERATIONS, DEATHS, GP = (41202, 41204), (41200, 41210), (40001, 40002), 42040
NEVER = (20003, 42039)
WITH_PREVALENT = (*DIAGNOSES, GP)
BY_START = (*DIAGNOSES, *OPERATIONS, *DEATHS, REGISTRY)
STANDARD = (*YEAR_OF, *NEVER, *BY_START, GP)
LABELS = {"ehr_hospital": (*DIAGNOSES, *OPERATIONS), "ehr_death": DEATHS, "ehr_primary_care": (GP, 42039), "ehr_cancer": (REGISTRY,)}
COHORT_FIELDS = (31, 34, 52, 53, 54, 21003, 189, 21001, 50, 21002, 95, 94, 20116, 20117, 21000, 40000)
GP_UNITS = ("MEA000", "MEA096", "mmol/l", "mmol/L", "MMOL/L", "Mmol/mol", "Unknown", "No UOM assigned")


def text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def listed(values: Iterable) -> str:
    return "(" + ", ".join(str(v) if isinstance(v, int) else text(v) for v in values) + ")"


# ---- the definitions as rows ----------------------------------------------------------------------

def _dated_by(field: int, about: dict) -> tuple[str, int | None] | None:
    """How answers to a survey field are dated: (rule, field that holds the date), None if they are not extracted."""
    if field in YEAR_OF:
        return "year", YEAR_OF[field]
    if field == REGISTRY:
        return "date", REGISTRY_DATE
    if field in STANDARD:
        return None
    if about.get("type") == "biomarker":
        return "biomarker", VISIT_DATE
    given = about.get("time_qualifier") or {}
    if given.get("type") == "baseline":
        return "baseline", VISIT_DATE
    if given.get("type") in ("age", "year"):
        return given["type"], int(given["field_id"])
    return None


def code_rows(folder: str = DEFAULT_DEFINITIONS) -> list[tuple]:
    """(phenotype, field, kind, code, rule, asked) of every code that counts."""
    rows = []
    for path in sorted(glob.glob(os.path.join(folder, "*.yaml"))):
        with open(path) as f:
            document = yaml.safe_load(f)
        about = document["metadata"]
        if "complex_logic" in about:
            continue
        for name, body in document["definitions"].items():
            if not str(name).isdigit() or int(name) in NEVER:
                continue
            field = int(name)
            if field in (*DIAGNOSES, *OPERATIONS, *DEATHS, GP):
                rule = ("record", None)
            else:
                rule = _dated_by(field, body.get("metadata") or {})
            for entry in body.get("values") or []:
                kind = str(entry.get("type"))
                if kind == "any" or kind == "prevalent" and field in WITH_PREVALENT:
                    code = str(entry["code"])[:5] if field == GP else str(entry["code"]).replace(".", "")
                    rows.append((about["variable_name"], field, kind, code, *(rule or (None, None))))
    return rows


def _codes(rows: list[tuple]) -> str:
    values = ",\n  ".join(f"({text(p)}, {f}, {text(k)}, {text(c)}, {text(r)}, CAST({a or 'NULL'} AS INTEGER))" for p, f, k, c, r, a in rows)
    return f"SELECT * FROM (VALUES\n  {values}) AS c(phenotype, field_id, kind, code, rule, asked)"


# ---- events: one statement a source ---------------------------------------------------------------

#: The records that hold codes: field, value, and what their dates need.
RECORDS = {
    "diagnosis": ("SELECT eid, ins_index, CASE level WHEN 1 THEN 41202 WHEN 2 THEN 41204 END AS field_id, diag_icd10 AS value "
                  "FROM raw_hesin_diag", DIAGNOSES),
    "operation": ("SELECT eid, ins_index, opdate, CASE level WHEN 1 THEN 41200 WHEN 2 THEN 41210 END AS field_id, oper4 AS value "
                  "FROM raw_hesin_oper", OPERATIONS),
    "cause": ("SELECT eid, CASE level WHEN 1 THEN 40001 WHEN 2 THEN 40002 END AS field_id, cause_icd10 AS value FROM raw_death_cause", DEATHS),
    "gp_record": ("SELECT eid, eventdate, 42040 AS field_id, read_code AS value FROM gp_clinical", (GP,)),
    "answer": ("SELECT eid, i, n, field AS field_id, value FROM raw_baseline", None),
}

_YEAR = "make_date(CAST(round_even({0}, 0) AS INTEGER), 1, 1)"
_NUMBER = "TRY_CAST({0} AS DOUBLE)"


def iso(value: str) -> str:
    return f"CAST(try_strptime({value}, '%Y-%m-%d') AS DATE)"


def _event(date: str, value: str = "value") -> str:
    return (f"SELECT CAST(eid AS BIGINT) AS eid, phenotype, CAST(field_id AS INTEGER) AS field_id, CAST({value} AS VARCHAR) AS field_value, "
            f"CAST({date} AS DATE) AS eventdate, CAST(NULL AS FLOAT) AS data_value")


_SURVEY_DATE = f"""CASE WHEN rule IN ('year', 'age') AND coalesce({_NUMBER.format('q.value')}, 0) <= 0 THEN {UNKNOWN}
     WHEN rule = 'year' THEN {_YEAR.format(_NUMBER.format('q.value'))}
     WHEN rule = 'age' THEN {_YEAR.format(_NUMBER.format('q.value') + ' + ' + _NUMBER.format('born.value'))}
     ELSE {iso('q.value')} END"""

SOURCES = {
    "diagnosis": _event(f"CASE kind WHEN 'prevalent' THEN {UNKNOWN} ELSE coalesce(admidate, epistart) END") +
    " FROM diagnosis JOIN hits USING (field_id, value) JOIN raw_hesin USING (eid, ins_index)",
    "operation": _event(f"coalesce(opdate, admidate, epistart, {UNKNOWN})") +
    " FROM operation JOIN hits USING (field_id, value) JOIN raw_hesin USING (eid, ins_index)",
    "cause": _event("date_of_death") + " FROM cause JOIN hits USING (field_id, value) JOIN raw_death USING (eid)",
    "gp_record": _event(f"CASE kind WHEN 'any' THEN coalesce(eventdate, {UNKNOWN}) ELSE {UNKNOWN} END") +
    " FROM gp_record JOIN hits USING (field_id, value)",
    "answer": _event(_SURVEY_DATE, "h.value").replace("CAST(eid", "CAST(h.eid") + """
FROM (SELECT *, CASE rule WHEN 'baseline' THEN 0 ELSE i END AS at_visit, CASE rule WHEN 'baseline' THEN 0 ELSE n END AS at_slot
      FROM answer JOIN hits USING (field_id, value) WHERE rule IS NOT NULL) h
LEFT JOIN raw_baseline q ON q.field = h.asked AND q.eid = h.eid AND q.i = h.at_visit AND q.n = h.at_slot
LEFT JOIN (SELECT eid, value FROM raw_baseline WHERE field = 34 AND i = 0 AND n = 0) born ON born.eid = h.eid""",
}
UNDATED = _event("NULL") + " FROM answer JOIN hits USING (field_id, value)"


def events_sql(phenotypes: Iterable[str] | None = None, fields: Iterable[int] | None = None, rules: Iterable[str] | None = None,
               undated: bool = False) -> str:
    """The events of the chosen definitions, fields or (for fields outside the standard ones) dating rules."""
    rows = [r for r in code_rows() if (phenotypes is None or r[0] in set(phenotypes)) and (fields is None or r[1] in set(fields))
            and (rules is None or r[1] not in STANDARD and r[4] in set(rules))]
    used = {r[1] for r in rows}
    of_records = {f for _, own in RECORDS.values() if own for f in own}
    sources = [s for s, (_, own) in RECORDS.items() if (used & set(own) if own else used - of_records)]
    if not sources:
        return _event("NULL", "NULL") + " FROM (SELECT NULL AS eid, '' AS phenotype, 0 AS field_id) WHERE false"
    ctes = [f"codes AS ({_codes(rows)})", *(f"{s} AS ({RECORDS[s][0]})" for s in sources)]
    values = " UNION ".join(f"SELECT field_id, value FROM {s}" for s in sources)
    ctes.append(f"""hits AS (SELECT DISTINCT field_id, value, phenotype, kind, rule, asked FROM ({values}) v JOIN codes USING (field_id)
  WHERE CASE WHEN rule = 'biomarker' THEN true WHEN field_id IN {listed(BY_START)} THEN starts_with(upper(value), upper(code))
             ELSE value = code END)""")
    body = [UNDATED] if undated else [SOURCES[s] for s in sources]
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(body)


# ---- GP tables, cohort, first events --------------------------------------------------------------

def _born(date: str) -> str:
    """A date in 1902 or 1903 is the middle of the year of birth, where that is known."""
    return f"CASE WHEN year({date}) BETWEEN 1902 AND 1903 AND yob IS NOT NULL THEN make_date(yob, 7, 1) ELSE {date} END AS {date}"


_YOB = "(SELECT eid, CAST(value AS INTEGER) AS yob FROM raw_baseline WHERE field = 34 AND i = 0 AND n = 0)"
GP_CLINICAL_SQL = f"""SELECT eid, data_provider, {_born('event_dt')[:-len(' AS event_dt')]} AS eventdate, read_2, read_3, value1, value2, value3,
  CASE WHEN (read_2 IS NULL) <> (read_3 IS NULL) THEN coalesce(read_2, read_3) END AS read_code
FROM raw_gp_clinical LEFT JOIN {_YOB} USING (eid)"""
GP_REGISTRATIONS_SQL = f"SELECT eid, data_provider, {_born('reg_date')}, {_born('deduct_date')} FROM raw_gp_registrations LEFT JOIN {_YOB} USING (eid)"

RECORD_CTES = ("raw_hesin", "raw_hesin_diag", "raw_hesin_oper", "raw_death", "raw_death_cause",
               "raw_gp_clinical", "raw_gp_registrations", "raw_gp_prescriptions", "raw_prescription_lines",
               "raw_baseline")


def with_views(body: str, extra: dict[str, str] | None = None, names: Iterable[str] = RECORD_CTES) -> str:
    """``WITH`` the record views (+ the normalised GP tables and any extra CTEs) followed by ``body``."""
    more = {"gp_clinical": GP_CLINICAL_SQL, "gp_registrations": GP_REGISTRATIONS_SQL, **(extra or {})}
    ctes = views.oracle_ctes(list(names)).rstrip() + "".join(f",\n{name} AS ({sql})" for name, sql in more.items())
    return f"{ctes}\n{body if body.lstrip().startswith(('SELECT', 'FROM')) else f'SELECT * FROM ({body})'}"


def cohort_sql(day: int = 1) -> str:
    """One aggregate per table, joined by person."""
    at_first = ", ".join(f"max(value) FILTER (WHERE field = {f} AND i = 0 AND n = 0) AS f{f}" for f in COHORT_FIELDS)
    shown = ", ".join(f"f{f}" for f in COHORT_FIELDS if f not in (31, 34, 52, 53, 54, 40000))
    return f"""SELECT eid, f31, f34, f52, f53, f54,
  CASE WHEN list_contains([11004, 11005], TRY_CAST(f54 AS INTEGER)) THEN 'S'
       WHEN list_contains([11003, 11022, 11023], TRY_CAST(f54 AS INTEGER)) THEN 'W' ELSE 'E' END AS country,
  CASE WHEN TRY_CAST(f34 AS INTEGER) BETWEEN 1 AND 9999 AND TRY_CAST(f52 AS INTEGER) BETWEEN 1 AND 12
       THEN make_date(CAST(f34 AS INTEGER), CAST(f52 AS INTEGER), {day}) END AS dob,
  {shown}, {iso('f40000')} AS f40000,
  CAST(reg.rows IS NOT NULL OR clin.rows IS NOT NULL OR rx.rows IS NOT NULL AS INTEGER) AS gp_ehr,
  CAST(coalesce(rx.provider, clin.provider, reg.provider) AS INTEGER) AS gp_ehr_data_provider,
  CAST(coalesce(reg.rows, 0) = 1 AS INTEGER) AS gp_ehr_single_reg,
  CASE WHEN reg.rows = 1 THEN reg.deducted END AS gp_ehr_deduct_date
FROM (SELECT eid, {at_first} FROM raw_baseline GROUP BY eid)
LEFT JOIN (SELECT eid, count(*) AS rows, min(data_provider) AS provider, min(deduct_date) AS deducted FROM gp_registrations GROUP BY eid) reg USING (eid)
LEFT JOIN (SELECT eid, count(*) AS rows, min(data_provider) AS provider FROM gp_clinical GROUP BY eid) clin USING (eid)
LEFT JOIN (SELECT eid, count(*) AS rows, min(data_provider) AS provider FROM raw_gp_prescriptions GROUP BY eid) rx USING (eid)"""


def labels_sql(compat: bool = False) -> str:
    """(field_id, label) of the fields that have one; ``compat``: 41240 stands where 41210 is meant (Q2)."""
    rows = [(41240 if compat and f == 41210 else f, label) for label, own in LABELS.items() for f in own]
    return "(VALUES " + ", ".join(f"({f}, {text(label)})" for f, label in rows) + ") AS l(field_id, label)"


def first_sql(compat: bool = False) -> str:
    """The earliest event of each person, definition and field, not before birth unless its date is a placeholder."""
    return f"""SELECT eid, phenotype, field_id, coalesce(label, 'selfreport') AS field_id_label,
  CASE WHEN earliest IS NULL OR dob IS NULL OR earliest IN ({UNKNOWN}, DATE '1901-01-01') THEN earliest ELSE greatest(earliest, dob) END AS eventdate
FROM (SELECT eid, phenotype, field_id, min(eventdate) AS earliest FROM phenotypes GROUP BY ALL)
JOIN (SELECT eid, dob FROM baseline_cohort) USING (eid) LEFT JOIN {labels_sql(compat)} USING (field_id)"""
