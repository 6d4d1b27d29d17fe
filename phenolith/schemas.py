"""Schemas of the record tables and of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

# the event fact table: bag semantics, no key
PHENOTYPES = T.StructType([
    T.StructField("eid", T.LongType()),
    T.StructField("phenotype", T.StringType()),
    T.StructField("field_id", T.IntegerType()),
    T.StructField("field_value", T.StringType()),
    T.StructField("eventdate", T.DateType()),
    T.StructField("data_value", T.FloatType()),
])
PHENOTYPE_COLUMNS = [f.name for f in PHENOTYPES.fields]
#: The earliest event date of each person, definition and field, before cohort and birth date are looked at.
EARLIEST = T.StructType([PHENOTYPES[c] for c in ("eid", "phenotype", "field_id", "eventdate")])

# column lists of the record files (the columns the engine reads; extra columns in a file are ignored)
RECORD_COLUMNS = {
    "hesin": ("eid", "ins_index", "epistart", "epiend", "admidate", "disdate"),
    "hesin_diag": ("eid", "ins_index", "arr_index", "level", "diag_icd10"),
    "hesin_oper": ("eid", "ins_index", "arr_index", "level", "opdate", "oper4"),
    "death": ("eid", "ins_index", "date_of_death"),
    "death_cause": ("eid", "ins_index", "level", "cause_icd10"),
    "gp_clinical": ("eid", "data_provider", "event_dt", "read_2", "read_3", "value1", "value2", "value3"),
    "gp_registrations": ("eid", "data_provider", "reg_date", "deduct_date"),
    "gp_prescriptions": ("eid", "data_provider", "issue_date", "bnf_code", "dmd_code", "drug_name", "quantity"),
}
RECORD_DATE_COLUMNS = {
    "hesin": ("epistart", "epiend", "admidate", "disdate"),
    "hesin_oper": ("opdate",),
    "death": ("date_of_death",),
    "gp_clinical": ("event_dt",),
    "gp_registrations": ("reg_date", "deduct_date"),
    "gp_prescriptions": ("issue_date",),
}
# integer columns; the remaining ones stay text (some "integer" columns hold letters in the real files)
RECORD_INT_COLUMNS = {
    "hesin": ("ins_index",),
    "hesin_diag": ("ins_index", "arr_index", "level"),
    "hesin_oper": ("ins_index", "arr_index", "level"),
    "death": ("ins_index",),
    "death_cause": ("ins_index", "level"),
    "gp_clinical": ("data_provider",),
    "gp_registrations": ("data_provider",),
    "gp_prescriptions": ("data_provider",),
}
