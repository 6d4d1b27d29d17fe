"""Definition loading and code tables (C1-C12), restating the reference's own expectations on our catalogue."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from phenolith.operators import codes as K
from phenolith.operators.dates import min_censor_date
from conftest import d


@pytest.fixture(scope="module")
def cat(spark):
    return K.load_catalogue(spark).cache()


@pytest.fixture(scope="module")
def codes(cat):
    return K.code_table(cat).cache()


def values(codes, phenotype, field, type_="any"):
    return sorted(r.code for r in K.field_values(codes, phenotype, field, type_).collect())


def test_load_catalogue(cat):
    rows = {r.variable_name: r for r in cat.collect()}
    assert len(rows) == 10
    r = rows["heart_rhythm"]
    assert r.created_by == "hand" and r.date_created == "2024-01-01"
    assert rows["renal_decline"].created_by is None  # optional metadata -> NULL
    assert rows["airway_disease"].ontologies["SNOMED-CT"] == "195967001"
    assert rows["renal_decline"].gender == ["male", "female"]


def test_definition_fields_in_file_order(cat):
    got = [r.field for r in K.definition_fields(cat).where(F.col("variable_name") == "airway_disease")
           .orderBy("pos").collect()]
    # non-empty fields in file order; empty 20001 and the 'limits' block are not listed
    assert got == ["22167", "6150", "20002", "41202", "41204", "40001", "40002", "42040", "SNOMED-CT"]


def test_field_values(codes):
    assert values(codes, "airway_disease", 20002) == ["1111", "1112"]
    assert values(codes, "heart_rhythm", 41204) == ["A44", "E1"]  # dot removed
    assert values(codes, "renal_decline", 42040) == ["s8i..", "v4i.."]  # first five characters, distinct
    assert values(codes, "renal_decline", 42040, "prevalent") == ["V4i..", "s8i.."]
    assert "V4i.." not in values(codes, "renal_decline", 42040, "any")
    assert values(codes, "bowel_tumour", 41204, "prevalent") == []


def test_empty_field_has_no_definition(cat):
    f = K.definition_fields(cat).where(F.col("variable_name") == "empty_gp").collect()
    assert [r.field for r in f] == ["41202"]


def test_unknown_phenotype_raises(spark, cat):
    with pytest.raises(K.UnknownPhenotypeError):
        K.require_phenotypes(spark, cat, ["renal_decline", "NOPE"])
    assert K.require_phenotypes(spark, cat, ["renal_decline"]).count() == 1
    with pytest.raises(ValueError):
        K.select_phenotypes(spark, cat, ["renal_decline"], db="other")
    assert K.is_valid_phenotype(cat, "renal_decline") and not K.is_valid_phenotype(cat, "NOPE")


def test_flags(cat):
    f = {r.variable_name: r for r in K.flags(cat).collect()}
    assert f["bowel_tumour"].is_cancer and not f["renal_decline"].is_cancer
    assert f["composite_risk"].is_complex and not f["renal_decline"].is_complex
    assert not any(r.is_biomarker for r in f.values())


def test_catalogue_selections(cat):
    groups = {r.group for r in K.categories(cat).collect()}
    assert {"Renal", "Cancers", "Neonatal", "Circulatory"} <= groups
    assert sorted(r.variable_name for r in K.phenotypes_by_category(cat, "Renal").collect()) == ["empty_gp", "renal_decline"]
    names = {r.variable_name for r in K.all_phenotypes(cat, include_cancer=False, include_neonatal=False).collect()}
    assert "bowel_tumour" not in names and "newborn_jaundice" not in names and "renal_decline" in names
    assert [r.variable_name for r in K.complex_phenotypes(cat).collect()] == ["composite_risk"]


def test_prescription_codes(codes):
    rows = {r.phenotype: r for r in K.prescription_codes(codes).collect()}
    assert set(rows) == {"sugar_disorder"}  # all others: no prescription field -> absent (NULL)
    assert rows["sugar_disorder"].bnf == ["Brand#13"] and rows["sugar_disorder"].dmd == ["17"]
    assert rows["sugar_disorder"].welsh_read == []


def test_standard_only_code_table(codes, cat):
    std = K.code_table(cat, standard_only=True)
    assert std.where(F.col("field_id") == 6150).count() == 0
    assert codes.where(F.col("field_id") == 6150).count() == 3


def test_minimal_cover(codes):
    m = K.match_table(codes)
    got = {(r.phenotype, r.field_id, r.type): sorted(x.code for x in m.where(
        (F.col("phenotype") == r.phenotype) & (F.col("field_id") == r.field_id) & (F.col("type") == r.type)).collect())
        for r in m.select("phenotype", "field_id", "type").distinct().collect()}
    assert got[("renal_decline", 41202, "any")] == ["A1"]  # A11 is covered by A1
    assert got[("airway_disease", 41202, "any")] == ["B4"]
    assert got[("bowel_tumour", 40006, "any")] == ["C1", "C20"]
    # prevalent codes only on 41202 / 41204 / 42040; unknown types and complex definitions dropped
    assert ("airway_disease", 40001, "prevalent") not in got
    assert all(p != "composite_risk" for p, _, _ in got)
    assert not m.where(F.col("code") == "S6i..").count()


def test_lint_lists_unextracted_entries(codes):
    reasons = {(r.phenotype, r.code): r.reason for r in K.lint_unextracted(codes).collect()}
    assert reasons[("airway_disease", "E2")].startswith("prevalent code on a field")
    assert reasons[("airway_disease", "S6i..")] == "unknown type"
    assert reasons[("composite_risk", "A2")] == "complex definition"
    assert reasons[("airway_disease", "195967001")] == "non-numeric field"


def test_min_censor_date():
    assert min_censor_date() == d("2015-10-31")
    assert min_censor_date(compat=True) == d("2016-02-28")


def test_field_definition_and_age_field(cat):
    f = K.field_definition(cat, "renal_decline", 6150).collect()
    assert len(f) == 1 and f[0].qual_type == "age" and f[0].pos == 6
    assert K.field_definition(cat, "empty_gp", 42040).count() == 0  # declared but empty
    assert K.field_definition(cat, "airway_disease", "limits").count() == 0
    assert K.age_field_id(cat, "renal_decline", 6150) == 3894
    with pytest.raises(ValueError):
        K.age_field_id(cat, "sugar_disorder", 6150)  # baseline-qualified
