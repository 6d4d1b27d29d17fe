"""Hand-made edge rows (FIXTURES section C), one test each, on small in-memory record tables."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from phenolith.operators import cohort as CO
from phenolith.operators import events as EV
from phenolith.operators import extract as XT
from phenolith.plans.pipeline import Study
from phenolith.sources.records import Sources, normalise_gp_clinical, normalise_gp_registrations
from conftest import d, write_definition

BASELINE = "eid bigint, field int, i int, n int, value string"
HESIN = "eid bigint, ins_index bigint, epistart date, admidate date, disdate date"
DIAG = "eid bigint, ins_index bigint, arr_index int, level int, diag_icd10 string"
OPER = "eid bigint, ins_index bigint, arr_index int, level int, opdate date, oper4 string"
DEATH = "eid bigint, ins_index int, date_of_death date"
CAUSE = "eid bigint, ins_index int, level int, cause_icd10 string"
GP_RAW = ("eid bigint, data_provider int, event_dt date, read_2 string, read_3 string, value1 string, "
          "value2 string, value3 string")
REG = "eid bigint, data_provider int, reg_date date, deduct_date date"
PRESC = ("eid bigint, data_provider int, issue_date date, bnf_code string, dmd_code string, drug_name string, "
         "quantity string")


def make_sources(spark, baseline=(), hesin=(), diag=(), oper=(), death=(), cause=(), gp=(), reg=(), presc=()):
    b = spark.createDataFrame(list(baseline), BASELINE)
    return Sources(
        baseline=b,
        hesin=spark.createDataFrame(list(hesin), HESIN),
        hesin_diag=spark.createDataFrame(list(diag), DIAG),
        hesin_oper=spark.createDataFrame(list(oper), OPER),
        death=spark.createDataFrame(list(death), DEATH),
        death_cause=spark.createDataFrame(list(cause), CAUSE),
        gp_clinical=normalise_gp_clinical(spark.createDataFrame(list(gp), GP_RAW), b),
        gp_registrations=normalise_gp_registrations(spark.createDataFrame(list(reg), REG), b),
        gp_prescriptions=spark.createDataFrame(list(presc), PRESC),
    )


@pytest.fixture(scope="module")
def defs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("defs")
    write_definition(folder, "edge", """\
    20002:
      metadata:
        time_qualifier: {field_id: 20008, type: year}
      values:
      - {code: '1105', value: x, type: any}
    6150:
      metadata:
        time_qualifier: {field_id: 3894, type: age}
      values:
      - {code: '2', value: x, type: any}
    41202:
      metadata: {desc: main}
      values:
      - {code: N18, value: x, type: any}
      - {code: N18.5, value: x, type: any}
    41200:
      metadata: {desc: oper}
      values:
      - {code: K1, value: x, type: any}
    40001:
      metadata: {desc: death}
      values:
      - {code: A, value: x, type: any}
    42040:
      metadata: {desc: gp}
      values:
      - {code: 44F..00, value: x, type: any}
      - {code: 44F..11, value: x, type: any}
      - {code: 12B4., value: x, type: any}
      - {code: 12B4., value: x, type: prevalent}
    """)
    return str(folder)


def events_of(spark, defs, **tables):
    src = make_sources(spark, **tables)
    return Study.load(spark, src, defs).events()


def rows(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def bag(items):
    return Counter(items)


def test_year_rounding_and_unknown_years(spark, defs):
    base = [(1, 20002, 0, k, "1105") for k in range(6)]
    base += [(1, 20008, 0, 0, "1986.5"), (1, 20008, 0, 1, "1987.5"), (1, 20008, 0, 2, "-1"),
             (1, 20008, 0, 3, "-3"), (1, 20008, 0, 4, "abc")]  # slot 5: no year row at all
    ev = events_of(spark, defs, baseline=base)
    assert sorted(r.eventdate for r in ev.collect()) == sorted(
        [d("1986-01-01"), d("1988-01-01")] + [d("1900-01-01")] * 4)


def test_age_qualifier_uses_visit_zero_birth_year(spark, defs):
    base = [(1, 34, 0, 0, "1950"), (1, 6150, 2, 0, "2"), (1, 3894, 2, 0, "40"),
            (2, 34, 0, 0, "1950"), (2, 6150, 0, 0, "2"), (2, 3894, 0, 0, "-1"),
            (3, 6150, 0, 0, "2"), (3, 3894, 0, 0, "30")]  # no year of birth -> NULL date
    ev = events_of(spark, defs, baseline=base)
    assert rows(ev, "eid", "eventdate") == bag([(1, d("1990-01-01")), (2, d("1900-01-01")), (3, None)])


def test_nested_prefixes_match_once_and_fold_case(spark, defs):
    hesin = [(1, 1, d("2010-01-01"), d("2010-01-02"), None)]
    diag = [(1, 1, 1, 1, "N185"), (1, 1, 2, 1, "n185"), (1, 1, 3, 1, "N19")]
    ev = events_of(spark, defs, hesin=hesin, diag=diag)
    assert rows(ev, "field_value") == bag([("N185",), ("n185",)])


def test_read_codes_exact_case_and_both_types(spark, defs):
    gp = [(1, 1, d("2011-01-01"), "44F..", None, None, None, None),
          (1, 1, d("2011-01-01"), "44f..", None, None, None, None),
          (1, 1, d("2012-05-05"), None, "12B4.", None, None, None)]
    ev = events_of(spark, defs, gp=gp)
    assert rows(ev, "field_value", "eventdate") == bag([
        ("12B4.", d("1900-01-01")), ("12B4.", d("2012-05-05")), ("44F..", d("2011-01-01"))])


def test_gp_both_read_columns_and_birth_year_dates(spark, defs):
    base = [(1, 34, 0, 0, "1950")]
    gp = [(1, 1, d("2011-01-01"), "44F..", "44F..", None, None, None),
          (1, 1, d("1902-02-02"), "44F..", None, None, None, None),
          (1, 1, d("1903-03-03"), None, "44F..", None, None, None),
          (2, 1, d("1902-02-02"), "44F..", None, None, None, None)]  # no year of birth: date kept
    src = make_sources(spark, baseline=base, gp=gp)
    assert src.gp_clinical.where(F.col("read_code").isNull()).count() == 1
    ev = Study.load(spark, src, defs).events()
    assert rows(ev, "eid", "eventdate") == bag([(1, d("1950-07-01")), (1, d("1950-07-01")), (2, d("1902-02-02"))])


def test_hospital_dates(spark, defs):
    hesin = [(1, 1, d("2010-01-01"), None, None), (1, 2, None, None, None)]
    diag = [(1, 1, 1, 1, "N18"), (1, 2, 1, 1, "N18")]
    oper = [(1, 2, 1, 1, None, "K12")]
    ev = events_of(spark, defs, hesin=hesin, diag=diag, oper=oper)
    assert rows(ev, "field_id", "eventdate") == bag([(41200, d("1900-01-01")), (41202, None), (41202, d("2010-01-01"))])


def test_death_join_on_eid_doubles_rows(spark, defs):
    ev = events_of(spark, defs, death=[(1, 0, d("2015-01-01")), (1, 1, d("2015-01-01"))],
                   cause=[(1, 0, 1, "A01")])
    assert ev.count() == 2


def test_first_events_clamp_and_cohort_membership(spark, defs):
    base = [(1, 34, 0, 0, "1950"), (1, 52, 0, 0, "6"), (2, 34, 0, 0, "1960"), (2, 52, 0, 0, "1")]
    hesin = [(1, 1, d("1940-01-01"), None, None), (9, 1, d("2000-01-01"), None, None)]
    diag = [(1, 1, 1, 1, "N18"), (9, 1, 1, 1, "N18")]
    gp = [(2, 1, None, None, "12B4.", None, None, None)]
    src = make_sources(spark, baseline=base, hesin=hesin, diag=diag, gp=gp)
    study = Study.load(spark, src, defs)
    first = study.first_events()
    got = rows(first, "eid", "field_id", "eventdate")
    # before birth -> birth date; the sentinel stays; participant 9 is not in the cohort
    assert got == bag([(1, 41202, d("1950-06-01")), (2, 42040, d("1900-01-01"))])
    pairs = first.groupBy("eid", "phenotype", "field_id").count().where("count > 1").count()
    assert pairs == 0


def test_cohort_merge_keeps_everyone_and_sex_label(spark, defs):
    base = [(1, 31, 0, 0, "0"), (2, 52, 0, 0, "3")]
    src = make_sources(spark, baseline=base)
    study = Study.load(spark, src, defs)
    merged = CO.cohort_phenotype_first(study.cohort(), study.first_events())
    assert rows(merged, "eid", "phenotype", "sex_label") == bag([(1, None, "female"), (2, None, "male")])


def test_single_registration_flag(spark, defs):
    base = [(1, 31, 0, 0, "1"), (2, 31, 0, 0, "1"), (3, 31, 0, 0, "1")]
    reg = [(2, 3, d("2000-01-01"), d("2010-01-01")), (3, 1, d("2000-01-01"), None), (3, 2, d("2001-01-01"), d("2005-01-01"))]
    gp = [(3, 4, d("2011-01-01"), "x", None, None, None, None)]
    src = make_sources(spark, baseline=base, reg=reg, gp=gp)
    c = Study.load(spark, src, defs).cohort()
    assert rows(c, "eid", "gp_ehr", "gp_ehr_single_reg", "gp_ehr_deduct_date", "gp_ehr_data_provider") == bag([
        (1, 0, 0, None, None), (2, 1, 1, d("2010-01-01"), 3), (3, 1, 0, None, 4)])


def test_gp_biomarker_units_and_providers(spark):
    gp = [(1, 2, d("2010-01-01"), "AB1..", None, "1.0", "2.5", "mmol/L"),
          (1, 2, d("2010-01-01"), "AB1..", None, "1.0", "2.5", "mg/dl"),
          (1, 3, None, "AB1..", None, "4.5", "9.9", "mg/dl"),
          (1, 3, d("2010-01-01"), "CD2..", None, "x", None, None)]
    src = make_sources(spark, gp=gp)
    out = XT.extract_gp_biomarker(src, "chol", ["AB1.."], ["AB1..", "CD2.."])
    assert rows(out, "phenotype", "data_value", "eventdate") == bag([
        ("chol_plasma", 2.5, d("2010-01-01")), ("chol_plasma", 4.5, None), ("chol_plasma", None, d("2010-01-01")),
        ("chol_serum", 2.5, d("2010-01-01")), ("chol_serum", 4.5, None)])


def test_drug_word_start(spark):
    presc = [(1, 1, None, None, None, "prednisolone 5mg", None), (1, 1, None, None, None, "methylprednisolone", None),
             (1, 1, None, None, None, "tab prednisolone", None)]
    src = make_sources(spark, presc=presc)
    assert XT.prescriptions_with_word(src, "prednisolone").count() == 2


def test_phenotype_first_removes_sentinels_then_picks_earliest(spark):
    first = spark.createDataFrame([
        (1, "p", 41202, d("1900-01-01")), (1, "p", 42040, d("2005-01-01")), (1, "p", 20002, d("2005-01-01")),
        (2, "p", 41202, d("2037-07-07")), (3, "p", 41202, None)],
        "eid bigint, phenotype string, field_id int, eventdate date")
    got = rows(EV.phenotype_first(first), "eid", "field_id", "eventdate")
    assert got == bag([(1, 20002, d("2005-01-01")), (3, 41202, None)])


def test_unique_people_check(spark):
    from phenolith.operators import dates as D

    cohort = spark.createDataFrame([(1, "2010-01-01", None), (1, "2011-01-01", None)],
                                   "eid bigint, f53 string, dob date")
    with pytest.raises(ValueError):
        D.baseline_date(cohort, check=True)
    assert D.baseline_date(cohort.limit(1), check=True).count() == 1


def test_extreme_years_give_null_not_errors(spark, defs):
    base = [(1, 20002, 0, k, "1105") for k in range(3)]
    base += [(1, 20008, 0, 0, "1e9"), (1, 20008, 0, 1, "99999"), (1, 20008, 0, 2, "1e300")]
    ev = events_of(spark, defs, baseline=base)
    assert [r.eventdate for r in ev.collect()] == [None, None, None]


def test_hot_participant_with_forced_skew_split(spark, defs):
    """One person holds a third of the rows; AQE is made to treat partitions as skewed so the split
    path runs. Results must equal a direct count."""
    hot, others = 1, list(range(2, 202))
    hesin = [(e, k, d("2010-01-01"), d("2010-01-02"), None) for e in [hot] * 100 for k in [0]] + \
            [(e, 0, d("2011-01-01"), None, None) for e in others]
    hesin = list({(h[0], h[1]): h for h in hesin}.values())
    diag = [(hot, 0, a, 1, "N18" + str(a % 10)) for a in range(100)] + [(e, 0, 1, 1, "N189") for e in others]
    gp = [(hot, 1, d("2012-01-01"), "44F..", None, None, None, None)] * 100 + \
         [(e, 1, d("2013-01-01"), "44F..", None, None, None, None) for e in others]
    base = [(e, 34, 0, 0, "1950") for e in [hot] + others] + [(e, 52, 0, 0, "1") for e in [hot] + others]
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        src = make_sources(spark, baseline=base, hesin=hesin, diag=diag, gp=gp)
        study = Study.load(spark, src, defs)
        ev = study.events()
        counts = Counter((r.eid == hot, r.field_id) for r in ev.collect())
        assert counts == Counter({(True, 41202): 100, (False, 41202): 200, (True, 42040): 100, (False, 42040): 200})
        first = rows(study.first_events(), "eid", "field_id", "eventdate")
        assert first[(hot, 41202, d("2010-01-02"))] == 1 and first[(hot, 42040, d("2012-01-01"))] == 1
        assert sum(first.values()) == 2 * 201
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
