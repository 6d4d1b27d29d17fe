"""Event store (L8, X18, E5, E6), file loading (L1-L3) and the column profile."""

from __future__ import annotations

import dataclasses
import math
import os
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from phenolith.operators import describe as R
from phenolith.plans.pipeline import Study, extract_phenotypes
from phenolith.session import scratch_path
from phenolith.schemas import RECORD_COLUMNS
from phenolith.sources import records as L
from phenolith.sources import views
from phenolith.sources.store import ConflictingWrite, EventStore
from conftest import SF_SMALL, d


@pytest.fixture(scope="module")
def study(spark):
    return Study.fixture(spark, SF_SMALL)


@pytest.fixture(scope="module")
def all_events(study):
    return sorted(tuple(r) for r in study.events().collect())


def store_rows(store):
    return sorted(tuple(r) for r in store.read().collect())


def fresh(spark):
    return EventStore(spark, scratch_path(spark, "phenotypes"))


def test_skip_twice_equals_once(spark, study, all_events):
    store = fresh(spark)
    extract_phenotypes(study, store=store, testing=False)
    extract_phenotypes(study, store=store, testing=False)  # everything already there: skipped
    assert store_rows(store) == all_events
    assert ("renal_decline", 41202) in store.partitions()


def test_refresh_equals_from_scratch(spark, study, all_events):
    store = fresh(spark)
    extract_phenotypes(study, store=store, testing=False)
    stale = store.read().where(F.col("phenotype") == "renal_decline")
    store.append(stale.withColumn("eventdate", F.lit(None).cast("date")))
    extract_phenotypes(study, ["renal_decline"], store=store, refresh=True, testing=False)
    assert store_rows(store) == all_events


def test_failed_refresh_keeps_the_old_events(spark, study, all_events, monkeypatch):
    store = fresh(spark)
    extract_phenotypes(study, store=store, testing=False)

    broken = study.events().withColumn("field_value", F.raise_error(F.lit("lost")).cast("string"))

    def failing(*args, **kwargs):
        return broken

    with monkeypatch.context() as patch:
        patch.setattr("phenolith.operators.extract.extract_all", failing)
        with pytest.raises(Exception) as failed:
            extract_phenotypes(study, store=store, refresh=True, testing=False)
    assert "lost" in str(failed.value)
    assert store_rows(store) == all_events
    assert len(os.listdir(store.path.removeprefix("file:") + "/data")) == 1  # what the failed run wrote is gone


def test_failure_at_the_switch_keeps_the_old_events(spark, study, all_events, monkeypatch):
    """New rows are written, then the run dies before its version appears."""
    store = fresh(spark)
    extract_phenotypes(study, store=store, testing=False)

    def dies(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(EventStore, "_commit", dies)
        with pytest.raises(OSError, match="lost"):
            extract_phenotypes(study, store=store, refresh=True, testing=False)
        with pytest.raises(OSError, match="lost"):
            store.delete("renal_decline")
    assert store_rows(store) == all_events and store.versions() == [1]


def test_readers_are_pinned_and_conflicting_writers_refused(spark, study, all_events):
    store = fresh(spark)
    extract_phenotypes(study, store=store, testing=False)
    before = store.read()
    base = store.manifest()
    store.delete("renal_decline")
    assert sorted(map(tuple, before.collect())) == all_events == sorted(map(tuple, store.read(1).collect()))
    with pytest.raises(ConflictingWrite):
        store._commit(base, {}, {})
    assert store.versions() == [1, 2]
    store.append(spark.createDataFrame(before.where("phenotype = 'renal_decline'").collect(), before.schema))
    assert store_rows(store) == all_events
    extract_phenotypes(study, store=store, refresh=True, testing=False)
    assert store.vacuum() == 2 and store.versions() == [4] and store_rows(store) == all_events


def test_changed_and_removed_codes(spark, study, all_events, monkeypatch):
    store = fresh(spark)
    gone = (F.col("phenotype") == "renal_decline") & F.col("field_id").isin(41202, 20002)
    fewer = dataclasses.replace(study, matches=study.matches.where(~gone | (F.col("field_id") == 41202) & (F.xxhash64("code") % 2 == 0)), _info=None)
    extract_phenotypes(fewer, store=store, testing=False)
    assert store_rows(store) != all_events
    asked = []
    from phenolith.operators import extract as XT

    whole = XT.extract_all
    monkeypatch.setattr("phenolith.operators.extract.extract_all", lambda s, m, **kw: (
        asked.extend(tuple(r) for r in m.select("phenotype", "field_id").distinct().collect()), whole(s, m, **kw))[1])
    extract_phenotypes(study, store=store, testing=False)
    assert store_rows(store) == all_events and {p for p, _ in asked} == {"renal_decline"}
    extract_phenotypes(fewer, ["renal_decline"], store=store, testing=False)  # a field that is listed no longer goes
    assert all(r[2] != 20002 for r in store_rows(store) if r[1] == "renal_decline")


def test_nothing_left_extracts_nothing(spark, study, monkeypatch):
    store = fresh(spark)
    extract_phenotypes(study, store=store, testing=False)
    requested = {(r.phenotype, r.field_id) for r in study.matches.select("phenotype", "field_id").distinct().collect()}
    assert set(store.finished()) == requested  # those without events too

    def not_again(*args, **kwargs):
        raise AssertionError("extracted again")

    monkeypatch.setattr("phenolith.operators.extract.extract_all", not_again)
    extract_phenotypes(study, store=store, testing=False)


def test_field_filter_and_test_mode(spark, study):
    ev = extract_phenotypes(study, ["renal_decline"], fields=[41202, 99999], testing=True)
    assert {r.field_id for r in ev.select("field_id").distinct().collect()} == {41202}
    with pytest.raises(ValueError):
        extract_phenotypes(study, refresh=True, testing=True)


def test_deletes(spark, study, all_events):
    store = fresh(spark)
    store.append(study.events())
    n_field = sum(1 for r in all_events if r[1] == "renal_decline" and r[2] == 41204)
    assert store.delete("renal_decline", 41204) == n_field
    before, after = store.delete_phenotype("renal_decline")
    assert before == len(all_events) - n_field
    assert after == sum(1 for r in all_events if r[1] != "renal_decline")
    assert all(p != "renal_decline" for p, _ in store.partitions())


def test_wide_csv_to_long(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("eid,31-0.0,20002-0.1,22000,34-1.2\n1,0,,7,1950\n2,,1105,,\n")
    long = L.wide_to_long(L.read_wide_csv(spark, str(path)))
    got = sorted(tuple(r) for r in long.collect())
    assert got == [(1, 31, 0, 0, "0"), (1, 34, 1, 2, "1950"), (1, 22000, 0, 0, "7"), (2, 20002, 0, 1, "1105")]
    out = str(tmp_path / "long")
    L.write_long(long, out)
    assert {r.field for r in spark.read.parquet(out).select("field").distinct().collect()} == {31, 34, 22000, 20002}


def test_field_names():
    assert L.parse_field_name("123-1.0") == (123, 1, 0)
    assert L.parse_field_name("22000") == (22000, 0, 0)
    assert L.parse_field_name("20002-0.31") == (20002, 0, 31)


def test_tsv_loader(spark, tmp_path):
    p = tmp_path / "hesin.txt"
    p.write_text("eid\tdsource\tins_index\tepistart\tepiend\tadmidate\tdisdate\n"
                 "1\tHES\t0\t03/02/2010\t05/02/2010\t\t31/02/2010\n"
                 "\"2\"\tSMR\t1\t\t\t01/01/2011\tbad\n")
    got = sorted(tuple(r) for r in L.read_record_tsv(spark, str(p), "hesin").collect())
    assert got == [(1, 0, d("2010-02-03"), d("2010-02-05"), None, None), (2, 1, None, None, d("2011-01-01"), None)]


def _np_profile(xs, lo, hi):
    a = np.array(xs, dtype=float)
    q = {p: float(np.percentile(a, p)) for p in (10, 20, 30, 40, 50, 60, 70, 80, 90, 25, 75)}
    return q, float(np.std(a)), int((a < lo).sum()), int((a > hi).sum())


def test_describe_values_matches_numpy(spark):
    vals = ["1.5", "2", None, "abc", "inf", "7", "7", "7", "-3.25", "100", "42", "0"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    r = R.describe_values(df, "v", 0.0, 50.0).first()
    finite = [1.5, 2, 7, 7, 7, -3.25, 100, 42, 0]
    q, sd, below, above = _np_profile(finite, 0.0, 50.0)
    assert (r.count_all, r.count_missing, r.count_invalid) == (12, 1, 1)
    assert (r.count_below_min, r.count_above_max) == (below, above)
    for p in (10, 20, 30, 40, 50, 60, 70, 80, 90):
        assert r[f"decile_{p}"] == pytest.approx(q[p], abs=1e-6)
    assert r.median == pytest.approx(q[50], abs=1e-6)
    assert r.IQR == pytest.approx(q[75] - q[25], abs=1e-6)
    assert r.std == pytest.approx(sd, abs=1e-6)
    assert (r.min, r.max) == (-3.25, 100.0)


def test_describe_values_nothing_left(spark):
    df = spark.createDataFrame([(None,), ("x",)], "v string")
    r = R.describe_values(df, "v").first()
    assert (r.count_all, r.count_missing, r.count_invalid) == (2, 1, 1)
    assert r.median is None and r.min is None and r.count_below_min is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60))
def test_exact_ranks_property(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    ranks = list(range(len(xs)))
    got = R.exact_ranks(df, "x", ranks, range_values=4)
    assert [got[k] for k in ranks] == sorted(float(x) for x in xs)


def test_exact_ranks_over_many_ranges(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).cast("double").alias("x"))
    ranks = [0, 1, 749, 1500, 2998, 2999]
    assert R.exact_ranks(df, "x", ranks, range_values=8) == {k: float(k) for k in ranks}


def test_wide_file_of_9000_columns(spark, tmp_path):
    names = [f"{100 + k}-{k % 3}.{k % 5}" for k in range(9000)]
    path = tmp_path / "wide.csv"
    path.write_text(",".join(["eid", *names]) + "\n" + "\n".join(
        ",".join([str(e), *(f"{e}x{k}" if k % 90 == e else "" for k in range(9000))]) for e in range(1, 4)) + "\n")
    began = time.perf_counter()
    long = L.wide_to_long(L.read_wide_csv(spark, str(path)))
    assert time.perf_counter() - began < 10
    got = {tuple(r) for r in long.collect()}
    assert got == {(e, 100 + k, k % 3, k % 5, f"{e}x{k}") for e in range(1, 4) for k in range(9000) if k % 90 == e}


def test_load_files_then_open(spark, study, all_events, tmp_path):
    root, src = str(tmp_path), study.sources
    raw = views.raw_views(spark, SF_SMALL)
    wide = src.baseline.groupBy("eid").pivot("field").agg(F.min("value"))
    wide.write.option("header", True).csv(f"{root}/wide")
    files = {}
    for name in src.as_dict():
        if name == "baseline":
            continue
        files[name] = f"{root}/{name}_file"
        df = raw[f"raw_{name}"]
        if name == "gp_clinical":
            df = df.select(*RECORD_COLUMNS[name])
        L.write_record_tsv(df.withColumn("dsource", F.lit("X")), files[name])
    loaded = L.load_files(spark, f"{root}/wide", files, f"{root}/tables")
    assert "dsource" in loaded.hesin.columns
    again = Study.open(spark, f"{root}/tables").sources
    for name in ("hesin_diag", "death", "gp_clinical", "gp_registrations"):
        columns = [c for c in src.as_dict()[name].columns]
        assert sorted(map(str, again.as_dict()[name].select(*columns).collect())) == sorted(map(str, src.as_dict()[name].collect()))
    assert "Join" not in again.gp_clinical._jdf.queryExecution().executedPlan().toString()
    records = [r for r in all_events if r[2] in (41202, 41204, 41200, 41210, 40001, 40002, 42040)]
    got = Study.open(spark, f"{root}/tables").events().where(F.col("field_id").isin(41202, 41204, 41200, 41210, 40001, 40002, 42040))
    assert sorted(tuple(r) for r in got.collect()) == records
    in_buckets = L.load_files(spark, f"{root}/wide", files, f"{root}/buckets", buckets=4)
    assert set(in_buckets.families) == {"hospital", "deaths"} and not os.path.exists(f"{root}/buckets/hesin")
    for name in ("hesin", "hesin_diag", "hesin_oper", "death", "death_cause"):
        assert sorted(map(str, getattr(in_buckets, name).collect())) == sorted(map(str, getattr(loaded, name).collect()))
    with pytest.raises(ValueError, match="no file for death"):
        L.load_files(spark, f"{root}/wide", {k: v for k, v in files.items() if k != "death"}, f"{root}/other")


def test_build_tables_stage_by_stage(spark, study):
    from phenolith.operators import cohort as CO
    from phenolith.plans.pipeline import build_tables

    t = build_tables(study, scratch_path(spark, "run"))
    cohort = study.cohort()
    want = CO.cohort_phenotype_first(cohort, study.first_events(cohort=cohort))
    assert sorted(map(tuple, t.cohort_phenotype_first.collect())) == sorted(map(tuple, want.collect()))
    assert t.phenotypes.count() == study.events().count()


def test_profile_of_many_columns_matches_numpy_and_the_single_profile(spark):
    rng = np.random.default_rng(5)
    n = 400
    table = {"a b": rng.normal(size=n), "ties": rng.integers(0, 3, n).astype(float), "same": np.full(n, 7.0), "big": rng.normal(size=n) * 1e200}
    odd = [None, "x", "nan", "inf", "", " 12 "]
    data = [(*(float(v[i]) for v in table.values()), odd[i % len(odd)] if i % 3 else str(i), None, "text", i if i % 5 else None) for i in range(n)]
    df = spark.createDataFrame(data, "`a b` double, ties double, same double, big double, odd string, empty double, words string, whole int")
    columns = [*df.columns, "odd"]
    limits = {"a b": (-0.5, None), "ties": (1.0, 1.0), "words": (0.0, 1.0), "odd": (None, 50.0)}
    cells = R.column_cells(df, columns)
    for range_values in (R.RANGE_VALUES, 37, 1):
        got = {r.variable: r for r in R.describe_cells(cells, limits, range_values).collect()}
        assert sorted(got) == sorted(df.columns)
        for c in df.columns:
            if " " in c:
                continue
            one = R.describe_values(df, c, *limits.get(c, (None, None))).first()
            assert {k: got[c][k] for k in one.asDict()} == pytest.approx(one.asDict(), nan_ok=True), c
        for c, xs in table.items():
            assert [got[c][f"decile_{p}"] for p in R.R6_PERCENTILES] == pytest.approx(np.percentile(xs, R.R6_PERCENTILES), abs=1e-5)
            assert got[c]["median"] == pytest.approx(np.median(xs), abs=1e-5)
    assert R.describe_columns(df.limit(0), columns).count() == 0


def test_profile_of_a_long_table(spark):
    """The long survey table is profiled by field, however many fields there are."""
    long = spark.range(3000).select((F.col("id") % 300).alias("field"), F.col("id").cast("string").alias("value"))
    cells = long.select(F.col("field").cast("string").alias("variable"), F.lit(False).alias("missing"), F.col("value").cast("double").alias("x"))
    rows = {int(r.variable): r for r in R.describe_cells(cells).collect()}
    assert len(rows) == 300
    for f in (0, 7, 299):
        xs = np.arange(f, 3000, 300)
        assert rows[f].median == np.median(xs) and rows[f].decile_10 == pytest.approx(np.percentile(xs, 10)) and rows[f].count_all == 10
