"""Tables in buckets of their key: joins without a shuffle, hot and NULL keys apart, the same rows."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from phenolith.operators import cohort as CO
from phenolith.operators import events as EV
from phenolith.operators import extract as XT
from phenolith.plans.pipeline import Study, build_tables
from phenolith.session import scratch_path
from phenolith.sources import bucketed
from phenolith.sources.bucketed import BucketedTables
from phenolith.sources.records import Sources
from conftest import SF_SMALL

HOSPITAL_AND_DEATHS = (41202, 41204, 41200, 41210, 40001, 40002)


@pytest.fixture(scope="module")
def study(spark):
    return Study.fixture(spark, SF_SMALL)


@pytest.fixture()
def no_automatic_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    """Exchanges that move rows, not broadcasts."""
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|RoundRobin|Single)", plan(df)))


def bag(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def events(sources, study):
    return XT.extract_hospital(sources, study.matches).unionByName(XT.extract_death(sources, study.matches))


def test_joins_of_bucketed_tables_do_not_shuffle(spark, study, no_automatic_broadcasts):
    root = scratch_path(spark, "tables")
    study.sources.store(root, buckets=4)
    stored = Sources.open(spark, root)
    hits = XT.value_hits(stored, study.matches)
    (hesin, diag, oper), _ = stored.parts("hospital")
    fields = XT.HOSPITAL_DIAG_FIELDS + XT.HOSPITAL_OPER_FIELDS
    found = XT._hospital_events(hesin, diag, oper, fields, hits, apart=True)
    assert plan(found).count("SortMergeJoin") == 2 and shuffles(found) == 0
    plain = XT._hospital_events(spark.read.parquet(f"{root}/hospital/hesin"), diag, oper, fields, hits, apart=True)
    assert shuffles(plain) > 0  # what the buckets save
    (death, cause), _ = stored.parts("deaths")
    found = XT._death_events(death, cause, XT.DEATH_FIELDS, hits)
    assert "SortMergeJoin" in plan(found) and shuffles(found) == 0  # the count of deaths neither


@pytest.mark.parametrize("least", [0, bucketed.HOT_ROWS])
def test_events_from_bucketed_tables(spark, study, least, monkeypatch):
    """With ``least`` 0, keys of more than a fair bucket are hot, as they are on large tables."""
    monkeypatch.setattr(bucketed.hot_keys, "__defaults__", (least,))
    monkeypatch.setattr(BucketedTables.write, "__defaults__", (least,))
    root = scratch_path(spark, "tables")
    hot_eid = study.sources.hesin_diag.agg(F.min("eid")).first()[0]
    copies = F.when(F.col("eid") == hot_eid, 400).otherwise(1)
    heavy = study.sources.hesin_diag.withColumn("_c", F.explode(F.sequence(F.lit(1), copies))).drop("_c")
    Sources(**{**study.sources.as_dict(), "hesin_diag": heavy}).store(root, buckets=64)
    stored = Sources.open(spark, root)
    assert bag(stored.hesin_diag.select(*heavy.columns)) == bag(heavy)
    apart = stored.families["hospital"].apart("hesin_diag")
    assert (apart.where(F.col("eid") == hot_eid).count() > 0) == (least == 0)
    want = bag(events(Sources(**{**study.sources.as_dict(), "hesin_diag": heavy}), study))
    assert bag(events(stored, study)) == want


def test_another_session_opens_the_tables(spark, study):
    root = scratch_path(spark, "tables")
    study.sources.store(root, buckets=4)
    opened = Sources.open(spark, root)
    want = bag(opened.hesin)
    for family in opened.families.values():  # a session that has not seen them
        for name in ("hesin", "hesin_diag", "hesin_oper", "death", "death_cause"):
            spark.sql(f"DROP TABLE IF EXISTS {family._identifier(name)}")
    again = Sources.open(spark, root)
    assert again.families["hospital"].buckets == 4 and again.families["hospital"].keys == ("eid", "ins_index")
    assert bag(again.hesin) == want == bag(study.sources.hesin.select(*again.hesin.columns))


def test_null_keys_odd_names_and_empty_tables(spark):
    left = spark.createDataFrame([(1, 1, "a"), (None, 1, "b"), (2, None, "c"), (1, 1, "a")], "k long, j long, `od.d``name` string")
    right = spark.createDataFrame([], "k long, j long, v string")
    tables = BucketedTables(spark, scratch_path(spark, "odd"), ["k", "j"], 3)
    tables.write({"l": left, "r": right}, least=0)
    for name in ("l", "r"):
        spark.sql(f"DROP TABLE {tables._identifier(name)}")
    assert bag(tables.whole("l")) == bag(left) and tables.whole("l").columns == left.columns
    assert tables.whole("r").count() == 0
    joined = [a.join(b, ["k", "j"], "left") for a, b in tables.parts("l", "r")]
    assert sum(j.count() for j in joined) == 4
    assert {r.k for r in tables.apart("l").collect()} >= {None, 2}


def test_hot_keys_are_fewer_than_buckets(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert bucketed.hot_keys(rows, ["k"], 8, least=0).count() == 0  # 100 rows each, a fair bucket has 125
    assert bucketed.hot_keys(rows, ["k"], 16, least=0).count() == 10
    assert bucketed.hot_keys(rows, ["k"], 16, least=100).count() == 0
    third = rows.unionByName(spark.range(500).select(F.lit(3).cast("long").alias("k")))
    assert [r.k for r in bucketed.hot_keys(third, ["k"], 8, least=0).collect()] == [3]


def test_people_in_buckets(spark, study, no_automatic_broadcasts):
    root = scratch_path(spark, "run")
    t = build_tables(study, root, buckets=4)
    cohort = study.cohort()
    want = CO.cohort_phenotype_first(cohort, study.first_events(cohort=cohort))
    assert bag(t.cohort_phenotype_first) == bag(want)
    people = BucketedTables.open(spark, f"{root}/people")
    first = EV.label_first(people.bucketed("earliest"), t.baseline_cohort)
    merged = CO.cohort_phenotype_first(t.baseline_cohort, t.phenotype_first)
    assert "SortMergeJoin" in plan(first) and shuffles(first) == 0
    assert "SortMergeJoin" in plan(merged) and shuffles(merged) == 0
    again = build_tables(study, root, buckets=4)  # over the tables of the run before
    assert bag(again.cohort_phenotype_first) == bag(want)
