"""What is shuffled and how often inputs are made: records without a hit stay where they are, joined tables are read once."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from phenolith.operators import codes as K
from phenolith.operators import extract as XT
from phenolith.plans.pipeline import Study
from phenolith.session import scratch_path
from phenolith.sources import bucketed
from phenolith.sources.records import Sources
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def study(spark):
    return Study.fixture(spark, SF_SMALL)


def bag(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def shuffled(node) -> list[int]:
    """Records of each exchange of an adaptive plan that has run."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return shuffled(node.executedPlan())
    if name.endswith("QueryStage"):
        return shuffled(node.plan())
    own = [node.metrics().apply("shuffleRecordsWritten").value()] if node.metrics().contains("shuffleRecordsWritten") else []
    return own + [n for i in range(node.children().size()) for n in shuffled(node.children().apply(i))]


def test_records_without_a_hit_are_not_shuffled(spark, study):
    """Hospital records come from a join here; only those that start with a code may go through it."""
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = XT.extract_hospital(study.sources, study.matches, info=study.info)
        assert len(events.collect()) > 0
        index = study.sources.coded_values().where(K.may_match(study.info))
        assert len(index.collect()) > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for df in (events, index):
        found = shuffled(df._jdf.queryExecution().executedPlan())
        assert found and max(found) < lines / 2, found


def test_the_condition_keeps_every_match(spark, monkeypatch):
    matches = spark.createDataFrame(
        [("p", 41202, "any", c, "prefix", len(c), None, None) for c in ("E1", "I10", "\U0001D49CB", "SS")]
        + [("q", 41204, "any", "K9", "prefix", 2, None, None), ("r", 42040, "any", "C10..", "exact", 5, None, None)],
        "phenotype string, field_id int, type string, code string, match string, code_len int, qual_type string, qual_field int")
    values = spark.createDataFrame(
        [(f, v) for f in (41202, 41204) for v in ("e119", "E1", "E", "", None, "i100", "I1", "\U0001D49Cb7", "ß1", "k90", "C10..")],
        "field_id int, field_value string")
    info = K.match_info(matches)
    want = bag(K.match_values(values, matches, info))
    kept = values.where(K.may_match(info))
    assert bag(K.match_values(kept, matches, info)) == want
    assert {tuple(r) for r in kept.collect()} == {(41202, v) for v in ("e119", "E1", "i100", "\U0001D49Cb7", "ß1")} | {(41204, "k90")}
    monkeypatch.setattr(K, "LISTED_PREFIXES", 4)
    many = K.match_info(matches)
    assert many.prefix_codes is None and values.where(K.may_match(many)).count() == values.count()
    none = K.match_info(matches.where(F.col("match") == "exact"))
    assert values.where(K.may_match(none)).count() == 0


def test_appended_events_share_the_matched_values(spark, monkeypatch):
    made, value_hits = [], XT.value_hits
    monkeypatch.setattr(XT, "value_hits", lambda *a, **kw: made.append(1) or value_hits(*a, **kw))
    assert entry.queries()["l8_append_events"](spark, SF_SMALL).count() > 0
    assert len(made) == 1


def test_a_store_in_buckets_makes_each_row_once(spark, study):
    made = spark.sparkContext.accumulator(0)

    def counted(value):
        made.add(1)
        return value

    diag = study.sources.hesin_diag
    want = bag(diag)
    once = replace(study.sources, hesin_diag=diag.withColumn("diag_icd10", F.udf(counted, "string")("diag_icd10")))
    root = scratch_path(spark, "tables")
    once.store(root, buckets=4)
    assert made.value == sum(want.values())
    stored = Sources.open(spark, root)
    assert bag(stored.hesin_diag.select(*diag.columns)) == want
    assert bag(stored.values) == bag(study.sources.coded_values())


def test_keys_are_counted_only_in_hot_cells(spark, monkeypatch):
    distinct = spark.range(3000).select(F.col("id").alias("k"))
    none = bucketed.hot_keys(distinct, ["k"], 4, least=0)
    assert none.columns == ["k"] and none.count() == 0
    assert "Exchange" not in none._jdf.queryExecution().executedPlan().toString()
    rows = distinct.unionByName(spark.range(5000).select(F.lit(7).cast("long").alias("k"))).unionByName(
        spark.range(9000).select(F.lit(None).cast("long").alias("k")))
    for cells in (bucketed.CELLS, 3, 1):  # keys that share a cell are told apart
        monkeypatch.setattr(bucketed, "CELLS", cells)
        assert [r.k for r in bucketed.hot_keys(rows, ["k"], 4, least=100).collect()] == [7]
