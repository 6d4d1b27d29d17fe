"""Plan-shape guards: what the physical plans must (not) contain, checked on the explained plans."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from phenolith import config as C
from phenolith.operators import codes as K
from phenolith.operators import events as EV
from phenolith.operators import extract as XT
from phenolith.plans.pipeline import Study, extract_phenotypes
from phenolith.schemas import RECORD_COLUMNS
from phenolith.session import scratch_path
from phenolith.sources import records as L
from phenolith.sources.records import Sources
from phenolith.sources.store import EventStore
from conftest import SF_SMALL

WRITING = {"l1_wide_csv", "l3_load_hesin", "l3_rejects", *(f"l3_{t}_all_columns" for t in RECORD_COLUMNS), "x18_changed_codes", "l8_append_events", "x18_skip_extracted", "x18_refresh", "e5_delete_phenotype",
           "e6_delete_phenotype_field", "r6_column_profile", "r6_all_columns", "f1_updated_first_events", "x12_bucketed_tables",
           "f10_bucketed_people"}


def plan(df) -> str:
    """The physical plan as text, without expression ids."""
    import re

    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def leaves(node) -> list:
    """The scans of an adaptive plan that has run."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return leaves(node.executedPlan())
    if name.endswith("QueryStage"):
        return leaves(node.plan())
    inner = [node.children().apply(i) for i in range(node.children().size())]
    return [n for child in inner for n in leaves(child)] if inner else [node]


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - WRITING))
def test_no_cross_products(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.fixture(scope="module")
def stored(spark):
    """Record tables stored the way a load leaves them (long table partitioned by field)."""
    s = Study.fixture(spark, SF_SMALL).sources
    root = scratch_path(spark, "records")
    L.write_long(s.baseline, f"{root}/baseline")
    for n, df in s.as_dict().items():
        if n != "baseline":
            df.write.parquet(f"{root}/{n}")
    t = {n: spark.read.parquet(f"{root}/{n}") for n in s.as_dict()}
    L.coded_values(s).write.parquet(f"{root}/values")
    t["values"] = spark.read.parquet(f"{root}/values")
    t["baseline"] = t["baseline"].select("eid", "field", "i", "n", "value")
    return Study.load(spark, Sources(**t))


def test_code_matching_is_broadcast_and_scans_are_pruned(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only the explicit (size-checked) broadcasts
    try:
        p = plan(stored.events())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in p
    # records join matched values and are not expanded: what is, are definitions (in the cached match table) and, after their
    # join, the multiplicities of deaths
    import re

    generated = set(re.findall(r"Generate explode\((\w+)", p))
    assert generated and not generated & {"array", "filter", "transform"}, generated
    assert p.count("Generate explode(array_repeat(") == 1
    # the long table is read only for the fields in use (partition filter on the field folders)
    long_scans = [ln for ln in p.split("\n") if re.search(r"FileScan parquet \[eid,i,n,value,field\]", ln)]
    assert long_scans and all(re.search(r"PartitionFilters: \[[^]]*(field IN \(|\(field#?\d* = 34\))", ln) for ln in long_scans)
    # hospital and death scans push their level filter to the reader
    assert p.count("PushedFilters: [In(level, [1,2])") == 3
    # episodes are read with the four columns the date rule needs
    assert "ReadSchema: struct<eid:bigint,ins_index:bigint,epistart:date,admidate:date>" in p


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_survey_extraction_plans_three_scans_of_the_long_table(spark, stored, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        p = plan(extract_phenotypes(stored, testing=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # those of pruning subqueries count too: the one over the match table needs none
    assert 0 < p.count("FileScan parquet [eid,i,n,value,field]") <= 3


def test_cohort_big_aggregate_is_hash_based(spark, stored):
    p = plan(stored.cohort())
    assert "HashAggregate(keys=[eid" in p
    # the text pivot (sort-based) only sees the 16 cohort fields at visit 0
    import re

    # (16 values: Spark plans the IN list as an INSET, sorted as text)
    assert re.search(r"PartitionFilters: \[field INSET 189, 20116, 20117, 21000", p)


def test_store_queries_read_only_their_folders(spark, stored):
    from phenolith.operators import events as EV

    store = EventStore(spark, scratch_path(spark, "phenotypes"))
    extract_phenotypes(stored, store=store, testing=False)
    p = plan(EV.phenotypes_by_field(store.read(), 41202))
    assert "field_id = 41202)" in p.split("PartitionFilters: [")[1].split("]")[0]
    p = plan(EV.events_by_field(store.read(), [41202, 42040], ["renal_decline"]))
    pushed = p.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "field_id" in pushed and "phenotype" in pushed


def test_first_event_selection_is_hash_aggregated(spark, stored):
    from phenolith.operators import events as EV

    p = plan(EV.phenotype_first(stored.first_events()))
    assert "SortAggregate" not in p.split("Union")[0]


def test_a_catalogue_selection_prunes_folders_at_run_time(spark, stored):
    store = EventStore(spark, scratch_path(spark, "phenotypes"))
    extract_phenotypes(stored, store=store, testing=False)
    renal = EV.events_of_selection(store.read(), K.phenotypes_by_category(stored.stored_catalogue, "Renal"))
    assert "dynamicpruning" in plan(renal)
    folders = {p for p in store.partitions() if p[0] in ("renal_decline", "empty_gp")}
    assert {(r.phenotype, r.field_id) for r in renal.collect()} == folders and len(folders) < len(store.partitions())
    (scan,) = [n for n in leaves(renal._jdf.queryExecution().executedPlan()) if n.metrics().contains("numPartitions")]
    assert scan.metrics().apply("numPartitions").value() == len(folders)


def test_a_few_gp_codes_read_few_rows(spark, stored):
    """Records in code order: a lookup reads the row groups that may hold its codes, whatever share a hot code has."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    n = 200_000
    code = F.when(F.col("id") % 3 == 0, F.lit("hot..")).otherwise(F.concat(F.lit("C"), F.lpad((F.xxhash64("id") % 500 + 500).cast("string"), 4, "0")))
    records = spark.range(n).select((F.col("id") % 997).alias("eid"), F.lit(1).alias("data_provider"), code.alias("read_code"),
                                    F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 3650).cast("int")).alias("eventdate"),
                                    F.col("id").cast("string").alias("value1"), F.lit(None).cast("string").alias("value2"),
                                    F.lit(None).cast("string").alias("value3"))
    path = scratch_path(spark, "gp")
    hadoop.setInt("parquet.block.size", 64 * 1024)
    try:
        L.write_by_code(records, path)
    finally:
        hadoop.unset("parquet.block.size")
    gp = spark.read.parquet(path)
    wanted = ["C0007", "C0700"]

    def rows_read(df) -> int:
        df.collect()
        return sum(x.metrics().apply("numOutputRows").value() for x in leaves(df._jdf.queryExecution().executedPlan())
                   if x.nodeName().startswith("Scan parquet"))

    found = XT.extract_gp_biomarker(replace(stored.sources, gp_clinical=gp), "glucose", wanted[:1], wanted[1:])
    assert rows_read(found) < n / 10
    assert found.count() == records.where(F.col("read_code").isin(*wanted)).count() > 0
    assert gp.count() == n and gp.exceptAll(records).isEmpty()
    matches = stored.matches.where(F.col("field_id") == C.F_GP_CLINICAL).limit(1).withColumn("code", F.lit(wanted[0]))
    diagnoses = XT.extract_primary_care(replace(stored.sources, gp_clinical=gp), matches)
    assert rows_read(diagnoses) < n / 10
    assert diagnoses.count() == records.where(F.col("read_code") == wanted[0]).count()
    none = XT.extract_gp_biomarker(replace(stored.sources, gp_clinical=gp), "glucose", [], [])
    assert none.count() == 0
