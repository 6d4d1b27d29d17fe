"""End-to-end plans: definitions + record tables -> events -> first events -> cohort.

``Study`` bundles what every query needs (the record tables and the code tables of a definition
directory); the functions below chain the operators the way the reference's command-line steps do,
but each step is one lazily-built DataFrame plan that Catalyst optimises as a whole.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolith.operators import codes as K
from phenolith.operators import cohort as CO
from phenolith.operators import events as EV
from phenolith.operators import extract as XT
from phenolith.session import scratch_path
from phenolith.sources.bucketed import BucketedTables
from phenolith.sources.first_store import FirstEventStore
from phenolith.sources.records import Sources, fixture_sources
from phenolith.sources.store import EventStore


@dataclass
class Study:
    spark: SparkSession
    sources: Sources
    catalogue: DataFrame
    codes: DataFrame
    matches: DataFrame
    _info: K.MatchInfo | None = None
    _stored_catalogue: DataFrame | None = None

    @property
    def stored_catalogue(self) -> DataFrame:
        """The catalogue as a table in the shared scratch folder (written once). Selections that prune the event store are made
        from it: Spark drops dynamic pruning at run time where the selection comes from a cached DataFrame."""
        if self._stored_catalogue is None:
            path = scratch_path(self.spark, "catalogue")
            self.catalogue.write.parquet(path)
            self._stored_catalogue = self.spark.read.parquet(path)
        return self._stored_catalogue

    @property
    def info(self) -> K.MatchInfo:
        """Driver-side facts about the match table (one small aggregate, computed once)."""
        if self._info is None:
            self._info = K.match_info(self.matches)
        return self._info

    @classmethod
    def load(cls, spark: SparkSession, sources: Sources, definitions: str = K.DEFAULT_DEFINITIONS) -> "Study":
        catalogue = K.load_catalogue(spark, definitions).cache()
        codes = K.code_table(catalogue)
        matches = K.match_table(codes).cache()  # bounded by the definition corpus
        return cls(spark, sources, catalogue, codes, matches)

    @classmethod
    def open(cls, spark: SparkSession, root: str, definitions: str = K.DEFAULT_DEFINITIONS) -> "Study":
        """A study over the tables that a load (``records.load_files``) stored below ``root``."""
        return cls.load(spark, Sources.open(spark, root), definitions)

    @classmethod
    def fixture(cls, spark: SparkSession, sf_dir: str, definitions: str = K.DEFAULT_DEFINITIONS) -> "Study":
        return cls.load(spark, fixture_sources(spark, sf_dir), definitions)

    # ---- derived tables --------------------------------------------------------------------------
    def events(self, phenotypes: Iterable[str] | None = None, fields: Iterable[int] | None = None) -> DataFrame:
        """The ``phenotypes`` table for the requested definitions (all by default)."""
        return XT.extract_all(self.sources, self.matches, phenotypes, fields, info=self.info)

    def cohort(self, **kw) -> DataFrame:
        """F4-F9."""
        return CO.baseline_cohort(self.sources, **kw)

    def first_events(self, events: DataFrame | None = None, cohort: DataFrame | None = None,
                     compat: bool = False) -> DataFrame:
        """F1-F3."""
        return EV.first_events(self.events() if events is None else events,
                               self.cohort() if cohort is None else cohort, compat=compat)


def extract_phenotypes(study: Study, phenotypes: Iterable[str] | None = None, fields: Iterable[int] | None = None,
                       store: EventStore | None = None, refresh: bool = False, testing: bool = True) -> DataFrame | None:
    """X17 + X18: extract definitions into the event store, or return the rows in test mode.

    * unknown names raise (C2); complex definitions, SNOMED and prescription fields are skipped;
    * ``fields`` keeps only those fields (a field a definition does not define yields nothing);
    * without ``refresh`` a (phenotype, field) is skipped that the store records as finished **with the same codes** (a mark of
      the content of its slice of the match table); if that leaves none, no job runs. A pair whose codes, types or date rule
      changed is extracted again, and one that its definition lists no longer is dropped. With ``refresh`` all are extracted
      again. The old events give way, in one version of the store, after the new ones are written (:meth:`EventStore.replace`);
    * ``testing`` writes nothing and returns the rows; test mode with refresh is rejected (Q12)."""
    if testing and refresh:
        raise ValueError("refresh needs a store; test mode never writes")
    m = study.matches
    if phenotypes is not None:
        names = list(phenotypes)
        K.require_phenotypes(study.spark, study.catalogue, names)
        m = m.where(F.col("phenotype").isin(*names))
    wanted = None if fields is None else {int(f) for f in fields}
    if wanted is not None:
        m = m.where(F.col("field_id").isin(*wanted))
    if testing:
        return XT.extract_all(study.sources, m, info=study.info)
    if store is None:
        raise ValueError("a store is needed outside test mode")
    marks = K.slice_marks(m)
    finished = store.finished()
    todo = {p: mark for p, mark in marks.items() if refresh or finished.get(p) != mark}
    # a definition that was asked for and has lost a field
    asked = set(names) if phenotypes is not None else {r.variable_name for r in study.catalogue.select("variable_name").collect()}
    stale = [p for p in finished if p not in marks and p[0] in asked and (wanted is None or p[1] in wanted)]
    if todo or stale:
        pairs = study.spark.createDataFrame(sorted(todo), "phenotype string, field_id int")
        left = m.join(pairs, ["phenotype", "field_id"], "left_semi").cache()
        # facts of what is left, so that only its fields are read; both are bounded by the definitions
        store.replace(XT.extract_all(study.sources, left, info=K.match_info(left)), todo, drop=stale)
        left.unpersist()
    return None


@dataclass
class Tables:
    """The derived tables of one run, each read back from where it was written."""

    phenotypes: DataFrame
    baseline_cohort: DataFrame
    phenotype_first: DataFrame
    cohort_phenotype_first: DataFrame


def build_tables(study: Study, root: str, refresh: bool = False, compat: bool = False, buckets: int | None = None) -> Tables:
    """The whole workflow, stage by stage, each stage written to ``root`` (shared storage, e.g. below the
    session's checkpoint directory) and read back: events (incremental store, X17/X18), cohort (F4-F9),
    first events (F1-F3, from their stored state, which a later run updates for the pairs that changed only),
    cohort x first events (F10). Writing each stage cuts
    the lineage, so a lost executor costs a stage, not the whole chain. With ``buckets`` the tables of people are written in that
    many buckets by eid (each person has a bounded number of rows in them): cohort and earliest dates are shuffled once, when
    they are written, and neither F1 nor F10 shuffles."""
    root = root.rstrip("/")
    store = EventStore(study.spark, f"{root}/phenotypes")
    extract_phenotypes(study, store=store, refresh=refresh, testing=False)
    events = store.read()

    spark = study.spark
    state = FirstEventStore(spark, f"{root}/earliest")
    state.update(store)
    if buckets:
        people = BucketedTables(spark, f"{root}/people", ["eid"], buckets)
        cohort = people.write_bounded("baseline_cohort", study.cohort())
        earliest = people.write_bounded("earliest", state.read())
        first = people.write_bounded("phenotype_first", EV.label_first(earliest, cohort, compat))
    else:
        study.cohort().write.mode("overwrite").parquet(f"{root}/baseline_cohort")
        cohort = spark.read.parquet(f"{root}/baseline_cohort")
        state.first_events(cohort, compat=compat).write.mode("overwrite").parquet(f"{root}/phenotype_first")
        first = spark.read.parquet(f"{root}/phenotype_first")

    CO.cohort_phenotype_first(cohort, first).write.mode("overwrite").parquet(f"{root}/cohort_phenotype_first")
    merged = spark.read.parquet(f"{root}/cohort_phenotype_first")
    return Tables(events, cohort, first, merged)
