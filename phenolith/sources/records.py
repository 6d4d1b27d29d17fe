"""Loading and normalising the record tables.

* L1/L2 - the wide survey file becomes the long ``baseline`` table: the header is parsed once and every
  row generates its non-empty cells (one array, whatever the number of columns);
* L3 - tab-separated record files: cells by header name, '' -> NULL, ``dd/mm/yyyy`` dates, rejected values listed;
* L4/L5 - GP clinical: unified Read code and birth-year date repair;
* L6 - GP registrations: the same date repair on both dates;
* L7 - field lookups on the long table.

The date repairs only touch rows whose year is a birth-year placeholder: those few rows are joined to the
year-of-birth lookup, the rest bypass the join, so the big GP tables are never shuffled for the repair.
"""

from __future__ import annotations

import re

from dataclasses import dataclass, fields as dc_fields, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from phenolith import config as C
from phenolith.functions import exprs as X
from phenolith.schemas import RECORD_COLUMNS, RECORD_DATE_COLUMNS, RECORD_INT_COLUMNS
from phenolith.session import scratch_path
from phenolith.sources import delimited, views
from phenolith.sources.bucketed import BucketedTables


@dataclass
class Sources:
    """The record tables one extraction reads."""

    baseline: DataFrame
    hesin: DataFrame
    hesin_diag: DataFrame
    hesin_oper: DataFrame
    death: DataFrame
    death_cause: DataFrame
    gp_clinical: DataFrame
    gp_registrations: DataFrame
    gp_prescriptions: DataFrame
    #: Index of the distinct (field_id, field_value) of the fields whose codes are matched by prefix; a load stores it.
    values: DataFrame | None = None
    #: The tables of a family in :data:`FAMILIES`, where they are stored in buckets of its key.
    families: dict[str, BucketedTables] | None = None

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in dc_fields(self) if f.name not in ("values", "families")}

    def parts(self, family: str) -> list[tuple[DataFrame, ...]]:
        """The tables of a family, in parts that can be joined by its key one by one."""
        _, names = FAMILIES[family]
        if self.families is None:
            return [tuple(getattr(self, n) for n in names)]
        return self.families[family].parts(*names)

    def coded_values(self) -> DataFrame:
        """The value index: the stored one, or made from the records."""
        return coded_values(self) if self.values is None else self.values

    def store(self, root: str, buckets: int | None = None) -> None:
        """Write every table as Parquet below ``root``, the long table partitioned by field; with ``buckets``, the tables of
        :data:`FAMILIES` in that many buckets of their key (first in the scratch folder: they are read several times, and may come
        from joins). The value index is made from the tables as stored."""
        spark = self.baseline.sparkSession
        stored = {}
        if buckets:
            for name in _IN_FAMILIES:
                stored[name] = _staged(getattr(self, name), name)
            _store_families(replace(self, **stored), root, buckets)
        for name, df in self.as_dict().items():
            if buckets and name in _IN_FAMILIES:
                continue
            if name == "baseline":
                write_long(df, f"{root}/{name}")
            elif name == "gp_clinical":
                write_by_code(df, f"{root}/{name}")
            else:
                df.write.mode("overwrite").parquet(f"{root}/{name}")
            if name in _WITH_VALUES:
                stored[name] = spark.read.parquet(f"{root}/{name}").select(*df.columns)
        _store_values(replace(self, **stored), root)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "Sources":
        """The tables that :meth:`store` left below ``root``."""
        families = {f: BucketedTables.open(spark, f"{root}/{f}") for f in FAMILIES if BucketedTables.exists(spark, f"{root}/{f}")}
        tables = {n: families[f].whole(n) for f in families for n in FAMILIES[f][1]}
        for f in dc_fields(cls):  # values too
            if f.name != "families" and f.name not in tables:
                tables[f.name] = spark.read.parquet(f"{root}/{f.name}")
        tables["baseline"] = tables["baseline"].select("eid", "field", "i", "n", "value")
        return cls(**tables, families=families or None)


#: Tables that extraction joins with each other, and the key they are joined by.
FAMILIES = {"hospital": (("eid", "ins_index"), ("hesin", "hesin_diag", "hesin_oper")), "deaths": (("eid",), ("death", "death_cause"))}
_IN_FAMILIES = {name for _, names in FAMILIES.values() for name in names}
#: Tables with values that are matched by prefix (:func:`coded_values`).
_WITH_VALUES = {"baseline", "hesin_diag", "hesin_oper", "death_cause"}


def _staged(table: DataFrame, name: str) -> DataFrame:
    path = scratch_path(table.sparkSession, f"staged-{name}")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _store_families(sources: Sources, root: str, buckets: int) -> None:
    for family, (keys, names) in FAMILIES.items():
        tables = BucketedTables(sources.baseline.sparkSession, f"{root}/{family}", keys, buckets)
        tables.write({n: getattr(sources, n) for n in names})


def coded_values(sources: Sources) -> DataFrame:
    """field_id, field_value: the distinct values of all prefix-matched fields, duplicates combined before the shuffle. As many
    rows as the records use codes, however many records there are."""

    def by_level(df: DataFrame, fields: tuple[int, int], value: str) -> DataFrame:
        field = F.when(F.col("level") == 1, F.lit(fields[0])).when(F.col("level") == 2, F.lit(fields[1]))
        return df.where(F.col("level").isin(1, 2)).select(field.alias("field_id"), F.col(value).alias("field_value"))

    registry = sources.baseline.where(F.col("field") == C.F_CANCER_REGISTRY)
    parts = [by_level(sources.hesin_diag, (C.F_HOSP_DIAG_MAIN, C.F_HOSP_DIAG_SEC), "diag_icd10"),
             by_level(sources.hesin_oper, (C.F_HOSP_OPER_MAIN, C.F_HOSP_OPER_SEC), "oper4"),
             by_level(sources.death_cause, (C.F_DEATH_PRIMARY, C.F_DEATH_SECONDARY), "cause_icd10"),
             registry.select(F.lit(C.F_CANCER_REGISTRY).alias("field_id"), F.col("value").alias("field_value"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where(F.col("field_value").isNotNull()).distinct()


def _store_values(sources: Sources, root: str) -> None:
    coded_values(sources).write.mode("overwrite").parquet(f"{root}/values")


# ----------------------------------------------------------------------------------------------
# L1 / L2: wide -> long
# ----------------------------------------------------------------------------------------------

FIELD_NAME_RE = r"^(\d+)(?:-(\d+)(?:\.(\d+))?)?"


def parse_field_name(name: str) -> tuple[int, int, int]:
    """L2: (field, visit, slot) of a header name, ``field[-visit[.slot]]``; what is not there is 0."""
    found = re.match(FIELD_NAME_RE, name)
    if found is None:
        raise ValueError(f"{name!r} is not a field name")
    return tuple(int(part or 0) for part in found.groups())


def wide_to_long(wide: DataFrame, id_col: str = "eid") -> DataFrame:
    """L1: one row per non-empty cell of the wide file: (eid, field, i, n, value).

    The header is parsed once (L2 on the column list). Each row becomes one array of its values, whose
    non-empty cells are generated with their position; the position finds field, i and n in three constant
    arrays. All four are SQL texts, so that building the plan takes no call per column: files have thousands."""
    columns = [c for c in wide.columns if c != id_col]
    if not columns:
        return wide.sparkSession.createDataFrame([], "eid long, field int, i int, n int, value string")
    quoted = ("`" + c.replace("`", "``") + "`" for c in columns)
    values = F.expr("array(" + ", ".join(f"cast({c} as string)" for c in quoted) + ")")
    ids = zip(("field", "i", "n"), zip(*(parse_field_name(c) for c in columns)))
    cells = (wide.select(F.col(f"`{id_col}`").cast("bigint").alias("eid"), F.posexplode(values).alias("pos", "value"))
             .where(F.col("value").isNotNull() & (F.col("value") != "")))
    return cells.select("eid", *[F.expr(f"array({', '.join(map(str, part))})")[F.col("pos")].alias(name) for name, part in ids],
                        "value")


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """The wide file as text columns (header decides the schema; nothing is inferred)."""
    return (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
            .option("quote", '"').option("escape", '"').option("multiLine", True).csv(path))


def wide_csv_to_long(spark: SparkSession, path: str, id_col: str = "eid") -> DataFrame:
    """L1 from the file itself: lines become cells (see ``delimited``), cells get their field, visit and slot by joining the
    header dictionary (L2) on their position. The plan has as many nodes for 9,000 columns as for nine. Rows whose eid is
    no integer, and cells beyond the header, are not loaded: :func:`wide_rejects` lists them."""
    line, names = delimited.header(spark, path, ",")
    at = names.index(id_col)
    fields = [(k, *parse_field_name(c)) for k, c in enumerate(names) if k != at]
    dictionary = spark.createDataFrame(fields, "pos int, field int, i int, n int")  # one row per column of the header
    records = delimited.read_records(spark, path, ",", skip=line)
    cells = records.select(X.try_cast(F.get("cells", F.lit(at)), "bigint").alias("eid"), F.posexplode("cells").alias("pos", "value"))
    return cells.where(F.col("eid").isNotNull() & (F.col("value") != "")).join(F.broadcast(dictionary), "pos").select(
        "eid", "field", "i", "n", "value")


def wide_rejects(spark: SparkSession, path: str, id_col: str = "eid") -> DataFrame:
    """file, line, column, value, reason of what :func:`wide_csv_to_long` does not load."""
    line, names = delimited.header(spark, path, ",")
    records = delimited.read_records(spark, path, ",", skip=line)
    eid = F.get("cells", F.lit(names.index(id_col)))
    found = F.array(
        F.when(X.try_cast(eid, "bigint").isNull(), _reject(id_col, eid, "not an integer")),
        F.when(F.size("cells") > len(names), _reject(None, F.array_join(F.slice("cells", len(names) + 1, F.size("cells")), ","), "beyond the header")))
    return _reject_rows(records.withColumn("_rejects", F.filter(found, lambda x: x.isNotNull())), spark, path)


def write_wide_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """The wide file as quoted CSV text, compressed."""
    _csv_writer(df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])).option("compression", compression).csv(path)


def _csv_writer(df: DataFrame):
    return (df.write.mode("overwrite").option("quote", '"').option("escape", '"').option("header", True)
            .option("emptyValue", "").option("nullValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_long(long: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long table partitioned by field: every lookup of one field reads one folder."""
    # rebalance by field: few files per field folder, and AQE splits a field holding most of the rows
    long.hint("rebalance", "field").write.mode(mode).partitionBy("field").parquet(path)


def write_by_code(records: DataFrame, path: str) -> None:
    """GP records ordered by Read code over all files, with Bloom filters: a query for a few codes skips the row groups without
    them. Ranges are cut by person and date too, so a code that holds most rows is spread over tasks."""
    (records.repartitionByRange("read_code", "eid", "eventdate").sortWithinPartitions("read_code", "eid", "eventdate")
     .write.mode("overwrite").option("parquet.bloom.filter.enabled#read_code", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path))


# ----------------------------------------------------------------------------------------------
# L3: tab-separated record files
# ----------------------------------------------------------------------------------------------

def _reject(column: str | None, value: Column, reason: str) -> Column:
    return F.struct(F.lit(column).cast("string").alias("column"), value.alias("value"), F.lit(reason).alias("reason"))


def _reject_rows(records: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """file, line, column, value, reason of the records' ``_rejects``."""
    bad = records.where(F.size("_rejects") > 0).select("file", "block", "id", F.explode("_rejects").alias("r"))
    return delimited.line_numbers(bad, spark, path).select("file", "line", "r.column", "r.value", "r.reason")


def _typed_records(spark: SparkSession, path: str, table: str, every_column: bool) -> tuple[DataFrame, list[str]]:
    """The records of a file with one column per field and ``_rejects``: what was turned to NULL, or does not fit the header."""
    line, names = delimited.header(spark, path, "\t")
    if absent := [c for c in RECORD_COLUMNS[table] if c not in names]:
        raise ValueError(f"{table} file without the column(s) {', '.join(absent)}")
    columns, rejects = [], []
    for c in RECORD_COLUMNS[table]:
        raw = F.nullif(F.get("cells", F.lit(names.index(c))), F.lit(""))
        if c in RECORD_DATE_COLUMNS.get(table, ()):
            value, reason = X.uk_date(raw), "not a date"
        elif c == "eid" or c in RECORD_INT_COLUMNS.get(table, ()):
            value, reason = X.try_cast(raw, "bigint" if c in ("eid", "ins_index") else "int"), "not an integer"
        else:
            columns.append(raw.alias(c))
            continue
        columns.append(value.alias(c))
        rejects.append(F.when(raw.isNotNull() & value.isNull(), _reject(c, raw, reason)))
    if every_column:
        columns += [F.nullif(F.get("cells", F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(names) if c not in RECORD_COLUMNS[table]]
    n = len(names)
    rejects.append(F.when(F.size("cells") > n, _reject(None, F.array_join(F.slice("cells", n + 1, F.size("cells")), "\t"), "beyond the header")))
    rejects.append(F.when(F.size("cells") < n, _reject(None, F.size("cells").cast("string"), "fewer cells than the header")))
    records = delimited.read_records(spark, path, "\t", skip=line)
    kept = [c for c in names if every_column and c not in RECORD_COLUMNS[table]]
    return records.select("file", "block", "id", *columns, F.filter(F.array(*rejects), lambda x: x.isNotNull()).alias("_rejects")), [
        *RECORD_COLUMNS[table], *kept]


def read_record_tsv(spark: SparkSession, path: str, table: str, every_column: bool = False) -> DataFrame:
    """L3: quoted, tab-separated, header skipped; cells are found by the names in the header, then typed with try_* ('' and
    bad values -> NULL; :func:`record_rejects` lists the bad ones). Record files carry many more columns than are used;
    with ``every_column`` these follow as text. A used column that the header lacks is an error."""
    records, columns = _typed_records(spark, path, table, every_column)
    return records.select(*[F.col(f"`{c}`") for c in columns])


def record_rejects(spark: SparkSession, path: str, table: str) -> DataFrame:
    """file, line, column, value, reason of each value of a record file that L3 turns to NULL, and of each record with more or
    fewer cells than the header."""
    return _reject_rows(_typed_records(spark, path, table, False)[0], spark, path)


def write_record_tsv(df: DataFrame, path: str) -> None:
    """Write a record table the way the record files come: tab-separated, quoted, dd/mm/yyyy dates."""
    cols = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        cols.append((F.date_format(c, "dd/MM/yyyy") if dtype == "date" else c.cast("string")).alias(name))
    _csv_writer(df.select(*cols)).option("sep", "\t").csv(path)


# ----------------------------------------------------------------------------------------------
# Field lookups on the long table
# ----------------------------------------------------------------------------------------------

def field_at(baseline: DataFrame, field: int, i: int = 0, n: int = 0, name: str = "value") -> DataFrame:
    """(eid, value) of one field at one (visit, slot)."""
    return (baseline.where((F.col("field") == field) & (F.col("i") == i) & (F.col("n") == n))
            .select("eid", F.col("value").alias(name)))


def fields_at(baseline: DataFrame, fields: dict[int, str], i: int = 0, n: int = 0) -> DataFrame:
    """L7 for several fields at once: one scan, one aggregation, one row per eid (values as columns).
    Duplicated (eid, field, i, n) keys resolve to the smallest value, deterministically."""
    b = baseline.where(F.col("field").isin(*fields) & (F.col("i") == i) & (F.col("n") == n))
    return b.groupBy("eid").agg(*[F.min(F.when(F.col("field") == f, F.col("value"))).alias(a)
                                   for f, a in fields.items()])


def field_same_slot(records: DataFrame, baseline: DataFrame, field: int, name: str = "q_value") -> DataFrame:
    """Left-join each record (eid, i, n) to the value of ``field`` at the same (visit, slot)."""
    q = baseline.where(F.col("field") == field).select("eid", "i", "n", F.col("value").alias(name))
    return records.join(q, ["eid", "i", "n"], "left")


def year_of_birth(baseline: DataFrame) -> DataFrame:
    return field_at(baseline, C.F_YOB, name="yob")


# ----------------------------------------------------------------------------------------------
# GP normalisation
# ----------------------------------------------------------------------------------------------

def repair_birth_year_dates(df: DataFrame, date_cols: list[str], yob: DataFrame) -> DataFrame:
    """A date in 1902 or 1903 means "in the year of birth" -> July 1st of the year of birth.

    Only rows carrying such a date are joined to ``yob`` (eid, yob); all other rows bypass the join."""
    flagged = F.lit(False)
    for c in date_cols:
        flagged = flagged | F.coalesce(F.year(c).isin(*C.GP_BIRTH_YEAR_CODES), F.lit(False))
    fix = df.where(flagged).join(yob, "eid", "left")
    y = X.try_cast(F.col("yob"), "int")
    fixed_cols = []
    for name in df.columns:
        if name in date_cols:
            c = F.col(name)
            fixed_cols.append(
                F.when(F.year(c).isin(*C.GP_BIRTH_YEAR_CODES) & y.between(1, 9999), F.make_date(y, F.lit(7), F.lit(1)))
                .otherwise(c).alias(name))
        else:
            fixed_cols.append(F.col(name))
    return df.where(~flagged).unionByName(fix.select(*fixed_cols))


def normalise_gp_clinical(raw: DataFrame, baseline: DataFrame) -> DataFrame:
    """L4 + L5: read_code derived, event date repaired; columns as the gp_clinical table."""
    df = raw.select(
        "eid", "data_provider", F.col("event_dt").alias("eventdate"), "read_2", "read_3",
        "value1", "value2", "value3", X.unified_read_code(F.col("read_2"), F.col("read_3")).alias("read_code"),
        *[F.col(f"`{c}`") for c in raw.columns if c not in RECORD_COLUMNS["gp_clinical"]],
    )
    return repair_birth_year_dates(df, ["eventdate"], year_of_birth(baseline))


def normalise_gp_registrations(raw: DataFrame, baseline: DataFrame) -> DataFrame:
    """The same repair on reg_date and deduct_date."""
    return repair_birth_year_dates(raw, ["reg_date", "deduct_date"], year_of_birth(baseline))


REJECTS = "table string, file string, line long, column string, value string, reason string"


def load_table(spark: SparkSession, path: str, table: str, root: str, baseline: DataFrame, every_column: bool = True,
               staged: str | None = None) -> int:
    """One record file -> ``root/<table>`` (or ``staged``), typed and repaired; returns how many values were rejected. These are counted in the
    pass that writes the table, and listed below ``root/rejects`` by a second pass only where there are some."""
    records, columns = _typed_records(spark, path, table, every_column)
    seen = Observation(f"load {table}")
    typed = records.observe(seen, F.sum(F.size("_rejects")).alias("rejected")).select(*[F.col(f"`{c}`") for c in columns])
    repair = {"gp_clinical": normalise_gp_clinical, "gp_registrations": normalise_gp_registrations}.get(table)
    target = (staged or f"{root}/{table}") if repair is None else scratch_path(spark, f"typed-{table}")
    typed.write.mode("overwrite").parquet(target)
    if repair is not None:  # the repair reads its input twice: the file is parsed once
        repaired = repair(spark.read.schema(typed.schema).parquet(target), baseline)
        if table == "gp_clinical":
            write_by_code(repaired, f"{root}/{table}")
        else:
            repaired.write.mode("overwrite").parquet(f"{root}/{table}")
    rejected = int(seen.get["rejected"] or 0)
    if rejected:
        record_rejects(spark, path, table).write.mode("overwrite").parquet(f"{root}/rejects/table={table}")
    return rejected


def load_files(spark: SparkSession, wide: str, files: dict[str, str], root: str, every_column: bool = True,
               buckets: int | None = None) -> Sources:
    """The load: the wide survey file and the eight record files (``files``: table -> path) become typed and repaired Parquet
    tables below ``root``, once; :meth:`Sources.open` reads them from then on, :func:`rejects` what was not loaded. With
    ``buckets``, the tables of :data:`FAMILIES` are stored in that many buckets of their key (typed first in the scratch folder)."""
    if absent := sorted(RECORD_COLUMNS.keys() - files.keys()):
        raise ValueError(f"no file for {', '.join(absent)}")
    write_long(wide_csv_to_long(spark, wide), f"{root}/baseline")
    wide_rejects(spark, wide).write.mode("overwrite").parquet(f"{root}/rejects/table=baseline")
    baseline = spark.read.parquet(f"{root}/baseline").select("eid", "field", "i", "n", "value")
    paths = {t: scratch_path(spark, f"typed-{t}") if buckets and t in _IN_FAMILIES else f"{root}/{t}" for t in RECORD_COLUMNS}
    for table, path in paths.items():
        load_table(spark, files[table], table, root, baseline, every_column, staged=path)
    stored = Sources(baseline=baseline, **{t: spark.read.parquet(path) for t, path in paths.items()})
    if buckets:
        _store_families(stored, root, buckets)
    _store_values(stored, root)
    return Sources.open(spark, root)


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """table, file, line, column, value, reason of everything a load (:func:`load_files`) left out or turned to NULL."""
    return spark.read.schema(REJECTS).parquet(f"{root}/rejects").select("table", "file", "line", "column", "value", "reason")


# ----------------------------------------------------------------------------------------------
# Fixture sources
# ----------------------------------------------------------------------------------------------

def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """All record tables derived from the test tables in ``sf_dir``, normalised like a load would."""
    raw = views.raw_views(spark, sf_dir)
    baseline = raw["raw_baseline"]
    return Sources(
        baseline=baseline,
        hesin=raw["raw_hesin"],
        hesin_diag=raw["raw_hesin_diag"],
        hesin_oper=raw["raw_hesin_oper"],
        death=raw["raw_death"],
        death_cause=raw["raw_death_cause"],
        gp_clinical=normalise_gp_clinical(raw["raw_gp_clinical"], baseline),
        gp_registrations=normalise_gp_registrations(raw["raw_gp_registrations"], baseline),
        gp_prescriptions=raw["raw_gp_prescriptions"],
    )
