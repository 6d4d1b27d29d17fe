"""Reports on phenotypes, cohorts and columns (R1-R6), all as DataFrames.

R6's percentiles are exact (numpy's linear interpolation) but never gather a column into one task:
values are counted per distinct value, the distinct values are cut into value ranges (as many as their number
asks for) with a quantile sketch, per-range counts tell which ranges hold a requested rank, only those are
sorted, and only the handful of rows that hold a requested rank come back to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenolith import config as C
from phenolith.functions import exprs as X
from phenolith.operators.events import events_of_selection

R6_PERCENTILES = (10, 20, 30, 40, 50, 60, 70, 80, 90)
R6_COLUMNS = ("count_all", "count_missing", "count_invalid", "min", "max", "count_below_min", "count_above_max",
              *(f"decile_{p}" for p in R6_PERCENTILES), "median", "std", "IQR")
ROUND_DIGITS = 6
#: Distinct values in a range that one task of R6 sorts, about.
RANGE_VALUES = 500_000


# ----------------------------------------------------------------------------------------------
# Phenotype reports
# ----------------------------------------------------------------------------------------------

def count_people(events: DataFrame, first: DataFrame, phenotype: str) -> DataFrame:
    """Distinct people with the phenotype in the events and in the first events (exact), from one
    aggregation over both tables."""
    both = (events.where(F.col("phenotype") == phenotype).select("eid", F.lit(0).alias("t"))
            .unionByName(first.where(F.col("phenotype") == phenotype).select("eid", F.lit(1).alias("t"))))
    return both.agg(F.count_distinct(F.when(F.col("t") == 0, F.col("eid"))).alias("n_phenotypes"),
                    F.count_distinct(F.when(F.col("t") == 1, F.col("eid"))).alias("n_phenotype_first"))


def report_by_field(events: DataFrame, lkp_fields: DataFrame, phenotype: str) -> DataFrame:
    """R2: people and events per field, with the field title (inner join to the ten-row lookup)."""
    e = events.where(F.col("phenotype") == phenotype)
    return (e.join(lkp_fields, "field_id", "inner")
            .groupBy("field_id", "title")
            .agg(F.count_distinct("eid").alias("num_patients"), F.count(F.lit(1)).alias("num_events")))


def report_by_category(events: DataFrame, phenotype: str, compat: bool = False) -> DataFrame:
    """People and events per source category (``compat``: labels by the list with 41240 for 41210)."""
    e = events.where(F.col("phenotype") == phenotype)
    return (e.withColumn("field_id_label", X.source_label(F.col("field_id"), compat))
            .groupBy("field_id_label")
            .agg(F.count_distinct("eid").alias("num_patients"), F.count(F.lit(1)).alias("num_events")))


def report_of_selection(events: DataFrame, selection: DataFrame, compat: bool = False) -> DataFrame:
    """R3 for every definition of a catalogue selection (C9-C11) that has events: people and events per source category."""
    return (events_of_selection(events, selection).withColumn("field_id_label", X.source_label(F.col("field_id"), compat))
            .groupBy("phenotype", "field_id_label")
            .agg(F.count_distinct("eid").alias("num_patients"), F.count(F.lit(1)).alias("num_events")))


# ----------------------------------------------------------------------------------------------
# Cohort description
# ----------------------------------------------------------------------------------------------

def recode_cohort(cohort: DataFrame, eids: DataFrame | None = None) -> DataFrame:
    """Friendly names; -3 -> NULL for smoking and alcohol; ethnicity -> its first digit with the
    negative codes -> NULL (Q11); codes -> labels."""
    df = cohort if eids is None else cohort.join(eids.select("eid").distinct(), "eid", "left_semi")
    df = df.withColumnsRenamed({k: v for k, v in C.COHORT_NICENAMES.items() if k in df.columns})
    for c in ("smoking", "alcohol"):
        df = df.withColumn(c, F.when(F.col(c) != C.PREFER_NOT_TO_ANSWER, F.col(c)))
    df = df.withColumn("ethnic", F.when(~F.col("ethnic").startswith("-"), F.substring("ethnic", 1, 1)))
    for c, mapping in C.COHORT_VALUE_LABELS.items():
        m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        df = df.withColumn(c, F.coalesce(m[F.col(c)], F.col(c)))
    return df


def table_one(recoded: DataFrame, columns: Iterable[str] = C.TABLE_ONE_COLUMNS,
              categorical: Iterable[str] = C.TABLE_ONE_CATEGORICAL, group: str = "sex") -> DataFrame:
    """R5: "Table 1" by group plus an ``Overall`` group, as a long table
    (grp, variable, level, n, missing, mean, sd, pct). Numeric columns: n, missing, mean, sample SD;
    categorical columns (and the grouping column itself): count and % of non-missing per level.

    Numeric statistics and all missing counts come from one wide ``rollup`` over the cohort (each person
    read once; the rollup's grand total is the Overall group); only the categorical columns are
    unpivoted to count their levels. The aggregated rows (a few per variable) are reshaped at the end."""
    columns = list(columns)
    categorical = set(categorical) | {group}
    numeric = [c for c in columns if c not in categorical]
    cats = [c for c in columns if c in categorical]
    base = recoded.select(F.coalesce(F.col(group).cast("string"), F.lit("missing")).alias("grp"),
                          *[F.col(c).cast("string").alias(c) for c in columns])

    def x(c):
        return X.try_cast(F.col(c), "double")

    wide = base.rollup("grp").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(x(c)).alias(f"{c}__n") for c in numeric],
        *[F.sum(F.when(x(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"{c}__miss") for c in numeric],
        *[F.avg(x(c)).alias(f"{c}__mean") for c in numeric],
        *[F.stddev_samp(x(c)).alias(f"{c}__sd") for c in numeric],
        *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"{c}__miss") for c in cats],
    ).withColumn("grp", F.coalesce("grp", F.lit("Overall")))  # grp is never NULL before the rollup

    no_d, no_s, no_b = F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(None).cast("bigint")
    rows = [F.struct(F.lit("n").alias("variable"), no_s.alias("level"), F.col("_n").alias("n"),
                     no_b.alias("missing"), no_d.alias("mean"), no_d.alias("sd"))]
    rows += [F.struct(F.lit(c).alias("variable"), no_s.alias("level"), F.col(f"{c}__n").alias("n"),
                      F.col(f"{c}__miss").alias("missing"),
                      F.round(F.col(f"{c}__mean"), ROUND_DIGITS).alias("mean"),
                      F.round(F.col(f"{c}__sd"), ROUND_DIGITS).alias("sd")) for c in numeric]
    summary = wide.select("grp", F.inline(F.array(*rows))).withColumn("pct", no_d)

    missing = wide.select("grp", F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"{c}__miss").alias("missing")) for c in cats])))
    stack = base.select("grp", F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).alias("level")) for c in cats]))).where(F.col("level").isNotNull())
    levels = (stack.rollup("variable", "level", "grp").agg(F.count(F.lit(1)).alias("n"),
                                                            F.grouping_id().alias("_g"))
              .where(F.col("_g") <= 1)  # (variable, level, grp) and (variable, level) = Overall
              .withColumn("grp", F.when(F.col("_g") == 1, F.lit("Overall")).otherwise(F.col("grp"))).drop("_g"))
    w = Window.partitionBy("grp", "variable")  # over the aggregated levels: a few rows per window
    levels = levels.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(w), ROUND_DIGITS))
    cat_rows = levels.join(missing, ["grp", "variable"], "left").select(
        "grp", "variable", "level", "n", "missing", no_d.alias("mean"), no_d.alias("sd"), "pct")
    return summary.select("grp", "variable", "level", "n", "missing", "mean", "sd", "pct").unionByName(cat_rows)


# ----------------------------------------------------------------------------------------------
# Column profile
# ----------------------------------------------------------------------------------------------

def _lerp(a: float, b: float, t: float) -> float:
    # numpy's linear interpolation, including its rearrangement for t >= 0.5
    d = b - a
    return b - d * (1 - t) if t >= 0.5 else a + d * t


def exact_ranks(values: DataFrame, col: str, ranks: Iterable[int], range_values: int = RANGE_VALUES) -> dict[int, float]:
    """Value at each 0-based rank of the sorted (finite, non-NULL) column ``col``, computed distributed:
    (1) count per distinct value, (2) cut the distinct values into ranges of about ``range_values`` with an
    approximate quantile sketch and a JVM bucketizer, (3) count each range, which tells the few ranges that
    hold a requested rank, (4) sort only those and keep the rows whose rank interval holds such a rank."""
    from pyspark.ml.feature import Bucketizer

    ranks = sorted(set(int(r) for r in ranks))
    if not ranks:
        return {}
    vc = values.groupBy(F.col(col).alias("x")).agg(F.count(F.lit(1)).alias("c")).persist(StorageLevel.MEMORY_AND_DISK)
    n_ranges = max(1, math.ceil(vc.count() / range_values))
    cuts = vc.approxQuantile("x", [i / n_ranges for i in range(1, n_ranges)], 0.25 / n_ranges) if n_ranges > 1 else []
    splits = [-math.inf] + sorted(set(c for c in cuts if c is not None and math.isfinite(c))) + [math.inf]
    if len(splits) == 2:
        splits.insert(1, 0.0)  # a bucketizer needs two ranges
    b = Bucketizer(splits=splits, inputCol="x", outputCol="r").transform(vc)
    before, offsets = 0, {}
    for r in sorted(b.groupBy("r").agg(F.sum("c").alias("t")).collect(), key=lambda r: r.r):  # one row a range
        if any(before <= k < before + r.t for k in ranks):
            offsets[float(r.r)] = before
        before += r.t
    if not offsets:
        return {}
    offset = F.create_map(*[F.lit(v) for kv in offsets.items() for v in kv])[F.col("r")]
    w = Window.partitionBy("r").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = b.where(F.col("r").isin(*offsets)).withColumn("end", offset + F.sum("c").over(w))
    start = F.col("end") - F.col("c")
    hits = ranked.select("x", F.explode(F.filter(F.array(*[F.lit(r) for r in ranks]),
                                                 lambda k: (k >= start) & (k < F.col("end")))).alias("k"))
    found = {int(r.k): float(r.x) for r in hits.collect()}  # at most len(ranks) rows
    vc.unpersist()
    return found


def describe_values(df: DataFrame, col: str, minimum: float | None = None, maximum: float | None = None) -> DataFrame:
    """Count, missing, invalid (not numeric), min, max, below/above limits, nine deciles, median,
    population SD and IQR of one column; non-finite values are dropped first; when nothing is left all
    statistics but the counts are NULL. Rounded to six decimals."""
    spark = df.sparkSession
    raw = F.col(col)
    is_num_type = dict(df.dtypes)[col] in ("double", "float", "int", "bigint", "smallint", "tinyint") \
        or dict(df.dtypes)[col].startswith("decimal")
    # the column is read by three passes (statistics, value counts, ranks): keep it after the first
    df = df.select(raw.alias(col)).persist(StorageLevel.MEMORY_AND_DISK)
    raw = F.col(col)
    missing = raw.isNull() | (F.isnan(raw) if is_num_type else F.lit(False))
    x = X.try_cast(raw, "double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))
    fx = F.when(finite, x)
    stats = df.agg(
        F.count(F.lit(1)).alias("count_all"),
        F.sum(F.when(missing, 1).otherwise(0)).cast("bigint").alias("count_missing"),
        F.sum(F.when(~missing & (x.isNull() | F.isnan(x)), 1).otherwise(0)).cast("bigint").alias("count_invalid"),
        F.count(fx).alias("n"),
        F.min(fx).alias("min"), F.max(fx).alias("max"),
        F.sum(F.when(fx < F.lit(minimum), 1).otherwise(0)).cast("bigint").alias("count_below_min")
        if minimum is not None else F.lit(None).cast("bigint").alias("count_below_min"),
        F.sum(F.when(fx > F.lit(maximum), 1).otherwise(0)).cast("bigint").alias("count_above_max")
        if maximum is not None else F.lit(None).cast("bigint").alias("count_above_max"),
        F.stddev_pop(fx).alias("std"),
    ).first()  # one row
    n = int(stats.n)
    out = {k: stats[k] for k in ("count_all", "count_missing", "count_invalid", "count_below_min", "count_above_max")}
    out["count_all"] = int(out["count_all"] or 0)
    nulls = {k: None for k in R6_COLUMNS if k not in out}
    if n == 0:
        out.update(nulls)
        out["count_below_min"] = out["count_above_max"] = None
    else:
        wanted = (*R6_PERCENTILES, 25, 75)
        pos = {p: p / 100 * (n - 1) for p in wanted}
        ranks = {int(math.floor(v)) for v in pos.values()} | {min(int(math.floor(v)) + 1, n - 1) for v in pos.values()}
        vals = exact_ranks(df.select(fx.alias("_x")).where(F.col("_x").isNotNull()), "_x", ranks)

        def pct(p):
            lo = int(math.floor(pos[p]))
            hi = min(lo + 1, n - 1)
            return _lerp(vals[lo], vals[hi], pos[p] - lo)

        for p in R6_PERCENTILES:
            out[f"decile_{p}"] = pct(p)
        out["median"] = pct(50)
        out["IQR"] = pct(75) - pct(25)
        out["min"], out["max"], out["std"] = stats["min"], stats["max"], stats["std"]
    df.unpersist()
    row = []
    for k in R6_COLUMNS:
        v = out[k]
        if k.startswith("count"):
            row.append(None if v is None else int(v))
        else:
            row.append(None if v is None else round(float(v), ROUND_DIGITS))
    schema = ", ".join(f"{k} {'bigint' if k.startswith('count') else 'double'}" for k in R6_COLUMNS)
    return spark.createDataFrame([tuple(row)], schema)


def column_cells(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """variable, missing, x: one row for each row of ``df`` and column; ``x`` is the number, NULL where there is none. A name
    listed twice counts once."""
    types = dict(df.dtypes)
    cells = []
    for c in dict.fromkeys(columns):
        raw = F.col(f"`{c}`")
        is_num = types[c].startswith("decimal") or types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint")
        missing = raw.isNull() | F.isnan(raw) if is_num else raw.isNull()
        cells.append(F.struct(F.lit(c).alias("variable"), missing.alias("missing"), X.try_cast(raw, "double").alias("x")))
    return df.select(F.inline(F.array(*cells)))


def _ranks_of_all(values: DataFrame, ranks: Mapping[str, set[int]], range_values: int) -> dict[tuple[str, int], float]:
    """Value at each wanted 0-based rank of each variable's numbers. ``values`` (variable, x) is counted per distinct value
    once, for all variables; the distinct values are range-partitioned by (variable, value), each variable's part of a range is
    counted, and only the parts that hold a wanted rank (at most one a rank) are sorted."""
    counted = values.groupBy("variable", "x").agg(F.count(F.lit(1)).alias("c")).persist(StorageLevel.MEMORY_AND_DISK)
    n_ranges = math.ceil(counted.count() / range_values)
    if n_ranges > 1:
        # stored with its range, as another run may cut the ranges elsewhere
        ranged = (counted.repartitionByRange(n_ranges, "variable", "x").withColumn("r", F.spark_partition_id())
                  .persist(StorageLevel.MEMORY_AND_DISK))
    else:
        ranged = counted.withColumn("r", F.lit(0))
    before: dict[str, int] = {}
    parts = []
    # one row a variable and range it reaches into
    for p in sorted(ranged.groupBy("variable", "r").agg(F.sum("c").alias("t")).collect(), key=lambda p: (p.variable, p.r)):
        start = before.get(p.variable, 0)
        before[p.variable] = start + p.t
        inside = sorted(k for k in ranks[p.variable] if start <= k < start + p.t)
        if inside:
            parts.append((p.variable, p.r, start, inside))
    found = {}
    if parts:
        wanted = values.sparkSession.createDataFrame(parts, "variable string, r int, start bigint, ranks array<bigint>")
        w = Window.partitionBy("variable", "r").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = ranged.join(F.broadcast(wanted), ["variable", "r"]).withColumn("end", F.col("start") + F.sum("c").over(w))
        hits = ranked.select("variable", "x", F.explode(F.filter(
            "ranks", lambda k: (k >= F.col("end") - F.col("c")) & (k < F.col("end")))).alias("k"))
        found = {(h.variable, h.k): h.x for h in hits.collect()}  # one row a wanted rank
    if n_ranges > 1:
        ranged.unpersist()
    counted.unpersist()
    return found


def describe_cells(cells: DataFrame, limits: Mapping[str, tuple[float | None, float | None]] | None = None,
                   range_values: int = RANGE_VALUES) -> DataFrame:
    """R6 of many variables at once, one row each (``variable`` and the columns of :func:`describe_values`), from rows
    (variable, missing, x) such as :func:`column_cells` makes of a wide table, or the long survey table with its field as
    variable. The jobs are as many for 9,000 variables as for one: statistics, counts per distinct value, counts per range,
    ranks. ``limits``: (minimum, maximum) of a variable, each or both None. A variable without rows gives no row; one without
    finite numbers its three counts. The driver gets a few rows a variable."""
    limits = dict(limits or {})

    def limit(side: int) -> F.Column:
        known = {v: float(pair[side]) for v, pair in limits.items() if pair[side] is not None}
        if not known:
            return F.lit(None).cast("double")
        return F.create_map(*[F.lit(e) for kv in known.items() for e in kv])[F.col("variable")]

    x = F.col("x")
    is_finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))
    finite = F.when(is_finite, x)
    count = lambda condition: F.count(F.when(condition, 1))
    stats = {s.variable: s for s in cells.groupBy("variable").agg(
        F.count(F.lit(1)).alias("count_all"), count(F.col("missing")).alias("count_missing"),
        count(~F.col("missing") & (x.isNull() | F.isnan(x))).alias("count_invalid"), F.count(finite).alias("n"),
        F.min(finite).alias("min"), F.max(finite).alias("max"), count(finite < limit(0)).alias("count_below_min"),
        count(finite > limit(1)).alias("count_above_max"), F.stddev_pop(finite).alias("std")).collect()}
    places = {v: {p: p / 100 * (s.n - 1) for p in (*R6_PERCENTILES, 25, 75)} for v, s in stats.items() if s.n}
    ranks = {v: {r for place in at.values() for r in (math.floor(place), min(math.floor(place) + 1, stats[v].n - 1))}
             for v, at in places.items()}
    values = _ranks_of_all(cells.where(is_finite).select("variable", "x"), ranks, range_values) if ranks else {}

    def row(v: str) -> tuple:
        s, at = stats[v], places.get(v)
        out = {"count_all": s.count_all, "count_missing": s.count_missing, "count_invalid": s.count_invalid}
        if at:
            def percentile(p: int) -> float:
                low = math.floor(at[p])
                return _lerp(values[v, low], values[v, min(low + 1, s.n - 1)], at[p] - low)

            low, high = limits.get(v, (None, None))
            out |= {"count_below_min": None if low is None else s.count_below_min,
                    "count_above_max": None if high is None else s.count_above_max, "min": s["min"], "max": s["max"], "std": s["std"],
                    **{f"decile_{p}": percentile(p) for p in R6_PERCENTILES}, "median": percentile(50),
                    "IQR": percentile(75) - percentile(25)}
        return (v, *(out.get(k) if k.startswith("count") or out.get(k) is None else round(out[k], ROUND_DIGITS) for k in R6_COLUMNS))

    schema = "variable string, " + ", ".join(f"{k} {'bigint' if k.startswith('count') else 'double'}" for k in R6_COLUMNS)
    return cells.sparkSession.createDataFrame([row(v) for v in sorted(stats)], schema)


def describe_columns(df: DataFrame, columns: Iterable[str],
                     limits: Mapping[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """R6 of several columns of a table at once (see :func:`describe_cells`)."""
    return describe_cells(column_cells(df, columns), limits)
