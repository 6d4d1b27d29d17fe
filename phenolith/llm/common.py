"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolith.session import scratch_path

#: A word: a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Characters of text handled at once inside a task.
SLICE_CHARS = 4_000_000


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: Spark's own file distribution sends it once per application.
    ``pick`` calls it, with which every operator starts."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        root, name = os.path.split(package)
        out = tempfile.mkdtemp(prefix="package-")
        shutil.copytree(package, os.path.join(out, "src", name), ignore=shutil.ignore_patterns("__pycache__", "*.pyc"))
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(out, name), "zip", os.path.join(out, "src")))
        _SHIPPED.add(app)


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts the lineage, and what was
    computed survives a lost executor. The shuffle files of this one job are dropped as it ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names: extra columns of the input can't clash with ours."""
    ship_package(df.sparkSession)
    return df.select(*[F.col(f"`{c}`").alias(k) for k, c in columns.items()])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(lengths: np.ndarray, limit: int = SLICE_CHARS):
    """Row ranges (lo, hi) whose lengths sum to about ``limit`` at most; a longer row stands alone."""
    if not len(lengths):
        return
    ends = np.cumsum(lengths)
    lo = 0
    while lo < len(lengths):
        start = ends[lo] - lengths[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, start + limit, side="right")))
        yield lo, hi
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def with_row_ids(docs: DataFrame, into: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a long that tells its texts apart: the doc_id where all rows of it have one text, else (and for rows
    without doc_id) a hash of doc_id and text. Rows with the same doc_id and text share it; null and empty texts are equal."""
    own, content = F.col(f"`{doc_id}`"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    differ = docs.where(own.isNotNull()).groupBy(own.alias("__of")).agg(F.min(content).alias("lo"), F.max(content).alias("hi"))
    differ = materialise(differ.where("lo < hi").select("__of"), "repeated-ids")
    if differ.isEmpty():
        return docs.withColumn(into, F.coalesce(own, content).cast("long"))
    hashed = F.xxhash64(F.coalesce(own, F.lit(0)), content)
    found = docs.join(differ, own == F.col("__of"), "left")
    return found.withColumn(into, F.when(own.isNull(), content).when(F.col("__of").isNull(), own).otherwise(hashed).cast("long")).drop("__of")
