"""Tables bucketed by a common key, so that joins by it need no shuffle.

The tables of a family lie below one folder, all cut into the same number of buckets by the same key, one file a bucket; a join by
the key reads bucket beside bucket. Spark knows the buckets of catalogue tables only, so each folder is declared in the session's
catalogue as an external table; ``spec`` (a row written with the family) says how, for later sessions.

A bucket is read by one task, so a key that holds a large share of the rows must not lie in one: keys with more rows than a fair
bucket of any table of the family (and more than ``HOT_ROWS``) are *hot*. There are fewer of them than buckets for each table, so their
list may be broadcast. All rows of a hot key, and those with NULL in the key, go to a plain folder beside the table
whose joins are ordinary ones. As the list is the same for all tables of a family, a row and its partners are always on
the same side: :meth:`parts` gives the two sides, and a join is the union of the joins of both.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys of fewer rows than this are never hot.
HOT_ROWS = 100_000
#: Cells that keys are dealt to by their hash when hot ones are looked for.
CELLS = 1 << 16


def hot_keys(table: DataFrame, keys: Sequence[str], buckets: int, least: int = HOT_ROWS) -> DataFrame:
    """The keys (without NULLs) with more than ``least`` rows and more than a fair bucket has: fewer than ``buckets``.

    Keys may be as many as rows, so cells of keys are counted first, combined before the shuffle. A hot key makes its cell hot, and
    fewer cells than ``buckets`` are: only their keys are counted one by one, mostly none."""
    cell = F.pmod(F.xxhash64(*keys), F.lit(CELLS))
    cells = table.groupBy(cell.alias("_cell")).agg(F.count("*").alias("_n"))
    largest = F.slice(F.sort_array(F.collect_list(F.struct("_n", "_cell")), asc=False), 1, buckets)
    rows, largest = cells.agg(F.coalesce(F.sum("_n"), F.lit(0)), largest).first()
    hot = [r["_cell"] for r in largest if r["_n"] > least and r["_n"] * buckets > rows]
    if not hot:
        return table.sparkSession.createDataFrame([], table.select(*keys).schema)
    counted = table.where(cell.isin(*hot)).select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("_n"))
    return counted.where((F.col("_n") > least) & (F.col("_n") * buckets > rows)).select(*keys)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


class BucketedTables:
    """A family of tables below ``root``; :meth:`open` finds what an earlier session wrote."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int | None = None):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), tuple(keys)
        self.buckets = int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "BucketedTables":
        spec = spark.read.parquet(f"{root}/spec").first()
        return cls(spark, root, spec["keys"], spec["buckets"])

    @staticmethod
    def exists(spark: SparkSession, root: str) -> bool:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/spec/_SUCCESS")
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def _identifier(self, name: str) -> str:
        return f"phenolith_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}_{name}"

    def _write_buckets(self, name: str, df: DataFrame) -> None:
        """One file a bucket: the shuffle of ``repartition`` deals rows as ``bucketBy`` does, and falls away where the rows
        come from a join of tables of this family."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._identifier(name)}")
        # an empty table has no file to tell its columns
        self.spark.createDataFrame([(df.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/{name}_schema")
        (df.repartition(self.buckets, *self.keys).write.format("parquet").mode("overwrite").bucketBy(self.buckets, *self.keys)
         .sortBy(*self.keys).option("path", f"{self.root}/{name}").saveAsTable(self._identifier(name)))

    def _write_spec(self) -> None:
        self.spark.createDataFrame([(list(self.keys), self.buckets)], "keys array<string>, buckets int").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.root}/spec")

    def write_bounded(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table of which each key has a bounded number of rows (one row a person, or one for each person and
        definition): nothing is hot, so all of it is bucketed. Returns the table."""
        self._write_buckets(name, df)
        self._write_spec()
        return self.bucketed(name)

    def write(self, tables: Mapping[str, DataFrame], least: int = HOT_ROWS) -> None:
        """Write the tables of a family together, rows of hot keys and of NULL keys apart. Each table is read three times
        (keys, then the rows of either side): give tables that are stored."""
        found = None
        for df in tables.values():
            hot = hot_keys(df, self.keys, self.buckets, least)
            found = hot if found is None else found.unionByName(hot)
        found.distinct().coalesce(1).write.mode("overwrite").parquet(f"{self.root}/hot")
        hot = F.broadcast(self.spark.read.parquet(f"{self.root}/hot").withColumn("_hot", F.lit(True)))
        null_key = F.lit(False)
        for k in self.keys:
            null_key = null_key | F.col(k).isNull()
        for name, df in tables.items():
            apart = F.col("_hot").isNotNull() | null_key
            marked = df.join(hot, list(self.keys), "left")
            columns = [F.col(_quoted(c)) for c in df.columns]
            self._write_buckets(name, marked.where(~apart).select(*columns))
            marked.where(apart).select(*columns).write.mode("overwrite").parquet(f"{self.root}/{name}_apart")
        self._write_spec()

    def bucketed(self, name: str) -> DataFrame:
        """The bucketed side of a table, declared in the session's catalogue if it is not yet."""
        table, path = self._identifier(name), f"{self.root}/{name}"
        if not self.spark.catalog.tableExists(table):
            schema = T.StructType.fromJson(json.loads(self.spark.read.parquet(f"{path}_schema").first()["schema"]))
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
            keys = ", ".join(map(_quoted, self.keys))
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(table)

    def apart(self, name: str) -> DataFrame:
        """The rows of hot and of NULL keys."""
        return self.spark.read.schema(self.bucketed(name).schema).parquet(f"{self.root}/{name}_apart")

    def parts(self, *names: str) -> list[tuple[DataFrame, ...]]:
        """The two sides of the tables: partners by the key are on the same side."""
        return [tuple(map(self.bucketed, names)), tuple(map(self.apart, names))]

    def whole(self, name: str) -> DataFrame:
        return self.bucketed(name).unionByName(self.apart(name))
