"""The ``phenotypes`` event store (L8, X18, E5, E6): immutable Parquet folders and a manifest for each version.

Rows lie in ``data/commit=<id>/field_id=<n>/phenotype=<name>``; a folder is written once and never changed. A manifest
(``_versions/<number>.json``, as large as the definition catalogue) lists the folders of each (phenotype, field) and the
pairs whose extraction is finished. Every change writes its rows first and then makes the next manifest appear by one
rename that fails if that version exists: until then readers and later runs see the old rows, from then on the new ones, and
of two writers that started from the same version the second is refused. ``read`` pins its DataFrame to one version, whose
folders stay until ``vacuum`` removes what kept versions don't list.

The layout stands in for an index on (phenotype, field, date): a query for one phenotype or field reads only its folders,
"what is extracted" is read from the manifest, and deleting a pair rewrites no data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from phenolith.schemas import PHENOTYPES

PARTITION_COLUMNS = ("field_id", "phenotype")
Pair = tuple[str, int]


class ConflictingWrite(RuntimeError):
    """Another writer made the next version first; nothing was changed."""


class EventStore:
    #: Columns of a row; the partition columns among them.
    SCHEMA = PHENOTYPES

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- Hadoop file-system access (works for any scheme the cluster is configured for) --
    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    @property
    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _escape(self, v) -> str:
        return self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(v))

    def _unescape(self, v: str) -> str:
        return self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(v)

    # -- versions ----------------------------------------------------------------------------------
    def versions(self) -> list[int]:
        found = self._fs.globStatus(self._path("_versions", "*.json")) or []
        return sorted(int(st.getPath().getName().split(".")[0]) for st in found)

    def manifest(self, version: int | None = None) -> dict:
        """version, folders ("field/phenotype" -> commits) and finished ("field/phenotype" -> mark) of a version, the
        latest by default; a store without versions is empty."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return {"version": 0, "folders": {}, "finished": {}}
        stream = self._fs.open(self._path("_versions", f"{version:012d}.json"))
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _commit(self, base: dict, folders: dict, finished: dict) -> int:
        """Makes the version after ``base``: its manifest appears whole, or not at all."""
        jvm, version = self.spark.sparkContext._jvm, base["version"] + 1
        draft, final = self._path("_versions", f"_draft-{uuid.uuid4().hex}"), self._path("_versions", f"{version:012d}.json")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps({"version": version, "folders": folders, "finished": finished}).encode()))
        finally:
            stream.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE  # an existing target is an error
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(draft, final, options)
        except Exception as e:
            if self._fs.exists(final):
                raise ConflictingWrite(f"version {version} of {self.path} was written by another run") from e
            raise
        finally:
            self._fs.delete(draft, False)
        return version

    @staticmethod
    def _key(pair: Pair) -> str:
        return f"{int(pair[1])}/{pair[0]}"

    @staticmethod
    def _pair(key: str) -> Pair:
        field_id, phenotype = key.split("/", 1)
        return phenotype, int(field_id)

    def _write(self, events: DataFrame) -> tuple[str, list[str]]:
        """A new commit folder with ``events``, and the keys it holds."""
        commit = uuid.uuid4().hex
        # rebalance (not repartition): rows of one (field, phenotype) are grouped for few files per folder,
        # while AQE splits a hot group over several tasks instead of sending it to one
        (events.select(*self.SCHEMA.names).hint("rebalance", *PARTITION_COLUMNS)
         .write.partitionBy(*PARTITION_COLUMNS).parquet(f"{self.path}/data/commit={commit}"))
        keys = []
        for st in self._fs.globStatus(self._path("data", f"commit={commit}", "field_id=*", "phenotype=*")) or []:
            field_id, phenotype = (p.getName().split("=", 1)[1] for p in (st.getPath().getParent(), st.getPath()))
            keys.append(self._key((self._unescape(phenotype), int(field_id))))
        return commit, keys

    # -- L8: sink and reader -----------------------------------------------------------------------
    def append(self, events: DataFrame) -> None:
        """Append events; files are laid out per (field_id, phenotype)."""
        base = self.manifest()
        commit, keys = self._write(events)
        folders = dict(base["folders"])
        for key in keys:
            folders[key] = [*folders.get(key, []), commit]
        self._commit(base, folders, base["finished"])

    def read(self, version: int | None = None) -> DataFrame:
        """The events of one version, the latest by default; later changes of the store don't touch this DataFrame."""
        return self._read(self.manifest(version)["folders"])

    def _read(self, folders: Mapping[str, list[str]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.SCHEMA)
        held: dict[str, set[str]] = {}
        for key, commits in folders.items():
            for commit in commits:
                held.setdefault(commit, set()).add(key)
        paths = []
        for commit, keys in sorted(held.items()):
            top = f"{self.path}/data/commit={commit}"
            there = len(self._fs.globStatus(self._path("data", f"commit={commit}", "field_id=*", "phenotype=*")) or [])
            paths += [top] if there == len(keys) else [
                f"{top}/field_id={f}/phenotype={self._escape(p)}" for p, f in map(self._pair, sorted(keys))]
        schema = T.StructType([*self.SCHEMA.fields, T.StructField("commit", T.StringType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths).select(*self.SCHEMA.names)

    # -- what is extracted (from the manifest, no data read) -----------------------------------------
    def partitions(self) -> list[Pair]:
        return sorted(map(self._pair, self.manifest()["folders"]))

    def finished(self) -> dict[Pair, str]:
        """(phenotype, field_id) pairs whose extraction was completed, with events or without, and the mark (the content of
        their codes) it was completed with."""
        return {self._pair(k): mark for k, mark in self.manifest()["finished"].items()}

    # -- X18: extraction into the store ------------------------------------------------------------
    def replace(self, events: DataFrame, pairs: Mapping[Pair, str] | Iterable[Pair], drop: Iterable[Pair] = ()) -> None:
        """Make ``events`` the rows of ``pairs`` (with their marks), all of them and no others, and drop the pairs of ``drop``,
        in one version. A failure anywhere leaves the store as it was."""
        base = self.manifest()
        marks = {self._key(p): mark for p, mark in (pairs.items() if isinstance(pairs, Mapping) else ((p, "") for p in pairs))}
        gone = {*marks, *map(self._key, drop)}
        commit, done = None, False
        try:
            commit, keys = self._write(events)
            if stray := set(keys) - set(marks):
                raise ValueError(f"events of pairs that are not replaced: {sorted(stray)}")
            folders = {k: v for k, v in base["folders"].items() if k not in gone} | {k: [commit] for k in keys}
            finished = {k: v for k, v in base["finished"].items() if k not in gone} | marks
            self._commit(base, folders, finished)
            done = True
        finally:
            if commit is not None and not done:
                self._fs.delete(self._path("data", f"commit={commit}"), True)

    # -- E5 / E6: deletes --------------------------------------------------------------------------
    def count(self, phenotype: str | None = None, field_id: int | None = None) -> int:
        """Rows, from the footers of the folders concerned."""
        return self._read({k: v for k, v in self.manifest()["folders"].items() if self._wanted(k, phenotype, field_id)}).count()

    def _wanted(self, key: str, phenotype: str | None, field_id: int | None) -> bool:
        p, f = self._pair(key)
        return phenotype in (None, p) and field_id in (None, f)

    def delete(self, phenotype: str, field_id: int | None = None) -> int:
        """Remove a phenotype (all fields, E5) or one (phenotype, field) (E6); returns removed rows."""
        base = self.manifest()
        gone = {k for k in {*base["folders"], *base["finished"]} if self._wanted(k, phenotype, field_id)}
        n = self._read({k: v for k, v in base["folders"].items() if k in gone}).count()
        if gone:
            self._commit(base, *({k: v for k, v in base[part].items() if k not in gone} for part in ("folders", "finished")))
        return n

    def delete_phenotype(self, phenotype: str) -> tuple[int, int]:
        """E5: counts before and after removing one phenotype from the table."""
        before = self.count()
        return before, before - self.delete(phenotype)

    def vacuum(self, keep: int = 1) -> int:
        """Remove manifests before the last ``keep`` ones and the folders that none of these lists; returns how many commits
        went. Readers of removed versions, and writers at work, must be gone."""
        versions = self.versions()
        live = {c for v in versions[-keep:] for commits in self.manifest(v)["folders"].values() for c in commits}
        for version in versions[:-keep]:
            self._fs.delete(self._path("_versions", f"{version:012d}.json"), False)
        commits = [st.getPath() for st in self._fs.globStatus(self._path("data", "commit=*")) or []]
        dead = [p for p in commits if p.getName().split("=", 1)[1] not in live]
        for p in dead:
            self._fs.delete(p, True)
        return len(dead)
