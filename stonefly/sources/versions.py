"""Versioned tables: keyed merge, one manifest a version, readers see old or new (IO-12).

A table is a folder of immutable Parquet files, dealt to ``parts`` by a hash of
its keys, and of manifests ``v00000001.json``, ``v00000002.json``...  A manifest
names the folders that make up the version, part by part.  ``merge`` writes
the incoming rows, rewrites only the parts that hold one of their keys, and
commits by renaming a finished manifest to the next free number; the rename
fails where that number exists, and the merge is then done again on the
version that came first.  Files that no manifest names are not part of the
table, so a crash at any place before the rename changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stonefly.operators.joins import join_null_safe
from stonefly.operators.lookup import least_per_key

PART = "_part"


class VersionedTable:
    """A table under ``root`` with the given keys.  ``parts`` holds for the table's life.

    ``one_row``: a key has one row (of several incoming ones the least is
    taken, as ``least_per_key`` says); otherwise a key has as many as come
    (the taxa of a sample), and incoming rows of a key replace all its old ones.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], one_row: bool = True, parts: int = 32) -> None:
        self.spark, self.root, self.keys, self.one_row, self.parts = spark, root.rstrip("/"), list(keys), one_row, parts
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.makeQualified(path).toUri(), spark._jsc.hadoopConfiguration())

    # -- manifests -----------------------------------------------------------------
    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def versions(self) -> list[int]:
        folder = self._path("manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version (the newest by default); None for a table that holds nothing yet."""
        known = self.versions()
        if version is None and not known:
            return None
        stream = self._fs.open(self._path("manifests", f"v{version or known[-1]:08d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> bool:
        """Is the manifest the next version now?  False where another one took its number."""
        jvm = self.spark._jvm
        temporary = self._path("manifests", f"{uuid.uuid4().hex}.tmp")
        out = self._fs.create(temporary)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self._context.rename(temporary, self._path("manifests", f"v{manifest['version']:08d}.json"), options)
        except Exception as error:
            self._fs.delete(temporary, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    # -- reading ----------------------------------------------------------------------
    def _read(self, manifest: dict, only: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        folders = sorted({f for p, f in manifest["parts"].items() if only is None or int(p) in only})
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default.  A plan that was made keeps its version."""
        manifest = self.manifest(version)
        if manifest is None:
            raise FileNotFoundError(f"no version in {self.root}")
        return self._read(manifest)

    # -- merging -----------------------------------------------------------------------
    def _write(self, df: DataFrame) -> tuple[str, set[int]]:
        """Write rows dealt to parts; the folder, and the parts that have rows (at most ``parts``)."""
        folder = f"data/{uuid.uuid4().hex}"
        dealt = df.withColumn(PART, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))
        dealt.write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        statuses = self._fs.listStatus(self._path(folder))
        names = [s.getPath().getName() for s in statuses]
        return folder, {int(n.split("=")[1]) for n in names if n.startswith(f"{PART}=")}

    def merge(self, df: DataFrame, run: str, attempts: int = 5) -> int:
        """Put the rows of ``df`` in, and return the new version.

        Rows of a key replace the old ones of that key.  Columns are united
        by name: what a side lacks is null.  ``run`` is noted in the manifest.
        """
        incoming = least_per_key(df, self.keys) if self.one_row else df
        fields = incoming.schema
        folder, touched = self._write(incoming)
        came = self.spark.read.schema(fields).parquet(*[f"{self.root}/{folder}/{PART}={p}" for p in sorted(touched)]) if touched else None
        for _ in range(attempts):
            old = self.manifest()
            known = T.StructType.fromJson(old["schema"]) if old else T.StructType([])
            clash = [f.name for f in known if f.name in fields.names and fields[f.name].dataType != f.dataType]
            if clash:
                raise ValueError(f"types of {clash} differ from the table's")
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in [*known, *[f for f in fields if f.name not in known.names]]])
            parts = dict(old["parts"]) if old else {}
            again = {p for p in touched if str(p) in parts}
            parts |= {str(p): f"{folder}/{PART}={p}" for p in touched}
            if again:
                # only parts that hold rows already: what stays, and what came
                mine = came.filter(F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).isin(sorted(again)))
                stays = join_null_safe(self._read(old, again), mine.select(*self.keys).distinct(), self.keys, "left_anti")
                merged, _ = self._write(stays.unionByName(mine, allowMissingColumns=True))
                parts |= {str(p): f"{merged}/{PART}={p}" for p in again}
            version = (old["version"] if old else 0) + 1
            if self._commit({"version": version, "run": run, "keys": self.keys, "schema": schema.jsonValue(), "parts": parts}):
                return version
        raise RuntimeError(f"other writers committed to {self.root} {attempts} times in a row")

    def expire(self, keep: int = 10) -> list[int]:
        """Delete all versions but the newest ``keep``, and the data that none of those names."""
        known = self.versions()
        gone, stay = known[:-keep], known[-keep:]
        named = {f.split("/")[1] for v in stay for f in self.manifest(v)["parts"].values()}
        old = {f.split("/")[1] for v in gone for f in self.manifest(v)["parts"].values()}
        for v in gone:
            self._fs.delete(self._path("manifests", f"v{v:08d}.json"), False)
        for folder in old - named:
            self._fs.delete(self._path("data", folder), True)
        return gone
