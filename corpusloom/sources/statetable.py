"""A keyed table that is updated by commits: copy on write by key bucket, one manifest per version.

Rows lie in buckets by the hash of their key. A commit merges its rows into the buckets they touch, writes those anew into
a folder of its own, and then publishes a manifest that names the folder of every bucket. Readers take the
newest whole manifest: a commit that dies before it has published one leaves the old version as it was, and two
writers cannot publish the same version.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.session import scratch_path

BUCKET = "state_bucket"


class StateConflict(RuntimeError):
    """Another commit has published this version first."""


class StateTable:
    """The state below ``path``. ``order`` decides between rows of a key: the largest wins, nulls are smallest; among equals
    the later commit does. Null keys are keys. ``buckets`` is fixed by the first commit: it bounds what a commit
    rewrites for one key, and a bucket is rewritten by one task."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, keys: list[str], order: str, buckets: int = 64):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), keys, order
        self.schema = spark.createDataFrame([], schema).schema
        if BUCKET in self.schema.fieldNames():
            raise ValueError(f"{BUCKET} is taken")
        found = self._manifest()
        self.buckets = found["buckets"] if found else buckets

    # --- manifests

    def _fs(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def versions(self) -> list[int]:
        """Published versions, whole or not, in order."""
        fs, folder = self._fs(f"{self.path}/manifests")
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, version: int | None = None) -> dict | None:
        for v in reversed(self.versions()):
            if version is None or v == version:
                text = self.spark.read.text(f"{self.path}/manifests/{v:012d}.json", wholetext=True).collect()
                try:
                    return json.loads(text[0].value)
                except (IndexError, ValueError):  # its writer died: as if it were not there
                    if version is not None:
                        break
        return None

    def _publish(self, version: int, folders: dict[str, str]) -> None:
        fs, target = self._fs(f"{self.path}/manifests/{version:012d}.json")
        try:
            out = fs.create(target, False)
        except Exception as taken:
            if fs.exists(target):
                raise StateConflict(f"version {version} of {self.path} was published by another commit") from taken
            raise
        out.write(bytearray(json.dumps({"version": version, "buckets": self.buckets, "folders": folders}).encode()))
        out.close()

    # --- rows

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the newest version, or of ``version``; none before the first commit."""
        found = self._manifest(version)
        if version is not None and found is None:
            raise ValueError(f"{self.path} has no version {version}")
        return self._rows(sorted(found["folders"].values()) if found else [])

    def folders(self) -> dict[str, str]:
        """Bucket to the folder that holds it."""
        found = self._manifest()
        return found["folders"] if found else {}

    def upsert(self, changes: DataFrame, attempts: int = 3) -> int | None:
        """Merge rows by key and publish a version; its number, None if there is nothing to merge.

        ``changes`` may hold a key many times, in any order; other columns than the table's are left out, missing ones are
        null. If another commit comes first the merge starts anew on its version.
        """
        columns = [(F.col(f.name) if f.name in changes.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        keys = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")
        staged = scratch_path(self.spark, "changes")
        self._latest(changes.select(*columns).withColumn("_new", F.lit(1))).withColumn(BUCKET, keys).write.parquet(staged)
        new = self.spark.read.parquet(staged)
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most the number of buckets
        if not touched:
            return None
        for attempt in range(attempts):
            # the number after all that were taken, those of dead writers included
            found, version = self._manifest(), max(self.versions(), default=0) + 1
            folders = dict(found["folders"]) if found else {}
            old = self._rows([folders[str(b)] for b in touched if str(b) in folders]).withColumn("_new", F.lit(0)).withColumn(BUCKET, keys)
            commit = f"{version:012d}-{uuid.uuid4().hex}"
            merged = self._latest(old.unionByName(new)).drop("_new").repartition(BUCKET)
            merged.write.partitionBy(BUCKET).parquet(f"{self.path}/data/{commit}")
            try:
                self._publish(version, folders | {str(b): f"{commit}/{BUCKET}={b}" for b in touched})
                return version
            except StateConflict:
                if attempt == attempts - 1:
                    raise
        return None

    def _latest(self, rows: DataFrame) -> DataFrame:
        """One row per key; the shuffle gets one row of a key from every task."""
        order = Window.partitionBy(*self.keys).orderBy(F.desc_nulls_last(self.order), F.desc("_new"), F.xxhash64(*self.schema.fieldNames()))
        return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")

    def vacuum(self, keep: int = 2) -> int:
        """Delete the folders that none of the ``keep`` newest versions names; how many. Not to be run beside a commit."""
        versions = self.versions()[-keep:]
        found = [m for m in map(self._manifest, versions) if m]
        named = {f.split("/")[0] for m in found for f in m["folders"].values()}
        fs, data = self._fs(f"{self.path}/data")
        old = [f.getPath() for f in fs.listStatus(data) if f.getPath().getName() not in named] if found and fs.exists(data) else []
        for folder in old:
            fs.delete(folder, True)
        for v in self.versions():
            if v not in versions:
                fs.delete(self._fs(f"{self.path}/manifests/{v:012d}.json")[1], False)
        return len(old)
