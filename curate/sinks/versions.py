"""A table in versions: folders that are written once, and a manifest written last.

Rows lie in buckets by a hash of their key. A change writes the buckets it touches to a
new folder and then adds one row to the manifest, which names the folder of every bucket;
readers follow the newest row. So a run that stops half way leaves the table as it was,
and a change costs what it touches. Rows without a key are only ever added, each time in
a folder of their own.

There is one writer at a time; two that commit the same version are found and raise.
Files are loaded once each: the manifest row that makes their rows visible also names the
list of files they came from.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.operators.changes import upsert
from curate.sinks.files import delete_folder, stored

BUCKETS = 256
MAX_FILES = 10_000
_BUCKET = "__bucket"

MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("schema", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("folders", T.ArrayType(T.StringType())),  # by bucket; null: empty
        T.StructField("loose", T.ArrayType(T.StringType())),
        T.StructField("loaded", T.ArrayType(T.StringType())),
        T.StructField("batch", T.StringType()),
    ]
)


def _schema(row: T.Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(row["schema"]))


class VersionedTable:
    """A table below ``path``, with at most one row per key and any number without one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS
    ) -> VersionedTable:
        """An empty table, unless one is there already; the number of buckets stays."""
        new = cls(spark, path)
        if key not in schema.names or buckets < 1:
            raise ValueError(f"a table needs a bucket and its key {key!r} among {schema.names}")
        try:
            new.manifest()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            new._commit((0, schema.json(), key, [None] * buckets, [], [], None))
        return new

    def manifest(self, version: int | None = None) -> T.Row:
        """The newest row of the manifest, or that of an older version."""
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        newest = rows.orderBy(F.desc("version")).limit(2).collect()
        if not newest:
            raise ValueError(f"{self.path} has no version {version}")
        if len(newest) == 2 and newest[0]["version"] == newest[1]["version"]:
            raise RuntimeError(f"two writers have committed version {newest[0]['version']}")
        return newest[0]

    def read(self, version: int | None = None) -> DataFrame:
        now = self.manifest(version)
        return self._rows(now, range(len(now["folders"])), now["loose"])

    def upsert(self, incoming: DataFrame, batch: str | None = None) -> bool:
        """Insert new keys, replace held ones, add rows without a key; see ``upsert``.

        A ``batch`` that has been committed before is left out; then False comes back.
        """
        return self._change(incoming, batch, None)

    def load_files(
        self,
        folder: str,
        schema: T.StructType | str,
        prepare: Callable[[DataFrame], DataFrame] | None = None,
        max_files: int = MAX_FILES,
    ) -> int:
        """Upsert the rows of all Parquet files that were not loaded yet, oldest first;
        returns the number of files.

        A second run adds nothing. Files count by their path, so a file that is written
        over in place is not loaded again. Each batch of ``max_files`` files is one version.
        """
        loaded = 0
        while paths := self._new_files(folder, max_files):
            rows = self.spark.read.schema(schema).parquet(*paths)
            self._change(prepare(rows) if prepare else rows, None, paths)
            loaded += len(paths)
        return loaded

    def vacuum(self) -> int:
        """Delete the data that the newest version does not use; returns the folders
        deleted. No reader of an older version may be at work."""
        now = self.manifest()
        used = {*now["folders"], *now["loose"], *now["loaded"]}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        every = rows.select(F.explode(F.concat("folders", "loose")).alias("folder")).distinct()
        old = [r["folder"] for r in every.collect() if r["folder"] not in used]
        for name in filter(None, old):
            delete_folder(self.spark, f"{self.path}/data/{name}")
        return len([name for name in old if name])

    def _rows(self, now: T.Row, buckets: Sequence[int], loose: Sequence[str]) -> DataFrame:
        schema = _schema(now)
        paths = [f"{self.path}/data/{name}" for name in loose]
        paths += [
            f"{self.path}/data/{now['folders'][b]}/{_BUCKET}={b}" for b in buckets if now["folders"][b]
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _change(self, incoming: DataFrame, batch: str | None, files: list[str] | None) -> bool:
        now = self.manifest()
        if batch is not None and self._committed(batch):
            return False
        key, buckets = now["key"], len(now["folders"])
        columns = _schema(now).names
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        incoming = stored(incoming.select(*columns).withColumn(_BUCKET, bucket), "incoming")
        keyed = incoming.filter(F.col(key).isNotNull())
        touched = sorted(r[0] for r in keyed.select(_BUCKET).distinct().collect())
        name = f"{now['version'] + 1}-{uuid.uuid4().hex}"
        folders, loose, loaded = list(now["folders"]), list(now["loose"]), list(now["loaded"])
        if touched:
            merged = upsert(keyed.drop(_BUCKET), self._rows(now, touched, []), key)
            # Rebalancing cuts a large bucket into several files and gathers small ones.
            merged.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET).write.partitionBy(
                _BUCKET
            ).parquet(f"{self.path}/data/{name}")
            for b in touched:
                folders[b] = name
        keyless = incoming.filter(F.col(key).isNull()).drop(_BUCKET)
        if not keyless.isEmpty():
            keyless.write.parquet(f"{self.path}/data/{name}-loose")
            loose.append(f"{name}-loose")
        if files:
            listed = self.spark.createDataFrame([(f,) for f in files], "path string")
            listed.write.parquet(f"{self.path}/loaded/{name}")
            loaded.append(name)
        self._commit((now["version"] + 1, now["schema"], key, folders, loose, loaded, batch))
        return True

    def _commit(self, row: tuple) -> None:
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(
            f"{self.path}/manifest"
        )

    def _committed(self, batch: str) -> bool:
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        return not rows.filter(F.col("batch") == batch).isEmpty()

    def _new_files(self, folder: str, most: int) -> list[str]:
        # Only the listing is read: the content column is pruned.
        found = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(folder)
            .select("path", "modificationTime")
        )
        names = self.manifest()["loaded"]
        if names:
            seen = self.spark.read.schema("path string").parquet(
                *[f"{self.path}/loaded/{name}" for name in names]
            )
            found = found.join(seen, "path", "left_anti")
        return [r["path"] for r in found.orderBy("modificationTime", "path").limit(most).collect()]
