"""Tables dealt into buckets of their key, of which an update rewrites only those it touches.

``TableStore`` keeps the data as it was written; to change one row there is to write a new
generation. Here a hash of the key says in which bucket a row lies, and a manifest, itself a
table of the store, says in which version each bucket's files are::

    <root>/<table>/v-3/_bucket=17/   files of the buckets that version 3 rewrote
    <root>/<table>__buckets/         one row per bucket: version and rows

An upsert reads and writes the touched buckets and then replaces the manifest, whose commit is
that of the whole update: a job that dies before it leaves nothing visible, and its retry
overwrites the leftovers. Keys are unique, so buckets are even whatever the data. One writer per
table is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import overwrite_rows, unseen
from ..schemas import Contract, conform, empty_frame
from ..session import hadoop_path, written_once
from .store import Batch, DuplicateKey, TableStore

_MANIFEST = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("buckets", T.IntegerType()),
    T.StructField("version", T.LongType()), T.StructField("rows", T.LongType())])


@dataclass(frozen=True)
class BucketedTable:
    """A table by its contract; ``buckets`` counts for a table that is not there yet."""

    store: TableStore
    contract: Contract
    buckets: int = 64

    @property
    def manifest_name(self) -> str:
        return f"{self.contract.name}__buckets"

    def manifest(self) -> list[Row]:
        """A row per bucket that holds rows; as many as the table has buckets at most."""
        return self.store.read(self.manifest_name).collect() if self.store.exists(self.manifest_name) else []

    def _path(self, version: int) -> str:
        return f"{self.store.root}/{self.contract.name}/v-{version}"

    def _rows(self, parts: list[Row]) -> DataFrame:
        if not parts:
            return empty_frame(self.store.spark, self.contract.schema)
        paths = [f"{self._path(p.version)}/_bucket={p.bucket}" for p in sorted(parts)]
        return self.store.spark.read.schema(self.contract.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._rows(self.manifest())

    def upsert(self, df: DataFrame, batch: str, gone: DataFrame | None = None) -> Batch:
        """Rows of ``df`` take the place of those of equal key; keys in ``gone`` are taken out first.

        A batch that is committed already does nothing; one that repeats a key is not committed.
        """
        store, key = self.store, list(self.contract.key)
        done = store.committed(self.manifest_name, batch)
        if done is not None:
            return Batch(self.contract.name, 0, committed=False)
        known = self.manifest()
        buckets = known[0].buckets if known else self.buckets
        place: Column = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
        commits = store.commits(self.manifest_name)
        version = commits[-1].seq + 1 if commits else 0
        with written_once(conform(df, self.contract), "upsert") as fresh:
            if not fresh.groupBy(*key).count().where(F.col("count") > 1).isEmpty():
                raise DuplicateKey(f"{self.contract.name}: batch {batch} repeats {', '.join(key)}")
            keys = fresh.select(*key)
            if gone is not None:
                # With the contract's types: a key of another type has another hash.
                gone = gone.select(*(F.col(k).cast(self.contract.schema[k].dataType).alias(k) for k in key))
                keys = keys.unionByName(gone)
            touched = {row[0] for row in keys.select(place).distinct().collect()}  # of ``buckets`` numbers
            stored = self._rows([p for p in known if p.bucket in touched])
            if gone is not None:
                stored = unseen(stored, gone, key)
            merged = overwrite_rows(stored, fresh, key).withColumn("_bucket", place)
            merged.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(self._path(version))
        written = store.spark.read.schema(merged.schema).parquet(self._path(version)).groupBy("_bucket").count().collect()
        parts = [p for p in known if p.bucket not in touched]
        parts += [Row(bucket=r[0], buckets=buckets, version=version, rows=r[1]) for r in written]
        frame = store.spark.createDataFrame([tuple(p) for p in sorted(parts)], _MANIFEST).coalesce(1)
        store.replace(self.manifest_name, frame, batch)
        return Batch(self.contract.name, sum(r[1] for r in written), committed=True)

    def purge(self, keep: int = 2) -> int:
        """Delete files of buckets that none of the newest ``keep`` manifests names; the folders deleted."""
        commits = self.store.commits(self.manifest_name)
        recent = sorted({c.gen for c in commits})[-max(keep, 1):]
        live = [c for c in commits if c.gen in recent]
        if not live:
            return 0
        named = {(r.version, r.bucket) for r in self.store.read_batches(self.manifest_name, live).collect()}
        deleted = 0
        # A version without a commit is newer than all of these and stays for its retry.
        for version in range(commits[-1].seq + 1):
            files, folder = hadoop_path(self.store.spark, self._path(version))
            if not files.exists(folder):
                continue
            for status in files.listStatus(folder):
                name = status.getPath().getName()
                if name.startswith("_bucket=") and (version, int(name.removeprefix("_bucket="))) not in named:
                    files.delete(status.getPath(), True)
                    deleted += 1
        return deleted
