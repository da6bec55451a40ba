"""Result table kept by the upsert key in buckets.

The table is a folder of parquet files, one subfolder per bucket of the key's
hash, and a manifest per version that names the folder of each bucket.  A merge
reads and rewrites only the buckets that hold keys of the batch; the files of
the others are carried over untouched.  Publication is the exclusive creation
of the next manifest: a merge that dies before it leaves the last version as it
was, and of two merges that started from one version the second is refused.

Reading, merging and writing are Spark jobs; the driver holds the manifest (a
line per bucket, their number is fixed when the table is made) and the list of
touched buckets.  Keys are unique in the table, so buckets are balanced by
their hash; choose ``buckets`` so that one is a few hundred MB.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.upsert import as_named_in, dedup_last, key_columns, upsert
from tallyspark.schemas import RESULT_SCHEMA, UPSERT_KEYS
from tallyspark.session import cut_lineage
from tallyspark.sinks import files
from tallyspark.sinks.writers import with_keys

BUCKETS = 64
_BUCKET = "_bucket"


class StaleVersion(RuntimeError):
    """Another merge published first."""


@dataclass(frozen=True)
class Manifest:
    version: int
    buckets: int
    keys: tuple[str, ...]
    schema: T.StructType
    folders: dict[int, str]  # bucket -> folder below the root

    def dumps(self) -> str:
        body = {"version": self.version, "buckets": self.buckets, "keys": list(self.keys),
                "schema": self.schema.jsonValue(), "folders": {str(b): f for b, f in sorted(self.folders.items())}}
        return json.dumps(body)

    @staticmethod
    def loads(text: str) -> Manifest:
        body = json.loads(text)
        folders = {int(b): f for b, f in body["folders"].items()}
        return Manifest(body["version"], body["buckets"], tuple(body["keys"]), T.StructType.fromJson(body["schema"]), folders)


class KeyedTable:
    """A versioned, bucketed table under ``root`` (any path Spark can write)."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = UPSERT_KEYS, buckets: int = BUCKETS,
                 schema: T.StructType = RESULT_SCHEMA):
        self.spark, self.root = spark, root.rstrip("/")
        self._new = Manifest(0, buckets, tuple(keys), schema, {})

    # --- manifests ---------------------------------------------------------------
    def _path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        found = files.names(self.spark, self._path("_manifest"))
        return [int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith(".")]

    def manifest(self, version: int | None = None) -> Manifest:
        """A version's manifest, the latest by default (version 0 is empty)."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        if version == 0:
            return self._new
        if version not in known:
            raise ValueError(f"{self.root} has no version {version}")
        return Manifest.loads(files.read_text(self.spark, self._path("_manifest", f"{version:010d}.json")))

    def _publish(self, m: Manifest) -> None:
        """Create the manifest of the next version; fails if there is one.
        The content is written aside first, so a reader never sees half; a
        claim left by a merge that died here is removed by :meth:`recover`."""
        final = self._path("_manifest", f"{m.version:010d}.json")
        claim = self._path("_manifest", f".{m.version:010d}.claim")
        aside = self._path("_manifest", f".{uuid.uuid4().hex}.aside")
        files.write_text(self.spark, aside, m.dumps())
        # an exclusive create is atomic where a rename may overwrite
        if not files.exists(self.spark, final) and files.claim(self.spark, claim):
            done = not files.exists(self.spark, final) and files.rename(self.spark, aside, final)
            files.delete(self.spark, claim)
            if done:
                return
        files.delete(self.spark, aside)
        raise StaleVersion(f"version {m.version} of {self.root} is taken; merge again from the latest")

    def recover(self) -> None:
        """Remove the claims and drafts of merges that died while they
        published.  Not to be run beside a merge."""
        for name in files.names(self.spark, self._path("_manifest")):
            if name.endswith((".claim", ".aside")):
                files.delete(self.spark, self._path("_manifest", name))

    # --- rows --------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.manifest(version))

    def _rows(self, m: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        folders = [f for b, f in sorted(m.folders.items()) if buckets is None or b in set(buckets)]
        if not folders:
            return self.spark.createDataFrame([], m.schema)
        return self.spark.read.schema(m.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def _bucketed(self, df: DataFrame, m: Manifest) -> DataFrame:
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*key_columns(m.keys)), F.lit(m.buckets)).cast("int"))

    def merge(self, batch: DataFrame, prefer: str = "batch") -> Manifest:
        """Merge a batch and publish the next version; an empty batch too.

        ``prefer="batch"``: a batch row replaces the values of the columns that
        the batch has (C8).  ``prefer="last"``: of the table's and the batch's
        rows of a key the last in queue order stays (W1), whatever the order of
        the merges."""
        if prefer not in ("batch", "last"):
            raise ValueError(f"unknown preference: {prefer}")
        m = self.manifest()
        batch = with_keys(as_named_in(batch, m.schema.names + [c.upper() for c in batch.columns]))
        added = [f for f in batch.schema.fields if f.name not in m.schema.names]
        schema = T.StructType(m.schema.fields + added)
        batch = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields if f.name in batch.columns])
        staged = cut_lineage(self._bucketed(dedup_last(batch, m.keys), m), "keyed-batch")
        touched = [r[0] for r in staged.select(_BUCKET).distinct().collect()]  # the manifest's buckets at most
        new = replace(m, version=m.version + 1, schema=schema)
        if touched:
            target, rows = self._rows(replace(m, schema=schema), touched), staged.drop(_BUCKET)
            if prefer == "batch":
                merged = upsert(target, rows, m.keys, unique=True)
            else:
                merged = dedup_last(target.unionByName(rows, allowMissingColumns=True), m.keys)
            folder = f"data/{uuid.uuid4().hex}"
            merged = self._bucketed(merged.select(*schema.names), m)
            merged.repartition(_BUCKET).write.mode("error").partitionBy(_BUCKET).parquet(f"{self.root}/{folder}")
            new = replace(new, folders={**m.folders, **{b: f"{folder}/{_BUCKET}={b}" for b in touched}})
        self._publish(new)
        return new

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete the bucket folders that none of the last ``keep`` versions
        names, and the manifests before; returns the deleted folders.  Not to
        be run beside a merge."""
        known = self.versions()
        named = {f for v in known[-keep:] for f in self.manifest(v).folders.values()}
        gone = []
        for write in files.names(self.spark, self._path("data")):
            for bucket in files.names(self.spark, self._path("data", write)):
                name = f"data/{write}/{bucket}"
                if bucket.startswith(f"{_BUCKET}=") and name not in named:
                    files.delete(self.spark, self._path(name))
                    gone.append(name)
        for v in known[:-keep]:
            files.delete(self.spark, self._path("_manifest", f"{v:010d}.json"))
        return gone
