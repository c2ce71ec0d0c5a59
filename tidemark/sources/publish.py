"""Published tables: write sorted parquet once, gate it, then commit one manifest entry."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.functions.fingerprint import identity, row_hash
from tidemark.operators.calendar import month_of

MANIFEST_SCHEMA = (
    "table_name string, layer string, version bigint, location string, row_count bigint, "
    "primary_key array<string>, schema_json string, config_hash string, hash_sum string, "
    "hash_xor string, upstream map<string,string>"
)


class PublishError(ValueError):
    """A table could not be published; readers still see the previous version."""


class CommitConflict(PublishError):
    """Another writer published the same version first."""


def key_gate(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: rows, rows with a null key part, and rows beyond the first of their key.

    Counts combine map-side, so one repeated key cannot overload a task.
    """
    null_key = " or ".join(f"`{c}` is null" for c in key)
    return (
        df.groupBy(*key).agg(F.expr("count(*) as n"))
        .groupBy().agg(
            F.expr("coalesce(sum(n), 0) as row_count"),
            F.expr(f"coalesce(sum(if({null_key}, n, 0)), 0) as null_key_rows"),
            F.expr("coalesce(sum(n - 1), 0) as duplicate_rows"),
        )
    )


@dataclass
class Warehouse:
    """Published tables under one shared root directory.

    Every publication writes a new version directory. Its commit is one manifest entry whose name
    is the table and version: it is created only if no such entry exists, so of two writers that
    started from the same version one fails, and a failed or interrupted build leaves the previous
    version in force. The file system must refuse to create a file twice, as HDFS does.
    """

    spark: SparkSession
    root: str
    config_hash: str = ""
    _used: dict[str, str] = field(default_factory=dict)

    @property
    def manifest_path(self) -> str:
        return f"{self.root.rstrip('/')}/_manifest"

    def _path(self, path: str):
        held = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return held, held.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def manifest(self, latest: bool = True) -> DataFrame:
        """Manifest rows; by default only the newest version of each table."""
        path, system = self._path(self.manifest_path)
        if not system.exists(path):
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        rows = self.spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").json(
            self.manifest_path)
        if not latest:
            return rows
        return rows.groupBy("table_name").agg(
            F.max_by(F.struct(*rows.columns[1:]), "version").alias("newest")
        ).select("table_name", "newest.*")

    def entry(self, name: str):
        """The newest manifest row of one table, or None."""
        return self.manifest().filter(F.col("table_name") == name).first()

    def read(self, name: str) -> DataFrame:
        """A published table; its fingerprint is remembered as an upstream of later ones.

        A table published by months has one more column, the month, by which slices are read.
        """
        row = self.entry(name)
        if row is None:
            raise PublishError(f"required upstream table is missing: {name}")
        self._used[name] = f"{row.hash_sum}/{row.hash_xor}"
        return self.spark.read.parquet(row.location)

    def publish(
        self, layer: str, name: str, df: DataFrame, key: list[str],
        partition_by: str | None = None, upstream: list[str] | None = None, months: str | None = None,
    ) -> dict:
        """Write, verify and commit one table; returns its manifest row. See :meth:`prepare`."""
        return self.commit(self.prepare(layer, name, df, key, partition_by, upstream, months))

    def prepare(
        self, layer: str, name: str, df: DataFrame, key: list[str],
        partition_by: str | None = None, upstream: list[str] | None = None, months: str | None = None,
    ) -> dict:
        """Write and verify one table without committing it; returns the row to commit.

        The plan runs once and the table is written once: rows are dealt out by partition (by the
        leading key where there is none), large partitions over several tasks, each file is sorted
        by the key, and row count, null keys and fingerprint are observed in the same pass. Only
        the key columns are read again, to count repeated keys. ``months`` names a date column
        by whose months the table is partitioned as well. ``upstream`` names the published inputs;
        by default, every table read through this warehouse so far.
        """
        if partition_by is not None and partition_by != key[0]:
            raise PublishError("tables are partitioned by the leading key column only")
        previous = self.entry(name)
        final = f"{self.root.rstrip('/')}/{layer}/{name}/data-{uuid.uuid4().hex[:12]}"
        inputs = self._used if upstream is None else upstream
        marks = {k: self._used[k] for k in inputs if k != name}
        schema = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        folders = [partition_by] if partition_by else []
        laid = df.withColumn("_hash", row_hash(df, sorted(df.columns)))
        if months is not None:
            laid = laid.withColumn(month_of(months), F.date_format(months, "yyyy-MM"))
            folders.append(month_of(months))
        seen = Observation()
        null_key = " or ".join(f"`{c}` is null" for c in key)
        observed = (
            laid.hint("rebalance", *[F.col(f"`{c}`") for c in folders or key[:1]])
            .sortWithinPartitions(*folders, *key)
            .observe(seen, *identity("_hash"), F.expr(f"count_if({null_key})").alias("null_key_rows"))
            .drop("_hash")
        )
        writer = observed.write.option("compression", "zstd")
        (writer.partitionBy(*folders) if folders else writer).parquet(final)
        mark = seen.get
        gate = key_gate(self.spark.read.parquet(final).select(*[f"`{c}`" for c in key]), key).first()
        broken = {**gate.asDict(), "null_key_rows": mark["null_key_rows"]}
        if broken["duplicate_rows"] or broken["null_key_rows"]:
            self._remove(final)
            raise PublishError(f"{name}: key {key} violated: {broken}")
        if mark["row_count"] != gate.row_count:
            raise PublishError(f"{name}: wrote {gate.row_count} of {mark['row_count']} rows")
        return {
            "table_name": name, "layer": layer,
            "version": (previous.version + 1) if previous else 1,
            "location": final, "row_count": gate.row_count, "primary_key": list(key),
            "schema_json": json.dumps(schema, sort_keys=True), "config_hash": self.config_hash,
            "hash_sum": mark["hash_sum"], "hash_xor": mark["hash_xor"], "upstream": marks,
        }

    def commit(self, row: dict) -> dict:
        """Make a prepared table the current version, unless another writer has been first."""
        name, version = row["table_name"], row["version"]
        path, system = self._path(f"{self.manifest_path}/{name}/{version:08d}.json")
        try:
            out = system.create(path, False)
        except Py4JJavaError as failed:
            if "FileAlreadyExists" not in failed.java_exception.getClass().getName():
                raise
            self._remove(row["location"])
            raise CommitConflict(f"{name}: version {version} was published meanwhile") from None
        out.write(bytearray(json.dumps(row).encode()))
        out.close()
        self._used[name] = f"{row['hash_sum']}/{row['hash_xor']}"
        return row

    def _remove(self, path: str) -> None:
        target, system = self._path(path)
        system.delete(target, True)
