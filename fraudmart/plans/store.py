"""K1–K9: mart state as versioned Parquet, published by one manifest per run.

Layout under ``root`` (any Hadoop-compatible shared path)::

    <table>/run_id=<run>/...            parts written by one run
    _manifests/run_id=<run>/part-*.json one row per live part of every table

A run writes only *new* directories (never overwrites a path it reads), then
writes its manifest last. Readers take the newest manifest (found by its name), so a run is
visible as a whole or not at all, a crashed run leaves the previous state
served, and re-running the same ``run_id`` simply rewrites its own parts.

Dimensions are split into ``slice=closed`` parts (append-only: the versions a
run closed) and ``slice=open`` parts, one per key bucket (the current versions;
a run rewrites the buckets that change), so a day's write is proportional to the
change; a manifest lists the newest open part of each bucket. Facts and the
report are appended as one part per run, partitioned by date inside it
(``trans_dt`` / ``report_dt``) for pruning.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifests"


@dataclass
class Manifest:
    run_id: str | None
    parts: dict[str, list[str]] = field(default_factory=dict)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- manifests -------------------------------------------------------------
    def _newest_run(self) -> str | None:
        """Newest published run id, from file names only (``_SUCCESS`` marks a
        manifest that was written whole); no manifest is read for it."""
        try:
            names = (self.spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
                     .option("recursiveFileLookup", True).load(f"{self.root}/{MANIFESTS}"))
            return names.agg(F.max(F.regexp_extract("path", r"run_id=([^/]+)/", 1))).first()[0]
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                return None
            raise

    def latest(self) -> Manifest:
        """The newest published manifest (its rows are a bounded list of
        part directories, the only store metadata read on the driver)."""
        last = self._newest_run()
        if last is None:
            return Manifest(None)
        rows = self.spark.read.schema("table string, part string").json(
            f"{self.root}/{MANIFESTS}/run_id={last}")
        parts: dict[str, list[str]] = {}
        for r in rows.collect():
            parts.setdefault(r.table, []).append(r.part)
        return Manifest(last, {t: sorted(p) for t, p in parts.items()})

    def publish(self, run_id: str, parts: dict[str, list[str]],
                expected: str | None = None) -> None:
        """Write the manifest of ``run_id`` — the commit point of the run. Refused when
        another run is seen to have been published since ``expected``, the state that this one
        read. (Look and write are two steps: runs on one store must not overlap.)"""
        if self._newest_run() != expected:
            raise RuntimeError(f"another run was published after {expected!r}; run again")
        rows = [(t, p) for t, ps in sorted(parts.items()) for p in ps]
        (self.spark.createDataFrame(rows, "table string, part string").coalesce(1)
         .write.mode("overwrite").json(f"{self.root}/{MANIFESTS}/run_id={run_id}"))

    # --- tables -----------------------------------------------------------------
    def table_path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: T.StructType, manifest: Manifest,
             parts: list[str] | None = None,
             partition_fields: tuple[T.StructField, ...] = ()) -> DataFrame:
        """Live rows of ``table``: only the parts the manifest lists are
        listed and scanned. The schema is given, never inferred (an empty part
        reads as no rows); ``run_id``/``slice`` bookkeeping columns are dropped,
        other partition columns (e.g. ``trans_dt``) are kept for pruning."""
        parts = manifest.parts.get(table, []) if parts is None else parts
        names = set(schema.fieldNames())
        extra = [f for f in partition_fields if f.name not in names]
        if "run_id" not in names | {f.name for f in extra}:
            bookkeeping = [T.StructField("run_id", T.StringType())]
        else:
            bookkeeping = []
        out = [f.name for f in schema.fields] + [f.name for f in extra]
        if not parts:
            return self.spark.createDataFrame([], T.StructType(list(schema.fields) + extra))
        full = T.StructType(list(schema.fields) + extra + bookkeeping)
        base = self.table_path(table)
        df = (self.spark.read.schema(full).option("basePath", base)
              .parquet(*[f"{base}/{p}" for p in parts]))
        return df.select(*out)

    def write(self, table: str, run_id: str, df: DataFrame, sub: str = "",
              partition_by: list[str] | None = None) -> str:
        """Write one part of ``table`` for ``run_id``; returns the part name."""
        part = f"run_id={run_id}" + (f"/{sub}" if sub else "")
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.table_path(table)}/{part}")
        return part
