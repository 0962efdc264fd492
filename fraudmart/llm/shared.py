"""Helpers that every operator of this package uses."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.plans.sizing import checkpoint_dir

#: ASCII white space; every other byte belongs to a word.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the package's sources to the executors, once per application, so that
    tasks can import it wherever the driver was started."""
    app = spark.sparkContext.applicationId
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if app in _SHIPPED or not os.path.isdir(root):  # not a folder: came as --py-files already
        return
    path = os.path.join(tempfile.mkdtemp(prefix="llm-sources-"), f"fraudmart-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


#: by module: what empties the caches that it keeps in a Python worker from task to task
_KEPT: dict[str, list] = {}


def kept(cached):
    """Marks an ``lru_cache`` as one of its module's alone: a worker empties it before a task
    of another module."""
    _KEPT.setdefault(cached.__module__, []).append(cached)
    return cached


@lru_cache(maxsize=1)
def _trim():
    """glibc's ``malloc_trim``, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns memory that this process does not use to the system."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def leave_to(module: str) -> None:
    """Spark hands a worker from stage to stage: what other modules keep in it goes."""
    held = [c for m, cs in _KEPT.items() if m != module for c in cs if c.cache_info().currsize]
    for c in held:
        c.cache_clear()
    if held:
        gc.collect()
        give_back()


def _tidy(run):
    module = run.__module__

    def task(batches):
        leave_to(module)
        yield from run(batches)
        give_back()
    return task


def in_tasks(df: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over Arrow batches of each partition (``df.transform(in_tasks, run, schema)``).
    A task leaves its worker no memory but its own module's caches (``kept``)."""
    ship(df.sparkSession)
    return df.mapInArrow(_tidy(run), schema)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only a session on one machine, as in tests,
    may leave it unset and gets a folder of its own."""
    base = checkpoint_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-checkpoints-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts lineage,
    survives a lost executor, and fixes whatever the plan computed. Folders lie
    under the application's id and may be removed when the application ends."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/llm-{app}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(id_col: Column, text_col: Column) -> Column:
    """64 bits that tell a document's row from any other, NULLs included.
    Rows that repeat both id and text share it."""
    return F.xxhash64(id_col, text_col, id_col.isNull(), text_col.isNull())


def documents_view(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only what the operators need, under fixed names, so that extra columns
    of the input cannot clash with theirs."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id",
            text_col: str = "text", once: bool = False) -> DataFrame:
    """``docs`` without the rows whose ``row_key`` is in ``dropped`` (one
    column ``row_key``); all columns stay as they are. ``once``: of rows that
    repeat both id and text one stays."""
    name = "row_key"
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    keys = dropped.select(F.col("row_key").alias(name)).distinct()
    keyed = docs.withColumn(name, row_key(F.col(id_col).cast("long"), F.col(text_col)))
    kept = keyed.join(keys, name, "left_anti")
    if once:  # the join has dealt rows out by this key already
        kept = kept.dropDuplicates([name])
    return kept.select(*docs.columns)
