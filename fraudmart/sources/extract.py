"""Incremental extract from relational sources.

A source is any DataFrame: ``spark.read.jdbc`` / ``spark.read.format('jdbc')``
for a live database (the OR-filter below is pushed to the database whole), or
Parquet for a replica. Watermarks are one row per source in a small control
table; reading them is the only value that travels to the driver, so that
they can become literals the scan can push down.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.operators.spread import by_key
from fraudmart.schemas import EPOCH_DATE


def read_watermark(ctrl: DataFrame, table_name: str,
                   schema_name: str | None = None) -> tuple[_dt.date, _dt.date]:
    """(create, update) high-water marks of one source; NULL or a missing
    row reads as 1000-01-01."""
    rows = ctrl.where(F.col("table_name") == table_name)
    if schema_name is not None:
        rows = rows.where(F.col("schema_name") == schema_name)
    first = rows.select(
        F.coalesce("max_create_dt", F.lit(EPOCH_DATE)).alias("c"),
        F.coalesce("max_update_dt", F.lit(EPOCH_DATE)).alias("u"),
    ).first()
    return (first.c, first.u) if first is not None else (EPOCH_DATE, EPOCH_DATE)


def read_watermarks(ctrl: DataFrame) -> dict[str, tuple[_dt.date, _dt.date]]:
    """(create, update) marks of every source, in one job (one row per source)."""
    return {r.table_name: (r.create_wm, r.update_wm) for r in watermark_values(ctrl).collect()}


def watermark_values(ctrl: DataFrame) -> DataFrame:
    """The control table as the extract reads it (NULL → 1000-01-01)."""
    return ctrl.select(
        "schema_name", "table_name",
        F.coalesce("max_create_dt", F.lit(EPOCH_DATE)).alias("create_wm"),
        F.coalesce("max_update_dt", F.lit(EPOCH_DATE)).alias("update_wm"),
    )


def incremental_extract(src: DataFrame, create_wm: _dt.date, update_wm: _dt.date,
                        create_col: str = "create_dt", update_col: str = "update_dt",
                        overlap_days: int = 0) -> DataFrame:
    """Rows created or updated strictly after the watermarks (a NULL date
    never qualifies). ``overlap_days`` re-reads a few days back, which is safe
    because the SCD2 and fact appends ignore unchanged rows."""
    def back(wm: _dt.date) -> _dt.date:
        return wm if wm <= EPOCH_DATE else wm - _dt.timedelta(days=overlap_days)

    wc, wu = back(create_wm), back(update_wm)
    return src.where((F.col(create_col) > F.lit(wc)) | (F.col(update_col) > F.lit(wu)))


#: the rows taken at the marks themselves: a digest of the whole row, and its dates
TAKEN = T.StructType([T.StructField("row_digest", T.StringType()),
                      T.StructField("create_dt", T.DateType()),
                      T.StructField("update_dt", T.DateType())])


def row_digest(df: DataFrame) -> Column:
    """128 bits of a whole row, NULLs included."""
    return F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))


def boundary_extract(src: DataFrame, create_wm: _dt.date, update_wm: _dt.date, taken: DataFrame,
                     create_col: str = "create_dt", update_col: str = "update_dt") -> DataFrame:
    """Rows at or after the marks that were not taken yet. The marks are dates: a strict
    comparison loses a row that comes in later on the mark's own date, an inclusive one
    takes the mark's date twice. ``taken`` (``TAKEN``) names the rows taken at the marks, so
    each row is taken once; a row that changed since has another digest and is taken again.
    The filter is pushed to the source; only rows of the marks' dates can meet ``taken``."""
    at_mark = ((F.col(create_col) >= F.lit(create_wm)) | (F.col(update_col) >= F.lit(update_wm)))
    rows = src.where(at_mark).withColumn("row_digest", row_digest(src))
    return rows.join(by_key(taken.select("row_digest")), "row_digest", "left_anti").drop("row_digest")


def taken_at_marks(batch: DataFrame, taken: DataFrame, create_wm: _dt.date, update_wm: _dt.date,
                   create_col: str = "create_dt", update_col: str = "update_dt") -> DataFrame:
    """``taken`` after ``batch``, for the new marks: what bears one of their dates."""
    new = batch.select(row_digest(batch).alias("row_digest"), F.col(create_col).alias("create_dt"),
                       F.col(update_col).alias("update_dt"))
    return (taken.unionByName(new)
            .where((F.col("create_dt") >= F.lit(create_wm)) | (F.col("update_dt") >= F.lit(update_wm)))
            .distinct())


def key_snapshot(src: DataFrame, key: str) -> DataFrame:
    """Full key-only snapshot for deletion detection (column pruning makes
    the scan read the key alone). Not de-duplicated: an anti-join does not
    care, and a downstream ``groupBy`` pre-aggregates map-side."""
    return src.select(key)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Source → target column names."""
    return df.withColumnsRenamed(mapping)
