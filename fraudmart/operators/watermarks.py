"""K6, M1, M2: the extract high-water marks.

Batch maxima are one scalar subquery (partial + final aggregate), so
advancing a watermark never collects the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.schemas import EPOCH_DATE, WATERMARKS

# Sources tracked by default: (schema, table, has create_dt).
DEFAULT_SOURCES = (
    ("mart", "terminals", False),
    ("mart", "cards", True),
    ("mart", "accounts", True),
    ("mart", "clients", True),
)


def init_watermarks(spark: SparkSession, sources=DEFAULT_SOURCES) -> DataFrame:
    """Bootstrap rows at 1000-01-01; a snapshot source (no create date) only
    gets an update watermark."""
    rows = [(s, t, EPOCH_DATE if has_create else None, EPOCH_DATE) for s, t, has_create in sources]
    return spark.createDataFrame(rows, WATERMARKS)


def advance_watermark(ctrl: DataFrame, batch: DataFrame, table_name: str,
                      create_col: str | None = "create_dt", update_col: str = "update_dt",
                      monotone: bool = True) -> DataFrame:
    """New control table after a batch of ``table_name``.

    The source system sets the mark to ``coalesce(max(batch), old)``, so a
    batch holding only updates of old rows can move the create mark
    *backwards*. ``monotone=True`` (default) keeps ``greatest(old, new)``
    instead; ``monotone=False`` reproduces the source system.
    An empty batch leaves the marks unchanged either way.
    """
    this = F.col("table_name") == table_name
    # both maxima in one aggregate over the batch (one scan)
    cols = {"c": create_col, "u": update_col}
    maxima = batch.agg(F.struct(*[(F.max(c) if c else F.lit(None).cast("date")).alias(k)
                                  for k, c in cols.items()])).scalar()

    def advanced(old: str, col: str | None, field: str):
        if col is None:
            return F.col(old)
        new = maxima.getField(field)
        value = F.greatest(F.col(old), new) if monotone else F.coalesce(new, F.col(old))
        return F.when(this, value).otherwise(F.col(old))

    return ctrl.select(
        "schema_name", "table_name",
        advanced("max_create_dt", create_col, "c").alias("max_create_dt"),
        advanced("max_update_dt", update_col, "u").alias("max_update_dt"),
    )
