"""§2.10: terminal snapshots as a stream into type-2 history.

Each file is a full snapshot, so a micro-batch takes one file
(``maxFilesPerTrigger=1``, oldest first) and is one SCD2 day: its date is the
``ddMMyyyy`` of the file's name, or the day the file was written. The batch id makes
it idempotent: a batch writes what it closed and the open slice after it under
``batch_id=<id>`` with overwrite, and begins from the batch before it, never from
its own output. A batch that runs again after a failure therefore replaces itself
and changes nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fraudmart.functions.columns import is_open
from fraudmart.operators import scd2
from fraudmart.schemas import TERMINALS
from fraudmart.sources import drops

DROP_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TERMINALS.columns])
_STORED = T.StructType([*TERMINALS.schema.fields, T.StructField("batch_id", T.LongType()),
                        T.StructField("slice", T.StringType())])


def snapshot_date():
    """The date of the drop that a row came from."""
    named = F.try_to_date(F.regexp_extract("_path", r"_(\d{8})", 1), "ddMMyyyy")
    return F.coalesce(named, F.to_date("_file_time"))


def read_snapshot_stream(spark: SparkSession, landing: str, sep: str = ",",
                         name_filter: str = "*terminals*") -> DataFrame:
    """Text rows of every new snapshot, one file a batch, with path and time of the file."""
    return (spark.readStream.format("csv").schema(DROP_SCHEMA).option("header", True)
            .option("enforceSchema", False).option("sep", sep).option("pathGlobFilter", name_filter)
            .option("maxFilesPerTrigger", 1).load(landing)
            .withColumns({"_path": F.col("_metadata.file_path"),
                          "_file_time": F.col("_metadata.file_modification_time")}))


def history_after(spark: SparkSession, root: str, batch_id: int | None = None) -> DataFrame:
    """The history after a batch (the newest if None): what every batch up to it closed, and
    the open slice of the last of them."""
    try:
        stored = spark.read.schema(_STORED).parquet(f"{root.rstrip('/')}/history")
    except Exception as e:  # noqa: BLE001 - no batch written yet
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], TERMINALS.schema)
        raise
    if batch_id is not None:
        stored = stored.where(F.col("batch_id") <= batch_id)
    newest = stored.where("slice = 'open'").agg(F.max("batch_id")).scalar()
    return stored.where((F.col("slice") == "closed") | (F.col("batch_id") == newest)).select(
        *TERMINALS.history_columns)


def snapshot_applier(spark: SparkSession, root: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: one snapshot, one SCD2 day."""
    base = root.rstrip("/")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        path = f"{base}/parsed/batch_id={batch_id}"
        parsed = drops.parse_terminals(batch, snapshot_date())
        parsed.write.mode("overwrite").parquet(path)
        parsed = spark.read.schema(parsed.schema).parquet(path)
        day = parsed.agg(F.max("update_dt")).first()[0]
        if day is None:   # a file without rows is no snapshot
            return
        before = history_after(spark, root, batch_id - 1)
        stage = drops.with_file_order(drops.good(parsed))
        touched = scd2.scd2_touched(before, stage, TERMINALS, day, drops.terminal_keys(parsed))
        (touched.withColumn("slice", F.when(is_open(), F.lit("open")).otherwise(F.lit("closed")))
         .select(*TERMINALS.history_columns, "slice").write.mode("overwrite").partitionBy("slice")
         .parquet(f"{base}/history/batch_id={batch_id}"))

    return on_batch


def ingest_snapshots(spark: SparkSession, landing: str, root: str, checkpoint: str, sep: str = ",",
                     name_filter: str = "*terminals*") -> StreamingQuery:
    """Applies every snapshot that has arrived, oldest first, then stops."""
    q = (read_snapshot_stream(spark, landing, sep, name_filter)
         .writeStream.foreachBatch(snapshot_applier(spark, root))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
