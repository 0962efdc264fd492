"""§2.10: exactly-once-per-file ingestion of the daily drops with Structured
Streaming.

The file source remembers every file it has processed in its checkpoint, so
a re-dropped file with an already seen name is ignored (the batch reader does
the same with the ledger). ``trigger(availableNow=True)`` processes
everything that has arrived and stops, so a daily scheduler can run it like a
batch job; ``cleanSource='archive'`` moves processed files to an archive
folder (the source system's backup step) — Spark does this lazily, a batch
after the file was processed.

Each micro-batch is parsed (bad rows → quarantine) and appended to the fact
with the same anti-join as the batch path (F1/F2), so a file that slips
through the seen-file memory (bounded by ``maxFileAge``) still adds no
duplicate. Output of a micro-batch is written to a directory named after its
batch id with overwrite, so a batch re-run after a failure replaces its own
output instead of appending twice.

A streaming file source needs its schema up front, so drop columns are read
in the documented order and ``enforceSchema=false`` makes Spark check each
file's header against it (a file with other columns fails instead of being
read positionally into the wrong fields).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fraudmart.operators import facts
from fraudmart.schemas import (
    BLACKLIST, BLACKLIST_DROP_COLUMNS, DROP_BLACKLIST, DROP_TRANSACTIONS, TRANSACTIONS,
    TRANSACTIONS_DROP_COLUMNS, TXN_SEPARATOR,
)
from fraudmart.sources import drops

DROP_COLUMNS = {DROP_TRANSACTIONS: TRANSACTIONS_DROP_COLUMNS, DROP_BLACKLIST: BLACKLIST_DROP_COLUMNS}
PARSERS = {DROP_TRANSACTIONS: drops.parse_transactions, DROP_BLACKLIST: drops.parse_blacklist}
FACT_SCHEMA = {DROP_TRANSACTIONS: TRANSACTIONS, DROP_BLACKLIST: BLACKLIST}


def read_drop_stream(spark: SparkSession, landing: str, kind: str, sep: str | None = None,
                     archive_dir: str | None = None,
                     max_files_per_trigger: int | None = None,
                     name_filter: str | None = "kind") -> DataFrame:
    """Parsed rows (with ``_error``) of every new ``*<kind>*`` file
    (``name_filter=None``: every file of a folder dedicated to one kind)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in DROP_COLUMNS[kind]])
    r = (spark.readStream.format("csv").schema(schema)
         .option("header", True).option("enforceSchema", False)
         .option("sep", sep or (TXN_SEPARATOR if kind == DROP_TRANSACTIONS else ",")))
    if name_filter:
        r = r.option("pathGlobFilter", f"*{kind}*" if name_filter == "kind" else name_filter)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.load(landing).withColumns({"_file": F.col("_metadata.file_name"),
                                       "_file_time": F.col("_metadata.file_modification_time")})
    return PARSERS[kind](raw)


def fact_appender(spark: SparkSession, fact_root: str, kind: str,
                  dedupe_on: tuple[str, ...] = ("trans_id", "trans_date")
                  ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: anti-join the batch against the fact written so
    far and write the new rows (and the quarantined ones) under
    ``batch_id=<id>``."""
    schema = FACT_SCHEMA[kind]
    fact_path = f"{fact_root.rstrip('/')}/fact"

    def load_fact(exclude_batch: int) -> DataFrame:
        read_schema = _fact_read_schema(kind)
        try:
            df = spark.read.schema(read_schema).parquet(fact_path)
        except Exception as e:  # noqa: BLE001 - no batch written yet
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                return spark.createDataFrame([], schema)
            raise
        keep = [c for c in read_schema.fieldNames() if c != "batch_id"]
        return df.where(F.col("batch_id") != exclude_batch).select(*keep)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # written once under the batch's id: its days, the anti-join and the quarantine all
        # read this, so a drop is parsed once; a batch that runs again overwrites it
        path = f"{fact_root.rstrip('/')}/parsed/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        parsed = spark.read.schema(batch.schema).parquet(path)
        good = drops.good(parsed).select(*schema.fieldNames())
        existing = load_fact(batch_id)
        if kind == DROP_TRANSACTIONS:
            # trans_dt partitions: the batch's time range prunes the fact read
            new = (facts.append_transactions(good, existing, dedupe_on)
                   .withColumn("trans_dt", F.to_date("trans_date")))
            new.write.mode("overwrite").partitionBy("trans_dt").parquet(
                f"{fact_path}/batch_id={batch_id}")
        else:
            new = facts.append_blacklist(good, existing.select(*schema.fieldNames()))
            new.write.mode("overwrite").parquet(f"{fact_path}/batch_id={batch_id}")
        bad = drops.quarantine(parsed).select(F.to_json(F.struct("*")).alias("row"))
        bad.write.mode("overwrite").parquet(
            f"{fact_root.rstrip('/')}/quarantine/batch_id={batch_id}")

    return on_batch


def ingest_available(spark: SparkSession, landing: str, kind: str, fact_root: str,
                     checkpoint: str, archive_dir: str | None = None,
                     dedupe_on: tuple[str, ...] = ("trans_id", "trans_date"),
                     name_filter: str | None = "kind") -> StreamingQuery:
    """Process every drop that has arrived, then stop (``availableNow``)."""
    q = (read_drop_stream(spark, landing, kind, archive_dir=archive_dir, name_filter=name_filter)
         .writeStream.foreachBatch(fact_appender(spark, fact_root, kind, dedupe_on))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q


def _fact_read_schema(kind: str) -> T.StructType:
    extra = [T.StructField("batch_id", T.LongType())]
    if kind == DROP_TRANSACTIONS:
        extra.append(T.StructField("trans_dt", T.DateType()))
    return T.StructType(list(FACT_SCHEMA[kind].fields) + extra)


def read_fact(spark: SparkSession, fact_root: str, kind: str) -> DataFrame:
    return spark.read.schema(_fact_read_schema(kind)).parquet(f"{fact_root.rstrip('/')}/fact")
