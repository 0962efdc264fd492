"""§2.10: the four rules on the stream of operations.

An operation's neighbours may still be on their way when it arrives, so operations wait, by
card and time bucket, in the state of a streaming aggregation until the event-time watermark
has passed all that their rules can reach. Each operation is copied into the neighbouring
buckets that have it within their reach, as in ``sequence.rule_frame``; a bucket closes when
the newest operation seen is at least ``delay`` past the bucket's end and the reach of rule 3.
A closed bucket leaves the state and its events are those of the batch rules, computed with
the same windows; so what the state holds is bounded by ``delay``, the reach and the bucket,
not by the history. An operation that comes in late by ``delay`` or less is never lost; one
whose bucket has closed is dropped by the watermark and counted in the query's progress
(``numRowsDroppedByWatermark``).

A pairwise self-join within the limit of rule 3 is not the same rule: it asks for the *next*
operation, and pairs of a busy card grow with the square of an hour.

The operations of one card and bucket are spread over ``splits`` rows of state, so that no row
of state holds a hot card alone; ``bucket_seconds`` narrows the bucket.

Owners and terminals are those known when an operation arrives. The owner's join comes after the
watermark, so an operation of an unknown card moves the time on too.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fraudmart.operators.context import transaction_context
from fraudmart.operators.rules import EVENT_COLUMNS, events_of_frame
from fraudmart.operators.sequence import (
    DAY_SECONDS, WINDOW_INPUTS, frame_of_buckets, halo_copies, reach_seconds,
)
from fraudmart.schemas import (
    AMOUNT_GUESS_LIMIT, DROP_TRANSACTIONS, EVENT_TWO_CITIES, FRAUD_REPORT, TWO_CITIES_LIMIT,
)
from fraudmart.sources import drops
from fraudmart.streaming.drops import read_drop_stream

_STORED = T.StructType([*FRAUD_REPORT.fields, T.StructField("batch_id", T.LongType())])
_BUCKET = ("home_bucket", "bucket")


def closed_buckets(operations: DataFrame, dimensions: dict[str, DataFrame], run_date: _dt.date,
                   delay: str, history: str = "all", two_cities_limit: str = TWO_CITIES_LIMIT,
                   amount_guess_limit: str = AMOUNT_GUESS_LIMIT,
                   bucket_seconds: int = DAY_SECONDS, splits: int = 8) -> DataFrame:
    """Streaming ``operations`` → one row per closed (card, bucket, split) with its context
    rows as the array ``ops``. ``dimensions``: clients, accounts, cards, terminals histories."""
    lead_s, lag_s = reach_seconds(two_cities_limit), reach_seconds(amount_guess_limit)
    # rule 3 of a bucket reads up to lead_s past its end
    closes_at = F.timestamp_seconds((F.col("bucket") + 1) * bucket_seconds + lead_s)
    # the newest closes_at is at most a bucket and both reaches ahead of the newest operation
    wait = reach_seconds(delay) + bucket_seconds + lead_s + lag_s
    waiting = (halo_copies(operations, lead_s, lag_s, bucket_seconds)
               .withColumn("closes_at", closes_at).withWatermark("closes_at", f"{wait} seconds"))
    ctx = transaction_context(dimensions["clients"], dimensions["accounts"], dimensions["cards"],
                              waiting, dimensions["terminals"], run_date, history,
                              version_join="range", carry=("closes_at", *_BUCKET))
    split = F.pmod(F.xxhash64("trans_id", "trans_date"), F.lit(splits)).alias("split")
    return (ctx.groupBy("card_num", "closes_at", split)
            .agg(F.collect_list(F.struct(*WINDOW_INPUTS, *_BUCKET)).alias("ops")))


def event_writer(spark: SparkSession, root: str, blacklist: DataFrame,
                 two_cities_limit: str = TWO_CITIES_LIMIT,
                 amount_guess_limit: str = AMOUNT_GUESS_LIMIT) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: the events of the buckets that this batch closed, under
    ``batch_id=<id>`` with overwrite, so a batch that runs again replaces its own."""
    base = root.rstrip("/")

    def on_batch(closed: DataFrame, batch_id: int) -> None:
        path = f"{base}/closed/batch_id={batch_id}"
        rows = closed.select(F.explode("ops").alias("op")).select("op.*")
        rows.write.mode("overwrite").parquet(path)   # the state is read once
        rows = spark.read.schema(rows.schema).parquet(path).repartition("card_num", "bucket")
        frame = frame_of_buckets(rows, reach_seconds(two_cities_limit))
        (events_of_frame(frame, blacklist, amount_guess_limit).select(*EVENT_COLUMNS)
         .write.mode("overwrite").parquet(f"{base}/events/batch_id={batch_id}"))

    return on_batch


def events_so_far(spark: SparkSession, root: str) -> DataFrame:
    """The events of all buckets closed so far. Rule 3 reports a client's latest qualifying
    operation, here the latest over the batches."""
    try:
        stored = spark.read.schema(_STORED).parquet(f"{root.rstrip('/')}/events")
    except Exception as e:  # noqa: BLE001 - no batch written yet
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], FRAUD_REPORT)
        raise
    by_client = F.col("event_type") == EVENT_TWO_CITIES
    latest = (stored.where(by_client).groupBy("passport", "fio", "phone", "event_type")
              .agg(F.max("event_dt").alias("event_dt"), F.max("report_dt").alias("report_dt")))
    return stored.where(~by_client).select(*EVENT_COLUMNS).unionByName(latest)


def detect_available(spark: SparkSession, landing: str, root: str, checkpoint: str,
                     dimensions: dict[str, DataFrame], blacklist: DataFrame, run_date: _dt.date,
                     delay: str, name_filter: str | None = "kind", **options) -> StreamingQuery:
    """Takes every drop of operations that has arrived, writes the events of the buckets that
    close, then stops; the others wait in the checkpoint for the next call. ``options`` as in
    ``closed_buckets``."""
    limits = {k: options[k] for k in ("two_cities_limit", "amount_guess_limit") if k in options}
    operations = drops.good(read_drop_stream(spark, landing, DROP_TRANSACTIONS,
                                             name_filter=name_filter))
    q = (closed_buckets(operations, dimensions, run_date, delay, **options)
         .writeStream.outputMode("append").foreachBatch(event_writer(spark, root, blacklist, **limits))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
