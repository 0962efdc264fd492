"""Registered queries of the operators that follow change instead of size: facts by
set of days, versions in force, late changes, digests of key buckets, exact marks,
hot keys."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.operators import digests, facts, late, maintained, scd2, sequence, spread
from fraudmart.operators.context import transaction_context
from fraudmart.plans.sizing import scratch
from fraudmart.schemas import CLIENTS, TRANSACTIONS, TXN_SEPARATOR, TXN_TIME_FORMAT, DimSpec
from fraudmart.sources import extract
from fraudmart.sources import fixtures as fx

FIXTURE_DIM = DimSpec("fixture", "k", ("a", "b"), new_from="update_dt", change_from="update_dt")


def fact_append_days(spark, d) -> DataFrame:
    """A day's batch with some operations of a day long past, against a fact stored by day."""
    path = scratch(spark, "fact-days")
    loaded = fx.transactions_loaded(spark, d).withColumn("trans_dt", F.to_date("trans_date"))
    loaded.write.partitionBy("trans_dt").parquet(path)
    schema = fx.transactions(spark, d).limit(0).withColumn("trans_dt", F.lit(None).cast("date")).schema
    fact = spark.read.schema(schema).parquet(path)
    t = fx.transactions(spark, d)
    day, late_row = F.to_date("trans_date"), F.col("trans_id").cast("bigint") % 5 == 0
    batch = t.where((day == F.lit(_dt.date(2024, 1, 28)))
                    | ((day == F.lit(_dt.date(2024, 1, 3))) & late_row))
    return facts.append_transactions(batch, fact).select(*TRANSACTIONS.fieldNames())


def many_versions(version_join: str):
    return lambda spark, d: transaction_context(
        fx.clients_many_versions(spark, d), fx.accounts_versions(spark, d),
        fx.cards_versions(spark, d), fx.transactions(spark, d), fx.terminals_daily(spark, d),
        fx.REPORT_RUN_DATE, "as_of", version_join)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a daily run would hand it to the next day: written and read back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def late_history(spark, d, order=("1", "late", "3", "2")) -> DataFrame:
    """Clients' history after their deliveries in the given order."""
    hist = spark.createDataFrame([], CLIENTS.schema)
    log = spark.createDataFrame([], late.log_schema(CLIENTS))
    for n in order:
        stage = (fx.late_clients(spark, d) if n == "late"
                 else fx.dimension_day(spark, d, "clients", int(n))[0])
        hist, new = late.apply_late(hist, log, stage, CLIENTS, fx.REPORT_RUN_DATE)
        hist, log = kept(hist, "late-history"), log.unionByName(kept(new, "late-log"))
    return hist


def deleted_by_digest(spark, d) -> DataFrame:
    """Day 2's deletions, from the digests that day 1 left."""
    first, second = fx.scd2_day(spark, d, 1), fx.scd2_day(spark, d, 2)
    empty = first.limit(0).select("k", "a", "b", F.col("update_dt").alias("effective_from"),
                                  F.col("update_dt").alias("effective_to"),
                                  F.lit("N").alias("deleted_flg"))
    hist = scd2.scd2_apply(empty, first, FIXTURE_DIM, fx.scd2_load_date(1), first.select("k"))
    left = digests.digests(first.select("k"), "k")
    # the day's own changes come first, as in the daily step
    hist = scd2.scd2_apply(hist, second, FIXTURE_DIM, fx.scd2_load_date(2))
    return digests.deleted_by_digest(hist, second.select("k"), left, FIXTURE_DIM, fx.scd2_load_date(2))


def boundary_extracts(spark, d) -> DataFrame:
    """Three extracts of a source whose rows also come in late on the mark's own date."""
    create = update = fx.EPOCH_DATE
    taken = spark.createDataFrame([], extract.TAKEN)
    out = None
    for step in (1, 2, 3):
        batch = extract.boundary_extract(fx.orders_visible(spark, d, step), create, update, taken)
        top = batch.agg(F.max("create_dt").alias("c"), F.max("update_dt").alias("u")).first()
        create, update = max(create, top.c or create), max(update, top.u or update)
        taken = extract.taken_at_marks(batch, taken, create, update)
        part = batch.withColumn("step", F.lit(step))
        out = part if out is None else out.unionByName(part)
    return out


def hot_context(spark, d, share: float = 0.05) -> DataFrame:
    """The context of operations of which a third are on one card, a third at one terminal."""
    t = fx.transactions_hot(spark, d)
    return transaction_context(
        fx.clients_hist(spark, d), fx.accounts_hist(spark, d), fx.cards_hist(spark, d), t,
        fx.terminals_hist(spark, d), fx.REPORT_RUN_DATE,
        hot_card=spread.hot_keys(t, "card_num", share),
        hot_terminal=spread.hot_keys(t, "terminal", share))


def streamed_terminals(spark, d) -> DataFrame:
    """Two terminal snapshots, each a file of a day, streamed into history."""
    from fraudmart.streaming import terminals

    root = scratch(spark, "stream-terminals")
    for n, day in ((1, "16012024"), (2, "31012024")):
        (fx.terminals_snapshot(spark, d, n).repartition(1).write.option("header", True)
         .csv(f"{root}/landing/terminals_{day}"))
    terminals.ingest_snapshots(spark, f"{root}/landing/*", f"{root}/out", f"{root}/checkpoint",
                               name_filter="*.csv")
    return terminals.history_after(spark, f"{root}/out")


def spelled_drop(operations: DataFrame) -> DataFrame:
    """Operations as a drop file spells them."""
    return operations.select(
        F.col("trans_id").alias("transaction_id"),
        F.date_format("trans_date", TXN_TIME_FORMAT).alias("transaction_date"),
        F.replace(F.col("amt").cast("string"), F.lit("."), F.lit(",")).alias("amount"),
        "card_num", "oper_type", "oper_result", "terminal")


def three_drops(spark, d) -> list[DataFrame]:
    """The operations up to the 10th, the 12th and after; every seventh of the 9th and 10th
    comes in late, with the third drop. The last operation, a month on and of a card that
    nobody owns, moves the time past all others."""
    t = fx.transactions(spark, d)
    day, e = F.dayofmonth("trans_date"), F.col("trans_id").cast("bigint")
    late_row = day.isin(9, 10) & (e % 7 == 0)
    mark = t.orderBy(e).limit(1).withColumns({
        "card_num": F.lit("0"), "trans_date": F.lit(_dt.datetime(2024, 3, 1)).cast("timestamp_ntz")})
    return [t.where((day <= 10) & ~late_row), t.where(day.isin(11, 12)),
            t.where((day > 12) | late_row | day.isNull()), mark]


def streamed_events(spark, d) -> DataFrame:
    """The four rules on a stream of drops, one of them late."""
    from fraudmart.streaming import rules as srules

    root = scratch(spark, "stream-events")
    dims = {"clients": fx.clients_hist(spark, d), "accounts": fx.accounts_hist(spark, d),
            "cards": fx.cards_hist(spark, d), "terminals": fx.terminals_hist(spark, d)}
    for n, rows in enumerate(three_drops(spark, d), 1):
        spelled_drop(rows).write.option("header", True).option("sep", TXN_SEPARATOR).csv(
            f"{root}/landing/transactions_{n}")
        srules.detect_available(spark, f"{root}/landing/*", f"{root}/out", f"{root}/checkpoint", dims,
                                fx.blacklist(spark, d), fx.REPORT_RUN_DATE, delay="3 days",
                                name_filter="*.csv")
    return srules.events_so_far(spark, f"{root}/out")


def maintained_lead_lag(spark, d) -> DataFrame:
    """Lead/lag after five batches of six days each; some operations of the first six days
    come in with the third and the fifth batch."""
    from fraudmart.plans.queries import report_context

    ctx = report_context(spark, d)
    e, day = F.col("trans_id").cast("bigint"), F.dayofmonth("trans_date")
    period = F.least(F.floor((day - 1) / 6), F.lit(4)) + 1
    batch = F.when((period == 1) & (e % 53 == 0), F.lit(3)).when(
        (period == 1) & (e % 59 == 0), F.lit(5)).otherwise(period)
    ctx = kept(ctx.withColumn("_batch", batch), "steps-input")
    empty = maintained.named(sequence.card_sequence(ctx.drop("_batch").limit(0)), 0)
    rows, tail = empty, empty
    replaced = empty.select(*maintained.NAME)
    for n in range(1, 6):
        new = kept(maintained.named(ctx.where(F.col("_batch") == n).drop("_batch"), n), "steps-new")
        step = maintained.advance(rows, tail, new, n, replaced)
        rows = rows.unionByName(kept(step.rows, "steps-rows"))
        replaced = replaced.unionByName(kept(step.replaced, "steps-replaced"))
        tail = kept(step.tail, "steps-tail")
    return maintained.current(rows, replaced).drop(*maintained.NAME)


def registry():
    return {
        "txn_lead_lag_maintained": maintained_lead_lag,
        "stream_terminals_history": streamed_terminals,
        "stream_fraud_events": streamed_events,
        "fact_transactions_append_days": fact_append_days,
        "context_many_versions_as_of": many_versions("sorted"),
        "scd2_late_changes": late_history,
        "scd2_deleted_by_digest": deleted_by_digest,
        "extract_boundary": boundary_extracts,
        "context_hot_keys": hot_context,
    }
