"""Registered queries: name → callable(spark, sf_dir) -> DataFrame.

Each query derives its inputs from the driver's tables (``sources.fixtures``)
and runs one operator (or the whole daily step) on them. Output columns carry
the same names and types as the matching SQL in ``oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import datetime as _dt

from fraudmart.operators import facts, report, rules, scd2, watermarks
from fraudmart.operators.context import transaction_context
from fraudmart.operators.sequence import card_sequence
from fraudmart.plans import change_queries
from fraudmart.plans.sizing import scratch
from fraudmart.schemas import DIMENSIONS, TRANSACTIONS, TXN_SEPARATOR, WATERMARKS, DimSpec
from fraudmart.sources import drops, extract
from fraudmart.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def report_context(spark: SparkSession, sf_dir: str, history: str = "all",
                   with_copies: bool = False) -> DataFrame:
    txns = (fx.transactions_with_copies if with_copies else fx.transactions)(spark, sf_dir)
    return transaction_context(
        fx.clients_hist(spark, sf_dir), fx.accounts_hist(spark, sf_dir),
        fx.cards_hist(spark, sf_dir), txns,
        fx.terminals_hist(spark, sf_dir), fx.REPORT_RUN_DATE, history=history)


def _context(history):
    return lambda spark, d: report_context(spark, d, history)


def _txn_lead_lag(spark, d):
    return card_sequence(report_context(spark, d))


def _rule_passport(spark, d):
    return rules.rule_passport(report_context(spark, d), fx.blacklist(spark, d))


def _rule_contract(spark, d):
    return rules.rule_contract_expired(report_context(spark, d))


def _rule_two_cities(limit):
    return lambda spark, d: rules.rule_two_cities(report_context(spark, d), limit)


def _rule_amount(history):
    return lambda spark, d: rules.rule_amount_guessing(report_context(spark, d, history))


def _fraud_events(history, with_copies=False, copies="keep", since=None):
    return lambda spark, d: rules.fraud_events(report_context(spark, d, history, with_copies),
                                               fx.blacklist(spark, d), copies=copies, since=since)


def midnight_context(spark: SparkSession, sf_dir: str, history: str = "all") -> DataFrame:
    """Owners with several versions, operations on both sides of midnight."""
    return transaction_context(
        fx.clients_versions(spark, sf_dir), fx.accounts_versions(spark, sf_dir),
        fx.cards_versions(spark, sf_dir), fx.transactions_midnight(spark, sf_dir),
        fx.terminals_hist(spark, sf_dir), fx.REPORT_RUN_DATE, history=history)


def _midnight_events(history: str = "all", **options):
    return lambda spark, d: rules.fraud_events(midnight_context(spark, d, history),
                                               fx.blacklist(spark, d), **options)


SINCE = _dt.datetime(2024, 1, 20, 0, 10)   # inside a day's burst of operations


# --- SCD2 days ------------------------------------------------------------------
FIXTURE_DIM = DimSpec("fixture", "k", ("a", "b"), new_from="update_dt", change_from="update_dt")
HIST_COLS = FIXTURE_DIM.history_columns


def _day_inputs(spark, d, day):
    stage = fx.scd2_day(spark, d, day)
    return stage, stage.select("k"), fx.scd2_load_date(day)


def scd2_history(spark, d, day: int, last_snapshot: bool = True,
                 missing_snapshot: str = "skip") -> DataFrame:
    """History after applying days 1..day, each with its full key snapshot
    (the last one optionally without)."""
    first, _, _ = _day_inputs(spark, d, 1)
    hist = first.limit(0).select("k", "a", "b", F.col("update_dt").alias("effective_from"),
                                 F.col("update_dt").alias("effective_to"),
                                 F.lit("N").alias("deleted_flg"))
    for n in range(1, day + 1):
        stage, keys, run = _day_inputs(spark, d, n)
        keys = keys if (n < day or last_snapshot) else None
        hist = scd2.scd2_apply(hist, stage, FIXTURE_DIM, run, keys, missing_snapshot)
    return hist


def _scd2_step(step, day):
    def q(spark, d):
        before = scd2_history(spark, d, day - 1)
        stage, keys, run = _day_inputs(spark, d, day)
        if step == "new":
            return scd2.scd2_new(before, stage, FIXTURE_DIM)
        if step == "changed":
            return scd2.scd2_changed(before, stage, FIXTURE_DIM)
        if step == "closed":
            return scd2.scd2_closed(before, stage, FIXTURE_DIM)
        if step == "resurrected":
            return scd2.scd2_resurrected(before, stage, FIXTURE_DIM)
        if step in ("deleted", "close_deleted"):
            # D5/D6 run after D1-D3 of the same day
            after_changes = scd2.scd2_apply(before, stage, FIXTURE_DIM, run, keys=None)
            op = scd2.scd2_tombstones if step == "deleted" else scd2.scd2_close_deleted
            return op(after_changes, keys, FIXTURE_DIM, run)
        if step == "changes":
            touched = scd2.scd2_touched(before, stage, FIXTURE_DIM, run, keys)
            return (touched.groupBy("change")
                    .agg(F.countDistinct("k").alias("keys"), F.count(F.lit(1)).alias("rows")))
        raise ValueError(step)
    return q


def _scd2_apply(day, last_snapshot=True, missing="skip", open_only=False):
    def q(spark, d):
        h = scd2_history(spark, d, day, last_snapshot, missing)
        return h.where(F.col("effective_to") == F.lit(fx.OPEN_DATE)) if open_only else h
    return q


def _scd2_dimension(name: str, day: int, null_update: str = "coalesce"):
    """History of a relational dimension after its days with create and update dates."""
    def q(spark, d):
        spec = DIMENSIONS[name]
        hist = spark.createDataFrame([], spec.schema)
        for n in range(1, day + 1):
            stage, keys, load = fx.dimension_day(spark, d, name, n)
            hist = scd2.scd2_apply(hist, stage, spec, load, keys, null_update=null_update)
        return hist
    return q


def _duplicate_stage(spark, d):
    """Three deliveries of every third supplier in one batch: the latest update wins."""
    stage = fx.scd2_day(spark, d, 1)
    again = stage.where(F.col("k") % 3 == 0)
    older = again.withColumns({"b": F.lit("zzz"), "update_dt": F.date_sub("update_dt", 5)})
    newer = again.withColumns({"b": F.lit("AAA"), "update_dt": F.date_add("update_dt", 5)})
    batch = stage.unionByName(older).unionByName(newer)
    empty = stage.limit(0).select("k", "a", "b", F.col("update_dt").alias("effective_from"),
                                  F.col("update_dt").alias("effective_to"),
                                  F.lit("N").alias("deleted_flg"))
    return batch, scd2.scd2_apply(empty, batch, FIXTURE_DIM, fx.scd2_load_date(1))


# --- report append ----------------------------------------------------------------

def _report_append(existing: str, report_dt: _dt.date = fx.REPORT_RUN_DATE):
    def q(spark, d):
        events = rules.fraud_events(report_context(spark, d, "all"), fx.blacklist(spark, d))
        old = rules.fraud_events(report_context(spark, d, existing), fx.blacklist(spark, d))
        rep = report.report_rows(old).withColumn("report_dt", F.lit(report_dt))
        return report.append_report(events, rep, fx.REPORT_RUN_DATE)
    return q


# --- extract and watermarks -----------------------------------------------------
LATE_WM = _dt.date(2001, 8, 1)


def _extract(wm: _dt.date):
    return lambda spark, d: extract.incremental_extract(fx.orders_source(spark, d), wm, wm)


def _extract_keys(spark, d):
    return extract.key_snapshot(fx.orders_source(spark, d), "k")


def _ctrl_after_batch(spark, d, monotone: bool):
    """Control table with the default sources plus 'orders' at 2001-08-01,
    advanced by the orders batch extracted at that watermark."""
    rows = [(s, t, LATE_WM if t == "orders" else (fx.EPOCH_DATE if c else None),
             LATE_WM if t == "orders" else fx.EPOCH_DATE)
            for s, t, c in (*watermarks.DEFAULT_SOURCES, ("mart", "orders", True))]
    ctrl = spark.createDataFrame(rows, WATERMARKS)
    wc, wu = extract.read_watermark(ctrl, "orders")
    batch = extract.incremental_extract(fx.orders_source(spark, d), wc, wu)
    return watermarks.advance_watermark(ctrl, batch, "orders", monotone=monotone)


def _watermark(monotone: bool):
    return lambda spark, d: _ctrl_after_batch(spark, d, monotone)


def _watermark_read(spark, d):
    return extract.watermark_values(_ctrl_after_batch(spark, d, False))


# --- facts and drops ------------------------------------------------------------------

def _fact_txn(dedupe_on):
    return lambda spark, d: facts.append_transactions(
        fx.transactions_batch(spark, d), fx.transactions_loaded(spark, d), dedupe_on)


def _fact_blacklist(keep):
    return lambda spark, d: facts.append_blacklist(
        fx.blacklist_batch(spark, d), fx.blacklist_loaded(spark, d), keep)


def _txn_parse(spark, d):
    return drops.good(drops.parse_transactions(fx.transactions_drop_text(spark, d)))


def _txn_quarantine(spark, d):
    return drops.quarantine(drops.parse_transactions(fx.transactions_drop_text(spark, d)))


def _blacklist_read(spark, d):
    return drops.good(drops.parse_blacklist(fx.blacklist_drop_text(spark, d)))


def _drop_files(kind: str):
    """A drop delivered as two sets of files with their columns in different orders,
    written and read back by the batch reader."""
    def q(spark, d):
        if kind == "transactions":
            text, sep, key = fx.transactions_drop_text(spark, d), TXN_SEPARATOR, "transaction_id"
        else:
            text, sep, key = fx.blacklist_drop_text(spark, d), ",", "passport"
        half = F.crc32(F.col(key).cast("binary")) % 2 == 0
        root = scratch(spark, f"drop-{kind}")
        for i, (rows, cols) in enumerate(((text.where(half), text.columns),
                                          (text.where(~half), text.columns[::-1]))):
            (rows.select(*cols).write.option("header", True).option("sep", sep)
             .csv(f"{root}/{kind}_{i}"))
        paths = [f"{root}/{kind}_{i}" for i in (0, 1)]
        got = (drops.read_transactions(spark, paths) if kind == "transactions"
               else drops.read_blacklist(spark, paths))
        return drops.good(got).drop("_file", "_file_time")
    return q


def _drop_terminal_keys(spark, d):
    """Every fifth terminal arrives with a city that is too long: its row goes to
    quarantine, its key stays in the snapshot."""
    n = F.regexp_extract("terminal_id", r"(\\d+)", 1).cast("int")
    text = fx.terminals_snapshot(spark, d, 1).withColumn(
        "terminal_city", F.when(n % 5 == 0, F.repeat(F.lit("x"), 40)).otherwise(F.col("terminal_city")))
    return drops.terminal_keys(drops.parse_terminals(text, fx.REPORT_RUN_DATE))


# --- the whole daily run ------------------------------------------------------------

def _stream_ingest(kind: str):
    """§2.10: a drop written by Spark as several files, then ingested once
    with ``availableNow``; the result is the fact it built."""
    def q(spark, d):
        from fraudmart.schemas import DROP_TRANSACTIONS, TXN_SEPARATOR
        from fraudmart.streaming import drops as sdrops

        text = (fx.transactions_drop_text if kind == DROP_TRANSACTIONS
                else fx.blacklist_drop_text)(spark, d)
        sep = TXN_SEPARATOR if kind == DROP_TRANSACTIONS else ","
        root = scratch(spark, f"stream-{kind}")
        text.write.option("header", True).option("sep", sep).csv(f"{root}/landing")
        sdrops.ingest_available(spark, f"{root}/landing", kind, f"{root}/out",
                                f"{root}/checkpoint", name_filter="*.csv")
        return sdrops.read_fact(spark, f"{root}/out", kind).select(
            *sdrops.FACT_SCHEMA[kind].fieldNames())
    return q


def _daily_run(spark, d):
    """One run on an empty store under the session's checkpoint folder; the
    result is the published fraud report of the run."""
    from fraudmart.plans import daily

    root = scratch(spark, "daily-run")
    created = fx.REPORT_RUN_DATE - _dt.timedelta(days=16)
    src = daily.Sources(
        cards=fx.relational_source(fx.cards(spark, d), created, {"account_num": "account"}),
        accounts=fx.relational_source(fx.accounts(spark, d), created, {"account_num": "account"}),
        clients=fx.relational_source(fx.clients(spark, d), created, {}),
        terminals_drop=fx.terminals_drop_text(spark, d),
        blacklist_drop=fx.blacklist_drop_text(spark, d),
        transactions_drop=fx.transactions_drop_text(spark, d))
    daily.run_daily(spark, root, src, fx.REPORT_RUN_DATE, run_id="00000001")
    return daily.read_state(spark, root)["fraud_report"]


DAY1, DAY2 = _dt.date(2024, 1, 16), _dt.date(2024, 1, 31)
_TWO_DAYS: dict[tuple[str, str, bool], str] = {}


def two_day_store(spark, d, as_files: bool = False) -> str:
    """Two daily runs on one store (kept per application and input): on day 2 every fifth
    client has a new phone, terminals moved, T1 is gone, and the transactions drop
    delivers some of day 1 again. ``as_files``: the drops lie in a landing folder, where on
    day 2 those of day 1 lie too; no blacklist comes on day 2."""
    from fraudmart.plans import daily

    key = (spark.sparkContext.applicationId, d, as_files)
    if key in _TWO_DAYS:
        return _TWO_DAYS[key]
    root = scratch(spark, "daily-files" if as_files else "daily-two")
    text = fx.transactions_drop_text(spark, d)
    cut = {1: F.col("transaction_date") < "2024-01-16", 2: F.col("transaction_date") >= "2024-01-10"}
    for n, day in ((1, DAY1), (2, DAY2)):
        c = F.regexp_extract("client_id", r"(\d+)", 1).cast("bigint")
        changed = (c % 5 == 0) & F.lit(n == 2)
        clients = fx.clients(spark, d).withColumns({
            "phone": F.when(changed, F.concat("phone", F.lit("0"))).otherwise(F.col("phone")),
            "create_dt": F.lit(DAY1), "update_dt": F.when(changed, F.lit(DAY2))})
        handed = {"terminals": fx.terminals_snapshot(spark, d, n),
                  "passport_blacklist": fx.blacklist_drop_text(spark, d) if n == 1 else None,
                  "transactions": text.where(cut[n])}
        src = daily.Sources(
            cards=fx.relational_source(fx.cards(spark, d), DAY1, {"account_num": "account"}),
            accounts=fx.relational_source(fx.accounts(spark, d), DAY1, {"account_num": "account"}),
            clients=clients)
        if as_files:
            src.landing = f"{root}/landing"
            for kind, rows in handed.items():
                if rows is not None:
                    (rows.write.option("header", True)
                     .option("sep", TXN_SEPARATOR if kind == "transactions" else ",")
                     .csv(f"{src.landing}/{kind}_{n}.csv"))
        else:
            src.terminals_drop, src.blacklist_drop = handed["terminals"], handed["passport_blacklist"]
            src.transactions_drop = handed["transactions"]
        daily.run_daily(spark, root, src, day, run_id=f"{n:08d}")
    _TWO_DAYS[key] = root
    return root


def _two_days(table: str, *columns: str, as_files: bool = False):
    def q(spark, d):
        from fraudmart.plans import daily

        df = daily.read_state(spark, two_day_store(spark, d, as_files))[table]
        return df.select(*columns) if columns else df
    return q


def _files_read(spark, d):
    """Which drops each run read, by the ledger and the run's status."""
    from fraudmart.plans import daily

    state = daily.read_state(spark, two_day_store(spark, d, as_files=True))
    drop = F.regexp_extract("file_name", r"^([^/]+)/", 1)
    read = state["file_ledger"].select("kind", "run_id", drop.alias("drop")).distinct()
    return state["run_status"].select("kind", "run_id", "status").join(read, ["kind", "run_id"], "left")


def _run_figures(spark, d):
    """What the second run of two did, as counted while its tables were written."""
    from fraudmart.plans import daily

    figures = daily.read_state(spark, two_day_store(spark, d))["run_figures"]
    return figures.where("run_id = '00000002'").select("table", "figure", "value")


def registry() -> dict[str, Query]:
    return change_queries.registry() | {
        "daily_run": _daily_run,
        "daily_run_day2_report": _two_days("fraud_report"),
        "daily_run_day2_facts": _two_days("fact_transactions", *TRANSACTIONS.fieldNames()),
        "daily_run_day2_clients": _two_days("clients_hist"),
        "daily_run_day2_terminals": _two_days("terminals_hist"),
        "daily_run_day2_watermarks": _two_days("watermarks"),
        "daily_run_day2_figures": _run_figures,
        "daily_run_files_drops": _files_read,
        "daily_run_files_facts": _two_days("fact_transactions", *TRANSACTIONS.fieldNames(),
                                           as_files=True),
        "daily_run_files_blacklist": _two_days("fact_passport_blacklist", as_files=True),
        "daily_run_files_terminals": _two_days("terminals_hist", as_files=True),
        "drop_transactions_files": _drop_files("transactions"),
        "drop_blacklist_files": _drop_files("passport_blacklist"),
        "drop_terminal_keys": _drop_terminal_keys,
        **{f"scd2_{n}_day{k}": _scd2_dimension(n, k)
           for n in ("cards", "accounts", "clients") for k in (2, 3)},
        "scd2_clients_day2_raw": _scd2_dimension("clients", 2, "raw"),
        "scd2_duplicate_stage": lambda spark, d: _duplicate_stage(spark, d)[1],
        "scd2_duplicate_losers": lambda spark, d: scd2.duplicate_stage_rows(
            _duplicate_stage(spark, d)[0], FIXTURE_DIM).select("k", "a", "b", "update_dt"),
        "stream_ingest_transactions": _stream_ingest("transactions"),
        "stream_ingest_blacklist": _stream_ingest("passport_blacklist"),
        "extract_incremental": _extract(_dt.date(2001, 1, 1)),
        "extract_incremental_late": _extract(LATE_WM),
        "extract_keys": _extract_keys,
        "watermark_advance": _watermark(False),
        "watermark_advance_monotone": _watermark(True),
        "watermark_read": _watermark_read,
        "fact_transactions_append": _fact_txn(("trans_id", "trans_date")),
        "fact_transactions_append_by_time": _fact_txn(("trans_date",)),
        "fact_blacklist_append": _fact_blacklist("first"),
        "fact_blacklist_append_earliest": _fact_blacklist("earliest"),
        "transactions_parse": _txn_parse,
        "transactions_quarantine": _txn_quarantine,
        "blacklist_read": _blacklist_read,
        "fraud_report_append": _report_append("as_of"),
        "fraud_report_rerun": _report_append("all"),
        "fraud_report_next_day": _report_append("all", _dt.date(2024, 1, 31)),
        "scd2_new": _scd2_step("new", 2),
        "scd2_changed": _scd2_step("changed", 2),
        "scd2_closed": _scd2_step("closed", 2),
        "scd2_deleted": _scd2_step("deleted", 2),
        "scd2_resurrected": _scd2_step("resurrected", 3),
        "scd2_close_deleted": _scd2_step("close_deleted", 2),
        "scd2_changes_day2": _scd2_step("changes", 2),
        "scd2_changes_day3": _scd2_step("changes", 3),
        "blacklist_first_entry": lambda spark, d: rules.blacklist_first_entry(fx.blacklist(spark, d)),
        "scd2_apply_day1": _scd2_apply(1),
        "scd2_apply_day2": _scd2_apply(2),
        "scd2_apply_day3": _scd2_apply(3),
        "scd2_missing_snapshot_skip": _scd2_apply(2, last_snapshot=False, missing="skip"),
        "scd2_missing_snapshot_delete": _scd2_apply(2, last_snapshot=False, missing="delete"),
        "scd2_open_day3": _scd2_apply(3, open_only=True),
        "context_all": _context("all"),
        "context_as_of": _context("as_of"),
        "txn_lead_lag": _txn_lead_lag,
        "rule_passport": _rule_passport,
        "rule_contract_expired": _rule_contract,
        "rule_two_cities": _rule_two_cities("1 hour"),
        "rule_two_cities_2days": _rule_two_cities("2 days"),
        "rule_two_cities_1min": _rule_two_cities("1 minute"),
        "rule_amount_guessing": _rule_amount("all"),
        "rule_amount_guessing_as_of": _rule_amount("as_of"),
        "fraud_events": _fraud_events("all"),
        "context_owner_versions": midnight_context,
        "context_owner_versions_as_of": lambda spark, d: midnight_context(spark, d, "as_of"),
        "txn_lead_lag_midnight": lambda spark, d: card_sequence(midnight_context(spark, d)),
        "fraud_events_midnight": _midnight_events(),
        "fraud_events_midnight_as_of": _midnight_events("as_of", bucket_seconds=7200),
        "fraud_events_hour_buckets": lambda spark, d: rules.fraud_events(
            report_context(spark, d), fx.blacklist(spark, d), bucket_seconds=3600),
        "fraud_events_as_of": _fraud_events("as_of"),
        "fraud_events_repeated_ops": _fraud_events("all", with_copies=True),
        "fraud_events_repeated_ops_collapsed": _fraud_events("all", True, "collapse"),
        "fraud_events_since": _fraud_events("all", since=SINCE),
    }
