"""O1: one daily run of the mart, end to end.

Order (as the source system, with the archive step folded into the commit):
stage and key snapshots → SCD2 (new, changed, deleted), facts, watermarks and
ledger of consumed files → report → manifest (the commit). Relational batches,
their key snapshots and parsed drops are staged (written once, read back), so
every later step of the run sees the same rows even when the source is a live
database, and a drop is parsed once. Tables that do not read each other are
written at the same time; what was read, added and changed is counted while it is
written.

A dimension's day follows the change, not its size: keys are dealt into buckets by
hash, and only buckets that a stage row falls into, or whose snapshot has another
digest than in the run before, are read, compared and written again.

Between these tables every step is a lazy DataFrame; the only values that reach the driver are
the watermarks (one row per source), the changed buckets and the figures, the list of
unseen drop file names and the manifest's list of part directories. Each table is written once per run
into its own new directory and read back from there by later steps, which
cuts the lineage at every table boundary (executor loss re-runs one stage,
not the whole day).
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.functions.columns import clean_key, is_open
from fraudmart.operators import digests, facts, report, rules, scd2, watermarks
from fraudmart.operators.context import transaction_context
from fraudmart.plans.store import Manifest, Store
from fraudmart.schemas import (
    BLACKLIST, DIMENSIONS, DROP_BLACKLIST, DROP_TERMINALS, DROP_TRANSACTIONS, EPOCH_DATE,
    FRAUD_REPORT, TRANSACTIONS, WATERMARKS,
)
from fraudmart.sources import drops, extract

# Source column → mart column.
RENAMES = {
    "cards": {"account": "account_num"},
    "accounts": {"account": "account_num"},
    "clients": {},
}
PADDED_KEYS = {"cards": ("card_num", "account_num"), "accounts": ("account_num",)}

DATE_PARTITIONS = {
    "fact_transactions": (T.StructField("trans_dt", T.DateType()),),
    "fraud_report": (T.StructField("report_dt", T.DateType()),),
}


#: What became of each kind of drop in a run
RUN_STATUS = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("n_files", T.IntegerType()),
    T.StructField("status", T.StringType()), T.StructField("run_id", T.StringType())])
#: what a run read, quarantined, found new, changed, restored or deleted, per table (counted
#: while the tables are written)
RUN_FIGURES = T.StructType([
    T.StructField("table", T.StringType()), T.StructField("figure", T.StringType()),
    T.StructField("value", T.LongType()), T.StructField("run_id", T.StringType())])
DIGESTS = T.StructType([T.StructField("name", T.StringType()), *digests.DIGESTS.fields])
#: jobs of a run that are started at a time
PARALLEL = 6


@dataclass
class Sources:
    """Inputs of one run. Relational sources are DataFrames with the source
    column names (``spark.read.jdbc`` or a replica); ``landing`` is the folder
    of file drops. Drops that were already read elsewhere can be handed in as
    text DataFrames with the drop's header names (``*_drop``); they take the
    place of the landing folder for their kind. Any input may be None
    (nothing arrived)."""

    cards: DataFrame | None = None
    accounts: DataFrame | None = None
    clients: DataFrame | None = None
    landing: str | None = None
    terminals_drop: DataFrame | None = None
    blacklist_drop: DataFrame | None = None
    transactions_drop: DataFrame | None = None


@dataclass
class Options:
    history: str = "all"                       # report joins all versions (source system)
    txn_dedupe: tuple[str, ...] = ("trans_id", "trans_date")
    monotone_watermarks: bool = True
    missing_snapshot: str = "skip"
    null_update: str = "coalesce"
    blacklist_keep: str = "first"
    report_include_type: bool = False
    overlap_days: int = 0                      # re-read a few days behind the watermark (Q5)
    boundary: str = "strict"                   # 'exact': rows of the marks' own dates, each once
    open_buckets: int = 16                     # key buckets of an open slice and of its digests
    report_copies: str = "keep"                # 'collapse' for batches with many repeats
    report_bucket_seconds: int = 86_400        # how finely a hot card is split (divides a day)
    report_since: _dt.date | None = None       # None: every event of all history (source system)
    drop_separator: dict = field(default_factory=lambda: {
        DROP_TERMINALS: ",", DROP_BLACKLIST: ",", DROP_TRANSACTIONS: ";"})


@dataclass
class RunResult:
    run_id: str
    parts: dict[str, list[str]]
    files: dict[str, list[str]]


#: how a dimension's parts are laid out: ``slice=closed/of=0/bucket=0`` (append-only) and
#: ``slice=open/of=<buckets>/bucket=<n>``, of which only buckets that change are written again
SLICES = tuple(T.StructField(n, t) for n, t in (
    ("run_id", T.StringType()), ("slice", T.StringType()), ("of", T.IntegerType()),
    ("bucket", T.IntegerType())))


def read_dimension(store: Store, name: str, manifest: Manifest) -> DataFrame:
    """The closed slices of every run and the newest open slice of every bucket, as listed."""
    return store.read(f"{name}_hist", DIMENSIONS[name].schema, manifest,
                      partition_fields=SLICES).drop(*[f.name for f in SLICES])


def read_open(store: Store, name: str, parts: list[str]) -> DataFrame:
    """The open versions in the given parts."""
    return store.read(f"{name}_hist", DIMENSIONS[name].schema, Manifest(None), parts,
                      SLICES).drop(*[f.name for f in SLICES])


def open_buckets(parts: list[str], buckets: int) -> dict[int, str] | None:
    """The listed open parts by bucket; None if they are laid out in another number of buckets."""
    found = {}
    for part in parts:
        if "/slice=open" in part:
            head, _, bucket = part.rpartition("/bucket=")
            if not head.endswith(f"/of={buckets}"):
                return None
            found[int(bucket)] = part
    return found


def read_table(store: Store, table: str, schema: T.StructType, manifest: Manifest) -> DataFrame:
    return store.read(table, schema, manifest, partition_fields=DATE_PARTITIONS.get(table, ()))


@dataclass
class Staged:
    """A table of the run's stage, read back, and what was counted while it was written."""

    rows: DataFrame
    figures: dict


def _relational(src: DataFrame, name: str) -> DataFrame:
    df = extract.rename(src, RENAMES[name])
    return df.withColumns({k: clean_key(k) for k in PADDED_KEYS.get(name, ())})


def in_parallel(spark: SparkSession, jobs: dict) -> dict:
    """Results of independent jobs, each in a thread of its own: on small tables a run is
    mostly the start of jobs. The first error is raised when all have ended."""
    if not jobs:
        return {}
    with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        running = {k: pool.submit(inheritable_thread_target(spark)(job)) for k, job in jobs.items()}
    return {k: f.result() for k, f in running.items()}


def observed(df: DataFrame, **figures) -> tuple[DataFrame, Observation]:
    """``df`` with sums and counts taken while it is written (no job of their own)."""
    seen = Observation()
    return df.observe(seen, *[c.alias(k) for k, c in figures.items()]), seen


def changed_buckets(store: Store, stage: dict, keys: dict, term: DataFrame | None, several: bool,
                    run_id: str, parts: dict, before: Manifest, buckets: int) -> dict[str, set[int]]:
    """For each dimension the key buckets that this run can change: those of incremental
    stage rows, and those where the digest of the full snapshot is not that of the run
    before. The digests are kept with the run; without a snapshot none are kept, so that the
    next one is compared in full."""
    new, asked = [], []
    for name, snapshot in keys.items():
        spec = DIMENSIONS[name]
        if name == "terminals":   # a snapshot of whole rows; those in quarantine name keys too
            columns = [*spec.attrs, "_error", *(["_file_time"] if several else [])]
            digest = digests.digests(term, spec.key, buckets, columns)
        else:
            digest = digests.digests(snapshot, spec.key, buckets)
        new.append(digest.withColumn("name", F.lit(name)))
    for name, rows in stage.items():
        if name != "terminals":
            spec = DIMENSIONS[name]
            asked.append(rows.where(F.col(spec.key).isNotNull()).select(
                F.lit(name).alias("name"), digests.bucket_of(spec.key, buckets).alias("bucket")))
    if not new and not asked:
        parts.pop("digests", None)
        return {}
    if new:
        part = store.write("digests", run_id, reduce(DataFrame.unionByName, new)
                           .select(*DIGESTS.fieldNames()).withColumn("of", F.lit(buckets)).coalesce(1))
        schema = T.StructType([*DIGESTS.fields, T.StructField("of", T.IntegerType())])
        was = store.read("digests", schema, before).where(F.col("of") == buckets)
        now = store.read("digests", schema, before, [part])
        sums = F.struct(*[c for c in DIGESTS.fieldNames() if c not in ("name", "bucket")])
        both = (was.where(F.col("name").isin(*keys)).select("name", "bucket", sums.alias("was"))
                .join(now.select("name", "bucket", sums.alias("now")), ["name", "bucket"], "full_outer"))
        asked.append(both.where(~F.col("was").eqNullSafe(F.col("now"))).select("name", "bucket"))
        parts["digests"] = [part]
    else:
        parts.pop("digests", None)
    found: dict[str, set[int]] = {}
    for name, bucket in reduce(DataFrame.unionByName, asked).distinct().collect():
        found.setdefault(name, set()).add(bucket)
    return found


def write_dimension(store: Store, name: str, run_id: str, run_date: _dt.date, stage: DataFrame | None,
                    keys: DataFrame | None, wanted: set[int], parts: list[str], opt: Options):
    """One SCD2 day on the wanted buckets. Returns the table's parts after it and the number of
    keys by kind of change. Buckets that are not wanted are listed again, not read or written."""
    spec = DIMENSIONS[name]
    # only the terminal drop can be "missing as empty"; databases are read or not
    missing = opt.missing_snapshot if name == "terminals" else "skip"
    listed = open_buckets(parts, opt.open_buckets)
    if listed is None or (keys is None and missing == "delete"):
        whole = True   # laid out anew, or every live key is looked at
    else:
        whole = False
        if not wanted:
            return parts, {}
    superseded = [p for p in parts if "/slice=open" in p] if whole else [
        listed[b] for b in sorted(wanted) if b in listed]
    hist = read_open(store, name, superseded)
    bucket = digests.bucket_of(spec.key, opt.open_buckets)
    if stage is None:
        dates = {c: F.lit(None).cast("date") for c in (spec.new_from, spec.change_from)}
        stage = hist.limit(0).select(*spec.columns).withColumns(dates)
    if not whole:
        stage = stage.where(bucket.isin(*wanted))
        keys = None if keys is None else keys.where(bucket.isin(*wanted))
    touched = scd2.scd2_touched(hist, stage, spec, run_date, keys, missing, opt.null_update)
    out = touched.withColumns({
        "slice": F.when(is_open(), F.lit("open")).otherwise(F.lit("closed")),
        "of": F.when(is_open(), F.lit(opt.open_buckets)).otherwise(F.lit(0)),
        "bucket": F.when(is_open(), bucket).otherwise(F.lit(0))})
    kinds = ("new", "changed", "restored", "deleted")
    out, seen = observed(
        out, open=F.collect_set(F.when(is_open(), F.col("bucket"))),
        closed=F.count(F.when(~is_open(), F.lit(1))),
        **{k: F.count(F.when(is_open() & (F.col("change") == k), F.lit(1))) for k in kinds})
    part = store.write(f"{name}_hist", run_id, out.select(
        *spec.history_columns, "slice", "of", "bucket").hint("rebalance", "slice", "bucket"),
        partition_by=["slice", "of", "bucket"])
    got = seen.get
    kept = [p for p in parts if p not in superseded]
    opened = [f"{part}/slice=open/of={opt.open_buckets}/bucket={b}" for b in sorted(got["open"])]
    closed = [f"{part}/slice=closed"] if got["closed"] else []
    return kept + closed + opened, {k: got[k] for k in kinds}


def run_daily(spark: SparkSession, root: str, sources: Sources, run_date: _dt.date,
              run_id: str | None = None, options: Options | None = None) -> RunResult:
    opt = options or Options()
    store = Store(spark, root)
    m = store.latest()
    run_id = run_id or f"{run_date:%Y%m%d}-{_dt.datetime.now(_dt.timezone.utc):%H%M%S%f}"
    if m.run_id is not None and run_id <= m.run_id:
        # a published run is never rewritten (its parts are inputs of this one)
        raise ValueError(f"run_id {run_id!r} must sort after the published {m.run_id!r}")
    parts: dict[str, list[str]] = {t: list(p) for t, p in m.parts.items()}
    figures: dict[tuple[str, str], int] = {}

    # --- stage: drops and relational extracts -------------------------------
    ctrl = (read_table(store, "watermarks", WATERMARKS, m) if "watermarks" in m.parts
            else watermarks.init_watermarks(spark))
    marks = extract.read_watermarks(ctrl)
    ledger = read_table(store, "file_ledger", drops.LEDGER, m) if "file_ledger" in m.parts else None
    handed = {DROP_TERMINALS: sources.terminals_drop, DROP_BLACKLIST: sources.blacklist_drop,
              DROP_TRANSACTIONS: sources.transactions_drop}
    # a kind that is handed in is not read from the landing folder: its files stay unseen
    files = in_parallel(spark, {k: partial(drops.unseen_files, spark, sources.landing, k, ledger)
                         for k in drops.KINDS if sources.landing and handed[k] is None})
    files = {k: files.get(k, []) for k in drops.KINDS}
    sep = opt.drop_separator

    def staged(name: str, df: DataFrame, **also) -> Staged:
        """K2: written once and read back from this run's own folder."""
        out, seen = observed(df, rows=F.count(F.lit(1)), **also)
        part = store.write(f"stage_{name}", run_id, out)
        parts[f"stage_{name}"] = [part]
        return Staged(store.read(f"stage_{name}", df.schema, m, parts=[part]), seen.get)

    def stage_drop(kind: str):
        if kind == DROP_TERMINALS:
            df = (drops.parse_terminals(handed[kind], run_date) if handed[kind] is not None else
                  drops.read_terminals(spark, files[kind], run_date, sep[kind]))
        elif kind == DROP_BLACKLIST:
            df = (drops.parse_blacklist(handed[kind]) if handed[kind] is not None else
                  drops.read_blacklist(spark, files[kind], sep[kind]))
        else:
            df = (drops.parse_transactions(handed[kind]) if handed[kind] is not None else
                  drops.read_transactions(spark, files[kind]))
        if df is None:
            return None
        return staged(kind, df, quarantined=F.count(F.when(F.col("_error").isNotNull(), F.lit(1))))

    def stage_source(name: str, src: DataFrame):
        wc, wu = marks.get(name, (EPOCH_DATE, EPOCH_DATE))
        if opt.boundary == "exact":
            rows = extract.boundary_extract(src, wc, wu, read_table(store, f"{name}_taken",
                                                                    extract.TAKEN, m))
        else:
            rows = extract.incremental_extract(src, wc, wu, overlap_days=opt.overlap_days)
        return staged(name, rows, create=F.max("create_dt"), update=F.max("update_dt"))

    given = {n: _relational(getattr(sources, n), n) for n in ("cards", "accounts", "clients")
             if getattr(sources, n) is not None}
    done = in_parallel(
        spark, {k: partial(stage_drop, k) for k in drops.KINDS}
        | {n: partial(stage_source, n, src) for n, src in given.items()}
        | {f"{n}_keys": partial(staged, f"{n}_keys",
                                extract.key_snapshot(src, DIMENSIONS[n].key))
           for n, src in given.items()})
    bl_raw, tx_raw = done[DROP_BLACKLIST].rows, done[DROP_TRANSACTIONS].rows
    term = done[DROP_TERMINALS].rows if done[DROP_TERMINALS] is not None else None
    for name, st in done.items():
        if st is not None and not name.endswith("_keys"):
            figures[name, "read"] = st.figures["rows"]
            if "quarantined" in st.figures:
                figures[name, "quarantined"] = st.figures["quarantined"]
    stage: dict[str, DataFrame] = {n: done[n].rows for n in given}
    keys: dict[str, DataFrame] = {n: done[f"{n}_keys"].rows for n in given}
    if term is not None:
        stage["terminals"] = (drops.with_file_order(drops.good(term))
                              if "_file_time" in term.columns else drops.good(term))
        keys["terminals"] = drops.terminal_keys(term)

    # --- SCD2 per dimension, facts, watermarks, run records: independent of each other ----
    wanted = changed_buckets(store, stage, keys, term, len(files[DROP_TERMINALS]) > 1, run_id, parts,
                             m, opt.open_buckets)

    def append(table: str, df: DataFrame, **how) -> str:
        out, seen = observed(df, rows=F.count(F.lit(1)))
        part = store.write(table, run_id, out, **how)
        figures[table, "new"] = seen.get["rows"]
        return part

    def blacklist_fact():
        loaded = read_table(store, "fact_passport_blacklist", BLACKLIST, m)
        return append("fact_passport_blacklist", facts.append_blacklist(
            drops.good(bl_raw).select(*BLACKLIST.fieldNames()), loaded, opt.blacklist_keep))

    def transactions_fact():
        loaded = read_table(store, "fact_transactions", TRANSACTIONS, m)
        new = facts.append_transactions(drops.good(tx_raw).select(*TRANSACTIONS.fieldNames()),
                                        loaded, opt.txn_dedupe)
        # one day's rows meet in few files; AQE splits a day that is too large for one task
        return append("fact_transactions", new.withColumn("trans_dt", F.to_date("trans_date"))
                      .hint("rebalance", "trans_dt"), partition_by=["trans_dt"])

    def advanced_marks():
        # M1; terminals: update only, never read back (M2)
        after = ctrl
        for name, st in stage.items():
            create = None if name == "terminals" else "create_dt"
            after = watermarks.advance_watermark(after, st, name, create, "update_dt",
                                                 opt.monotone_watermarks)
        return store.write("watermarks", run_id, after)

    def taken(name: str):
        wc, wu = marks.get(name, (EPOCH_DATE, EPOCH_DATE))
        got = done[name].figures
        rows = extract.taken_at_marks(
            stage[name], read_table(store, f"{name}_taken", extract.TAKEN, m),
            max(wc, got["create"] or wc), max(wu, got["update"] or wu))
        return store.write(f"{name}_taken", run_id, rows)

    def quarantined_rows():
        bad = [(DROP_BLACKLIST, drops.quarantine(bl_raw)), (DROP_TRANSACTIONS, drops.quarantine(tx_raw))]
        if term is not None:
            bad.append((DROP_TERMINALS, drops.quarantine(term)))
        for name in given:              # Q20: a NULL key cannot be versioned
            bad.append((name, scd2.quarantine_keys(stage[name], DIMENSIONS[name])))
        for name, st in stage.items():  # Q19: rows that lost to another of their key
            bad.append((f"{name}:duplicate_key", scd2.duplicate_stage_rows(st, DIMENSIONS[name])))
        rows = [df.select(F.lit(kind).alias("kind"), F.to_json(F.struct("*")).alias("row"))
                for kind, df in bad]
        return store.write("quarantine", run_id, reduce(DataFrame.unionByName, rows))

    def file_ledger():
        consumed = [(drops.drop_name(sources.landing, p), k, run_id)
                    for k, ps in files.items() for p in ps]
        return store.write("file_ledger", run_id, spark.createDataFrame(consumed, drops.LEDGER))

    def run_status():
        status = [(k, len(files[k]), "handed in" if handed[k] is not None else
                   "read" if files[k] else "missing", run_id) for k in drops.KINDS]
        return store.write("run_status", run_id, spark.createDataFrame(status, RUN_STATUS))

    grown = {"fact_passport_blacklist": blacklist_fact, "fact_transactions": transactions_fact,
             "quarantine": quarantined_rows, "file_ledger": file_ledger, "run_status": run_status}
    replaced = {"watermarks": advanced_marks}
    if opt.boundary == "exact":
        replaced |= {f"{n}_taken": partial(taken, n) for n in given}
    dimensions = {f"{n}_hist": partial(
        write_dimension, store, n, run_id, run_date, stage.get(n), keys.get(n), wanted.get(n, set()),
        parts.get(f"{n}_hist", []), opt) for n in DIMENSIONS}
    written = in_parallel(spark, dimensions | grown | replaced)
    for table, (listed, changes) in ((t, written[t]) for t in dimensions):
        parts[table] = listed
        figures |= {(table, k): v for k, v in changes.items()}
    for table in grown:
        parts.setdefault(table, []).append(written[table])
    for table in replaced:
        parts[table] = [written[table]]

    # --- report: read this run's state back (lineage cut at the table) ------
    now = Manifest(run_id, {t: list(p) for t, p in parts.items()})
    dims = {n: read_dimension(store, n, now) for n in DIMENSIONS}
    txns = read_table(store, "fact_transactions", TRANSACTIONS, now)
    if opt.report_since is not None:   # partition pruning: the days the rules can look at
        txns = txns.where(F.col("trans_dt") >= F.lit(opt.report_since - _dt.timedelta(days=1)))
    ctx = transaction_context(dims["clients"], dims["accounts"], dims["cards"],
                              txns.drop("trans_dt"), dims["terminals"], run_date,
                              history=opt.history)
    events = rules.fraud_events(ctx, read_table(store, "fact_passport_blacklist", BLACKLIST, now),
                                copies=opt.report_copies, since=opt.report_since,
                                bucket_seconds=opt.report_bucket_seconds)
    existing = read_table(store, "fraud_report", FRAUD_REPORT, m)
    new_rows = report.append_report(events, existing, run_date, opt.report_include_type)
    parts.setdefault("fraud_report", []).append(
        append("fraud_report", new_rows, partition_by=["report_dt"]))

    # --- what the run did, then commit ------------------------------------------
    rows = [(t, f, int(n), run_id) for (t, f), n in sorted(figures.items())]
    parts.setdefault("run_figures", []).append(
        store.write("run_figures", run_id, spark.createDataFrame(rows, RUN_FIGURES).coalesce(1)))
    store.publish(run_id, parts, expected=m.run_id)
    return RunResult(run_id, parts, files)


def read_state(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every table of the newest published run."""
    store = Store(spark, root)
    m = store.latest()
    out = {f"{n}_hist": read_dimension(store, n, m) for n in DIMENSIONS}
    out["fact_transactions"] = read_table(store, "fact_transactions", TRANSACTIONS, m)
    out["fact_passport_blacklist"] = read_table(store, "fact_passport_blacklist", BLACKLIST, m)
    out["fraud_report"] = read_table(store, "fraud_report", FRAUD_REPORT, m)
    out["watermarks"] = read_table(store, "watermarks", WATERMARKS, m)
    out["file_ledger"] = read_table(store, "file_ledger", drops.LEDGER, m)
    out["run_status"] = read_table(store, "run_status", RUN_STATUS, m)
    out["run_figures"] = read_table(store, "run_figures", RUN_FIGURES, m)
    return out
