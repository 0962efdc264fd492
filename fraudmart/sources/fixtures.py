"""Mart inputs derived from the driver's TPC-H-style test tables.

The formulas are the ones written down in FIXTURES.md (Part B). Everything is
a lazy DataFrame over the parquet tables, so the work grows with the scale
factor; nothing is generated on the driver.
"""

from __future__ import annotations

import datetime as _dt
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.schemas import DIMENSIONS, EPOCH_DATE, LIVE_FLAG, OPEN_DATE, TXN_TIME_FORMAT  # noqa: F401

# Fixed dates of the fixtures.
HISTORY_START = _dt.date(2023, 1, 1)
TERMINAL_V2_FROM = _dt.date(2024, 1, 15)
TERMINAL_V1_TO = _dt.date(2024, 1, 14)
REPORT_RUN_DATE = _dt.date(2024, 2, 1)
SCD2_DAY1 = _dt.date(2024, 1, 1)


def scd2_load_date(day: int) -> _dt.date:
    return SCD2_DAY1 + _dt.timedelta(days=day - 1)


_READS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. The test tables are immutable, so a session reuses
    its read of each file (listing and footer are read once)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reads = _READS.setdefault(spark, {})
    if path not in reads:
        reads[path] = spark.read.parquet(path)
    return reads[path]


def _days(base: _dt.date, offset: Column) -> Column:
    return F.date_add(F.lit(base), offset.cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def _versioned(df: DataFrame) -> DataFrame:
    """One open version valid since HISTORY_START."""
    return df.withColumns({
        "effective_from": F.lit(HISTORY_START),
        "effective_to": F.lit(OPEN_DATE),
        "deleted_flg": F.lit(LIVE_FLAG),
    })


# --- relational sources (as staged rows) -------------------------------------

def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), _s(c)).alias("client_id"),
        F.concat(F.lit("L"), _s(c % 97)).alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.when(c % 50 == 49, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("P"), _s(c % 13))).alias("patronymic"),
        _days(_dt.date(1960, 1, 1), (c * 17) % 14000).alias("date_of_birth"),
        _s(F.lit(4000000000) + c * 37).alias("passport_num"),
        F.when(c % 5 == 0, F.lit(None).cast("date"))
         .otherwise(_days(_dt.date(2023, 12, 20), (c * 7) % 60)).alias("passport_valid_to"),
        F.concat(F.lit("+7"), _s(F.lit(9000000000) + c)).alias("phone"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), _s(c)).alias("account_num"),
        _days(_dt.date(2024, 1, 5), (c * 11) % 60).alias("valid_to"),
        F.concat(F.lit("C"), _s(c)).alias("client"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _s(F.lit(1000000) + c).alias("card_num"),
        F.concat(F.lit("A"), _s(c)).alias("account_num"),
    )


def clients_hist(spark, sf_dir):
    return _versioned(clients(spark, sf_dir))


def accounts_hist(spark, sf_dir):
    return _versioned(accounts(spark, sf_dir))


def cards_hist(spark, sf_dir):
    return _versioned(cards(spark, sf_dir))


def terminals_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 1 for every supplier; every fourth supplier moves city on
    2024-01-15 (version 2)."""
    s = F.col("s_suppkey")
    sup = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is the fixed 25-row TPC-H table; the join key is unique there.
    base = sup.join(F.broadcast(nation), sup.s_nationkey == nation.n_nationkey, "left")
    moved = s % 4 == 0
    common = [
        F.concat(F.lit("T"), _s(s)).alias("terminal_id"),
        F.when(s % 3 == 0, F.lit("POS")).otherwise(F.lit("ATM")).alias("terminal_type"),
    ]
    v1 = base.select(
        *common, F.col("n_name").alias("terminal_city"), F.col("s_name").alias("terminal_address"),
        F.lit(HISTORY_START).alias("effective_from"),
        F.when(moved, F.lit(TERMINAL_V1_TO)).otherwise(F.lit(OPEN_DATE)).alias("effective_to"),
        F.lit(LIVE_FLAG).alias("deleted_flg"),
    )
    v2 = base.where(moved).select(
        *common,
        F.concat(F.lit("NATION_"), _s((F.col("s_nationkey") + 1) % 25)).alias("terminal_city"),
        F.col("s_name").alias("terminal_address"),
        F.lit(TERMINAL_V2_FROM).alias("effective_from"),
        F.lit(OPEN_DATE).alias("effective_to"),
        F.lit(LIVE_FLAG).alias("deleted_flg"),
    )
    return v1.unionByName(v2)


def blacklist(spark: SparkSession, sf_dir: str, only_first_of: int | None = None) -> DataFrame:
    """Rows for c%6=1 plus a later duplicate entry for c%18=1.

    ``only_first_of=12`` keeps just the first entries of c%12=1 (the part of
    the blacklist that is already loaded in the append fixture)."""
    c = F.col("c_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    passport = _s(F.lit(4000000000) + c * 37).alias("passport_num")
    first_rows = c % 6 == 1 if only_first_of is None else c % only_first_of == 1
    first = cust.where(first_rows).select(
        passport, _days(_dt.date(2024, 1, 1), c % 30).alias("entry_dt"))
    if only_first_of is not None:
        return first
    extra = cust.where(c % 18 == 1).select(
        passport, _days(_dt.date(2024, 1, 3), c % 30).alias("entry_dt"))
    return first.unionByName(extra)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event; a day of events is squeezed into its first
    30 minutes (seconds of day // 48) so the 20-minute limit both passes and
    fails. The highest terminal number has no terminal row."""
    ev = table(spark, sf_dir, "events")
    e = F.col("event_id")
    n_terminals = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    sec_of_day = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    day_start = F.to_date("ts").cast("timestamp_ntz")
    return ev.select(
        _s(e).alias("trans_id"),
        F.timestamp_add("SECOND", F.floor(sec_of_day / 48), day_start).alias("trans_date"),
        _s(F.lit(1000000) + F.col("user_id")).alias("card_num"),
        F.when(F.col("event_type") == "signup", F.lit("DEPOSIT"))
         .when(F.col("event_type") == "purchase", F.lit("PAYMENT"))
         .otherwise(F.lit("WITHDRAW")).alias("oper_type"),
        F.col("value").cast("decimal(9,2)").alias("amt"),
        F.when(e % 3 == 0, F.lit("SUCCESS")).otherwise(F.lit("REJECT")).alias("oper_result"),
        F.concat(F.lit("T"), _s(e % (n_terminals + 1))).alias("terminal"),
    )


def transactions_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions with every tenth operation delivered three times."""
    t = transactions(spark, sf_dir)
    repeated = t.where(F.col("trans_id").cast("bigint") % 10 == 0)
    return t.unionByName(repeated).unionByName(repeated)


def transactions_loaded(spark, sf_dir):
    """Fact rows already loaded before the batch (event_id even)."""
    return transactions(spark, sf_dir).where(F.col("trans_id").cast("bigint") % 2 == 0)


def transactions_batch(spark, sf_dir):
    """Today's stage batch (event_id % 3 <> 1); overlaps the loaded rows."""
    return transactions(spark, sf_dir).where(F.col("trans_id").cast("bigint") % 3 != 1)


def blacklist_loaded(spark, sf_dir):
    """Blacklist fact before the batch: first entries of c%12=1."""
    return blacklist(spark, sf_dir, only_first_of=12)


def blacklist_batch(spark, sf_dir):
    return blacklist(spark, sf_dir)


# --- raw text drops (as a CSV reader with all-string columns yields them) ----

def transactions_drop_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions fixture spelled as the drop file spells it: header
    names, 'yyyy-MM-dd HH:mm:ss' times and a decimal comma; every 50th amount
    is junk and every 7th id gets leading zeros."""
    t = transactions(spark, sf_dir)
    e = F.col("trans_id").cast("bigint")
    amount = F.replace(F.col("amt").cast("string"), F.lit("."), F.lit(","))
    return t.select(
        F.when(e % 7 == 0, F.concat(F.lit("00"), F.col("trans_id")))
         .otherwise(F.col("trans_id")).alias("transaction_id"),
        F.date_format("trans_date", TXN_TIME_FORMAT).alias("transaction_date"),
        F.when(e % 50 == 0, F.lit("n/a")).otherwise(amount).alias("amount"),
        F.col("card_num"), F.col("oper_type"), F.col("oper_result"), F.col("terminal"),
    )


def blacklist_drop_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = blacklist(spark, sf_dir)
    return b.select(F.date_format("entry_dt", "yyyy-MM-dd").alias("date"),
                    F.col("passport_num").alias("passport"))


# --- SCD2 day snapshots (key k, attributes a, b) ------------------------------

def scd2_day(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Full snapshot of day 1, 2 or 3 with its load date as ``update_dt``."""
    s = F.col("s_suppkey")
    sup = table(spark, sf_dir, "supplier")
    if day == 1:
        df = sup.where(s % 11 != 3).select(
            s.alias("k"), F.col("s_nationkey").alias("a"), F.col("s_name").alias("b"))
    else:
        day2 = sup.where(s % 10 != 0).select(
            s.alias("k"),
            F.when(s % 7 == 1, (F.col("s_nationkey") + 1) % 25)
             .otherwise(F.col("s_nationkey")).alias("a"),
            F.when(s % 13 == 2, F.lit(None).cast("string")).otherwise(F.col("s_name")).alias("b"),
        )
        if day == 2:
            df = day2
        elif day == 3:
            df = day2.unionByName(sup.where(s % 10 == 0).select(
                s.alias("k"), F.col("s_nationkey").alias("a"), F.col("s_name").alias("b")))
        else:
            raise ValueError(day)
    d = F.lit(scd2_load_date(day))
    return df.withColumns({"create_dt": d, "update_dt": d})


# --- incremental source -------------------------------------------------------

def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relational source with create/update dates; a quarter never updated."""
    k = F.col("o_orderkey")
    create = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        k.alias("k"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        create.alias("create_dt"),
        F.when(k % 4 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(create, (k % 400).cast("int"))).alias("update_dt"),
    )


def terminals_drop_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's terminal snapshot as the drop spells it (version 1 cities)."""
    return terminals_hist(spark, sf_dir).where(F.col("effective_from") == F.lit(HISTORY_START)) \
        .select("terminal_id", "terminal_type", "terminal_city", "terminal_address")


def relational_source(df: DataFrame, created: _dt.date, renames: dict[str, str]) -> DataFrame:
    """A staged dimension as its source table shows it: source column names,
    every row created on ``created`` and never updated."""
    return df.withColumnsRenamed(renames).withColumns(
        {"create_dt": F.lit(created), "update_dt": F.lit(None).cast("date")})


# --- dimension days with create and update dates ----------------------------------

#: the attribute that changes, per dimension
CHANGING = {"cards": "account_num", "accounts": "client", "clients": "phone"}


def dimension_day(spark: SparkSession, sf_dir: str, name: str, day: int):
    """(incremental stage, key snapshot, load date) of a relational dimension, c = customer
    number. Day 1: c%11<>3 arrive. Day 2: c%10=0 are gone; of the others c%7=1 change (c%14=1
    by a new create_dt without update_dt) and c%11=3 are new. Day 3: c%10=0 are back."""
    load = _dt.date(2024, 1, day)
    key, attr = DIMENSIONS[name].key, CHANGING[name]
    c = F.regexp_extract(key, r"(\d+)$", 1).cast("bigint") % 1_000_000
    base = {"cards": cards, "accounts": accounts, "clients": clients}[name](spark, sf_dir).withColumn(
        "_c", c)
    c = F.col("_c")
    first, late = F.lit(_dt.date(2024, 1, 1)), F.lit(load)
    none = F.lit(None).cast("date")
    if day == 1:
        present, arrives = c % 11 != 3, c % 11 != 3
        created, updated, changed = first, none, F.lit(False)
    elif day == 2:
        present = c % 10 != 0
        changed = present & (c % 7 == 1) & (c % 11 != 3)
        arrives = present & (changed | (c % 11 == 3))
        created = F.when(changed & (c % 14 != 1), first).otherwise(late)
        updated = F.when(changed & (c % 14 != 1), late)
    else:
        present, arrives, changed = F.lit(True), c % 10 == 0, F.lit(False)
        created, updated = first, late
    stage = base.where(arrives).withColumns({
        attr: F.when(changed, F.concat(attr, F.lit("x"))).otherwise(F.col(attr)),
        "create_dt": created, "update_dt": updated}).drop("_c")
    return stage, base.where(present).select(key), load


def terminals_snapshot(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """The terminals drop of the daily runs: first versions; on day 2 the open ones without T1."""
    t = terminals_hist(spark, sf_dir)
    rows = (t.where(F.col("effective_from") == F.lit(HISTORY_START)) if day == 1 else
            t.where((F.col("effective_to") == F.lit(OPEN_DATE)) & (F.col("terminal_id") != "T1")))
    return rows.select("terminal_id", "terminal_type", "terminal_city", "terminal_address")


# --- hard paths: owners with several versions, operations around midnight ------------

def _second_version(hist: DataFrame, every: int, start: _dt.date, changes: dict) -> DataFrame:
    """Every ``every``-th key gets a second version from ``start`` with ``changes``."""
    key = hist.columns[0]
    again = F.regexp_extract(key, r"(\d+)$", 1).cast("bigint") % 1_000_000 % every == 0
    first = hist.withColumn("effective_to", F.when(
        again, F.lit(start - _dt.timedelta(days=1))).otherwise(F.col("effective_to")))
    second = hist.where(again).withColumns({**changes, "effective_from": F.lit(start)})
    return first.unionByName(second)


def clients_versions(spark, sf_dir):
    return _second_version(clients_hist(spark, sf_dir), 4, _dt.date(2024, 1, 15), {
        "phone": F.concat("phone", F.lit("9")),
        "passport_valid_to": F.date_add("passport_valid_to", 30)})


def accounts_versions(spark, sf_dir):
    return _second_version(accounts_hist(spark, sf_dir), 6, _dt.date(2024, 1, 10),
                           {"valid_to": F.date_add("valid_to", 20)})


def cards_versions(spark, sf_dir):
    return _second_version(cards_hist(spark, sf_dir), 9, _dt.date(2024, 1, 20), {})


def transactions_midnight(spark, sf_dir):
    """The operations, each day's half hour moved to 23:45 - 00:15."""
    return transactions(spark, sf_dir).withColumn(
        "trans_date", F.col("trans_date") + F.expr("INTERVAL '23:45' HOUR TO MINUTE"))


# --- many versions, late changes, hot keys ------------------------------------------

def terminals_daily(spark: SparkSession, sf_dir: str, days: int = 30) -> DataFrame:
    """A version of each terminal for every day of January 2024, n = its number: valid on
    that day only, in a city that moves daily; none on days with (n + day) % 5 = 0, and the
    last day's stays open."""
    n = F.regexp_extract("terminal_id", r"(\d+)", 1).cast("int")
    first = terminals_hist(spark, sf_dir).where(F.col("effective_from") == F.lit(HISTORY_START))
    daily = first.withColumn("_day", F.explode(F.sequence(F.lit(1), F.lit(days))))
    start = _days(_dt.date(2024, 1, 1), F.col("_day") - 1)
    return (daily.where((n + F.col("_day")) % 5 != 0).withColumns({
        "terminal_city": F.concat(F.lit("CITY_"), _s((n + F.col("_day")) % 25)),
        "effective_from": start,
        "effective_to": F.when(F.col("_day") == days, F.lit(OPEN_DATE)).otherwise(start)})
        .drop("_day"))


def clients_many_versions(spark: SparkSession, sf_dir: str, versions: int = 10) -> DataFrame:
    """Ten versions of each client, three days each, with their own phone; none where
    (c + version) % 6 = 0."""
    c = F.regexp_extract("client_id", r"(\d+)", 1).cast("bigint")
    v = F.col("_v")
    each = clients_hist(spark, sf_dir).withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(versions - 1))))
    return (each.where((c + v) % 6 != 0).withColumns({
        "phone": F.concat("phone", F.lit("-"), _s(v)),
        "effective_from": _days(_dt.date(2024, 1, 1), v * 3),
        "effective_to": _days(_dt.date(2024, 1, 3), v * 3)}).drop("_v"))


def late_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery that comes in late: clients with c % 9 = 4 had another phone from before
    their first delivery on, those with c % 9 = 5 from the second day on."""
    c = F.regexp_extract("client_id", r"(\d+)$", 1).cast("bigint") % 1_000_000
    old = c % 9 == 4
    return clients(spark, sf_dir).where(old | (c % 9 == 5)).withColumns({
        "phone": F.concat("phone", F.lit("y")),
        "create_dt": F.lit(_dt.date(2023, 12, 20)),
        "update_dt": F.when(old, F.lit(_dt.date(2023, 12, 20))).otherwise(F.lit(_dt.date(2024, 1, 2)))})


def transactions_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the operations on one card, another third at one terminal."""
    e = F.col("trans_id").cast("bigint")
    return transactions(spark, sf_dir).withColumns({
        "card_num": F.when(e % 3 == 0, F.lit("1000001")).otherwise(F.col("card_num")),
        "terminal": F.when(e % 3 == 1, F.lit("T1")).otherwise(F.col("terminal"))})


def orders_visible(spark: SparkSession, sf_dir: str, step: int) -> DataFrame:
    """What a source shows at three extracts: rows with k % 3 = 0 from the first, 1 from the
    second, 2 from the third on, dated up to that extract's day."""
    last = F.greatest("create_dt", F.coalesce("update_dt", "create_dt"))
    return orders_source(spark, sf_dir).where(
        (F.col("k") % 3 < step) & (last <= F.lit(EXTRACT_DAYS[step - 1])))


EXTRACT_DAYS = (_dt.date(2001, 6, 1), _dt.date(2001, 9, 1), _dt.date(2002, 1, 1))
