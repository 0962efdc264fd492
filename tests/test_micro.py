"""Hand-made cases (at most ~10 rows each) for the boundary and quirk rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fraudmart.operators import report, rules, scd2
from fraudmart.operators.context import transaction_context
from fraudmart.schemas import (
    ACCOUNTS_HIST, BLACKLIST, CARDS_HIST, CLIENTS_HIST, OPEN_DATE, TERMINALS_HIST, TRANSACTIONS,
    DimSpec,
)
from fraudmart.sources import drops

D0 = dt.date(2023, 1, 1)
RUN = dt.date(2024, 2, 1)


def ts(s):
    return dt.datetime.fromisoformat(s)


def world(spark, txns, passport_valid_to=dt.date(2030, 1, 1), account_valid_to=dt.date(2030, 1, 1),
          blacklist=(), terminals=(("T1", "MOSCOW"), ("T2", "KAZAN"), ("T3", "MOSCOW")),
          patronymic="Ivanovich"):
    """One client/account/card and the given transactions
    (id, time, oper_type, amount, result, terminal)."""
    cl = spark.createDataFrame([("C1", "Ivanov", "Ivan", patronymic, dt.date(1980, 1, 1), "P1",
                                 passport_valid_to, "+7900", D0, OPEN_DATE, "N")], CLIENTS_HIST)
    ac = spark.createDataFrame([("A1", account_valid_to, "C1", D0, OPEN_DATE, "N")], ACCOUNTS_HIST)
    ca = spark.createDataFrame([("K1", "A1", D0, OPEN_DATE, "N")], CARDS_HIST)
    te = spark.createDataFrame([(t, "ATM", c, "addr", D0, OPEN_DATE, "N") for t, c in terminals],
                               TERMINALS_HIST)
    tr = spark.createDataFrame(
        [(i, ts(t), "K1", o, Decimal(str(a)), r, term) for i, t, o, a, r, term in txns], TRANSACTIONS)
    bl = spark.createDataFrame(list(blacklist), BLACKLIST)
    return transaction_context(cl, ac, ca, tr, te, RUN), bl


def types_of(df):
    return sorted(r.event_type for r in df.collect())


def test_expiry_day_is_not_fraud(spark):
    ctx, bl = world(spark, [("1", "2024-01-10 10:00:00", "PAYMENT", 5, "SUCCESS", "T1"),
                            ("2", "2024-01-11 10:00:00", "PAYMENT", 5, "SUCCESS", "T1")],
                    passport_valid_to=dt.date(2024, 1, 10), account_valid_to=dt.date(2024, 1, 10))
    assert [r.event_dt for r in rules.rule_passport(ctx, bl).collect()] == [ts("2024-01-11 10:00:00")]
    assert [r.event_dt for r in rules.rule_contract_expired(ctx).collect()] == \
        [ts("2024-01-11 10:00:00")]


def test_blacklist_entry_day_is_fraud_and_null_expiry_never_expires(spark):
    txns = [("1", "2024-01-09 10:00:00", "PAYMENT", 5, "SUCCESS", "T1"),
            ("2", "2024-01-10 10:00:00", "PAYMENT", 5, "SUCCESS", "T1")]
    ctx, bl = world(spark, txns, passport_valid_to=None,
                    blacklist=[("P1", dt.date(2024, 1, 10)), ("P1", dt.date(2024, 1, 20))])
    got = rules.rule_passport(ctx, bl).collect()
    assert [r.event_dt for r in got] == [ts("2024-01-10 10:00:00")]  # duplicates do not multiply
    ctx, bl = world(spark, txns, passport_valid_to=None)
    assert rules.rule_passport(ctx, bl).count() == 0


@pytest.mark.parametrize("second,expected", [("11:00:00", 1), ("11:00:01", 0)])
def test_two_cities_one_hour_inclusive(spark, second, expected):
    ctx, _ = world(spark, [("1", "2024-01-10 10:00:00", "PAYMENT", 5, "SUCCESS", "T1"),
                           ("2", f"2024-01-10 {second}", "PAYMENT", 5, "SUCCESS", "T2")])
    assert rules.rule_two_cities(ctx).count() == expected


@pytest.mark.parametrize("first,second,expected",
                         [("DEPOSIT", "PAYMENT", 0), ("PAYMENT", "DEPOSIT", 1)])
def test_two_cities_deposit_only_checked_on_first(spark, first, second, expected):
    ctx, _ = world(spark, [("1", "2024-01-10 10:00:00", first, 5, "SUCCESS", "T1"),
                           ("2", "2024-01-10 10:30:00", second, 5, "SUCCESS", "T2")])
    assert rules.rule_two_cities(ctx).count() == expected


@pytest.mark.parametrize("a,b", [("T1", "T9"), ("T9", "T2")])
def test_two_cities_unknown_terminal(spark, a, b):
    ctx, _ = world(spark, [("1", "2024-01-10 10:00:00", "PAYMENT", 5, "SUCCESS", a),
                           ("2", "2024-01-10 10:30:00", "PAYMENT", 5, "SUCCESS", b)])
    assert rules.rule_two_cities(ctx).count() == 0


def test_two_cities_reports_latest_first_operation(spark):
    ctx, _ = world(spark, [("1", "2024-01-10 10:00:00", "PAYMENT", 5, "SUCCESS", "T1"),
                           ("2", "2024-01-10 10:30:00", "PAYMENT", 5, "SUCCESS", "T2"),
                           ("3", "2024-01-10 10:40:00", "PAYMENT", 5, "SUCCESS", "T3")])
    got = rules.rule_two_cities(ctx).collect()
    assert [r.event_dt for r in got] == [ts("2024-01-10 10:30:00")]


def test_two_cities_across_midnight(spark):
    ctx, _ = world(spark, [("1", "2024-01-10 23:30:00", "PAYMENT", 5, "SUCCESS", "T1"),
                           ("2", "2024-01-11 00:20:00", "PAYMENT", 5, "SUCCESS", "T2")])
    assert [r.event_dt for r in rules.rule_two_cities(ctx).collect()] == [ts("2024-01-10 23:30:00")]


def guess(last_time, amounts=(40, 30, 20, 10), start="2024-01-10 10:00:00"):
    t0 = ts(start)
    times = [t0, t0 + dt.timedelta(minutes=5), t0 + dt.timedelta(minutes=10), ts(last_time)]
    res = ["REJECT", "REJECT", "REJECT", "SUCCESS"]
    return [(str(i), t.isoformat(sep=" "), "PAYMENT", a, r, "T1")
            for i, (t, a, r) in enumerate(zip(times, amounts, res))]


@pytest.mark.parametrize("last,expected", [("2024-01-10 10:20:00", 1), ("2024-01-10 10:20:01", 0)])
def test_amount_guessing_twenty_minutes_inclusive(spark, last, expected):
    ctx, _ = world(spark, guess(last))
    assert rules.rule_amount_guessing(ctx).count() == expected


def test_amount_guessing_equal_amounts(spark):
    ctx, _ = world(spark, guess("2024-01-10 10:15:00", amounts=(40, 30, 30, 10)))
    assert rules.rule_amount_guessing(ctx).count() == 0


def test_amount_guessing_across_midnight(spark):
    ctx, _ = world(spark, guess("2024-01-11 00:05:00", start="2024-01-10 23:50:00"))
    got = rules.rule_amount_guessing(ctx).collect()
    assert [r.event_dt for r in got] == [ts("2024-01-11 00:05:00")]


def test_fraud_events_one_operation_several_types(spark):
    ctx, bl = world(spark, [("1", "2024-01-11 10:00:00", "PAYMENT", 5, "SUCCESS", "T1")],
                    passport_valid_to=dt.date(2024, 1, 1), account_valid_to=dt.date(2024, 1, 1))
    assert types_of(rules.fraud_events(ctx, bl)) == ["1", "2"]


def test_null_patronymic_makes_fio_null(spark):
    ctx, _ = world(spark, [("1", "2024-01-11 10:00:00", "PAYMENT", 5, "SUCCESS", "T1")])
    assert ctx.first().fio == "Ivanov Ivan Ivanovich"
    ctx, _ = world(spark, [("1", "2024-01-11 10:00:00", "PAYMENT", 5, "SUCCESS", "T1")],
                   patronymic=None)
    assert ctx.first().fio is None


def test_latest_update_wins_between_rows_of_one_stage_key(spark):
    h = spark.createDataFrame([], "k string, a string, b string, effective_from date, "
                                  "effective_to date, deleted_flg string")
    rows = [("k", "Z-old", "x", dt.date(2024, 1, 2)), ("k", "A-new", "x", dt.date(2024, 1, 9)),
            ("k", "A-new", "x", dt.date(2024, 1, 9))]
    s = spark.createDataFrame(rows, "k string, a string, b string, update_dt date")
    got = scd2.scd2_apply(h, s, SPEC, dt.date(2024, 1, 10)).collect()
    assert [(r.a, r.effective_from) for r in got] == [("A-new", dt.date(2024, 1, 9))]
    assert [r.a for r in scd2.duplicate_stage_rows(s, SPEC).collect()] == ["Z-old"]


# --- SCD2 ------------------------------------------------------------------------

SPEC = DimSpec("t", "k", ("a", "b"), new_from="update_dt", change_from="update_dt")
H_SCHEMA = "k string, a string, b string, effective_from date, effective_to date, deleted_flg string"
S_SCHEMA = "k string, a string, b string, update_dt date"
DAY = dt.date(2024, 1, 10)


def hist(spark, rows):
    return spark.createDataFrame(rows, H_SCHEMA)


def stage(spark, rows, day=DAY):
    return spark.createDataFrame([(*r, day) for r in rows], S_SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_null_safe_difference(spark):
    h = hist(spark, [("1", "x", "y", D0, OPEN_DATE, "N"), ("2", None, "y", D0, OPEN_DATE, "N"),
                     ("3", None, "y", D0, OPEN_DATE, "N")])
    s = stage(spark, [("1", None, "y"), ("2", "x", "y"), ("3", None, "y")])
    changed = {r.k for r in scd2.scd2_changed(h, s, SPEC).collect()}
    assert changed == {"1", "2"}


def test_restored_key_with_equal_attributes(spark):
    h = hist(spark, [("1", "x", "y", D0, dt.date(2024, 1, 4), "N"),
                     ("1", "x", "y", dt.date(2024, 1, 5), OPEN_DATE, "Y")])
    s = stage(spark, [("1", "x", "y")])
    out = rows(scd2.scd2_apply(h, s, SPEC, DAY, keys=s.select("k")))
    assert out == [("1", "x", "y", D0, dt.date(2024, 1, 4), "N"),
                   ("1", "x", "y", dt.date(2024, 1, 5), dt.date(2024, 1, 9), "Y"),
                   ("1", "x", "y", DAY, OPEN_DATE, "N")]


def test_change_and_deletion_in_one_run(spark):
    h = hist(spark, [("1", "x", "y", D0, OPEN_DATE, "N")])
    s = stage(spark, [("1", "x2", "y")], day=dt.date(2024, 1, 8))
    keys = spark.createDataFrame([("2",)], "k string")
    out = rows(scd2.scd2_apply(h, s, SPEC, DAY, keys=keys))
    assert out == [("1", "x", "y", D0, dt.date(2024, 1, 7), "N"),
                   ("1", "x2", "y", dt.date(2024, 1, 8), dt.date(2024, 1, 9), "N"),
                   ("1", "x2", "y", DAY, OPEN_DATE, "Y")]


def test_change_twice_on_one_day(spark):
    h = hist(spark, [("1", "x", "y", D0, OPEN_DATE, "N")])
    h1 = scd2.scd2_apply(h, stage(spark, [("1", "x2", "y")]), SPEC, DAY)
    h2 = rows(scd2.scd2_apply(h1, stage(spark, [("1", "x3", "y")]), SPEC, DAY))
    assert h2 == [("1", "x", "y", D0, dt.date(2024, 1, 9), "N"),
                  ("1", "x2", "y", DAY, dt.date(2024, 1, 9), "N"),   # empty interval
                  ("1", "x3", "y", DAY, OPEN_DATE, "N")]


def test_missing_versus_empty_snapshot(spark):
    h = hist(spark, [("1", "x", "y", D0, OPEN_DATE, "N"), ("2", "x", "y", D0, OPEN_DATE, "N")])
    s = stage(spark, [])
    assert rows(scd2.scd2_apply(h, s, SPEC, DAY, keys=None)) == rows(h)
    empty = spark.createDataFrame([], "k string")
    out = scd2.scd2_apply(h, s, SPEC, DAY, keys=empty)
    assert out.where("deleted_flg = 'Y' AND effective_to = DATE'9999-12-31'").count() == 2
    parity = scd2.scd2_apply(h, s, SPEC, DAY, keys=None, missing_snapshot="delete")
    assert rows(parity) == rows(out)


def test_duplicate_stage_keys_latest_wins(spark):
    h = hist(spark, [])
    s = spark.createDataFrame([("1", "old", "y", DAY, 1), ("1", "new", "y", DAY, 2)],
                              S_SCHEMA + ", _seq int")
    assert rows(scd2.scd2_apply(h, s, SPEC, DAY)) == [("1", "new", "y", DAY, OPEN_DATE, "N")]


def test_null_key_is_quarantined(spark):
    s = stage(spark, [(None, "x", "y"), ("1", "x", "y")])
    assert scd2.scd2_apply(hist(spark, []), s, SPEC, DAY).count() == 1
    assert scd2.quarantine_keys(s, SPEC).count() == 1


# --- drops, keys, report -------------------------------------------------------------

def test_amount_and_id_parsing(spark):
    raw = spark.createDataFrame(
        [("001", "2024-01-10 10:00:00", "10", "K1 ", "PAYMENT", "SUCCESS", "T1"),
         ("2", "2024-01-10 10:00:01", "10,5", "K1", "PAYMENT", "SUCCESS", "T1"),
         ("3", "2024-01-10 10:00:02", "x", "K1", "PAYMENT", "SUCCESS", "T1"),
         ("4", "not a time", "1", "K1", "PAYMENT", "SUCCESS", "T1")],
        ", ".join(f"{c} string" for c in ("transaction_id", "transaction_date", "amount",
                                           "card_num", "oper_type", "oper_result", "terminal")))
    parsed = drops.parse_transactions(raw)
    good = {r.trans_id: r for r in drops.good(parsed).collect()}
    assert good["001"].amt == Decimal("10.00") and good["2"].amt == Decimal("10.50")
    assert good["001"].card_num == "K1"
    assert {r.trans_id: r._error for r in drops.quarantine(parsed).collect()} == \
        {"3": "amount", "4": "transaction_date"}


def test_padded_card_number_joins_after_trim(spark):
    padded = spark.createDataFrame([("K1".ljust(20), "A1")], "card_num string, account_num string")
    trimmed = padded.select(F.rtrim("card_num").alias("card_num"), "account_num")
    tx = spark.createDataFrame([("K1",)], "card_num string")
    assert tx.join(padded, "card_num").count() == 0
    assert tx.join(trimmed, "card_num").count() == 1


def test_report_rerun_and_rounding(spark):
    ev = spark.createDataFrame(
        [(ts("2024-01-10 10:00:00.6"), "P1", "F", "+7", "1", RUN),
         (ts("2024-01-10 10:00:00"), None, "F", "+7", "2", RUN)],
        "event_dt timestamp_ntz, passport string, fio string, phone string, event_type string, "
        "report_dt date")
    first = report.append_report(ev, spark.createDataFrame([], ev.schema), RUN)
    got = {r.passport: r.event_dt for r in first.collect()}
    assert got["P1"] == ts("2024-01-10 10:00:01")
    again = report.append_report(ev, first, RUN).collect()
    assert [r.passport for r in again] == [None]  # NULL passport never matches


def test_declared_length_goes_to_quarantine(spark):
    cols = ("transaction_id", "transaction_date", "amount", "card_num", "oper_type",
            "oper_result", "terminal")
    raw = spark.createDataFrame(
        [("1", "2024-01-10 10:00:00", "1", "K1", "PAYMENT", "SUCCESS", "T1"),
         ("2", "2024-01-10 10:00:00", "1", "K1", "PAYMENT", "SUCCESS", "T" + "9" * 10)],
        ", ".join(f"{c} string" for c in cols))
    parsed = drops.parse_transactions(raw)
    assert [r.trans_id for r in drops.good(parsed).collect()] == ["1"]
    assert [r._error for r in drops.quarantine(parsed).collect()] == ["length:terminal"]


def test_dedupe_by_time_keeps_null_ids_and_drops_same_second(spark):
    from fraudmart.operators import facts
    t = lambda s: ts(s)
    fact = spark.createDataFrame([("1", t("2024-01-10 10:00:00"), "K1", "P", Decimal("1"), "S", "T1")],
                                 TRANSACTIONS)
    stage = spark.createDataFrame(
        [("2", t("2024-01-10 10:00:00"), "K2", "P", Decimal("1"), "S", "T1"),   # same second
         (None, t("2024-01-10 10:00:00"), "K3", "P", Decimal("1"), "S", "T1"),  # NULL id
         ("1", t("2024-01-10 10:00:00"), "K1", "P", Decimal("1"), "S", "T1"),   # re-delivery
         ("4", t("2024-01-10 11:00:00"), "K1", "P", Decimal("1"), "S", "T1")], TRANSACTIONS)
    by_time = {r.card_num for r in facts.append_transactions(stage, fact, ("trans_date",)).collect()}
    assert by_time == {"K3", "K1"} and \
        [r.trans_id for r in facts.append_transactions(stage, fact, ("trans_date",))
         .where("card_num = 'K1'").collect()] == ["4"]
    by_id = {r.trans_id for r in facts.append_transactions(stage, fact).collect()}
    assert by_id == {"2", None, "4"}


def test_changed_row_with_null_update_date(spark):
    spec = DimSpec("c", "k", ("a",))          # new_from create_dt, change_from update_dt
    h = spark.createDataFrame([("1", "x", D0, OPEN_DATE, "N")],
                              "k string, a string, effective_from date, effective_to date, "
                              "deleted_flg string")
    s = spark.createDataFrame([("1", "y", DAY, None)],
                              "k string, a string, create_dt date, update_dt date")
    default = rows(scd2.scd2_apply(h, s, spec, DAY))
    assert default == [("1", "x", D0, dt.date(2024, 1, 9), "N"), ("1", "y", DAY, OPEN_DATE, "N")]
    raw = rows(scd2.scd2_apply(h, s, spec, DAY, null_update="raw"))
    assert ("1", "y", None, OPEN_DATE, "N") in raw and ("1", "x", D0, None, "N") in raw


def test_report_dedupe_ignores_type_unless_asked(spark):
    schema = ("event_dt timestamp_ntz, passport string, fio string, phone string, "
              "event_type string, report_dt date")
    old = spark.createDataFrame([(ts("2024-01-10 10:00:00"), "P1", "F", "+7", "1", RUN)], schema)
    new = spark.createDataFrame([(ts("2024-01-10 10:00:00"), "P1", "F", "+7", "2", RUN)], schema)
    assert report.append_report(new, old, RUN).count() == 0
    assert report.append_report(new, old, RUN, include_type=True).count() == 1
    next_day = old.withColumn("report_dt", F.lit(dt.date(2024, 1, 31)))
    assert report.append_report(new, next_day, RUN).count() == 1


def test_blacklist_keep_first_or_earliest(spark):
    from fraudmart.operators import facts
    fact = spark.createDataFrame([("P1", dt.date(2024, 1, 10))], BLACKLIST)
    stage = spark.createDataFrame([("P1", dt.date(2024, 1, 5)), ("P2", dt.date(2024, 1, 7)),
                                   ("P2", dt.date(2024, 1, 8))], BLACKLIST)
    assert rows(facts.append_blacklist(stage, fact)) == \
        [("P2", dt.date(2024, 1, 7)), ("P2", dt.date(2024, 1, 8))]
    assert rows(facts.append_blacklist(stage, fact, keep="earliest")) == \
        [("P1", dt.date(2024, 1, 5)), ("P2", dt.date(2024, 1, 7)), ("P2", dt.date(2024, 1, 8))]


def test_broken_open_invariant_fails_loudly(spark):
    h = hist(spark, [("1", "x", "y", D0, OPEN_DATE, "N"), ("1", "z", "y", D0, OPEN_DATE, "N")])
    with pytest.raises(Exception, match="several open versions"):
        scd2.scd2_apply(h, stage(spark, [("1", "q", "y")]), SPEC, DAY).collect()


@pytest.mark.parametrize("txns,expected", [
    # the success repeated: one rule-4 event (only its first copy has three rejects behind it)
    (guess("2024-01-10 10:15:00") + [("3", "2024-01-10 10:15:00", "PAYMENT", 10, "SUCCESS", "T1")],
     {"4": 1}),
    # a reject repeated: two equal amounts in the run, no rule-4 event
    (guess("2024-01-10 10:15:00") + [("1", "2024-01-10 10:05:00", "PAYMENT", 30, "REJECT", "T1")],
     {}),
    # a repeated operation, then two at the same later second in two cities
    ([("1", "2024-01-10 10:00:00", "PAYMENT", 5, "SUCCESS", "T1"),
      ("1", "2024-01-10 10:00:00", "PAYMENT", 5, "SUCCESS", "T1"),
      ("2", "2024-01-10 10:30:00", "PAYMENT", 5, "SUCCESS", "T1"),
      ("3", "2024-01-10 10:30:00", "PAYMENT", 5, "SUCCESS", "T2")], {"3": 1}),
])
def test_collapsed_copies_give_the_same_events(spark, txns, expected):
    ctx, bl = world(spark, txns, passport_valid_to=dt.date(2024, 1, 9))
    keep = sorted(tuple(r) for r in rules.fraud_events(ctx, bl).collect())
    collapsed = sorted(tuple(r) for r in rules.fraud_events(ctx, bl, copies="collapse").collect())
    assert collapsed == keep
    assert sum(r[4] == "1" for r in keep) == len(txns)       # rule 1: one event per operation
    assert {t: sum(r[4] == t for r in keep) for t in ("3", "4")} == {"3": 0, "4": 0, **expected}
