"""Plan shape: one shuffle for an SCD2 day, no cartesian products, anti-joins
written as such, filters pushed into the scan; the split window equals the
whole-partition window."""

import datetime as dt
import re

from pyspark.sql import functions as F

from fraudmart.operators import facts, report, rules, scd2, sequence
from fraudmart.operators.context import transaction_context
from fraudmart.plans.change_queries import kept
from fraudmart.plans.queries import FIXTURE_DIM, report_context
from fraudmart.sources import extract
from fraudmart.sources import fixtures as fx
from tests.conftest import SF
from tests.test_scd2_property import as_rows

D = SF["0.001"]


def plan(df, mode: str = "simple") -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_scd2_apply_is_one_shuffle(spark):
    stage = fx.scd2_day(spark, D, 2)
    hist = scd2.scd2_apply(stage.limit(0).select(
        "k", "a", "b", F.col("update_dt").alias("effective_from"),
        F.col("update_dt").alias("effective_to"), F.lit("N").alias("deleted_flg")),
        fx.scd2_day(spark, D, 1), FIXTURE_DIM, fx.scd2_load_date(1))
    hist.write.mode("overwrite").parquet(f"{spark.sparkContext.getCheckpointDir()}/h1")
    h1 = spark.read.parquet(f"{spark.sparkContext.getCheckpointDir()}/h1")
    p = plan(scd2.scd2_apply(h1, stage, FIXTURE_DIM, fx.scd2_load_date(2), stage.select("k")))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_report_plan_has_no_pairs(spark):
    p = plan(rules.fraud_events(report_context(spark, D), fx.blacklist(spark, D)))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert p.count("Window") >= 2


def test_fact_append_is_anti_join(spark):
    p = plan(facts.append_transactions(fx.transactions_batch(spark, D),
                                       fx.transactions_loaded(spark, D)))
    assert "LeftAnti" in p


def test_extract_filter_reaches_parquet_scan(spark):
    path = f"{spark.sparkContext.getCheckpointDir()}/orders_src"
    fx.orders_source(spark, D).write.mode("overwrite").parquet(path)
    src = spark.read.parquet(path)
    p = plan(extract.incremental_extract(src, dt.date(2001, 1, 1), dt.date(2001, 1, 1))
             .select("k"))
    assert re.search(r"PushedFilters: \[Or\(GreaterThan\(create_dt", p), p
    keys = plan(extract.key_snapshot(src, "k"))
    assert "ReadSchema: struct<k:bigint>" in keys


def test_split_window_equals_whole_partition_window(spark):
    ctx = report_context(spark, SF["0.01"])
    whole = as_rows(sequence.card_sequence_whole(ctx).collect())
    assert as_rows(sequence.card_sequence(ctx).collect()) == whole
    assert as_rows(sequence.card_sequence(ctx, bucket_seconds=3600).collect()) == whole


def test_rule_frame_bucket_width_does_not_change_events(spark):
    ctx = report_context(spark, D)
    day = rules.fraud_events(ctx, fx.blacklist(spark, D))
    frame_hour = sequence.rule_frame(ctx, bucket_seconds=3600)
    hour = rules.two_cities_events(frame_hour)
    assert as_rows(hour.collect()) == as_rows(day.where("event_type = '3'").collect())
    assert as_rows(rules._events(frame_hour.where(rules.amount_guess_condition()), "4")
                   .collect()) == as_rows(day.where("event_type = '4'").collect())


def test_hot_card_is_spread_over_day_partitions(spark):
    """All operations on one card over 30 days: the window input is hashed by
    (card, day), so the card lands in many shuffle partitions."""
    hot = F.concat(F.lit("HOT"), F.substring("card_num", 1, 0))   # one card, not a constant
    ctx = report_context(spark, D).withColumn("card_num", hot)
    frame = sequence.rule_frame(ctx)
    p = plan(frame)
    assert re.search(r"Exchange hashpartitioning\(card_num#\d+, bucket#\d+L?, \d+\)", p), p
    # where the frame's own rows end up
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = frame.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread > 4   # of 8 shuffle partitions
    whole = as_rows(sequence.card_sequence_whole(ctx).collect())
    assert as_rows(sequence.card_sequence(ctx).collect()) == whole


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_windows_run_once(spark):
    """Both consumers of the verdicts read one exchange: in the plan that ran, each of
    the two windows appears once."""
    text = final_plan(rules.fraud_events(report_context(spark, SF["0.01"]),
                                         fx.blacklist(spark, SF["0.01"])))
    ran = text.split("\n+- == Initial Plan ==")[0]
    assert len(re.findall(r"\bWindow \[", ran)) == 2, ran
    assert "ReusedExchange" in ran


def test_lead_lag_deals_the_context_out_once(spark):
    text = final_plan(sequence.card_sequence(report_context(spark, SF["0.01"])))
    ran = text.split("\n+- == Initial Plan ==")[0]
    assert len(re.findall(r"- Exchange hashpartitioning\(_grp#\d+, _day#", ran)) == 1, ran


def test_building_the_report_runs_no_job(spark):
    sc = spark.sparkContext
    ctx, bl = report_context(spark, D), fx.blacklist(spark, D)
    sc.setJobGroup("building", "no job may start here")
    try:
        rules.fraud_events(ctx, bl)
        rules.fraud_events(ctx, bl, copies="collapse")
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        sc.setJobGroup("tests", "")


def test_bucket_width_must_divide_the_day(spark):
    import pytest
    with pytest.raises(ValueError):
        sequence.rule_frame(report_context(spark, D), bucket_seconds=7000)


def test_rules_across_midnight_in_any_bucket_width(spark):
    """Operations spread over whole days and right around midnight, on few cards."""
    import random
    rnd = random.Random(11)
    start = dt.datetime(2024, 1, 1, 20)
    rows = []
    for i in range(600):
        at = start + dt.timedelta(minutes=rnd.randrange(0, 60 * 32))
        if rnd.random() < .5:
            at = dt.datetime(2024, 1, 2) + dt.timedelta(seconds=rnd.randrange(-1500, 1500))
        rows.append((None if rnd.random() < .02 else at, f"p{i % 3}", "f", "1", dt.date(2024, 2, 1),
                     None, "c", f"k{i % 3}", None, str(i), rnd.choice(["PAYMENT", "DEPOSIT"]),
                     600 - i % 7 * 50 - i % 3, rnd.choice(["REJECT", "REJECT", "REJECT", "SUCCESS"]),
                     "t", rnd.choice("AB"), None))
    for c in range(3):  # three rejects before midnight and a success after it, on each card
        for j, (m, r) in enumerate(((-9, "REJECT"), (-6, "REJECT"), (-1, "REJECT"), (4, "SUCCESS"))):
            rows.append((dt.datetime(2024, 1, 4) + dt.timedelta(minutes=m), f"p{c}", "f", "1",
                         dt.date(2024, 2, 1), None, "c", f"k{c}", None, f"m{j}", "PAYMENT", 90 - j,
                         r, "t", "A", None))
    ctx = spark.createDataFrame(rows, "trans_date timestamp_ntz, passport string, fio string, "
        "phone string, report_dt date, passport_valid_to date, client_id string, card_num string, "
        "ac_valid_to date, trans_id string, oper_type string, amt int, oper_result string, "
        "terminal_id string, terminal_city string, te_effective_from date")
    whole = sequence.card_sequence_whole(ctx.where("trans_date is not null"))
    guess = as_rows(rules._events(whole.where(
        "oper_result_lag_3 = 'REJECT' and oper_result_lag_2 = 'REJECT' and "
        "oper_result_lag_1 = 'REJECT' and oper_result = 'SUCCESS' and amt_lag_3 > amt_lag_2 and "
        "amt_lag_2 > amt_lag_1 and amt_lag_1 > amt and "
        "trans_date - trans_date_lag_3 <= interval '20' minute"), "4").collect())
    assert guess
    for seconds in (86_400, 3600, 600):
        assert as_rows(rules.rule_amount_guessing(ctx, bucket_seconds=seconds).collect()) == guess
    for limit in ("1 hour", "2 days"):
        day = as_rows(rules.rule_two_cities(ctx, limit).collect())
        assert day == as_rows(rules.rule_two_cities(ctx, limit, bucket_seconds=7200).collect())


def test_since_mode_equals_filtered_full_report(spark):
    import datetime as dt
    ctx = report_context(spark, SF["0.01"])
    full = rules.fraud_events(ctx, fx.blacklist(spark, SF["0.01"]))
    for since in (dt.datetime(2024, 1, 15, 0, 5), dt.datetime(2024, 1, 22), dt.date(2024, 1, 29)):
        got = rules.fraud_events(ctx, fx.blacklist(spark, SF["0.01"]), since=since)
        cut = since if isinstance(since, dt.datetime) else dt.datetime.combine(since, dt.time())
        assert as_rows(got.collect()) == as_rows(full.where(F.col("event_dt") >= F.lit(cut))
                                                 .collect()), since


def test_the_statement_of_the_bench_returns_the_same_events(spark, monkeypatch):
    import bench
    monkeypatch.setattr(bench, "SF_DIR", D)
    for name, rows in (("clients", fx.clients_hist), ("accounts", fx.accounts_hist),
                       ("cards", fx.cards_hist), ("terminals", fx.terminals_hist),
                       ("transactions", fx.transactions), ("blacklist", fx.blacklist)):
        rows(spark, D).createOrReplaceTempView(f"bench_{name}")
    events = rules.fraud_events(report_context(spark, D), fx.blacklist(spark, D))
    cols = ["event_dt", "passport", "fio", "phone", "event_type"]
    assert as_rows(spark.sql(bench.STATEMENT).select(*cols).collect()) == \
        as_rows(events.select(*cols).collect())


def test_no_table_that_grows_goes_through_the_driver(spark):
    """Files of a few kB are what the planner would broadcast; both sides are dealt out instead."""
    day = dt.date(2024, 1, 2)
    open_ = f"date'2023-01-01' effective_from, date'{fx.OPEN_DATE}' effective_to, 'N' deleted_flg"
    rows = {
        "clients": "string(id) client_id, 'l' last_name, 'f' first_name, 'p' patronymic, string(id) "
                   "passport_num, date'2024-01-01' passport_valid_to, string(id) phone, " + open_,
        "accounts": "string(id) account_num, date'2024-06-01' valid_to, string(id) client, " + open_,
        "cards": "string(id) card_num, string(id) account_num, " + open_,
        "terminals": "string(id) terminal_id, string(id % 3) terminal_city, " + open_,
        "blacklist": "string(id) passport_num, date'2024-01-01' entry_dt",
        "operations": "string(id) trans_id, timestamp_ntz'2024-01-02 00:00:00' trans_date, string(id % 9) "
                      "card_num, 'PAYMENT' oper_type, 1.5 amt, 'REJECT' oper_result, string(id % 7) terminal",
        "reported": "timestamp_ntz'2024-01-02 00:00:00' event_dt, string(id) passport, "
                    f"date'{day}' report_dt",
        "stage": "id k, int(id % 2) a, 'b' b, date'2024-01-02' create_dt, date'2024-01-02' update_dt",
        "hist": "id k, 1 a, 'b' b, " + open_}
    t = {n: kept(spark.range(12).selectExpr(*cols.split(", ")), f"grows-{n}") for n, cols in rows.items()}
    plans = []
    for how in ({}, {"history": "as_of"}, {"history": "as_of", "version_join": "range"}):
        ctx = transaction_context(t["clients"], t["accounts"], t["cards"], t["operations"],
                                  t["terminals"], day, **how)
        events = rules.fraud_events(ctx, t["blacklist"])
        plans.append(report.append_report(events, t["reported"], day))
    assert [p.count() for p in plans] == [0, 0, 0]   # each event's passport is reported
    # 12 by passport, and three cards with two operations at a time in two cities
    assert rules.fraud_events(ctx, t["blacklist"]).count() == 15
    plans += [facts.append_transactions(t["operations"], t["operations"], mode)
              for mode in facts.DEDUPE_MODES]
    plans += [facts.append_blacklist(t["blacklist"], t["blacklist"], k) for k in ("first", "earliest")]
    plans += [scd2.scd2_new(t["hist"], t["stage"], FIXTURE_DIM),
              scd2.scd2_changed(t["hist"], t["stage"], FIXTURE_DIM),
              scd2.scd2_tombstones(t["hist"], t["stage"], FIXTURE_DIM, day),
              scd2.duplicate_stage_rows(t["stage"], FIXTURE_DIM)]
    for df in plans:
        text = plan(df)
        assert "SortMergeJoin" in text and "Broadcast" not in text, text
