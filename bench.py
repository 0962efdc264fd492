"""

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (timed runs per job after one warm-up pass over all jobs, default 3).
Each job (plan building included) is forced with the ``noop`` sink; the
median wall time is reported. Shuffle bytes written per job (last run) are
read from Spark's event log in a scratch folder: at this scale everything is
small enough to broadcast, so the shuffle volume is the number that shows how
a plan would behave on a cluster.
Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def session(event_dir: str):
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master(f"local[{CPUS}]")
         .config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", event_dir)
         .config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false")
         .appName("fraudmart-bench")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(max(8, 2 * CPUS)))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s


def jobs(spark):
    from pyspark.sql import functions as F

    from fraudmart.operators import facts, rules, scd2, watermarks
    from fraudmart.operators.context import transaction_context
    from fraudmart.plans.queries import registry, report_context
    from fraudmart.plans.sizing import scratch
    from fraudmart.schemas import WATERMARKS, DimSpec
    from fraudmart.sources import extract
    from fraudmart.sources import fixtures as fx

    d = SF_DIR

    def report(history):
        def job():
            ctx = transaction_context(
                fx.clients_hist(spark, d), fx.accounts_hist(spark, d), fx.cards_hist(spark, d),
                fx.transactions(spark, d), fx.terminals_hist(spark, d), fx.REPORT_RUN_DATE, history=history)
            return rules.fraud_events(ctx, fx.blacklist(spark, d))
        return job

    def report_by_rule():
        """The same events, each rule planned by itself (what the one-pass form saves)."""
        ctx, bl = report_context(spark, d), fx.blacklist(spark, d)
        return (rules.rule_passport(ctx, bl).unionByName(rules.rule_contract_expired(ctx))
                .unionByName(rules.rule_two_cities(ctx)).unionByName(rules.rule_amount_guessing(ctx)))

    def report_statement():
        """The same events as one SQL statement over whole-card windows."""
        for name, rows in (("clients", fx.clients_hist), ("accounts", fx.accounts_hist),
                           ("cards", fx.cards_hist), ("terminals", fx.terminals_hist),
                           ("transactions", fx.transactions), ("blacklist", fx.blacklist)):
            rows(spark, d).createOrReplaceTempView(f"bench_{name}")
        return spark.sql(STATEMENT)

    def unchanged_day():
        """A second daily run where nothing changed: sources and snapshots as the day before."""
        from fraudmart.plans import daily
        created = fx.REPORT_RUN_DATE - dt.timedelta(days=16)
        src = daily.Sources(
            cards=fx.relational_source(fx.cards(spark, d), created, {"account_num": "account"}),
            accounts=fx.relational_source(fx.accounts(spark, d), created, {"account_num": "account"}),
            clients=fx.relational_source(fx.clients(spark, d), created, {}),
            terminals_drop=fx.terminals_drop_text(spark, d))

        def job():
            if not job.n:   # the first day, in the warm-up pass
                job.root = scratch(spark, "bench-unchanged")
                job.n = 1
                daily.run_daily(spark, job.root, src, fx.REPORT_RUN_DATE, run_id="00001")
            job.n += 1
            r = daily.run_daily(spark, job.root, src, fx.REPORT_RUN_DATE, run_id=f"{job.n:05d}")
            written = [p for t, ps in r.parts.items() if t.endswith("_hist")
                       for p in ps if p.startswith(f"run_id={job.n:05d}/")]
            assert not written, written   # no open slice, no closed one
            return daily.read_state(spark, job.root)["run_figures"]
        job.n = 0
        return job

    # B2: one SCD2 day over an orders dimension, x % of keys changed
    dim = DimSpec("orders", "k", ("customer", "status", "priority"), new_from="update_dt",
                  change_from="update_dt")
    day1, day2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)

    def scd2_day(pct):
        def job():
            o = fx.table(spark, d, "orders")
            base = o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("customer"),
                            F.col("o_orderstatus").alias("status"),
                            F.col("o_orderpriority").alias("priority"))
            hist = base.withColumns({"effective_from": F.lit(day1),
                                     "effective_to": F.lit(fx.OPEN_DATE),
                                     "deleted_flg": F.lit("N")})
            changed = F.col("k") % 100 < pct
            # an incremental stage: only the changed keys arrive, the snapshot has all
            stage = base.where(changed).withColumns({
                "status": F.concat("status", F.lit("*")), "update_dt": F.lit(day2)})
            return scd2.scd2_apply(hist, stage, dim, day2, keys=base.select("k"))
        return job

    # Incremental extract + watermark advance
    def extract_day(wm):
        def job():
            ctrl = spark.createDataFrame([("mart", "orders", wm, wm)], WATERMARKS)
            wc, wu = extract.read_watermark(ctrl, "orders")
            batch = extract.incremental_extract(fx.orders_source(spark, d), wc, wu)
            new_ctrl = watermarks.advance_watermark(ctrl, batch, "orders")
            return batch.crossJoin(F.broadcast(new_ctrl.select("max_create_dt", "max_update_dt")))
        return job

    # Transaction append
    def append(dedupe_on):
        return lambda: facts.append_transactions(fx.transactions_batch(spark, d),
                                                 fx.transactions_loaded(spark, d), dedupe_on)

    return {
        "b1_report_one_pass_all": report("all"),
        "b1_report_one_pass_as_of": report("as_of"),
        "b1_report_rule_by_rule": report_by_rule,
        "b2_scd2_day_0pct": scd2_day(0),
        "b2_scd2_day_10pct": scd2_day(10),
        "b2_scd2_day_100pct": scd2_day(100),
        "b3_extract_watermark_few": extract_day(dt.date(2002, 6, 1)),
        "b3_extract_watermark_all": extract_day(dt.date(1000, 1, 1)),
        "b4_append_by_id_and_time": append(("trans_id", "trans_date")),
        "b4_append_by_time": append(("trans_date",)),
        "b5_lead_lag": lambda: registry()["txn_lead_lag"](spark, d),
        "b6_daily_run": lambda: registry()["daily_run"](spark, d),
        "b7_daily_run_unchanged": unchanged_day(),
        # the 100 TB regime, where nothing is small enough to broadcast: same
        # report, every join a shuffle join (compare shuffle_mb)
        "b1_report_one_pass_all_no_broadcast": (report("all"), NO_BROADCAST),
        "b1_report_rule_by_rule_no_broadcast": (report_by_rule, NO_BROADCAST),
        "b1_report_one_statement": report_statement,
        "b1_report_one_statement_no_broadcast": (report_statement, NO_BROADCAST),
    }


#: the four rules as one statement: what the one-pass form is compared with
STATEMENT = """
WITH ops AS (
  SELECT t.*, p.passport_num AS passport, p.passport_valid_to, p.phone,
         p.last_name || ' ' || p.first_name || ' ' || p.patronymic AS fio,
         a.valid_to AS contract_to, te.terminal_city, te.effective_from AS since,
         to_date(t.trans_date) AS day
  FROM bench_transactions t
  JOIN bench_cards c ON c.card_num = t.card_num
  JOIN bench_accounts a ON a.account_num = c.account_num
  JOIN bench_clients p ON p.client_id = a.client
  LEFT JOIN bench_terminals te ON te.terminal_id = t.terminal),
steps AS (
  SELECT *, lead(terminal_city) OVER card AS next_city, lead(trans_date) OVER card AS next_at,
         lag(oper_result, 1) OVER card AS r1, lag(oper_result, 2) OVER card AS r2,
         lag(oper_result, 3) OVER card AS r3, lag(amt, 1) OVER card AS a1,
         lag(amt, 2) OVER card AS a2, lag(amt, 3) OVER card AS a3,
         lag(trans_date, 3) OVER card AS at3
  FROM ops
  WINDOW card AS (PARTITION BY passport, fio, phone, card_num
                  ORDER BY trans_date, trans_id, since, terminal_city))
SELECT trans_date AS event_dt, passport, fio, phone, '1' AS event_type FROM ops o
WHERE passport_valid_to < day
   OR EXISTS (SELECT 1 FROM bench_blacklist b WHERE b.passport_num = o.passport AND b.entry_dt <= o.day)
UNION ALL
SELECT trans_date, passport, fio, phone, '2' FROM ops WHERE contract_to < day
UNION ALL
SELECT max(trans_date), passport, fio, phone, '3' FROM ops o
WHERE oper_type <> 'DEPOSIT'
  AND EXISTS (SELECT 1 FROM steps s WHERE s.card_num = o.card_num AND s.trans_date = o.trans_date
              AND s.next_city <> o.terminal_city AND s.next_at <= s.trans_date + INTERVAL 1 HOUR)
GROUP BY passport, fio, phone
UNION ALL
SELECT trans_date, passport, fio, phone, '4' FROM steps
WHERE oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT'
  AND a3 > a2 AND a2 > a1 AND a1 > amt AND trans_date <= at3 + INTERVAL 20 MINUTES"""


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
COMPARISON_ONLY = ("b1_report_rule_by_rule", "b1_report_rule_by_rule_no_broadcast",
                   "b1_report_one_pass_all_no_broadcast", "b1_report_one_statement",
                   "b1_report_one_statement_no_broadcast")
#: the jobs of the first round, for a total that can be compared from round to round
FIRST_ROUND = ("b1_report_one_pass_all", "b1_report_one_pass_as_of", "b2_scd2_day_0pct",
               "b2_scd2_day_10pct", "b2_scd2_day_100pct", "b3_extract_watermark_few",
               "b3_extract_watermark_all", "b4_append_by_id_and_time", "b4_append_by_time")


def run(spark, name, build, timed: bool = True) -> float:
    build, conf = build if isinstance(build, tuple) else (build, {})
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        if not timed:
            spark.sparkContext.setJobGroup(f"{name}#warmup", name)
            build().write.format("noop").mode("overwrite").save()
            return 0.0
        return _timed(spark, name, build)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _timed(spark, name, build) -> float:
    times = []
    for i in range(REPEAT):
        last = i == REPEAT - 1
        spark.sparkContext.setJobGroup(f"{name}#last" if last else f"{name}#{i}", name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def shuffle_mb(event_dir: str) -> dict[str, float]:
    """Shuffle bytes written per job group, from the event log."""
    stage_group, written = {}, {}
    for path in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    sid = ev.get("Stage ID")
                    written[sid] = written.get(sid, 0) + m.get("Shuffle Bytes Written", 0)
    out: dict[str, float] = {}
    for sid, b in written.items():
        g = stage_group.get(sid)
        if g and g.endswith("#last"):
            k = g[: -len("#last")]
            out[k] = out.get(k, 0) + b
    return {k: round(v / 2**20, 3) for k, v in sorted(out.items())}


def main():
    event_dir = tempfile.mkdtemp(prefix="fraudmart-bench-events-")
    spark = session(event_dir)
    only = set(sys.argv[1:])
    selected = {n: b for n, b in jobs(spark).items() if not only or n in only}
    for name, build in selected.items():      # one warm-up pass over every job (JIT)
        run(spark, name, build, timed=False)
    out = {}
    for name, build in selected.items():
        out[name] = round(run(spark, name, build), 3)
        print(f"{name}: {out[name]}s", file=sys.stderr)
    spark.stop()   # flushes the event log
    shuffled = shuffle_mb(event_dir)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    headline = [k for k in out if k not in COMPARISON_ONLY]
    print(json.dumps({
        "metric": "mart_jobs_total_median",
        "value": round(sum(out[k] for k in headline), 3),
        "first_round_jobs": round(sum(out.get(k, 0) for k in FIRST_ROUND), 3),
        "unit": "sec",
        "queries": out,
        "shuffle_mb": shuffled,
        "sf": float(m.group(1)) if m else None,
        "cpus": CPUS,
        "repeat": REPEAT,
    }))


if __name__ == "__main__":
    main()
