"""File-stream ingestion of the drops: exactly once per file name, dedupe
against the fact, quarantine of bad rows."""

import datetime as dt
import os

from pyspark.sql import functions as F

from fraudmart.schemas import DROP_TRANSACTIONS
from fraudmart.sources import fixtures as fx
from fraudmart.streaming import drops as sdrops
from tests.conftest import SF

D = SF["0.001"]


def write(df, path):
    df.toPandas().to_csv(path, sep=";", index=False)


def test_available_now_ingestion(spark, tmp_path):
    landing, out, cp = tmp_path / "landing", tmp_path / "out", tmp_path / "cp"
    landing.mkdir()
    text = fx.transactions_drop_text(spark, D)
    first = text.where(F.col("transaction_date") < "2024-01-10")
    second = text.where(F.col("transaction_date") >= "2024-01-10")
    write(first, landing / "transactions_09012024.txt")
    write(fx.table(spark, D, "region"), landing / "readme.txt")   # not a transactions drop

    sdrops.ingest_available(spark, str(landing), DROP_TRANSACTIONS, str(out), str(cp))
    n_first = first.where("amount <> 'n/a'").count()
    assert sdrops.read_fact(spark, str(out), DROP_TRANSACTIONS).count() == n_first

    # next day: a new file, plus yesterday's file dropped again under a new
    # name (its rows are already loaded) and under the same name (ignored)
    write(second, landing / "transactions_31012024.txt")
    write(first, landing / "transactions_09012024_copy.txt")
    os.utime(landing / "transactions_09012024.txt")
    sdrops.ingest_available(spark, str(landing), DROP_TRANSACTIONS, str(out), str(cp))
    fact = sdrops.read_fact(spark, str(out), DROP_TRANSACTIONS)
    n_all = text.where("amount <> 'n/a'").count()
    assert fact.count() == n_all
    assert fact.select("trans_id", "trans_date").distinct().count() == n_all
    bad = spark.read.parquet(str(out / "quarantine"))   # per file occurrence
    assert bad.count() == text.where("amount = 'n/a'").count() + \
        first.where("amount = 'n/a'").count()


def test_a_replayed_snapshot_changes_nothing(spark, tmp_path):
    """A batch that runs again replaces its own output: history stays what SCD2 over the
    three snapshots gives."""
    from fraudmart.operators import scd2
    from fraudmart.schemas import TERMINALS
    from fraudmart.sources import drops
    from fraudmart.streaming import terminals as st
    from tests.test_scd2_property import as_rows

    landing, out, cp = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "cp")
    landing.mkdir()
    t = [fx.terminals_snapshot(spark, D, 1), fx.terminals_snapshot(spark, D, 2)]
    t.append(t[0].where("terminal_id <> 'T2'"))
    hist = spark.createDataFrame([], TERMINALS.schema)
    for n, (rows, day) in enumerate(zip(t, (16, 20, 31))):
        rows.toPandas().to_csv(landing / f"terminals_{day}012024.csv", index=False)
        os.utime(landing / f"terminals_{day}012024.csv", (1_700_000_000 + n, 1_700_000_000 + n))
        stage = drops.good(drops.parse_terminals(rows, dt.date(2024, 1, day)))
        hist = scd2.scd2_apply(hist, stage, TERMINALS, dt.date(2024, 1, day), rows.select("terminal_id"))
    st.ingest_snapshots(spark, str(landing), out, cp)
    want = as_rows(hist.collect())
    assert as_rows(st.history_after(spark, out).collect()) == want
    for batch_id, (rows, day) in ((1, (t[1], 20)), (2, (t[2], 31))):   # run again, in order
        again = rows.withColumn("_path", F.lit(f"/x/terminals_{day}012024.csv")).withColumn(
            "_file_time", F.lit(dt.datetime(2024, 1, 1)))
        st.snapshot_applier(spark, out)(again, batch_id)
        assert as_rows(st.history_after(spark, out).collect()) == want
    st.ingest_snapshots(spark, str(landing), out, cp)   # nothing new
    assert as_rows(st.history_after(spark, out).collect()) == want


def test_rules_on_a_stream_give_the_batch_events(spark, tmp_path):
    """Drops one after another, the third with late rows, give the events of the batch rules;
    the state empties as time passes."""
    from collections import Counter

    from fraudmart.operators import rules
    from fraudmart.operators.context import transaction_context
    from fraudmart.plans.change_queries import spelled_drop, three_drops
    from fraudmart.streaming import rules as srules

    landing, out, cp = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "cp")
    dims = {"clients": fx.clients_hist(spark, D), "accounts": fx.accounts_hist(spark, D),
            "cards": fx.cards_hist(spark, D), "terminals": fx.terminals_hist(spark, D)}
    blacklist = fx.blacklist(spark, D)
    day = dt.timedelta(days=1)
    drops_in, held, dropped = three_drops(spark, D), [], 0

    def batch_events(operations):
        ctx = transaction_context(dims["clients"], dims["accounts"], dims["cards"], operations,
                                  dims["terminals"], fx.REPORT_RUN_DATE)
        return Counter(rules.fraud_events(ctx, blacklist).collect())

    for n, rows in enumerate(drops_in, 1):
        spelled_drop(rows).write.option("header", True).option("sep", ";").csv(f"{landing}/t_{n}")
        q = srules.detect_available(spark, f"{landing}/*", out, cp, dims, blacklist,
                                    fx.REPORT_RUN_DATE, delay="3 days", name_filter="*.csv")
        state = [p.stateOperators[0] for p in q.recentProgress if p.stateOperators]
        held.append(state[-1].numRowsTotal)
        dropped += sum(s.numRowsDroppedByWatermark for s in state)
        if n == 2:   # what is closed is final: nothing of the last days, all of the first
            got = Counter(srules.events_so_far(spark, out).where("event_type <> '3'").collect())
            last = max(r.event_dt for r in got)
            assert dt.datetime(2024, 1, 6) < last < dt.datetime(2024, 1, 13) - 3 * day
            want = batch_events(drops_in[0].where("trans_date < '2024-01-07'"))
            assert not Counter({r: k for r, k in want.items() if r.event_type != "3"}) - got
    assert Counter(srules.events_so_far(spark, out).collect()) == batch_events(fx.transactions(spark, D))
    assert dropped == 0 and held[-1] == 0 and all(held[:-1])
    srules.detect_available(spark, f"{landing}/*", out, cp, dims, blacklist, fx.REPORT_RUN_DATE,
                            delay="3 days", name_filter="*.csv")   # nothing new
    assert Counter(srules.events_so_far(spark, out).collect()) == batch_events(fx.transactions(spark, D))
