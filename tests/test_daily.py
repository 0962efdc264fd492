"""End-to-end daily runs on a scratch store: drops as CSV files in a landing
folder, relational sources as DataFrames; ledger, crash and re-run."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from fraudmart.operators import rules
from fraudmart.operators.context import transaction_context
from fraudmart.plans import daily
from fraudmart.plans.store import Store
from fraudmart.sources import fixtures as fx
from tests.conftest import SF

D = SF["0.001"]
DAY1, DAY2 = dt.date(2024, 1, 16), dt.date(2024, 1, 31)


def write_drop(df, path, sep):
    """A drop file as the bank delivers it (one file, header, text)."""
    df.toPandas().to_csv(path, sep=sep, index=False)


def sources(spark, day):
    """Relational sources: all rows created on DAY1; on DAY2 every fifth
    client changes phone (update_dt = DAY2)."""
    c = F.regexp_extract("client_id", r"(\d+)", 1).cast("int")
    changed = (c % 5 == 0) & F.lit(day == DAY2)
    clients = fx.clients(spark, D).withColumns({
        "phone": F.when(changed, F.concat("phone", F.lit("0"))).otherwise(F.col("phone")),
        "create_dt": F.lit(DAY1),
        "update_dt": F.when(changed, F.lit(DAY2)),
    })
    accounts = fx.accounts(spark, D).withColumnRenamed("account_num", "account").withColumns(
        {"create_dt": F.lit(DAY1), "update_dt": F.lit(None).cast("date")})
    cards = fx.cards(spark, D).withColumnRenamed("account_num", "account").withColumns(
        {"create_dt": F.lit(DAY1), "update_dt": F.lit(None).cast("date")})
    return clients, accounts, cards


def terminals_drop(spark, version):
    t = fx.terminals_hist(spark, D)
    t = t.where(F.col("effective_to") == F.lit(fx.OPEN_DATE)) if version == 2 else \
        t.where(F.col("effective_from") == F.lit(fx.HISTORY_START))
    if version == 2:  # terminal T1 closed on day 2
        t = t.where(F.col("terminal_id") != "T1")
    return t.select("terminal_id", "terminal_type", "terminal_city", "terminal_address")


def txn_drop(spark, lo, hi):
    t = fx.transactions_drop_text(spark, D)
    return t.where((F.col("transaction_date") >= lo) & (F.col("transaction_date") < hi))


@pytest.fixture(scope="module")
def setup(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("mart")
    landing = base / "landing"
    landing.mkdir()
    write_drop(terminals_drop(spark, 1), landing / "terminals_16012024.csv", ",")
    write_drop(fx.blacklist_drop_text(spark, D), landing / "passport_blacklist_16012024.csv", ",")
    write_drop(txn_drop(spark, "2024-01-01", "2024-01-16"), landing / "transactions_16012024.txt", ";")
    return base, landing


def test_two_days(spark, setup):
    base, landing = setup
    root = str(base / "store")
    cl, ac, ca = sources(spark, DAY1)
    r1 = daily.run_daily(spark, root, daily.Sources(ca, ac, cl, str(landing)), DAY1, run_id="20240116")
    assert {k: len(v) for k, v in r1.files.items()} == \
        {"terminals": 1, "passport_blacklist": 1, "transactions": 1}
    s1 = daily.read_state(spark, root)
    n_sup = fx.table(spark, D, "supplier").count()
    assert s1["terminals_hist"].count() == n_sup
    assert s1["clients_hist"].count() == fx.table(spark, D, "customer").count()
    n_tx = txn_drop(spark, "2024-01-01", "2024-01-16").where("amount <> 'n/a'").count()
    assert s1["fact_transactions"].count() == n_tx
    wm = {r.table_name: r for r in s1["watermarks"].collect()}
    assert wm["clients"].max_create_dt == DAY1 and wm["terminals"].max_update_dt == DAY1

    # day-1 report equals the rules run straight on the same inputs
    direct = rules.fraud_events(
        transaction_context(s1["clients_hist"], s1["accounts_hist"], s1["cards_hist"],
                            s1["fact_transactions"].drop("trans_dt"), s1["terminals_hist"], DAY1),
        s1["fact_passport_blacklist"])
    rep1 = s1["fraud_report"]
    assert rep1.count() > 0
    assert rep1.count() == direct.count()   # nothing was reported before: every event is new

    # day 2: new terminal snapshot (T1 gone), more transactions, changed clients
    write_drop(terminals_drop(spark, 2), landing / "terminals_31012024.csv", ",")
    write_drop(txn_drop(spark, "2024-01-16", "2024-02-01"), landing / "transactions_31012024.txt", ";")
    cl, ac, ca = sources(spark, DAY2)
    r2 = daily.run_daily(spark, root, daily.Sources(ca, ac, cl, str(landing)), DAY2, run_id="20240131")
    assert {k: len(v) for k, v in r2.files.items()} == \
        {"terminals": 1, "passport_blacklist": 0, "transactions": 1}   # ledger skips day-1 files
    s2 = daily.read_state(spark, root)
    th = s2["terminals_hist"]
    assert th.where("terminal_id = 'T1' AND deleted_flg = 'Y'").count() == 1
    moved = th.where(F.col("effective_from") == F.lit(DAY2)).count()
    assert moved == fx.table(spark, D, "supplier").where("s_suppkey % 4 = 0").count() + 1
    opens = th.where(F.col("effective_to") == F.lit(fx.OPEN_DATE)).groupBy("terminal_id").count()
    assert opens.where("count > 1").count() == 0
    n_changed = fx.table(spark, D, "customer").where("c_custkey % 5 = 0").count()
    assert s2["clients_hist"].count() == fx.table(spark, D, "customer").count() + n_changed
    assert s2["fact_transactions"].count() == n_tx + \
        txn_drop(spark, "2024-01-16", "2024-02-01").where("amount <> 'n/a'").count()
    assert s2["fraud_report"].where(F.col("report_dt") == F.lit(DAY2)).count() > 0
    assert s2["fraud_report"].where(F.col("report_dt") == F.lit(DAY1)).count() == rep1.count()


def test_old_terminals_survive_a_bad_attribute_and_only_terminals_may_be_missing(spark, tmp_path):
    """A row in quarantine still names its terminal; a database that was not read deletes nothing."""
    landing, root = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()
    head = "terminal_id,terminal_type,terminal_city,terminal_address\n"
    (landing / "terminals_1.csv").write_text(head + "T1,ATM,A,x\nT2,ATM,B,y\nT3,ATM,C,z\n")
    cl, ac, ca = sources(spark, DAY1)
    opt = daily.Options(missing_snapshot="delete")
    daily.run_daily(spark, root, daily.Sources(ca, ac, cl, str(landing)), DAY1, "1", opt)
    (landing / "terminals_2.csv").write_text(
        head + f"T1,ATM,A,x\nT2,ATM,{'B' * 21},y\nT3,ATM,C,z,surplus\n")
    daily.run_daily(spark, root, daily.Sources(None, ac, cl, str(landing)), DAY2, "2", opt)
    state = daily.read_state(spark, root)
    gone = state["terminals_hist"].where("deleted_flg = 'Y'").count()
    assert gone == 0
    assert state["cards_hist"].where("deleted_flg = 'Y'").count() == 0
    status = {(r.kind, r.run_id): r.status for r in state["run_status"].collect()}
    assert status[("terminals", "2")] == "read" and status[("transactions", "2")] == "missing"


def test_files_of_a_kind_that_is_handed_in_stay_unseen(spark, setup, tmp_path):
    _, landing = setup
    cl, ac, ca = sources(spark, DAY1)
    root = str(tmp_path / "store")
    r = daily.run_daily(spark, root, daily.Sources(
        ca, ac, cl, str(landing), transactions_drop=txn_drop(spark, "2024-01-01", "2024-01-02")),
        DAY1, "1")
    assert r.files["transactions"] == []
    r = daily.run_daily(spark, root, daily.Sources(ca, ac, cl, str(landing)), DAY2, "2")
    assert len(r.files["transactions"]) >= 1


def test_a_run_that_another_overtook_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish("1", {"t": ["run_id=1"]})
    with pytest.raises(RuntimeError):
        store.publish("3", {"t": ["run_id=3"]}, expected=None)
    store.publish("2", {"t": ["run_id=1", "run_id=2"]}, expected="1")
    assert store.latest().run_id == "2" and store.latest().parts["t"] == ["run_id=1", "run_id=2"]


def test_drops_with_columns_in_another_order(spark, tmp_path):
    """Each file is read by its own header; rows with more or fewer fields go to quarantine."""
    from fraudmart.sources import drops
    cols = ["transaction_id", "transaction_date", "amount", "card_num", "oper_type", "oper_result",
            "terminal"]
    other = ["card_num", "transaction_id", "amount", "terminal", "oper_result", "oper_type",
             "transaction_date"]
    row = dict(zip(cols, ["1", "2024-01-01 00:00:01", "10,50", "1000001", "PAYMENT", "SUCCESS", "T1"]))
    a, b = tmp_path / "transactions_1.txt", tmp_path / "transactions_2.txt"
    a.write_text(";".join(cols) + "\n" + ";".join(row[c] for c in cols) + "\n")
    b.write_text(";".join(other) + "\n" + ";".join({**row, "transaction_id": "2"}[c] for c in other)
                 + "\n" + ";".join({**row, "transaction_id": "3"}[c] for c in other) + ";more\n"
                 + "1000001;4\n" + ";".join({**row, "transaction_id": "5",
                                               "transaction_date": "2024-01-01"}[c] for c in other) + "\n")
    (tmp_path / "transactions_3.txt").write_text("")
    paths = [str(a), str(b), str(tmp_path / "transactions_3.txt")]
    got = drops.read_transactions(spark, paths)
    ok = drops.good(got).orderBy("trans_id").collect()
    assert [(r.trans_id, r.card_num, str(r.amt), r.terminal) for r in ok] == [
        ("1", "1000001", "10.50", "T1"), ("2", "1000001", "10.50", "T1")]
    assert sorted(r._error for r in drops.quarantine(got).collect()) == [
        "fields", "fields", "transaction_date"]
    x, y = tmp_path / "passport_blacklist_1.csv", tmp_path / "passport_blacklist_2.csv"
    x.write_text("date,passport\n2024-01-01,P1\n")
    y.write_text("passport,date\nP2,2024-01-02\n")
    bl = drops.read_blacklist(spark, [str(x), str(y)])
    assert sorted((r.passport_num, str(r.entry_dt)) for r in drops.good(bl).collect()) == [
        ("P1", "2024-01-01"), ("P2", "2024-01-02")]


def test_only_changed_buckets_are_written_again(spark, setup, tmp_path):
    """Without a change a day writes no dimension at all; with one key changed it writes that
    key's bucket and lists the others again."""
    _, given = setup
    landing = tmp_path / "landing"   # the first day's drops: another test adds the second day's
    landing.mkdir()
    for drop in given.glob("*_16012024.*"):
        shutil.copy(drop, landing)
    cl, ac, ca = sources(spark, DAY1)
    root = str(tmp_path / "store")
    first = daily.run_daily(spark, root, daily.Sources(ca, ac, cl, str(landing)), DAY1, "0")
    names = ("cards", "accounts", "clients", "terminals")
    for name in names:
        listed = first.parts[f"{name}_hist"]
        assert listed and all(p.startswith("run_id=0/slice=open/of=16/bucket=") for p in listed)
        assert len(listed) == len(set(listed)) <= 16
    terminals = terminals_drop(spark, 1)
    again = daily.run_daily(spark, root, daily.Sources(ca, ac, cl, terminals_drop=terminals),
                            DAY1 + dt.timedelta(days=1), "1")
    # a drop that is read from a file and the same drop handed in have the same digest
    for name in names:
        assert sorted(again.parts[f"{name}_hist"]) == sorted(first.parts[f"{name}_hist"])
        assert not os.path.exists(f"{root}/{name}_hist/run_id=1")
    one = cl.withColumns({"phone": F.when(F.col("client_id") == "C7", F.lit("+1")).otherwise(
        F.col("phone")), "update_dt": F.when(F.col("client_id") == "C7", F.lit(DAY2))})
    gone = terminals.where("terminal_id <> 'T3'")
    last = daily.run_daily(spark, root, daily.Sources(ca, ac, one, terminals_drop=gone), DAY2, "2")
    for name, changed in (("cards", 0), ("accounts", 0), ("clients", 1), ("terminals", 1)):
        listed = last.parts[f"{name}_hist"]
        opened = [p for p in listed if "slice=open" in p]
        assert sum(p.startswith("run_id=2") for p in opened) == changed, name
        assert len(opened) == len(first.parts[f"{name}_hist"])
        assert [p for p in listed if "slice=closed" in p] == ["run_id=2/slice=closed"] * changed
    state = daily.read_state(spark, root)
    assert state["clients_hist"].count() == fx.table(spark, D, "customer").count() + 1
    assert state["terminals_hist"].where("deleted_flg = 'Y'").count() == 1
    figures = {(r.table, r.figure): r.value for r in state["run_figures"].collect()
               if r.run_id == "2"}
    assert figures["clients_hist", "changed"] == figures["terminals_hist", "deleted"] == 1
    assert figures["clients", "read"] == 1 and ("cards_hist", "changed") not in figures


def test_another_number_of_buckets_lays_the_slice_out_anew(spark, tmp_path):
    root = str(tmp_path / "store")
    cl, ac, ca = sources(spark, DAY1)
    daily.run_daily(spark, root, daily.Sources(ca, ac, cl), DAY1, "0", daily.Options(open_buckets=4))
    before = {k: sorted(map(str, v.collect())) for k, v in daily.read_state(spark, root).items()
              if k.endswith("_hist")}
    r = daily.run_daily(spark, root, daily.Sources(ca, ac, cl), DAY2, "1", daily.Options(open_buckets=3))
    assert all("/of=3/" in p for p in r.parts["clients_hist"])
    after = {k: sorted(map(str, v.collect())) for k, v in daily.read_state(spark, root).items()
             if k.endswith("_hist")}
    assert after == before


def test_a_key_that_leaves_after_a_day_without_snapshot_is_found(spark, tmp_path):
    """The digests of the last snapshot say nothing about keys that came in between."""
    root = str(tmp_path / "store")
    _, ac, _ = sources(spark, DAY1)
    some = ac.where("account <> 'A9'")
    daily.run_daily(spark, root, daily.Sources(accounts=some), DAY1, "0")
    daily.run_daily(spark, root, daily.Sources(), DAY1 + dt.timedelta(days=1), "1")
    late_one = ac.where("account = 'A9'").withColumn("create_dt", F.lit(DAY2))
    # A9 is delivered while the snapshot of the same day has it; then it is gone
    daily.run_daily(spark, root, daily.Sources(accounts=some.unionByName(late_one)), DAY2, "2")
    daily.run_daily(spark, root, daily.Sources(accounts=some), DAY2 + dt.timedelta(days=1), "3")
    gone = daily.read_state(spark, root)["accounts_hist"].where("deleted_flg = 'Y'").collect()
    assert [r.account_num for r in gone] == ["A9"]


def test_exact_marks_take_late_rows_of_the_marks_date(spark, tmp_path):
    _, ac, _ = sources(spark, DAY1)
    some = ac.where("account NOT IN ('A9', 'A8')")
    for mode, n in (("strict", 0), ("exact", 2)):
        root = str(tmp_path / mode)
        opt = daily.Options(boundary=mode)
        daily.run_daily(spark, root, daily.Sources(accounts=some), DAY1, "0", opt)
        daily.run_daily(spark, root, daily.Sources(accounts=ac), DAY2, "1", opt)   # dated DAY1
        state = daily.read_state(spark, root)
        assert state["accounts_hist"].where("account_num IN ('A9', 'A8')").count() == n
        read = {r.run_id: r.value for r in state["run_figures"].collect()
                if (r.table, r.figure) == ("accounts", "read")}
        assert read["1"] == n


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    from fraudmart.sources import drops
    for i in range(12):
        cols = ["date", "passport"] if i % 2 else ["passport", "date"]
        row = {"date": "2024-01-01", "passport": f"P{i}"}
        (tmp_path / f"passport_blacklist_{i}.csv").write_text(
            ",".join(cols) + "\n" + ",".join(row[c] for c in cols) + "\n")
    paths = drops.unseen_files(spark, str(tmp_path), "passport_blacklist")
    sc = spark.sparkContext
    sc.setJobGroup("headers", "headers")
    try:
        got = drops.read_blacklist(spark, paths)
        assert len(sc.statusTracker().getJobIdsForGroup("headers")) <= 3   # AQE: a job a stage
    finally:
        sc.setJobGroup("tests", "")
    assert sorted(r.passport_num for r in drops.good(got).collect()) == sorted(f"P{i}" for i in range(12))


def test_crash_before_commit_keeps_previous_state(spark, setup, monkeypatch):
    base, landing = setup
    root = str(base / "crash")
    cl, ac, ca = sources(spark, DAY1)
    src = daily.Sources(ca, ac, cl, str(landing))
    daily.run_daily(spark, root, src, DAY1, run_id="1")
    before = {k: v.count() for k, v in daily.read_state(spark, root).items()}

    def boom(*a, **k):
        raise RuntimeError("executor lost during commit")
    monkeypatch.setattr(Store, "publish", boom)
    with pytest.raises(RuntimeError):
        daily.run_daily(spark, root, src, DAY2, run_id="2")
    monkeypatch.undo()
    after = {k: v.count() for k, v in daily.read_state(spark, root).items()}
    assert after == before and Store(spark, root).latest().run_id == "1"
    daily.run_daily(spark, root, src, DAY2, run_id="2")   # same run id re-runs cleanly
    assert Store(spark, root).latest().run_id == "2"
    with pytest.raises(ValueError):
        daily.run_daily(spark, root, src, DAY2, run_id="2")  # a published run is never rewritten
    assert os.path.isdir(os.path.join(root, "_manifests", "run_id=2"))


def test_drops_in_parquet_and_json(spark, tmp_path):
    from fraudmart.sources import drops
    landing = tmp_path / "landing"
    landing.mkdir()
    text = txn_drop(spark, "2024-01-01", "2024-01-04")
    typed = drops.good(drops.parse_transactions(text))
    # a typed parquet drop (numbers and times as such) and a JSON drop
    (typed.withColumnsRenamed({"trans_id": "transaction_id", "trans_date": "transaction_date",
                               "amt": "amount"})
     .toPandas().to_parquet(landing / "transactions_03012024.parquet", coerce_timestamps="us"))
    text.toPandas().to_json(landing / "transactions_02012024.json", orient="records", lines=True)
    paths = drops.unseen_files(spark, str(landing), "transactions")
    assert sorted(drops.drop_format(p) for p in paths) == ["json", "parquet"]
    got = drops.read_transactions(spark, paths)
    assert drops.good(got).count() == 2 * typed.count()
    assert drops.quarantine(got).count() == text.where("amount = 'n/a'").count()
    assert drops.good(got).select("trans_id", "trans_date", "amt").distinct().count() == typed.count()


def test_report_since_matches_the_full_report(spark, setup):
    base, landing = setup
    cl, ac, ca = sources(spark, DAY1)
    src = daily.Sources(ca, ac, cl, str(landing))
    since = dt.date(2024, 1, 10)
    full_root, part_root = str(base / "full"), str(base / "since")
    daily.run_daily(spark, full_root, src, DAY1, run_id="1")
    daily.run_daily(spark, part_root, src, DAY1, run_id="1",
                    options=daily.Options(report_since=since))
    full = daily.read_state(spark, full_root)["fraud_report"]
    part = daily.read_state(spark, part_root)["fraud_report"]
    expected = full.where(F.col("event_dt") >= F.lit(dt.datetime(2024, 1, 10)))
    assert sorted(map(tuple, part.collect())) == sorted(map(tuple, expected.collect()))
    assert part.count() > 0
