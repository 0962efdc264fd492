"""Operators that follow change instead of size: sets of days, versions in force, late
changes, digests of key buckets, exact marks, hot keys."""

import datetime as dt
import random
import re
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.operators import (asof, digests, facts, late, maintained, scd2, sequence,
                                 spread)
from fraudmart.operators.context import transaction_context
from fraudmart.plans import change_queries as cq
from fraudmart.schemas import CLIENTS, OPEN_DATE, TERMINALS, DimSpec
from fraudmart.sources import extract
from fraudmart.sources import fixtures as fx
from tests.conftest import SF
from tests.test_scd2_property import as_rows

D = SF["0.001"]
DAY = dt.date(2024, 1, 1)

def days(n):
    return DAY + dt.timedelta(days=n)


# --- F2

def test_append_reads_only_the_days_of_the_batch(spark, tmp_path):
    """Days between the batch's own hold files that are no Parquet: reading one would fail."""
    t = fx.transactions(spark, D)
    path = str(tmp_path / "fact")
    loaded = t.withColumn("trans_dt", F.to_date("trans_date"))
    loaded.write.partitionBy("trans_dt").parquet(path)
    wanted = {dt.date(2024, 1, 2), dt.date(2024, 1, 27)}
    for folder in (tmp_path / "fact").glob("trans_dt=*"):
        if dt.date.fromisoformat(folder.name[9:]) not in wanted:
            for f in folder.glob("*.parquet"):
                f.write_bytes(b"no parquet")
            for f in folder.glob(".*.crc"):
                f.write_bytes(b"")
    fact = spark.read.schema(loaded.schema).parquet(path)
    batch = t.where(F.to_date("trans_date").isin(*wanted))
    fresh = batch.limit(3).withColumn("trans_id", F.concat(F.lit("new"), F.col("trans_id")))
    got = facts.append_transactions(batch.unionByName(fresh), fact)
    assert as_rows(got.collect()) == as_rows(fresh.select(*got.columns).collect())
    assert facts.append_transactions(batch.limit(0), fact).count() == 0


# --- as of a day

def _versions(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, s date, e date")


def test_as_of_matches_the_range_join(spark):
    rnd = random.Random(4)
    versions = []
    for k in "abcde":
        at = 0
        while at < 60:
            length = rnd.randint(0, 6)
            if rnd.random() < .8:   # else a gap
                versions.append((k, f"{k}{at}", days(at), days(at + length - 1)))
            at += length
        versions.append((k, None, days(at), OPEN_DATE))
    rows = [(rnd.choice("abcdef"), days(rnd.randint(-5, 80)), i) for i in range(500)]
    rows += [(None, days(3), 900), ("a", None, 901), ("a", days(4), 902), ("a", days(4), 902)]
    f = spark.createDataFrame(rows, "k string, d date, i int")
    v = _versions(spark, versions)
    r = v.select(F.col("k").alias("vk"), "v", "s", "e")
    for how in ("inner", "left"):
        got = asof.as_of_join(f, v, "k", F.col("d"), "s", "e", ["v"], how)
        want = f.join(r, (F.col("k") == F.col("vk")) & F.col("d").between(F.col("s"), F.col("e")), how)
        assert as_rows(got.select("k", "d", "i", "v").collect()) == \
            as_rows(want.select("k", "d", "i", "v").collect())


def test_overlapping_versions_stop_the_job(spark):
    f = spark.createDataFrame([("a", days(3), 1)], "k string, d date, i int")
    v = _versions(spark, [("a", "x", days(0), days(4)), ("a", "y", days(4), OPEN_DATE)])
    with pytest.raises(Exception, match="overlap"):
        asof.as_of_join(f, v, "k", F.col("d"), "s", "e", ["v"]).collect()
    t = fx.terminals_hist(spark, D)
    twice = t.unionByName(t)
    args = [fx.clients_hist(spark, D), fx.accounts_hist(spark, D), fx.cards_hist(spark, D),
            fx.transactions(spark, D), twice, fx.REPORT_RUN_DATE, "as_of"]
    assert transaction_context(*args, version_join="range").count() > 0
    with pytest.raises(ValueError):
        transaction_context(*args, version_join="nothing")


def test_many_versions_do_not_multiply_the_facts(spark):
    """1,000 versions of one key: no operator of the plan that ran puts out more rows than
    facts and versions together."""
    n = 1000
    v = _versions(spark, [("a", str(i), days(i), days(i)) for i in range(n)])
    f = spark.range(5000).select(F.lit("a").alias("k"), F.date_add(
        F.lit(DAY), (F.col("id") % n).cast("int")).alias("d"), "id")
    got = asof.as_of_join(f, v, "k", F.col("d"), "s", "e", ["v"])
    assert got.where(F.col("v") == F.datediff("d", F.lit(DAY)).cast("string")).count() == 5000
    got.collect()
    most = max(_join_rows(got))
    assert most <= 5000, most


def _join_rows(df):
    """Rows that each join of the plan that ran put out."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(p.plan())
            continue
        if "Join" in name:
            out.append(p.metrics().apply("numOutputRows").value())
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


# --- late changes

def _stage(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, b string, create_dt date, update_dt date")


def test_any_order_of_deliveries_gives_one_history(spark):
    want = as_rows(cq.late_history(spark, D).collect())
    for order in (("late", "2", "1", "3"), ("1", "2", "3", "late", "1")):
        assert as_rows(cq.late_history(spark, D, order).collect()) == want, order


def _plain_history(rows):
    """{key: [(from, to, a, b)]} by sorting a key's rows by date."""
    out = {}
    for k in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == k]
        by_date = {}
        for r in mine:
            at = r[4] or r[3]
            by_date[at] = max(by_date.get(at, ("", "")), (r[1], r[2]))
        dates = sorted(by_date)
        born = min(min(r[3], r[4] or r[3]) for r in mine)
        said = [(min(dates[0], born), by_date[dates[0]])]
        for d in dates[1:]:
            if by_date[d] != said[-1][1]:
                said.append((d, by_date[d]))
        ends = [d - dt.timedelta(days=1) for d, _ in said[1:]] + [OPEN_DATE]
        out[k] = [(d, e, *ab) for (d, ab), e in zip(said, ends)]
    return out


def test_late_changes_match_plain_python(spark):
    rnd = random.Random(9)
    spec = DimSpec("d", "k", ("a", "b"))
    rows = []
    for _ in range(120):
        create = days(rnd.randint(0, 10))
        update = None if rnd.random() < .3 else create + dt.timedelta(days=rnd.randint(0, 8))
        rows.append((rnd.randint(1, 8), rnd.choice("xyz"), rnd.choice("pq"), create, update))
    want = _plain_history(rows)
    empty = "k long, a string, b string, effective_from date, effective_to date, deleted_flg string"
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        hist = spark.createDataFrame([], empty)
        log = spark.createDataFrame([], "k long, a string, b string, seen_from date, born date, "
                                        "deleted_flg string, seq long")
        for at in range(0, len(rows), 40):
            hist, new = late.apply_late(hist, log, _stage(spark, rows[at:at + 40]), spec, days(30))
            hist, log = cq.kept(hist, "h"), log.unionByName(cq.kept(new, "l"))
        got = {}
        for r in hist.orderBy("k", "effective_from").collect():
            got.setdefault(r.k, []).append((r.effective_from, r.effective_to, r.a, r.b))
        assert got == want


def test_late_change_before_a_deletion(spark):
    spec = DimSpec("d", "k", ("a", "b"))
    empty = "k long, a string, b string, effective_from date, effective_to date, deleted_flg string"
    hist = spark.createDataFrame([], empty)
    log = spark.createDataFrame([], "k long, a string, b string, seen_from date, born date, "
                                    "deleted_flg string, seq long")
    one = spark.createDataFrame([(1,), (2,)], "k long")
    hist, new = late.apply_late(hist, log, _stage(spark, [(1, "x", None, DAY, None),
                                                          (2, "x", None, DAY, None)]), spec, DAY, one)
    hist, log = cq.kept(hist, "h"), log.unionByName(cq.kept(new, "l"))
    hist, new = late.apply_late(hist, log, _stage(spark, []), spec, days(5), one.where("k = 1"))
    hist, log = cq.kept(hist, "h"), log.unionByName(cq.kept(new, "l"))
    hist, new = late.apply_late(hist, log, _stage(spark, [(2, "y", "z", DAY, days(3))]), spec, days(6),
                                one.where("k = 1"))
    got = sorted(map(tuple, hist.collect()), key=str)
    assert got == sorted([
        (1, "x", None, DAY, OPEN_DATE, "N"), (2, "x", None, DAY, days(2), "N"),
        (2, "y", "z", days(3), days(4), "N"), (2, "y", "z", days(5), OPEN_DATE, "Y")], key=str)


def test_a_log_can_begin_with_a_history(spark):
    hist = cq.late_history(spark, D, ("1", "2"))
    log = late.log_of_history(hist, CLIENTS)
    again, _ = late.apply_late(hist, log, fx.late_clients(spark, D), CLIENTS, fx.REPORT_RUN_DATE)
    assert as_rows(again.collect()) == as_rows(cq.late_history(spark, D, ("1", "2", "late")).collect())


# --- digests

def test_equal_snapshots_have_equal_digests(spark):
    keys = fx.clients(spark, D).select("client_id")
    a = digests.digests(keys, "client_id")
    b = digests.digests(keys.orderBy(F.rand(1)).repartition(5), "client_id")
    assert digests.differing(a, b).count() == 0
    assert a.agg(F.sum("n")).first()[0] == keys.count()
    changed = fx.clients(spark, D).withColumn("phone", F.when(
        F.col("client_id") == "C7", F.lit(None).cast("string")).otherwise(F.col("phone")))
    full = [digests.digests(x, "client_id", columns=("phone",))
            for x in (fx.clients(spark, D), changed)]
    assert digests.differing(*full).count() == 1   # attributes count where they are named


def test_only_changed_buckets_are_compared(spark):
    t = fx.terminals_hist(spark, SF["0.01"]).where(F.col("effective_to") == F.lit(OPEN_DATE))
    keys = t.select("terminal_id")
    before = digests.digests(keys, "terminal_id")
    run = dt.date(2024, 2, 1)
    same = digests.differing(before, digests.digests(keys, "terminal_id"))
    assert digests.in_buckets(t, "terminal_id", same).count() == 0
    left = keys.where("terminal_id NOT IN ('T3', 'T17')")
    wanted = digests.differing(before, digests.digests(left, "terminal_id"))
    assert wanted.count() <= 2
    assert digests.in_buckets(t, "terminal_id", wanted).count() < t.count() / 4
    got = digests.deleted_by_digest(t, left, before, TERMINALS, run)
    assert as_rows(got.collect()) == as_rows(scd2.scd2_tombstones(t, left, TERMINALS, run).collect())
    # a repeated key only costs a comparison
    twice = keys.unionByName(keys.where("terminal_id = 'T3'"))
    assert digests.deleted_by_digest(t, twice, before, TERMINALS, run).count() == 0


# --- exact marks

def test_rows_of_the_marks_date_are_taken_once(spark):
    schema = "k long, v string, create_dt date, update_dt date"
    taken = spark.createDataFrame([], extract.TAKEN)
    seen = [(1, "a", DAY, None), (2, "a", days(1), None), (3, None, days(0), days(1))]
    got = extract.boundary_extract(spark.createDataFrame(seen, schema), fx.EPOCH_DATE, fx.EPOCH_DATE,
                                   taken)
    assert got.count() == 3
    taken = extract.taken_at_marks(got, taken, days(1), days(1))
    assert taken.count() == 2
    # late with the mark's date; changed with the mark's date; older than both marks
    seen += [(4, "b", days(1), None), (5, "b", DAY, days(1)), (6, "b", DAY, None)]
    seen[1] = (2, "c", days(1), None)
    src = spark.createDataFrame(seen, schema)
    got = extract.boundary_extract(src, days(1), days(1), taken)
    assert sorted(r.k for r in got.collect()) == [2, 4, 5]
    taken = extract.taken_at_marks(got, taken, days(1), days(1))
    assert extract.boundary_extract(src, days(1), days(1), taken).count() == 0


def test_boundary_filter_reaches_the_scan(spark, tmp_path):
    from tests.test_plans import plan
    fx.orders_source(spark, D).write.parquet(str(tmp_path / "o"))
    p = plan(extract.boundary_extract(spark.read.parquet(str(tmp_path / "o")), DAY, DAY,
                                      spark.createDataFrame([], extract.TAKEN)))
    assert re.search(r"PushedFilters: \[Or\(GreaterThanOrEqual\(create_dt", p), p


# --- hot keys

def test_hot_keys_are_found(spark):
    t = fx.transactions_hot(spark, SF["0.01"])
    assert spread.hot_keys(t, "card_num", 0.05).values == ("1000001",)
    assert spread.hot_keys(t, "terminal", 0.05).values == ("T1",)
    assert spread.hot_keys(t.limit(0), "terminal").values == ()


def test_a_hot_key_is_spread_without_the_planners_help(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
           "spark.sql.shuffle.partitions": "200"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        f = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.col("id").cast("string")).alias("k"), F.lit(1).alias("same"))
        other = f.select("k").distinct().withColumn("v", F.length("k"))
        hot = spread.hot_keys(f, "k", 0.05)
        assert hot.values == ("hot",)
        for how in ("inner", "left"):
            got = spread.spread_join(f, other, ["k"], how, hot)
            at = got.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
            assert len(at) >= 50 and sum(r["count"] for r in at) == 10_000
            assert max(r["count"] for r in at) < 1000
            assert got.count() == 30_000
    finally:
        for k in off:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    with pytest.raises(ValueError):
        spread.spread_join(f, other, ["k"], "outer", hot)


def test_hot_context_equals_the_plain_one(spark):
    t = fx.transactions_hot(spark, D)
    plain = transaction_context(
        fx.clients_hist(spark, D), fx.accounts_hist(spark, D), fx.cards_hist(spark, D), t,
        fx.terminals_hist(spark, D), fx.REPORT_RUN_DATE)
    assert as_rows(cq.hot_context(spark, D).collect()) == as_rows(plain.collect())
    as_of = [transaction_context(
        fx.clients_hist(spark, D), fx.accounts_hist(spark, D), fx.cards_hist(spark, D), t,
        fx.terminals_hist(spark, D), fx.REPORT_RUN_DATE, "as_of", **hot) for hot in (
            {}, {"hot_card": spread.hot_keys(t, "card_num", .05),
                 "hot_terminal": spread.hot_keys(t, "terminal", .05)})]
    assert as_rows(as_of[0].collect()) == as_rows(as_of[1].collect())


# --- lead/lag day by day

def _ops(spark, rows):
    """(card, minute, amount) -> context rows."""
    full = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m) if m is not None else None, "p", None,
             "1", DAY, None, "c", card, None, f"{card}{m}{a}", "PAYMENT", a, "REJECT", "t",
             "AB"[a % 2], None) for card, m, a in rows]
    return spark.createDataFrame(full, "trans_date timestamp_ntz, passport string, fio string, "
        "phone string, report_dt date, passport_valid_to date, client_id string, card_num string, "
        "ac_valid_to date, trans_id string, oper_type string, amt int, oper_result string, "
        "terminal_id string, terminal_city string, te_effective_from date")


def test_maintained_sequence_equals_the_whole_one(spark):
    rnd = random.Random(6)
    empty = maintained.named(sequence.card_sequence(_ops(spark, []).limit(0)), 0)
    steps, tail, replaced, all_rows = empty, empty, empty.select(*maintained.NAME), []
    for n in range(1, 6):
        low = 100 * n - (250 if n in (3, 5) else 0)   # batches 3 and 5 reach back
        batch = [(rnd.choice("abc"), rnd.randint(low, 100 * n + 99), rnd.randint(1, 9))
                 for _ in range(rnd.choice([1, 12, 40]))]
        if n == 4:
            batch.append(("a", None, 5))
        all_rows += batch
        new = cq.kept(maintained.named(_ops(spark, batch), n), "n")
        step = maintained.advance(maintained.current(steps, replaced), tail, new, n)
        steps = steps.unionByName(cq.kept(step.rows, "r"))
        replaced = replaced.unionByName(cq.kept(step.replaced, "x"))
        tail = cq.kept(step.tail, "t")
        got = maintained.current(steps, replaced).drop(*maintained.NAME)
        assert as_rows(got.collect()) == as_rows(
            sequence.card_sequence_whole(_ops(spark, all_rows)).select(*got.columns).collect()), n
        assert tail.groupBy("card_num").count().agg(F.max("count")).first()[0] <= 3


def test_a_batch_is_worked_out_once(spark):
    """What is appended and replaced is read from one written sequence, and the appended rows
    with what replaced them serve as history. Operations that are equal in every column, more
    of them than the tail holds, keep their order over batches that another card's lie between."""
    empty = maintained.named(sequence.card_sequence(_ops(spark, []).limit(0)), 0)
    steps, tail, replaced, all_rows = empty, empty, empty.select(*maintained.NAME), []
    same = _ops(spark, [("a", 5, 3)])
    same = same.unionByName(same).unionByName(same)
    same = same.unionByName(same).coalesce(1)
    for n, new in enumerate((same, _ops(spark, [("b", 9, 1)]), _ops(spark, [("a", 100, 4), ("b", 9, 2)]),
                             _ops(spark, [("a", 7, 8)])), 1):
        all_rows.append(new)
        new = cq.kept(maintained.named(new, n), "n")
        step = maintained.advance(steps, tail, new, n, replaced)
        for df in (step.rows, step.replaced):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        steps = steps.unionByName(cq.kept(step.rows, "r"))
        replaced = replaced.unionByName(cq.kept(step.replaced, "x"))
        tail = cq.kept(step.tail, "t")
        got = maintained.current(steps, replaced).drop(*maintained.NAME)
        whole = sequence.card_sequence_whole(reduce(DataFrame.unionByName, all_rows))
        assert as_rows(got.collect()) == as_rows(whole.select(*got.columns).collect()), n


def test_an_ordinary_day_reads_no_history(spark, tmp_path):
    first = cq.kept(maintained.named(_ops(spark, [("a", i, 3) for i in range(9)]), 1), "n")
    empty = maintained.named(sequence.card_sequence(_ops(spark, []).limit(0)), 0)
    step = maintained.advance(empty, empty, first, 1)
    tail = cq.kept(step.tail, "t")
    path = tmp_path / "history"
    step.rows.write.parquet(str(path))
    history = spark.read.schema(step.rows.schema).parquet(str(path))
    for f in [*path.glob("*.parquet"), *path.glob(".*.crc")]:
        f.write_bytes(b"no parquet")   # reading it would fail
    new = cq.kept(maintained.named(_ops(spark, [("a", 100, 4), ("b", 1, 4)]), 2), "n")
    step = maintained.advance(history, tail, new, 2)
    assert step.rows.count() == 3 and step.replaced.count() == 1   # two new rows, one next operation
    late = cq.kept(maintained.named(_ops(spark, [("a", 5, 1)]), 3), "n")
    with pytest.raises(Exception):
        maintained.advance(history, cq.kept(step.tail, "t"), late, 3).rows.count()
