"""SCD2 against a brute-force model of the source system's statements
(insert new → insert changed + close old → insert tombstones + close), on
seeded random five-day histories with NULL attributes, deletions and
restores. Also checks the one-open-row-per-key invariant and idempotence."""

import datetime as dt
import random

import pytest

from fraudmart.operators import scd2
from fraudmart.schemas import OPEN_DATE, DimSpec

SPEC = DimSpec("t", "k", ("a", "b"), new_from="update_dt", change_from="update_dt")
H_SCHEMA = "k string, a string, b string, effective_from date, effective_to date, deleted_flg string"
S_SCHEMA = "k string, a string, b string, update_dt date"


def model_day(hist, stage, keys, run):
    """hist: list of lists [k, a, b, from, to, flag]; stage rows (k, a, b, update_dt)."""
    hist = [list(r) for r in hist]
    known = {r[0] for r in hist}
    for k, a, b, u in stage:                       # D1
        if k not in known:
            hist.append([k, a, b, u, OPEN_DATE, "N"])
    chg = [(s, h) for s in stage for h in hist
           if h[0] == s[0] and h[4] == OPEN_DATE and (s[1] != h[1] or s[2] != h[2] or h[5] == "Y")]
    for s, _ in chg:                               # D2
        hist.append([s[0], s[1], s[2], s[3], OPEN_DATE, "N"])
    for s, h in chg:                               # D3
        h[4] = s[3] - dt.timedelta(days=1)
    if keys is not None:
        gone = [h for h in hist if h[4] == OPEN_DATE and h[5] == "N" and h[0] not in keys]
        for h in gone:                             # D5
            hist.append([h[0], h[1], h[2], run, OPEN_DATE, "Y"])
        for h in gone:                             # D6
            h[4] = run - dt.timedelta(days=1)
    return hist


def random_days(seed, n_days=5, n_keys=8):
    rnd = random.Random(seed)
    vals = [None, "x", "y"]
    days = []
    for d in range(n_days):
        run = dt.date(2024, 1, 1) + dt.timedelta(days=d)
        snap = [(str(k), rnd.choice(vals), rnd.choice(vals), run)
                for k in range(n_keys) if rnd.random() < 0.75]
        days.append((run, snap))
    return days


def as_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mode", ["snapshot", "incremental"])
def test_apply_matches_model(spark, seed, mode):
    hist_rows = []
    prev_snap = {}
    for run, snap in random_days(seed):
        if mode == "snapshot":
            stage_rows = snap                      # full snapshot (terminals-like)
        else:                                      # only new/changed rows, keys in full
            stage_rows = [r for r in snap if prev_snap.get(r[0]) != r[1:3]]
        keys = {r[0] for r in snap}
        expected = model_day(hist_rows, stage_rows, keys, run)
        h = spark.createDataFrame(hist_rows, H_SCHEMA)
        s = spark.createDataFrame(stage_rows, S_SCHEMA)
        kdf = spark.createDataFrame([(k,) for k in keys], "k string")
        got = scd2.scd2_apply(h, s, SPEC, run, keys=kdf)
        got_rows = [list(r) for r in got.collect()]
        assert as_rows(got_rows) == as_rows(expected), run
        opens = [r[0] for r in got_rows if r[4] == OPEN_DATE]
        assert len(opens) == len(set(opens))       # one open row per key
        # same day, same inputs again: nothing changes (keys(S) ⊆ K here)
        again = scd2.scd2_apply(spark.createDataFrame(got_rows, H_SCHEMA), s, SPEC, run, keys=kdf)
        assert as_rows(again.collect()) == as_rows(got_rows)
        hist_rows = got_rows
        prev_snap = {r[0]: r[1:3] for r in snap}


def test_step_operators_agree_with_apply(spark):
    (run1, snap1), (run2, snap2) = random_days(42, n_days=2, n_keys=12)
    h1 = spark.createDataFrame(model_day([], snap1, {r[0] for r in snap1}, run1), H_SCHEMA)
    s2 = spark.createDataFrame(snap2, S_SCHEMA)
    k2 = s2.select("k")
    touched = scd2.scd2_touched(h1, s2, SPEC, run2, keys=k2)
    by_change = {r.change for r in touched.select("change").distinct().collect()}
    assert by_change <= {"new", "changed", "restored", "deleted", "unchanged"}
    new = {r.k for r in scd2.scd2_new(h1, s2, SPEC).collect()}
    changed = {r.k for r in scd2.scd2_changed(h1, s2, SPEC).collect()}
    closed = {r.k for r in scd2.scd2_closed(h1, s2, SPEC).collect()}
    assert closed == changed
    t_new = {r.k for r in touched.where("change = 'new'").collect()}
    t_chg = {r.k for r in touched.where("change IN ('changed', 'restored')").collect()}
    assert t_new == new
    assert t_chg == changed


@pytest.mark.parametrize("seed", [7, 8])
def test_full_snapshots_as_of_reproduces_each_day(spark, seed):
    """Full snapshot once per day: the live open rows equal the last snapshot,
    and the live rows valid on day d equal snapshot d."""
    from pyspark.sql import functions as F

    hist_rows, days = [], random_days(seed)
    for run, snap in days:
        h = spark.createDataFrame(hist_rows, H_SCHEMA)
        s = spark.createDataFrame(snap, S_SCHEMA)
        hist_rows = [list(r) for r in
                     scd2.scd2_apply(h, s, SPEC, run, keys=s.select("k")).collect()]
    h = spark.createDataFrame(hist_rows, H_SCHEMA)
    live_open = h.where((F.col("effective_to") == F.lit(OPEN_DATE)) & (F.col("deleted_flg") == "N"))
    assert as_rows(live_open.select("k", "a", "b").collect()) == \
        as_rows([r[:3] for r in days[-1][1]])
    for run, snap in days:
        valid = h.where((F.col("effective_from") <= F.lit(run)) & (F.col("effective_to") >= F.lit(run))
                        & (F.col("deleted_flg") == "N"))
        assert as_rows(valid.select("k", "a", "b").collect()) == as_rows([r[:3] for r in snap]), run
