"""Golden counts written down with the fixtures (FIXTURES.md, Part C)."""

from pyspark.sql import functions as F

from fraudmart.plans import queries as Q
from tests.conftest import SF

D = SF["0.01"]


def _count(spark, name):
    return Q.registry()[name](spark, D).count()


def test_rule_counts_history_all(spark):
    ev = Q.registry()["fraud_events"](spark, D)
    got = {r.event_type: r.n for r in ev.groupBy("event_type").agg(F.count("*").alias("n")).collect()}
    assert got == {"1": 4923, "2": 2288, "3": 150, "4": 1}
    assert ev.where(F.col("fio").isNull()).count() == 174


def test_rule_counts_as_of(spark):
    ev = Q.registry()["fraud_events_as_of"](spark, D)
    got = {r.event_type: r.n for r in ev.groupBy("event_type").agg(F.count("*").alias("n")).collect()}
    assert got == {"1": 3980, "2": 1839, "3": 150, "4": 6}
    assert ev.where(F.col("fio").isNull()).count() == 145


def test_duplicate_event_rows(spark):
    ev = Q.registry()["fraud_events"](spark, D)
    dup = ev.count() - ev.distinct().count()
    assert dup == 1394


def test_scd2_counts(spark):
    assert _count(spark, "scd2_apply_day1") == 91
    assert _count(spark, "scd2_new") == 8
    assert _count(spark, "scd2_changed") == 19
    assert _count(spark, "scd2_deleted") == 9
    assert _count(spark, "scd2_apply_day2") == 127
    assert _count(spark, "scd2_apply_day3") == 137
    assert _count(spark, "scd2_open_day3") == 100
    assert _count(spark, "scd2_resurrected") == 9
    h2 = Q.registry()["scd2_apply_day2"](spark, D)
    assert h2.where("effective_to = DATE'9999-12-31'").count() == 99
    assert h2.where("effective_to = DATE'9999-12-31' AND deleted_flg = 'Y'").count() == 9


def test_extract_and_facts(spark):
    assert _count(spark, "extract_incremental") == 2284
    assert _count(spark, "extract_incremental_late") == 938
    assert _count(spark, "fact_transactions_append") == 3333
    assert _count(spark, "fact_transactions_append_by_time") == 2770


def test_watermark_moves_back_unless_monotone(spark):
    d = SF["0.001"]
    parity = Q.registry()["watermark_advance"](spark, d).where("table_name='orders'").first()
    mono = Q.registry()["watermark_advance_monotone"](spark, d).where("table_name='orders'").first()
    assert str(parity.max_create_dt) == "2001-07-30"
    assert str(mono.max_create_dt) == "2001-08-01"
    assert str(parity.max_update_dt) == "2002-07-08"


def test_rule_counts_at_bench_scale(spark):
    d = SF["0.1"]
    for name, expected in (("fraud_events", {"1": 48960, "2": 22437, "3": 1500, "4": 18}),
                           ("fraud_events_as_of", {"1": 39249, "2": 18011, "3": 1500, "4": 33})):
        ev = Q.registry()[name](spark, d)
        got = {r.event_type: r.n
               for r in ev.groupBy("event_type").agg(F.count("*").alias("n")).collect()}
        assert got == expected, name
    assert Q.registry()["fact_transactions_append_by_time"](spark, d).count() == 5153
    assert Q.registry()["extract_incremental"](spark, d).count() == 22453
