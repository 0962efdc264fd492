"""DuckDB SQL of ``change_queries``, said from the definitions."""

from __future__ import annotations

from fraudmart.plans.oracle_sql import (
    ACCOUNTS, BLACKLIST, CARDS, CLIENTS, CTX_COLS, MIDNIGHT, OPEN, ORDERS_SRC, TERMINALS,
    TRANSACTIONS, TXN_COLS, TXN_TEXT, operations, oracle_queries, scd2_through, two_day_queries, with_fixtures,
)


def _with(ctes, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


TERMINALS_DAILY = TERMINALS.replace("terminals_hist AS (", "terminals_old AS (") + """,
terminals_one AS (SELECT *, CAST(substr(terminal_id, 2) AS INTEGER) AS n FROM terminals_old
                  WHERE effective_from = DATE '2023-01-01'),
terminals_hist AS (
  SELECT terminal_id, terminal_type, 'CITY_' || ((n + d) % 25) AS terminal_city, terminal_address,
         CAST(DATE '2023-12-31' + CAST(d AS INTEGER) AS DATE) AS effective_from,
         CASE WHEN d = 30 THEN DATE '9999-12-31'
              ELSE CAST(DATE '2023-12-31' + CAST(d AS INTEGER) AS DATE) END AS effective_to, deleted_flg
  FROM terminals_one, range(1, 31) AS days(d) WHERE (n + d) % 5 <> 0)"""

CLIENTS_MANY = CLIENTS.replace("clients_hist AS (", "clients_old AS (") + """,
clients_hist AS (
  SELECT * EXCLUDE (v)
         REPLACE (phone || '-' || v AS phone,
                  CAST(DATE '2024-01-01' + CAST(3 * v AS INTEGER) AS DATE) AS effective_from,
                  CAST(DATE '2024-01-03' + CAST(3 * v AS INTEGER) AS DATE) AS effective_to)
  FROM clients_old, range(0, 10) AS versions(v)
  WHERE (CAST(substr(client_id, 2) AS BIGINT) + v) % 6 <> 0)"""

HOT = TRANSACTIONS.replace("transactions AS (", "transactions_even AS (", 1) + """,
transactions AS (
  SELECT * REPLACE (CASE WHEN CAST(trans_id AS BIGINT) % 3 = 0 THEN '1000001' ELSE card_num END
                      AS card_num,
                    CASE WHEN CAST(trans_id AS BIGINT) % 3 = 1 THEN 'T1' ELSE terminal END AS terminal)
  FROM transactions_even)"""

LATE = CLIENTS.replace("clients_hist AS (", "clients_all AS (") + """,
src AS (SELECT * EXCLUDE (effective_from, effective_to, deleted_flg),
               CAST(substr(client_id, 2) AS BIGINT) % 1000000 AS c FROM clients_all),
said AS (
  SELECT * EXCLUDE (c), DATE '2024-01-01' AS seen, DATE '2024-01-01' AS born FROM src WHERE c % 11 <> 3
  UNION ALL
  SELECT * EXCLUDE (c) REPLACE (phone || 'x' AS phone), DATE '2024-01-02',
         CASE WHEN c % 14 <> 1 THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END
  FROM src WHERE c % 10 <> 0 AND c % 7 = 1 AND c % 11 <> 3
  UNION ALL
  SELECT * EXCLUDE (c), DATE '2024-01-02', DATE '2024-01-02' FROM src WHERE c % 10 <> 0 AND c % 11 = 3
  UNION ALL
  SELECT * EXCLUDE (c), DATE '2024-01-03', DATE '2024-01-01' FROM src WHERE c % 10 = 0
  UNION ALL
  SELECT * EXCLUDE (c) REPLACE (phone || 'y' AS phone),
         CASE WHEN c % 9 = 4 THEN DATE '2023-12-20' ELSE DATE '2024-01-02' END, DATE '2023-12-20'
  FROM src WHERE c % 9 IN (4, 5)),
one AS (SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY client_id, seen
                                                      ORDER BY phone DESC) = 1),
births AS (SELECT client_id, min(born) AS born, min(seen) AS first_seen FROM said GROUP BY client_id),
placed AS (SELECT o.* REPLACE (CASE WHEN o.seen = b.first_seen THEN least(o.seen, b.born)
                                    ELSE o.seen END AS seen)
           FROM one o JOIN births b USING (client_id)),
news AS (SELECT * FROM placed
         QUALIFY lag(phone) OVER (PARTITION BY client_id ORDER BY seen) IS DISTINCT FROM phone)"""

BOUNDARY = ORDERS_SRC + """,
dated AS (SELECT *, greatest(create_dt, coalesce(update_dt, create_dt)) AS last FROM src),
b1 AS (SELECT * FROM dated WHERE k % 3 < 1 AND last <= DATE '2001-06-01'),
m1 AS (SELECT max(create_dt) AS c, max(update_dt) AS u FROM b1),
b2 AS (SELECT d.* FROM dated d, m1 WHERE k % 3 < 2 AND last <= DATE '2001-09-01'
       AND (create_dt >= c OR update_dt >= u) AND k NOT IN (SELECT k FROM b1)),
m2 AS (SELECT greatest(max(c), (SELECT max(create_dt) FROM b2)) AS c,
              greatest(max(u), (SELECT max(update_dt) FROM b2)) AS u FROM m1),
b3 AS (SELECT d.* FROM dated d, m2 WHERE k % 3 < 3 AND last <= DATE '2002-01-01'
       AND (create_dt >= c OR update_dt >= u) AND k NOT IN (SELECT k FROM b1)
       AND k NOT IN (SELECT k FROM b2))"""


def figures_sql() -> str:
    """Day 2 of the two daily runs, counted from the fixtures."""
    moved = "SELECT terminal_id FROM terminals_all WHERE effective_from = DATE '2024-01-15'"
    last = f"SELECT terminal_id FROM terminals_all WHERE effective_to = {OPEN}"
    fifth = "SELECT * FROM clients_old WHERE CAST(substr(client_id, 2) AS BIGINT) % 5 = 0"
    again = "SELECT * FROM parsed WHERE transaction_date >= '2024-01-10'"
    rows = [
        ("cards", "read", "0"), ("accounts", "read", "0"), ("clients", "read", f"FROM ({fifth})"),
        ("terminals", "read", f"FROM ({last}) WHERE terminal_id <> 'T1'"),
        ("terminals", "quarantined", "0"),
        ("passport_blacklist", "read", "0"), ("passport_blacklist", "quarantined", "0"),
        ("transactions", "read", f"FROM ({again})"),
        ("transactions", "quarantined", f"FROM ({again}) WHERE _error IS NOT NULL"),
        *[("clients_hist", k, f"FROM ({fifth})" if k == "changed" else "0")
          for k in ("new", "changed", "restored", "deleted")],
        *[("terminals_hist", k, {"changed": f"FROM ({moved}) WHERE terminal_id <> 'T1'",
                                 "deleted": "1"}.get(k, "0"))
          for k in ("new", "changed", "restored", "deleted")],
        ("fact_passport_blacklist", "new", "0"),
        ("fact_transactions", "new",
         "FROM parsed WHERE _error IS NULL AND transaction_date >= '2024-01-16'"),
        ("fraud_report", "new", f"FROM ({REPORT_DAY2})"),
    ]
    ctes = [TERMINALS.replace("terminals_hist AS (", "terminals_all AS ("),
            CLIENTS.replace("clients_hist AS (", "clients_old AS ("), TRANSACTIONS,
            TXN_TEXT.replace("SELECT trim(transaction_id)", "SELECT transaction_date, trim(transaction_id)")]
    return _with(ctes, "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{f}' AS figure, "
        + (f"CAST({n} AS BIGINT) AS value" if n.isdigit() else f"(SELECT count(*) {n}) AS value")
        for t, f, n in rows))


REPORT_DAY2 = (two_day_queries()["daily_run_day2_report"] + ") WHERE (report_dt = DATE '2024-01-31'")


def change_queries() -> dict[str, str]:
    q = {"txn_lead_lag_maintained": oracle_queries()["txn_lead_lag"],
         "stream_fraud_events": oracle_queries()["fraud_events"]}
    days = two_day_queries()
    q["daily_run_day2_figures"] = figures_sql()
    q["daily_run_files_facts"] = days["daily_run_day2_facts"]
    q["daily_run_files_terminals"] = days["daily_run_day2_terminals"]
    q["stream_terminals_history"] = days["daily_run_day2_terminals"]
    q["daily_run_files_blacklist"] = with_fixtures(["blacklist"]) + "\nSELECT * FROM blacklist"
    q["daily_run_files_drops"] = """
SELECT * FROM (VALUES
  ('terminals', '00000001', 'read', 'terminals_1.csv'),
  ('passport_blacklist', '00000001', 'read', 'passport_blacklist_1.csv'),
  ('transactions', '00000001', 'read', 'transactions_1.csv'),
  ('terminals', '00000002', 'read', 'terminals_2.csv'),
  ('passport_blacklist', '00000002', 'missing', NULL),
  ('transactions', '00000002', 'read', 'transactions_2.csv')) AS t(kind, run_id, status, "drop")"""
    q["fact_transactions_append_days"] = with_fixtures(["transactions"]) + f"""
SELECT {TXN_COLS} FROM transactions b
WHERE (CAST(trans_date AS DATE) = DATE '2024-01-28'
       OR CAST(trans_date AS DATE) = DATE '2024-01-03' AND CAST(trans_id AS BIGINT) % 5 = 0)
  AND NOT EXISTS (SELECT 1 FROM transactions l WHERE CAST(l.trans_id AS BIGINT) % 2 = 0
                  AND l.trans_id = b.trans_id AND l.trans_date = b.trans_date)"""
    q["context_many_versions_as_of"] = _with(
        [CLIENTS_MANY, MIDNIGHT[1], MIDNIGHT[2], TERMINALS_DAILY, TRANSACTIONS, operations("as_of")],
        f"SELECT {CTX_COLS} FROM ops")
    q["context_hot_keys"] = _with(
        [CLIENTS, ACCOUNTS, CARDS, TERMINALS, BLACKLIST, HOT, operations("all")],
        f"SELECT {CTX_COLS} FROM ops")
    q["scd2_late_changes"] = _with([LATE], f"""
SELECT * EXCLUDE (seen, born), seen AS effective_from,
       CAST(coalesce(lead(seen) OVER (PARTITION BY client_id ORDER BY seen) - 1, {OPEN}) AS DATE)
         AS effective_to, 'N' AS deleted_flg
FROM news""")
    q["scd2_deleted_by_digest"] = scd2_through(2) + f"""
SELECT k, a, b, DATE '2024-01-02' AS effective_from, {OPEN} AS effective_to, 'Y' AS deleted_flg
FROM d2_gone"""
    cols = "k, customer, status, create_dt, update_dt"
    q["extract_boundary"] = _with([BOUNDARY], "\nUNION ALL ".join(
        f"SELECT {cols}, {n} AS step FROM b{n}" for n in (1, 2, 3)))
    return q
