"""The transaction context the four fraud rules read.

The source system builds it as a five-table LEFT JOIN chain starting at
clients. A client with no account, card or transaction yields a row with a
NULL transaction that no rule can select, so the chain is written here as
inner joins from the transaction side (same rule results, and Catalyst can
plan it around the big fact) with only the terminal join kept LEFT (an unknown
terminal keeps the row for rules 1, 2 and 4).

Plan shape at scale: the three owner dimensions (cards, accounts, clients)
are joined among themselves first, so the fact is shuffled once on
``card_num`` and once on ``terminal`` (``spread.by_key``: no dimension goes through the driver).
A card or terminal with a large share of all operations is dealt over many
tasks where the caller names the hot keys (``spread.hot_keys``).

As of a day, versions are found per distinct (key, day) instead of joined by
range (``asof``): a key's many versions never multiply its operations.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.functions.columns import full_name
from fraudmart.operators.asof import as_of_join, in_force
from fraudmart.operators.spread import Hot, by_key, spread_join

HISTORY_MODES = ("all", "as_of")
VERSION_JOINS = ("sorted", "range")
OWNER = ("passport", "fio", "phone", "passport_valid_to", "client_id", "ac_valid_to")


def card_owners(clients: DataFrame, accounts: DataFrame, cards: DataFrame,
                history: str = "all") -> DataFrame:
    """card → account → client, one row per combination of versions.

    With ``history='as_of'`` only combinations whose validity periods overlap
    are kept, and the common period is carried as ``own_from``/``own_to``.
    """
    cl = clients.select(
        "client_id", F.col("passport_num").alias("passport"),
        full_name("last_name", "first_name", "patronymic").alias("fio"),
        "phone", "passport_valid_to",
        F.col("effective_from").alias("cl_from"), F.col("effective_to").alias("cl_to"),
    )
    ac = accounts.select(
        "account_num", "client", F.col("valid_to").alias("ac_valid_to"),
        F.col("effective_from").alias("ac_from"), F.col("effective_to").alias("ac_to"),
    )
    ca = cards.select(
        "card_num", "account_num",
        F.col("effective_from").alias("ca_from"), F.col("effective_to").alias("ca_to"),
    )
    owners = ca.join(by_key(ac), "account_num").join(by_key(cl), F.col("client") == F.col("client_id"))
    if history == "all":
        return owners.select("card_num", "passport", "fio", "phone", "passport_valid_to",
                             "client_id", "ac_valid_to")
    own_from = F.greatest("ca_from", "ac_from", "cl_from")
    own_to = F.least("ca_to", "ac_to", "cl_to")
    return (owners.where(own_from <= own_to)
            .select("card_num", "passport", "fio", "phone", "passport_valid_to", "client_id",
                    "ac_valid_to", own_from.alias("own_from"), own_to.alias("own_to")))


def owners_on_days(pairs: DataFrame, clients: DataFrame, accounts: DataFrame,
                   cards: DataFrame) -> DataFrame:
    """``card_num, _on`` and the owner in force on that day (pairs without one are left out):
    card, then account, then client, each as of the day."""
    span = ("effective_from", "effective_to")
    at = in_force(pairs, cards, "card_num", "_on", *span, ["account_num"])
    at = at.where("found").drop("found")
    ac = accounts.select("account_num", "client", F.col("valid_to").alias("ac_valid_to"), *span)
    at = in_force(at, ac, "account_num", "_on", *span, ["client", "ac_valid_to"])
    at = at.where("found").drop("found", "account_num")
    cl = clients.select(
        F.col("client_id").alias("client"), "client_id", F.col("passport_num").alias("passport"),
        full_name("last_name", "first_name", "patronymic").alias("fio"), "phone",
        "passport_valid_to", *span)
    at = in_force(at, cl, "client", "_on", *span, ["client_id", "passport", "fio", "phone",
                                                   "passport_valid_to"])
    return at.where("found").select("card_num", "_on", *OWNER)


def _as_of(tr: DataFrame, clients: DataFrame, accounts: DataFrame, cards: DataFrame,
           te: DataFrame, hot_card: Hot | None, hot_terminal: Hot | None) -> DataFrame:
    dated = tr.withColumn("_on", F.to_date("trans_date"))
    pairs = (dated.where(F.col("card_num").isNotNull() & F.col("_on").isNotNull())
             .select("card_num", "_on").distinct())
    owners = owners_on_days(pairs, clients, accounts, cards)
    ctx = spread_join(dated, owners, ["card_num", "_on"], "inner", hot_card).drop("_on")
    te = te.withColumn("terminal", F.col("terminal_id"))
    return as_of_join(ctx, te, "terminal", F.to_date("trans_date"), "te_effective_from", "te_to",
                      ["terminal_id", "terminal_city", "te_effective_from"], "left",
                      hot=hot_terminal)


def transaction_context(clients: DataFrame, accounts: DataFrame, cards: DataFrame,
                        transactions: DataFrame, terminals: DataFrame, run_date: _dt.date,
                        history: str = "all", version_join: str = "sorted",
                        hot_card: Hot | None = None, hot_terminal: Hot | None = None,
                        carry: tuple[str, ...] = ()) -> DataFrame:
    """Join every transaction to its card owner and terminal.

    ``history='all'`` joins every version of every dimension, as the source
    system does (a terminal with two versions doubles its transactions);
    ``history='as_of'`` joins only the versions valid on the transaction date:
    ``version_join='sorted'`` finds them per key and day and asks that versions of
    a key do not overlap, ``'range'`` compares every version of the key, which
    also serves histories that do overlap.

    ``hot_card``, ``hot_terminal`` (``spread.hot_keys`` of ``card_num`` and
    ``terminal``): values whose operations are dealt over many tasks. ``carry``: further
    columns of the operations to keep.
    """
    if history not in HISTORY_MODES:
        raise ValueError(f"history must be one of {HISTORY_MODES}")
    if version_join not in VERSION_JOINS:
        raise ValueError(f"version_join must be one of {VERSION_JOINS}")
    tr = transactions.select("trans_id", "trans_date", "card_num", "oper_type", "amt",
                             "oper_result", "terminal", *carry)
    te = terminals.select(
        "terminal_id", "terminal_city",
        F.col("effective_from").alias("te_effective_from"),
        F.col("effective_to").alias("te_to"),
    )
    day = F.to_date("trans_date")
    if history == "all":
        ctx = spread_join(tr, card_owners(clients, accounts, cards), ["card_num"], "inner", hot_card)
        te = te.withColumn("terminal", F.col("terminal_id"))
        ctx = spread_join(ctx, te, ["terminal"], "left", hot_terminal)
    elif version_join == "sorted":
        ctx = _as_of(tr, clients, accounts, cards, te, hot_card, hot_terminal)
    else:
        owners = card_owners(clients, accounts, cards, history)
        ctx = tr.join(by_key(owners), (tr.card_num == owners.card_num)
                      & day.between(owners.own_from, owners.own_to)).drop(owners.card_num)
        ctx = ctx.join(by_key(te),
                       (F.col("terminal") == F.col("terminal_id"))
                       & day.between(F.col("te_effective_from"), F.col("te_to")), "left")
    return ctx.select(
        "trans_date", "passport", "fio", "phone", F.lit(run_date).alias("report_dt"),
        "passport_valid_to", "client_id", "card_num", "ac_valid_to", "trans_id", "oper_type",
        "amt", "oper_result", "terminal_id", "terminal_city", "te_effective_from", *carry,
    )
