"""Table schemas, fixed values and the four SCD2 dimension specs.

Every state table of the mart is declared here once as a ``StructType`` so
readers never infer types. Card and account numbers are plain strings,
right-trimmed at ingest, because fixed-width CHAR columns pad on read and then
silently stop matching equi-joins against unpadded strings.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values (must equal the source system's conventions) ---------------
# End date of an open (current) version.
OPEN_DATE = _dt.date(9999, 12, 31)
# Watermark used before the first extract.
EPOCH_DATE = _dt.date(1000, 1, 1)
# deleted_flg values.
LIVE_FLAG = "N"
DELETED_FLAG = "Y"
# oper_type exempt from the two-cities rule; oper_result values of rule 4.
DEPOSIT = "DEPOSIT"
REJECT = "REJECT"
SUCCESS = "SUCCESS"
# event_type codes of the fraud report.
EVENT_PASSPORT = "1"
EVENT_CONTRACT = "2"
EVENT_TWO_CITIES = "3"
EVENT_AMOUNT_GUESS = "4"
# Time limits of rules 3 and 4 (inclusive).
TWO_CITIES_LIMIT = "1 hour"
AMOUNT_GUESS_LIMIT = "20 minutes"
AMOUNT_GUESS_REJECTS = 3
# Timestamp format of the transactions drop; field separator; decimal comma.
TXN_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TXN_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
TXN_SEPARATOR = ";"
# Declared text lengths of the target tables (VARCHAR(n) / CHAR(n)); a longer
# value would be rejected by the target, so the row goes to quarantine.
MAX_LENGTH = {
    "trans_id": 15, "card_num": 20, "oper_type": 15, "oper_result": 15, "terminal": 10,
    "passport_num": 30,
    "terminal_id": 10, "terminal_type": 10, "terminal_city": 20, "terminal_address": 100,
}
# File-name substrings that identify the three drop kinds.
DROP_TERMINALS = "terminals"
DROP_BLACKLIST = "passport_blacklist"
DROP_TRANSACTIONS = "transactions"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, D, TS = T.StringType(), T.DateType(), T.TimestampNTZType()
AMT = T.DecimalType(9, 2)

VERSION_FIELDS = (("effective_from", D), ("effective_to", D), ("deleted_flg", S))

TRANSACTIONS = _struct(
    ("trans_id", S), ("trans_date", TS), ("card_num", S), ("oper_type", S),
    ("amt", AMT), ("oper_result", S), ("terminal", S),
)
BLACKLIST = _struct(("passport_num", S), ("entry_dt", D))
TERMINALS_HIST = _struct(
    ("terminal_id", S), ("terminal_type", S), ("terminal_city", S), ("terminal_address", S),
    *VERSION_FIELDS,
)
CARDS_HIST = _struct(("card_num", S), ("account_num", S), *VERSION_FIELDS)
ACCOUNTS_HIST = _struct(("account_num", S), ("valid_to", D), ("client", S), *VERSION_FIELDS)
CLIENTS_HIST = _struct(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
    ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D), ("phone", S),
    *VERSION_FIELDS,
)
WATERMARKS = _struct(
    ("schema_name", S), ("table_name", S), ("max_create_dt", D), ("max_update_dt", D),
)
FRAUD_REPORT = _struct(
    ("event_dt", TS), ("passport", S), ("fio", S), ("phone", S), ("event_type", S),
    ("report_dt", D),
)
# Raw drops: every column arrives as text and is typed by the parsers.
BLACKLIST_DROP_COLUMNS = ("date", "passport")
TRANSACTIONS_DROP_COLUMNS = (
    "transaction_id", "transaction_date", "amount", "card_num", "oper_type", "oper_result",
    "terminal",
)


@dataclass(frozen=True)
class DimSpec:
    """How one SCD2 dimension is keyed and versioned.

    ``new_from`` / ``change_from`` name the stage columns that become
    ``effective_from`` of a brand-new key and of a changed key respectively.
    """

    name: str
    key: str
    attrs: tuple[str, ...]
    new_from: str = "create_dt"
    change_from: str = "update_dt"
    schema: T.StructType = field(default=None, compare=False)

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attrs]

    @property
    def history_columns(self) -> list[str]:
        return [self.key, *self.attrs, "effective_from", "effective_to", "deleted_flg"]


TERMINALS = DimSpec(
    "terminals", "terminal_id", ("terminal_type", "terminal_city", "terminal_address"),
    new_from="update_dt", change_from="update_dt", schema=TERMINALS_HIST,
)
CARDS = DimSpec("cards", "card_num", ("account_num",), schema=CARDS_HIST)
ACCOUNTS = DimSpec("accounts", "account_num", ("valid_to", "client"), schema=ACCOUNTS_HIST)
CLIENTS = DimSpec(
    "clients", "client_id",
    ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
     "passport_valid_to", "phone"),
    schema=CLIENTS_HIST,
)
DIMENSIONS = {d.name: d for d in (TERMINALS, CARDS, ACCOUNTS, CLIENTS)}
