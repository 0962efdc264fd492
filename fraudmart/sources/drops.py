"""Daily file drops (terminal snapshot, passport blacklist,
transactions) read as DataFrames.

* Discovery is by file-name substring inside one landing folder (S9; a folder
  of part files counts as a drop of that name); the listing itself is a Spark ``binaryFile`` scan of metadata only (the content
  column is pruned).
* A file whose name is already in the ledger is skipped (S10) — for all three
  kinds, not just terminals.
* A missing drop gives an empty, correctly typed DataFrame (S11).
* Columns are taken by each file's own header, in any order, and everything is
  read as text first: ids keep leading zeros, a decimal comma parses, and a row
  whose value does not parse, or with more or fewer fields than its header, is
  routed to quarantine instead of failing the job.
"""

from __future__ import annotations

import csv
import datetime as _dt
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.functions.columns import clean_key, parse_amount, parse_date, parse_timestamp
from fraudmart.schemas import (
    BLACKLIST, DROP_BLACKLIST, DROP_TERMINALS, DROP_TRANSACTIONS, MAX_LENGTH, TRANSACTIONS,
    TXN_SEPARATOR,
)

LEDGER = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("run_id", T.StringType()),
])


def _plain(path: str) -> str:
    """A path without its scheme, as both the caller and Spark's listing would spell it."""
    path = re.sub(r"^[a-zA-Z0-9]+:/+", "/", path)
    return (path if path.startswith("/") else os.path.abspath(path)).rstrip("/")


def drop_name(landing: str, path: str) -> str:
    """What the ledger calls a drop: its path below the landing folder."""
    return _plain(path)[len(_plain(landing)) + 1:]


def list_drops(spark: SparkSession, landing: str, kind: str) -> DataFrame:
    """Files in ``landing`` whose name contains ``kind`` (path, name, time). A drop may also be
    a folder of that name with part files, as Spark writes it."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing))
    except Exception as e:  # noqa: BLE001 - an absent folder or no match is an empty drop
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], "path string, file_name string, modificationTime timestamp")
        raise
    below = F.substr(F.regexp_replace("path", "^[a-zA-Z0-9]+:/+", "/"), F.lit(len(_plain(landing)) + 2))
    return (files.select("path", below.alias("file_name"), "modificationTime")
            .where(F.element_at(F.split("file_name", "/"), 1).contains(kind)))


def unseen_files(spark: SparkSession, landing: str, kind: str,
                 ledger: DataFrame | None = None) -> list[str]:
    """Paths of drops not yet in the ledger, oldest first.

    Only file names come to the driver (a bounded listing); the data itself
    is read in parallel by ``spark.read``."""
    files = list_drops(spark, landing, kind)
    if ledger is not None:
        files = files.join(ledger.select("file_name"), "file_name", "left_anti")
    return [r.path for r in files.orderBy("modificationTime", "file_name").collect()]


#: the whole line of a text row whose number of fields is not its header's
MALFORMED = "_malformed"
FORMATS = {".parquet": "parquet", ".json": "json", ".jsonl": "json"}   # anything else: text


def drop_format(path: str) -> str:
    name = path.rsplit("/", 1)[-1].lower()
    return next((f for ext, f in FORMATS.items() if name.endswith(ext)), "csv")


def _read_text(spark: SparkSession, paths: list[str], sep: str) -> DataFrame | None:
    """Named string columns plus the source file name and order.

    Text drops (CSV, any extension) take column names from their own header:
    files are read together only where their headers are equal. Parquet and
    JSON drops keep their own names and every value is read as text, so all
    formats go through the same parsers (and the same quarantine)."""
    groups: dict[tuple, list[str]] = {}
    for p in paths:
        if drop_format(p) != "csv":
            groups.setdefault((drop_format(p), ()), []).append(p)
    for p, header in csv_headers(spark, [p for p in paths if drop_format(p) == "csv"], sep).items():
        groups.setdefault(("csv", header), []).append(p)
    frames = []
    for (fmt, header), ps in sorted(groups.items()):
        if fmt == "csv":
            schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, MALFORMED)])
            df = (spark.read.schema(schema).option("header", True).option("sep", sep)
                  .option("enforceSchema", False).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", MALFORMED).csv(ps))
        elif fmt == "json":
            df = spark.read.option("primitivesAsString", True).json(ps)
        else:
            df = spark.read.parquet(*ps)
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns],
                       F.col("_metadata.file_name").alias("_file"),
                       F.col("_metadata.file_modification_time").alias("_file_time"))
        frames.append(df)
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def csv_headers(spark: SparkSession, paths: list[str], sep: str) -> dict[str, tuple[str, ...]]:
    """Column names of every text file under ``paths``, in one job whatever their number: a
    file's first block is read by one task in order, so the first of its lines that the task
    meets is the header. A file without lines has none and is left out."""
    if not paths:
        return {}
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        "value")
    first = lines.where(F.col("at") == 0).groupBy("path").agg(F.first("value").alias("header"))
    return {r.path: tuple(next(csv.reader([r.header.lstrip("\ufeff")], delimiter=sep), ()))
            for r in sorted(first.collect())}


def _empty_with_error(spark: SparkSession, schema: T.StructType) -> DataFrame:
    # a new StructType: StructType.add would change the shared schema constant
    fields = list(schema.fields) + [T.StructField("_error", T.StringType())]
    return spark.createDataFrame([], T.StructType(fields))


# --- parsers (string DataFrame in, typed DataFrame + error column out) -------

def _too_long(cols: dict[str, Column]) -> Column:
    """First column (in order) whose value exceeds its declared length."""
    err = None
    for name, c in cols.items():
        if name in MAX_LENGTH:
            cond = F.length(c) > MAX_LENGTH[name]
            err = F.when(cond, F.lit(f"length:{name}")) if err is None else \
                err.when(cond, F.lit(f"length:{name}"))
    return err


def _malformed(raw: DataFrame) -> Column:
    return F.col(MALFORMED).isNotNull() if MALFORMED in raw.columns else F.lit(False)


def _kept_columns(raw: DataFrame) -> list[str]:
    return [c for c in ("_file", "_file_time", MALFORMED) if c in raw.columns]


def parse_transactions(raw: DataFrame) -> DataFrame:
    """Drop columns (any order, all text) → fact columns; ``_error`` names the
    first field that did not parse (NULL for a clean row)."""
    amt = parse_amount("amount")
    ts = parse_timestamp("transaction_date")
    text = {"trans_id": F.trim("transaction_id"), "card_num": clean_key(F.trim("card_num")),
            "oper_type": F.trim("oper_type"), "oper_result": F.trim("oper_result"),
            "terminal": F.trim("terminal")}
    err = (F.when(_malformed(raw), F.lit("fields")).otherwise(_too_long(text)
           .when(F.col("amount").isNotNull() & amt.isNull(), F.lit("amount"))
           .when(F.col("transaction_date").isNotNull() & ts.isNull(), F.lit("transaction_date"))))
    extra = _kept_columns(raw)
    return raw.select(
        text["trans_id"].alias("trans_id"), ts.alias("trans_date"),
        text["card_num"].alias("card_num"), text["oper_type"].alias("oper_type"),
        amt.alias("amt"), text["oper_result"].alias("oper_result"),
        text["terminal"].alias("terminal"),
        err.alias("_error"), *extra,
    )


def parse_blacklist(raw: DataFrame) -> DataFrame:
    """``date``, ``passport`` (by name) → ``passport_num``, ``entry_dt``."""
    d = parse_date("date")
    passport = F.trim("passport")
    err = (F.when(_malformed(raw), F.lit("fields"))
           .otherwise(_too_long({"passport_num": passport})
                      .when(F.col("date").isNotNull() & d.isNull(), F.lit("date"))))
    extra = _kept_columns(raw)
    return raw.select(passport.alias("passport_num"), d.alias("entry_dt"),
                      err.alias("_error"), *extra)


def parse_terminals(raw: DataFrame, load_date: _dt.date | Column) -> DataFrame:
    """Terminal snapshot; the load date becomes ``update_dt``."""
    loaded = load_date if isinstance(load_date, Column) else F.lit(load_date)
    extra = _kept_columns(raw)
    text = {c: F.trim(c) for c in ("terminal_id", "terminal_type", "terminal_city",
                                   "terminal_address")}
    err = (F.when(_malformed(raw), F.lit("fields"))
           .otherwise(_too_long(text).when(text["terminal_id"].isNull(), F.lit("terminal_id"))))
    return raw.select(
        *[v.alias(k) for k, v in text.items()],
        loaded.alias("update_dt"),
        err.alias("_error"), *extra,
    )


def terminal_keys(parsed: DataFrame) -> DataFrame:
    """The key snapshot: every terminal that the file names, whatever its other
    columns hold. A row in quarantine still says that its terminal exists."""
    return parsed.where(F.col("terminal_id").isNotNull()).select("terminal_id").distinct()


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col("_error").isNull()).drop("_error", MALFORMED)


def quarantine(df: DataFrame) -> DataFrame:
    return df.where(F.col("_error").isNotNull())


# --- readers -------------------------------------------------------------------

def read_transactions(spark: SparkSession, paths: list[str]) -> DataFrame:
    raw = _read_text(spark, paths, TXN_SEPARATOR)
    return _empty_with_error(spark, TRANSACTIONS) if raw is None else parse_transactions(raw)


def read_blacklist(spark: SparkSession, paths: list[str], sep: str = ",") -> DataFrame:
    raw = _read_text(spark, paths, sep)
    return _empty_with_error(spark, BLACKLIST) if raw is None else parse_blacklist(raw)


def read_terminals(spark: SparkSession, paths: list[str], load_date: _dt.date,
                   sep: str = ",") -> DataFrame | None:
    """Full terminal snapshot, or None when no file arrived (so deletion
    detection can tell "no snapshot" from "empty snapshot")."""
    raw = _read_text(spark, paths, sep)
    return None if raw is None else parse_terminals(raw, load_date)


def with_file_order(df: DataFrame) -> DataFrame:
    """``_seq`` for the SCD2 stage: rows of a later file win on duplicate keys."""
    return df.withColumn("_seq", F.unix_micros(F.col("_file_time")))


KINDS = (DROP_TERMINALS, DROP_BLACKLIST, DROP_TRANSACTIONS)
