"""Exact dedup: group by a 128-bit content hash and compare bytes inside groups.

Main path is DataFrame expressions only. Defined results:

* NULL text counts as the empty text; all empty texts are one group.
* Of equal texts the row with the largest ``doc_id`` stays; NULL ids lose to
  any id, and a group of NULL ids only keeps its rows' NULL.
* Rows that repeat both id and text are one document delivered twice: all of
  them count in ``group_size`` and carry the same answer; ``keep_rows`` lets
  one of them through (where other columns differ, the one of least hash of these).
* Texts of any length are hashed and compared whole.
* An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.shared import documents_view, row_key


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def exact_groups(docs: DataFrame, hash_fn=content_hash) -> DataFrame:
    """One row per distinct text: ``content_hash, text_sha256, keep_id, group_size``.

    Grouping on (hash, text) makes the aggregate itself compare the bytes of
    texts with one hash, so a collision of the 128-bit hash makes two groups.
    Copies meet in the map-side aggregate first: a group of any size reaches
    the shuffle as one row per map task.
    """
    d = documents_view(docs).withColumn("text", F.coalesce("text", F.lit("")))
    g = (d.groupBy(hash_fn(F.col("text")).alias("content_hash"), "text")
         .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return g.select("content_hash", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
                    "keep_id", "group_size")


def exact_dedup(docs: DataFrame, hash_fn=content_hash) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, row_key``."""
    d = documents_view(docs)
    text = F.coalesce("text", F.lit(""))
    rows = d.select("doc_id", hash_fn(text).alias("content_hash"),
                    F.sha2(F.encode(text, "UTF-8"), 256).alias("text_sha256"),
                    row_key(F.col("doc_id"), F.col("text")).alias("row_key"))
    g = exact_groups(docs, hash_fn)
    # rows of one hash with different bytes differ in the second digest too
    return (rows.join(g, ["content_hash", "text_sha256"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256", "row_key"))


def keep_rows(docs: DataFrame, hash_fn=content_hash) -> DataFrame:
    """``docs`` with one row per distinct text, all columns.

    The text moves through one shuffle: rows are cut to their survivors by a
    join on the small (hash, id) table; repeats of a surviving row collapse.
    """
    taken = {c.lower() for c in docs.columns}
    h, k = "content_hash", "keep_id"
    while h in taken or k in taken:
        h, k = f"_{h}", f"_{k}"
    g = exact_groups(docs, hash_fn).select(
        F.struct("content_hash", "text_sha256", "keep_id").alias(k))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn(h, F.struct(
        hash_fn(text).alias("content_hash"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("text_sha256"),
        F.col("doc_id").cast("long").alias("keep_id")))
    kept = keyed.join(g, F.col(h).eqNullSafe(F.col(k)), "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    if not others:
        return kept.dropDuplicates([h]).select(*docs.columns)
    order = F.xxhash64(F.to_json(F.struct(*others)))
    one = kept.groupBy(h).agg(F.min_by(F.struct(*docs.columns), order).alias("_row"))
    return one.select("_row.*")
