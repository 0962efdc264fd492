"""Benchmark decontamination: size-partitioned MinHash containment search.

An item's set is its distinct five-word shingles (lower case, words are runs of
letters and digits). A document leaks an item when it holds at least
``threshold`` of the item's shingles, wherever they stand in the document.

Search. Items are partitioned by set size (powers of two). The sketch of an
item is the ``k`` smallest hashes of its set, where ``k`` belongs to the
partition: with containment at or above the threshold a document misses at
most ``floor((1 - threshold) * size)`` shingles of the item, so ``k`` = that
number for the largest size of the partition, plus one (all of the set where
it is smaller), cannot be missed entirely. One side of a containment search is a long document whose own
fixed-size MinHash would say nothing about a short item (Jaccard under 0.01),
so documents are not sketched: their shingle hashes probe the items' sketches.
That makes the candidate step exact.

Verification counts the distinct shingles that a candidate pair really shares,
comparing the words of the shingles, not their hashes.

Main path is DataFrame expressions only. Defined results:

* A text of any length is compared whole (its words are one array, its shingles rows);
  there are no ties: every leaked pair is returned.
* NULL or empty texts, and texts under five words, have no shingle: such items
  match nothing and such documents leak nothing.
* The report (``contaminated``) is by id: repeated document rows with the same id
  count as one document (its shingles are the union); repeated item ids likewise.
  NULL ids are ids like any other. ``clean`` looks at each row by itself.
* Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.shared import row_key, without, written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: tasks that share a shingle of very many documents
SALTS = 32


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"),
                    lambda w: w != "")


def _joined(w: Column, n: int) -> Column:
    """Distinct n-word shingles of a word array, words joined by one space."""
    return F.when(F.size(w) >= n, F.transform(
        F.sequence(F.lit(0), F.size(w) - n),
        lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(n)])))


def _sets(df: DataFrame, id_col: str, out_id: str, n: int) -> DataFrame:
    """(id, shingle) rows, repeats included."""
    w = df.select(F.col(id_col).cast("long").alias(out_id), words(F.col("text")).alias("w"))
    return (w.where(F.size("w") >= n)
            .select(out_id, F.explode(_joined(F.col("w"), n)).alias("shingle")))


def item_shingles(benchmark: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """``item_id, item_size, shingle, hash``: each item's distinct shingles."""
    s = _sets(benchmark, "item_id", "item_id", n).distinct()
    size = s.groupBy("item_id").agg(F.count(F.lit(1)).alias("item_size"))
    # an item without id is an item too
    return (s.alias("s").join(size.alias("z"),
                              F.col("s.item_id").eqNullSafe(F.col("z.item_id")))
            .select("s.item_id", "item_size", "shingle", F.xxhash64("shingle").alias("hash")))


def item_sketches(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``hash, item_id`` of the sketch: the smallest hashes of each item, as many
    as its size partition needs."""
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.col("item_size").cast("double"))) + 1) - 1
    k = F.floor(F.lit(1 - threshold) * upper + F.lit(1e-9)).cast("int") + 1
    return (items.groupBy("item_id", "item_size")
            .agg(F.sort_array(F.collect_set("hash")).alias("all"))
            .select("item_id", F.explode(F.slice("all", F.lit(1), k)).alias("hash")))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 n: int = SHINGLE_WORDS) -> DataFrame:
    """One row per leaked (document, item):
    ``doc_id, item_id, n_shared, item_size, containment``."""
    items = written(item_shingles(benchmark, n), "decontam-items")
    # a written table: the planner knows its size and broadcasts it below its own limit only
    probes = written(item_sketches(items, threshold), "decontam-sketches")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    w = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(text).alias("w"))
    hashed = w.where(F.size("w") >= n).select("doc_id", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("w") - n),
        lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(F.col("w"), i + j) for j in range(n)]))
    )).alias("hash"))
    cand = written(hashed.join(probes, "hash").select("doc_id", "item_id").distinct(),
                   "decontam-candidates")
    ids = cand.select("doc_id").distinct()
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    near = d.alias("d").join(ids.alias("i"), F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")),
                             "left_semi")
    # per candidate document: its shingles that any item has, then only the candidate pairs. A
    # shingle that many documents share is dealt out by document; the items come with each salt
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    dealt = _sets(near, "doc_id", "doc_id", n).withColumn("salt", salt)
    copied = items.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    have = dealt.join(copied, ["shingle", "salt"])
    shared = (have.groupBy("doc_id", "item_id", "item_size")
              .agg(F.count_distinct("shingle").alias("n_shared")))
    hit = shared.where(F.col("n_shared") >= F.lit(threshold) * F.col("item_size") - F.lit(1e-9))
    return (hit.alias("h").join(cand.alias("c"),
                                F.col("h.doc_id").eqNullSafe(F.col("c.doc_id"))
                                & F.col("h.item_id").eqNullSafe(F.col("c.item_id")), "left_semi")
            .select("doc_id", "item_id", "n_shared", "item_size",
                    (F.col("n_shared") / F.col("item_size")).alias("containment")))


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
          n: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without the rows whose text leaks an item, whatever other rows have their
    id; all columns."""
    rows = docs.select(row_key(F.col("doc_id").cast("long"), F.col("text")).alias("doc_id"), "text")
    leaks = contaminated(rows, benchmark, threshold, n)
    return without(docs, leaks.select(F.col("doc_id").alias("row_key")))
