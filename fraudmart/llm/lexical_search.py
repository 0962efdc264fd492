"""Ranked lexical search, reversed: the items' terms are the index, documents pass by.

Terms are runs of ASCII letters and digits and of any code points above U+007F,
A-Z lower-cased. A document's score for an item sums over the item's terms, with
their repeats, ``w * ((1000000000 * tf) div (1000 * tf + 12 * m))``, where
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and ``m = 75 + (25 * n * N) div L``.

1. The items' terms are counted per item and become an inverted index (term ->
   items, repeats) that is broadcast. Its size is checked: beyond ``MOST_POSTINGS``
   the items are dealt into blocks by a hash, and each block is its own pass over
   the documents (an item is never cut; one item alone may be larger).
2. Tasks read each document once and keep its number of terms and the counts of
   terms that any item has. Number of documents, of terms, and documents per term
   are sums over this table.
3. Tasks stream the counts through the index and push scores into one heap per
   item, never longer than ``top``; the heaps (``top`` rows per item and task) are
   merged by rank, the first ranks being taken before the shuffle.

Defined results: NULL, empty or term-less texts are no documents (they count for
nothing and are never returned); an item without terms returns nothing; equal
scores go by ascending doc_id, NULL last; a repeated document row is a document of
its own; rows that repeat both item_id and text are one item, and an item_id with
several texts has its ranks for each; texts of any length are read in slices; no
documents or no items give no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.shared import documents_view, in_tasks, written

TOP = 20
#: item-term pairs of a broadcast index; about 100 bytes each on the driver
MOST_POSTINGS = 1_000_000
#: bytes of a text that are split at a time
SLICE = 1 << 20
#: cells (documents x items) and postings that a task scores at a time
CELLS = 1 << 21
#: sums stay exact in double precision when scores are summed in two halves
HALF = 24


def _term_table() -> bytes:
    """Bytes of terms to themselves (A-Z lowered), all others to a space. UTF-8 bytes of
    code points above U+007F are all above 0x7F."""
    t = bytearray(b" " * 256)
    for b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        t[b] = b
    for b in range(0x41, 0x5B):
        t[b] = b + 0x20
    return bytes(t)


TERMS = _term_table()


def term_counts(data: bytes) -> Counter:
    """The terms of a UTF-8 text and how often each occurs."""
    data = data.translate(TERMS)
    counts: Counter = Counter()
    at = 0
    while len(data) - at > SLICE:
        end = data.find(b" ", at + SLICE)
        if end < 0:
            break
        counts.update(data[at:end].split())
        at = end
    counts.update((data[at:] if at else data).split())
    return counts


def _texts(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [term_counts(t) for t in _texts(b.column(1))]
        sizes = [len(c) for c in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), sizes), pa.int64()),
             pa.array([t for c in found for t in c], pa.binary()),
             pa.array([k for c in found for k in c.values()], pa.int64())],
            names=["item", "term", "repeats"])


class Index:
    """Postings of a block of items: for each term the items that hold it, with repeats."""

    def __init__(self, rows: list[tuple[int, bytes, int]]):
        self.items = np.unique(np.array([r[0] for r in rows], dtype=np.int64))
        self.terms = {t: i for i, t in enumerate(sorted({bytes(r[1]) for r in rows}))}
        term = np.array([self.terms[bytes(r[1])] for r in rows], dtype=np.int64)
        order = np.argsort(term, kind="stable")
        self.item = np.searchsorted(self.items, [r[0] for r in rows])[order]
        self.repeats = np.array([r[2] for r in rows], dtype=np.int64)[order]
        self.start = np.searchsorted(term[order], np.arange(len(self.terms) + 1))


def _counter(index):
    """(doc_id, text) -> doc_id, n, terms and counts, of documents that have a term."""
    def run(batches):
        terms = index.value.terms
        known = terms.keys()
        for b in batches:
            ids, ns, flat, tfs, ends = [], [], [], [], [0]
            for d, text in zip(b.column(0).to_pylist(), _texts(b.column(1))):
                counts = term_counts(text)
                if not counts:
                    continue
                ids.append(d)
                ns.append(counts.total())
                for t in known & counts.keys():
                    flat.append(terms[t])
                    tfs.append(counts[t])
                ends.append(len(flat))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])
    return run


class Heaps:
    """The ``top`` best documents of each item: a heap of (score, -doc_id) per item."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.heaps: list[list[tuple[int, float]]] = [[] for _ in range(n_items)]
        self.least = np.zeros(n_items, dtype=np.int64)  # score to reach, 0 while not full

    def push(self, scores: np.ndarray, ids: list[int | None]) -> None:
        """``scores``: documents x items."""
        for r, i in zip(*np.nonzero((scores >= self.least) & (scores > 0))):
            d, heap = ids[r], self.heaps[i]
            entry = (int(scores[r, i]), -math.inf if d is None else -d)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]


def block_scores(index: Index, weights: np.ndarray, rows: np.ndarray, terms: np.ndarray,
                 gains: np.ndarray, n_rows: int) -> np.ndarray:
    """Documents x items: sums of weight * gain * repeats, in 64-bit integers."""
    sizes = index.start[terms + 1] - index.start[terms]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - index.start[terms], sizes)
    part = np.repeat(weights[terms] * gains, sizes) * index.repeats[at]
    n_items = len(index.items)
    cell = np.repeat(rows, sizes) * n_items + index.item[at]
    high = np.bincount(cell, part >> HALF, n_rows * n_items)
    low = np.bincount(cell, part & ((1 << HALF) - 1), n_rows * n_items)
    return ((high.astype(np.int64) << HALF) + low.astype(np.int64)).reshape(n_rows, n_items)


def _ranker(index, weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    """(doc_id, n, terms, tfs) -> item, doc_id, score: a task's heaps."""
    def run(batches):
        ix = index.value
        heaps = Heaps(len(ix.items), top)
        posted = np.diff(ix.start)
        most = 16  # few documents first: what later ones must reach is soon known
        for b in batches:
            ids = b.column(0).to_pylist()
            m = 75 + (25 * b.column(1).to_numpy() * n_docs) // n_terms
            cut = np.asarray(b.column(2).offsets)
            terms = np.asarray(b.column(2).values)
            tfs = np.asarray(b.column(3).values)
            cost = np.concatenate([[0], np.cumsum(posted[terms])])[cut]
            lo = 0
            while lo < len(ids):
                hi = int(np.searchsorted(cost, cost[lo] + CELLS, side="right")) - 1
                hi = max(lo + 1, min(hi, lo + most, lo + CELLS // len(ix.items), len(ids)))
                most = min(most * 2, CELLS)
                rows = np.repeat(np.arange(hi - lo), np.diff(cut[lo:hi + 1]))
                t, tf = terms[cut[lo]:cut[hi]], tfs[cut[lo]:cut[hi]]
                gains = (1_000_000_000 * tf) // (1000 * tf + 12 * m[lo:hi][rows])
                heaps.push(block_scores(ix, weights, rows, t, gains, hi - lo), ids[lo:hi])
                lo = hi
        found = [(int(ix.items[i]), None if d == -math.inf else -d, s)
                 for i, h in enumerate(heaps.heaps) for s, d in h]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))],
            names=["item", "doc_id", "score"])
    return run


def _block(docs: DataFrame, rows: list, top: int) -> DataFrame:
    """``item, rank, doc_id, score`` for the items of one index."""
    spark = docs.sparkSession
    index = spark.sparkContext.broadcast(Index(rows))
    counts = written(docs.transform(in_tasks, _counter(index),
                                    "doc_id long, n long, terms array<int>, tfs array<long>"),
                     "search-counts")
    n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).first()
    weights = np.zeros(len(index.value.terms), dtype=np.int64)
    for t, df in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weights[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    heaps = counts.transform(in_tasks, _ranker(index, weights, n_docs, n_terms, top),
                             "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("item", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           most_postings: int = MOST_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` best documents."""
    d = documents_view(docs, id_col, text_col)
    listed = written(items.select(F.col(item_col).alias("item_id"),
                                  F.col(item_text_col).cast("string").alias("text")).distinct()
                     .withColumn("item", F.monotonically_increasing_id()), "search-items")
    terms = written(listed.select("item", "text").transform(
        in_tasks, _item_terms, "item long, term binary, repeats long"), "search-terms")
    blocks = max(1, math.ceil(terms.count() / most_postings))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = None
    for k in range(blocks):
        rows = [tuple(r) for r in terms.where(block == k).collect()]
        part = _block(d, rows, top)
        if blocks > 1:
            part = written(part, "search-block")
        found = part if found is None else found.unionByName(part)
    return listed.select("item", "item_id").join(found, "item").select(
        "item_id", "rank", "doc_id", "score")
