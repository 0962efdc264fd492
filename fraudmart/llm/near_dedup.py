"""MinHash near-dedup: bottom-k sketches from one hash function.

A document's set is its distinct 3-word shingles (lower-case A-Z, words are
runs of bytes other than ASCII white space); a shorter text is one shingle.
Two documents are linked when ``100 * |A and B| >= 85 * |A or B|``; a group is
what links reach.

1. Documents with equal sets form one class; only one of it goes on.
2. A sketch retains the ``K`` smallest shingle hashes. Retained values that two
   classes share form inverted lists. Each class enters only the lists of its
   rarest values: of ``K`` retained values two linked classes miss at most a
   known number (``prefix_length``), so their first so many values, ordered by
   list length, meet. Sets that fit in their sketch get the exact number,
   others a five-sigma bound (a missed link at similarity 0.85 exactly: under
   one in 100,000; at 0.88 under one in ten million).
3. A long list (over ``LONG``) holds a large group or text that many share. Its
   members do the same again with their *full* sets, where the bound is exact.
4. Each list is linked as a star first (members with the member that has the
   fewest rarer values). Then only pairs of different groups remain; they are
   all tried that can be linked: at the first value that two sets share, the
   rarer values of either are missing in the other, so their number bounds the
   similarity. So a large group costs its size, not its square, and no link
   between different groups is left out.
5. A candidate must pass the estimate from the union sketch (five sigma below
   the threshold), then the exact comparison of the full sets.

Defined results: NULL, empty or blank text is an empty set, linked with
nothing; ties in lists go to the smaller class id; repeated rows are copies;
NULL ids are ignored when the smallest id of a group is taken (a group of NULL
ids only has NULL); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.components import components
from fraudmart.llm.hashing import shingles, word_hashes
from fraudmart.llm.shared import documents_view, in_tasks, row_key, without, written

SHINGLE_WORDS = 3
SHARE = 85
K = 64
LONG = 64
SIGMAS = 5
#: rows of a batch that a task hashes at a time
ROWS = 256


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = [(t or "").encode().lower() for t in texts]
    return [np.unique(shingles(w, n)) for w in word_hashes(data)]


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _sketcher(n: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            sets = shingle_sets(b.column(2).to_pylist(), n)
            keys = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            sketch = [s[:k].view(np.int64) for s in sets]
            flat = np.concatenate(sketch) if sketch else np.empty(0, np.int64)
            ends = np.cumsum([0] + [len(s) for s in sketch]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(keys, pa.binary()), pa.ListArray.from_arrays(ends, pa.array(flat))],
                names=["doc_id", "row_key", "n_shingles", "set_key", "sketch"])
    return run


def sketches(docs: DataFrame, n: int = SHINGLE_WORDS, k: int = K) -> DataFrame:
    """``doc_id, row_key, n_shingles, set_key, sketch`` per document."""
    d = documents_view(docs).select(
        "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    return d.transform(in_tasks, _sketcher(n, k), "doc_id long, row_key long, n_shingles long, "
                                         "set_key binary, sketch array<long>")


def _full_sets(n: int):
    def run(batches):
        for part in _pieces(batches):
            sets = shingle_sets(part.column(1).to_pylist(), n)
            sizes = [len(s) for s in sets]
            cid = np.repeat(part.column(0).to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid, pa.int64()), pa.array(np.repeat(sizes, sizes), pa.int64()),
                 pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64))],
                names=["cid", "n", "v"])
    return run


def prefix_length(n: Column, k: int | None, share: int = SHARE) -> Column:
    """How many of its rarest values a class needs so that any linked class shares one.

    A linked set lacks at most floor((1 - share) * n) of the n values. Where a
    sketch is cut, the number of retained values that are not shared is that of
    k draws with probability 1 - share at most: its mean and ``SIGMAS`` sigmas.
    """
    miss = (100 - share) / 100
    exact = F.floor(n * F.lit(100 - share) / F.lit(100)).cast("int") + 1
    if k is None:
        return exact
    drawn = math.ceil(k * miss + SIGMAS * math.sqrt(k * miss * (1 - miss))) + 1
    return F.when(n * 100 <= k * share, exact).otherwise(F.least(n, F.lit(drawn)).cast("int"))


def postings(values: DataFrame, k: int | None, share: int = SHARE) -> DataFrame:
    """(cid, n, v) rows -> ``v, cid, n, rank, whole``: each class in the lists of its rarest
    values; ``rank``: how many of its values are rarer; ``whole``: do the values hold all of
    the set? Values that one class alone has make no list but count as its rarest."""
    df = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
    shared = values.join(df, "v")
    held = F.least("n", F.lit(k)) if k is not None else F.col("n")
    ordered = (shared.groupBy("cid", "n")
               .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs")))
    alone = (held - F.size("vs")).cast("int")
    take = prefix_length(F.col("n"), k, share) - alone
    return (ordered.where(take > 0)
            .select("cid", "n", alone.alias("alone"), F.posexplode(
                F.slice("vs", F.lit(1), F.greatest(take, F.lit(1)))).alias("i", "x"))
            .select(F.col("x.v").alias("v"), "cid", "n", (F.col("alone") + F.col("i")).alias("rank"),
                    (F.col("n") <= k if k is not None else F.lit(True)).alias("whole")))


def _may_link(a, b, share: int) -> Column:
    """Can two members of a list be linked, if its value is the first that they share?
    A link needs (100 + share) * |both| >= share * (n + m), and what ranks before the
    list's value is in one of them only."""
    n, m = a["n"], b["n"]
    least = (n + m) * share
    ranked = (((n - a["rank"]) * (100 + share) >= least)
              & ((m - b["rank"]) * (100 + share) >= least))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * share) & (
        ~(a["whole"] & b["whole"]) | ranked)


def star_pairs(lists: DataFrame, share: int = SHARE) -> DataFrame:
    """``a, b`` (a > b): every member of a list with the list's centre."""
    centre = (lists.groupBy("v")
              .agg(F.min(F.struct("rank", "cid", "n", "whole")).alias("c"),
                   F.count(F.lit(1)).alias("m"))
              .where(F.col("m") > 1).select("v", "c"))
    c = {k: F.col(f"c.{k}") for k in ("rank", "cid", "n", "whole")}
    x = {k: F.col(k) for k in c}
    return (lists.join(centre, "v").where((x["cid"] != c["cid"]) & _may_link(x, c, share))
            .select(F.greatest(x["cid"], c["cid"]).alias("a"),
                    F.least(x["cid"], c["cid"]).alias("b")).distinct())


def rest_pairs(lists: DataFrame, roots: DataFrame, share: int = SHARE) -> DataFrame:
    """``a, b``: members of one list that the stars left in different groups."""
    cols = ("v", "cid", "n", "rank", "whole")
    g = (lists.join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
         .select(*cols, F.coalesce("root", "cid").alias("root")))
    split = (g.groupBy("v").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where(F.col("lo") != F.col("hi")).select("v"))
    g = g.join(split, "v", "left_semi")
    o = g.toDF(*[f"o_{c}" for c in (*cols, "root")])
    x = {k: F.col(k) for k in cols}
    y = {k: F.col(f"o_{k}") for k in cols}
    return (g.join(o, (x["v"] == y["v"]) & (x["cid"] > y["cid"])
                   & (F.col("root") != F.col("o_root")) & _may_link(x, y, share))
            .select(F.col("cid").alias("a"), F.col("o_cid").alias("b")).distinct())


def estimated(pairs: DataFrame, classes: DataFrame, k: int = K, share: int = SHARE) -> DataFrame:
    """Pairs whose union sketch does not rule the link out."""
    s = classes.select("cid", "sketch")
    p = (pairs.join(s.toDF("a", "sa"), "a").join(s.toDF("b", "sb"), "b"))
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    both = F.size(F.array_intersect(F.array_intersect(F.col("sa"), F.col("sb")), union))
    p = p.select("a", "b", F.size(union).alias("u"), both.alias("both"))
    q = share / 100
    least = math.floor(k * q - SIGMAS * math.sqrt(k * q * (1 - q)))
    return p.where(F.when(F.col("u") < k, F.col("both") * 100 >= F.col("u") * share)
                   .otherwise(F.col("both") >= least)).select("a", "b")


def same_shingles(left: bytes, right: bytes, n: int) -> tuple[int, int, int]:
    """Sizes of two texts' shingle sets and of what they share, by the words themselves."""
    ids: dict[bytes, int] = {}
    texts = [np.array([ids.setdefault(w, len(ids)) for w in t.lower().split()], dtype=np.int64)
             for t in (left, right)]
    width = [min(n, len(w)) for w in texts]
    rows = [len(w) - k + 1 if k else 0 for w, k in zip(texts, width)]
    # rows of equal words get one number: word by word, renumbered so that nothing overflows
    codes = np.repeat(width, rows).astype(np.int64)
    for j in range(max(width)):
        nth = np.concatenate([w[j:j + r] if j < k else np.zeros(r, np.int64)
                              for w, k, r in zip(texts, width, rows)])
        codes = np.unique(codes * (len(ids) + 1) + nth, return_inverse=True)[1]
    a, b = np.unique(codes[:rows[0]]), np.unique(codes[rows[0]:])
    return len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))


def _verifier(n: int, share: int):
    def run(batches):
        for b in _pieces(batches):
            left = shingle_sets(b.column(2).to_pylist(), n)
            right = shingle_sets(b.column(3).to_pylist(), n)
            ok = []
            for i, (x, y) in enumerate(zip(left, right)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked = 100 * both >= share * (len(x) + len(y) - both)
                if linked:  # a link is confirmed on words, not on their hashes
                    x, y, both = same_shingles(b.column(2)[i].as_py().encode(),
                                               b.column(3)[i].as_py().encode(), n)
                    linked = 100 * both >= share * (x + y - both)
                ok.append(linked)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(
                pa.array(ok, pa.bool_()))
    return run


def verified(pairs: DataFrame, texts: DataFrame, n: int = SHINGLE_WORDS,
             share: int = SHARE) -> DataFrame:
    """Pairs whose full sets are linked."""
    p = (pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
         .join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b")
         .select("a", "b", "ta", "tb"))
    return p.transform(in_tasks, _verifier(n, share), "a long, b long")


def class_links(classes: DataFrame, docs: DataFrame, n: int = SHINGLE_WORDS, k: int = K,
                share: int = SHARE, long: int = LONG) -> DataFrame:
    """``node, root`` over class ids: the groups of classes that have a link."""
    lists = written(postings(classes.select("cid", F.col("n_shingles").alias("n"),
                                            F.explode("sketch").alias("v")), k, share),
                    "near-lists")
    sizes = lists.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1)
    sized = written(lists.join(sizes, "v"), "near-sized")
    short = sized.where(F.col("m") <= long).drop("m")

    involved = classes.select("cid", "rep_key").join(
        sized.select("cid").distinct(), "cid", "left_semi")
    d = documents_view(docs)
    keyed = d.select(row_key(F.col("doc_id"), F.col("text")).alias("rep_key"), "text")
    texts = written(keyed.join(involved, "rep_key").dropDuplicates(["cid"]).select("cid", "text"),
                    "near-texts")

    members = sized.where(F.col("m") > long).select("cid").distinct()
    full = texts.join(members, "cid", "left_semi").transform(in_tasks,
        _full_sets(n), "cid long, n long, v long")
    long_lists = written(postings(full, None, share), "near-long")
    both = short.unionByName(long_lists)

    def links(pairs):
        return verified(estimated(pairs, classes, k, share), texts, n, share)

    first = written(links(star_pairs(both, share)), "near-star")
    roots = written(components(first, "near-first"), "near-roots")
    rest = written(links(rest_pairs(both, roots, share)), "near-rest")
    return components(first.union(rest), "near")


def _grouped(docs: DataFrame, n: int = SHINGLE_WORDS, k: int = K, share: int = SHARE,
             long: int = LONG) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, row_key, root`` (NULL: linked with
    nothing for want of shingles)."""
    sk = written(sketches(docs, n, k), "near-sketches")
    g = (sk.where(F.col("n_shingles") > 0).groupBy("set_key")
         .agg(F.min("row_key").alias("rep_key"), F.first("n_shingles").alias("n_shingles"),
              F.first("sketch").alias("sketch"), F.min("doc_id").alias("least_id")))
    classes = written(g.withColumn("cid", F.monotonically_increasing_id()), "near-classes")
    roots = written(class_links(classes, docs, n, k, share, long), "near-groups")
    named = (classes.select("cid", "set_key", "least_id")
             .join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
             .select("set_key", "least_id", F.coalesce("root", "cid").alias("root")))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_set = named.join(least, "root").select("set_key", "component_id", "root")
    linked = sk.where(F.col("n_shingles") > 0).drop("sketch").join(by_set, "set_key")
    alone = sk.where(F.col("n_shingles") == 0).drop("sketch").withColumn(
        "component_id", F.col("doc_id")).withColumn("root", F.lit(None).cast("long"))
    names = ("doc_id", "n_shingles", "component_id", "row_key", "root")
    return linked.select(*names).unionByName(alone.select(*names))


def near_groups(docs: DataFrame, n: int = SHINGLE_WORDS, k: int = K, share: int = SHARE,
                long: int = LONG) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept, row_key``."""
    return _grouped(docs, n, k, share, long).select(
                      "doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "row_key")


def keep_one(docs: DataFrame, n: int = SHINGLE_WORDS, share: int = SHARE) -> DataFrame:
    """``docs`` with one document of each group, all columns: that of the least id (NULL
    last), then of the least row key. Rows that repeat both id and text are one document."""
    linked = written(_grouped(docs, n, share=share).where(F.col("root").isNotNull()).select(
        "doc_id", "row_key", "root"), "near-linked")
    stay = linked.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("x")).select("x.row_key")
    return without(docs, linked.select("row_key").join(stay, "row_key", "left_anti"), once=True)
