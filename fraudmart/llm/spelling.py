"""Spelling variants: words one edit apart, found over numbered trie nodes.

Words are runs of letters (A-Z, a-z, U+00C0 to U+00FF), lower-cased in A-Z only.
Two words are near if they differ by exactly one inserted, deleted or replaced
code point. A word's form is its near word of largest count, if that count is at
least ``RATIO`` times its own; its root is where its chain of forms ends.

1. The vocabulary is sorted by range once forwards and once by the reversed word.
   In sorted order a word's path through the trie is its neighbour's path down to
   their common prefix and new numbers from there, so a task numbers the nodes of
   its range with one path in memory. Where two ranges meet, the common prefix of
   the two words at the seam tells which numbers mean one node; only these seam
   words (two a range) reach the driver.
2. Only nodes that two words share can meet another word's, so a path is kept down
   to the longest prefix shared with a neighbour in sorted order.
3. A word gives one pair (prefix node, suffix node) for each position skipped and
   for each gap between positions. Two words that agree in a pair with one position
   skipped in both differ there; a skipped position that meets a gap is an inserted
   code point (of a run of equal ones the first is skipped, so each near pair meets
   once). A pair holds at most one word a letter of the alphabet (90) and one more,
   so no pair of nodes is hot, and no pairs of words are formed: a pair's members
   are told their number and their best one.
4. Forms raise the count at least ``RATIO`` times a step, so chains are short and
   doubling reaches every root in a known number of joins.

Exact: no hash stands for a word. Defined results: NULL or empty text has no
words; a NULL id counts as an empty text in the rule that varies runs; repeated
rows count each time; ties go to the smallest word in code-point order; a text or
a word of any length is taken whole (numbers kept per word grow with its length, not
its square); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.shared import documents_view, in_tasks, written

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
VARY = 31
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: a task's numbers start here times its partition
RANGE = 1 << 40
#: how a word enters a pair of nodes
SKIP, SKIP_FIRST, GAP = 0, 1, 2


def runs(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``doc_id, run``: lower-cased runs of letters, one row per occurrence; runs that are
    too short to become a word are left out."""
    d = documents_view(docs)
    letters = F.split(F.translate("text", UPPER, UPPER.lower()), "[^a-zÀ-ÿ]+")
    return (d.select("doc_id", F.explode(letters).alias("run"))
            .where(F.length("run") >= least_length))


def varied(doc_id: Column, run: Column, every: int = VARY) -> Column:
    """The run without one code point, where ``every`` divides the crc32 of "id:run"."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
                .cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % every == 0, cut).otherwise(run)


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of a column ``word``."""
    return (words.where(F.length("word") >= least_length).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while lo < hi:  # the longest equal prefix, by halving
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, word, n, wid) -> wid, n, word, part, seam key or NULL, path of node numbers.

    ``wid`` is kept, or is the word's place in this order where it is NULL. The first word
    of a range numbers its path base + depth, so the seam can be renumbered by depth."""
    part = TaskContext.get().partitionId()
    base, used = part * RANGE, 0
    path: list[int] = [0]
    place, held, shared = 0, None, 0  # the word read before, and what it shares with its neighbours

    def rows(out, seam, keep):
        key, word, n, wid, nodes = held
        out.append((wid, n, word, part, key if seam else None, nodes[:keep + 1]))

    for b in batches:
        out: list[tuple] = []
        for key, word, n, wid in zip(*(c.to_pylist() for c in b.columns)):
            k = common(held[0], key) if held else 0
            if held:
                first = place == 1
                rows(out, first, len(held[0]) if first else max(shared, k))
            path = path[:k + 1]
            path.extend(range(base + used + 1, base + used + 1 + len(key) - k))
            used += len(key) - k
            held = (key, word, n, base + place if wid is None else wid, path)
            place, shared = place + 1, k
        if out:
            yield _batch(out)
    if held:
        out = []
        rows(out, True, len(held[0]))
        yield _batch(out)


NODES = "wid long, n long, word string, part int, seam string, path array<long>"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)],
        names=["wid", "n", "word", "part", "seam", "path"])


def numbered(words: DataFrame, key: Column, parts: int | None = None) -> DataFrame:
    """The trie of ``key``: each of ``word, n, wid`` with its path of node numbers."""
    keyed = words.select(key.alias("key"), "word", "n", "wid")
    dealt = (keyed.repartitionByRange(parts, "key") if parts else keyed.repartitionByRange("key"))
    return dealt.sortWithinPartitions("key").transform(in_tasks, _numbered, NODES)


def seams(trie: DataFrame) -> dict[int, list[int]]:
    """For each range the numbers of its first word's path that mean nodes of earlier ranges
    (list index: depth - 1). Reads the first and last word of each range."""
    edges: dict[int, list] = {}
    for part, word, path in (trie.where(F.col("seam").isNotNull())
                             .select("part", "seam", "path").collect()):
        edges.setdefault(part, []).append((word, path))
    same: dict[int, list[int]] = {}
    last, last_path = "", [0]
    for part in sorted(edges):
        first = min(edges[part], key=lambda x: x[0])
        k = common(last, first[0])
        same[part] = last_path[1:k + 1]
        last, path = max(edges[part], key=lambda x: x[0])
        last_path = joined(path, part, same[part])
    return {p: s for p, s in same.items() if s}


def joined(path: list[int], part: int, same: list[int]) -> list[int]:
    """``path`` with the numbers of nodes that an earlier range numbered first."""
    base, out = part * RANGE, list(path)
    for depth in range(1, min(len(same), len(path) - 1) + 1):
        if path[depth] != base + depth:
            break
        out[depth] = same[depth - 1]
    return out


def _pairs(head: dict[int, list[int]], tail: dict[int, list[int]]):
    """(wid, n, word, part, path, tail part, tail path) -> pairs of nodes."""
    def run(batches):
        for b in batches:
            f, r, how, ids, ns = [], [], [], [], []
            for wid, n, word, p, path, q, back in zip(*(c.to_pylist() for c in b.columns)):
                path = joined(path, p, head.get(p, ()))
                back = joined(back, q, tail.get(q, ()))
                size, a, z = len(word), len(path) - 1, len(back) - 1
                for i in range(max(0, size - 1 - z), min(a, size - 1) + 1):
                    f.append(path[i])
                    r.append(back[size - 1 - i])
                    how.append(SKIP_FIRST if i == 0 or word[i] != word[i - 1] else SKIP)
                for i in range(max(0, size - z), min(a, size) + 1):
                    f.append(path[i])
                    r.append(back[size - i])
                    how.append(GAP)
                new = len(f) - len(ids)
                ids.extend([wid] * new)
                ns.extend([n] * new)
                if len(f) > 1 << 18:
                    yield _pair_batch(f, r, how, ns, ids)
                    f, r, how, ids, ns = [], [], [], [], []
            yield _pair_batch(f, r, how, ns, ids)
    return run


def _pair_batch(f, r, how, ns, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(f, pa.int64()), pa.array(r, pa.int64()), pa.array(how, pa.int8()),
         pa.array(ns, pa.int64()), pa.array(ids, pa.int64())], names=["f", "r", "how", "n", "wid"])


def near_words(pairs: DataFrame) -> DataFrame:
    """``wid, n_near, best``: the number of near words, and the one of largest ``n``, of equals
    the least ``wid``, as struct(n, -wid)."""
    met = (pairs.groupBy("f", "r")
           .agg(F.collect_list(F.struct("n", (-F.col("wid")).alias("neg"), "how")).alias("all"))
           .where(F.size("all") > 1))
    me = met.select("all", F.explode("all").alias("me"))

    def near(x):
        how, mine = x["how"], F.col("me.how")
        return (x["neg"] != F.col("me.neg")) & (
            ((mine != GAP) & (how != GAP))
            | ((mine == GAP) & (how == SKIP_FIRST)) | ((mine == SKIP_FIRST) & (how == GAP)))

    others = me.select((-F.col("me.neg")).alias("wid"), F.filter("all", near).alias("o"))
    best = F.array_max(F.transform("o", lambda x: F.struct(x["n"].alias("n"), x["neg"].alias("neg"))))
    return (others.where(F.size("o") > 0).select("wid", F.size("o").alias("k"), best.alias("b"))
            .groupBy("wid").agg(F.sum("k").alias("n_near"), F.max("b").alias("best")))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """``wid, root`` from ``wid, form``: where at most ``2 ** steps`` forms in a row end."""
    at = forms.select("wid", F.col("form").alias("root"))
    for _ in range(steps):
        nxt = at.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        at = written(at.join(nxt, "root", "left").select(
            "wid", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return at


def variants(vocab: DataFrame, ratio: int = RATIO, parts: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``vocab`` (``word, n``, words
    distinct). ``parts``: ranges that the tries are built in (the session's number if None)."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: forms could run in a circle")
    vocab = written(vocab, "spelling-words")
    head = written(numbered(vocab.withColumn("wid", F.lit(None).cast("long")),
                            F.col("word"), parts), "spelling-heads")
    words = head.select("wid", "word", "n")
    tail = written(numbered(words, F.reverse("word"), parts), "spelling-tails")
    both = head.select("wid", "n", "word", "part", "path").join(
        tail.select("wid", F.col("part").alias("q"), F.col("path").alias("back")), "wid")
    pairs = both.transform(in_tasks, _pairs(seams(head), seams(tail)),
                           "f long, r long, how byte, n long, wid long")
    near = near_words(pairs)
    found = written(words.select("wid", "n").join(near, "wid").select(
        "wid", "n_near", F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.neg"))
        .alias("form"), F.col("best.n").alias("form_n")), "spelling-near")
    forms = found.where(F.col("form").isNotNull()).select("wid", "form", "form_n")
    top = vocab.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log2(max(1, math.floor(math.log(top, ratio)) + 1)))
    named = words.select("wid", "word")
    linked = (forms.join(roots(forms, steps), "wid")
              .join(named.toDF("form", "form_word"), "form")
              .join(named.toDF("root", "root_word"), "root")
              .select("wid", "form_word", "root_word", "form_n"))
    return (words.join(found.select("wid", "n_near"), "wid", "left").join(linked, "wid", "left")
            .select("word", F.col("form_word").alias("form"),
                    F.coalesce("root_word", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.col("form_n").cast("long").alias("form_n")))


def document_variants(docs: DataFrame, ratio: int = RATIO, parts: int | None = None) -> DataFrame:
    """Spelling variants among the words of ``docs``."""
    r = runs(docs)
    return variants(vocabulary(r.select(varied(F.col("doc_id"), F.col("run")).alias("word"))),
                    ratio, parts)
