"""What the two substring operators share: which windows could repeat at all.

A window of ``width`` units (words or bytes) owns the least hash among its
grams of ``gram`` units (its minimizer, leftmost of equals). Equal windows have
the same owner, so a window whose owner's hash occurs once in the corpus cannot
repeat. Counting one hash per run of windows with one owner, a few per cent of
all positions, therefore leaves only runs worth a full comparison; nothing that
repeats is lost.

Texts that are equal in whole are one class and go on once: where a class has
copies, each of its windows starts elsewhere too.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm import hashing as H
from fraudmart.llm.shared import documents_view, in_tasks, row_key, written

#: units of a text as numpy values, their number, and the digest of all that is kept
Units = Callable[[list[bytes]], list[np.ndarray]]
#: windows that are hashed at a time
PART = 1 << 20
SURVEY = ("doc_id long, row_key long, n_units long, whole_sha256 string, owners array<long>")


class Windows:
    """Windows of ``width`` units with minimizers of ``gram`` units."""

    def __init__(self, width: int, gram: int, units: Units, base: int = H.BASES[0]):
        self.width, self.gram, self.units, self.base = width, min(gram, width), units, base

    def runs(self, values: np.ndarray):
        """(first window, end, owner position, owner hash) of each run."""
        if len(values) < self.width:
            e = np.empty(0, dtype=np.int64)
            return e, e, e, e.view(np.uint64)
        span = self.width - self.gram + 1
        parts, n = [], len(values) - self.width + 1
        for at in range(0, n, PART):  # memory stays bounded for a text of any length
            grams = H.windows(values[at:at + PART + self.width - 1], self.gram, self.base)
            first, end, owner = H.owner_runs(H.sliding_owner(grams, span))
            parts.append((first + at, end + at, owner + at, grams[owner]))
        first, end, owner, h = (np.concatenate(x) for x in zip(*parts))
        new = np.append(True, owner[1:] != owner[:-1])  # a run may go on over a cut
        last = np.append(np.flatnonzero(new)[1:] - 1, len(new) - 1)
        return first[new], end[last], owner[new], h[new]


def _surveyor(w: Windows, digest):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                data = [(t or "").encode() for t in part.column(2).to_pylist()]
                values = w.units(data)
                owners = [w.runs(v)[3].view(np.int64) for v in values]
                ends = np.cumsum([0] + [len(o) for o in owners]).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.int64), *owners])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(v) for v in values], pa.int64()),
                     pa.array([digest(d) for d in data], pa.string()),
                     pa.ListArray.from_arrays(ends, pa.array(flat))],
                    names=["doc_id", "row_key", "n_units", "whole_sha256", "owners"])
    return run


def survey(docs: DataFrame, w: Windows, digest) -> DataFrame:
    """Per row ``doc_id, row_key, n_units, whole_sha256`` and the owners' hashes, run by run."""
    d = documents_view(docs).select(
        "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    return d.transform(in_tasks, _surveyor(w, digest), SURVEY)


def suspects(docs: DataFrame, surveyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes ``cid, whole_sha256, copies`` and, of those with an owner that occurs
    again, ``cid, owners, counts, text`` (``owners``: the distinct ones; ``counts``: how
    often each occurs in all classes). A text that repeats one owner many times, as
    periodic text does, is one row of the join."""
    g = (surveyed.groupBy("whole_sha256", "n_units")
         .agg(F.count(F.lit(1)).alias("copies"), F.min("row_key").alias("rep_key"),
              F.first("owners").alias("owners")))
    classes = written(g.withColumn("cid", F.monotonically_increasing_id()), "repeat-classes")
    again = (classes.select(F.explode("owners").alias("owner")).groupBy("owner")
             .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    held = classes.select("cid", F.explode(F.array_distinct("owners")).alias("owner"))
    found = (held.join(again, "owner").groupBy("cid")
             .agg(F.collect_list(F.struct("owner", "n")).alias("o"))
             .select("cid", F.col("o.owner").alias("owners"), F.col("o.n").alias("counts")))
    wanted = classes.select("cid", "rep_key").join(found, "cid")
    d = documents_view(docs)
    keyed = d.select(row_key(F.col("doc_id"), F.col("text")).alias("rep_key"),
                     F.coalesce("text", F.lit("")).alias("text"))
    texts = keyed.join(wanted, "rep_key").dropDuplicates(["cid"]).select(
        "cid", "owners", "counts", "text")
    return classes.drop("owners"), written(texts, "repeat-texts")


def chosen(w: Windows, values: np.ndarray, owners) -> list[tuple[int, int, int]]:
    """The runs of a text that the named owners have: (first window, end, owner hash)."""
    first, end, _, h = w.runs(values)
    at = np.flatnonzero(np.isin(h.view(np.int64), np.array(owners, dtype=np.int64)))
    return list(zip(first[at].tolist(), end[at].tolist(), h[at].tolist()))


def covered(n: int, spans: list[tuple[int, int]], unique: np.ndarray, width: int) -> np.ndarray:
    """Units covered by a repeated window: windows of the spans that are not unique."""
    window = np.zeros(n + 1, dtype=bool)
    for a, b in spans:
        window[a:b] = True
    window[unique] = False
    start = np.flatnonzero(window)
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, start, 1)
    np.add.at(step, start + width, -1)
    return np.cumsum(step, dtype=np.int32)[:n] > 0


def outcome(surveyed: DataFrame, classes: DataFrame, judged: DataFrame, width: int,
            empty_sha256: str, spans: bool) -> DataFrame:
    """Every input row with its class's result. ``judged``: ``cid, n_removed, n_spans,
    kept_sha256`` of the classes that had suspects."""
    r = classes.join(judged, "cid", "left")
    all_gone = (F.col("copies") > 1) & (F.col("n_units") >= width)
    r = r.select(
        "whole_sha256", "n_units",
        F.when(all_gone, F.col("n_units")).otherwise(F.coalesce("n_removed", F.lit(0)))
        .cast("long").alias("n_removed"),
        F.when(all_gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0)))
        .cast("long").alias("n_spans"),
        F.when(all_gone, F.lit(empty_sha256)).otherwise(F.coalesce("kept_sha256", "whole_sha256"))
        .alias("kept_sha256"))
    out = surveyed.select("doc_id", "row_key", "n_units", "whole_sha256").join(
        r, ["whole_sha256", "n_units"])
    return out.select("doc_id", "n_units", "n_removed", *(["n_spans"] if spans else []),
                      "kept_sha256", "row_key")
