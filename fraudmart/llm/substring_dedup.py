"""Substring dedup: Rabin-Karp hashes of fixed-length word windows, counted in Spark.

A window is ``WINDOW`` consecutive words of one document. A word goes when a
window that covers it has a word sequence that starts anywhere else too, in the
same document or another; windows are judged on the input. Overlapping windows
merge into maximal intervals.

Every window of every text is accounted for: minimizers (``repeats``) set apart
the windows that cannot repeat; the others are hashed to 96 bits and counted.
The count also keeps the place of a window that occurs once, so the repeated
windows are the rest and no join back is needed; a window that a third of all
documents share is one row per map task in that shuffle.

Defined results: NULL text has no words; words are runs of bytes other than
ASCII white space, unchanged; texts under ``WINDOW`` words lose nothing;
repeated rows are copies of each other and lose all their words (if there are
enough); empty table, empty result; extra columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm import hashing as H
from fraudmart.llm.repeats import Windows, chosen, covered, outcome, survey, suspects
from fraudmart.llm.shared import in_tasks, written

WINDOW = 35
GRAM = 8


def _digest(data: bytes) -> str:
    return sha256(b" ".join(data.split())).hexdigest()


def _window_rows(w: Windows):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                cids = part.column(0).to_pylist()
                data = [t.encode() for t in part.column(2).to_pylist()]
                h1s, h2s, cs, ps = [], [], [], []
                for cid, words, owners in zip(cids, w.units(data), part.column(1).to_pylist()):
                    h1 = H.windows(words, w.width, H.BASES[0])
                    h2 = H.windows(H.mix(words), w.width, H.BASES[1])
                    pos = np.concatenate([np.arange(a, e) for a, e, _ in chosen(w, words, owners)])
                    h1s.append(h1[pos]), h2s.append((h2[pos] >> H.U(32)).astype(np.uint32))
                    cs.append(np.full(len(pos), cid)), ps.append(pos.astype(np.int32))
                if cs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(h1s).view(np.int64)),
                         pa.array(np.concatenate(h2s).view(np.int32)),
                         pa.array(np.concatenate(cs), pa.int64()), pa.array(np.concatenate(ps))],
                        names=["h1", "h2", "cid", "pos"])
    return run


def _judge(w: Windows):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                data = [t.encode() for t in part.column(2).to_pylist()]
                rows = []
                for cid, owners, text, words, unique in zip(
                        part.column(0).to_pylist(), part.column(1).to_pylist(), data,
                        w.units(data), part.column(3).to_pylist()):
                    gone = covered(len(words), [r[:2] for r in chosen(w, words, owners)],
                                   np.array(unique or [], dtype=np.int64), w.width)
                    tokens = np.array(text.split(), dtype=object)
                    kept = b" ".join(tokens[~gone].tolist())
                    n_spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                    rows.append((cid, int(gone.sum()), n_spans, sha256(kept).hexdigest(), kept.decode()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                    names=["cid", "n_removed", "n_spans", "kept_sha256", "kept_text"])
    return run


def repeated_words(docs: DataFrame, width: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document ``doc_id, n_units, n_removed, n_spans, kept_sha256, row_key``."""
    w = Windows(width, gram, H.word_hashes)
    surveyed = written(survey(docs, w, _digest), "substring-survey")
    classes, texts = suspects(docs, surveyed)
    rows = in_tasks(texts.select("cid", "owners", "text"), _window_rows(w),
                    "h1 long, h2 int, cid long, pos int")
    # min() is the place itself where the count is one
    unique = (rows.groupBy("h1", "h2")
              .agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("cid"), F.min("pos").alias("pos"))
              .where(F.col("n") == 1).groupBy("cid").agg(F.collect_list("pos").alias("unique")))
    todo = texts.join(unique, "cid", "left").select("cid", "owners", "text", "unique")
    judged = written(in_tasks(todo, _judge(w), "cid long, n_removed long, n_spans long, "
                                               "kept_sha256 string, kept_text string"),
                     "substring-judged")
    return outcome(surveyed, classes, judged.drop("kept_text"), width,
                   sha256(b"").hexdigest(), True)
