"""Suffix-array dedup: two-stage suffix sorting finds bytes that occur again.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
anywhere else, in the same text or another (UTF-8, never across texts).

1. ``repeats`` leaves the runs of windows whose minimizer occurs again. The
   strings that one minimizer owns all contain it, so what can match lies
   around occurrences of one minimizer: each occurrence becomes a segment (the
   bytes of its windows), dealt out by the minimizer's hash.
2. Equal segments of one minimizer collapse, with their number.
3. A task gets bounded batches of whole minimizers, sorts the suffixes of the
   batch in two stages: only suffixes smaller than their successors are sorted
   directly, all others are induced by scanning the buckets of first bytes in
   order. Then common prefixes of neighbours in the order tell which strings of
   ``LENGTH`` bytes occur once. Those are reported with their place; all other
   windows of the runs repeat.
4. A minimizer with more than ``HOT`` occurrences is not sorted in one task:
   its windows are hashed to 96 bits and counted in Spark instead, an exact way
   for groups of any size.

Defined results: NULL text counts as empty; texts under ``LENGTH`` bytes lose
nothing; repeated rows are copies of each other; empty table, empty result;
extra columns are ignored.
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

LENGTH = 400
GRAM = 128
#: a minimizer's segments are sorted in one task up to so many (under 4 MB of text)
HOT = 5000
#: bytes of segments that one task sorts at a time (whole minimizers, so a batch may
#: exceed it by one minimizer)
BATCH = 1 << 20


# --- the suffix array ---------------------------------------------------------------

def _direct_order(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` ordered by the first ``depth`` bytes from there (more are not compared):
    by eight bytes at a time while most suffixes differ there, then the groups that
    are still equal by all their bytes."""
    head = 24
    padded = np.concatenate([text, np.zeros(head + 8, dtype=text.dtype)])
    words = np.zeros(len(text) + head, dtype=np.uint64)
    for j in range(8):
        words = (words << H.U(8)) | padded[j:j + len(words)].astype(np.uint64)
    out = at[np.lexsort([words[at + o] for o in range(head - 8, -1, -8)])]
    if len(out) < 2:
        return out
    same = np.ones(len(out) - 1, dtype=bool)
    for o in range(0, head, 8):
        key = words[out + o]
        same &= key[1:] == key[:-1]
    step = np.diff(np.concatenate([[False], same, [False]]).astype(np.int8))
    data = text.tobytes()

    def rest(i: int) -> bytes:
        return data[i + head:i + depth]

    for lo, hi in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
        out[lo:hi + 1] = sorted(out[lo:hi + 1].tolist(), key=rest)
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix: is it smaller than the one that starts a byte later?
    (The last one is not; runs of one byte follow their end.)"""
    n = len(text)
    diff = np.flatnonzero(text[1:] != text[:-1]) if n else np.empty(0, np.int64)
    nxt = np.searchsorted(diff, np.arange(n))
    ok = nxt < len(diff)
    out = np.zeros(n, dtype=bool)
    end = diff[nxt[ok]]
    out[ok] = text[end] < text[end + 1]
    return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, ordered by (at least) their first ``depth`` bytes.

    Stage one sorts the suffixes smaller than their successors. Stage two scans
    the buckets of first bytes upwards: each suffix in its final place puts its
    predecessor, if that is the larger kind, at the head of its bucket.
    """
    n = len(text)
    if not n:
        return np.empty(0, dtype=np.int64)
    small = smaller_than_next(text)
    sizes = np.bincount(text, minlength=256)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    sa = np.full(n, -1, dtype=np.int64)
    direct = _direct_order(text, np.flatnonzero(small), depth)
    first = text[direct]
    n_small = np.bincount(first, minlength=256)
    at = 0
    for c in np.flatnonzero(n_small):  # the small ones end their bucket
        sa[starts[c + 1] - n_small[c]:starts[c + 1]] = direct[at:at + n_small[c]]
        at += n_small[c]
    head = starts[:256].copy()
    last = text[n - 1]  # the empty suffix comes before all: it induces the last one
    if not small[n - 1]:
        sa[head[last]] = n - 1
        head[last] += 1

    def induce(done: np.ndarray) -> None:
        p = done[done > 0] - 1
        p = p[~small[p]]
        if not len(p):
            return
        c = text[p]
        o = np.argsort(c, kind="stable")
        p, c = p[o], c[o]
        counts = np.bincount(c, minlength=256)
        rank = np.arange(len(p)) - np.repeat(np.cumsum(counts)[counts > 0] - counts[counts > 0],
                                             counts[counts > 0])
        sa[head[c] + rank] = p
        head[:] += counts

    for c in np.flatnonzero(sizes):
        lo = starts[c]
        while lo < head[c]:  # larger kind: grows while suffixes of the same byte are induced
            hi = head[c]
            induce(sa[lo:hi])
            lo = hi
        induce(sa[starts[c + 1] - n_small[c]:starts[c + 1]])
    return sa


def same_as_next(text: np.ndarray, sa: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """For each place in the order but the last: do it and the next share ``length`` bytes?
    ``room``: bytes from each suffix to the end of its segment."""
    a, b = sa[:-1], sa[1:]
    ok = (room[a] >= length) & (room[b] >= length)
    todo = np.flatnonzero(ok)
    view = np.lib.stride_tricks.sliding_window_view(text, length) if len(text) >= length else None
    for at in range(0, len(todo), 4096):
        t = todo[at:at + 4096]
        ok[t] = (view[a[t]] == view[b[t]]).all(axis=1)
    return ok


def once(segments: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """For each segment the starts of its ``length``-byte strings that occur once in all
    segments (a segment that counts n occurs n times)."""
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    text = np.frombuffer(b"".join(segments), dtype=np.uint8)
    ends = np.cumsum(sizes)
    begin = ends - sizes
    owner = np.repeat(np.arange(len(segments)), sizes)
    room = ends[owner] - np.arange(len(text))
    sa = suffix_array(text, length)
    sa = sa[room[sa] >= length]
    same = same_as_next(text, sa, room, length)
    alone = np.ones(len(sa), dtype=bool)
    if len(sa) > 1:
        alone[:-1] &= ~same
        alone[1:] &= ~same
    alone &= np.array(counts)[owner[sa]] == 1
    found = np.sort(sa[alone])
    cut = np.searchsorted(found, np.append(begin, len(text)))
    return [found[a:b] - s for a, b, s in zip(cut[:-1], cut[1:], begin)]


# --- Spark --------------------------------------------------------------------------

def _bytes(docs: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(d, dtype=np.uint8) for d in docs]


def _byte_windows() -> Windows:
    return Windows(LENGTH, GRAM, _bytes)


def _segment_rows(w: Windows, hot: int):
    """Rows of cold minimizers: equal segments of one batch are one row already."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                held: dict[tuple[int, bytes], list[int]] = {}
                for cid, owners, counts, text in zip(*(part.column(i).to_pylist() for i in range(4))):
                    data = text.encode()
                    todo = [o for o, n in zip(owners, counts) if n <= hot]
                    for a, e, h in chosen(w, w.units([data])[0], todo) if todo else ():
                        key = (h, data[a:e - 1 + w.width])
                        if key in held:
                            held[key][0] += 1
                        else:
                            held[key] = [1, cid, a]
                if held:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array([k[0] for k in held], dtype=np.uint64).view(np.int64)),
                         pa.array([k[1] for k in held], pa.binary()),
                         *[pa.array([v[i] for v in held.values()], pa.int64()) for i in range(3)]],
                        names=["owner", "segment", "copies", "cid", "pos"])
    return run


def _hot_rows(w: Windows, hot: int):
    """Windows of hot minimizers, equal ones of one batch counted already."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = []
                for cid, owners, counts, text in zip(*(part.column(i).to_pylist() for i in range(4))):
                    todo = [o for o, n in zip(owners, counts) if n > hot]
                    if not todo:
                        continue
                    values = w.units([text.encode()])[0]
                    for lo, hi in joined([(a, e) for a, e, _ in chosen(w, values, todo)]):
                        piece = values[lo:hi - 1 + w.width]
                        found.append((H.windows(piece, w.width, H.BASES[0]),
                                      H.windows(piece, w.width, H.BASES[1]) >> H.U(32),
                                      np.full(hi - lo, cid, dtype=np.int64), np.arange(lo, hi)))
                if not found:
                    continue
                h1, h2, cids, pos = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((h2, h1))
                h1, h2 = h1[order], h2[order]
                first = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
                n = np.diff(np.append(first, len(h1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1[first].view(np.int64)),
                     pa.array(h2[first].astype(np.uint32).view(np.int32)),
                     pa.array(n, pa.int64()), pa.array(cids[order][first]),
                     pa.array(pos[order][first], pa.int64())], names=["h1", "h2", "n", "cid", "pos"])
    return run


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Adjacent spans as one."""
    out: list[tuple[int, int]] = []
    for a, e in spans:
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], e)
        else:
            out.append((a, e))
    return out


def _sorter(length: int, batch: int):
    def flush(rows):
        merged: dict[bytes, list[int]] = {}
        for seg, copies, cid, pos in rows:
            if seg in merged:
                merged[seg][0] += copies
            else:
                merged[seg] = [copies, cid, pos]
        segs = list(merged)
        counts = [v[0] for v in merged.values()]
        out_c, out_p = [], []
        for (n, cid, pos), at in zip(merged.values(), once(segs, counts, length)):
            if len(at):
                out_c.append(np.full(len(at), cid))
                out_p.append(at + pos)
        return out_c, out_p

    def run(batches):
        """Rows come sorted by minimizer; a batch ends between two of them."""
        rows, size, owner = [], 0, None
        for b in batches:
            for o, seg, copies, cid, pos in zip(*(b.column(i).to_pylist() for i in range(5))):
                if o != owner and size >= batch:
                    yield from _emit(flush(rows))
                    rows, size = [], 0
                owner = o
                rows.append((seg, copies, cid, pos))
                size += len(seg)
        if rows:
            yield from _emit(flush(rows))
    return run


def _emit(found):
    c, p = found
    if c:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c), pa.int64()), pa.array(np.concatenate(p), pa.int64())],
            names=["cid", "pos"])


def _judge(w: Windows):
    def run(batches):
        for b in batches:
            rows = []
            for cid, owners, text, unique in zip(*(b.column(i).to_pylist() for i in range(4))):
                data = text.encode()
                values = w.units([data])[0]
                gone = covered(len(data), [r[:2] for r in chosen(w, values, owners)],
                               np.array(unique or [], dtype=np.int64), w.width)
                kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                rows.append((cid, int(gone.sum()), spans, sha256(kept).hexdigest(), kept))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                    names=["cid", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def repeated_bytes(docs: DataFrame, hot: int = HOT, batch: int = BATCH) -> DataFrame:
    """Per document ``doc_id, n_units, n_removed, n_spans, kept_sha256, row_key``."""
    w = _byte_windows()
    surveyed = written(survey(docs, w, lambda d: sha256(d).hexdigest()), "suffix-survey")
    classes, texts = suspects(docs, surveyed)
    rows = texts.select("cid", "owners", "counts", "text")
    segments = in_tasks(rows, _segment_rows(w, hot),
                        "owner long, segment binary, copies long, cid long, pos long")
    cold = (segments.repartition("owner").sortWithinPartitions("owner")
            .transform(in_tasks, _sorter(w.width, batch), "cid long, pos long"))
    counted = in_tasks(rows.where(F.exists("counts", lambda n: n > hot)), _hot_rows(w, hot),
                       "h1 long, h2 int, n long, cid long, pos long")
    warm = (counted.groupBy("h1", "h2")
            .agg(F.sum("n").alias("n"), F.min("cid").alias("cid"), F.min("pos").alias("pos"))
            .where(F.col("n") == 1).select("cid", "pos"))
    unique = cold.union(warm).groupBy("cid").agg(F.collect_list("pos").alias("unique"))
    todo = texts.join(unique, "cid", "left").select("cid", "owners", "text", "unique")
    judged = written(in_tasks(todo, _judge(w), "cid long, n_removed long, n_spans long, "
                                               "kept_sha256 string, kept binary"), "suffix-judged")
    return outcome(surveyed, classes, judged.drop("kept"), w.width, sha256(b"").hexdigest(), True)
