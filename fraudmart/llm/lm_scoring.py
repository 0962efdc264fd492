"""LM scoring: a log-bilinear neural model trained by noise-contrastive estimation.

Tokens are the words of a text (lower-case A-Z, runs of bytes other than ASCII
white space) and one end. Training documents give

* the count of every token (all of them, unbounded vocabulary, kept in Spark);
* counts of class trigrams, from which the driver trains a first model. The
  ``HEAD_CLASSES`` most frequent words are classes of their own; all others fall
  into ``TAIL_CLASSES`` classes by the hash of their last two bytes; the end and
  the start are classes;
* every occurrence of a token with the two before it: tasks train the model of
  words on all of them, once, so training grows with the corpus.

The model of words has a vector for each word that travels with the tasks (see
below), as context and as target; rarer words share the context vector of their
class. A target is predicted in three steps: its class, its group of at most
``GROUP`` words (or the rarer words) in the class, the word in the group. Each
step is the scalar product of the context (two vectors, one matrix per position)
with a vector, and a bias; it is trained by noise-contrastive estimation (noise:
frequencies) and normalised by a softmax. The first model gives the start; the
tasks of a round train copies, whose rows are averaged in Spark by how often each
was trained. Texts are split once, into a table of head indices that trigrams, training
and scoring read; training rows are dealt out, and ordered, by a hash of
their text, so the scores belong to the rows and not to how they were partitioned. A rarer word has its add-one share of its class's rarer words, of
which a share is reserved for words that training did not have: probabilities of
all words sum to one.

Counts of the most frequent words (at most ``HEAD_WORDS``, chosen by a threshold
on counts) travel with the tasks; rarer words are joined with their counts in
Spark, grouped per document first.

Defined results: NULL text is empty: one token, the end; a NULL ``doc_id`` hashes
as the empty string (training); ties between equally frequent words go to the
smaller word; repeated rows are trained on and scored as often as they occur; an
empty table, or one without training rows, trains on nothing (uniform classes);
a very long text is split in slices and scored as one window; extra columns are
ignored. The first model sees ``STEPS * BATCH`` drawn trigrams at any size, as it only
gives the start; the model of words trains on every token.
"""

from __future__ import annotations

import ctypes
import math
import os
from functools import cached_property, lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.hashing import cuts
from fraudmart.llm.shared import documents_view, in_tasks, kept, written

FOLDS, HELD_OUT = 7, 2
HEAD_CLASSES, TAIL_CLASSES = 72, 54
CLASSES = HEAD_CLASSES + TAIL_CLASSES + 2
END, START = CLASSES - 2, CLASSES - 1
#: the end as a token; no word is empty
END_TOKEN = ""
HEAD_WORDS = 200_000
DIMENSIONS, STEPS, BATCH, NOISE, SEED = 24, 1500, 1024, 20, 7
#: words of a group; rounds over disjoint parts of the training rows; tokens that a copy of
#: the parameters is trained on in all rounds; noise words that the contexts of a batch share; learning rate
GROUP, ROUNDS, TASK_TOKENS, SHARED, RATE = 64, 2, 16_000_000, 32, .1
#: tokens that a task trains on, and scores, at a time; bytes of text that it splits at a time
WINDOW, SCORE_WINDOW, SLICE = 1 << 16, 1 << 19, 1 << 22


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def tail_class(word: str | bytes) -> int:
    data = word.encode() if isinstance(word, str) else word
    return HEAD_CLASSES + crc32(data[-2:]) % TAIL_CLASSES


def text_slices(texts: pa.Array):
    """Rows of about ``SLICE`` bytes at a time: first row, end, texts. A longer text comes alone,
    in blocks cut at white space."""
    upto = np.cumsum([0, *pc.fill_null(pc.binary_length(texts), 0).to_pylist()])
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + SLICE, side="right")) - 1)
        if upto[hi] - upto[lo] > SLICE:
            blocks = pa.array(cuts(texts[lo].as_py().encode()), pa.binary())
            yield lo, hi, blocks.cast(pa.string())
        else:
            yield lo, hi, texts.slice(lo, hi - lo)
        lo = hi


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (lower-case A-Z, none of null), in order, and how many each has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    cut, words = np.asarray(lists.offsets), lists.values
    some = pc.binary_length(words).to_numpy() > 0   # white space at an end leaves an empty one
    if some.all():
        return words, np.diff(cut)
    return words.filter(pa.array(some)), np.diff(np.concatenate([[0], np.cumsum(some)])[cut])


def _summed(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("token", use_threads=False).aggregate(
        [("c", "sum")]).rename_columns({"c_sum": "c"})


def token_table(docs: DataFrame, flush: int = 400_000) -> DataFrame:
    """``token, c`` of a frame with ``text``; each task counts before the shuffle."""
    def run(batches):
        held, texts = [], 0
        for b in batches:
            texts += b.num_rows
            for _, _, part in text_slices(b.column(0)):
                token, c = pc.value_counts(words_of(part)[0]).flatten()
                held.append(pa.table({"token": token, "c": c}))
                if sum(map(len, held)) > flush:
                    held = [_summed(held)]
                    if len(held[0]) > flush:
                        yield from held.pop().to_batches()
        end = pa.table({"token": pa.array([END_TOKEN]), "c": pa.array([texts], pa.int64())})
        if texts:
            yield from _summed([*held, end]).to_batches()

    return (docs.select("text").transform(in_tasks, run, "token string, c long")
            .groupBy("token").agg(F.sum("c").alias("c")))


def head_words(counts: DataFrame, limit: int = HEAD_WORDS) -> dict[str, int]:
    """The words at or above the least count level that at most ``limit`` words reach.

    Levels are sixteenths of a power of two: a table of under 1,100 rows, so
    neither a sort nor a large result reaches the driver.
    """
    level = F.floor(F.log2(F.col("c").cast("double")) * 16)
    words = counts.where(F.col("token") != END_TOKEN).withColumn("level", level)
    sizes = sorted(((r.level, r.n) for r in
                    words.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()),
                   reverse=True)
    total, least = 0, None
    for lv, n in sizes:
        if total + n > limit:
            break
        total, least = total + n, lv
    if least is None:
        return {}
    rows = words.where(F.col("level") >= least).select("token", "c").toArrow()
    got = zip(rows.column("token").to_pylist(), rows.column("c").to_pylist())
    return dict(sorted(got, key=lambda x: (-x[1], x[0])))


class Classes:
    """Head words with class and count; arrays by head index, then one entry for the end."""

    def __init__(self, head: dict[str, int], end_count: int):
        words = list(head)
        self.words = pa.array(words, pa.string())
        self.of = np.array([i if i < HEAD_CLASSES else tail_class(w)
                            for i, w in enumerate(words)] + [END], dtype=np.int64)
        self.count = np.array([head[w] for w in words] + [end_count], dtype=np.int64)
        self.end = len(words)

    @cached_property
    def index(self) -> dict[bytes, int]:
        return {w.encode(): i for i, w in enumerate(self.words.to_pylist())}

    def heads(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray]:
        """Head indices of words (a rarer word: -1 - k in the k-th tail class), and the places of
        the rarer ones with them."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().copy()
        places = np.flatnonzero(at < 0)
        rarer = words.take(pa.array(places)).dictionary_encode()
        tails = np.array([tail_class(w) for w in rarer.dictionary.to_pylist()], np.int32)
        if len(places):
            at[places] = HEAD_CLASSES - 1 - tails[rarer.indices.to_numpy()]
        return at, places, rarer


@kept
@lru_cache(maxsize=2)
def _classes(key: tuple) -> Classes:
    words, counts, end = key
    return Classes(dict(zip(words, counts)), end)


TOKEN_ROWS = ("doc_id long, held_out boolean, dealt_by long, at array<int>, rare array<string>, "
              "times array<long>")


def token_rows(docs: DataFrame, key: tuple) -> DataFrame:
    """``docs`` (``doc_id, held_out, text``) as head indices, with the distinct rarer words of
    each text and how often they occur: all that later steps read of a text."""
    def run(batches):
        known = _classes(key)
        for b in batches:
            for lo, hi, texts in text_slices(b.column(3)):
                words, size = words_of(texts)
                if len(texts) != hi - lo:   # blocks of one text
                    size = size.sum(keepdims=True)
                at, places, rarer = known.heads(words)
                ends = np.cumsum(size + 1)
                units = np.full(ends[-1], known.end, np.int32)
                inside = np.ones(len(units), dtype=bool)
                inside[ends - 1] = False
                units[inside] = at
                n = max(len(rarer.dictionary), 1)
                text = np.searchsorted(np.cumsum(size), places, side="right")
                pair, times = np.unique(text * n + rarer.indices.to_numpy(), return_counts=True)
                cut = pa.array(np.searchsorted(pair, np.arange(hi - lo + 1) * n), pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [*[b.column(i).slice(lo, hi - lo) for i in range(3)],
                     pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(units)),
                     pa.ListArray.from_arrays(cut, rarer.dictionary.take(pa.array(pair % n))),
                     pa.ListArray.from_arrays(cut, pa.array(times, pa.int64()))],
                    names=["doc_id", "held_out", "dealt_by", "at", "rare", "times"])
                for first, end, _, _ in windows(out, 3, SCORE_WINDOW):
                    yield out.slice(first, end - first)

    return docs.select("doc_id", "held_out", F.xxhash64("text").alias("dealt_by"), "text").transform(
        in_tasks, run, TOKEN_ROWS)


def classes_of(at: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Classes of head indices as ``Classes.heads`` gives them. ``of``: those of head words."""
    return np.where(at < 0, HEAD_CLASSES - 1 - at, of[np.maximum(at, 0)])


def windows(batch: pa.RecordBatch, column: int, size: int):
    """Rows of a batch in runs of about ``size`` tokens: first row, end, tokens, sizes."""
    lists = batch.column(column)
    cut, flat = np.asarray(lists.offsets), np.asarray(lists.values)
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(cut, cut[lo] + size, side="right")) - 1)
        yield lo, hi, flat[cut[lo]:cut[hi]], np.diff(cut[lo:hi + 1])
        lo = hi


def dealt_windows(batches, size: int):
    """Rows ``dealer, dealt_by, at``, sorted, in runs of about ``size`` tokens of one dealer,
    whatever batches they come in: dealer, tokens, sizes."""
    me, parts, sizes, held = None, [], [], 0
    for batch in batches:
        dealers, lists = batch.column(0).to_pylist(), batch.column(2)
        cut, flat = np.asarray(lists.offsets), np.asarray(lists.values)
        for i, (dealer, n) in enumerate(zip(dealers, np.diff(cut).tolist())):
            if sizes and (dealer != me or held + n > size):
                yield me, np.concatenate(parts), np.array(sizes)
                parts, sizes, held = [], [], 0
            me, held = dealer, held + n
            parts.append(flat[cut[i]:cut[i + 1]]), sizes.append(n)
    if sizes:
        yield me, np.concatenate(parts), np.array(sizes)


def before(units: np.ndarray, size: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The two units before each token of its text (``none``: there is none)."""
    a, b = np.empty_like(units), np.empty_like(units)
    b[1:], a[2:] = units[:-1], units[:-2]
    starts = np.cumsum(size) - size
    b[starts], a[starts] = none, none
    a[(starts + 1)[size > 1]] = none
    return a, b


def class_trigrams(rows: DataFrame, known: Classes) -> DataFrame:
    """``code, n`` of token rows: how often class w follows classes a, b
    (code = (a * K + b) * K + w)."""
    of = known.of

    def run(batches):
        codes, held = [], 0
        for batch in batches:
            for _, _, at, size in windows(batch, 0, SCORE_WINDOW):
                cls = classes_of(at, of)
                a, b = before(cls, size, START)
                codes.append((a * CLASSES + b) * CLASSES + cls)
                held += len(at)
                if held > 2_000_000:
                    yield _counted(codes)
                    codes, held = [], 0
        if codes:
            yield _counted(codes)

    return (rows.select("at").transform(in_tasks, run, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")))


def _counted(codes) -> pa.RecordBatch:
    code, n = np.unique(np.concatenate(codes), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n, pa.int64())],
                                      names=["code", "n"])


class LogBilinear:
    """score(w | a, b) = (r_a C_1 + r_b C_2) . q_w + bias_w"""

    def __init__(self, seed: int = SEED, d: int = DIMENSIONS):
        rnd = np.random.default_rng(seed)
        self.r = rnd.normal(0, .1, (CLASSES, d))
        self.q = rnd.normal(0, .1, (CLASSES, d))
        self.c = np.stack([np.eye(d), np.eye(d)]) + rnd.normal(0, .01, (2, d, d))
        self.bias = np.zeros(CLASSES)

    def fit(self, code: np.ndarray, n: np.ndarray, steps: int = STEPS, batch: int = BATCH,
            noise: int = NOISE, seed: int = SEED) -> LogBilinear:
        """Noise-contrastive estimation on weighted trigrams (``code`` sorted): each is told
        from ``noise`` draws of the class frequencies, taken in expectation."""
        if not len(code):
            return self
        w = code % CLASSES
        freq = np.bincount(w, weights=n, minlength=CLASSES) + 1e-3
        freq[START] = 1e-9
        p = freq / freq.sum()
        self.bias = np.log(p)
        offset = np.log(noise * p)
        upto = np.cumsum(n, dtype=np.float64)
        rnd = np.random.default_rng(seed)
        params = (self.r, self.q, self.c, self.bias)
        seen = [np.full_like(x, 1e-6) for x in params]
        rows = np.arange(batch)
        for step in range(steps):
            x = code[np.searchsorted(upto, rnd.random(batch) * upto[-1], side="right").clip(
                max=len(code) - 1)]
            a, b, target = x // CLASSES ** 2, x // CLASSES % CLASSES, x % CLASSES
            ra, rb = self.r[a], self.r[b]
            h = ra @ self.c[0] + rb @ self.c[1]
            s = h @ self.q.T + self.bias - offset
            real = 1 / (1 + np.exp(-np.clip(s, -30, 30)))  # P(from the data)
            g = -real * (noise * p)  # noise terms, then the true target's term
            g[rows, target] += 1 - real[rows, target]
            g /= batch
            gh = g @ self.q
            gr = np.zeros_like(self.r)
            np.add.at(gr, a, gh @ self.c[0].T)
            np.add.at(gr, b, gh @ self.c[1].T)
            grads = (gr, g.T @ h, np.stack([ra.T @ gh, rb.T @ gh]), g.sum(axis=0))
            rate = .3 * (1 - step / steps) + .01
            for x, dx, acc in zip(params, grads, seen):
                acc += dx * dx
                x += rate * dx / np.sqrt(acc)
        return self

    def log_probs(self) -> np.ndarray:
        """Normalised log probabilities [context, class] for all contexts, in batches."""
        out = np.empty((CLASSES ** 2, CLASSES), dtype=np.float64)
        left, right = self.r @ self.c[0], self.r @ self.c[1]
        for a in range(CLASSES):
            s = (left[a] + right) @ self.q.T + self.bias
            s[:, START] = -np.inf  # the start never follows
            s -= s.max(axis=1, keepdims=True)
            out[a * CLASSES:(a + 1) * CLASSES] = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
        return out


def class_sizes(counts: DataFrame, known: Classes) -> np.ndarray:
    """log10 of each class's sum of (c + 1) over its training words, plus one for a new word.
    Classes of one word or of the end are certain of it."""
    words = [w.decode() for w in list(known.index)[:HEAD_CLASSES]]
    rare = counts.where((F.col("token") != END_TOKEN) & ~F.col("token").isin(words)) if words else (
        counts.where(F.col("token") != END_TOKEN))
    data = F.encode("token", "UTF-8")
    last = F.when(F.octet_length("token") > 2, F.substring(data, -2, 2)).otherwise(data)
    rows = (rare.groupBy((F.crc32(last) % TAIL_CLASSES).alias("k"))
            .agg(F.sum(F.col("c") + 1).alias("s")).collect())
    z = np.zeros(CLASSES)
    for r in rows:
        z[HEAD_CLASSES + r.k] = r.s
    z[HEAD_CLASSES:HEAD_CLASSES + TAIL_CLASSES] += 1
    return np.log10(np.maximum(z, 1))


class Tree:
    """The shipped words past the head classes by class and group; the last group of each
    class stands for its rarer words. Rows of words lie together by group, groups by class."""

    def __init__(self, known: Classes, sizes: np.ndarray):
        n = known.end
        tail = np.arange(min(HEAD_CLASSES, n), n)
        cls = known.of[tail] - HEAD_CLASSES
        order = np.argsort(cls, kind="stable")
        tail, cls = tail[order], cls[order]
        first = np.searchsorted(cls, np.arange(TAIL_CLASSES + 1))
        self.first_group = np.concatenate([[0], np.cumsum(-(-np.diff(first) // GROUP) + 1)])
        group = self.first_group[cls] + (np.arange(len(cls)) - first[cls]) // GROUP
        groups = int(self.first_group[-1])
        self.rest = self.first_group[1:] - 1
        self.row = np.full(n + 1, -1)
        self.row[tail] = np.arange(len(tail))
        self.group = np.full(n + 1, -1)
        self.group[tail] = group
        self.first_word = np.searchsorted(group, np.arange(groups + 1))
        self.word_mass = known.count[tail] + 1.0
        self.group_mass = np.bincount(group, self.word_mass, minlength=groups)
        held = np.bincount(cls, self.word_mass, minlength=TAIL_CLASSES)
        z = 10 ** sizes[HEAD_CLASSES:HEAD_CLASSES + TAIL_CLASSES]
        self.group_mass[self.rest] = np.maximum(np.round(z - held), 1)
        # rows of the parameters: contexts, groups, words, classes, two matrices
        self.n, self.units = n, n + TAIL_CLASSES + 2
        self.groups_at = self.units
        self.words_at = self.groups_at + groups
        self.classes_at = self.words_at + len(tail)
        self.matrices_at = self.classes_at + CLASSES

    def start(self, known: Classes, model: LogBilinear) -> np.ndarray:
        """Parameters (vector, bias) that give the first model with add-one shares."""
        d = model.r.shape[1]
        p = np.zeros((self.matrices_at + 2 * d, d + 1), dtype=np.float32)
        p[:self.n, :d] = model.r[known.of[:self.n]]
        p[self.n:self.units, :d] = model.r[HEAD_CLASSES:]
        p[self.groups_at:self.words_at, d] = np.log(self.group_mass / self.group_mass.sum())
        p[self.words_at:self.classes_at, d] = np.log(self.word_mass / self.word_mass.sum())
        p[self.classes_at:self.matrices_at, :d] = model.q
        p[self.classes_at:self.matrices_at, d] = model.bias
        p[self.matrices_at:, :d] = model.c.reshape(2 * d, d)
        return p

    def rows(self, of: np.ndarray, at: np.ndarray, size: np.ndarray):
        """Of all tokens of a run of token rows: contexts a and b, class, group and word row
        (-1: none). ``of``: classes of the head words."""
        rare, head, cls = at < 0, np.maximum(at, 0), classes_of(at, of)
        a, b = before(np.where((at >= 0) & (at < self.n), at, self.n + cls - HEAD_CLASSES), size,
                      self.units - 1)
        group = self.group[head]
        group[rare] = self.rest[cls[rare] - HEAD_CLASSES]
        return a, b, cls, group, np.where(rare, -1, self.row[head])


@lru_cache(maxsize=1)
def one_thread() -> None:
    """Tasks share their machine: matrix products of this process stay on one core (where
    numpy brings its own OpenBLAS; elsewhere the caller's settings hold)."""
    folder = os.path.join(os.path.dirname(os.path.dirname(np.__file__)), "numpy.libs")
    for name in os.listdir(folder) if os.path.isdir(folder) else ():
        if "openblas" in name:
            put = getattr(ctypes.CDLL(os.path.join(folder, name)),
                          "scipy_openblas_set_num_threads64_", None)
            if put:
                put(1)


class Training:
    """One task's copy of the parameters."""

    def __init__(self, tree: Tree, start: np.ndarray, seed: int, rate: float = RATE):
        self.tree, self.p, self.rate = tree, start.copy(), rate
        self.seen = np.ones(len(start), dtype=np.float32)
        self.times = np.zeros(len(start), dtype=np.int64)
        self.rnd = np.random.default_rng(seed)
        classes = start[tree.classes_at:tree.matrices_at, -1].astype(np.float64)
        share = np.exp(classes - classes.max())
        self.noise = (NOISE * share / share.sum()).astype(np.float32)
        self.offset = np.log(self.noise)
        self.mass = {at: (np.log(NOISE * m / m.sum()).astype(np.float32), np.cumsum(m / m.sum()))
                     for at, m in ((tree.groups_at, tree.group_mass), (tree.words_at, tree.word_mass))
                     if len(m)}
        self.place = np.zeros(len(start), dtype=np.int64)
        # whole rows as single values: they are put back much faster than by two dimensions
        self.whole = self.p.view(f"V{self.p.strides[0]}").ravel()
        most, d = 4 * BATCH + 2 * SHARED, self.p.shape[1]
        self.rows, self.grads = np.empty(most, dtype=np.int64), np.empty((most, d), dtype=np.float32)
        self.every, self.cells = np.arange(most), np.arange(most * d).reshape(most, d)

    def _add(self, n: int) -> None:
        """Adds up the first ``n`` gradients by row, then steps."""
        rows, every, place, d = self.rows[:n], self.every[:n], self.place, self.p.shape[1]
        place[rows] = every
        first = rows[place.take(rows) == every]   # each row once
        place[first] = every[:len(first)]
        which = place.take(rows)
        total = np.bincount(self.cells.take(which, axis=0).ravel(), self.grads[:n].ravel(),
                            len(first) * d).astype(np.float32).reshape(-1, d)
        self._scale(first, total)
        total += self.p.take(first, axis=0)
        self.whole[first] = total.view(self.whole.dtype).ravel()
        self.times[first] += np.bincount(which, minlength=len(first))

    def _scale(self, rows, g: np.ndarray) -> None:
        acc = self.seen[rows] + np.einsum("ij,ij->i", g, g) / g.shape[1]
        self.seen[rows] = acc
        g *= (self.rate / np.sqrt(acc))[:, None]

    def _step(self, rows: slice, g: np.ndarray) -> None:
        self._scale(rows, g)
        self.p[rows] += g

    # a sigmoid is (1 + tanh(x / 2)) / 2: halves and offsets go into the smaller factor of a product

    def _told(self, h: np.ndarray, at: int, target: np.ndarray, noise: np.ndarray, out: slice):
        """Targets told from noise that the batch shares: the gradients of the contexts. Rows of
        parameters and their gradients go to ``out``."""
        offset, n = self.mass[at][0], len(target)
        rows, grads = self.rows[out], self.grads[out]
        np.add(target, at, out=rows[:n])
        np.add(noise, at, out=rows[n:])
        qt, qn = self.p.take(rows[:n], axis=0), self.p.take(rows[n:], axis=0)
        real = np.einsum("ij,ij->i", h, qt)
        real -= offset.take(target)
        real = (.5 - .5 * np.tanh(.5 * real))[:, None]
        half = .5 * qn
        half[:, -1] -= .5 * offset.take(noise)
        false = np.tanh(h @ half.T)
        false += 1
        false *= -np.float32(.5 * NOISE / SHARED)
        np.multiply(real, h, out=grads[:n])
        np.matmul(false.T, h, out=grads[n:])
        qt *= real
        qt += false @ qn
        return qt

    def batch(self, a, b, cls, told) -> None:
        """A vector's last entry is its bias; that of a context is one. ``told``: of groups and
        words, where their rows begin, the targets of the first tokens, noise."""
        t, d = self.tree, self.p.shape[1] - 1
        n = len(cls)
        units = self.rows[:2 * n]
        units[:n], units[n:] = a, b
        c = np.zeros((2, d + 1, d + 1), dtype=np.float32)
        c[:, :d] = self.p[t.matrices_at:].reshape(2, d, d + 1)
        r = self.p.take(units, axis=0)
        ra, rb = r[:n], r[n:]
        h = ra @ c[0]
        h += rb @ c[1]
        h[:, d] = 1
        q = self.p[t.classes_at:t.matrices_at]
        half = .5 * q
        half[:, d] -= .5 * self.offset
        g = h @ half.T
        np.tanh(g, out=g)
        # the gradient of a score is -noise * (1 + tanh) / 2, of the target's besides what is
        # missing to one; the factor of the class goes into the products below
        share, own = -.5 * self.noise, np.arange(n) * g.shape[1] + cls
        flat = g.ravel()
        real = .5 - .5 * flat.take(own)
        g += 1
        flat[own] += real / share.take(cls)
        gh, gq = g @ (q * share[:, None]), (g.T @ h) * share[:, None]
        upto = 2 * n
        for at, target, noise in told:
            m, k = len(target), upto + len(target) + len(noise)
            gh[:m] += self._told(h[:m], at, target, noise, slice(upto, k))
            upto = k
        gh[:, d] = 0
        gc = np.concatenate([ra[:, :d].T @ gh, rb[:, :d].T @ gh])
        np.matmul(gh, c[0].T, out=self.grads[:n])
        np.matmul(gh, c[1].T, out=self.grads[n:2 * n])
        self._add(upto)
        self._step(slice(t.classes_at, t.matrices_at), gq)
        self._step(slice(t.matrices_at, None), gc)
        self.times[t.classes_at:] += n

    def window(self, rows) -> None:
        a, b, cls, *targets = rows
        n, starts = len(a), (self.tree.groups_at, self.tree.words_at)
        order, part = self.rnd.permutation(n), np.arange(n) // BATCH
        # of a batch, tokens with a word come first, then those with a group only
        has = [x[order] >= 0 for x in targets]
        sizes = np.array([np.bincount(part, x) for x in has], dtype=np.int64).T
        order = order[np.argsort(3 * part - has[0] - has[1], kind="stable")]
        a, b, cls, *targets = (x[order] for x in rows)
        drawn = np.zeros((*sizes.shape, SHARED))
        drawn[sizes > 0] = self.rnd.random((np.count_nonzero(sizes), SHARED))
        noise = [np.searchsorted(upto, drawn[:, i]).clip(max=len(upto) - 1)
                 for i, upto in ((i, self.mass[x][1]) for i, x in enumerate(starts) if x in self.mass)]
        for k, at in enumerate(range(0, n, BATCH)):
            own = slice(at, at + BATCH)
            self.batch(a[own], b[own], cls[own],
                       [(starts[i], targets[i][at:at + m], noise[i][k])
                        for i, m in enumerate(sizes[k].tolist()) if m])


#: rows of parameters that travel as one: rows, how often each was trained, vectors
COPIES, COPY_ROWS = "block int, task int, row binary, n binary, v binary", 2048


def _block(block: int, task: int, rows: np.ndarray, n: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    data = [pa.array([x.tobytes()], pa.binary()) for x in (
        rows.astype(np.int64), n.astype(np.int64), v.astype(np.float32))]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([task], pa.int32()), *data],
        names=["block", "task", "row", "n", "v"])


def _rows(row: bytes, n: bytes, v: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = np.frombuffer(row, np.int64)
    return rows, np.frombuffer(n, np.int64), np.frombuffer(v, np.float32).reshape(len(rows), -1)


def _copy(dealer: int, task: Training):
    """The rows of a dealer's parameters that it trained."""
    for k, at in enumerate(range(0, len(task.p), COPY_ROWS)):
        rows = at + np.flatnonzero(task.times[at:at + COPY_ROWS])
        if len(rows):
            yield _block(k, dealer, rows, task.times[rows], task.p[rows])


def _averaged(batches):
    """Copies of blocks, sorted by block and task -> each row's average, weighted by ``n``."""
    me, n, v = None, None, None

    def out():
        some = np.flatnonzero(n)
        return _block(me, -1, me * COPY_ROWS + some, n[some], v[some] / n[some, None])

    for b in batches:
        for k, *copy in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
            rows, times, vectors = _rows(*copy)
            if k != me:
                if me is not None:
                    yield out()
                me, n, v = k, np.zeros(COPY_ROWS, np.int64), np.zeros((COPY_ROWS, vectors.shape[1]))
            rows = rows - k * COPY_ROWS
            n[rows] += times
            v[rows] += vectors.astype(np.float64) * times[:, None]
    if me is not None:
        yield out()


def train_words(train: DataFrame, known: Classes, tree: Tree, start: np.ndarray, n: int,
                rounds: int = ROUNDS) -> tuple[np.ndarray, int]:
    """Parameters after all training rows, and how many tokens they were trained on.

    Rounds train on disjoint parts of the rows; dealers' rows are averaged in Spark.
    Parameters lie on the machines' disks while their round lasts, no longer."""
    p, trained = start, 0
    dealers = max(1, -(-n // TASK_TOKENS))
    for k in range(rounds):
        shared = train.sparkSession.sparkContext.broadcast((known.of, tree, p))

        def run(batches, shared=shared, k=k):
            one_thread()
            task, me, (of, tree, p) = None, None, shared.value
            for dealer, at, size in dealt_windows(batches, WINDOW):
                if dealer != me:
                    if task is not None:
                        yield from _copy(me, task)
                    task, me = Training(tree, p, SEED + k * 1_000_003 + dealer, RATE / (k + 1)), dealer
                task.window(tree.rows(of, at, size))
            if task is not None:
                yield from _copy(me, task)

        # a dealer's copy of the parameters belongs to its rows: how many copies there are follows
        # the tokens, not the partitions
        dealer = F.pmod(F.hash("dealt_by"), F.lit(dealers)).alias("dealer")
        part = train.where(F.pmod("dealt_by", F.lit(rounds)) == k).select(dealer, "dealt_by", "at")
        dealt = part.repartition(4 * dealers, "dealer").sortWithinPartitions("dealer", "dealt_by")
        copies = dealt.transform(in_tasks, run, COPIES)
        moved = (copies.repartition("block").sortWithinPartitions("block", "task")
                 .transform(in_tasks, _averaged, COPIES).select("row", "n", "v").toArrow())
        shared.destroy()
        p = p.copy()
        for copy in zip(*(c.to_pylist() for c in moved.columns)):
            rows, times, vectors = _rows(*copy)
            p[rows] = vectors
            trained += int(times[rows == tree.classes_at].sum())
    return p, trained


class Scores:
    """Normalised log probabilities (base 10) of tokens; rarer words: of all of their class."""

    def __init__(self, tree: Tree, p: np.ndarray):
        self.tree, self.p, d = tree, p, p.shape[1] - 1
        c = p[tree.matrices_at:].reshape(2, d, d + 1)
        self.left, self.right = p[:tree.units, :d] @ c[0], p[:tree.units, :d] @ c[1]
        self.left[:, d], self.right[:, d] = 1, 0
        self.q = p[tree.classes_at:tree.matrices_at].copy()
        self.q[START] = 0
        self.q[START, d] = -1e30  # the start never follows

    @staticmethod
    def _total(s: np.ndarray) -> np.ndarray:
        """Logarithm of the sum of the exponentials of each row."""
        e = np.einsum("ij->i", np.exp(s))
        if not (e.min() > 1e-30 and e.max() < np.inf):
            top = s.max(axis=1)
            return top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        return np.log(e)

    def __call__(self, a, b, cls, group, row) -> np.ndarray:
        t = self.tree
        pair, which = np.unique(a * t.units + b, return_inverse=True)
        contexts = self.left.take(pair // t.units, axis=0)
        contexts += self.right.take(pair % t.units, axis=0)
        out = np.empty(len(which))
        with np.errstate(over="ignore"):
            # the sum over the classes belongs to the context: once for each one of the window
            total = np.empty(len(pair))
            for at in range(0, len(pair), 512):
                total[at:at + 512] = self._total(contexts[at:at + 512] @ self.q.T)
            for at in range(0, len(which), 4096):
                part = slice(at, at + 4096)
                out[part] = np.einsum("ij,ij->i", contexts.take(which[part], axis=0),
                                      self.q.take(cls[part], axis=0))
            out -= total[which]
            # the same of groups in their class, and of words in their group
            for base, first, target in ((t.groups_at, t.first_group, group),
                                        (t.words_at, t.first_word, row)):
                some = np.flatnonzero(target >= 0)
                # sorted by target, so by set; each target of a context once
                once, of = np.unique(target[some] * len(pair) + which[some], return_inverse=True)
                if len(some):
                    out[some] += self._shares(contexts, base, first, *np.divmod(once, len(pair)))[of]
        return out / math.log(10)

    def _shares(self, contexts, base: int, first, target, which) -> np.ndarray:
        """Log shares of sorted targets, each in its set of rows, after its context."""
        sets, starts = np.unique(np.searchsorted(first, target, side="right") - 1, return_index=True)
        ends, wide = np.append(starts[1:], len(target)), first[sets + 1] - first[sets]
        own = target - np.repeat(first[sets], ends - starts)
        lp = np.empty(len(target))
        # sets of one size that follow each other share their softmax
        cut = np.flatnonzero(np.diff(wide) | np.diff(starts // 1024)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(sets)]):
            at, end = starts[lo], ends[hi - 1]
            h = contexts.take(which[at:end], axis=0)
            s = np.empty((end - at, wide[lo]), dtype=h.dtype)
            for k, x, y in zip((base + first[sets[lo:hi]]).tolist(), (starts[lo:hi] - at).tolist(),
                               (ends[lo:hi] - at).tolist()):
                np.matmul(h[x:y], self.p[k:k + s.shape[1]].T, out=s[x:y])
            lp[at:end] = s[np.arange(end - at), own[at:end]] - self._total(s)
        return lp


def _scorer(shared):
    """Token rows ``row, at, doc_id, held_out`` -> tokens, those with a head word, their log10
    shares, score. ``shared``: a broadcast of the classes and counts of words, tree, parameters."""
    def run(batches):
        one_thread()
        of, count, tree, p = shared.value
        weight, trained = np.log10(count + 1.0), len(count) > 1 or count[-1]
        scores = Scores(tree, p)
        rest = np.log10(tree.group_mass[tree.rest])
        for batch in batches:
            for lo, hi, at, size in windows(batch, 1, SCORE_WINDOW):
                token = tree.rows(of, at, size)
                rare, starts = at < 0, np.cumsum(size) - size
                model = scores(*token)
                model[rare] -= rest[token[2][rare] - HEAD_CLASSES]
                logs = np.where(rare, 0, weight[np.maximum(at, 0)])
                head = np.add.reduceat(~rare, starts, dtype=np.int64) if trained else np.zeros_like(size)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(lo, hi - lo) for i in (0, 2, 3)],
                     pa.array(size, pa.int64()), pa.array(head, pa.int64()),
                     pa.array(np.add.reduceat(logs, starts)), pa.array(np.add.reduceat(model, starts))],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "logs", "model"])
    return run


def score(docs: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT, head: int = HEAD_WORDS,
          steps: int = STEPS) -> DataFrame:
    """Per document ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    d = documents_view(docs).select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"),
                                    "text")
    train = d.where(~F.col("held_out"))
    counts = written(token_table(train), "lm-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)),
                       F.coalesce(F.sum(F.when(F.col("token") == END_TOKEN, F.col("c"))), F.lit(0))
                       ).first()
    n, v, ends = (int(x) for x in total)
    words = head_words(counts, head)
    key = (tuple(words), tuple(words.values()), ends)
    known = Classes(words, ends)
    rows = written(token_rows(d, key).withColumn("row", F.monotonically_increasing_id()),
                   "lm-tokens")
    training = rows.where(~F.col("held_out"))
    grams = class_trigrams(training, known).toArrow()
    code = grams.column("code").to_numpy()
    order = np.argsort(code)
    model = LogBilinear().fit(code[order], grams.column("n").to_numpy()[order], steps)
    tree = Tree(known, class_sizes(counts, known))
    p, _ = train_words(training, known, tree, tree.start(known, model), n)

    shared = docs.sparkSession.sparkContext.broadcast((known.of, known.count, tree, p))
    scored = written(rows.select("row", "at", "doc_id", "held_out").transform(
        in_tasks, _scorer(shared), "row long, doc_id long, held_out boolean, n_tokens long, "
                                   "known long, logs double, model double"), "lm-scored")
    shared.destroy()
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("token"), F.col("x.times").alias("times"))
    met = rare.join(counts, "token").groupBy("row").agg(
        F.sum("times").alias("found"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"))
    zero = F.lit(0.0)
    return scored.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("found", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more", zero)
         - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
        (F.col("model") + F.coalesce("more", zero)).alias("score"))
