"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model's protobuf is parsed (``spm``) and rebuilt as a tokenizer: normaliser
(character map, white space, prefix), metaspace marker, scores (unigram) or
merges in score order (merging models), and byte fallback. Segments of a batch
that were not seen before are encoded in one call, on the task's own thread: a thread
that the library starts for a call keeps memory until its worker ends.

Parity: each new segment is also encoded by the ``sentencepiece`` library. The ids
are always those of the rebuilt tokenizer; the document's ``n_differing`` counts
the segments where that library's differ. Decoding is the rebuilt tokenizer's
decoder too; ``round_trip`` tells whether all segments of a document decode to
themselves, which makes its normalised text (a segment ends with a whole character).

Defined results: NULL and empty texts have no ids and decode to the empty text;
texts of any length are encoded whole; repeated rows give repeated results;
empty table, empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm import spm
from fraudmart.llm.shared import documents_view, in_tasks, kept
from fraudmart.llm.token_counts import read_model


def merges(model: spm.Model) -> list[tuple[str, str]]:
    """Pairs that make a piece, best piece first; of one piece's pairs, by their ids."""
    ids = {p: i for i, p, _ in model.text_pieces()}
    out = []
    for i, p, score in model.text_pieces():
        cuts = [(p[:k], p[k:]) for k in range(1, len(p))]
        pairs = sorted((ids[a], ids[b], a, b) for a, b in cuts if a in ids and b in ids)
        out += [(-score, i, k, a, b) for k, (_, _, a, b) in enumerate(pairs)]
    return [(a, b) for *_, a, b in sorted(out)]


def build(data: bytes, whole: bool = True):
    """The model as a ``tokenizers.Tokenizer``: of whole texts, or of segments of
    a normalised text (no normaliser)."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    m = spm.parse(data)
    if m.model_type == spm.UNIGRAM:
        core = models.Unigram(list(zip(m.pieces, map(float, m.scores))), m.unk_id, m.byte_fallback)
    else:
        core = models.BPE(vocab={p: i for i, p in enumerate(m.pieces)}, merges=merges(m),
                          unk_token=m.pieces[m.unk_id], fuse_unk=True,
                          byte_fallback=m.byte_fallback)
    t = Tokenizer(core)
    if whole:
        steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
        if m.remove_extra_whitespaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if m.add_dummy_prefix:
            steps.append(normalizers.Prepend(spm.SPACE))
        t.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", spm.SPACE)])
    back = [decoders.Replace(spm.SPACE, " ")]
    if m.byte_fallback:
        back.append(decoders.ByteFallback())
    back.append(decoders.Fuse())
    if whole and m.add_dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    t.decoder = decoders.Sequence(back)
    return t


class Codec:
    def __init__(self, data: bytes):
        import sentencepiece

        self.model = spm.parse(data)
        self.tokenizer = build(data, whole=False)
        self.check = sentencepiece.SentencePieceProcessor(
            model_proto=spm.without_normalizer(data))
        self.cut = spm.segmenter(self.model)
        self.cache = spm.Cache()
        self.differing: set[str] = set()
        #: segments that do not decode to themselves
        self.lost: set[str] = set()
        self.control = {i for i, k in enumerate(self.model.kinds) if k == spm.CONTROL}

    def learn(self, segments) -> None:
        """Encodes segments not seen before, as one batch, by both libraries."""
        cache = self.cache
        new, turned = cache.missing(segments)
        if turned:
            self.differing = {s for s in self.differing if s in cache}
            self.lost = {s for s in self.lost if s in cache}
        if not new:
            return
        got = [g.ids for g in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        want = self.check.encode(new, num_threads=1)
        if got != want:
            self.differing.update(s for s, a, b in zip(new, got, want) if a != b)
        back = self.tokenizer.decode_batch(got, skip_special_tokens=False)
        plain = [s.replace(spm.SPACE, " ") for s in new]
        if back != plain:
            self.lost.update(s for s, a, b in zip(new, back, plain) if a != b)
        flat = array("i", chain.from_iterable(got)).tobytes()
        ends = list(accumulate(map(len, got)))
        young, at = cache.young, 0
        for s, end in zip(new, ends):
            young[s] = flat[at:4 * end]
            at = 4 * end

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, bool, int]]:
        """Per text: ids, does it decode to the normalised text, differing segments."""
        norm = [spm.normalized(self.model, t) if t else "" for t in texts]
        cut = [self.cut(t) for t in norm]
        self.learn(s for segments in cut for s in segments)
        get, out = self.cache.young.__getitem__, []
        for segments in cut:
            ids = np.frombuffer(b"".join(map(get, segments)), dtype=np.int32)
            bad = sum(map(self.differing.__contains__, segments)) if self.differing else 0
            out.append((ids, not self.lost or self.lost.isdisjoint(segments), bad))
        return out

    def decode(self, ids: list[int]) -> str:
        text = self.tokenizer.decode([i for i in ids if i not in self.control],
                                     skip_special_tokens=False)
        return text[1:] if self.model.add_dummy_prefix and text[:1] == " " else text


@kept
@lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    return Codec(data)


def _pieces(batch, size: int = 1 << 20):
    """Rows of a batch in runs of about ``size`` characters."""
    texts, held, at = [], 0, 0
    column = batch.column(1)
    for i in range(batch.num_rows):
        texts.append(column[i].as_py())
        held += len(texts[-1] or "")
        if held >= size:
            yield at, texts
            texts, held, at = [], 0, i + 1
    if texts:
        yield at, texts


def _one_thread() -> None:
    """The ``tokenizers`` library reads this at each call: as many threads as the machine has
    cores otherwise, in each of its workers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def _encoder(data: bytes):
    def run(batches):
        _one_thread()
        c = codec(data)
        for b in batches:
            for at, texts in _pieces(b):
                got = c.encode(texts)
                sizes = [len(g[0]) for g in got]
                ends = np.cumsum([0] + sizes).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.int32), *[g[0] for g in got]])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(flat)),
                     pa.array([g[1] for g in got], pa.bool_()),
                     pa.array([g[2] for g in got], pa.int64())],
                    names=["doc_id", "n_tokens", "ids", "round_trip", "n_differing"])
    return run


def encode(docs: DataFrame, model_path: str = spm.DEFAULT_MODEL) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids, round_trip, n_differing``."""
    return documents_view(docs).transform(in_tasks,
        _encoder(read_model(model_path)), "doc_id long, n_tokens long, ids array<int>, round_trip boolean, n_differing long")


def decode(encoded: DataFrame, model_path: str = spm.DEFAULT_MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; NULL ids decode to the empty text."""
    data = read_model(model_path)

    def run(batches):
        _one_thread()
        c = codec(data)
        for b in batches:
            texts = [c.decode([i for i in ids or () if i is not None])
                     for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").transform(in_tasks,
        run, "doc_id long, text string")
