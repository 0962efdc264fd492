"""Token counts: a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the pieces that end at each character; the
dynamic programme keeps, per position, the best score and the number of pieces
of the best path, never the pieces. Tie rule of the tokenizers: a later start
replaces an earlier one only with a strictly better score, so of equal paths
the one whose last piece is longest wins. A character that no one-character
piece covers may be unknown, at the least piece score minus 10; with byte
fallback it counts as its UTF-8 bytes, without as one piece per unknown run.

The pieces and scores come from a SentencePiece model file (a path; the file's
bytes travel with the job). The public file here was made for merging; its
pieces and scores are read as a unigram vocabulary, whatever its type says.

Texts are cut where no piece can cross (``spm.segmenter``); sums over segments
are the sums over the text.

Defined results: NULL and empty texts have 0 tokens and score 0; texts of any
length are taken whole; repeated rows give repeated results; empty table, empty
result; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm import spm
from fraudmart.llm.shared import documents_view, in_tasks, kept, row_key

UNKNOWN_PENALTY = 10.0


class Counter:
    """Counts tokens of texts; ``count(text)`` is (tokens, best score)."""

    def __init__(self, data: bytes):
        import ahocorasick

        self.model = spm.parse(data)
        pieces = self.model.text_pieces()
        self.automaton = ahocorasick.Automaton()
        for _, piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, _, s in pieces) - UNKNOWN_PENALTY
        self.by_bytes = self.model.byte_fallback and len(self.model.byte_ids()) == 256
        self.cut = spm.segmenter(self.model)
        self.cache = spm.Cache()

    def viterbi(self, text: str) -> tuple[int, float]:
        """Over one segment."""
        n = len(text)
        if not n:
            return 0, 0.0
        # per end: score, pieces, and whether the path ends in an unknown character
        score, count, open_end = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0
        matches: list[tuple[int, float]] = []

        def close(end: int) -> None:
            """The best way to ``end``: matches come longest first, i.e. earliest start first."""
            best = None
            single = False
            for size, s in matches:
                value = score[end - size] + s
                if best is None or value > best:
                    best, score[end], count[end] = value, value, count[end - size] + 1
                single = single or size == 1
            if not single:
                value = score[end - 1] + self.unknown
                if best is None or value > best:
                    score[end] = value
                    more = (len(text[end - 1].encode()) if self.by_bytes
                            else 0 if open_end[end - 1] else 1)
                    count[end], open_end[end] = count[end - 1] + more, True

        for last, match in self.automaton.iter(text):
            while done < last:
                done += 1
                close(done)
                matches.clear()
            matches.append(match)
        while done < n:
            done += 1
            close(done)
            matches.clear()
        return count[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        segments = self.cut(spm.normalized(self.model, text))
        cache = self.cache
        for s in cache.missing(segments)[0]:
            cache[s] = self.viterbi(s)
        tokens, total = 0, 0.0
        for s in segments:
            t, v = cache[s]
            tokens += t
            total += v
        return tokens, total


@kept
@lru_cache(maxsize=2)
def counter(data: bytes) -> Counter:
    return Counter(data)


def read_model(path: str) -> bytes:
    """A tokenizer file (on the driver; jobs carry its bytes)."""
    with open(path, "rb") as f:
        return f.read()


def token_counts(docs: DataFrame, model_path: str = spm.DEFAULT_MODEL) -> DataFrame:
    """Per document ``doc_id, n_tokens, best_score, row_key``."""
    data = read_model(model_path)

    def run(batches):
        c = counter(data)
        for b in batches:
            got = [c.count(t) if t else (0, 0.0) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([g[1] for g in got], pa.float64()), b.column(1)],
                names=["doc_id", "n_tokens", "best_score", "row_key"])

    d = documents_view(docs).select(
        "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    return d.transform(in_tasks, run, "doc_id long, n_tokens long, best_score double, row_key long")
