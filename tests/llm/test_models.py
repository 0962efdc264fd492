"""Language ID, LM scoring, token counts and the SentencePiece codec."""

import base64
import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest

from fraudmart.llm import language_id, lm_scoring, sentencepiece_codec, spm, token_counts
from fraudmart.llm.queries import (language_id_pages, op1_language_id, op2_lm_scoring,
                                   op3_token_counts, op8_sentencepiece)
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, host string, kept string, p double"
ODD = ["", None, " ", "a", "  two  spaces ", "line\n\nfeeds\t x", "日本語 ☃🙂 é", "<s> <0x0A> <unk>",
       " " * 37 + "z", "x" * 3000, "▁▁q", "\x00 nul"]


@pytest.fixture(scope="module")
def data():
    return token_counts.read_model(spm.DEFAULT_MODEL)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, lang, s, "h", "k", 0.5) for d, t, lang, s in rows], SCHEMA)


# --- language ------------------------------------------------------------------------

def test_documents_and_pages_get_their_language(spark):
    got = op1_language_id(spark, SMALL).collect()
    assert len(got) == 200 and all(r.kept and r.lang == r.declared for r in got)
    pages = language_id_pages(spark, SMALL).collect()
    assert len(pages) == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert sum(r.lang == r.declared for r in pages) >= .95 * len(pages)


def test_held_out_accuracy_without_declarations(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    train = _frame(spark, [(r.doc_id, r.text, r.lang, r.source) for r in docs if r.doc_id % 2])
    test = _frame(spark, [(r.doc_id, r.text, None, None) for r in docs if r.doc_id % 2 == 0])
    model = language_id.train_text_model(train)
    got = language_id.identify(language_id.document_rows(test), model).collect()
    right = {r.doc_id: r.lang for r in docs}
    assert sum(r.lang == right[r.id] for r in got) >= .95 * len(got)


def test_evidence_other_than_text_decides_short_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    model = language_id.train_text_model(_frame(
        spark, [(r.doc_id, r.text, r.lang, r.source) for r in docs]))
    rows = [(r.doc_id, "x", "x.fr", "x.fr", "fr", r.text) for r in docs if r.lang == "fr"]
    rows += [(r.doc_id, "y", "y.com", "y.com", "en", r.text) for r in docs if r.lang == "en"]
    rows += [(10_000, "x", "x.fr", "x.fr", None, "zq"), (10_001, "y", "y.com", "y.com", None, "zq"),
             (10_002, None, None, None, "fr", "zq")]
    frame = spark.createDataFrame(
        [(i, i, dec, h and h.split(".")[-1], dom, h, t) for i, _, dom, h, dec, t in rows],
        "id long, row_key long, declared string, suffix string, domain string, host string, text string")
    got = {r.id: r.lang for r in language_id.identify(frame, model).collect()}
    assert (got[10_000], got[10_001], got[10_002]) == ("fr", "en", "fr")


def test_noise_and_languages_that_were_not_trained_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    rnd = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    odd = ["".join(rnd.choice(letters) for _ in range(400)),
           " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(60)),
           base64.b64encode(rnd.randbytes(300)).decode(),
           "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом",
           "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
           "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel",
           "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni"]
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs]
    extra = [(10 ** 6 + i, t, None, None) for i, t in enumerate(odd)]
    got = language_id.identify_documents(_frame(spark, rows + extra)).collect()
    assert [r.doc_id for r in got if not r.kept] and {r.doc_id for r in got if not r.kept} == {
        d for d, *_ in extra}
    # two rows make a language of their own, and take nothing from the others
    few = [(2 * 10 ** 6 + i, t, "hu", None) for i, t in enumerate([odd[5], odd[5] + " " + odd[5][:40]])]
    got = {r.doc_id: r for r in language_id.identify_documents(_frame(spark, rows + few)).collect()}
    assert all(got[d].lang == "hu" and got[d].kept for d, *_ in few)
    assert sum(got[d].lang == lang for d, _, lang, _ in rows) >= .99 * len(rows)


def test_language_edge_cases(spark):
    rows = [(1, None, "en", "s"), (2, "", None, None), (3, "123 !!", "en", "s"),
            (None, "the of and to in is", "en", "s"), (4, "the of", "zz", None)]
    rows += [(i, "the of and to in is that for", "en-GB", "s") for i in range(10, 20)]
    frame = _frame(spark, rows)
    got = {r.doc_id: (r.lang, r.kept) for r in language_id.identify_documents(frame).collect()}
    assert not got[1][1] and not got[2][1] and not got[3][1]
    assert got[None] == ("en", True) and got[10] == ("en", True) and got[4] == ("en", True)
    kept = language_id.keep_identified(frame)
    assert kept.columns == frame.columns and kept.count() == 12
    assert language_id.keep_identified(frame, accepted=["fr"]).count() == 0
    assert language_id.identify_documents(frame.limit(0)).count() == 0
    blank = _frame(spark, [(1, "some text", None, None)])
    assert [(r.lang, r.kept) for r in language_id.identify_documents(blank).collect()] == [(None, False)]


# --- language model ------------------------------------------------------------------

def _same(got, want):
    assert len(got) == len(want)
    for r in got:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)


def test_scores_match_counts_and_beat_the_base(spark, texts):
    got = op2_lm_scoring(spark, SMALL).collect()
    _same(got, brute.scores(texts))
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_do_not_depend_on_what_travels_with_tasks(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    few = lm_scoring.score(frame, head=300, steps=20).collect()
    _same(few, brute.scores(texts))


def test_model_is_normalised_and_learns():
    rnd = np.random.default_rng(1)
    code = np.unique(rnd.integers(0, 50, 3000) * lm_scoring.CLASSES ** 2
                     + rnd.integers(0, 50, 3000) * lm_scoring.CLASSES + 3)
    model = lm_scoring.LogBilinear().fit(code, np.ones(len(code)), steps=200)
    p = np.exp(model.log_probs())
    assert np.allclose(p.sum(axis=1), 1) and p[:, 3].mean() > .9
    assert (p[:, lm_scoring.START] == 0).all()


def test_word_probabilities_sum_to_one(spark, texts):
    """Class probability times shares, over all training words and a new one per class."""
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    counts = lm_scoring.token_table(frame)
    words = lm_scoring.head_words(counts)
    ends = len(texts)
    known = lm_scoring.Classes(words, ends)
    z = 10 ** lm_scoring.class_sizes(counts, known)
    share = {}
    for r in counts.collect():
        if r.token:
            i = known.index[r.token.encode()]
            k = int(known.of[i])
            share[k] = share.get(k, 0) + ((r.c + 1) / z[k] if k >= lm_scoring.HEAD_CLASSES else 1)
    for k, s in share.items():
        assert math.isclose(s + (1 / z[k] if k >= lm_scoring.HEAD_CLASSES else 0), 1, rel_tol=1e-9)


def test_words_past_the_head_classes_have_contexts_of_their_own(spark):
    """Pairs of words of one tail class that always follow each other."""
    pairs = [(f"p{i:03d}xx", f"q{i:03d}yy") for i in range(100)]
    rnd = random.Random(5)
    rows = [(d, " ".join(w for _ in range(200) for w in rnd.choice(pairs))) for d in range(600)]
    right, wrong = f"{pairs[90][0]} {pairs[90][1]}", f"{pairs[90][0]} {pairs[60][1]}"
    held = [d for d in range(10_000, 10_100) if lm_scoring.crc32(str(d).encode()) % 7 == 2][:2]
    rows += [(held[0], right), (held[1], wrong)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_scoring.score(frame, steps=50).collect()}
    assert got[held[0]] > got[held[1]] + .3


def test_training_takes_every_token_and_stays_normalised(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    counts = lm_scoring.token_table(frame)
    words = lm_scoring.head_words(counts, 2000)
    key = (tuple(words), tuple(words.values()), len(texts))
    known = lm_scoring.Classes(words, len(texts))
    tree = lm_scoring.Tree(known, lm_scoring.class_sizes(counts, known))
    start = tree.start(known, lm_scoring.LogBilinear())
    n = sum(r.c for r in counts.collect())
    rows = lm_scoring.token_rows(frame.withColumn("held_out", lm_scoring.F.lit(False)), key)
    p, trained = lm_scoring.train_words(rows, known, tree, start, n)
    assert trained == n
    moved = np.abs(p - start)[:, :-1].max(axis=1) > 0
    assert moved[tree.words_at:tree.classes_at].mean() > .9 and moved[:tree.n].mean() > .9
    # all targets after one context: head classes and the end, words, rarer words of each class
    cls = [*range(lm_scoring.HEAD_CLASSES), lm_scoring.END]
    targets = [(c, -1, -1) for c in cls]
    targets += [(int(known.of[i]), int(tree.group[i]), int(tree.row[i]))
                for i in range(lm_scoring.HEAD_CLASSES, tree.n)]
    targets += [(lm_scoring.HEAD_CLASSES + k, int(g), -1) for k, g in enumerate(tree.rest)]
    c, g, r = np.array(targets).T
    scores = lm_scoring.Scores(tree, p)
    for a, b in ((3, 500), (tree.units - 1, tree.units - 1), (1500, tree.n)):
        lp = scores(np.full(len(c), a), np.full(len(c), b), c, g, r)
        assert math.isclose((10 ** lp).sum(), 1, rel_tol=1e-4)


def test_scores_belong_to_the_rows_not_to_their_partitions(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id long, text string").select("text", "doc_id")
    few, many = (sorted((r.doc_id, r.score) for r in lm_scoring.score(frame.repartition(n), steps=50)
                        .collect()) for n in (1, 7))
    assert [d for d, _ in few] == [d for d, _ in many]
    # what differs is the rounding of single precision in products of other sizes
    assert all(math.isclose(a, b, rel_tol=1e-5) for (_, a), (_, b) in zip(few, many))


def test_copies_of_parameters_follow_the_tokens_not_the_partitions(spark, texts, monkeypatch):
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(lm_scoring, "TASK_TOKENS", 4_000)
    original = type(frame).repartition

    def run(least):
        monkeypatch.setattr(type(frame), "repartition", lambda self, n, *c: original(
            self, max(n, least) if c and isinstance(n, int) else n, *c))
        return sorted((r.doc_id, r.score) for r in lm_scoring.score(frame, steps=20).collect())

    few, many = run(1), run(40)
    assert [d for d, _ in few] == [d for d, _ in many]
    assert all(math.isclose(a, b, rel_tol=1e-5) for (_, a), (_, b) in zip(few, many))


def test_windows_of_a_dealer_do_not_depend_on_batches():
    rnd = np.random.default_rng(3)
    dealer, size = np.repeat([2, 5], [30, 11]), rnd.integers(1, 40, 41)
    at = lm_scoring.pa.ListArray.from_arrays(np.cumsum([0, *size]).astype(np.int32),
                                             np.arange(size.sum(), dtype=np.int32))
    batch = lm_scoring.pa.RecordBatch.from_arrays(
        [lm_scoring.pa.array(dealer, "int32"), lm_scoring.pa.array(range(41), "int64"), at],
        names=["dealer", "dealt_by", "at"])
    got = [[(d, a.tolist(), s.tolist()) for d, a, s in lm_scoring.dealt_windows(
        [batch.slice(i, n) for i in range(0, 41, n)], 100)] for n in (41, 7)]
    assert got[0] == got[1]
    assert sum((a for _, a, _ in got[0]), []) == list(range(size.sum()))
    assert all(sum(s) <= 100 for _, _, s in got[0]) and {d for d, *_ in got[0]} == {2, 5}


def test_words_and_rows_are_taken_from_many_texts_at_once(spark, monkeypatch):
    """White space at the ends, other control characters, blocks of a long text."""
    rnd = random.Random(4)
    gaps = [" ", "\t", "\n\n", "\x0b", "\x0c\r", "\x1c", "\x1f", "\x85", "\u00a0", "\u2003"]
    rows = [(i, "".join(rnd.choice(["Ab", "c", "\u00c4D", "rare%d" % rnd.randrange(40)]) + rnd.choice(gaps)
                        for _ in range(rnd.randrange(30)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \t "), (303, "  Ab c \n"), (304, "c Ab  " * 500)]
    monkeypatch.setattr(lm_scoring, "SLICE", 700)
    monkeypatch.setattr("fraudmart.llm.hashing.BLOCK", 512)
    want = {i: brute.words(t, True) for i, t in rows}
    counts = {"": len(rows)}
    for ws in want.values():
        for w in ws:
            counts[w.decode()] = counts.get(w.decode(), 0) + 1
    head = dict(sorted(((w, n) for w, n in counts.items() if w), key=lambda x: (-x[1], x[0]))[:90])
    known = lm_scoring.Classes(head, len(rows))
    # in this process, where the sizes above hold
    text = lm_scoring.pa.array([t for _, t in rows], lm_scoring.pa.string())
    seen, done = {}, 0
    for lo, hi, part in lm_scoring.text_slices(text):
        assert lo == done and len(part) == hi - lo or hi == lo + 1
        words, size = lm_scoring.words_of(part)
        at, places, rarer = known.heads(words)
        got = [w.encode() for w in words.to_pylist()]
        assert got == sum((want[i] for i in range(lo, hi)), []) and size.sum() == len(got)
        assert at.tolist() == [known.index.get(w, lm_scoring.HEAD_CLASSES - 1 - lm_scoring.tail_class(w))
                               for w in got]
        assert [got[i] for i in places] == [w.encode() for w in rarer.to_pylist()]
        done = hi
    assert done == len(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.token: r.c for r in lm_scoring.token_table(frame, flush=20).collect()} == counts
    key = (tuple(head), tuple(head.values()), len(rows))
    docs = frame.withColumn("held_out", lm_scoring.F.lit(False))
    for r in lm_scoring.token_rows(docs, key).collect():
        ws = want[r.doc_id]
        assert r["at"][:-1] == [known.index.get(w, lm_scoring.HEAD_CLASSES - 1 - lm_scoring.tail_class(w))
                                for w in ws] and r["at"][-1] == known.end
        rare = [w.decode() for w in ws if w not in known.index]
        assert dict(zip(r.rare, r.times)) == {w: rare.count(w) for w in rare}
        assert len(r.rare) == len(set(rare))


def test_copies_of_a_block_are_averaged_by_how_often_rows_were_trained():
    d, rnd = 3, np.random.default_rng(2)
    copies = {(b, t): (b * lm_scoring.COPY_ROWS + np.flatnonzero(rnd.random(50) < .5), t + 1)
              for b in (0, 2) for t in range(3)}
    batches = [lm_scoring._block(b, t, rows, np.full(len(rows), n), np.full((len(rows), d), float(t)))
               for (b, t), (rows, n) in copies.items()]
    got = {}
    for out in lm_scoring._averaged(batches):
        rows, n, v = lm_scoring._rows(*(out.column(i)[0].as_py() for i in (2, 3, 4)))
        got.update({r: (c, x.tolist()) for r, c, x in zip(rows.tolist(), n.tolist(), v)})
    for r in {int(x) for rows, _ in copies.values() for x in rows}:
        met = [(t, n) for (_, t), (rows, n) in copies.items() if r in rows]
        total = sum(n for _, n in met)
        assert got.pop(r) == (total, pytest.approx([sum(t * n for t, n in met) / total] * d))
    assert not got


def test_scores_match_a_plain_second_computation(spark, texts, monkeypatch):
    """Softmax by softmax, token by token, from the trained parameters."""
    kept = {}

    def train(rows, known, tree, start, n, **more):
        got = original(rows, known, tree, start, n, **more)
        kept.update(known=known, tree=tree, p=got[0].astype(float))
        return got

    original = lm_scoring.train_words
    monkeypatch.setattr(lm_scoring, "train_words", train)
    some = texts[:40]
    frame = spark.createDataFrame(some, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_scoring.score(frame, head=400, steps=20).collect()}
    counts = {}
    for d, t in some:
        if lm_scoring.crc32(str(d).encode()) % 7 != 2:
            for w in brute.words(t, True):
                counts[w] = counts.get(w, 0) + 1
    t, p, known = kept["tree"], kept["p"], kept["known"]
    d = p.shape[1] - 1
    c = p[t.matrices_at:].reshape(2, d, d + 1)[:, :, :d]

    def unit(w):
        i = known.index.get(w)
        return i if i is not None else t.n + lm_scoring.tail_class(w) - lm_scoring.HEAD_CLASSES

    def log_share(h, rows, target):
        s = p[rows, :d] @ h + p[rows, d]
        return float(s[target] - s.max() - math.log(np.exp(s - s.max()).sum()))

    for doc, text in some:
        ws, total = brute.words(text, True), 0.0
        prev = [t.units - 1, t.units - 1]
        for w in [*ws, None]:
            h = p[prev[0], :d] @ c[0] + p[prev[1], :d] @ c[1]
            k = lm_scoring.END if w is None else (
                int(known.of[known.index[w]]) if w in known.index else lm_scoring.tail_class(w))
            classes = np.arange(t.classes_at, t.matrices_at - 1)   # without the start
            total += log_share(h, classes, k)
            if w is not None and k >= lm_scoring.HEAD_CLASSES:
                i, j = known.index.get(w), k - lm_scoring.HEAD_CLASSES
                group = int(t.rest[j] if i is None else t.group[i])
                groups = np.arange(t.first_group[j], t.first_group[j + 1])
                total += log_share(h, t.groups_at + groups, group - t.first_group[j])
                if i is None:
                    total += math.log((counts.get(w, 0) + 1) / t.group_mass[t.rest[j]])
                else:
                    words = np.arange(t.first_word[group], t.first_word[group + 1])
                    total += log_share(h, t.words_at + words, int(t.row[i]) - t.first_word[group])
            if w is not None:
                prev = [prev[1], unit(w)]
        assert math.isclose(got[doc], total / math.log(10), rel_tol=1e-4, abs_tol=1e-3)


def test_parameters_leave_the_disk_when_their_round_is_over(spark):
    def held():
        folder = spark.sparkContext._temp_dir
        return sum(e.stat().st_size for e in os.scandir(folder) if e.is_file())

    words = [f"word{i:05d}" for i in range(20_000)]
    frame = spark.createDataFrame([(i, " ".join(words[i::20])) for i in range(20)] * 2,
                                  "doc_id long, text string")
    before = held()
    got = lm_scoring.score(frame, steps=5).collect()
    assert len(got) == 40 and all(r.n_tokens == 1001 for r in got)
    # two vectors of 25 single precision numbers for each trained word are over three megabytes
    assert held() - before < 1_000_000


def test_lm_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "A b"), (3, "a\x0bB\x1fc"), (3, "a\x0bB\x1fc")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm_scoring.score(frame, steps=5).collect()
    assert len(got) == 5
    by = {r.doc_id: r for r in got}
    assert by[1].n_tokens == by[2].n_tokens == 1 and by[3].n_tokens == 3 and by[None].n_tokens == 3
    assert lm_scoring.score(frame.limit(0), steps=5).count() == 0
    only_held = spark.createDataFrame([(d, "x y") for d in range(60)], "doc_id long, text string").where(
        lm_scoring.held_out(lm_scoring.F.col("doc_id")))
    r = lm_scoring.score(only_held, steps=5).first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score < 0


# --- tokens --------------------------------------------------------------------------

def _unigram(data):
    """The pieces as a unigram tokenizer of the ``tokenizers`` library (pieces that no
    text can match renamed)."""
    from tokenizers import Tokenizer, models
    m = spm.parse(data)
    names = [p if k in (spm.NORMAL, spm.USER_DEFINED, spm.UNUSED, spm.BYTE) else f"\x00{i}"
             for i, (p, k) in enumerate(zip(m.pieces, m.kinds))]
    return Tokenizer(models.Unigram(list(zip(names, m.scores)), m.unk_id, True))


def test_counts_equal_the_tokenizers_on_whole_texts(spark, texts, data):
    m, ref = spm.parse(data), _unigram(data)
    want = {d: len(ref.encode(spm.normalized(m, t or "")).ids) for d, t in texts}
    assert {r.doc_id: r.n_tokens for r in op3_token_counts(spark, SMALL).collect()} == want
    c = token_counts.Counter(data)
    for t in ODD:
        if t and "<0x0A>" not in t:  # that library also matches the names of byte pieces
            assert c.count(t)[0] == len(ref.encode(spm.normalized(m, t)).ids), t


def _proto(pieces, model_type=1, byte_fallback=False):
    import struct
    body = b""
    for p, s, k in pieces:
        raw = p.encode()
        piece = bytes([10, len(raw)]) + raw + b"\x15" + struct.pack("<f", s) + bytes([24, k])
        body += bytes([10, len(piece)]) + piece
    trainer = bytes([3 << 3, model_type]) + b"\x98\x02" + bytes([byte_fallback])
    return body + bytes([18, len(trainer)]) + trainer


def test_viterbi_takes_the_best_path_and_the_longest_last_piece_of_ties():
    rnd = random.Random(3)
    letters = "abc"
    for _ in range(40):
        words = {rnd.choice(letters) for _ in range(2)} | {
            "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 4))) for _ in range(6)}
        table = {w: -float(rnd.randint(1, 4)) for w in words}
        c = token_counts.Counter(_proto([("<unk>", 0, 2)] + [(w, s, 1) for w, s in table.items()]))
        unknown = min(table.values()) - 10
        text = "".join(rnd.choice(letters + "é") for _ in range(12))

        # brute force over all ends, starts ascending, strictly better replaces
        best = [(0.0, 0, False)]
        for end in range(1, len(text) + 1):
            found = None
            for start in range(end):
                score, n, open_end = best[start]
                piece = text[start:end]
                options = [(table[piece], 1, False)] if piece in table else []
                if end - start == 1 and piece not in table:
                    options.append((unknown, 0 if open_end else 1, True))
                for s, more, o in options:
                    if found is None or score + s > found[0]:
                        found = (score + s, n + more, o)
            best.append(found)
        assert c.viterbi(text) == (best[-1][1], best[-1][0])


def test_cache_is_emptied_but_counts_stay(texts, data):
    c, small = token_counts.Counter(data), token_counts.Counter(data)
    small.cache.limit = 500
    for _, t in texts[:20]:
        assert c.count(t) == small.count(t)
    codec, tight = sentencepiece_codec.Codec(data), sentencepiece_codec.Codec(data)
    tight.cache.limit = 500
    for i in range(0, 20, 4):
        some = [t for _, t in texts[i:i + 4]]
        for a, b in zip(codec.encode(some), tight.encode(some)):
            assert (a[0] == b[0]).all() and a[1:] == b[1:]


def test_codec_equals_the_library_on_whole_texts(spark, texts, data):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    got = {r.doc_id: r for r in op8_sentencepiece(spark, SMALL).collect()}
    for d, t in texts:
        assert got[d].ids == sp.encode(t) and got[d].round_trip and got[d].n_tokens == len(got[d].ids)
    c = sentencepiece_codec.Codec(data)
    whole = sentencepiece_codec.build(data)
    for t, (ids, back, bad) in zip(ODD, c.encode(ODD)):
        ids = ids.tolist()
        assert ids == sp.encode(t or "") and back and not bad
        assert ids == whole.encode(t or "", add_special_tokens=False).ids
        assert c.decode(ids) == sp.decode(ids)
        if t and spm.SPACE not in t:
            assert c.decode(ids) == t


def test_encoding_starts_no_threads_in_a_worker():
    code = """if True:
        import os
        import pyarrow as pa
        from fraudmart.llm import sentencepiece_codec as s, spm
        from fraudmart.llm.token_counts import read_model
        s.codec(read_model(spm.DEFAULT_MODEL))
        frame = pa.RecordBatch.from_arrays([pa.array(range(64)), pa.array(
            [f"some words {i} of text{i}" for i in range(64)])], names=["doc_id", "text"])
        threads = len(os.listdir("/proc/self/task"))
        assert sum(b.num_rows for b in s._encoder(read_model(spm.DEFAULT_MODEL))([frame])) == 64
        print(len(os.listdir("/proc/self/task")) - threads)"""
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True,
                          cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__))))
    assert done.stdout.strip() == "0", done.stderr


def test_ids_are_those_of_the_rebuilt_tokenizer(data):
    """Where the libraries differ, the difference is counted and not put in its place."""
    c = sentencepiece_codec.Codec(data)
    want = c.encode(["some words here"])[0][0].tolist()

    class Other:
        def encode(self, segments, num_threads=1):
            return [[0] for _ in segments]

    d = sentencepiece_codec.Codec(data)
    d.check = Other()
    ids, back, bad = d.encode(["some words here"])[0]
    assert ids.tolist() == want and back and bad > 0


def test_decode_reverses_encode(spark):
    rows = [(i, t) for i, t in enumerate(ODD) if t is None or spm.SPACE not in t]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(frame))
    assert {r.doc_id: r.text for r in back.collect()} == {d: t or "" for d, t in rows}
    assert sentencepiece_codec.encode(frame.limit(0)).count() == 0
    assert token_counts.token_counts(frame.limit(0)).count() == 0


def test_unigram_model_files(data):
    """A unigram file: rebuilt tokenizer, library and codec agree; byte fallback on and off."""
    import sentencepiece
    for fallback in (False, True):
        rnd = random.Random(7)
        pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)]
        pieces += [(f"<0x{b:02X}>", 0, 6) for b in range(256)] if fallback else []
        letters = [chr(97 + i) for i in range(8)] + [spm.SPACE]
        words = sorted({"".join(rnd.choice(letters[:8]) for _ in range(rnd.randint(2, 4)))
                        for _ in range(60)})
        pieces += [(w, -rnd.uniform(2, 9), 1) for w in [*letters, *words]]
        proto = _proto(pieces, 1, fallback)
        m = spm.parse(proto)
        assert m.model_type == spm.UNIGRAM and m.byte_fallback == fallback
        c = sentencepiece_codec.Codec(proto)
        whole = sentencepiece_codec.build(proto)
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        counter = token_counts.Counter(proto)
        for _ in range(30):
            t = "".join(rnd.choice("abcdefgh  ") for _ in range(60)) + (" é" if fallback else "")
            ids = c.encode([t])[0][0].tolist()
            assert ids == sp.encode(t) == whole.encode(t, add_special_tokens=False).ids
            assert counter.count(t)[0] == len(ids)
