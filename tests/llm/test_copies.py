"""Near, substring and suffix dedup against brute force, and their edge cases."""

import random

import numpy as np
import pytest

from fraudmart.llm import hashing, near_dedup
from fraudmart.llm.queries import op4_near_dedup, op7_substring_dedup, op9_suffix_dedup
from fraudmart.llm.repeats import Windows
from fraudmart.llm.substring_dedup import repeated_words
from fraudmart.llm.suffix_dedup import once, repeated_bytes, suffix_array
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, kept boolean, cid long, row_key string"


def _rows(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text").collect()]


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, None, 1, "x") for d, t in rows], SCHEMA)


def _edits(seed, n_base=6, copies=40):
    """Groups of near copies with few and many edits, short texts, and shared passages."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
    rows, shared = [], [word() for _ in range(50)]
    for _ in range(n_base):
        base = [word() for _ in range(rnd.choice([4, 12, 40, 150, 400]))]
        for _ in range(rnd.randint(1, copies)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 12))):
                w[rnd.randrange(len(w))] = word()
            if rnd.random() < .3:
                at = rnd.randrange(len(w))
                w[at:at] = shared
            rows.append(" ".join(w).upper() if rnd.random() < .2 else " ".join(w))
    rows += ["", None, "  \n", "one", "One", "two words", "a\x00b c", "é ü ß " * 90, "ab" * 900]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("long", [64, 4])
def test_near_groups_match_all_pairs(spark, long):
    rows = _edits(1)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_dedup.near_groups(_frame(spark, rows), long=long).collect()}
    assert got == brute.near_groups(rows)


def test_near_query_matches_all_pairs(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in op4_near_dedup(spark, SMALL).collect()}
    want = brute.near_groups(_rows(spark, SMALL))
    assert got == {d: (n, c, d == c) for d, (n, c) in want.items()}


def test_substring_matches_brute_force(spark):
    rows = _edits(2)
    for width, gram in ((35, 8), (5, 3), (2, 2)):
        got = repeated_words(_frame(spark, rows), width, gram).select(
            "doc_id", "n_units", "n_removed", "kept_sha256").collect()
        assert sorted(map(tuple, got)) == sorted(brute.substring(rows, width))


def test_substring_query_matches_brute_force(spark):
    got = sorted(map(tuple, op7_substring_dedup(spark, SMALL).collect()))
    assert got == sorted(brute.substring(_rows(spark, SMALL), 35))


@pytest.mark.parametrize("hot,batch", [(2000, 1 << 20), (3, 1 << 12)])
def test_suffix_matches_brute_force(spark, hot, batch):
    rows = _edits(3)
    got = repeated_bytes(_frame(spark, rows), hot, batch).select(
        "doc_id", "n_units", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute.suffix(rows, 400))


def test_suffix_query_matches_brute_force(spark):
    got = sorted(map(tuple, op9_suffix_dedup(spark, SMALL).collect()))
    assert got == sorted(brute.suffix(_rows(spark, SMALL), 400))


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_orders_all_suffixes(seed):
    rnd = random.Random(seed)
    data = bytes(rnd.choice(b"ab" if seed % 2 else b"abc\x00\xff") for _ in range(700))
    if seed == 4:
        data = b"a" * 300
    text = np.frombuffer(data, dtype=np.uint8)
    got = suffix_array(text, len(data)).tolist()
    assert got == sorted(range(len(data)), key=lambda i: data[i:])


def test_strings_that_occur_once():
    found = once([b"abcabc", b"abcx"], [1, 1], 3)
    assert [f.tolist() for f in found] == [[1, 2], [1]]
    assert [f.tolist() for f in once([b"abcd"], [2], 3)] == [[]]


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    rnd = random.Random(5)
    text = b" ".join(b"w%d" % rnd.randrange(50) for _ in range(900)) + b" " + b"x" * 400 + b" end"
    whole = hashing.word_hashes([text])[0]
    runs = Windows(35, 8, hashing.word_hashes).runs(whole)
    monkeypatch.setattr(hashing, "BLOCK", 97)
    monkeypatch.setattr("fraudmart.llm.repeats.PART", 61)
    assert (hashing.word_hashes([text, b"", text])[2] == whole).all()
    for a, b in zip(Windows(35, 8, hashing.word_hashes).runs(whole), runs):
        assert (a == b).all()


def test_empty_tables_and_repeated_rows(spark):
    none = _frame(spark, [])
    assert near_dedup.near_groups(none).count() == 0
    assert repeated_words(none).count() == repeated_bytes(none).count() == 0
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, None), (None, "z")]
    got = sorted((str(r.doc_id), str(r.component_id), r.kept)
                 for r in near_dedup.near_groups(_frame(spark, rows)).collect())
    assert got == [("1", "1", True), ("1", "1", True), ("None", "1", False),
                   ("None", "None", True), ("None", "None", True)]
    frame = _frame(spark, rows)
    assert near_dedup.keep_one(frame).columns == frame.columns
    long = " ".join(f"w{i}" for i in range(60))
    got = repeated_words(_frame(spark, [(7, long), (7, long), (8, "w1 w2")])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(7, 60), (7, 60), (8, 0)]






def test_one_document_of_a_group_stays_whatever_its_ids(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base, f"x{i}"]) for i in range(3)]
    other = [" ".join([*(f"v{i}" for i in range(60)), f"y{i}"]) for i in range(3)]
    rows = [(None, t) for t in texts] + [(7, t) for t in other] + [(8, other[0]), (None, other[1])]
    rows += [(None, ""), (9, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    left = near_dedup.keep_one(frame, n=5, share=80).collect()
    assert sorted([r.doc_id for r in left], key=str) == [7, 9, None, None]
    assert sum(r.text in texts for r in left) == 1


def _twins(size=2048):
    """Two different words that every polynomial modulo 2**64 takes for one (Thue-Morse)."""
    bits = [bin(i).count("1") % 2 for i in range(size)]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


def test_words_of_equal_polynomials_stay_apart(spark):
    a, b = _twins()
    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(1, a), (2, b), (3, f"{a} {rest}"), (4, f"{b} {rest}")]
    df = _frame(spark, rows)
    near = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(df).collect()}
    assert near == {d: c for d, (_, c) in brute.near_groups(rows).items()}
    assert near[1] == 1 and near[2] == 2
    gone = {r["doc_id"]: r["n_removed"] for r in repeated_words(df).collect()}
    assert gone == {1: 0, 2: 0, 3: 0, 4: 0}


def test_links_are_confirmed_on_words():
    assert near_dedup.same_shingles(b"a b c d", b"B C d e", 3) == (2, 2, 1)
    assert near_dedup.same_shingles(b"a b", b"a b c", 3) == (1, 1, 0)
    assert near_dedup.same_shingles(b"x " * 50, b"x x x", 3) == (1, 1, 1)
    rnd = random.Random(2)
    for n in (1, 3, 5):
        x, y = ([rnd.choice("abc") for _ in range(rnd.randint(1, 60))] for _ in range(2))
        sets = [{tuple(w[i:i + min(n, len(w))]) for i in range(len(w) - min(n, len(w)) + 1)}
                for w in (x, y)]
        assert near_dedup.same_shingles(" ".join(x).encode(), " ".join(y).encode(), n) == (
            len(sets[0]), len(sets[1]), len(sets[0] & sets[1]))
