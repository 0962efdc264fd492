"""Very long texts, clashing columns, thousands of declared languages, long conversations."""

import random

import duckdb
import pandas as pd
import pyarrow as pa
import pytest

import corpus_pipeline
from fraudmart.llm import (chat, decontam, exact_dedup, language_id, lm_scoring, queries,
                           sentencepiece_codec, token_counts)
from fraudmart.llm.shared import in_tasks
from tools.oracle_check import bag

LONG = "one long line of words that goes on " * 120_000   # over four million characters


def _named(spark, rows, *clashing):
    """Documents with further columns whose names operators use themselves."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr("*", *[f"'x' AS {c}" for c in clashing])


def test_a_long_conversation_is_several_rows_in_sql_too(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(9000)]
    rows += [(2, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(4096)]   # a prefix
    rows += [(3, i, "user", f"other {i}") for i in range(4096)] + [(4, 0, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(frame)
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
                 .astype({"conv_id": "int64", "turn": "int64"}))
    rel = con.sql(queries.OP5_SQL)
    order = sorted(rel.columns)
    assert sorted(got.columns) == order
    rows = [tuple(r) for r in got.collect()]
    assert bag(rows, got.columns, order) == bag(rel.fetchall(), rel.columns, order)
    assert sorted((r[0], r[1]) for r in (tuple(x) for x in rows)) == [
        (1, 0), (1, 1), (1, 2), (3, 0), (4, 0)]


def test_thousands_of_declared_languages_share_one_class(spark):
    rnd = random.Random(1)
    common = {"en": "the quick brown fox jumps over the lazy dog again and again ",
              "de": "der schnelle braune fuchs springt wieder über den faulen hund "}
    tag = lambda i: "".join("abcdefghij"[int(c)] for c in f"{i:04d}")
    rows = [(x, t * rnd.randint(1, 3)) for x, t in common.items() for _ in range(200)]
    rows += [("x" + tag(i), "zq vxw kjq wvz " * 5) for i in range(5000) for _ in range(2)]
    train = spark.createDataFrame(rows, "lang string, text string")
    model = language_id.train_text_model(train)
    assert len(model.langs) == language_id.MOST_LANGS + 1 and {"en", "de", "und"} <= set(model.langs)
    assert model.logp.nbytes < 40_000_000   # whatever is declared
    few = language_id.train_text_model(train, most=2)
    assert few.langs == ["de", "en", "und"]


def test_very_long_texts(spark):
    rows = [(1, LONG), (2, LONG), (3, "short text of one two three four words"), (9, LONG + "end")]
    docs = _named(spark, rows)
    kept = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(docs).collect()}
    assert kept == {1: (2, 2), 2: (2, 2), 3: (3, 1), 9: (9, 1)}
    item = spark.createDataFrame([(7, "words that goes on one long line of words")],
                                 "item_id long, text string")
    leaks = {r.doc_id for r in decontam.contaminated(docs, item).collect()}
    assert leaks == {1, 2, 9}
    train = docs.selectExpr("'en' AS lang", "text")
    model = language_id.train_text_model(train)
    assert model.langs == ["en"] and model.evidence(LONG)[1]
    got = {r.doc_id: r.n_tokens for r in lm_scoring.score(docs, steps=5).collect()}
    assert got == {1: 960_001, 2: 960_001, 3: 9, 9: 960_002}


@pytest.mark.parametrize("run, clashing", [
    (lambda d: lm_scoring.score(d, steps=5), ("held_out", "row", "at", "token", "c", "score")),
    (token_counts.token_counts, ("n_tokens", "row_key", "best_score")),
    (sentencepiece_codec.encode, ("ids", "n_tokens", "round_trip")),
])
def test_clashing_columns_change_nothing(spark, run, clashing):
    rows = [(1, "some words here"), (2, None), (None, ""), (3, "some more words"), (3, "some more words")]
    plain = run(_named(spark, rows))
    named = run(_named(spark, rows, *clashing))
    assert plain.columns == named.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, named.collect()))


def test_a_worker_keeps_nothing_for_another_operator(spark):
    """Spark hands its Python workers on: neither codecs nor their caches go along."""
    def kept(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([sentencepiece_codec.codec.cache_info().currsize
                           + token_counts.counter.cache_info().currsize])], names=["n"])

    docs = spark.createDataFrame([(i, f"a text of some words {i}") for i in range(40)],
                                 "doc_id long, text string").repartition(4)
    for _ in range(2):
        assert sum(r.n_tokens for r in sentencepiece_codec.encode(docs).collect()) > 0
        assert sum(r.n_tokens for r in token_counts.token_counts(docs).collect()) > 0
    assert {r.n for r in in_tasks(docs, kept, "n long").collect()} == {0}


def test_the_language_stage_rejects(spark):
    """Texts without letters go, and those that fit no language, whatever they declare."""
    rnd = random.Random(4)
    rows = [(i, "the house of the old man is by the river and the trees " * 3, "en", "s", 1)
            for i in range(40)]
    rows += [(100, "12345 67890 !!!", "en", "s", 1), (101, None, "en", "s", 1), (102, "", None, None, 0),
             (103, "".join(rnd.choice("бвгджзклмнпрст") for _ in range(600)), None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long")
    kept = corpus_pipeline.identify_language(spark, docs, "unused")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(40))
