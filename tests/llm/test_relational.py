"""Exact dedup, decontamination, chat formatting, components and the pipeline."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fraudmart.llm import chat, decontam, exact_dedup, queries
from fraudmart.llm.components import components
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    import duckdb

    from tools.oracle_check import TABLES, bag
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = queries.registry()[name](spark, SMALL)
    rel = con.sql(queries.SQL[name])
    cols, want = rel.columns, rel.fetchall()
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    assert bag([tuple(r) for r in df.collect()], df.columns, order) == bag(want, cols, order)


# --- exact copies --------------------------------------------------------------------

def _docs(spark, rows):
    return spark.createDataFrame(
        [(d, t, "x", 1, "k") for d, t in rows],
        "doc_id long, text string, keep_id string, group_size int, content_hash string")


def test_exact_dedup_edge_cases(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "b"), (5, "A"), (6, "a ")]
    got = sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept)
                 for r in exact_dedup.exact_dedup(_docs(spark, rows)).collect())
    assert got == [(0, 0, 1, True), (1, 2, 3, False), (2, 2, 3, True), (2, 2, 3, True),
                   (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (6, 6, 1, True)]
    docs = _docs(spark, rows)
    kept = exact_dedup.keep_rows(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [
        (0, "b"), (2, "a"), (4, ""), (5, "A"), (6, "a ")]
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_a_collision_of_the_hash_makes_no_copies(spark):
    weak = lambda t: F.substring(F.encode(t, "UTF-8"), 1, 1)
    rows = [(1, "ab"), (2, "ac"), (3, "ab")]
    got = {r.doc_id: (r.keep_id, r.group_size)
           for r in exact_dedup.exact_dedup(_docs(spark, rows), weak).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2)}


# --- leaks ---------------------------------------------------------------------------

def test_leaks_match_brute_force(spark):
    rnd = random.Random(2)
    word = lambda: rnd.choice("ab cd ef gh ij kl mn op qr st".split()) + str(rnd.randrange(30))
    items = [(i, " ".join(word() for _ in range(rnd.randint(3, 60)))) for i in range(30)]
    items += [(100, None), (101, ""), (102, items[0][1]), (None, items[1][1].upper() + "!")]
    docs = [(None, "short"), (-1, None), (-2, "")]
    for d in range(120):
        w = [word() for _ in range(rnd.randint(0, 300))]
        for _ in range(rnd.randint(0, 2)):
            part = rnd.choice(items[:30])[1].split()
            for _ in range(rnd.randint(0, 3)):  # some words replaced: containment falls
                part[rnd.randrange(len(part))] = "zz"
            at = rnd.randint(0, len(w))
            w[at:at] = part
        docs.append((d, ", ".join(w)))
    frame = spark.createDataFrame([(d, t, 7) for d, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, 8) for i, t in items], "item_id long, text string, doc_id int")
    key = lambda r: tuple(-9 if x is None else x for x in r)
    got = sorted(key((r.doc_id, r.item_id, r.n_shared, r.item_size))
                 for r in decontam.contaminated(frame, bench).collect())
    want = sorted(map(key, brute.leaks(docs, items)))
    assert got == want and len(want) > 20
    clean = decontam.clean(frame, bench)
    assert clean.columns == frame.columns
    assert clean.count() == len(docs) - len({w[0] for w in want})
    assert decontam.contaminated(frame.limit(0), bench).count() == 0
    assert decontam.contaminated(frame, bench.limit(0)).count() == 0


# --- chats ---------------------------------------------------------------------------

def _chats(spark, rows):
    return spark.createDataFrame([(*r, "b") for r in rows],
                                 "conv_id long, turn long, role string, text string, block string")


def test_prefixes_go_and_equal_conversations_keep_the_smallest_id(spark):
    def conv(i, texts):
        return [(i, n, "user" if n % 2 == 0 else "assistant", t) for n, t in enumerate(texts)]
    rows = (conv(1, "ab") + conv(2, "abc") + conv(3, "abd") + conv(4, "abc") + conv(5, "b")
            + conv(6, "ab") + [(7, 5, "user", "a"), (7, 9, "assistant", None)]
            + [(8, 0, "user", "a"), (8, 0, "user", "a"), (None, None, None, None)])
    got = {r.conv_id: (r.copies, r.n_turns, r.rendered) for r in chat.format_chats(_chats(spark, rows)).collect()}
    assert sorted(got, key=str) == [2, 3, 5, 7, None]
    assert got[2][:2] == (2, 3) and got[7][1] == 2
    assert got[5][2] == "<|im_start|>user\nb<|im_end|>\n"
    assert chat.format_chats(_chats(spark, [])).count() == 0


def test_blocks_do_not_change_the_result(spark):
    rnd = random.Random(4)
    rows = [(c, n * 3, "user", rnd.choice("ab")) for c in range(40) for n in range(rnd.randint(1, 9))]
    frame = _chats(spark, rows)
    whole = chat.format_chats(frame).collect()
    parts = chat.format_chats(frame, block=4).orderBy("chunk").collect()
    joined = {}
    for r in parts:
        joined[r.conv_id] = joined.get(r.conv_id, "") + r.rendered
        assert r.chunk_turns <= 4
    assert joined == {r.conv_id: r.rendered for r in whole}


# --- components and the pipeline -----------------------------------------------------

def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(30)] + [(7, 7)]
    edges += [(200 + rnd.randrange(80), 200 + rnd.randrange(80)) for _ in range(60)]
    rnd.shuffle(edges)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    frame = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.root for r in components(frame).collect()} == {x: find(x) for x in root}
    assert components(frame.limit(0)).count() == 0


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    last = {}
    for d, t in rows.items():
        last[t] = max(d, last.get(t, d))
    left = [(d, t) for d, t in rows.items() if last[t] == d]
    groups = brute.near_groups(left, 5, 80)
    left = [(d, t) for d, t in left if groups[d][1] == d]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    gone = {x[0] for x in brute.leaks(left, items)}
    want = {d for d, _ in left if d not in gone}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want)
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_the_columns_of_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_key string"
    rows = [(i, f"the of and to in {i} is that", "en", "s", 1, "r") for i in range(8)]
    rows += [(50, "the of and to in 3 is that", "en", None, None, None), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            out = stage(spark, frame, SMALL)
            assert out.columns == docs.columns, name
            out.count()


def test_clean_looks_at_rows_not_ids(spark):
    item = " ".join(f"w{i}" for i in range(12))
    half = item.split()
    rows = [(None, item), (None, "plain text that leaks nothing at all"), (5, " ".join(half[:8])),
            (5, " ".join(half[4:])), (6, item + " more"), (6, "another plain text of six words")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = {tuple(r) for r in decontam.clean(frame, bench).collect()}
    assert left == {rows[1], rows[2], rows[3], rows[5]}
