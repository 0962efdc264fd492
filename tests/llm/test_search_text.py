"""Spelling variants, page text and lexical search: brute force and edge cases."""

import random
import re
import zlib
from collections import Counter
from html import unescape

import pytest

from fraudmart.llm import html_text, lexical_search, spelling
from fraudmart.llm.queries import SQL, op11_spelling_variants, op12_html_extraction, \
    op13_lexical_search
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, word string, n long, item long, rank int"


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2, 3) for d, t in rows], SCHEMA)


def _texts(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text").collect()]


# --- 11: spelling variants

def _answers(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
            for r in df.collect()}


@pytest.mark.parametrize("parts", [None, 1, 7, 40])
def test_variants_match_all_pairs(spark, parts):
    rnd = random.Random(3)
    stems = ["".join(rnd.choice("abàz") for _ in range(rnd.randint(6, 9))) for _ in range(60)]
    words = set()
    for s in stems:
        words.add(s)
        for _ in range(6):
            i = rnd.randrange(len(s))
            words |= {s[:i] + s[i + 1:], s[:i] + rnd.choice("abÿ") + s[i:],
                      s[:i] + rnd.choice("abz") + s[i + 1:]}
    words |= {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "a" * 5000, "a" * 5001, "zzzzzzz"}
    vocab = {w: 10 ** rnd.randint(0, 5) * rnd.randint(1, 3) + 1 for w in words if len(w) >= 7}
    got = _answers(spelling.variants(
        spark.createDataFrame(list(vocab.items()), "word string, n long"), parts=parts))
    assert got == brute.variants(vocab)


def test_variants_of_documents(spark):
    rows = _texts(spark, SMALL)
    words = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    vocab = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}
    assert _answers(op11_spelling_variants(spark, SMALL)) == brute.variants(vocab)


def test_variants_edge_cases(spark):
    long = "q" * 30000
    rows = [(1, None), (2, ""), (None, "Tokenss tokenss"), (None, "Tokenss tokenss"),
            (3, "ÀBCDEFGH Àbcdefgh 123"), (4, f"{long} x {long}"), (5, "short × words ÷ only")]
    got = _answers(spelling.document_variants(_docs(spark, rows)))
    assert got["tokenss"] == (None, "tokenss", 4, 0, None)
    assert got["Àbcdefgh"] == (None, "Àbcdefgh", 2, 0, None)  # only A-Z are lowered
    assert sum(len(w) >= 29999 for w in got) == 1
    assert spelling.document_variants(_docs(spark, [])).count() == 0
    one = spark.createDataFrame([("abcdefgh", 5)], "word string, n long")
    assert _answers(spelling.variants(one)) == {"abcdefgh": (None, "abcdefgh", 5, 0, None)}
    with pytest.raises(ValueError):
        spelling.variants(one, ratio=1)


def test_variant_ties_and_chains(spark):
    vocab = {"aaaaaaab": 2, "aaaaaaac": 30, "aaaaaaad": 30, "aaaaaaaa": 29,
             "baaaaaac": 300, "baaaaaacc": 3000}
    got = _answers(spelling.variants(spark.createDataFrame(list(vocab.items()),
                                                           "word string, n long")))
    assert got["aaaaaaab"][:2] == ("aaaaaaac", "baaaaaacc")  # of equals the smallest; then on
    assert got["aaaaaaac"][:2] == ("baaaaaac", "baaaaaacc")
    assert got["baaaaaacc"] == (None, "baaaaaacc", 3000, 1, None)
    assert got == brute.variants(vocab)


# --- 12: page text

PAGE = """<!DOCTYPE html><html lang="en"><head><title>Site</title><style>p{}</style>
<script>var a = "</p><article>";</script></head><body class="has-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this page work as you expect it to.</p></div>
%s
<div id="comments"><h3>Comments</h3><article class="comment"><p>Great read, thank you very
much!</p></article></div>
<form action="/s"><label>Search</label><input name="q"></form>
<aside><p>Related: another long story that you may like as well, with many words in it.</p></aside>
<footer>&copy; 2024 Site</footer></body></html>"""


@pytest.mark.parametrize("body, want", [
    ("<article><h1>A&amp;B</h1><p>One  <b>two</b>\n three<br>four.</p><p>F&ouml;&#x20AC;</p></article>",
     ["A&B", "One two three four.", "Fö€"]),
    ("<article><h1>T</h1><p><b>Never closed.<br><p>Next.<div class='ad'>Buy!</div><p>Last.</article>",
     ["T", "Never closed.", "Next.", "Last."]),
    ("<article></article>", []),
    ("<main><h1>T</h1><p>Only <a href='x'>a link</a></p><p><a href='y'>all link</a></p>"
     "<section class='share-buttons'>Tweet</section></main>", ["T", "Only a link", "all link"]),
    ("<article><header><h1>Title</h1></header><p>Text</p><footer>By me</footer></article>",
     ["Title", "Text"]),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>"
     "<p>a < b & c<!-- not > this --> d</p></article>", ["one", "two", "a b", "c", "a < b & c d"]),
    ("<div class='ad'>Never closed ad <article><p>Article</p></article>", ["Article"]),
    ("<div class='wrapper sidebar-left'><article><p>Inside</p></article></div>", ["Inside"]),
    ("<article><p title=\"a > b\" data-x='<p>'>Quoted</p><p hidden>no</p></article>", ["Quoted"]),
])
def test_page_text(body, want):
    assert html_text.main_text(PAGE % body) == "\n\n".join(want)


def test_page_without_article_uses_the_distribution():
    story = "<p>" + "A sentence of the story that goes on. " * 4 + "</p>"
    links = "<div><ul>" + "<li><a href='x'>Some other page of the site</a></li>" * 30 + "</ul></div>"
    html = f"<html><body>{links}<div><div><p>Home</p></div></div><div><div><h2>Title</h2>{story}" \
           f"<p>Short.</p>{story}</div></div><div><div><p>Imprint</p></div></div>{links}"
    one = " ".join(["A sentence of the story that goes on."] * 4)
    assert html_text.main_text(html) == "\n\n".join(["Title", one, "Short.", one])
    # no window reaches the surge: the longest passage, the first of equals
    assert html_text.main_text("<p>Hi</p><section><div></div></section><p>Ho</p>") == "Hi"


def test_page_rows(spark):
    rows = [(1, "u", "<article><p>x</p></article>", "t", 1), (1, "u", "<article><p>x</p></article>",
            "t", 1), (2, None, None, "t", 2), (None, "u", "", "t", 3), (3, "u", "<p", "t", 4),
            (4, "u", "<article>" + "<p>é word</p>" * 50000 + "<p>cut &amp", "t", 5),
            (5, "u", "<b>" * 20000 + "<div>" * 20000 + "deep", "t", 6),
            (6, "u", "<nav>menu</nav>", "t", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, "
                                        "n_chars int")
    got = sorted((tuple(r) for r in html_text.extract(pages).collect()), key=str)
    long = "\n\n".join(["é word"] * 50000 + ["cut &"])
    assert got == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (2, None, "", 0), (None, "u", "", 0),
                          (3, "u", "", 0), (4, "u", long, len(long)), (5, "u", "deep", 4),
                          (6, "u", "", 0)], key=str)
    assert html_text.extract(pages.limit(0)).collect() == []


def test_given_pages_match_their_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = op12_html_extraction(spark, SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        html = pages[r["page_id"]]
        body = html[html.index("<article>") + 9:html.index("</article>")]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", x)).split())
                  for x in re.split("</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


# --- 13: lexical search

def _ranks(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()),
                  key=str)


def test_search_matches_sql(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(SQL["op13_lexical_search"]).fetchall()
    assert _ranks(op13_lexical_search(spark, SMALL)) == sorted(want, key=str)


@pytest.mark.parametrize("most, slices", [(1_000_000, 3), (40, 11)])
def test_search_matches_brute_force(spark, monkeypatch, most, slices):
    rnd = random.Random(5)
    pool = ["a", "B", "b", "Ünï", "ünï", "x1", "zz", "日本"] + [f"w{i}" for i in range(60)]
    gaps = [" ", "_", "-\n", "\x00", "@"]
    text = lambda k: "".join(rnd.choice(pool) + rnd.choice(gaps) for _ in range(k))
    docs = [(i, text(rnd.choice([0, 1, 5, 40, 300]))) for i in range(150)]
    docs += [(7, docs[7][1]), (None, "zz zz w1"), (None, "zz zz w1"), (900, None), (901, " -- ")]
    items = [(i, text(rnd.randint(0, 30))) for i in range(25)]
    items += [items[3], (3, "another text of w1"), (None, "zz w1"), (50, None), (51, "nowhere")]
    got = lexical_search.search(
        _docs(spark, docs).repartition(slices),
        spark.createDataFrame([(i, t, 1, 1) for i, t in items],
                              "item_id long, text string, score int, doc_id long"),
        top=5, most_postings=most)
    assert _ranks(got) == sorted(brute.search(docs, items, 5), key=str)


def test_search_edge_cases(spark):
    items = spark.createDataFrame([("i", "a b")], "item_id string, text string")
    none = lexical_search.search(_docs(spark, []), items)
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0
    assert lexical_search.search(_docs(spark, [(1, "a")]), items.limit(0)).count() == 0
    long = ("word " * 600_000) + "é" * 2_000_000
    assert sum(lexical_search.term_counts(long.encode()).values()) == 600_001
    got = lexical_search.search(_docs(spark, [(1, long), (2, "A"), (3, "a")]), items)
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in got.orderBy("rank").collect()] == \
        [("i", 1, 2), ("i", 2, 3)]
