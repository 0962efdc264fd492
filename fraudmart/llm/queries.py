"""Registered ``opN_*`` queries: each applies one operator, with production
parameters, to its whole table. ``SQL`` holds DuckDB's equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudmart.llm import (chat, decontam, exact_dedup, html_text, language_id, lexical_search,
                           lm_scoring, near_dedup, sentencepiece_codec, spelling,
                           substring_dedup, suffix_dedup, token_counts)
from fraudmart.llm.shared import table


def op1_language_id(spark, sf_dir):
    """Documents: text, declared language, source as host."""
    r = language_id.identify_documents(table(spark, sf_dir, "documents"))
    return r.select("doc_id", "lang", "confidence", "kept", "declared", "text_lang")


def language_id_pages(spark, sf_dir):
    """Raw pages: text, markup language, address suffix, domain and host."""
    docs = language_id.document_rows(table(spark, sf_dir, "documents"))
    model = language_id.train_text_model(docs.select(F.col("declared").alias("lang"), "text"))
    r = language_id.identify(language_id.page_rows(table(spark, sf_dir, "pages")), model)
    return r.select(F.col("id").alias("page_id"), "lang", "confidence", "kept", "declared",
                    "text_lang")


def op2_lm_scoring(spark, sf_dir):
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents")).drop("row_key")


def op4_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(table(spark, sf_dir, "documents")).drop("row_key")


def op5_chat_formatting(spark, sf_dir):
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("row_key")


def op7_substring_dedup(spark, sf_dir):
    r = substring_dedup.repeated_words(table(spark, sf_dir, "documents"))
    return r.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", "kept_sha256")


def op8_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark, sf_dir):
    r = suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))
    return r.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans",
                    "kept_sha256")


def op10_decontamination(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.document_variants(table(spark, sf_dir, "documents"))


def op12_html_extraction(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op13_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def registry():
    return {
        "op1_language_id": op1_language_id,
        "language_id_pages": language_id_pages,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_token_counts": op3_token_counts,
        "op4_near_dedup": op4_near_dedup,
        "op5_chat_formatting": op5_chat_formatting,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_decontamination": op10_decontamination,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_html_extraction": op12_html_extraction,
        "op13_lexical_search": op13_lexical_search,
    }


OP5_SQL = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
convs AS (
  SELECT conv_id, count(*) AS n_turns,
         list(struct_pack(r := role, t := text) ORDER BY turn, role, text) AS body
  FROM turns GROUP BY conv_id),
whole AS (SELECT body, n_turns, min(conv_id) AS conv_id, count(*) AS copies
          FROM convs GROUP BY body, n_turns)
SELECT w.conv_id, chunk, w.copies, w.n_turns, 4096 * chunk + 1 AS first_turn,
       least(4096, w.n_turns - 4096 * chunk) AS chunk_turns,
       list_aggregate(list_transform(w.body[4096 * chunk + 1:4096 * chunk + 4096],
           lambda x: '<|im_start|>' || coalesce(x.r, '') || chr(10)
           || coalesce(x.t, '') || '<|im_end|>' || chr(10)), 'string_agg', '') AS rendered
FROM (SELECT *, unnest(range((n_turns + 4095) // 4096)) AS chunk FROM whole) w
WHERE NOT EXISTS (SELECT 1 FROM whole l WHERE l.n_turns > w.n_turns
                  AND l.body[1:w.n_turns] = w.body)
"""

OP6_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
       sha256(d.body) AS text_sha256
FROM d JOIN g ON d.body = g.body
"""

OP10_SQL = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                             lambda w: w <> '') AS w FROM documents),
iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                              lambda w: w <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS shingle
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM dw WHERE len(w) >= 5)),
its AS (SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') AS shingle
        FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM iw WHERE len(w) >= 5)),
size AS (SELECT item_id, count(*) AS item_size FROM its GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared
           FROM ds JOIN its USING (shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, item_size, n_shared / item_size AS containment
FROM shared JOIN size USING (item_id)
WHERE n_shared >= 0.8 * item_size - 1e-9
"""

OP11_SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
coded AS (
  SELECT run, k, list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                                lambda c: unicode(c)::BIGINT) AS points FROM runs),
bytes AS (
  SELECT run, k, flatten(list_transform(points, lambda u:
      CASE WHEN u < 128 THEN [u] ELSE [192 + (u >> 6), 128 + (u & 63)] END)) AS b FROM coded),
hashed AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295, b), lambda c, x:
      xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h FROM bytes, crc),
words AS (
  SELECT CASE WHEN h % 31 = 0
              THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, k FROM hashed),
vocab AS (SELECT word, sum(k)::BIGINT AS n FROM words WHERE length(word) >= 7
          GROUP BY word HAVING sum(k) >= 2),
skips AS (SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b
          FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocab)),
near AS (
  SELECT s.word, o.word AS other, o.n FROM skips s JOIN skips o USING (a, b) WHERE s.word <> o.word
  UNION SELECT s.word, v.word, v.n FROM skips s JOIN vocab v ON v.word = s.a || s.b
  UNION SELECT v.word, s.word, s.n FROM skips s JOIN vocab v ON v.word = s.a || s.b),
best AS (SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near,
                row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place FROM near),
forms AS (SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
                 CASE WHEN b.n >= 10 * v.n THEN b.other END AS form,
                 CASE WHEN b.n >= 10 * v.n THEN b.n END AS form_n
          FROM vocab v LEFT JOIN best b ON b.word = v.word AND b.place = 1),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e USING (word)
"""

OP13_SQL = r"""
WITH td AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
ti AS (
  SELECT DISTINCT item_id, text,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
items AS (SELECT item_id, text, unnest(terms) AS term FROM ti),
size AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM td WHERE len(terms) > 0),
tf AS (SELECT doc_id, r, n, term, count(*) AS tf
       FROM (SELECT doc_id, r, len(terms)::BIGINT AS n, unnest(terms) AS term FROM td)
       GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, size GROUP BY term, n_docs),
scored AS (
  SELECT item_id, text, doc_id, r, sum(w * ((1000000000 * tf)
         // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM items JOIN tf USING (term) JOIN w USING (term), size GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text
                                        ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

SQL = {
    "op5_chat_formatting": OP5_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op13_lexical_search": OP13_SQL,
}
