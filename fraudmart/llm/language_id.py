"""Language ID by Bayesian evidence fusion.

Four kinds of evidence are independent given the language:

* the text: a naive Bayes model over byte trigrams of the lower-case text,
  hashed into ``BUCKETS``. It is trained on all texts with a declared language,
  counted in Spark per language. A text's evidence is its mean log likelihood
  times at most ``EFFECTIVE`` trigrams, since neighbours repeat each other;
* the declared markup language (an ``html lang`` or a column), with the
  probability of each declaration given the language;
* the address suffix, likewise;
* the host: a prior smoothed from the corpus over suffix and registered domain
  to the host.

The last three come from grouped sums of the posterior by text alone, so a wrong
declaration or a mixed host only weighs as much as it agrees with the texts. A
host's share of rows does not matter: sums are pre-aggregated, and what is
joined back is one small row per value.

A document is rejected (``kept`` false) when it has no letters, when its text fits
none of the languages, when its best language's probability is under
``LEAST_CONFIDENCE``, or when that language is not among ``accepted`` (default: all
languages of the training table). Fit is absolute: the share of the text's letter
trigrams that are likelier in its best language than among uniform bytes must reach
``LEAST_FIT`` of the same share of that language's training texts, less a slack for
short texts. The ``MOST_LANGS`` languages that most rows declare (of two rows at least)
are classes; the rest, as raw pages declare thousands of odd tags, is one class, ``und``,
so the table that travels with the tasks is bounded whatever is declared. All classes are
mixed with the same share of the pooled texts, so what no language has favours none. A
text in a language outside the table that is close to one in it can still fit that one.

Defined results: NULL or empty text has no text evidence and is rejected;
texts of any length are read whole, in chunks;
missing declaration, suffix or host is no evidence (the prior is then that of
the next level); ties go to the alphabetically first language; without any
declared language in the training table nothing is identified and all rows are
rejected; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.shared import in_tasks, row_key, without, written

BUCKETS = 1 << 16
EFFECTIVE = 60.0
LEAST_CONFIDENCE = 0.5
#: rows that a language needs in the training table: a text that alone declares its
#: language has no other to be compared with
LEAST_ROWS = 2
#: languages with a class of their own, by rows that declare them (ties: alphabetically); all
#: others share the class REST
MOST_LANGS = 48
REST = "und"
#: weight of the pooled texts in each language
POOLED = .1
LEAST_FIT = .5
PRIOR_WEIGHT = 20.0
CHUNK = 1 << 20


def trigrams(text: str):
    """Hashed byte trigrams of the lower-case text, in chunks."""
    a = np.frombuffer(text.lower().encode(), dtype=np.uint8).astype(np.uint32)
    for at in range(0, max(len(a) - 2, 0), CHUNK):
        x = a[at:at + CHUNK + 2]
        yield ((x[:-2] | x[1:-1] << 8 | x[2:] << 16) * np.uint32(2654435761)) >> np.uint32(16)


def lettered_trigrams(text: str):
    """Which trigrams consist of letters and spaces, in the chunks of ``trigrams``."""
    a = np.frombuffer(text.lower().encode(), dtype=np.uint8)
    for at in range(0, max(len(a) - 2, 0), CHUNK):
        x = a[at:at + CHUNK + 2]
        x = ((x >= 97) & (x <= 122)) | (x >= 128) | (x == 32)
        yield x[:-2] & x[1:-1] & x[2:]


def _letters(text: str) -> int:
    a = np.frombuffer(text.lower().encode(), dtype=np.uint8)
    return int(np.count_nonzero(((a >= 97) & (a <= 122)) | (a >= 128)))


def trigram_table(train: DataFrame) -> DataFrame:
    """``lang, bucket, n`` from rows ``lang, text``; each task counts before the shuffle."""
    def run(batches):
        sums: dict[str, np.ndarray] = {}

        def out():
            for lang, s in sums.items():
                at = np.flatnonzero(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()),
                     pa.array(s[at], pa.int64())], names=["lang", "bucket", "n"])
            sums.clear()

        for b in (p.slice(at, 512) for p in batches for at in range(0, p.num_rows, 512)):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for t in trigrams(text or ""):
                    s += np.bincount(t, minlength=BUCKETS)
                if len(sums) > 64:
                    yield from out()
        yield from out()

    return (train.select("lang", "text").transform(in_tasks, run, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


class TextModel:
    """Log probabilities [bucket, language]; one table of BUCKETS rows, whatever the corpus."""

    def __init__(self, langs: list[str], table: np.ndarray):
        self.langs = langs
        own = table / np.maximum(table.sum(axis=0, keepdims=True), 1)
        pool = table.sum(axis=1, keepdims=True) + .5
        self.logp = np.log((1 - POOLED) * own + POOLED * pool / pool.sum())
        #: is a trigram likelier than among uniform bytes?
        self.likely = (table + .5) * BUCKETS > (table + .5).sum(axis=0, keepdims=True)
        self.least = LEAST_FIT * (own * self.likely).sum(axis=0)

    def evidence(self, text: str) -> tuple[np.ndarray, bool]:
        """Log likelihoods, and whether the text fits the best language (texts without a
        trigram of letters have no say)."""
        total, n = np.zeros(len(self.langs)), 0
        likely, letters = np.zeros(len(self.langs)), 0
        for t, lettered in zip(trigrams(text), lettered_trigrams(text)):
            total += self.logp[t].sum(axis=0)
            n += len(t)
            likely += np.count_nonzero(self.likely[t[lettered]], axis=0)
            letters += np.count_nonzero(lettered)
        best = int(total.argmax()) if len(total) else 0
        fits = not letters or likely[best] / letters >= self.least[best] - .5 / letters ** .5
        return total * (min(n, EFFECTIVE) / n) if n else total, bool(fits)


def train_text_model(train: DataFrame, least_rows: int = LEAST_ROWS,
                     most: int = MOST_LANGS) -> TextModel:
    """From rows ``lang, text``; NULL and blank languages are left out."""
    t = train.select(_code(F.col("lang")).alias("lang"), "text").where(F.col("lang") != "")
    rows = t.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    own = rows.where((F.col("n") >= least_rows) & (F.col("lang") != REST)).orderBy(
        F.desc("n"), "lang").limit(most)
    langs = sorted(r.lang for r in own.select("lang").collect())
    rest = rows.where(~F.col("lang").isin(langs)).agg(F.sum("n")).first()[0] or 0
    if rest >= least_rows:
        langs.append(REST)
        t = t.withColumn("lang", F.when(F.col("lang").isin(langs), F.col("lang")).otherwise(REST))
        langs.sort()
    table = np.zeros((BUCKETS, len(langs)))
    if langs:
        got = trigram_table(t.where(F.col("lang").isin(langs))).toArrow()
        at = {x: i for i, x in enumerate(langs)}
        col = [at[x] for x in got.column("lang").to_pylist()]
        table[got.column("bucket").to_numpy(), col] = got.column("n").to_numpy()
    return TextModel(langs, table)


def _code(lang: Column) -> Column:
    """``en-GB`` and ``EN`` are ``en``."""
    return F.lower(F.trim(F.regexp_extract(F.coalesce(lang.cast("string"), F.lit("")),
                                           r"^\s*([A-Za-z]*)", 1)))


def text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """``id, row_key, letters, declared, suffix, domain, host, fits, ll`` of rows with a
    ``text``."""
    names = ["id", "row_key", "declared", "suffix", "domain", "host", "text"]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [t or "" for t in part.column(6).to_pylist()]
                ll = [model.evidence(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(6)]
                    + [pa.array([_letters(t) for t in texts], pa.int64()),
                       pa.array([x[1] for x in ll], pa.bool_()),
                       pa.array([x[0] for x in ll], pa.list_(pa.float64()))],
                    names=[*names[:-1], "letters", "fits", "ll"])

    return rows.select(*names).transform(in_tasks,
        run, "id long, row_key long, declared string, suffix string, domain string, "
             "host string, letters long, fits boolean, ll array<double>")


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def _sums(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Summed posteriors per key as one array column."""
    g = rows.groupBy(*keys).agg(*[F.sum(F.col("post")[i]).alias(f"s{i}") for i in range(n)])
    return g.select(*keys, F.array(*[f"s{i}" for i in range(n)]).alias("s"))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


def _smoothed(parent: Column, s: Column) -> Column:
    """A level's probabilities with its parent's as a prior of ``PRIOR_WEIGHT`` rows."""
    n = _total(s)
    return F.zip_with(s, parent, lambda x, p: (x + F.lit(PRIOR_WEIGHT) * p) / (n + PRIOR_WEIGHT))


def _likelihood(seen: DataFrame, key: str, n: int) -> DataFrame:
    """log P(value | language) per value of ``key`` with add-one smoothing over values."""
    per = written(_sums(seen.where(F.col(key).isNotNull()), [key], n), f"langid-{key}")
    total = per.agg(*[F.coalesce(F.sum(F.col("s")[i]), F.lit(0.0)).alias(f"t{i}") for i in range(n)],
                    F.count(F.lit(1)).alias("v")).first()
    return per.select(key, F.array(*[
        F.log((F.col("s")[i] + 1) / F.lit(float(total[f"t{i}"]) + total["v"] + 1))
        for i in range(n)]).alias(f"{key}_log"))


def identify(rows: DataFrame, model: TextModel, accepted: list[str] | None = None) -> DataFrame:
    """``id, lang, confidence, kept, declared, text_lang, row_key`` of rows ``id, row_key,
    declared, suffix, domain, host, text`` (NULL or blank: missing)."""
    langs, n = model.langs, len(model.langs)
    clean = rows.select("id", "row_key", F.nullif(_code(F.col("declared")), F.lit("")).alias("declared"),
                        *[F.nullif(F.lower(F.trim(F.col(c).cast("string"))), F.lit("")).alias(c)
                          for c in ("suffix", "domain", "host")], "text")
    if not n:
        return clean.select("id", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
                            F.lit(False).alias("kept"), "declared",
                            F.lit(None).cast("string").alias("text_lang"), "row_key")
    ev = written(text_evidence(clean, model), "langid-evidence")
    seen = ev.where((F.col("letters") > 0) & F.col("fits")).withColumn("post", _softmax(F.col("ll")))

    # priors: corpus, then suffix, domain and host, each smoothed towards the level above
    hosts = written(_sums(seen, ["suffix", "domain", "host"], n), "langid-hosts")
    whole = hosts.agg(*[F.coalesce(F.sum(F.col("s")[i]), F.lit(0.0)) for i in range(n)]).first()
    base = np.array([float(x) for x in whole]) + 1
    corpus = F.array(*[F.lit(float(x)) for x in base / base.sum()])
    hosts = hosts.withColumn("post", F.col("s"))
    level = hosts
    prior = corpus
    for i, keys in enumerate((["suffix"], ["suffix", "domain"], ["suffix", "domain", "host"])):
        sums = _sums(hosts, keys, n).toDF(*[f"_{k}{i}" for k in keys], f"_s{i}")
        on = [F.col(k).eqNullSafe(F.col(f"_{k}{i}")) for k in keys]
        level = level.join(sums, on)
        step = _smoothed(prior, F.col(f"_s{i}"))
        prior = F.when(F.col(keys[-1]).isNull(), prior).otherwise(step)
        level = level.withColumn(f"_p{i}", prior)
        prior = F.col(f"_p{i}")
    priors = written(level.select(F.col("suffix").alias("_x"), F.col("domain").alias("_y"),
                                  F.col("host").alias("_z"), F.col("_p2").alias("prior")),
                     "langid-priors")

    zeros = F.array(*[F.lit(0.0)] * n)
    out = ev
    for key in ("declared", "suffix"):
        like = _likelihood(seen, key, n)
        out = out.join(like.withColumnRenamed(key, f"_{key}"),
                       F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")
    out = out.join(priors, F.col("suffix").eqNullSafe(F.col("_x"))
                   & F.col("domain").eqNullSafe(F.col("_y"))
                   & F.col("host").eqNullSafe(F.col("_z")), "left")
    logs = F.zip_with(F.col("ll"), 
                      F.transform(F.coalesce("prior", corpus), lambda x: F.log(x)),
                      lambda a, b: a + b)
    for key in ("declared", "suffix"):
        logs = F.zip_with(logs, F.coalesce(f"{key}_log", zeros), lambda a, b: a + b)
    names = F.array(*[F.lit(x) for x in langs])

    def best(p):
        return F.element_at(names, F.array_position(p, F.array_max(p)).cast("int"))

    out = out.withColumn("p", _softmax(logs)).withColumn("lang", best(F.col("p")))
    sure = (F.col("letters") > 0) & F.col("fits") & (F.array_max("p") >= LEAST_CONFIDENCE)
    if accepted is not None:
        sure = sure & F.col("lang").isin(list(accepted))
    return out.select("id", "lang", F.array_max("p").alias("confidence"), sure.alias("kept"),
                      "declared", best(F.col("ll")).alias("text_lang"), "row_key")


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as evidence rows: ``lang`` is the declaration, ``source`` the host."""
    def col(name):
        return (F.col(name).cast("string") if name in docs.columns
                else F.lit(None).cast("string"))
    none = F.lit(None).cast("string")
    i, t = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(i.alias("id"), row_key(i, t).alias("row_key"), col("lang").alias("declared"),
                       none.alias("suffix"), none.alias("domain"), col("source").alias("host"),
                       t.alias("text"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Raw pages as evidence rows: markup language, address suffix, domain and host."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")),
                                    r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    body = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    body = F.regexp_replace(F.regexp_replace(body, r"<[^>]*>", " "), r"&[a-zA-Z0-9#]{1,8};", " ")
    i = F.col("page_id").cast("long")
    return pages.select(
        i.alias("id"), row_key(i, F.col("html").cast("string")).alias("row_key"),
        F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", 1).alias("declared"),
        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        host.alias("host"), body.alias("text"))


def identify_documents(docs: DataFrame, accepted: list[str] | None = None) -> DataFrame:
    rows = document_rows(docs)
    model = train_text_model(rows.select(F.col("declared").alias("lang"), "text"))
    return identify(rows, model, accepted).withColumnRenamed("id", "doc_id")


def keep_identified(docs: DataFrame, accepted: list[str] | None = None) -> DataFrame:
    """``docs`` without rejected documents, all columns."""
    gone = identify_documents(docs, accepted).where(~F.col("kept")).select("row_key")
    return without(docs, gone)
