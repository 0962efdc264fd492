"""Chat formatting: collapse cumulative snapshots, then render what is maximal.

Logs often hold one conversation several times, each time with more turns. A
conversation is dropped when all its turns, in order, are the first turns of a
longer one; of equal conversations the smallest ``conv_id`` stays.

Every turn gets a rolling prefix hash: the sum, over the turns so far, of three
60-bit numbers that hash position, role and text together. A sum can be taken
in blocks, so one conversation with a large share of all turns is split into
blocks of ``BLOCK`` turns: sums inside blocks, then over the few block totals.
Prefix sets are grouped (one row per distinct prefix) before the anti-join, so
a first turn that a third of all conversations share is one row there.

Rendering gives rows of at most ``BLOCK`` turns (``chunk`` 0, 1, ...); ordinary
conversations are one chunk, and no task ever holds a conversation of unbounded
length.

Defined results: NULL role or text renders as empty and differs from the empty
string when prefixes are compared; turns are ordered by ``turn`` (NULL first),
ties by role and text; texts of any length are hashed and rendered whole; a repeated row (all four columns equal) is one turn; all
rows without ``conv_id`` are one conversation; empty table, empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.shared import written

BLOCK = 4096
HEAD, END = "<|im_start|>", "<|im_end|>"


def _piece(i: int, *cols: Column) -> Column:
    """60 bits of the turn; a sum of 2^60-sized values is kept as decimal."""
    blob = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    return F.conv(F.substring(blob, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    ).distinct()


def prefix_hashes(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, turn, role, text, block, pos, h0, h1, h2, n_turns``: position in
    the conversation (1..n) and the hash of its first ``pos`` turns."""
    t = _turns(conversations).withColumn(
        "block", F.coalesce(F.floor(F.col("turn") / block), F.lit(None).cast("long")))
    inside = Window.partitionBy("conv_id", "block").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(),
        F.col("text").asc_nulls_first())
    t = t.withColumn("rank", F.row_number().over(inside).cast("long"))
    totals = t.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    blocks = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    t = _by_block(t, totals).withColumn("pos", F.col("rank") + F.col("skip")).drop("rank", "skip")
    for i in range(3):
        t = t.withColumn(f"p{i}", _piece(i, F.col("pos"), F.col("role"), F.col("text")))
    sums = t.groupBy("conv_id", "block").agg(*[F.sum(f"p{i}").alias(f"s{i}") for i in range(3)])
    zero = F.lit(0).cast("decimal(38,0)")
    sums = sums.select("conv_id", "block", *[
        F.coalesce(F.sum(f"s{i}").over(before), zero).alias(f"s{i}") for i in range(3)])
    run = Window.partitionBy("conv_id", "block").orderBy("pos")
    t = _by_block(t, sums)
    return t.select("conv_id", "turn", "role", "text", "block", "pos", "n_turns", *[
        (F.sum(f"p{i}").over(run) + F.col(f"s{i}")).cast("decimal(38,0)").alias(f"h{i}")
        for i in range(3)])


def _by_block(rows: DataFrame, per_block: DataFrame) -> DataFrame:
    b = per_block.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"),
                         *[c for c in per_block.columns if c not in ("conv_id", "block")])
    return rows.join(b, F.col("conv_id").eqNullSafe(F.col("_c"))
                     & F.col("block").eqNullSafe(F.col("_b"))).drop("_c", "_b")


def collapse(turns: DataFrame) -> DataFrame:
    """``conv_id, copies, n_turns`` of the maximal conversations, from ``prefix_hashes``."""
    key = ["h0", "h1", "h2", "pos"]
    whole = (turns.where(F.col("pos") == F.col("n_turns")).groupBy(*key)
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")))
    proper = turns.where(F.col("pos") < F.col("n_turns")).select(*key).distinct()
    return (whole.join(proper, key, "left_anti")
            .select("conv_id", "copies", F.col("pos").alias("n_turns")))


def render(turns: DataFrame, kept: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, chunk, copies, n_turns, first_turn, chunk_turns, rendered``."""
    k = kept.select(F.col("conv_id").alias("_c"), "copies")
    t = turns.join(k, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    line = F.concat(F.lit(HEAD), F.coalesce("role", F.lit("")), F.lit("\n"),
                    F.coalesce("text", F.lit("")), F.lit(END + "\n"))
    g = (t.withColumn("chunk", F.floor((F.col("pos") - 1) / block))
         .groupBy("conv_id", "chunk", "copies", "n_turns")
         .agg(F.min("pos").alias("first_turn"), F.count(F.lit(1)).alias("chunk_turns"),
              F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines")))
    return g.select("conv_id", "chunk", "copies", "n_turns", "first_turn", "chunk_turns",
                    F.array_join(F.col("lines.line"), "").alias("rendered"))


def format_chats(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Collapse, then render: one row per maximal conversation (and chunk)."""
    turns = written(prefix_hashes(conversations, block), "chat-prefixes")
    return render(turns, collapse(turns), block)
