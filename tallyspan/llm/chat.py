"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

A log often holds a conversation several times, each time a few turns longer. Every turn gets the rolling
hash of the turns up to it. A conversation whose whole hash is the hash of a proper prefix of another one is
left out by an anti-join; of equal ones that with the least id stays. Only then are turns rendered.

A rolling hash is the exclusive or of hashes of (position, role, text), 128 bits in all, so it can be summed
over slices of a conversation: one that holds a third of all rows spreads over many tasks. For the same reason
the result has one row per turn: a conversation's text is its rows' texts in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspan.operators.ordered import SLICE, SPOT, join_slices, place, slice_totals, slices_before
from tallyspan.session import materialise

# The marks around a turn.
OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _turn_hash(seed: int) -> Column:
    missing = [F.col(c).isNull() for c in ("role", "text")]
    return F.xxhash64(F.lit(seed), F.col("position"), *missing, F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, position, n_turns, role, text, p1, p2): every turn with the hash of all turns up to it."""
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).distinct()
    placed = place(rows, ["conv_id"], ["turn", "role", "text"])
    whole = Window.partitionBy("conv_id")
    starts = slice_totals(placed, ["conv_id"], _n=F.count(F.lit(1)), _first=F.min(SPOT)).select(
        "conv_id", SLICE, "_first", F.coalesce(F.sum("_n").over(slices_before(["conv_id"])), F.lit(0)).alias("_skip"), F.sum("_n").over(whole).alias("n_turns")
    )
    numbered = join_slices(placed, starts, ["conv_id"]).withColumn("position", F.col("_skip") + F.col(SPOT) - F.col("_first"))
    hashed = materialise(
        numbered.withColumn("h1", _turn_hash(1)).withColumn("h2", _turn_hash(2)).select("conv_id", SLICE, "position", "n_turns", "role", "text", "h1", "h2"), "turns"
    )
    carried = slice_totals(hashed, ["conv_id"], _x1=F.bit_xor("h1"), _x2=F.bit_xor("h2")).select(
        "conv_id", SLICE, *[F.coalesce(F.bit_xor(f"_x{k}").over(slices_before(["conv_id"])), F.lit(0)).alias(f"_c{k}") for k in (1, 2)]
    )
    inside = Window.partitionBy("conv_id", SLICE).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select("conv_id", SLICE, "position", "n_turns", *[F.bit_xor(f"h{k}").over(inside).alias(f"_i{k}") for k in (1, 2)])
    summed = join_slices(running, carried, ["conv_id"]).select(
        "conv_id", "position", "n_turns", *[F.col(f"_c{k}").bitwiseXOR(F.col(f"_i{k}")).alias(f"p{k}") for k in (1, 2)]
    )
    return hashed.select("conv_id", "position", "n_turns", "role", "text"), materialise(summed, "prefixes")


def maximal(marks: DataFrame) -> DataFrame:
    """(conv_id): conversations that are no proper prefix of another and the first of their equals."""
    last = F.col("position") == F.col("n_turns") - 1
    full = marks.where(last).select("conv_id", "n_turns", "p1", "p2")
    inner = marks.where(~last).select((F.col("position") + 1).alias("n_turns"), "p1", "p2").distinct()
    once = full.groupBy("n_turns", "p1", "p2").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    return once.join(inner, ["n_turns", "p1", "p2"], "left_anti").select("conv_id")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, position, n_turns, role, rendered) of every turn of the maximal conversations of ``turns``.

    ``turns`` needs conv_id, turn, role and text; other columns are ignored. Turns are ordered by turn, then role,
    then text (nulls first); rows that repeat wholly are one turn. A null role or text differs from an empty one
    when conversations are compared and is rendered as empty. Rows without conv_id form one conversation.
    """
    rows, marks = prefixes(turns)
    kept = maximal(marks)
    rendered = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit(BREAK), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    return rows.join(kept.withColumnRenamed("conv_id", "_kept"), F.col("conv_id").eqNullSafe(F.col("_kept")), "left_semi").select(
        "conv_id", "position", "n_turns", "role", rendered.alias("rendered")
    )
