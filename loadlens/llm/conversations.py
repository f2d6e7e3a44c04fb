"""Operator 2: chat formatting with cumulative-snapshot collapse (DataFrame functions only).

Chat logs often hold a conversation once per turn: each snapshot repeats the
turns before it.  Turns are put in order and a rolling hash of the first k
turns is kept for every k.  A conversation whose whole hash is a proper prefix
hash of another one is dropped, of equal conversations the least conv_id stays;
two anti-joins do this.  The maximal conversations that remain are rendered.

Turns are ordered by (turn, role, text), so ties have one order; null roles and
texts equal each other and render as "unknown" and nothing; a null turn comes
first; rows with a null conv_id form one conversation; an empty table gives no
rows.  Long conversations are numbered and rendered in parts of 256 turn
numbers, so that no conversation has to fit in a task as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadlens.llm.tables import store

#: Turn numbers in a part of a conversation.
PART = 256
# Marks of the rendered form.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _before(df: DataFrame, value: str, out: str, agg) -> DataFrame:
    """Per conversation and part, ``agg`` of ``value`` over the earlier parts."""
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return df.select("conv_id", "part", F.coalesce(agg(value).over(earlier), F.lit(0).cast("long")).alias(out))


def numbered(turns: DataFrame) -> DataFrame:
    """``(conv_id, part, pos, role, text, h1, h2)``: position in the conversation and the hash of the turns up to it.

    The rolling hash is the running xor of two 64-bit hashes of (position, role, text).
    """
    t = turns.select("conv_id", F.coalesce(F.floor(F.col("turn") / PART), F.lit(-1 << 40)).cast("long").alias("part"), "turn", "role", "text")
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    t = store(t.withColumn("pos", F.row_number().over(inside)), "turns")
    sizes = store(t.groupBy("conv_id", "part").agg(F.count("*").alias("n")), "turn-parts")
    starts = _before(sizes, "n", "start", F.sum).select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "start")
    t = t.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).withColumn("pos", F.col("pos") + F.col("start")).drop("c", "p", "start")
    role, text = F.coalesce("role", F.lit("\0")), F.coalesce("text", F.lit("\0"))
    for i in (1, 2):
        t = t.withColumn(f"x{i}", F.xxhash64(F.lit(i), "pos", role, text))
    t = store(t, "hashed-turns")
    totals = store(t.groupBy("conv_id", "part").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")), "turn-hashes")
    one, two = _before(totals, "x1", "b1", F.bit_xor), _before(totals, "x2", "b2", F.bit_xor)
    before = one.join(two, one["conv_id"].eqNullSafe(two["conv_id"]) & (one["part"] == two["part"])).select(
        one["conv_id"].alias("c"), one["part"].alias("p"), "b1", "b2")
    upto = Window.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return (t.withColumn("h1", F.bit_xor("x1").over(upto)).withColumn("h2", F.bit_xor("x2").over(upto))
            .join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
            .select("conv_id", "part", "pos", "role", "text",
                    F.col("h1").bitwiseXOR(F.col("b1")).alias("h1"), F.col("h2").bitwiseXOR(F.col("b2")).alias("h2")))


def maximal(turns: DataFrame) -> DataFrame:
    """The numbered turns of the conversations that no other one extends or, with a lesser id, equals."""
    t = store(numbered(turns), "numbered")
    last = t.groupBy("conv_id").agg(F.max_by(F.struct("pos", "h1", "h2"), "pos").alias("e")).select("conv_id", "e.*")
    last = store(last, "whole")
    # one row per different conversation, by the least id
    whole = store(last.groupBy("pos", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.max(F.col("conv_id").isNull()).alias("has_null")), "distinct")
    ends = last.select(F.col("conv_id").alias("c"), F.col("pos").alias("n"))
    inner = (t.join(ends, F.col("conv_id").eqNullSafe(F.col("c"))).where("pos < n").select("pos", "h1", "h2").distinct())
    kept = whole.join(inner, ["pos", "h1", "h2"], "left_anti").select(F.col("conv_id").alias("c"))
    return t.join(store(kept, "kept"), F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")


def _line() -> Column:
    """One rendered turn; the marks are broken up where a text holds them."""
    clean = F.coalesce("text", F.lit(""))
    for mark in (BEGIN, END):
        clean = F.replace(clean, F.lit(mark), F.lit(mark.replace("|", "| ")))
    return F.concat(F.lit(BEGIN), F.coalesce("role", F.lit("unknown")), F.lit("\n"), clean, F.lit(END + "\n"))


def render(turns: DataFrame) -> DataFrame:
    """``(conv_id, part, n_turns, text)`` of each maximal conversation; parts are numbered from 0 by their turns."""
    parts = maximal(turns).withColumn("line", F.struct("pos", _line().alias("line"))).groupBy("conv_id", "part").agg(
        F.count("*").alias("n_turns"), F.array_sort(F.collect_list("line")).alias("lines"))
    order = Window.partitionBy("conv_id").orderBy("part")
    return parts.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("part"), "n_turns",
                        F.array_join("lines.line", "").alias("text"))


#: The same rows from the whole turn lists.
SQL = """
WITH t AS (
  SELECT conv_id, coalesce(CAST(floor(turn / 256.0) AS BIGINT), -1099511627776) AS part,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos, role, text
  FROM conversations),
lists AS (
  SELECT conv_id, list({'r': coalesce(role, chr(0)), 't': coalesce(text, chr(0))} ORDER BY pos) AS turns FROM t GROUP BY conv_id),
firsts AS (SELECT min(conv_id) AS conv_id, turns FROM lists GROUP BY turns),
prefixes AS (SELECT DISTINCT turns[1:k] AS turns FROM lists, unnest(range(1, len(turns))) AS u(k)),
kept AS (SELECT conv_id FROM firsts WHERE turns NOT IN (SELECT turns FROM prefixes)),
parts AS (
  SELECT conv_id, part, count(*) AS n_turns,
         string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10)
                    || replace(replace(coalesce(text, ''), '<|im_start|>', '<| im_start| >'), '<|im_end|>', '<| im_end| >')
                    || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
  FROM t WHERE conv_id IN (SELECT conv_id FROM kept) GROUP BY conv_id, part)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part) - 1 AS part, n_turns, text FROM parts
"""
