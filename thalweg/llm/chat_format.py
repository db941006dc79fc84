"""Chat formatting: collapse cumulative snapshots, then render what remains.

Logs often hold a conversation again and again as it grows.  Each turn has a digest of its place, role
and text; the rolling hash of a prefix is the exclusive-or of its digests (120 bits).  A conversation
whose hash equals a proper prefix of another, longer one is a snapshot of it and goes, by an anti-join
on (length, hash).  Of equal conversations the smallest id stays.  DataFrame functions only.

Turns are dealt by (conversation, block of ``BLOCK`` turn numbers), so a conversation with a third of
all turns spreads over tasks: ranks and hashes are built within blocks and carried across them by the
totals of the blocks.  A rendered conversation has one row per block, nearly always one.

Order: turn, role, text, nulls first.  Rows equal in all four columns count once.  A row without
conversation id belongs to no conversation and isn't rendered.  A null role renders as ``unknown``, a
null text as nothing; both equal themselves only.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.llm.common import stored
from thalweg.llm.registry import query, table

BLOCK = 256
OPEN, CLOSE = "<|{}|>\n", "\n<|end|>\n"


def _digest(*cols):
    """Two 60-bit halves of a digest over typed, length-marked columns."""
    parts = [F.coalesce(F.concat(F.char_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in cols]
    hexed = F.sha2(F.concat(*parts), 256)
    return [F.conv(F.substring(hexed, a, 15), 16, 10).cast("long") for a in (1, 17)]


def turns(chats: DataFrame, block: int = BLOCK) -> DataFrame:
    """Distinct turns with their block and their place within it (from 1)."""
    rows = chats.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    ).filter(F.col("conv_id").isNotNull())
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / F.lit(block)), F.lit(-(1 << 62)).cast("long")))
    w = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    same = F.col("turn").eqNullSafe(F.lag("turn").over(w)) & F.col("role").eqNullSafe(F.lag("role").over(w)) & F.col("text").eqNullSafe(F.lag("text").over(w))
    rows = rows.withColumn("new", (F.row_number().over(w) == 1) | ~same).filter("new").drop("new")
    return rows.withColumn("place", F.row_number().over(w))


def prefixes(chats: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, block, pos, a, b): the rolling hash of every prefix; ``pos`` counts turns from 1."""
    placed = turns(chats, block).select("conv_id", "block", "place", *[c.alias(n) for c, n in zip(_digest(F.col("role"), F.col("text")), "xy", strict=True)])
    totals = placed.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("n0"))
    at = placed.join(first, ["conv_id", "block"]).withColumn("pos", F.col("n0") + F.col("place"))
    at = at.select("conv_id", "block", "pos", *[c.alias(n) for c, n in zip(_digest(F.col("pos"), F.col("x"), F.col("y")), "de", strict=True)])
    upto = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = at.select("conv_id", "block", "pos", *[F.bit_xor(c).over(upto).alias(n) for c, n in (("d", "a"), ("e", "b"))])
    ends = rolled.groupBy("conv_id", "block").agg(F.max_by(F.struct("a", "b"), "pos").alias("e"))
    carried = ends.select("conv_id", "block", *[F.coalesce(F.bit_xor(f"e.{n}").over(before), F.lit(0)).alias(f"{n}0") for n in "ab"])
    joined = rolled.join(carried, ["conv_id", "block"])
    return joined.select("conv_id", "block", "pos", *[F.col(n).bitwiseXOR(F.col(f"{n}0")).alias(n) for n in "ab"])


def maximal(hashes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): conversations that aren't a prefix of a longer one, one of each equal lot."""
    whole = hashes.groupBy("conv_id").agg(F.max_by(F.struct("a", "b"), "pos").alias("h"), F.max("pos").alias("pos"))
    lots = whole.groupBy("pos", "h.a", "h.b").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = hashes.join(whole.select("conv_id", F.col("pos").alias("last")), "conv_id").filter("pos < last")
    proper = inner.groupBy("pos", "a", "b").agg(F.count("*").alias("seen"))
    return lots.join(proper, ["pos", "a", "b"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"), "copies")


def render(chats: DataFrame, keep: DataFrame, blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, part, n_turns, copies, text) of the kept conversations, one part per block of turns."""
    parts = blocks.join(keep, "conv_id").withColumn("part", F.row_number().over(Window.partitionBy("conv_id").orderBy("block")) - 1)
    shown = F.concat(F.format_string(OPEN.replace("{}", "%s"), F.coalesce("role", F.lit("unknown"))), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    # The turns are already dealt by (conversation, block): neither the join nor the grouping deals them again.
    rows = turns(chats, block).join(parts, ["conv_id", "block"])
    lines = rows.groupBy("conv_id", "block", "part", "n_turns", "copies").agg(F.sort_array(F.collect_list(F.struct("place", shown.alias("t")))).alias("l"))
    return lines.select("conv_id", "part", "n_turns", "copies", F.concat_ws("", F.transform("l", lambda x: x.t)).alias("text"))


def format_chats(chats: DataFrame, block: int = BLOCK) -> DataFrame:
    """The whole operator: hashes, collapse, rendering."""
    hashes = stored(prefixes(chats, block), "chat-prefixes")
    return render(chats, maximal(hashes), hashes.select("conv_id", "block").distinct(), block)


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS l,
    string_agg(concat('<|', coalesce(role, 'unknown'), '|>', chr(10), coalesce(text, ''), chr(10), '<|end|>', chr(10)), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS text
  FROM t GROUP BY conv_id),
lots AS (SELECT l, n, min(conv_id) AS conv_id, count(*) AS copies, min(text) AS text FROM c GROUP BY l, n),
proper AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, n)) AS k FROM lots))
SELECT conv_id, CAST(0 AS INTEGER) AS part, n AS n_turns, copies, text FROM lots WHERE l NOT IN (SELECT l FROM proper)"""


@query("op2_chat_format", ORACLE)
def chat_format(spark, sf):
    """Every maximal conversation, rendered."""
    return format_chats(table(spark, sf, "conversations"))
