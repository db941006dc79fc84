"""Mixing sources by temperature.

A source's share of all tokens is raised to an exponent between 0 (all sources alike) and 1 (as they
are) and normalised.  The exponent comes from a bisection towards a target: a normalised entropy, or
the most often that a source may be repeated.  The weights then turn into tokens of a budget, and those
into whole passes over a source plus a part of one more.  A pass is a permutation of the source's
blocks; the part takes blocks in that order while they fit and, of the block that no longer does,
documents in a hashed order while they fit.  DataFrame functions only.

Documents are dealt to a fixed number of blocks by a hash, so sums are combined on the map side and no
task ever holds a source.  The block at the edge of the budget is cut into ranges of the hash by its
number of documents; their sums find the range at the edge, some thousand documents, and only that is ordered.

Tokens are words.  A null source is a source of its own.  A text without words weighs nothing and comes
with every whole pass; a source without any comes once.  Repeated rows are documents of their own.
The draw is fixed by ``seed``, the rows and their ids.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.llm.common import packed, sql_words, stored, unpacked
from thalweg.llm.registry import query, table


class Mix(NamedTuple):
    """``target`` is "entropy" (as a share of the highest) or "repeats" (most passes over a source); ``budget`` in tokens, none: as many as there are."""

    target: str = "repeats"
    value: float = 2.0
    budget: int | None = None
    blocks: int = 1024
    seed: int = 17


#: The interval is cut in this many parts per pass over the sources, this many times: 2**-40 at the end.
CUTS, PASSES = 32, 8
#: A range of a block holds about so many documents.
RANGE_DOCS = 4096


def weighed(docs: DataFrame, mix: Mix = Mix(), id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """``docs`` with its tokens, source and block, under names that ``docs`` must not have; ``draw`` packs its rows first."""
    tokens = F.size(sql_words(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).cast("long")
    order = F.xxhash64(F.lit(mix.seed), F.col(id_col), F.col(text_col))
    return docs.withColumns({"_tokens": tokens, "_source": F.col(source_col).cast("string"), "_order": order}).withColumn("_block", F.pmod("_order", F.lit(mix.blocks)).cast("int"))


def _at(sources: DataFrame, total: int, budget: int, exponents: list[float], target: str) -> dict[float, float]:
    """The target's measure at several exponents: one pass over the sources, combined on the map side."""
    share = F.col("tokens") / F.lit(float(total))
    rows = sources.filter("tokens > 0").select("tokens", share.alias("p"), F.explode(F.array(*[F.lit(float(a)) for a in exponents])).alias("a"))
    z = F.sum(F.pow("p", "a"))
    if target == "entropy":  # of w = p^a / z: log z - a * sum(p^a log p) / z
        made = F.log(z) - F.col("a") * F.sum(F.pow("p", "a") * F.log("p")) / z
    else:  # the most passes: budget * p^a / z / tokens, decreasing in tokens as a <= 1
        made = F.max(F.pow("p", "a") / F.col("tokens")) * F.lit(float(budget)) / z
    return {r["a"]: r["m"] for r in rows.groupBy("a").agg(made.alias("m")).collect()}


def exponent(sources: DataFrame, mix: Mix) -> float:
    """The exponent that meets the target: the largest for an entropy, the smallest for a limit of repeats.

    Both measures fall as the exponent grows.  Where even an end of [0, 1] doesn't meet the target that end is taken.
    ``sources``: (source, tokens).  Only numbers come to the driver.
    """
    total, n = sources.agg(F.sum("tokens"), F.count(F.when(F.col("tokens") > 0, 1))).first()
    if not total or n < 2:
        return 1.0
    goal = mix.value * math.log(n) if mix.target == "entropy" else mix.value
    budget = total if mix.budget is None else mix.budget
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        grid = [low + (high - low) * k / CUTS for k in range(CUTS + 1)]
        at = sorted(_at(sources, total, budget, grid, mix.target).items())
        above = [a for a, m in at if m > goal]
        if not above:
            return low
        if len(above) == len(at):
            return high
        k = len(above)
        low, high = at[k - 1][0], at[k][0]
    return low if mix.target == "entropy" else high


def plan(sources: DataFrame, mix: Mix) -> DataFrame:
    """(source, tokens, weight, want, passes, rest): the budget's tokens of each source and how they are made up.

    A source without tokens takes nothing of the budget: it has one pass.
    """
    alpha = exponent(sources, mix)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    share = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(alpha))
    with_tokens = sources.filter("tokens > 0").withColumn("_p", share)
    z = with_tokens.agg(F.sum("_p")).first()[0] or 1.0
    budget = float(total if mix.budget is None else mix.budget)
    want = with_tokens.withColumn("weight", F.col("_p") / F.lit(z)).withColumn("want", F.floor(F.col("weight") * F.lit(budget)))
    passes = F.floor(F.col("want") / F.col("tokens"))
    made = want.select("source", "tokens", "weight", "want", passes.alias("passes"), (F.col("want") - passes * F.col("tokens")).alias("rest"))
    none = F.lit(0).cast("long")
    return made.unionByName(sources.filter("tokens = 0").select("source", "tokens", F.lit(0.0).alias("weight"), none.alias("want"), F.lit(1).cast("long").alias("passes"), none.alias("rest")))


def draw(docs: DataFrame, mix: Mix = Mix(), id_col="doc_id", text_col="text", source_col="source", range_docs: int = RANGE_DOCS, marks: bool = True) -> DataFrame:
    """The mixture: rows of ``docs``, all columns, with ``_pass``, ``_place`` (0 to 1 within the source's pass), ``_tokens``.

    A column of ``docs`` of one of these three names gives way to it; without ``marks`` there are the columns of ``docs`` alone.
    Ordering by (_pass, _place) blends the sources; every stretch then holds them near their weights.
    """
    slim = docs.select(packed(docs).alias("row"), F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    rows = weighed(slim, mix, "_id").drop("text", "source")
    blocks = stored(rows.groupBy("_source", "_block").agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs")), "mix-blocks")
    sources = stored(blocks.groupBy(F.col("_source").alias("source")).agg(F.sum("tokens").alias("tokens")), "mix-sources")
    planned = stored(plan(sources, mix), "mix-plan")
    # Where the last, partial pass ends among the blocks: at most ``mix.blocks`` rows per source are ordered.
    shuffled = F.xxhash64(F.lit(mix.seed), F.col("_source"), F.col("_block"), F.col("passes"))
    w = Window.partitionBy("_source").orderBy("_shuffled", "_block")
    edges = (
        blocks.withColumnRenamed("tokens", "held").join(planned, F.col("_source").eqNullSafe(F.col("source")))
        .withColumn("_shuffled", shuffled).withColumn("_upto", F.sum("held").over(w))
        .select(
            F.col("_source").alias("_s"), F.col("_block").alias("_b"), "passes", F.col("docs").alias("_docs"),
            (F.col("rest") - F.col("_upto") + F.col("held")).alias("_left"),
            F.when(F.col("tokens") == 0, -1).when(F.col("_upto") <= F.col("rest"), 1).when(F.col("_upto") - F.col("held") < F.col("rest"), 0).otherwise(-1).alias("_fit"),
        )
    )
    edges = stored(edges, "mix-edges")
    joined = rows.join(edges, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
    # The edge block's documents come in the hash's order; ranges of the hash are summed first.
    largest = edges.filter("_fit = 0").agg(F.max("_docs")).first()[0] or 0
    n_ranges = -(-largest // range_docs) or 1
    high = F.shiftright("_order", 32) + F.lit(1 << 31)
    joined = joined.withColumn("_range", F.when(F.col("_fit") == 0, F.shiftright(high * F.lit(n_ranges), 32)))
    held = joined.filter("_fit = 0").groupBy("_s", "_b", "_left", "_range").agg(F.sum("_tokens").alias("_held"))
    upto = held.withColumn("_upto", F.sum("_held").over(Window.partitionBy("_s", "_b").orderBy("_range")))
    state = F.when(F.col("_upto") <= F.col("_left"), 1).when(F.col("_upto") - F.col("_held") <= F.col("_left"), 0).otherwise(-1)
    ranges = stored(upto.select(F.col("_s").alias("_rs"), F.col("_b").alias("_rb"), F.col("_range").alias("_r"), state.alias("_inside"), (F.col("_left") - F.col("_upto") + F.col("_held")).alias("_over")), "mix-ranges")
    same = F.col("_s").eqNullSafe(F.col("_rs")) & (F.col("_b") == F.col("_rb")) & (F.col("_range") == F.col("_r"))
    joined = joined.join(ranges, same, "left").withColumn("_state", F.coalesce("_inside", "_fit"))
    inside = F.sum("_tokens").over(Window.partitionBy("_s", "_b", "_range").orderBy("_order", "_id").rowsBetween(Window.unboundedPreceding, 0))
    edge = joined.filter("_state = 0").withColumn("_more", (inside <= F.col("_over")).cast("long"))
    sure = joined.filter("_state <> 0").withColumn("_more", (F.col("_state") == 1).cast("long"))
    copies = sure.unionByName(edge).withColumn("_copies", F.col("passes") + F.col("_more")).filter("_copies > 0")
    drawn = copies.withColumn("_pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    # Blocks are permuted anew in each pass, documents within their block.
    spot = lambda *x: F.pmod(F.xxhash64(F.lit(mix.seed), *x), F.lit(1 << 20)) / F.lit(float(1 << 20))
    place = (F.floor(spot(F.col("_s"), F.col("_b"), F.col("_pass")) * mix.blocks) + spot(F.col("_order"), F.col("_pass"))) / F.lit(float(mix.blocks))
    if not marks:
        return drawn.select(*unpacked(docs.columns))
    own = ("_pass", "_place", "_tokens")
    kept = [c for name, c in zip(docs.columns, unpacked(docs.columns), strict=True) if name not in own]
    return drawn.withColumn("_place", place).select(*kept, *own)


@query("op3_mixing")
def mixing(spark, sf):
    """One budget's worth of documents, no source more than twice over."""
    drawn = draw(table(spark, sf, "documents"), Mix())
    return drawn.select("doc_id", "source", F.col("_pass").alias("pass"), F.col("_place").alias("place"), F.col("_tokens").alias("n_tokens"))
