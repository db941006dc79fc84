"""Importance resampling towards a target distribution: hashed n-gram weights, then a distributed radix sort.

Features of a text are its runs of one to three words, hashed into buckets.  A bucket's gain is the
log ratio of its smoothed share in the target and in the corpus, as a whole number of thousandths, and
a text's weight is the sum of its features' gains, added up over arrays.  Weight plus Gumbel noise drawn
from the row's id is its score, so taking the highest scores samples without replacement in proportion
to the exponentiated weights.

Ranks come from a least-significant-digit radix sort of the composite key (score falling, id rising).
Every row carries its position; a pass counts (block, digit), turns the counts into global offsets with
prefix sums over digits and over the blocks of a digit, and a row's next position is its offset plus the
number of rows of that digit before it in its block.  A block has a fixed number of positions, so no task
holds more than blocks of it, however the digits are spread.  Each pass is a table in the shared folder.

Null and empty texts, and those without a word, have no feature, weigh 0 and have a score; texts under
``least_words`` words are never drawn.  A null id is an empty text in the noise and comes last of its
score.  Repeated rows are scored alike and ranked one after the other; equal rows are interchangeable.
Very long texts are read whole.  Without a target or without documents the smoothing alone decides, and
an empty table gives an empty result.  Further columns, whatever their names, are carried in one struct.
"""

from __future__ import annotations

import math
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.llm.common import stored, texts, tokenised
from thalweg.llm.registry import query, table


class Draw(NamedTuple):
    buckets: int = 10_000
    longest: int = 3
    least_words: int = 20
    percent: int = 5
    seed: int = 42


class Sort(NamedTuple):
    digit_bits: int = 9
    block_rows: int = 2_048  # a power of two


POLY = 0xEDB88320
#: Bytes of a text as they count: A-Z small, all but digits, letters and bytes beyond ASCII a space.
PLAIN = np.full(256, 32, np.uint8)
PLAIN[48:58] = np.arange(48, 58)
PLAIN[65:91] = np.arange(97, 123)
PLAIN[97:123] = np.arange(97, 123)
PLAIN[128:] = np.arange(128, 256)


def plain(text: pa.Array) -> pa.Array:
    """The texts with every byte that belongs to no word as a space."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string())
    _, ends, data = text.buffers()
    if data is None or not data.size:
        return text
    made = pa.py_buffer(PLAIN[np.frombuffer(data, np.uint8)].tobytes())
    return pa.LargeStringArray.from_buffers(len(text), ends, made, offset=text.offset)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials over GF(2) modulo that of the checksum; bit 31 is the constant term."""
    out = np.zeros_like(a)
    b = b.copy()
    for k in range(31, -1, -1):
        out ^= np.where((a >> np.uint32(k)) & np.uint32(1), b, np.uint32(0))
        b = (b >> np.uint32(1)) ^ np.where(b & np.uint32(1), np.uint32(POLY), np.uint32(0))
    return out


def shifts(lengths: np.ndarray) -> np.ndarray:
    """For each length, four tables of 256: what a checksum becomes when so many bytes follow it, by its bytes."""
    power = np.full(len(lengths), 1 << 31, np.uint32)
    square = np.full(len(lengths), 1 << 23, np.uint32)  # x to the 8th: one byte
    left = lengths.astype(np.int64)
    while (left > 0).any():
        power = np.where(left & 1, _times(power, square), power)
        square, left = _times(square, square), left >> 1
    basis = np.zeros((len(lengths), 32), np.uint32)
    for k in range(31, -1, -1):
        basis[:, k] = power
        power = (power >> np.uint32(1)) ^ np.where(power & np.uint32(1), np.uint32(POLY), np.uint32(0))
    out = np.zeros((len(lengths), 4, 256), np.uint32)
    for part in range(4):
        for k in range(8):
            out[:, part, 1 << k : 2 << k] = out[:, part, : 1 << k] ^ basis[:, 8 * part + k, None]
    return out


def joined(first: np.ndarray, second: np.ndarray, kind: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Checksums of two strings one after the other; ``by[kind]`` is the table of the second one's length."""
    byte = np.uint32(255)
    out = second ^ by[kind, 0, first & byte]
    for part in (1, 2, 3):
        out ^= by[kind, part, (first >> np.uint32(8 * part)) & byte]
    return out


def features(text: pa.Array, options: Draw = Draw()):
    """(by length of run: the buckets of all runs and the text each lies in, rising; words of every text)."""
    codes, words, offsets = tokenised(plain(text), lower=False)
    raw = words.cast(pa.large_binary()).to_pylist()
    alone = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
    sizes, kind = np.unique(np.fromiter(map(len, raw), np.int64, len(raw)), return_inverse=True)
    spaced = joined(np.full(len(raw), zlib.crc32(b" "), np.uint32), alone, kind, shifts(sizes))
    by = shifts(sizes + 1)
    doc = np.repeat(np.arange(len(text)), np.diff(offsets))
    run, made = alone[codes], []
    for n in range(1, options.longest + 1):
        last = codes[n - 1 :]
        if n > 1:
            run = joined(run[: len(last)], spaced[last], kind[last], by)
        inside = doc[n - 1 :] == doc[: len(last)]
        made.append(((run[inside] % np.uint32(options.buckets)).astype(np.int64), doc[: len(last)][inside]))
    return made, np.diff(offsets)


def counts(rows: DataFrame, options: Draw = Draw()) -> np.ndarray:
    """How many features of all texts fall into each bucket; one row per bucket and task is shuffled."""

    def run(batches):
        seen = np.zeros(options.buckets, np.int64)
        for batch in batches:
            for bucket, _ in features(batch.column("text"), options)[0]:
                seen += np.bincount(bucket, minlength=options.buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    out = np.zeros(options.buckets, np.int64)
    for r in rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down, by bucket."""
    s, t, m = float(corpus.sum()), float(target.sum()), len(corpus)
    ratios = (1000 * math.log((b + 1.0) * (s + m) / ((a + 1.0) * (t + m))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True))
    return np.fromiter(map(math.floor, ratios), np.int64, m)


def weighed(rows: DataFrame, gain: np.ndarray, options: Draw = Draw()) -> DataFrame:
    """The columns of ``rows`` but the text, with (n_words, n_features, weight); no shuffle."""
    keep = [c for c in rows.columns if c != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches):
        for batch in batches:
            runs, words = features(batch.column("text"), options)
            number, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for bucket, owner in runs:
                at = np.searchsorted(owner, np.arange(batch.num_rows + 1))
                total = np.concatenate([[0], np.cumsum(shared.value[bucket])])
                number += np.diff(at)
                weight += np.diff(total[at])
            made = [pa.array(x.astype(np.int64)) for x in (words, number, weight)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], names=[*keep, "n_words", "n_features", "weight"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return rows.mapInArrow(run, f"{kinds}, n_words long, n_features long, weight long")


def noise(doc_id, seed: int):
    """Thousandths of a Gumbel draw that the id and the seed alone decide."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _part(rows: DataFrame, value, low: int | None, high: int | None, falling: bool):
    """(column, bits): the value as an unsigned number of as few bits as its range asks for; nulls after all others."""
    if low is None:
        return F.lit(0).cast("long"), 0
    bits = (high - low + 1).bit_length()
    if bits <= 62:
        return F.coalesce(F.lit(high) - value if falling else value - F.lit(low), F.lit(high - low + 1)).cast("long"), bits
    if rows.filter(value.isNull()).take(1):
        raise ValueError("ids that span all of 64 bits leave no room for a null one")
    flipped = value.bitwiseXOR(F.lit(-(1 << 63)))
    return F.bitwise_not(flipped) if falling else flipped, 64


def _block(position, how: Sort):
    return F.shiftright(position, how.block_rows.bit_length() - 1).alias("block")


def radix_ranks(rows: DataFrame, how: Sort = Sort()) -> DataFrame:
    """(place, rank) for (place, score, doc_id): ranks from 1 by falling score, then rising id.

    ``place`` identifies a row and is its first position; positions needn't be without gaps at first.
    """
    s0, s1, d0, d1 = rows.agg(F.min("score"), F.max("score"), F.min("doc_id"), F.max("doc_id")).first()
    low, low_bits = _part(rows, F.col("doc_id"), d0, d1, falling=False)
    high, high_bits = _part(rows, F.col("score"), s0, s1, falling=True)
    held = rows.select("place", F.col("place").alias("position"), _block(F.col("place"), how), low.alias("low"), high.alias("high"))
    for part, bits in (("low", low_bits), ("high", high_bits)):
        passes = -(-bits // how.digit_bits)
        width = -(-bits // passes) if passes else 0
        for k in range(passes):
            digit = F.shiftrightunsigned(part, k * width).bitwiseAND((1 << width) - 1)
            held = stored(_counting_pass(held.withColumn("digit", digit), how), "radix-pass")
    return held.select("place", (F.col("position") + 1).alias("rank"))


def _counting_pass(rows: DataFrame, how: Sort) -> DataFrame:
    """One stable counting sort by ``digit``: every row's next position, and the block that it lies in."""
    cells = stored(rows.groupBy("block", "digit").agg(F.count("*").alias("n")), "radix-cells")
    totals = cells.groupBy("digit").agg(F.sum("n").alias("n"))
    # At most two to the digit's bits rows: the only window without a key.
    first = totals.select("digit", (F.sum("n").over(Window.orderBy("digit")) - F.col("n")).alias("first"))
    before = F.sum("n").over(Window.partitionBy("digit").orderBy("block")) - F.col("n")
    offsets = cells.select("block", "digit", before.alias("before")).join(first, "digit").select("block", "digit", (F.col("first") + F.col("before")).alias("offset"))
    local = F.row_number().over(Window.partitionBy("block", "digit").orderBy("position")) - 1
    placed = rows.withColumn("local", local).join(offsets, ["block", "digit"]).withColumn("position", (F.col("offset") + F.col("local")).cast("long"))
    return placed.select("place", "position", _block(F.col("position"), how), "low", "high")


def resampled(rows: DataFrame, target: DataFrame, options: Draw = Draw(), how: Sort = Sort()) -> DataFrame:
    """Every row of (doc_id, text, …) without its text, with (n_words, n_features, weight, score, rank); ``target``: (text).

    Of the rows with enough words the given share with the highest scores is drawn; the rank of others is null.
    """
    gain = gains(counts(rows, options), counts(target, options))
    scored = weighed(rows, gain, options).withColumn("score", F.col("weight") + noise(F.col("doc_id"), options.seed))
    scored = stored(scored.withColumn("place", F.monotonically_increasing_id()), "weights")
    enough = scored.filter(F.col("n_words") >= options.least_words)
    ranks = radix_ranks(enough.select("place", "score", "doc_id"), how)
    drawn = ranks.filter(F.col("rank") <= F.lit(options.percent * enough.count() // 100))
    return scored.join(drawn.withColumnRenamed("place", "_place"), F.col("place") == F.col("_place"), "left").drop("place", "_place")


def draw(docs: DataFrame, target: DataFrame, options: Draw = Draw(), how: Sort = Sort()) -> DataFrame:
    """(row, weight, score, rank): the drawn rows of ``docs`` as structs of all their columns, with their text."""
    named = [f"c{k}" for k in range(len(docs.columns))]
    row = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, named, strict=True)]).alias("row")
    clean = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = resampled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean.alias("text"), row), texts(target, target.columns[0], "text"), options, how)
    back = F.struct(*[F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, named, strict=True)])
    return made.filter("rank IS NOT NULL").select(back.alias("row"), "weight", "score", "rank")


@query("op13_importance_resampling")
def importance_resampling(spark, sf):
    """Weight, score and rank of every document, drawn towards the benchmark's texts."""
    made = resampled(texts(table(spark, sf, "documents")), texts(table(spark, sf, "benchmark"), "item_id"))
    return made.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
