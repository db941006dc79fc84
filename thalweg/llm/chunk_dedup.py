"""Substring deduplication by content-defined chunks of word runs, exact to the word.

A passage is a stretch of bytes that begins and ends with whole words and comes up more than once; it
counts from ``words`` words on.  A passage of over 50 words whose first and last word are glued to others
still has 49 whole ones.  All that matters is settled by runs of exactly ``words`` words with the blanks
between them: a run that comes up twice is repeated, neighbouring repeated runs make up a passage.

Runs aren't listed; they are taken by the chunk.  Of the ends of every ``gram`` words within a run, the
one with the least gear hash is the run's cut.  It depends on the run's words alone, so copies of a run
have it at the same word wherever they lie.  Neighbouring runs with one cut are a chunk, so each run is in
one chunk and none is missed.  A chunk's name is the digest of the ``gram`` words that end at the cut, and
its class is the digest of all its words.

Names that come up twice are counted first; only their chunks go on.  Where all chunks of a name are of one
class, that class settles all their runs at once.  Other names lie at the end of a passage or by an edited
word: there one chunk of each class gets a row per run, with a 128-bit digest, and runs are counted over
the classes.  So the rows follow the chunks (some ten runs each) and the different texts, not the words
or the copies.

Counting is combined on the map side; rows meet their counts, which are stored first, in a join whose other
side has few rows per digest, so a run that a third of all texts hold can be split.  Texts are read for the names, the chunks
and the single runs; should the table give other rows in between, the job stops.  Each row is a text of its
own, also if it repeats another.  Null, empty and short texts hold no passages.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.llm.common import SPACES, mix, stored, texts
from thalweg.llm.registry import query, table


class Passages(NamedTuple):
    words: int = 49
    gram: int = 25


class Cuts(NamedTuple):
    least: int = 8
    most: int = 256
    words: int = 20


BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
BLANK = np.isin(np.arange(256), list(SPACES.encode()))

GEAR = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)
MASK = np.uint32(0b11111 << 20)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash of the 16 bytes up to each byte."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    return h


def cuts(data: np.ndarray, options: Cuts) -> np.ndarray:
    """Ends of content-defined chunks of a byte array, the last one its length.  Passages don't rest on them: a chunk cut into at a passage's end is lost."""
    n = len(data)
    found = np.flatnonzero((gear(data) & MASK) == 0) + 1
    if len(found):
        found = found[np.diff(found, prepend=-options.least) >= options.least]
    ends = np.append(found[found < n], n)
    begins = np.append(0, ends[:-1])
    if (ends - begins).max() > options.most:
        pieces = -(-(ends - begins) // options.most)
        index = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        ends = np.minimum(np.repeat(begins, pieces) + (index + 1) * options.most, np.repeat(ends, pieces))
    return ends


def spread(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text's begin, one more at the end."""
    text = text.cast(pa.large_string())
    at = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[at[0] : at[-1]] if len(text) else np.zeros(0, np.uint8)
    return data, at - at[0]


def split(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a text column: (begins, ends) in bytes of their text, (digests of the words with the blanks behind
    them, digests without), two rows of 64 bits each, and where each text's words begin, one more at the end."""
    data, at = spread(text)
    dark = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins = np.flatnonzero(dark & (edge[:-1] | ~np.append(False, dark[:-1])))
    ends = np.flatnonzero(dark & (edge[1:] | ~np.append(dark[1:], False))) + 1
    # The blanks behind a text's last word may be the next text's; no run goes on from there.
    units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data)])
    coded = units.dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    digest = lambda made: np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, made)), ">u8").astype(np.uint64).reshape(-1, 2).T[:, codes]
    offsets = np.searchsorted(begins, at)
    start = np.repeat(at[:-1], np.diff(offsets))
    return begins - start, ends - start, digest(distinct), digest([u.rstrip(SPACES.encode()) for u in distinct]), offsets


def runs(units: np.ndarray, last: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of every ``n`` words in a row: ``n - 1`` of ``units`` and one of ``last``, put together by doubling."""
    size = max(0, len(units) - n + 1)
    out, done = np.zeros(size, np.uint64), 0
    power, step = units, 1
    while size and step <= n - 1:
        if (n - 1) & step:
            out = out * np.uint64(pow(base, step, 1 << 64)) + power[done : done + size]
            done += step
        power = power[: max(0, len(power) - step)] * np.uint64(pow(base, step, 1 << 64)) + power[step:]
        step *= 2
    return mix(out * np.uint64(base) + last[n - 1 : n - 1 + size])


def extremes(values: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``n`` values in a row."""
    step = 1
    while 2 * step <= n:
        values = pick(values[: max(0, len(values) - step)], values[step:])
        step *= 2
    rest = n - step
    return pick(values[: max(0, len(values) - rest)], values[rest:])


def whole(offsets: np.ndarray, n: int) -> np.ndarray:
    """For every place that ``n`` words can follow: whether they are one text's."""
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(offsets[-1])
    return left[: max(0, len(left) - n + 1)] >= n


class Chunks(NamedTuple):
    """Chunks of a batch: their text, first run and number of runs, bytes from the first run's begin to the last
    one's end, name and class; and of all words where they begin and end and where each text's begin, and two
    digests of the run that begins there."""

    doc: np.ndarray
    place: np.ndarray
    size: np.ndarray
    length: np.ndarray
    name: np.ndarray
    kind: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    runs: list[np.ndarray]


def chunked(text: pa.Array, options: Passages) -> Chunks:
    """The chunks of a text column; ``place`` counts words of the batch."""
    begins, ends, units, last, offsets = split(text)
    ok = whole(offsets, options.words)
    two = [runs(units[k], last[k], options.words, BASES[k]) for k in (0, 1)]
    if not ok.any():
        none = np.zeros(0, np.int64)
        return Chunks(none, none, none, none, none.view(np.uint64), none.view(np.uint64), begins, ends, offsets, two)
    data, at = spread(text)
    closes = (ends + np.repeat(at[:-1], np.diff(offsets)))[options.gram - 1 :] - 1
    # The place below the hash: of equal hashes the first counts.
    keys = (gear(data)[closes].astype(np.uint64) << np.uint64(32)) | np.arange(len(closes), dtype=np.uint64)
    least = extremes(keys, options.words - options.gram + 1, np.minimum) & np.uint64(0xFFFFFFFF)
    cut = np.where(ok, least.astype(np.int64), -1)
    edge = cut[1:] != cut[:-1]
    first, final = np.flatnonzero(np.append(True, edge) & ok), np.flatnonzero(np.append(edge, True) & ok)
    size = final - first + 1
    name = runs(units[0], last[0], options.gram, BASES[0])[cut[first]]
    kind = mix(mix(two[0][first] + size.astype(np.uint64)) + two[1][final])
    doc = np.searchsorted(offsets, first, "right") - 1
    return Chunks(doc, first, size, ends[final + options.words - 1] - begins[first], name, kind, begins, ends, offsets, two)


def names(docs: DataFrame, options: Passages) -> DataFrame:
    """(h): the name of every chunk."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(chunked(batch.column("text"), options).name.view(np.int64))], names=["h"])

    return docs.select("text").mapInArrow(run, "h long")


def chunks(docs: DataFrame, options: Passages) -> DataFrame:
    """(row_id, doc_id, at, extent, h, d): all chunks with name and class.  ``at``: the first run's place and byte,
    ``extent``: the number of runs and bytes, two numbers of 32 bits each, as all of these rows are shuffled."""

    def run(batches):
        for batch in batches:
            c = chunked(batch.column("text"), options)
            place = c.place - c.offsets[c.doc]
            own = [batch.column(k).take(pa.array(c.doc)) for k in ("row_id", "doc_id")]
            made = [place << 32 | c.begins[c.place], c.size << 32 | c.length, c.name.view(np.int64), c.kind.view(np.int64)]
            yield pa.RecordBatch.from_arrays([*own, *map(pa.array, made)], names=["row_id", "doc_id", "at", "extent", "h", "d"])

    return docs.select("row_id", "doc_id", "text").mapInArrow(run, "row_id long, doc_id long, at long, extent long, h long, d long")


def windows(docs: DataFrame, options: Passages) -> DataFrame:
    """(row_id, place, k, from, to, n, hi, lo): every run of the chunks in ``marks``, the ``k``-th of the chunk at
    ``place``, with its bytes counted from the chunk's begin."""

    def run(batches):
        for batch in batches:
            c, marks = chunked(batch.column("text"), options), batch.column("marks")
            doc = np.repeat(np.arange(len(marks)), np.diff(np.asarray(marks.offsets)))
            place, n, h, d = (x.to_numpy(zero_copy_only=False) for x in marks.flatten().flatten())
            which = np.searchsorted(c.place, place + c.offsets[doc])
            known = which < len(c.place)
            if not known.all() or (c.name.view(np.int64)[which] != h).any() or (c.kind.view(np.int64)[which] != d).any():
                raise RuntimeError("the documents were read twice and gave other rows the second time")
            size = c.size[which]
            k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            first = np.repeat(c.place[which], size)
            bytes_ = [c.begins[first + k] - c.begins[first], c.ends[first + k + options.words - 1] - c.begins[first]]
            made = [np.repeat(place, size), k.astype(np.int32), *bytes_, np.repeat(n, size), *(x[first + k].view(np.int64) for x in c.runs)]
            rows = batch.column("row_id").take(pa.array(np.repeat(doc, size)))
            yield pa.RecordBatch.from_arrays([rows, *map(pa.array, made)], names=["row_id", "place", "k", "from", "to", "n", "hi", "lo"])

    return docs.select("row_id", "text", "marks").mapInArrow(run, "row_id long, place int, k int, from long, to long, n long, hi long, lo long")


def settled(classes: DataFrame, rows: DataFrame, options: Passages) -> DataFrame:
    """(h, d, k, z, from, to, n, keeper, shift): the repeated runs ``k`` up to ``z`` of each class, as far as they
    come up equally often and first in one stretch of a row, whose place is ``k + shift``."""
    mixed = classes.filter("kinds > 1")
    marks = mixed.groupBy("row_id").agg(F.collect_list(F.struct("place", "n", "h", "d")).alias("marks"))
    made = stored(windows(rows.join(marks, "row_id"), options), "windows")
    counts = made.groupBy("hi", "lo").agg(F.sum("n").alias("total"), F.min(F.struct("row_id", (F.col("place") + F.col("k")).alias("place"))).alias("keeper")).filter("total > 1")
    hit = made.drop("n").join(stored(counts, "counts"), ["hi", "lo"]).select(
        "row_id", "place", "k", "from", "to", F.col("total").alias("n"), F.col("keeper.row_id").alias("keeper"), (F.col("keeper.place") - F.col("k")).alias("shift")
    )
    alike = ["row_id", "place", "n", "keeper", "shift"]
    island = hit.withColumn("island", F.col("k") - F.row_number().over(Window.partitionBy("row_id", "place").orderBy("n", "keeper", "shift", "k")))
    parts = island.groupBy(*alike, "island").agg(F.min("k").alias("k"), F.max("k").alias("z"), F.min("from").alias("from"), F.max("to").alias("to"))
    columns = ["h", "d", "k", "z", "from", "to", "n", "keeper", "shift"]
    single = classes.filter("kinds = 1").select(
        "h", "d", F.lit(0).alias("k"), (F.col("size") - 1).alias("z"), F.lit(0).cast("long").alias("from"), F.col("length").alias("to"), "n", F.col("row_id").alias("keeper"), F.col("place").alias("shift")
    )
    return mixed.select("row_id", "place", "h", "d").join(parts, ["row_id", "place"]).select(*columns).unionByName(single)


def repeated_windows(docs: DataFrame, options: Passages) -> DataFrame:
    """(row_id, doc_id, place, last, begin, end, n, first): every run of ``words`` words that comes up more than once,
    as stretches of runs that begin at the words ``place`` up to ``last`` and share ``n`` and whether they are the ``first``."""
    rows = texts(docs).withColumn("row_id", F.monotonically_increasing_id())
    again = stored(names(rows, options).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "again")
    found = stored(chunks(rows, options).join(again, "h"), "chunks")
    high, low = (lambda c: F.shiftright(c, 32).cast("int")), (lambda c: F.col(c).bitwiseAND(F.lit((1 << 32) - 1)))
    # Chunks of one class and row differ in their places, which are the upper bits.
    classes = found.groupBy("h", "d").agg(F.count("*").alias("n"), F.min(F.struct("row_id", "at")).alias("keeper"), F.min("extent").alias("extent"))
    kinds = stored(found.select("h", "d").distinct().groupBy("h").agg(F.count("*").alias("kinds")), "kinds")
    known = stored(classes.join(kinds, "h").select("h", "d", "n", "kinds", "keeper.row_id", high("keeper.at").alias("place"), high("extent").alias("size"), low("extent").alias("length")), "classes")
    at, begin = high("at"), low("at")
    return found.drop("extent").join(settled(known, rows, options), ["h", "d"]).select(
        "row_id", "doc_id", (at + F.col("k")).alias("place"), (at + F.col("z")).alias("last"), (begin + F.col("from")).alias("begin"), (begin + F.col("to")).alias("end"),
        "n", ((F.col("row_id") == F.col("keeper")) & (at == F.col("shift"))).alias("first"),
    )


def repeated_passages(docs: DataFrame, options: Passages = Passages()) -> DataFrame:
    """(doc_id, begin, end, n_words, n_copies, first): passages found more than once, whose offsets are UTF-8 bytes.

    ``n_copies``: the fewest occurrences among its runs.  ``first``: its runs come up here first, so it is
    the one to keep.  A passage is split where that changes; words that a run covers which isn't first belong
    to the part that isn't.  Each of those has an equal word at the run's first place, further to the front,
    so when all that isn't first is removed, every word of a repeated run stays in one place, and of each
    run at most one copy.  Of what is first, a rest below ``words`` words is kept without a row of its own.
    """
    hit = repeated_windows(docs, options)
    # Repeated runs at neighbouring places of one text, as far as all or none of them are first: less all runs up to
    # its own, a stretch's last place is the same along them.
    size = F.sum(F.col("last") - F.col("place") + 1).over(Window.partitionBy("row_id", "first").orderBy("place"))
    island = hit.withColumn("island", F.col("last") - size)
    made = island.groupBy("row_id", "doc_id", "first", "island").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("place").alias("a"), (F.max("last") + options.words).alias("z"), F.min("n").alias("n_copies")
    )
    # The copies before and behind, as words and bytes.
    copy = lambda *x: F.when(~F.col("first"), F.struct(*x))
    side = lambda order: Window.partitionBy("row_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    beside = made.withColumn("before", F.last(copy("z", "end"), True).over(side(F.col("a")))).withColumn("behind", F.last(copy("a", "begin"), True).over(side(F.col("a").desc())))
    cut = lambda own, other, pick: F.when(F.col("first"), pick(own, other)).otherwise(F.col(own))
    parts = beside.select(
        "doc_id", cut("begin", "before.end", F.greatest).alias("begin"), cut("end", "behind.begin", F.least).alias("end"),
        (cut("z", "behind.a", F.least) - cut("a", "before.z", F.greatest)).cast("long").alias("n_words"), "n_copies", "first",
    )
    return parts.filter(F.col("n_words") >= options.words)


@query("op6_substring_dedup")
def substring_dedup(spark, sf):
    """Every occurrence of every repeated passage."""
    return repeated_passages(table(spark, sf, "documents"))
