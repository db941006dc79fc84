"""Near-duplicate join: Jaccard similarity of word shingles, candidates pruned by Bayes' rule.

Texts are lower-cased (A-Z) and split into words; a shingle is five words (a shorter text is one).

1. Texts with equal sets of shingles are one node; copies are counted, never paired.
2. MinHash bands (40 of 6 values; a pair at 0.8 is missed with a chance of 5e-6) link nodes that share a
   band, by stars to the smallest node of the band.  Their components are the candidate groups.
3. A group is cut into blocks by set size and a hash.  Each pair of blocks whose sizes allow the
   similarity is one small task.  There MinHash values are compared 24 at a time; a pair goes as soon as
   the posterior chance (even prior) that it reaches the threshold is below ``tolerance``.  What is left
   is verified exactly on the sets.  A task gives the number of links of each node and a spanning forest
   of the links, so pairs are compared but never listed.
4. Components of the forests are the classes.

The result has one row per row of the input: the class, named by its smallest doc_id, and the number of
other rows with a similarity of at least the threshold.  A null or empty text has no shingle, is in no
class but its own and has no links.  Repeated rows are copies.  A null id is kept and names no class
while another id can.
"""

from __future__ import annotations

import math
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.common import groups, mix, packed, shingle_hashes, stored, texts, tokenised, unpacked, word_hashes
from thalweg.llm.components import components
from thalweg.llm.registry import query, table


class Join(NamedTuple):
    threshold: float = 0.8
    shingle: int = 5
    bands: int = 40
    rows: int = 6
    step: int = 24
    tolerance: float = 1e-6
    block: int = 512
    block_shingles: int = 1 << 20

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def family(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = mix(np.arange(1, 2 * n + 1, dtype=np.uint64)).astype(np.uint32)
    return base[:n] | np.uint32(1), base[n:]


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """MinHash values of non-empty sets, one row each; worked off in slices that stay in cache."""
    a, b = family(n)
    out = np.empty((len(sets), n), np.uint32)
    k = 0
    while k < len(sets):
        size, z = 0, k
        while z < len(sets) and (z == k or size + len(sets[z]) <= 1 << 15):
            size += len(sets[z])
            z += 1
        flat = mix(np.concatenate(sets[k:z])).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[k : z - 1]])]).astype(np.int64)
        room = np.empty_like(flat)
        for j in range(n):
            np.multiply(flat, a[j], out=room)
            np.add(room, b[j], out=room)
            out[k:z, j] = np.minimum.reduceat(room, starts)
        k = z
    return out


def shingle_sets(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    codes, words, offsets = tokenised(batch.column("text"))
    own = word_hashes(words)[codes]
    return [np.unique(shingle_hashes(own[a:z], n)) for a, z in zip(offsets[:-1], offsets[1:], strict=True)]


def _digest(s: np.ndarray) -> tuple[int, int]:
    two = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), ">i8")
    return int(two[0]), int(two[1])


def described(docs: DataFrame, options: Join = Join()) -> DataFrame:
    """(doc_id, text_hash, hi, lo, n, bands) of every text: digest and size of its set, keys of its bands."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch, options.shingle)
            full = [k for k, s in enumerate(sets) if len(s)]
            bands: list = [[]] * len(sets)
            if full:
                sig = signatures([sets[k] for k in full], options.hashes).reshape(len(full), options.bands, options.rows).astype(np.uint64)
                key = np.tile(np.arange(options.bands, dtype=np.uint64), (len(full), 1))
                for j in range(options.rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, j])
                for k, row in zip(full, key.astype(np.int64), strict=True):
                    bands[k] = row
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int32()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "hi", "lo", "n", "bands"],
            )

    rows = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, hi long, lo long, n int, bands array<long>")


def candidate_groups(nodes: DataFrame) -> DataFrame:
    """(node, root): nodes that share a band with another, by component."""
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter("n > 1").select("key", "low")
    return components(banded.join(shared, "key").select(F.col("node").alias("a"), F.col("low").alias("b")))


def block_pairs(grouped: DataFrame, options: Join = Join()) -> DataFrame:
    """(node, group, a, b, side): the block pairs a node takes part in.  ``grouped``: (node, root, n).

    ``side``: 0 first block, 1 second block, 2 the block with itself.  A block's number is its size class
    in the upper half and its share of the class in the lower.
    """
    small = grouped.groupBy("root").agg(F.count("*").alias("c"), F.sum("n").alias("s")).select("root", ((F.col("c") <= options.block) & (F.col("s") <= options.block_shingles)).alias("small"))
    # Neighbouring classes hold all partners: the classes are a little wider than the threshold allows.
    size_class = F.floor(F.log("n") / F.lit(math.log(1 / options.threshold) * 1.0001)).cast("long")
    rows = grouped.join(small, "root").withColumn("class", F.when(F.col("small"), F.lit(0).cast("long")).otherwise(size_class))
    shares = rows.groupBy("root", "class").agg(F.greatest(F.ceil(F.count("*") / F.lit(options.block)), F.ceil(F.sum("n") / F.lit(options.block_shingles))).cast("long").alias("k"))
    beside = lambda d, name: shares.select("root", (F.col("class") + d).alias("class"), F.col("k").alias(name))
    at = rows.join(shares, ["root", "class"]).join(beside(-1, "up"), ["root", "class"], "left").join(beside(1, "down"), ["root", "class"], "left")
    own = F.pmod(F.xxhash64("node"), F.col("k")).alias("own")
    number = lambda c, s: c * F.lit(1 << 31) + s
    c, me = F.col("class"), number(F.col("class"), F.col("own"))
    upto = lambda n: F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))
    pair = lambda a, b, side: F.struct(a.alias("a"), b.alias("b"), side.cast("int").alias("side"))
    here = F.transform(upto(F.col("k")), lambda s: pair(number(c, F.least(s, F.col("own"))), number(c, F.greatest(s, F.col("own"))), F.when(s == F.col("own"), 2).when(s > F.col("own"), 0).otherwise(1)))
    above = F.transform(upto(F.col("up")), lambda s: pair(me, number(c + 1, s), F.lit(0)))
    below = F.transform(upto(F.col("down")), lambda s: pair(number(c - 1, s), me, F.lit(1)))
    return at.select("node", F.col("root").alias("group"), "class", "k", "up", "down", own).select("node", "group", F.explode(F.concat(here, above, below)).alias("p")).select("node", "group", "p.*")


def floors(options: Join) -> list[tuple[int, int]]:
    """(values compared, fewest equal ones that keep a pair).

    With an even prior the similarity after m of n equal values is Beta(m + 1, n - m + 1), whose mass from
    t on is the chance of at most m successes in n + 1 draws of chance t.
    """
    t, out = options.threshold, []
    for n in [*range(options.step, options.hashes, options.step), options.hashes]:
        mass, m = 0.0, -1
        while mass < options.tolerance:
            m += 1
            mass += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def survivors(a: np.ndarray, b: np.ndarray, options: Join, itself: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) that Bayes' rule leaves."""
    if itself:
        i, j = np.triu_indices(len(a), 1)
    else:
        i, j = (x.ravel() for x in np.indices((len(a), len(b))))
    equal, done = np.zeros(len(i), np.int32), 0
    for n, least in floors(options):
        for at in range(0, len(i), 1 << 16):
            s = slice(at, at + (1 << 16))
            equal[s] += (a[i[s], done:n] == b[j[s], done:n]).sum(1, dtype=np.int32)
        keep = equal >= least
        i, j, equal, done = i[keep], j[keep], equal[keep], n
        if not len(i):
            break
    return i, j


def overlaps(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs.  Many pairs of few sets are counted by matrix products."""
    if len(i) <= 2 * (len(a) + len(b)):
        return np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], np.int64)
    flat = np.concatenate([*a, *b])
    owner = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in [*a, *b]])
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    column = (np.cumsum(shared) - 1)[code]
    keep = shared[code]
    owner, column = owner[keep], column[keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(a), len(b)), np.float32)  # exact: counts stay below 2**24
    for at in range(0, int(shared.sum()), 2048):
        lo, hi = np.searchsorted(column, (at, at + 2048))
        grid = np.zeros((len(a) + len(b), 2048), np.float32)
        grid[owner[lo:hi], column[lo:hi] - at] = 1
        total += grid[: len(a)] @ grid[len(a) :].T
    return total[i, j].astype(np.int64)


def verify(pairs: DataFrame, options: Join = Join()) -> DataFrame:
    """(node, links, partner) from (group, a, b, side, node, copies, shingles): counts of links, and a forest of them."""
    t = Fraction(str(options.threshold))

    def run(batches):
        for _, rows in groups(batches, "group", "a", "b"):
            side = rows.column("side").to_numpy()
            node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
            _, first = np.unique(np.stack([node, side]), axis=1, return_index=True)  # a repeated row may bring a set twice
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("shingles")]
            itself = bool((side == 2).any())
            left = [k for k in first if side[k] in (0, 2)]
            right = left if itself else [k for k in first if side[k] == 1]
            if not left or not right:
                continue
            a, b = [sets[k] for k in left], [sets[k] for k in right]
            sig = signatures(a, options.hashes)
            i, j = survivors(sig, sig if itself else signatures(b, options.hashes), options, itself)
            if not len(i):
                continue
            both = np.array([len(a[x]) + len(b[y]) for x, y in zip(i, j, strict=True)], np.int64)
            hit = overlaps(a, b, i, j) * (t.numerator + t.denominator) >= t.numerator * both
            i, j = i[hit], j[hit]
            if not len(i):
                continue
            left, right = np.asarray(left)[i], np.asarray(right)[j]
            links = np.zeros(len(side), np.int64)
            np.add.at(links, left, copies[right])
            np.add.at(links, right, copies[left])
            root = list(range(len(side)))

            def find(x, root=root):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            forest = []
            for x, y in zip(left.tolist(), right.tolist(), strict=True):
                p, q = find(x), find(y)
                if p != q:
                    root[p] = q
                    forest.append((x, y))
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*node[some].tolist(), *[int(node[x]) for x, _ in forest]], pa.int64()), pa.array([*links[some].tolist(), *[0] * len(forest)], pa.int64()),
                 pa.array([*[None] * len(some), *[int(node[y]) for _, y in forest]], pa.int64())],
                names=["node", "links", "partner"],
            )

    dealt = pairs.repartition("group", "a", "b").sortWithinPartitions("group", "a", "b")
    return dealt.select("group", "a", "b", "side", "node", "copies", "shingles").mapInArrow(run, "node long, links long, partner long")


def _payload(docs: DataFrame, wanted: DataFrame, options: Join) -> DataFrame:
    """(hi, lo, shingles) of the texts whose id is in ``wanted`` (first_id)."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch, options.shingle)
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["hi", "lo", "shingles"]
            )

    # Always merged: dealing the texts once costs the same share of the input at every size.
    picked = texts(docs).hint("merge").join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    return picked.mapInArrow(run, "hi long, lo long, shingles binary")


def classes(docs: DataFrame, options: Join = Join()) -> DataFrame:
    """(doc_id, text_hash, class_id, class_hash, n_links): one row per row of ``docs``.

    (class_id, class_hash) are the id and text hash of the class's first row, by id.
    """
    rows = stored(described(docs, options), "near-rows")
    alike = rows.filter("n > 0").groupBy("hi", "lo").agg(
        F.count("*").alias("copies"), F.min("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "text_hash")).alias("first"), F.first("bands").alias("bands")
    )
    nodes = stored(alike.select(F.monotonically_increasing_id().alias("node"), "hi", "lo", "copies", "n", "first", "bands"), "near-nodes")
    grouped = stored(candidate_groups(nodes).join(nodes.drop("bands"), "node"), "near-groups")
    sets = _payload(docs, grouped.select(F.col("first.doc_id").alias("first_id")), options)
    carried = grouped.select("node", "hi", "lo", "copies").join(sets, ["hi", "lo"]).drop("hi", "lo")
    found = stored(verify(block_pairs(grouped.select("node", "root", "n"), options).join(carried, "node"), options), "near-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    member = components(found.filter("partner IS NOT NULL").select(F.col("node").alias("a"), F.col("partner").alias("b")))
    known = nodes.select("node", "hi", "lo", "copies", "first").join(member, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = known.groupBy("root").agg(F.min("first").alias("head"))
    named = known.join(heads, "root").select("hi", "lo", "head", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    # One row per set on the right: a set that a third of all rows share is split by the join.
    full = rows.filter("n > 0").drop("bands", "n").join(named, ["hi", "lo"]).select("doc_id", "text_hash", F.col("head.doc_id").alias("class_id"), F.col("head.text_hash").alias("class_hash"), "n_links")
    none = rows.filter("n = 0").select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.col("text_hash").alias("class_hash"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(none)


def keep_one(docs: DataFrame, options: Join = Join()) -> DataFrame:
    """The first row, by id, of each class; all columns stay.  Of rows equal in id and text one stays."""
    heads = stored(classes(docs, options).filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash"))).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_t")).distinct(), "near-heads")
    keyed = docs.select(packed(docs).alias("row"), F.col("doc_id").cast("long").alias("_d"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_h"))
    first = keyed.join(heads, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_t")), "left_semi").dropDuplicates(["_d", "_h"])
    return first.select(*unpacked(docs.columns))


@query("op7_jaccard_join")
def jaccard_join(spark, sf):
    """Class and number of links of every document."""
    return classes(table(spark, sf, "documents")).select("doc_id", "class_id", "n_links")
