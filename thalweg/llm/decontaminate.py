"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are compared in lower case without punctuation.  There are two kinds of seeds.  A run is the
shortest one of at least three words, starting at a place of a test item, that chance would hardly put
into the corpus: the product of its words' shares times the corpus' words is at most ``rare``.  A run
that reaches the item's end or eight words is taken as it is.  Runs grow with the corpus and miss copies
with an edit every few words, so two words next to each other, or with one between them, are seeds as
well: the rarest pairs of all items, as many as chance makes up to ``noise`` hits a word of text.  A text
needs two of an item's pairs within ``band`` diagonals; their choice follows the words' shares alone, so
what is found doesn't depend on the size of the corpus.  Texts with a seed are aligned with the item
around it, word by word (match 2, mismatch -1, gap -1).  An item counts as present where the best
alignment reaches ``similarity`` of a perfect one.

An item without a rare pair left is found by its runs alone.  Items are the query set and go against all
texts in blocks of bounded size (an item longer than a block is a block of its own); each task aligns the
texts it reads, so nothing is shuffled but counts of the items' words.  Null and empty texts and items
match nothing.  Very long texts are searched whole, aligned around their seeds only.  Repeated rows are
reported each.  An empty table gives an empty result.  Further columns, whatever their names, stay as
they are.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.common import mix, packed, stored, texts, tokenised, unpacked, word_hashes
from thalweg.llm.registry import query, table


class Search(NamedTuple):
    similarity: float = 0.5
    rare: float = 0.01
    shortest: int = 3
    longest: int = 8
    noise: float = 0.01
    band: int = 8
    block_words: int = 400_000


MATCH, MISMATCH, GAP = 2, -1, -1


def plain(text):
    """Lower case, every run of other characters than letters and digits one space."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences and the place in ``text`` where it ends (exclusive)."""
    steps = np.arange(len(text) + 1, dtype=np.int64) * -GAP
    row = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for w in item:
        new = np.zeros_like(row)
        new[1:] = row[:-1] + np.where(text == w, MATCH, MISMATCH)
        np.maximum(new, row + GAP, out=new)
        np.maximum(new, 0, out=new)
        # A gap in the item's row: the best cell to the left, less a gap per word.
        row = np.maximum.accumulate(new + steps) - steps
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def word_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, dict[int, int]]:
    """Words of the corpus, and how often each hash of ``vocabulary`` (sorted) comes up; bounded by the items."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        total, counts = 0, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            codes, words, _ = tokenised(batch.column("text"), lower=False)
            total += len(codes)
            own = word_hashes(words)
            at = np.searchsorted(shared.value, own)
            ok = at < len(counts)
            ok[ok] = shared.value[at[ok]] == own[ok]
            np.add.at(counts, at[ok], np.bincount(codes, minlength=len(own))[ok])
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *seen.tolist()], pa.int64()), pa.array([total, *counts[seen].tolist()], pa.int64())], names=["k", "n"])

    rows = docs.select(plain(F.col("text")).alias("text")).mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    found = {r["k"]: r["n"] for r in rows}
    return found.pop(-1, 0), {int(vocabulary[k]): n for k, n in found.items()}


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - n + 1 + k]
    return mix(out + np.uint64(n))


def seeds(items: list[np.ndarray], total: int, counts: dict[int, int], options: Search) -> dict[int, list[tuple[int, int, int]]]:
    """By length: (hash, item, place) of the rare runs."""
    out: dict[int, list] = {}
    for i, words in enumerate(items):
        share = [max(counts.get(int(w), 0), 1) / max(total, 1) for w in words]
        for p in range(max(1, len(words) - options.shortest + 1) if len(words) else 0):
            expected, n = float(max(total, 1)), 0
            while p + n < len(words) and n < options.longest and (n < options.shortest or expected > options.rare):
                expected *= share[p + n]
                n += 1
            out.setdefault(n, []).append((int(run_hashes(words[p : p + n], n)[0]), i, p))
    return out


def pair_hashes(words: np.ndarray, gap: int) -> np.ndarray:
    """Hashes of every word with the one ``gap`` places on."""
    stop = max(0, len(words) - gap)
    return mix(words[:stop] * np.uint64(0x9E3779B97F4A7C15) + words[gap : gap + stop] + np.uint64(gap))


def rare_pairs(items: list[np.ndarray], total: int, counts: dict[int, int], options: Search) -> dict[int, list[tuple[int, int, int]]]:
    """By gap: (hash, item, place) of the rarest pairs, whose chances add up to ``noise`` at most."""
    made, chance = [], []
    for i, words in enumerate(items):
        share = np.array([max(counts.get(int(w), 0), 1) / max(total, 1) for w in words])
        for gap in (1, 2):
            for p, h in enumerate(pair_hashes(words, gap).tolist()):
                made.append((gap, h, i, p))
                chance.append(share[p] * share[p + gap])
    order = np.argsort(chance, kind="stable")
    kept = order[np.cumsum(np.array(chance)[order]) <= options.noise] if len(order) else []
    out: dict[int, list] = {1: [], 2: []}
    for k in sorted(int(k) for k in kept):
        gap, *rest = made[k]
        out[gap].append(tuple(rest))
    return out


def contaminated(docs: DataFrame, items: DataFrame, options: Search = Search()) -> DataFrame:
    """(row, item_id, score, similarity, first_word, last_word): texts that hold an item, one row per pair.

    ``docs``: (row, text), where ``row`` is whatever identifies a text.  Words count from 0 in the plain text, ``last_word`` is inclusive.
    """
    spark = docs.sparkSession
    cleaned = stored(items.select(F.col("item_id").cast("long").alias("item_id"), plain(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text")), "items")
    words = cleaned.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    n_blocks = max(1, -(-words // options.block_words))
    kind = docs.schema["row"].dataType.simpleString()
    schema = f"row {kind}, item_id long, score int, similarity double, first_word long, last_word long"
    out = None
    for b in range(n_blocks):
        rows = cleaned.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(n_blocks)) == b).collect()
        codes, distinct, offsets = tokenised(pa.array([r["text"] for r in rows], pa.string()), lower=False)
        hashes = word_hashes(distinct)
        sequences = [hashes[codes[offsets[k] : offsets[k + 1]]] for k in range(len(rows))]
        total, counts = word_counts(docs, np.sort(hashes))
        found = _search(docs, spark.sparkContext.broadcast((seeds(sequences, total, counts, options), rare_pairs(sequences, total, counts, options), sequences, [r["item_id"] for r in rows])), options, schema)
        out = found if out is None else out.unionByName(found)
    return out


class _Table:
    """Seeds of one kind by hash, with a small table in front that most words of a text don't pass."""

    def __init__(self, found):
        h = np.array([f[0] for f in found], np.uint64)
        order = np.argsort(h, kind="stable")
        self.h, self.where = h[order], np.array([f[1:] for f in found], np.int64).reshape(-1, 2)[order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(h & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, span: int, offsets: np.ndarray) -> np.ndarray:
        """(text, item, diagonal, place in the item) of every hit of ``span`` words within one text."""
        at = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(self.h, hashes[at]), np.searchsorted(self.h, hashes[at], "right")
        keep = hi > lo
        at, lo, hi = at[keep], lo[keep], hi[keep]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + span <= offsets[doc + 1]  # a seed mustn't cross into the next text
        at, lo, hi, doc = at[inside], lo[inside], hi[inside], doc[inside]
        times = hi - lo
        pick = np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())
        place = self.where[pick, 1]
        return np.stack([np.repeat(doc, times), self.where[pick, 0], np.repeat(at, times) - place, place], 1)


def twice_hit(hits: np.ndarray, band: int) -> np.ndarray:
    """Of (text, item, diagonal, place) those with another place's hit within ``band`` diagonals."""
    hits = hits[np.lexsort(hits.T[::-1])]
    near = (hits[1:, :2] == hits[:-1, :2]).all(1) & (hits[1:, 2] - hits[:-1, 2] <= band) & (hits[1:, 3] != hits[:-1, 3])
    return hits[np.append(near, False) | np.insert(near, 0, False)] if len(hits) else hits


def _search(docs: DataFrame, shared, options: Search, schema: str) -> DataFrame:
    similarity = options.similarity

    def run(batches):
        by_length, by_gap, items, ids = shared.value
        runs = [(n, _Table(found)) for n, found in sorted(by_length.items())]
        pairs = [(gap, _Table(found)) for gap, found in by_gap.items() if found]
        for batch in batches:
            codes, words, offsets = tokenised(batch.column("text"), lower=False)
            own = word_hashes(words)[codes]
            made = {"at": [], "item_id": [], "score": [], "similarity": [], "first_word": [], "last_word": []}
            hits = [t.hits(run_hashes(own, n), n, offsets)[:, :3] for n, t in runs]
            if pairs:
                hits.append(twice_hit(np.concatenate([t.hits(pair_hashes(own, gap), gap + 1, offsets) for gap, t in pairs]), options.band)[:, :3])
            seen = np.unique(np.concatenate(hits), axis=0) if hits else np.zeros((0, 3), np.int64)
            best: dict[tuple[int, int], tuple] = {}
            k = 0
            while k < len(seen):
                doc, item, first = (int(x) for x in seen[k])
                size = len(items[item])
                slack = size // 2 + 2
                last = first
                k += 1
                # Diagonals that lie close together are one candidate; a text may hold several.
                while k < len(seen) and seen[k, 0] == doc and seen[k, 1] == item and seen[k, 2] - last <= slack:
                    last = int(seen[k, 2])
                    k += 1
                a, z = max(int(offsets[doc]), first - slack), min(int(offsets[doc + 1]), last + size + slack)
                score, end = align(items[item], own[a:z])
                if score >= similarity * MATCH * size and score > best.get((doc, item), (0,))[0]:
                    stop = a + end - int(offsets[doc])
                    best[doc, item] = (score, score / (MATCH * size), max(0, stop - size), stop - 1)
            for (doc, item), v in best.items():
                for name, x in zip(made, (doc, ids[item], *v), strict=True):
                    made[name].append(x)
            picked = batch.column("row").take(pa.array(made["at"], pa.int64()))
            kinds = (pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
            names = ("item_id", "score", "similarity", "first_word", "last_word")
            yield pa.RecordBatch.from_arrays([picked, *[pa.array(made[c], t) for c, t in zip(names, kinds, strict=True)]], names=["row", *names])

    return docs.select("row", plain(F.col("text")).alias("text")).mapInArrow(run, schema)


def find_leaks(docs: DataFrame, items: DataFrame, options: Search = Search()) -> DataFrame:
    """(doc_id, item_id, score, similarity, first_word, last_word)."""
    rows = texts(docs).select(F.struct("doc_id").alias("row"), "text")
    return contaminated(rows, items, options).select("row.doc_id", "item_id", "score", "similarity", "first_word", "last_word")


def drop_leaks(docs: DataFrame, items: DataFrame, options: Search = Search()) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns stay."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(packed(docs).alias("packed"), F.struct(F.col("doc_id").cast("long").alias("d"), F.xxhash64(text).alias("h")).alias("row"), text.alias("text"))
    bad = stored(contaminated(keyed.select("row", "text"), items, options).select("row.d", "row.h").distinct(), "leaks")
    clean = keyed.join(bad, keyed["row.h"].eqNullSafe(bad["h"]) & keyed["row.d"].eqNullSafe(bad["d"]), "left_anti")
    return clean.select(*unpacked(docs.columns, "packed"))


@query("op5_decontaminate")
def decontaminate(spark, sf):
    """Documents that hold benchmark items, with the best alignment of each pair."""
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
