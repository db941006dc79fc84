"""Language identification: sparse softmax regression on TF-IDF character n-grams, by FTRL, with a temperature.

A text's words are cut into runs of letters; n-grams of one to four letters, with the word's edges as
spaces, are hashed.  A feature's value is its share of the text's n-grams times its inverse document
frequency.  Weights come from follow-the-regularised-leader with an L1 and an L2 penalty, so most are
exactly zero.  Labelled texts are dealt to a fixed number of shards; in each round every shard trains on
from the shared state, and the states are averaged.  Besides whole texts, pieces of some texts are
trained on, so that short texts are told apart as well.  One temperature, found on texts kept aside (cut alike),
divides the margins, so that scores are probabilities.

Values are linear in the counts of words, so a text's margins are sums over its words, and a batch looks
at each distinct word once.  At most about ``sample`` distinct labelled texts are used for each language
(picked by a hash of the text; copies count once), and document frequencies are those of the sample:
this is the classifier's fit.  Predictions cover all rows and whole texts without a shuffle.

A null text, or one without a letter, is ``und`` with score 0; so is every text where no label can be
learned from.  With one language every text with a letter is of that language, with score 1.  Null
languages aren't learned from, null ids belong to the texts learned from, repeated rows are predicted
alike, equal margins go to the language first in order.  An empty table gives an empty result, further
columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.common import mix, stored, texts, tokenised
from thalweg.llm.registry import query, table

EDGE, INNER = 32, 1
SLICE = 512


class Fit(NamedTuple):
    sample: int = 800
    buckets: int = 1 << 17
    longest: int = 4
    shards: int = 4
    rounds: int = 3
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.1


#: Words a piece: a quarter of the texts is cut into pieces of each of these lengths, the rest stays whole.
PIECES = (6, 25, 100)


def held_out(id_col="doc_id", folds: int = 4, held: int = 2):
    """True for rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == held, F.lit(False))


def sliced(batches):
    """Batches of at most ``SLICE`` rows, so that a worker holds the n-grams of so many texts' words."""
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE):
            yield batch.slice(a, SLICE)


def grams(words: pa.Array, options: Fit):
    """(word, bucket) of the n-grams of letters, a pair of arrays per length; words without a letter have none."""
    clean = pc.replace_substring_regex(pc.utf8_lower(words), r"\PL+", chr(INNER)).to_pylist()
    points = np.frombuffer((" " + " ".join(clean) + " ").encode("utf-32-le"), np.uint32)
    edge = points <= EDGE
    word = np.cumsum(points == EDGE, dtype=np.int32) - 1
    # All edges are alike, whether a word ends there or its letters are broken off.
    points = np.where(edge, EDGE, points).astype(np.uint64)
    run = np.zeros(len(points), np.uint64)
    inner = np.ones(len(points), bool)
    for n in range(1, options.longest + 1):
        stop = len(points) - n + 1
        if stop <= 0:
            break
        run = run[:stop] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :]
        # Edges may come first or last only, and not alone.
        inner = inner[:stop] & ~edge[n - 2 : n - 2 + stop] if n > 2 else inner[:stop]
        at = np.flatnonzero(~edge if n == 1 else ~(edge[:stop] & edge[1:]) if n == 2 else inner)
        yield word[at], (mix(run[at] + np.uint64(n)) & np.uint64(options.buckets - 1)).astype(np.int32)


def _examples(sample: DataFrame, options: Fit) -> DataFrame:
    """(shard, aside, lang, part, bucket, share): every sampled text, whole or in pieces, as shares of its n-grams."""

    def run(batches):
        for batch in sliced(batches):
            codes, words, offsets = tokenised(batch.column("text"), lower=False)
            owner, bucket = (np.concatenate(x) for x in zip(*grams(words, options), strict=True))
            order = np.argsort(owner, kind="stable")
            owner, bucket = owner[order], bucket[order]
            first = np.searchsorted(owner, np.arange(len(words) + 1))
            key = batch.column("h").to_numpy(zero_copy_only=False)
            made: dict[str, list] = {k: [] for k in ("shard", "aside", "lang", "key", "bucket", "share")}
            for t in range(batch.num_rows):
                own, h = codes[offsets[t] : offsets[t + 1]], int(key[t])
                aside = h % 7 == 0
                cut = len(own) if h // 5 % 4 == 3 else PIECES[h // 5 % 4]
                for a in range(0, len(own), max(cut, 1)):
                    distinct, times = np.unique(own[a : a + cut], return_counts=True)
                    size = first[distinct + 1] - first[distinct]
                    at = np.repeat(first[distinct] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    if not len(at):
                        continue
                    b, back = np.unique(bucket[at], return_inverse=True)
                    n = np.bincount(back, np.repeat(times, size))
                    row = (h // 20 % options.shards, aside, batch.column("lang")[t].as_py(), h * 1000 % 982_451_653 + a, b.astype(np.int32), (n / n.sum()).astype(np.float32))
                    for column, v in zip(made.values(), row, strict=True):
                        column.append(v)
            kinds = (pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made.values(), kinds, strict=True)], names=list(made))

    return sample.mapInArrow(run, "shard int, aside boolean, lang string, key long, bucket array<int>, share array<float>")


def sampled(docs: DataFrame, options: Fit) -> DataFrame:
    """(lang, text, h): about ``sample`` distinct texts at most for each language, all outside the held-out fold."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(7), "text"), 24))
    # Distinct by hash first, so that copies don't use up a language's share.
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}
    if not sizes:
        return known.limit(0).select("lang", "text", "h")
    share = F.element_at(F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, options.sample / max(1, n))))]), F.col("lang"))
    picked = known.filter(F.pmod(F.xxhash64(F.lit(11), "h"), F.lit(1 << 30)) < (share * float(1 << 30)))
    return picked.groupBy("lang", "h").agg(F.first("text").alias("text"))


class Model:
    """Languages, weights (bucket by language, inverse document frequencies multiplied in) and a temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray | None, temperature: float):
        self.languages, self.weights, self.temperature = languages, weights, temperature


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def leader(z: np.ndarray, n: np.ndarray, o: Fit) -> np.ndarray:
    """The weights that follow from the sums of gradients: zero within the L1 penalty, shrunk by the L2 penalty."""
    return np.where(np.abs(z) <= o.l1, 0.0, -(z - np.sign(z) * o.l1) / ((o.beta + np.sqrt(n)) / o.alpha + o.l2))


def _round(examples: DataFrame, state, index: dict[str, int], scale: np.ndarray, o: Fit):
    """One round: every shard trains on from the shared state; the touched states of all shards come back as sums."""
    shared = examples.sparkSession.sparkContext.broadcast((*state, index, scale))
    size = len(index)

    def run(rows: pa.Table) -> pa.Table:
        # A shard is a fixed share of the bounded sample.
        z, n, number, idf = shared.value
        z, n = z.copy(), n.copy()
        shard = rows.sort_by([("key", "ascending")]).combine_chunks()
        order = np.random.default_rng(17).permutation(shard.num_rows)
        buckets, shares, langs = shard.column("bucket"), shard.column("share"), shard.column("lang").to_pylist()
        for k in order.tolist():
            b = buckets[k].values.to_numpy()
            x = shares[k].values.to_numpy().astype(float) * idf[b]
            zb, nb = z[b], n[b]
            w = leader(zb, nb, o)
            p = _softmax(x @ w)
            p[number[langs[k]]] -= 1.0
            g = x[:, None] * p[None, :]
            more = nb + g * g
            z[b] = zb + g - (np.sqrt(more) - np.sqrt(nb)) / o.alpha * w
            n[b] = more
        at = np.flatnonzero(n.any(1))
        lists = lambda a: pa.array(list(a[at]), pa.list_(pa.float64()))
        return pa.Table.from_arrays([pa.array(at), lists(z), lists(n)], names=["bucket", "z", "n"])

    made = examples.groupBy("shard").applyInArrow(run, "bucket long, z array<double>, n array<double>").toArrow()
    z, n = np.zeros_like(state[0]), np.zeros_like(state[1])
    at = made.column("bucket").to_numpy()
    for total, name in ((z, "z"), (n, "n")):
        np.add.at(total, at, made.column(name).combine_chunks().flatten().to_numpy().reshape(-1, size))
    return z / o.shards, n / o.shards


def _temperature(margins: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the margins with the least log loss, by golden section over its logarithm."""
    loss = lambda s: -np.log(np.maximum(_softmax(margins / np.exp(s))[np.arange(len(truth)), truth], 1e-300)).sum()
    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, options: Fit = Fit()) -> Model:
    """The model of (doc_id, text, lang, …)."""
    examples = stored(_examples(sampled(docs, options), options), "language-examples")
    languages = sorted(r["lang"] for r in examples.select("lang").distinct().collect())
    if len(languages) < 2:
        return Model(languages, None, 1.0)
    train = examples.filter("NOT aside")
    if train.select("lang").distinct().count() < len(languages):
        train = examples
    seen = train.select(F.explode("bucket").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).toArrow()
    df = np.zeros(options.buckets)
    df[seen.column("bucket").to_numpy()] = seen.column("n").to_numpy()
    idf = 1.0 + np.log((1.0 + train.count()) / (1.0 + df))
    index = {k: i for i, k in enumerate(languages)}
    state = (np.zeros((options.buckets, len(languages))), np.zeros((options.buckets, len(languages))))
    for _ in range(options.rounds):
        state = _round(train, state, index, idf, options)
    weights = leader(*state, options) * idf[:, None]
    kept = examples.filter("aside").select("lang", "bucket", "share").toArrow()
    if not kept.num_rows:
        return Model(languages, weights, 1.0)
    parts = zip(kept.column("bucket"), kept.column("share"), strict=True)
    margins = np.array([s.values.to_numpy().astype(float) @ weights[b.values.to_numpy()] for b, s in parts])
    return Model(languages, weights, _temperature(margins, np.array([index[x] for x in kept.column("lang").to_pylist()])))


def identified(rows: DataFrame, model: Model, options: Fit = Fit()) -> DataFrame:
    """The columns of ``rows`` but the text, with (lang_pred, score); no shuffle."""
    keep = [c for c in rows.columns if c != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(model)  # buckets times languages

    def run(batches):
        m = shared.value
        names = np.array([*m.languages, "und"], object)
        for batch in sliced(batches):
            codes, words, offsets = tokenised(batch.column("text"), lower=False)
            # A word's n-grams and margins are summed over its lengths of n-gram, a text's over its words.
            size, each = np.zeros(len(words)), np.zeros((len(m.languages), len(words)))
            for owner, bucket in grams(words, options):
                size += np.bincount(owner, minlength=len(words))
                for k in range(len(each) if m.weights is not None else 0):
                    each[k] += np.bincount(owner, m.weights[bucket, k], len(words))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            total = np.bincount(doc, size[codes], batch.num_rows)
            score, pick = np.ones(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            if m.weights is not None:
                margins = np.column_stack([np.bincount(doc, e[codes], batch.num_rows) for e in each])
                chance = _softmax(margins / np.maximum(total, 1)[:, None] / m.temperature)
                pick = chance.argmax(1)
                score = chance[np.arange(len(pick)), pick]
            none = (total == 0) | (len(m.languages) == 0)
            pick[none], score[none] = len(m.languages), 0.0
            made = [pa.array(names[pick].tolist(), pa.string()), pa.array(np.clip(score, 0.0, 1.0))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], names=[*keep, "lang_pred", "score"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame, options: Fit = Fit()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from the languages of those that aren't held out."""
    return identified(texts(docs), fit(docs, options), options).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op12_language_id")
def language_id(spark, sf):
    """The language of every document."""
    return identify(table(spark, sf, "documents"))
