"""Toxicity: boosted trees over a few dense features, calibrated by isotonic regression.

A lexicon is learned first: words and word beginnings (4 to 6 letters) that labelled toxic texts hold
far more often than others (log odds at least ``z`` standard errors from even).  The features of a
text are lexicon densities and weights, nearness of lexicon words to second-person words, capitals,
punctuation, and obfuscation (letters mixed with digits or signs, long runs of a letter).  Trees and
lexicon are fitted on three quarters of the sample, calibration on the rest.

At most ``SAMPLE`` labelled rows are used, picked by a hash of the id; everything else covers all rows.
Null texts are empty ones and get a score as well.  Labels without an id or value are left out, several
labels of one id count as toxic if one is.  Without both classes in the labels every text gets the
share of toxic ones as its score.  Repeated rows are scored alike, further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.common import stored, texts, tokenised
from thalweg.llm.registry import query, table

SAMPLE = 20_000
LEXICON = 4_000
PREFIXES = (4, 5, 6)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer sie usted ustedes ti tuyo vosotros os vuestro".split()
)
PLAIN = str.maketrans("013457@$!", "oieastasi")
EDGE = ".,;:!?\"'()[]{}«»„“”…-–—"
FEATURES = (
    "word_hits", "prefix_hits", "weight", "heaviest", "hits", "near_second", "second", "near_hits", "capitals", "shouted",
    "exclaim", "question", "punctuation", "obfuscated", "plain_hits", "stretched", "words",
)


def held_out(id_col="doc_id", folds: int = 5):
    """True for rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic, fit): at most about ``sample`` labelled rows outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out())
    share = min(1.0, sample / max(1, known.count()))
    picked = known.filter(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    # Broadcast: the sample's size bounds it.
    rows = texts(docs).join(F.broadcast(picked), "doc_id")
    return rows.withColumn("fit", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(4)) != 0)


def _core(words: list[str]) -> list[str]:
    return [w.strip(EDGE).lower() for w in words]


def lexicon(sample: DataFrame, z: float = 3.2, most: int = LEXICON) -> dict[str, float]:
    """Weights of words ("word") and beginnings ("begi*"): log odds of the share of toxic and of other texts that hold them."""

    def forms(batches):
        for batch in batches:
            codes, words, offsets = tokenised(batch.column("text"), lower=False)
            cores = _core(words.to_pylist())
            index: dict[str, int] = {}
            put = lambda f: index.setdefault(f, len(index))
            columns = np.array([[put(c), *[put(c[:k] + "*") if len(c) >= k else -1 for k in PREFIXES]] if c else [-1] * (1 + len(PREFIXES)) for c in cores] or np.zeros((0, 4)), np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            pairs = np.unique(np.concatenate([doc * (len(index) + 1) + columns[codes, k] for k in range(columns.shape[1])])[np.concatenate([columns[codes, k] for k in range(columns.shape[1])]) >= 0])
            toxic = np.asarray(batch.column("toxic").to_numpy(zero_copy_only=False), dtype=np.int64)[pairs // (len(index) + 1)]
            form = pairs % (len(index) + 1)
            n = len(index)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(index), pa.string()), pa.array(np.bincount(form, toxic, n).astype(np.int64)), pa.array(np.bincount(form, 1 - toxic, n).astype(np.int64))],
                names=["form", "toxic", "other"],
            )

    t, o = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not t or not o:
        return {}
    counts = sample.select("text", "toxic").mapInArrow(forms, "form string, toxic long, other long").groupBy("form").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (F.lit(t + 1.0) - F.col("a") - 0.5)) - F.log((F.col("b") + 0.5) / (F.lit(o + 1.0) - F.col("b") - 0.5))
    scored = counts.withColumn("odds", odds).withColumn("z", odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5)))
    return {r["form"]: r["odds"] for r in scored.filter(F.col("z") >= z).orderBy(F.desc("z"), "form").limit(most).collect()}


def featured(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The columns of ``docs`` but the text, with the features; no shuffle."""
    keep = [c for c in docs.columns if c != "text"]

    def run(batches):
        for batch in batches:
            codes, words, offsets = tokenised(batch.column("text"), lower=False)
            plain = words.to_pylist()
            cores = _core(plain)
            size = batch.num_rows
            lex = np.fromiter((weights.get(c, 0.0) for c in cores), float, len(cores))
            pre = np.fromiter((max((weights.get(c[:k] + "*", 0.0) for k in PREFIXES if len(c) >= k), default=0.0) for c in cores), float, len(cores))
            second = np.fromiter((c in SECOND_PERSON for c in cores), float, len(cores))
            count = lambda rx: pc.count_substring_regex(words, rx).to_numpy(zero_copy_only=False).astype(float)
            # Arrow's pattern functions are linear in the text and see each distinct word once.
            letters, upper, exclaim, question, signs = (count(p) for p in (r"\pL", r"\p{Lu}", "!", r"\?", r"[!?.,;:*#@$%&]"))
            mixed = np.asarray(pc.match_substring_regex(words, r"\pL[0-9@$*!#]+\pL").to_numpy(zero_copy_only=False), float)
            opened = np.zeros(len(cores))
            for k in np.flatnonzero(mixed):
                c = cores[k].translate(PLAIN)
                opened[k] = max([weights.get(c, 0.0), *[weights.get(c[:n] + "*", 0.0) for n in PREFIXES if len(c) >= n]])
            stretched = np.zeros(len(cores))
            for k in np.flatnonzero(letters >= 6):
                c = cores[k]
                stretched[k] = any(c[i] == c[i + 1] == c[i + 2] == c[i + 3] for i in range(len(c) - 3))
            heavy = np.maximum(np.maximum(lex, pre), opened)
            n = np.diff(offsets).astype(float)
            doc = np.repeat(np.arange(size), np.diff(offsets))
            total = lambda per_word: np.bincount(doc, per_word[codes], size) if len(codes) else np.zeros(size)
            each, chars = np.maximum(n, 1), np.maximum(total(letters), 1)
            heaviest = np.zeros(size)
            np.maximum.at(heaviest, doc, heavy[codes])
            # Distance in words from each lexicon word to the nearest second-person word of the same text.
            at = np.arange(len(codes))
            far = 1 << 30
            is_second, hit = second[codes] > 0, heavy[codes] > 0
            before = np.maximum.accumulate(np.where(is_second, at, -far)) if len(at) else at
            after = np.minimum.accumulate(np.where(is_second, at, far)[::-1])[::-1] if len(at) else at
            begin, end = offsets[:-1][doc], offsets[1:][doc]
            gap = np.minimum(np.where(before >= begin, at - before, far), np.where(after < end, after - at, far))
            near = np.zeros(size)
            np.maximum.at(near, doc[hit], 1.0 / (1.0 + gap[hit]))
            hits = total((heavy > 0).astype(float))
            values = dict(
                word_hits=total((lex > 0).astype(float)) / each, prefix_hits=total((pre > 0).astype(float)) / each, weight=total(heavy) / each, heaviest=heaviest, hits=np.log1p(hits),
                near_second=near, second=total(second) / each, near_hits=np.bincount(doc[hit], gap[hit] <= 5, size) / each if len(codes) else np.zeros(size),
                capitals=total(upper) / chars, shouted=total(((upper == letters) & (letters > 2)).astype(float)) / each,
                exclaim=total(exclaim) / each, question=total(question) / each, punctuation=total(signs) / each,
                obfuscated=total(mixed) / each, plain_hits=total((opened > 0).astype(float)) / each, stretched=total(stretched) / each, words=np.log1p(n),
            )
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(values[f], pa.float64()) for f in FEATURES]], names=[*keep, *FEATURES])

    kinds = ", ".join(f"{c} {t}" for c, t in docs.dtypes if c in keep)
    return docs.mapInArrow(run, f"{kinds}, " + ", ".join(f"{f} double" for f in FEATURES))


class Scorer:
    """A fitted model; ``score`` adds the calibrated probability to texts."""

    def __init__(self, weights, trees, curve, constant: float):
        self.weights, self.trees, self.curve, self.constant = weights, trees, curve, constant

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, …, score) for (doc_id, text, …)."""
        if self.trees is None:
            return docs.drop("text").withColumn("score", F.lit(self.constant))
        keep = [c for c in docs.columns if c != "text"]
        raw = _raw(self.trees, VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(featured(docs, self.weights)))
        made = self.curve.transform(raw)
        return made.select(*keep, F.least(F.greatest(F.col("_calibrated"), F.lit(0.0)), F.lit(1.0)).alias("score"))


def _raw(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("_raw", vector_to_array("_probability")[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = 20, depth: int = 3) -> Scorer:
    rows = stored(labelled(docs, labels, sample), "toxic-sample")
    both = {(r["fit"], r["toxic"]): r["n"] for r in rows.groupBy("fit", "toxic").agg(F.count("*").alias("n")).collect()}
    n, toxic = sum(both.values()), sum(v for (_, y), v in both.items() if y == 1)
    constant = toxic / n if n else 0.0
    if not both.get((True, 1)) or not both.get((True, 0)):
        return Scorer({}, None, None, constant)
    weights = lexicon(rows.filter("fit"))
    ready = stored(featured(rows, weights), "toxic-features")
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(ready)
    booster = GBTClassifier(featuresCol="_x", labelCol="toxic", predictionCol="_predicted", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=11)
    trees = booster.setProbabilityCol("_probability").setRawPredictionCol("_margin").fit(ready.filter("fit"))
    other = ready.filter("NOT fit") if both.get((False, 1)) and both.get((False, 0)) else ready
    curve = IsotonicRegression(featuresCol="_raw", labelCol="toxic", predictionCol="_calibrated").fit(_raw(trees, other))
    return Scorer(weights, trees, curve, constant)


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, learned from ``labels``."""
    scored = fit(docs, labels, **options).score(texts(docs))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay."""
    named = [f"_c{i}" for i in range(len(docs.columns))]
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct(*[F.col(c).alias(n) for c, n in zip(docs.columns, named, strict=True)]).alias("row"))
    scored = fit(docs, labels, **options).score(packed)
    return scored.filter("score < 0.5").select(*[F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, named, strict=True)])


@query("op9_toxicity")
def toxicity(spark, sf):
    """A calibrated score for every document."""
    return judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
