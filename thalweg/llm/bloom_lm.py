"""Language-model scores from a log-frequency Bloom filter.

Texts are lower-cased (A-Z) and split into words; each ends with one end token, and its first word
follows a begin mark.  Counts of word pairs in the training texts are quantised: a count c has the level
1 + floor(log c / log ``base``), and the filter holds the pair once for each level up to its own.  A
count is read back by probing level after level until one is missing; the estimate is the middle of the
counts of the last level found.  With c(h, w) from the filter and exact counts c(h) and c(w),

    P(w | h) = (c(h, w) + mu * P(w)) / (c(h) + mu),   P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)).

Work is laid out by chunks, the words of one Arrow batch: a chunk is coded once, then asks for the
counts of its distinct words.  Requests and pair counts travel as sorted arrays dealt by hash to buckets
whose number grows with the input; a word that every text holds is one entry per chunk.  The filter
grows with the pairs, so it is broadcast in segments of at most ``segment_bytes``: each segment
scores the pairs it owns in one pass over the chunks, and the passes add up, as the score is a sum.
A pass leaves one row per chunk, not one per text.

Words are told apart by 64-bit hashes, pairs by ``KEY_BYTES`` within a bucket.  Null texts are empty ones (the end token alone); a null id is
trained on.  Repeated rows are texts of their own.  Without training texts N = V = 0 and c = 0.
"""

from __future__ import annotations

import itertools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.common import groups, mix, stored, texts, tokenised, word_hashes
from thalweg.llm.registry import query, table


class Model(NamedTuple):
    base: float = 1.5
    mu: float = 100.0
    bits_per_key: int = 12
    probes: int = 5
    bucket_entries: int = 1 << 20
    segment_bytes: int = 32 << 20


#: A pair is told from the others of its bucket by this many bytes of its hash: with 2^20 pairs a bucket,
#: at any size of the input, one in a million meets another, far below the filter's own errors.
KEY_BYTES = 5
LOW = np.uint64((1 << 8 * KEY_BYTES) - 1)
END, BEGIN = (mix(np.array([k], np.uint64)) for k in (0xE4D, 0xBE61))
CHUNK = "chunk long, ids array<long>, held array<boolean>, sizes array<int>, codes binary, words binary"


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def coded(docs: DataFrame) -> DataFrame:
    """Chunks: per text its id, whether it is held out and its length; all words as codes; the hash of each code."""

    def run(batches):
        seeds = np.random.default_rng()
        for batch in batches:
            codes, words, offsets = tokenised(batch.column("text"))
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": [int(seeds.integers(1 << 62))], "ids": [batch.column("doc_id").to_pylist()], "held": [batch.column("held").to_pylist()],
                    "sizes": [np.diff(offsets).astype(np.int32)], "codes": [planes(codes, 4)], "words": [word_hashes(words).astype("<u8").tobytes()],
                },
                schema=pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("codes", pa.binary()), ("words", pa.binary())]),
            )

    return texts(docs).withColumn("held", held_out()).mapInArrow(run, CHUNK)


def planes(numbers: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each number: first all lowest bytes, then all second ones, so that empty ones compress."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplaned(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel().astype(np.uint64)


class Chunk:
    """One row of ``coded``: words with their end tokens, and the word before each."""

    def __init__(self, row: dict):
        self.key, self.ids = row["chunk"], row["ids"]
        self.held = np.array(row["held"], bool)
        sizes = np.array(row["sizes"], np.int64)
        self.words = np.frombuffer(row["words"], "<u8").astype(np.uint64)
        self.end, self.begin = len(self.words), len(self.words) + 1
        codes = unplaned(row["codes"], 4).astype(np.int64)
        ends = np.cumsum(sizes)
        self.tokens = np.insert(codes, ends, self.end)
        self.sizes = sizes + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.before = np.roll(self.tokens, 1)
        self.before[self.starts] = self.begin
        self.trained = np.repeat(~self.held, self.sizes)
        self.hashes = np.concatenate([self.words, END, BEGIN])

    def pairs(self, which=slice(None)) -> np.ndarray:
        return mix(self.hashes[self.before[which]] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[self.tokens[which]])


def _chunks(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield Chunk(batch.slice(k, 1).to_pylist()[0])


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Chosen by the high bits, so the ``KEY_BYTES`` low ones tell the keys of a bucket apart."""
    return ((keys >> np.uint64(8 * KEY_BYTES)) % np.uint64(buckets)).astype(np.int64)


def _order(keys: np.ndarray, buckets: int) -> np.ndarray:
    return np.lexsort((keys, _bucket(keys, buckets)))


def _dealt(keys: np.ndarray, counts: np.ndarray, buckets: int):
    """(bucket, keys, counts) with keys sorted; no more parts than keys."""
    order = _order(keys, buckets)
    keys, counts = keys[order], counts[order]
    bucket = _bucket(keys, buckets)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in itertools.pairwise([*cut.tolist(), len(keys)]):
        yield int(bucket[a]), keys[a:b], counts[a:b]


REQUEST = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _requests(chunk: Chunk, parts, width: int = 8) -> pa.RecordBatch:
    rows = [{"bucket": b, "chunk": chunk.key, "keys": planes(k, width), "counts": planes(c, 8)} for b, k, c in parts]
    return pa.RecordBatch.from_pylist(rows, schema=REQUEST)


def _merged(rows: pa.Table, width: int = 8):
    keys = np.concatenate([unplaned(x.as_py(), width) for x in rows.column("keys")])
    counts = np.concatenate([unplaned(x.as_py(), 8) for x in rows.column("counts")]).astype(np.int64)
    distinct, place = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, counts)
    return distinct, place, total


def word_buckets(entries: int, model: Model) -> int:
    return max(1, -(-entries // model.bucket_entries))


def word_totals(chunks: DataFrame, entries: int, model: Model) -> DataFrame:
    """(chunk, bucket, totals, …) answers to every chunk in the order it asked, and per bucket (null, …, distinct, tokens)."""
    buckets = word_buckets(entries, model)

    def ask(batches):
        for c in _chunks(batches):
            counts = np.bincount(c.tokens[c.trained], minlength=c.end + 1)[: c.end]
            yield _requests(c, _dealt(c.words, counts, buckets))

    def answer(batches):
        schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("totals", pa.binary()), ("seen", pa.int64()), ("tokens", pa.int64())])
        for (bucket,), rows in groups(batches, "bucket"):
            _, place, total = _merged(rows)
            sizes = [len(x.as_buffer()) >> 3 for x in rows.column("keys")]
            at = np.cumsum([0, *sizes])
            for k, (a, b) in enumerate(itertools.pairwise(at.tolist())):
                yield pa.RecordBatch.from_pylist([{"chunk": rows.column("chunk")[k].as_py(), "bucket": bucket, "totals": planes(total[place[a:b]], 8), "seen": None, "tokens": None}], schema=schema)
            yield pa.RecordBatch.from_pylist([{"chunk": None, "bucket": bucket, "totals": b"", "seen": int((total > 0).sum()), "tokens": int(total.sum())}], schema=schema)

    asked = chunks.mapInArrow(ask, "bucket long, chunk long, keys binary, counts binary")
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, "chunk long, bucket long, totals binary, seen long, tokens long")


def levels(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(base) + 1e-9).astype(np.int64)


def middles(base: float, top: int = 160) -> np.ndarray:
    """The estimate for each level; level 0 is a count of 0."""
    low = np.ceil(base ** np.arange(top) - 1e-9)
    high = np.maximum(low, np.ceil(base ** np.arange(1, top + 1) - 1e-9) - 1)
    return np.concatenate([[0.0], (low + high) / 2])


def _bits(keys: np.ndarray, level, probe: int, size) -> np.ndarray:
    own = mix(keys + np.uint64(0xD1B54A32D192ED03) * np.asarray(level, np.uint64))
    return (own + np.uint64(probe) * ((own >> np.uint64(33)) | np.uint64(1))) % size


def filters(chunks: DataFrame, tokens: int, model: Model) -> tuple[DataFrame, int]:
    """(bucket, size, bits): one part of the filter per bucket of pairs, sized by its keys; and the number of buckets."""
    buckets = max(1, -(-tokens // model.bucket_entries))

    def ask(batches):
        for c in _chunks(batches):
            keys, counts = np.unique(c.pairs(np.flatnonzero(c.trained)), return_counts=True)
            yield _requests(c, _dealt(keys, counts, buckets), KEY_BYTES)

    def build(batches):
        for (bucket,), rows in groups(batches, "bucket"):
            keys, _, total = _merged(rows, KEY_BYTES)
            level = levels(total, model.base)
            size = np.uint64(max(64, -(-int(level.sum()) * model.bits_per_key // 64) * 64))
            bits = np.zeros(int(size), bool)
            for j in range(1, int(level.max()) + 1):
                own = keys[level >= j]
                for p in range(model.probes):
                    bits[_bits(own, j, p, size).astype(np.int64)] = True
            yield pa.RecordBatch.from_pydict({"bucket": [bucket], "size": [int(size)], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    asked = chunks.mapInArrow(ask, "bucket long, chunk long, keys binary, counts binary")
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(build, "bucket long, size long, bits binary"), buckets


class Segment:
    """Some buckets of the filter, laid end to end."""

    def __init__(self, rows, buckets: int):
        self.size = np.ones(buckets, np.uint64)
        self.at = np.zeros(buckets, np.int64)
        self.here = np.zeros(buckets, bool)
        place = 0
        for r in rows:
            self.size[r["bucket"]], self.at[r["bucket"]], self.here[r["bucket"]] = r["size"], place, True
            place += r["size"]
        self.bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in rows), np.uint8)

    def level(self, keys: np.ndarray, bucket: np.ndarray, probes: int) -> np.ndarray:
        """The highest level up to which every level of the key is in the filter."""
        out = np.zeros(len(keys), np.int64)
        alive, j = np.arange(len(keys)), 1
        while len(alive):
            k, size, at = keys[alive], self.size[bucket[alive]], self.at[bucket[alive]]
            ok = np.ones(len(alive), bool)
            for p in range(probes):
                some = np.flatnonzero(ok)
                bit = _bits(k[some], j, p, size[some]).astype(np.int64) + at[some]
                ok[some] = (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            alive = alive[ok]
            out[alive] = j
            j += 1
        return out


SCORES = "chunk long, ids array<long>, held array<boolean>, sizes array<long>, known array<long>, base array<double>, score array<double>"
SCORE_ROW = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("known", pa.list_(pa.int64())), ("base", pa.list_(pa.float64())), ("score", pa.list_(pa.float64()))])


def _score(asked: DataFrame, shared, asked_buckets: int, tokens: int, vocabulary: int, trained: int, model: Model, first: bool) -> DataFrame:
    """One row per chunk: the part of its texts' scores that the segment's pairs contribute; in the first pass the exact unigram columns too."""
    middle = middles(model.base)

    def run(batches):
        seg, buckets = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                c = Chunk(row)
                # The answers by bucket, each in the order of its keys, are the words in the order they were asked in.
                count = np.zeros(c.end + 2)
                told = [unplaned(p["totals"], 8).astype(np.int64) for p in sorted(row["answers"], key=lambda p: p["bucket"])]
                if told:
                    count[_order(c.words, asked_buckets)] = np.concatenate(told)
                count[c.end] = count[c.begin] = trained
                chance = (count + 0.1) / (tokens + 0.1 * (vocabulary + 1))
                keys, place = np.unique(c.pairs(), return_inverse=True)
                bucket = _bucket(keys, buckets)
                own = np.flatnonzero(seg.here[bucket])
                pair, mine = np.zeros(len(keys)), np.zeros(len(keys), bool)
                pair[own] = middle[np.minimum(seg.level(keys[own] & LOW, bucket[own], model.probes), len(middle) - 1)]
                mine[own] = True
                term = np.log10((pair[place] + model.mu * chance[c.tokens]) / (count[c.before] + model.mu))
                total = lambda x, c=c: np.add.reduceat(x, c.starts) if len(c.starts) else np.zeros(0)
                out = dict.fromkeys(SCORE_ROW.names) | {"chunk": c.key, "score": total(np.where(mine[place], term, 0.0))}
                if first:
                    out |= {"ids": c.ids, "held": c.held, "sizes": c.sizes, "known": total((count[c.tokens] > 0).astype(np.int64)).astype(np.int64), "base": total(np.log10(chance)[c.tokens])}
                yield pa.RecordBatch.from_pydict({k: [v] for k, v in out.items()}, schema=SCORE_ROW)

    return asked.mapInArrow(run, SCORES)


def _added(passes: DataFrame) -> DataFrame:
    """One row per chunk again: the parts of all passes added up, two rows of a chunk in memory at a time."""

    def run(batches):
        held = None
        for row in itertools.chain.from_iterable(b.slice(k, 1).to_pylist() for b in batches for k in range(b.num_rows)):
            if held and held["chunk"] != row["chunk"]:
                yield pa.RecordBatch.from_pylist([held], schema=SCORE_ROW)
                held = None
            if held:
                held["score"] = np.add(held["score"], row["score"])
                row = row if row["ids"] is not None else held
                held |= {c: row[c] for c in ("ids", "held", "sizes", "known", "base")}
            else:
                held = row
        if held:
            yield pa.RecordBatch.from_pylist([held], schema=SCORE_ROW)

    return passes.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, SCORES)


def score_texts(docs: DataFrame, model: Model = Model()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    spark = docs.sparkSession
    chunks = stored(coded(docs), "lm-chunks")
    flags = F.arrays_zip("held", "sizes")
    learned = F.filter(flags, lambda x: ~x.held)
    entries, n_texts, n_words = chunks.agg(
        F.sum(F.octet_length("words") / 8).cast("long"), F.sum(F.size(learned)), F.sum(F.aggregate(learned, F.lit(0).cast("long"), lambda a, x: a + x.sizes))
    ).first()
    answers = stored(word_totals(chunks, entries or 0, model), "lm-totals")
    seen, tokens = answers.filter("chunk IS NULL").agg(F.sum("seen"), F.sum("tokens")).first()
    trained = n_texts or 0
    vocabulary, tokens = (seen or 0) + (trained > 0), (tokens or 0) + trained
    by_chunk = answers.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "totals")).alias("answers"))
    # A chunk with no words has no request, hence the outer join.
    asked = stored(chunks.join(by_chunk, "chunk", "left").withColumn("answers", F.coalesce("answers", F.array().cast("array<struct<bucket:bigint,totals:binary>>"))), "lm-asked")
    parts, buckets = filters(chunks, (n_words or 0) + trained, model)
    parts = stored(parts, "lm-filter")
    # Every bucket belongs to some segment; one that holds no pair needs no bits.
    segments, room = [[]], model.segment_bytes
    sizes = {r["bucket"]: r["size"] // 8 for r in parts.select("bucket", "size").collect()}
    for b in range(buckets):
        if segments[-1] and sizes.get(b, 0) > room:
            segments.append([])
            room = model.segment_bytes
        segments[-1].append(b)
        room -= sizes.get(b, 0)
    scored = []
    for lot in segments:
        rows = parts.filter(F.col("bucket").between(lot[0], lot[-1])).collect()
        empty = [{"bucket": b, "size": 64, "bits": b"\0" * 8} for b in lot if b not in sizes]
        shared = spark.sparkContext.broadcast((Segment([*rows, *empty], buckets), buckets))
        scored.append(stored(_score(asked, shared, word_buckets(entries or 0, model), tokens, vocabulary, trained, model, not scored), "lm-scores"))
        shared.destroy()
    out = scored[0]
    if len(scored) > 1:
        for more in scored[1:]:
            out = out.unionByName(more)
        out = _added(out)
    told = out.select(F.explode(F.arrays_zip("ids", "held", "sizes", "known", "base", "score")).alias("t"))
    return told.select(
        F.col("t.ids").alias("doc_id"), F.col("t.held").alias("held_out"), F.col("t.sizes").alias("n_tokens"), F.col("t.known").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), F.col("t.base").alias("base_score"), F.col("t.score").alias("score"),
    )


@query("op4_bloom_lm")
def bloom_lm(spark, sf):
    """Unigram and model scores of every document."""
    return score_texts(table(spark, sf, "documents"))
