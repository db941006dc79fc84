"""Session options and Arrow helpers shared by the operators.

A *word* is a run of characters other than space and ``\\x09-\\x0D``.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.session import configure, fresh_path

SPACES = " \t\n\x0b\f\r"
#: An Arrow batch holds this many bytes or rows, so a worker's memory doesn't follow the table's.
BATCH_BYTES, BATCH_ROWS = "8m", "4096"


def prepared(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there and nothing is computed twice."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty ones; all other columns are left behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def packed(docs: DataFrame):
    """All columns of a row as one struct, so that no name of theirs meets one of an operator's."""
    return F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)])


def unpacked(names, row: str = "row") -> list:
    """The columns of a packed row under their own names."""
    return [F.col(f"{row}.c{k}").alias(c) for k, c in enumerate(names)]


def sql_words(text):
    """The words of a text as an array, without UDFs."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \x09-\x0D]+"))


def tokenised(text: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of a text column: (code of every word, distinct words, where each text's words begin, one more at the end)."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string())
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(text))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    flat = lists.flatten()
    blank = np.asarray(pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False), dtype=bool)
    if blank.any():
        before = np.concatenate([[0], np.cumsum(blank)])
        flat, offsets = flat.filter(pa.array(~blank)), offsets - before[offsets]
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, offsets


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (public domain constants of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word, the same on every machine."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; a shorter non-empty text is one shingle."""
    size = len(hashes)
    if not size:
        return hashes
    n = min(n, size)
    out = np.zeros(size - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[k : size - n + 1 + k]
    return mix(out + np.uint64(n))


def groups(batches, *keys: str):
    """Runs of equal keys over sorted record batches, as (key, table).  A run may span batches."""
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in itertools.pairwise(starts):
            key, part = tuple(c[a].item() for c in cols), pa.Table.from_batches([batch.slice(a, b - a)])
            if held and key != held_key:
                yield held_key, pa.concat_tables(held)
                held = []
            held_key = key
            held.append(part)
    if held:
        yield held_key, pa.concat_tables(held)
