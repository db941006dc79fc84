"""Token ids in files of fixed-width bits.

An id takes as many bits as the vocabulary needs.  A shard holds whole documents in ascending order:

    header    "TOKBITS1", bits u32, block u32, documents u64, ids u64, blocks u64    (little endian)
    documents doc_id i64, then a byte that is 1 where the id is null, then starts u64 (one more than documents)
    blocks    offset u64 of each block in the payload (one more than blocks)
    payload   blocks of ``block`` ids, lowest bits first; every block starts at a whole byte

so any range of ids is read with the offsets of its blocks and unpacked by numpy.  Tasks write shards
under names of their own, and only those that the manifest (a Spark table) lists count: a task that is
run twice leaves a file that nothing refers to.

A document's ids end with ``end_id``; an empty or null text is that id alone.  Order: doc_id (nulls
first), then text.  Repeated rows are repeated documents.  An empty table gives no shards.
"""

from __future__ import annotations

import itertools
import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.llm.common import SPACES, stored, texts, tokenised
from thalweg.llm.registry import query, table
from thalweg.session import fresh_path

MAGIC, HEADER = b"TOKBITS1", struct.Struct("<8sIIQQQ")
MANIFEST = "part int, seq int, file string, n_docs long, n_tokens long"
#: Ids of so many words, and of so many parts of words, are kept per worker; those beyond are encoded again when they come up.
CACHED_WORDS = 500_000


class Layout(NamedTuple):
    bits: int
    block: int = 4096
    shard_ids: int = 1 << 25


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits`` bits each, lowest first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    lanes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(lanes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a packed run."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    raw = np.frombuffer(data + b"\0" * 5, np.uint8).astype(np.uint64)
    at = np.arange(n, dtype=np.int64) * bits
    low = at >> 3
    word = np.zeros(n, np.uint64)
    for k in range(5):
        word |= raw[low + k] << np.uint64(8 * k)
    return ((word >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ShardWriter:
    """Collects documents and packs full blocks at once, so a shard in the making is held packed."""

    def __init__(self, layout: Layout):
        self.layout, self.docs, self.null, self.starts, self.packed = layout, [], [], [0], []
        self.tail = np.zeros(0, np.uint32)

    @property
    def n_tokens(self) -> int:
        return self.starts[-1]

    def add(self, doc_ids: list, ids: np.ndarray, ends: np.ndarray) -> None:
        self.docs += [d or 0 for d in doc_ids]
        self.null += [d is None for d in doc_ids]
        base = self.starts[-1]
        self.starts += (base + ends).tolist()
        self.tail = np.concatenate([self.tail, ids]) if len(self.tail) else ids
        whole = len(self.tail) // self.layout.block * self.layout.block
        for a in range(0, whole, self.layout.block):
            self.packed.append(pack(self.tail[a : a + self.layout.block], self.layout.bits))
        self.tail = self.tail[whole:].copy()

    def write(self, path: str) -> None:
        if len(self.tail):
            self.packed.append(pack(self.tail, self.layout.bits))
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in self.packed])]).astype("<u8")
        system, at = _open(path)
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(at) as out:
            out.write(HEADER.pack(MAGIC, self.layout.bits, self.layout.block, len(self.docs), self.n_tokens, len(self.packed)))
            out.write(np.asarray(self.docs, "<i8").tobytes() + bytes(self.null) + np.asarray(self.starts, "<u8").tobytes() + offsets.tobytes())
            for p in self.packed:
                out.write(p)


class Shard:
    """Random access to one file."""

    def __init__(self, path: str):
        system, at = _open(path)
        self.file = system.open_input_file(at)
        magic, self.bits, self.block, n_docs, self.n_tokens, n_blocks = HEADER.unpack(self.file.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} isn't a token file")
        self.docs = np.frombuffer(self.file.read(8 * n_docs), "<i8")
        self.null = np.frombuffer(self.file.read(n_docs), np.uint8).astype(bool)
        self.starts = np.frombuffer(self.file.read(8 * (n_docs + 1)), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(self.file.read(8 * (n_blocks + 1)), "<u8").astype(np.int64)
        self.payload = self.file.tell()

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the shard, from their blocks alone."""
        if end <= begin:
            return np.zeros(0, np.uint32)
        first, last = begin // self.block, (end - 1) // self.block
        self.file.seek(self.payload + int(self.offsets[first]))
        data = self.file.read(int(self.offsets[last + 1] - self.offsets[first]))
        if self.block * self.bits % 8 == 0:  # blocks without padding between them unpack as one run
            got = [unpack(data, min((last + 1) * self.block, self.n_tokens) - first * self.block, self.bits)]
        else:
            at = (self.offsets[first : last + 2] - self.offsets[first]).tolist()
            got = [unpack(data[x:y], min(self.block, self.n_tokens - b * self.block), self.bits) for b, (x, y) in enumerate(itertools.pairwise(at), first)]
        return np.concatenate(got)[begin - first * self.block : end - first * self.block]


#: Normaliser and pre-tokeniser for which words may be taken apart and put together in a form that more of them share.
SHARED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Kinds that part a text at white space and look at nothing beyond it, and normalisers that see one character or a word.
PARTING, LOCAL = ("WhitespaceSplit", "Whitespace", "BertPreTokenizer"), ("NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "BertNormalizer")


def sharing(tokenizer: str) -> str:
    """What of a text is encoded on its own so that the ids are those of the whole text: "parts" of words, "words", or "texts"."""
    made = json.loads(tokenizer)
    kind = lambda part: (made.get(part) or {}).get("type")
    added = [t for t in made.get("added_tokens") or [] if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or set(t["content"]) & set(SPACES)]
    if added or made.get("truncation") or made.get("padding"):
        return "texts"
    ends = made["model"].get("type") == "BPE" and made["model"].get("end_of_word_suffix") == "</w>" and not made["model"].get("dropout")
    if ends and all(made.get(k) == v for k, v in SHARED.items()) and all("<" in t["content"] for t in made.get("added_tokens") or []):
        return "parts"
    steps = (made.get("normalizer") or {}).get("normalizers") or [made.get("normalizer")]
    local = all(step is None or step.get("type") in LOCAL for step in steps)
    return "words" if ends and all(made.get(k) == v for k, v in SHARED.items()) or local and kind("pre_tokenizer") in PARTING else "texts"


def _split(word: str) -> tuple[str, str]:
    """A word as two parts that encode on their own, in a form that fewer words share.

    Capitals and a mark behind a letter can be taken apart safely where every character is a precomposed one
    below U+0130 and no special token can be in the word; all other words stay whole.
    """
    if "<" in word or not (word.isascii() or max(word) < "\u0130"):
        return word, ""
    low = word.lower()
    return (low[:-1], low[-1]) if low[-1] in ".,;:!?" and low[-2:-1].isalpha() else (low, "")


_encoders: dict[str, Callable] = {}


def encoder(tokenizer: str):
    """``new_encoder``, kept by a worker from one task to the next with the words it knows."""
    key = xxhash.xxh3_128_hexdigest(tokenizer)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = new_encoder(tokenizer)
    return _encoders[key]


def new_encoder(tokenizer: str):
    """A function from a text column to (ids, end of each text's ids), equal to encoding the whole texts.

    Where the tokenizer parts texts at white space, distinct words are encoded once and put together; else whole texts are.
    """
    from tokenizers import Tokenizer

    model, way = Tokenizer.from_str(tokenizer), sharing(tokenizer)
    known: dict[str, bytes] = {"": b""}
    whole: dict[str, bytes] = {}

    last = np.zeros(max(model.get_vocab().values(), default=0) + 1, bool)
    last[[i for piece, i in model.get_vocab().items() if piece.endswith("</w>")]] = True

    def singly(words: list[str]):
        for a in range(0, len(words), 4096):
            yield from (array("I", e.ids).tobytes() for e in model.encode_batch_fast(words[a : a + 4096], add_special_tokens=False))

    def letters(words: list[str]) -> list[bytes]:
        """Ids of words of letters, a hundred to a text: each is one piece, which ends with the next word-final id."""
        out: list[bytes] = []
        for a in range(0, len(words), 6400):
            lots = [words[k : k + 100] for k in range(a, min(a + 6400, len(words)), 100)]
            for lot, e in zip(lots, model.encode_batch_fast([" ".join(lot) for lot in lots], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, np.uint32)
                ends = (np.flatnonzero(last[ids]) + 1) * 4
                if len(ends) == len(lot):
                    raw = ids.tobytes()
                    out += [raw[i:j] for i, j in itertools.pairwise([0, *ends.tolist()])]
                else:
                    out += singly(lot)
        return out

    def by_parts(words: list[str]) -> list[bytes]:
        split = [_split(w) for w in words]
        new = list({p for pair in split for p in pair if p not in known})
        plain = [w for w in new if w.isalpha()]
        fresh = dict(zip(plain, letters(plain), strict=True))
        other = [w for w in new if w not in fresh]
        fresh.update(zip(other, singly(other), strict=True))
        room = CACHED_WORDS - len(known)
        known.update(itertools.islice(fresh.items(), max(0, room)))
        look = known if len(fresh) <= room else {**fresh, **known}
        return [look[a] + look[b] if b else look[a] for a, b in split]

    def pieces_of(words: list[str]) -> list[bytes]:
        out = [whole.get(w) for w in words]
        new = [k for k, piece in enumerate(out) if piece is None]
        fresh = [words[k] for k in new]
        for k, w, piece in zip(new, fresh, by_parts(fresh) if way == "parts" else singly(fresh), strict=True):
            out[k] = piece
            if len(whole) < CACHED_WORDS:
                whole[w] = piece
        return out

    def by_texts(text: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        made = [np.append(np.frombuffer(x, np.uint32), np.uint32(end_id)) for x in singly(text.to_pylist())]
        return np.concatenate(made) if made else np.zeros(0, np.uint32), np.cumsum([len(m) for m in made]).astype(np.int64)

    def by_words(text: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        codes, words, offsets = tokenised(text, lower=False)
        # The end id is one more distinct piece, put behind each text's words.
        pieces = pieces_of(words.to_pylist())
        pieces.append(np.asarray([end_id], "<u4").tobytes())
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) >> 2
        begins = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(pieces), "<u4")
        seq = np.insert(codes, offsets[1:], len(pieces) - 1)
        n = sizes[seq]
        upto = np.cumsum(n)
        step = np.ones(int(upto[-1]) if len(upto) else 0, np.int32)
        some = np.flatnonzero(n)
        # Places in ``flat``: on by one within a piece, a jump where the next begins.
        first = begins[seq[some]]
        step[upto[some] - n[some]] = np.diff(first, prepend=1) - np.append(0, n[some][:-1] - 1)
        if len(step):
            step[0] = first[0]
        return flat[np.cumsum(step)], upto[offsets[1:] + np.arange(len(offsets) - 1)]

    return by_texts if way == "texts" else by_words


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, vocabulary: int | None = None, **layout) -> DataFrame:
    """Encode, write shards below ``path``, return the manifest.  ``tokenizer``: the text of a tokenizers file."""
    from tokenizers import Tokenizer

    shape = Layout(width(max(vocabulary or Tokenizer.from_str(tokenizer).get_vocab_size(), end_id + 1)), **layout)
    body = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, part, seq, made, shard = encoder(body.value), TaskContext.get().partitionId(), 0, [], ShardWriter(shape)

        def close():
            nonlocal seq, shard
            file = f"{path}/{part:06d}-{seq:04d}-{uuid.uuid4().hex[:12]}.tok"
            shard.write(file)
            made.append((part, seq, file, len(shard.docs), shard.n_tokens))
            seq, shard = seq + 1, ShardWriter(shape)

        for batch in batches:
            # About a million words at a time, whatever the batch holds.
            for a in range(0, batch.num_rows, 2048):
                piece = batch.slice(a, 2048)
                ids, ends = encode(piece.column("text"), end_id)
                shard.add(piece.column("doc_id").to_pylist(), ids, ends)
                if shard.n_tokens >= shape.shard_ids:
                    close()
        if shard.docs:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "seq", "file", "n_docs", "n_tokens"), m, strict=True)) for m in made], schema=pa.schema(
            [("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    # Equal rows are told apart by their place, so that very many of them are dealt to many ranges.
    rows = texts(docs).withColumns({"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange("doc_id", "_tie", "_row").sortWithinPartitions("doc_id", "_tie", "text", "_row").drop("_tie", "_row")
    return stored(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, of_doc, schema: str) -> DataFrame:
    """(doc_id, start, n_tokens, …) of all documents in the listed shards.

    ``of_doc(ids)`` gives the further columns of ``schema`` as a tuple.  ``start`` counts the ids of all documents before.
    """
    # One row per shard: the only unpartitioned window here runs over file names.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))
    spread = listed.repartition(max(1, min(manifest.count(), 20_000)), "file")
    full = f"doc_id long, start long, n_tokens long{', ' if schema else ''}{schema}"
    names = [c.split()[0] for c in full.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard, at = Shard(row["file"]), 0
                while at < len(shard.docs):  # about 4 million ids at a time
                    to = max(at + 1, int(np.searchsorted(shard.starts, shard.starts[at] + (1 << 22), "right")) - 1)
                    starts = shard.starts[at : to + 1]
                    ids = shard.ids(int(starts[0]), int(starts[-1]))
                    local = starts - starts[0]
                    extra = [of_doc(ids[local[k] : local[k + 1]]) for k in range(to - at)]
                    cols = [
                        pa.array(shard.docs[at:to], pa.int64(), mask=shard.null[at:to]),
                        pa.array(starts[:-1] + row["base"], pa.int64()),
                        pa.array(np.diff(starts), pa.int64()),
                        *[pa.array([e[k] for e in extra]) for k in range(len(names) - 3)],
                    ]
                    yield pa.RecordBatch.from_arrays(cols, names=names)
                    at = to

    return spread.mapInArrow(run, full)


def crc_of_ids(ids: np.ndarray) -> tuple:
    return (zlib.crc32(ids.astype("<u4").tobytes()),)


def encode_and_read(docs: DataFrame) -> DataFrame:
    """Write all documents as token files and describe each from what the files hold."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        body = f.read()
    manifest = write_tokens(docs, fresh_path(docs.sparkSession, "token-files"), body)
    return read_tokens(manifest, crc_of_ids, "ids_crc32 long")


@query("op1_token_files")
def token_files(spark, sf):
    """Start, length and checksum of every document's ids, read back from the files."""
    return encode_and_read(table(spark, sf, "documents"))
