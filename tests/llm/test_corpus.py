"""The corpus operators: SQL where it can express them, else brute force, round trips and held-out accuracy."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import compare, connect
from thalweg.llm import bloom_lm, chat_format, chunk_dedup, decontaminate, jaccard_join, mixing, quality_ledger, secret_ledger, token_files, toxicity
from thalweg.llm.common import prepared
from thalweg.session import fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, h long, node long, n int"


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "ko", "mi", "ten", "sul", "ra", "vo"]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    prepared(spark)
    a, long = words(120, 1), words(60_000, 2)
    near = a.split()
    near[60] = "changed"
    leak = words(30, 9)
    rows = [(1, a), (2, a), (2, a), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (None, words(80, 3)), (7, long), (8, words(3, 4)), (9, words(100, 5) + " " + leak + " " + words(90, 6)), (10, "password=abcdef12 " * 40), (11, "x\ny\nx\n\n" * 30)]
    return spark.createDataFrame([(i, t, None, None if i == 3 else "s%d" % ((i or 0) % 2), None, "r", 5, 7, 1) for i, t in rows], SCHEMA), leak


@pytest.fixture(scope="module")
def none(spark):
    return prepared(spark).createDataFrame([], SCHEMA)


@pytest.mark.parametrize("key", sorted(corpus_pipeline.ORACLES))
def test_sql(spark, sf, key):
    assert compare(spark, connect(sf), corpus_pipeline.QUERIES[key], corpus_pipeline.ORACLES[key], sf)[1] is None


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    links, root = collections.Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    heads = collections.defaultdict(list)
    for i in range(len(rows)):
        heads[find(i)].append(rows[i][0])
    return sorted(((rows[i][0], min((x for x in heads[find(i)] if x is not None), default=None), links[i]) for i in range(len(rows))), key=str)


def test_jaccard_join_is_brute_force(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd[0].select(F.col("doc_id") + 1_000_000, "text").toDF("doc_id", "text"))
    rows = [tuple(r) for r in docs.collect()]
    for options in (jaccard_join.Join(), jaccard_join.Join(block=3, block_shingles=500)):
        got = jaccard_join.classes(docs, options).select("doc_id", "class_id", "n_links").collect()
        assert sorted(map(tuple, got), key=str) == brute_classes(rows)


def test_jaccard_join_keeps_one_of_each_class(spark, odd, none):
    kept = [r.doc_id for r in jaccard_join.keep_one(odd[0]).collect()]
    assert sorted(kept, key=str) == sorted([1, 4, 5, 6, 7, 8, 9, 10, 11, None], key=str)
    assert jaccard_join.classes(none).count() == 0


def test_overlaps_agree_and_posterior_is_monotone():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 300, 120).astype(np.uint64)) for _ in range(40)]
    i, j = (x.ravel() for x in np.indices((40, 40)))
    want = [len(set(sets[a].tolist()) & set(sets[b].tolist())) for a, b in zip(i, j, strict=True)]
    assert jaccard_join.overlaps(sets, sets, i, j).tolist() == want
    least = [m for _, m in jaccard_join.floors(jaccard_join.Join())]
    assert least == sorted(least) and least[-1] < 0.8 * 240


@pytest.mark.parametrize("bits", [1, 7, 8, 16, 17, 32])
def test_packing_round_trip(tmp_path, bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    assert (token_files.unpack(token_files.pack(ids, bits), 1000, bits) == ids).all()
    w = token_files.ShardWriter(token_files.Layout(bits, 24 if bits != 7 else 25))
    w.add([3, None], ids, np.array([400, 1000]))
    w.write(str(tmp_path / "s" / "x.tok"))
    shard = token_files.Shard(str(tmp_path / "s" / "x.tok"))
    assert shard.starts.tolist() == [0, 400, 1000] and shard.null.tolist() == [False, True]
    for a, b in ((0, 1000), (399, 401), (23, 24), (976, 1000), (5, 5)):
        assert (shard.ids(a, b) == ids[a:b]).all()


def test_token_files(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted(((r.doc_id, r.text or "") for r in odd[0].collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    start, want = 0, []
    for i, t in rows:
        ids = [*model.encode(t, add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in token_files.encode_and_read(odd[0]).collect()), key=lambda r: r[1])
    assert got == want
    assert token_files.encode_and_read(none).count() == 0


def test_encoder_equals_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        body = f.read()
    model, encode, r = Tokenizer.from_str(body), token_files.encoder(body), random.Random(3)
    alphabet = [*"aAbB.,;:!?'sStTdD \t\n\x0b\x0c\r09<|>-éÉßİıJΣς²ªÅ日", "̌", "́", "<|endoftext|>", "<|ENDOFTEXT|>", "'re"]
    made = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(5000)]
    ids, ends = encode(pa.array(made), 1)
    for t, a, b in zip(made, [0, *ends[:-1]], ends, strict=True):
        assert ids[a:b].tolist() == [*model.encode(t, add_special_tokens=False).ids, 1], repr(t)


def brute_lm(rows, model):
    count, pairs, texts = collections.Counter(), collections.Counter(), 0
    made = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    for (_, w), h in zip(made, held, strict=True):
        if not h:
            count.update(w)
            texts += 1
            pairs.update(zip([0, *w[:-1]], w, strict=True))
    n, v, mid = sum(count.values()), len(count), bloom_lm.middles(model.base)
    for (i, w), h in zip(made, held, strict=True):
        p = [(count[x] + 0.1) / (n + 0.1 * (v + 1)) for x in w]
        read = [mid[int(bloom_lm.levels(np.array([pairs[k]]), model.base)[0])] if pairs[k] else 0.0 for k in zip([0, *w[:-1]], w, strict=True)]
        before = [texts if x == 0 else count[x] for x in [0, *w[:-1]]]
        yield (i, h, len(w), sum(count[x] > 0 for x in w), n), sum(map(math.log10, p)), sum(math.log10((c + model.mu * q) / (b + model.mu)) for c, q, b in zip(read, p, before, strict=True))


@pytest.mark.parametrize("small", [False, True])
def test_bloom_lm(spark, odd, small):
    model = bloom_lm.Model(bits_per_key=64, bucket_entries=5000, segment_bytes=40_000) if small else bloom_lm.Model(bits_per_key=64)
    rows = [(r.doc_id, r.text) for r in odd[0].collect()]
    got = sorted((tuple(r) for r in bloom_lm.score_texts(odd[0], model).collect()), key=str)
    for g, (exact, base, score) in zip(got, sorted(brute_lm(rows, model), key=str), strict=True):
        assert g[:5] == exact and g[5] == pytest.approx(base, rel=1e-9)
        assert abs(g[6] - score) <= 1e-9 + 1e-3 * g[2]


def test_bloom_lm_of_nothing(spark, none):
    assert bloom_lm.score_texts(none).count() == 0


def test_decontaminate(spark, odd, none):
    leak = odd[1].split()
    edited = [w for k, w in enumerate(leak) if k not in (7, 21)]
    edited[12] = "other"
    docs = odd[0].unionByName(odd[0].limit(1).withColumn("doc_id", F.lit(50).cast("long")).withColumn("text", F.lit(words(40, 11) + " " + ", ".join(edited).upper() + " " + words(40, 12))))
    items = spark.createDataFrame([(1, odd[1]), (2, None), (3, ""), (4, words(25, 77)), (None, "zz")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs, items).collect()}
    assert set(got) == {(9, 1), (50, 1)}
    assert got[9, 1].similarity == 1.0 and (got[9, 1].first_word, got[9, 1].last_word) == (100, 129)
    split = decontaminate.find_leaks(docs, items, decontaminate.Search(block_words=10)).collect()
    assert {(r.doc_id, r.item_id) for r in split} == set(got)
    kept = decontaminate.drop_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert decontaminate.find_leaks(none, items).count() == 0


def brute_align(a, b):
    h, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_is_brute_force():
    r = np.random.default_rng(4)
    for _ in range(60):
        a, b = r.integers(0, 4, r.integers(1, 25)), r.integers(0, 4, r.integers(1, 40))
        assert decontaminate.align(a, b)[0] == brute_align(a.tolist(), b.tolist())


def test_chunks_find_shifted_passages(spark, none):
    passage = words(60, 21)
    rows = [(k, words(70 + k, 100 + k) + " " + passage + " " + words(50, 200 + k)) for k in range(30)] + [(100 + k, words(200, 300 + k)) for k in range(30)] + [(None, None), (200, "")]
    docs = prepared(spark).createDataFrame(rows, "doc_id long, text string")
    got = chunk_dedup.repeated_passages(docs).collect()
    assert {r.doc_id for r in got} == set(range(30))
    by_id = dict(rows)
    assert all(by_id[r.doc_id].encode()[r.begin : r.end].decode() in by_id[r.doc_id] and r.n_words >= 20 for r in got)
    assert sum(r.first for r in got) <= 3
    data = np.frombuffer(words(500, 9).encode(), np.uint8)
    ends = chunk_dedup.cuts(data, chunk_dedup.Cuts())
    assert ends[-1] == len(data) and (np.diff(ends) > 0).all() and np.diff(ends, prepend=0).max() <= 256
    assert chunk_dedup.repeated_passages(none).count() == 0


def repeated_runs(rows, n):
    """By brute force: (row, first byte, last byte) of all runs of ``n`` words that come up more than once."""
    seen = collections.defaultdict(list)
    for k, text in enumerate(rows):
        raw = (text or "").encode()
        spans = [x.span() for x in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", raw)]
        for a in range(len(spans) - n + 1):
            begin, end = spans[a][0], spans[a + n - 1][1]
            seen[raw[begin:end]].append((k, begin, end))
    return {run: places for run, places in seen.items() if len(places) > 1}


def test_passages_are_brute_force(spark):
    """Passages of 49 to 60 words, each in two texts, beside odd texts: every one is found, to the byte."""
    rows = [None, "", " \n ", "a b " * 200, "c\td  " * 100, "a b " * 90, words(48, 5000), words(48, 5000)]
    for k in range(240):
        passage, glue = words(49 + k % 12, 1000 + k), "x" * (k % 12 > 1)
        rows += [f"{words(k % 7, 2000 + k)} {glue}{passage}{glue} {words(9, 3000 + k)}", f"{words(30, 4000 + k)} {passage}"]
    made = collections.defaultdict(set)
    for k, begin, end in (x for places in repeated_runs(rows, 49).values() for x in places):
        made[k].update(range(begin, end))
    docs = prepared(spark).createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = collections.defaultdict(set)
    for r in chunk_dedup.repeated_windows(docs, chunk_dedup.Passages()).collect():
        got[r.doc_id].update(range(r.begin, r.end))
    assert len(made) == 482 + 1 and got == made
    assert {r.doc_id for r in chunk_dedup.repeated_passages(docs).collect()} == set(made)


def test_passages_take_a_row_per_chunk_not_per_word(spark):
    """Copies, edited copies and texts of few words, against brute force: places, counts and which is first; long copies take few rows."""
    r = np.random.default_rng(8)
    base = [words(int(r.integers(40, 400)), 700 + k).split() for k in range(12)] + [list(r.choice(["a", "b"], 300)), ["c", "d", "e"] * 80]
    rows = [None, "", " \n "]
    for _ in range(160):
        x = [w for k in r.integers(0, len(base), r.integers(1, 4)) for w in base[k][int(r.integers(0, 30)) :]]
        for at in r.integers(0, len(x), r.integers(0, 4)):
            x[at] = f"edit{r.integers(3)}"
        rows.append(" ".join(x) if r.random() < 0.8 else "\t ".join(x) + "\n")
    rows += [words(3000, 90)] * 20
    docs = prepared(spark).createDataFrame([(k % 50, text) for k, text in enumerate(rows)], "doc_id long, text string").coalesce(1)
    found = chunk_dedup.repeated_windows(docs, chunk_dedup.Passages())
    got = {}
    for x in found.collect():
        spans = [m.span() for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", rows[x.row_id].encode())]
        assert x.doc_id == x.row_id % 50 and (x.begin, x.end) == (spans[x.place][0], spans[x.last + 48][1])
        for place in range(x.place, x.last + 1):
            assert (x.row_id, spans[place][0], spans[place + 48][1]) not in got
            got[x.row_id, spans[place][0], spans[place + 48][1]] = (x.n, x.first)
    want = {}
    for places in repeated_runs(rows, 49).values():
        want |= {at: (len(places), at == min(places)) for at in places}
    assert got == want and len(want) > 60_000
    assert found.filter(f"row_id >= {len(rows) - 20}").count() < 20 * 2952 / 5


def test_what_is_first_is_kept_once(spark):
    """Neighbouring passages of other texts, copies within one text, passages with a word more in some texts."""
    p, q, s, t = words(60, 31), words(55, 32), words(70, 33), words(64, 36)
    rows = [p, f"{p} {q}", q, f"{s} {words(20, 34)} {s}", f"{words(12, 35)} {s} {p}", f"{q} {s}", t, f"{t} more", f"{t} more", "a b " * 200]
    docs = prepared(spark).createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(1)
    got = chunk_dedup.repeated_passages(docs).collect()
    assert sorted((r.doc_id, r.n_words) for r in got if r.first) == [(0, 60), (1, 55), (3, 70), (6, 64)]
    left = [bytearray(text.encode()) for text in rows]
    for r in got:
        if not r.first:
            left[r.doc_id][r.begin : r.end] = b"\0" * (r.end - r.begin)
    for run, places in repeated_runs(rows, 49).items():
        assert sum(left[k][begin:end] == run for k, begin, end in places) <= 1
    left = [x.replace(b"\0", b"").decode() for x in left]
    assert all(sum(x.count(passage) for x in left) == 1 for passage in (p, q, s, t))
    assert [x.split() for x in left[6:]] == [t.split(), ["more"], [], ["a", "b"]]


def test_secret_ledger_scans_only_unseen(spark, odd, none):
    book = secret_ledger.BlobLedger(spark, fresh_path(spark, "ledger"))
    first = secret_ledger.scan_documents(odd[0].limit(5), book).count()
    seen = book.rows(secret_ledger.RULE_VERSION).count()
    out = {r.doc_id: r for r in secret_ledger.scan_documents(odd[0], book).collect()}
    total = book.rows(secret_ledger.RULE_VERSION).count()
    secret_ledger.scan_documents(odd[0], book).count()
    assert first == 5 and seen < total == book.rows(secret_ledger.RULE_VERSION).count() == odd[0].select(F.coalesce("text", F.lit(""))).distinct().count()
    assert out[10].n_assign == 40 and out[10].spans.startswith("assign:0:17,assign:18:35") and out[4].spans == ""
    assert secret_ledger.scan_documents(none, secret_ledger.BlobLedger(spark, fresh_path(spark, "ledger"))).count() == 0


def test_quality_ledger(odd, none):
    book = quality_ledger.apply_policy(quality_ledger.ledger(odd[0]))
    rows = {r.doc_id: r for r in book.collect()}
    assert rows[10].n_repeat_words == 40 and rows[11].n_dup_lines == 88 and not rows[4].kept and rows[7].kept
    cells = {(r.policy, r.rule): r for r in quality_ledger.ablations(book).collect()}
    kept = sum(r.kept for r in book.collect())
    for k, (name, _) in enumerate(quality_ledger.RULES):
        cell, mask = cells[2, name], quality_ledger.POLICIES[2]
        assert cell.kept == kept and cell.kept_without == sum(r.fail_bits & mask & ~(1 << k) == 0 for r in book.collect())
    assert quality_ledger.ledger(none).count() == 0 and {r.kept for r in quality_ledger.ablations(quality_ledger.ledger(none)).collect()} == {0}


def test_quality_verdicts_and_ablations_come_from_the_stored_ledger(spark, sf):
    made = corpus_pipeline.QUERIES["op8_quality_rules"](spark, sf)
    assert made.inputFiles() and all("quality-ledger" in f for f in made.inputFiles())
    bits = [r.fail_bits for r in made.collect()]
    book = quality_ledger.stored_ledger(spark.read.parquet(f"{sf}/documents.parquet"))
    cells = quality_ledger.ablations(book).collect()
    assert len(cells) == 8
    for r in cells:
        mask, bit = quality_ledger.POLICIES[r.policy], 1 << [name for name, _ in quality_ledger.RULES].index(r.rule)
        hit = [b & mask for b in bits]
        assert (r.failed, r.only_rule, r.kept, r.kept_without) == (sum(b & bit != 0 for b in hit), hit.count(bit), hit.count(0), sum(b & ~bit == 0 for b in hit))


def test_chats_with_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, None, None), (3, 0, "user", "a"), (3, 1, None, None), (None, 0, "user", "x"), (4, None, "user", "q"), (4, 3, "user", None)]
    rows += [(5, k, "user", f"t{k}") for k in range(10)] + [(6, k, "user", f"t{k}") for k in range(7)]
    chats = prepared(spark).createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int")
    got = {(r.conv_id, r.part): r for r in chat_format.format_chats(chats, block=4).collect()}
    assert set(got) == {(2, 0), (4, 0), (5, 0), (5, 1), (5, 2), (4, 1)} - ({(4, 1)} if (4, 1) not in got else set())
    assert got[2, 0].copies == 2 and got[2, 0].text == "<|user|>\na\n<|end|>\n<|unknown|>\n\n<|end|>\n"
    assert "".join(got[5, k].text for k in range(3)).count("<|user|>") == 10
    assert chat_format.format_chats(chats.limit(0)).count() == 0


def test_mixing_meets_its_target(spark, sf, odd, none):
    docs = prepared(spark).read.parquet(f"{sf}/documents.parquet")
    sizes = docs.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), r"\s+"))).alias("tokens"))
    t = {r.source: r.tokens for r in sizes.collect()}
    total = sum(t.values())
    for mix in (mixing.Mix("repeats", 2.0, blocks=8), mixing.Mix("entropy", 0.9, blocks=8), mixing.Mix("repeats", 3.0, budget=total // 3, blocks=8)):
        a = mixing.exponent(sizes, mix)
        p = {s: (n / total) ** a for s, n in t.items()}
        w = {s: x / sum(p.values()) for s, x in p.items()}
        budget = mix.budget or total
        if mix.target == "entropy":
            assert -sum(x * math.log(x) for x in w.values()) / math.log(len(w)) >= 0.9 - 1e-9
        else:
            assert max(w[s] * budget / t[s] for s in t) <= mix.value + 1e-9
        drawn = mixing.draw(docs, mix)
        got = {r.source: r.n for r in drawn.groupBy("source").agg(F.sum("_tokens").alias("n")).collect()}
        longest = docs.select(F.max(F.size(F.split("text", r"\s+")))).first()[0]
        assert all(0 <= w[s] * budget - got.get(s, 0) <= longest + 1 for s in t)
        assert drawn.groupBy("doc_id", "_pass").count().filter("count > 1").count() == 0
    assert mixing.draw(none).count() == 0 and set(mixing.draw(odd[0]).columns) >= set(odd[0].columns)


def test_mixing_orders_small_ranges_only(spark, sf):
    """The draw doesn't depend on the ranges, and with them no sorted group grows with the block."""
    docs = prepared(spark).read.parquet(f"{sf}/documents.parquet")
    mix = mixing.Mix("repeats", 3.0, budget=20_000, blocks=2)
    draws = [mixing.draw(docs, mix, range_docs=n) for n in (1 << 40, 4)]
    one, many = (sorted(map(tuple, d.select("doc_id", "_pass", "_place", "_tokens").collect())) for d in draws)
    assert one == many and len(one) > 20
    # By brute force: of each source's edge block, the documents in the hash's order while they fit.
    weighed = mixing.weighed(docs, mix).collect()
    drawn = {i for i, *_ in one}
    for source in {r._source for r in weighed}:
        for block in (0, 1):
            taken = [r.doc_id in drawn for r in sorted((r for r in weighed if (r._source, r._block) == (source, block)), key=lambda r: (r._order, r.doc_id))]
            assert taken == sorted(taken, reverse=True)


def test_mixing_keeps_sources_without_words(spark):
    """Such a source, also the null one, comes once; the others are drawn as without it."""
    some = [(k, words(20 + k, k), "ab"[k % 2]) for k in range(12)]
    bare = [(50, "", "blank"), (51, " \n", "blank"), (52, None, "blank"), (53, "", None), (54, None, None)]
    drawn = lambda rows: sorted((r.doc_id, r._pass) for r in mixing.draw(prepared(spark).createDataFrame(rows, "doc_id long, text string, source string")).collect())
    assert drawn(some + bare) == sorted(drawn(some) + [(k, 0) for k in range(50, 55)])
    assert drawn(bare) == [(k, 0) for k in range(50, 55)]


def test_toxicity_held_out(spark, odd, none):
    base = "/root/testdata/sf0.01"
    docs, labels = prepared(spark).read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    rows = toxicity.judge(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)
    assert sum(r.predicted and not r.toxic for r in rows) <= 0.05 * len(rows)
    empty = labels.limit(0)
    assert [r.score for r in toxicity.judge(odd[0], empty).collect()] == [0.0] * odd[0].count()
    assert toxicity.judge(none, labels).count() == 0
    kept = toxicity.reject_toxic(odd[0], empty)
    assert kept.columns == odd[0].columns and kept.count() == odd[0].count()


def test_pipeline(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start and a.doc_id <= b.doc_id for a, b in zip(rows, rows[1:], strict=False))
    assert 100 < len(rows)
