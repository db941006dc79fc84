"""Quality rules as a ledger of bitmasks.

Every rule is evaluated once per document.  The ledger keeps the measurements and one bit per failed
rule; policies are versioned masks over those bits, so a new policy or an ablation reads the ledger
and never the texts.  DataFrame functions only; no shuffle is needed.

A null text is an empty one and fails the base rules.  Nulls in other columns don't matter, repeated
rows are judged alike, an empty table gives an empty ledger, further columns are ignored.  Windows of
three words are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.common import sql_words, stored, texts
from thalweg.llm.registry import query, table

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: name, condition of failure over the measurements.  A rule's bit is its place; new rules go to the end.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "n_dup_lines > 0 AND 100 * n_dup_lines > 50 * n_lines"),
)
BASE_MASK = 0b11
#: Policies by version: the bits that reject a document.
POLICIES = {1: 0b000011, 2: 0b111111}
CURRENT = 2


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements of every text, in two projections without a shuffle."""
    words = F.col("_words")
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")
    read = texts(docs, id_col, text_col).select(
        "doc_id",
        sql_words(F.col("text")).alias("_words"),
        lines.alias("_lines"),
        (F.char_length("text") - F.char_length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.char_length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
    )
    n = F.size("_words")
    at = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    window = F.transform(at, lambda i: F.struct(F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)).alias("h"), i.alias("i")))
    sorted_ = read.withColumn("_sorted", F.sort_array(window))
    last = F.size("_sorted")
    hash_at = lambda k: F.get("_sorted", k).getField("h")
    again = F.filter("_sorted", lambda x, k: F.coalesce(x.h == hash_at(k - 1), F.lit(False)) | F.coalesce(x.h == hash_at(k + 1), F.lit(False)))
    places = sorted_.withColumn("_again", F.when(last > 1, F.sort_array(F.transform(again, lambda x: x.i))).otherwise(F.array().cast("array<int>")))
    covered = F.aggregate(
        F.transform("_again", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("_again", k + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return places.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def ledger(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, measurements and ``fail_bits``: bit k is set where rule k fails."""
    bits = F.lit(0).cast("long")
    for k, (_, failed) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, id_col, text_col).withColumn("fail_bits", bits)


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The ledger as a table: policies and ablations read it, and no text again."""
    return stored(ledger(docs), "quality-ledger")


def apply_policy(book: DataFrame, version: int = CURRENT, policies=POLICIES) -> DataFrame:
    """The ledger with ``policy`` and ``kept`` for one policy."""
    hit = F.col("fail_bits").bitwiseAND(F.lit(policies[version]).cast("long"))
    return book.withColumn("policy", F.lit(version)).withColumn("kept", hit == 0)


def ablations(book: DataFrame, rules=RULES, policies=POLICIES) -> DataFrame:
    """(policy, rule, failed, only_rule, kept, kept_without): one pass over the bits, combined on the map side."""
    def count(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    cells = []
    for version, mask in policies.items():
        of = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
        for k, (name, _) in enumerate(rules):
            if mask >> k & 1:
                bit = F.lit(1 << k).cast("long")
                cells.append(F.struct(
                    F.lit(version).alias("policy"), F.lit(name).alias("rule"),
                    F.coalesce(count(of.bitwiseAND(bit) != 0), F.lit(0)).alias("failed"), F.coalesce(count(of == bit), F.lit(0)).alias("only_rule"),
                    F.coalesce(count(of == 0), F.lit(0)).alias("kept"),
                    F.coalesce(count(of.bitwiseAND(F.lit(mask & ~(1 << k)).cast("long")) == 0), F.lit(0)).alias("kept_without"),
                ))
    return book.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT doc_id, w, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM (SELECT doc_id, text, {WORDS} AS w FROM d)),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM (
    SELECT doc_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS gram FROM (SELECT doc_id, w, unnest(range(1, n_words - 1)) AS i FROM m WHERE n_words > 2))),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE times > 1) GROUP BY doc_id),
v AS (SELECT m.doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines FROM m LEFT JOIN r ON m.doc_id = r.doc_id),
b AS (SELECT *, CAST({' + '.join(f"CASE WHEN {cond} THEN {1 << k} ELSE 0 END" for k, (_, cond) in enumerate(RULES))} AS BIGINT) AS fail_bits FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {BASE_MASK}) <> 0 AS base_failed,
  (fail_bits & {POLICIES[CURRENT]}) = 0 AS kept, fail_bits FROM b"""


@query("op8_quality_rules", ORACLE)
def quality_rules(spark, sf):
    """Measurements, failure bits and the verdict of the current policy for every document."""
    book = apply_policy(stored_ledger(table(spark, sf, "documents")))
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE_MASK).cast("long")) != 0
    return book.select("doc_id", *MEASURES, base.alias("base_failed"), "kept", "fail_bits")


ABLATIONS = ORACLE[: ORACLE.rindex("SELECT doc_id, n_words, word_chars")] + "\nUNION ALL ".join(
    f"""SELECT {version} AS policy, '{name}' AS rule, count(*) FILTER ((fail_bits & {mask & 1 << k}) <> 0) AS failed,
  count(*) FILTER ((fail_bits & {mask}) = {1 << k}) AS only_rule, count(*) FILTER ((fail_bits & {mask}) = 0) AS kept,
  count(*) FILTER ((fail_bits & {mask & ~(1 << k)}) = 0) AS kept_without FROM b"""
    for version, mask in POLICIES.items()
    for k, (name, _) in enumerate(RULES)
    if mask >> k & 1
)


@query("quality_ablations", ABLATIONS)
def quality_ablations(spark, sf):
    """What each rule of each policy rejects, and what would be kept without it, from the stored ledger."""
    return ablations(stored_ledger(table(spark, sf, "documents")))
