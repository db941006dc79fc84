"""Secret scans with an incremental ledger of blobs.

Every version of every text is addressed by its SHA-256, every rule by a digest of all its parts.  A
ledger keeps which (blob, rule) pairs have been scanned and what was found; a run scans only pairs the
ledger lacks, each blob once however many paths hold it, and joins findings back to all paths.  A rule
that is changed scans anew, and it alone; only the rows of a run's own blobs are reported from.
DataFrame functions only.

A match's place comes from the lengths of the pieces between matches (``split``) and of the matches
(``regexp_extract_all``), summed in order.  Starts and ends are code points, ends exclusive.

Null texts count as empty ones (a blob without findings); a null id is a path like any other; repeated
rows give repeated rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thalweg.llm.common import stored, texts
from thalweg.llm.registry import query, table
from thalweg.session import fresh_path

ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


class Rule(NamedTuple):
    """``pattern`` finds leftmost matches without overlap; shorter than ``least`` characters (of ``group``) don't count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: A long run is the same match whether its least length is in the pattern or tested afterwards; not so for assignments.
RULES = (
    Rule("assign", ASSIGN, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
BASE = ("assign", "access", "hex")
RULE_VERSION = "2"

LEDGER = "blob string, scanned array<string>, found array<struct<rule:string,gaps:array<int>,sizes:array<int>,wide:array<int>>>, rule_version string"


def digest(rule: Rule) -> str:
    """The version of one rule: a rule that is changed in any part is another one, whatever its set is called."""
    return hashlib.sha256(repr(tuple(rule)).encode()).hexdigest()[:32]


def blobs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, blob, text): every path with the address of its text."""
    return texts(docs, id_col, text_col).withColumn("blob", F.sha2("text", 256))


def _found(rule: Rule):
    sizes = lambda found: F.transform(found, lambda x: F.char_length(x))
    p = F.lit(rule.pattern)
    return F.when(
        F.array_contains("missing", digest(rule)) & F.col("text").rlike(rule.pattern),
        F.struct(
            F.lit(digest(rule)).alias("rule"),
            sizes(F.split("text", rule.pattern, -1)).alias("gaps"),
            sizes(F.regexp_extract_all("text", p, F.lit(0))).alias("sizes"),
            sizes(F.regexp_extract_all("text", p, F.lit(rule.group))).alias("wide"),
        ),
    )


def scan(unseen: DataFrame, rules=RULES, version: str = RULE_VERSION) -> DataFrame:
    """One ledger row per blob of ``unseen`` (blob, text, missing), also where nothing is found; only rules in ``missing`` are tried."""
    found = F.filter(F.array(*[_found(r) for r in rules]), lambda x: x.isNotNull())
    return unseen.select("blob", F.col("missing").alias("scanned"), found.alias("found"), F.lit(version).alias("rule_version"))


class BlobLedger:
    """Scanned (blob, rule) pairs under one folder; rows are only ever appended.

    A row holds the digests of the rules a run tried on a blob.  The name of the set of rules
    (``rule_version``) is kept beside them and decides nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self, version: str | None = None) -> DataFrame | None:
        jvm = self.spark._jvm
        there = jvm.org.apache.hadoop.fs.Path(self.path)
        if not there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there):
            return None
        held = self.spark.read.schema(LEDGER).parquet(self.path)
        return held if version is None else held.filter(F.col("rule_version") == version)

    def update(self, paths: DataFrame, rules=RULES, version: str = RULE_VERSION) -> DataFrame:
        """Scan what is unseen in ``paths`` (doc_id, blob, text) and return the ledger's rows of their blobs."""
        known, wanted = self.rows(), F.array(*[F.lit(digest(r)) for r in rules])
        if known is not None:
            own = known.join(paths.select("blob").distinct(), "blob", "left_semi")
            seen = stored(own.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("tried")), "secret-seen")
            paths = paths.join(seen.filter(F.size(F.array_except(wanted, "tried")) == 0).select("blob"), "blob", "left_anti")
        # Copies of a blob meet on the map side first, so a text that a third of all paths hold is one row per task.
        unseen = paths.groupBy("blob").agg(F.first("text").alias("text"))
        if known is None:
            unseen = unseen.withColumn("missing", wanted)
        else:
            unseen = unseen.join(seen, "blob", "left").withColumn("missing", F.array_except(wanted, F.coalesce("tried", F.array().cast("array<string>")))).drop("tried")
        scan(unseen, rules, version).write.mode("append").option("compression", "zstd").partitionBy("rule_version").parquet(self.path)
        return self.rows()


def findings(ledger: DataFrame, rules=RULES) -> DataFrame:
    """(blob, kind, start, end) of every finding of ``rules`` in the ledger's rows."""
    named = F.create_map(*[x for r in rules for x in (F.lit(digest(r)), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least")))])
    one = (
        ledger.select("blob", F.explode("found").alias("f"))
        .select("blob", "f.rule", F.posexplode(F.arrays_zip(F.slice("f.gaps", F.lit(1), F.size("f.sizes")).alias("gap"), F.col("f.sizes").alias("size"), F.col("f.wide").alias("wide"))))
        .select("blob", "rule", F.try_element_at(named, F.col("rule")).alias("of"), "pos", "col.gap", "col.size", "col.wide")
        .filter("of IS NOT NULL")
    )
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("blob", "rule").orderBy("pos"))
    return (
        one.withColumn("end", upto.cast("long"))
        .filter(F.col("wide") >= F.col("of.least"))
        .select("blob", F.col("of.kind").alias("kind"), (F.col("end") - F.col("size")).alias("start"), "end")
    )


def report(paths: DataFrame, found: DataFrame, kinds) -> DataFrame:
    """Findings joined back to every path, one row per path: counts by kind, digest of the base spans, all spans."""
    rank = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)]), F.col("kind"))
    spans = found.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("all"))
    text = lambda items: F.concat_ws(",", F.transform(items, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))))
    of = lambda kind: F.coalesce(F.size(F.filter("all", lambda x: x.kind == kind)), F.lit(0)).cast("long").alias(f"n_{kind}")
    base = F.filter("all", lambda x: x.kind.isin(*BASE))
    per_blob = spans.select("blob", *[of(k) for k in BASE], text(base).alias("base"), text(F.col("all")).alias("spans"))
    # A table of its own, so the join can split a blob that very many paths hold.
    out = paths.select("doc_id", "blob").join(stored(per_blob, "secret-spans"), "blob", "left")
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def scan_documents(docs: DataFrame, ledger: BlobLedger, rules=RULES, version: str = RULE_VERSION) -> DataFrame:
    """Bring the ledger up to date with ``docs`` and report every document."""
    paths, first = blobs(docs), ledger.rows() is None
    rows = ledger.update(paths, rules, version)
    if not first:  # a ledger that was empty holds nothing but these blobs
        rows = rows.join(paths.select("blob").distinct(), "blob", "left_semi")
    return report(paths, findings(rows, rules), [r.kind for r in rules])


def _duck(kind: str, pattern: str, group: int, least: int, rank: int) -> str:
    rx = pattern.replace("'", "''")
    return f"""
SELECT doc_id, '{kind}' AS kind, {rank} AS rank, start, start + size AS stop FROM (
  SELECT doc_id, size, wide, sum(gap + size) OVER (PARTITION BY doc_id ORDER BY i) - size AS start FROM (
    SELECT doc_id, unnest(range(1, len(m) + 1)) AS i, unnest(list_transform(g[1:len(m)], lambda x: length(x))) AS gap,
      unnest(list_transform(m, lambda x: length(x))) AS size, unnest(list_transform(w, lambda x: length(x))) AS wide
    FROM (SELECT doc_id, string_split_regex(text, '{rx}') AS g, regexp_extract_all(text, '{rx}', 0) AS m, regexp_extract_all(text, '{rx}', {group}) AS w
      FROM d WHERE regexp_matches(text, '{rx}'))))
WHERE wide >= {least}"""


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({' UNION ALL '.join(_duck(*r, i) for i, r in enumerate(RULES))}),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(concat(kind, ':', CAST(start AS BIGINT), ':', CAST(stop AS BIGINT)), ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
  string_agg(concat(kind, ':', CAST(start AS BIGINT), ':', CAST(stop AS BIGINT)), ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per ON d.doc_id = per.doc_id"""


@query("op10_secret_scan", ORACLE)
def secret_scan(spark, sf):
    """Every document's secrets, through a ledger that starts empty."""
    return scan_documents(table(spark, sf, "documents"), BlobLedger(spark, fresh_path(spark, "secret-ledger")))


@query("secret_scan_incremental", ORACLE)
def secret_scan_incremental(spark, sf):
    """The same through a ledger that knows half of the blobs, and those by three rules only."""
    docs, book = table(spark, sf, "documents"), BlobLedger(spark, fresh_path(spark, "secret-ledger"))
    book.update(blobs(docs.filter("doc_id % 2 = 0")), RULES[:3])
    return scan_documents(docs, book)
