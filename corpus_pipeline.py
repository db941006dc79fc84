"""The corpus pipeline and the list of all corpus queries.

Five stages, each over all that the stage before it kept.  Null texts are empty ones throughout, rows
without an id are kept, and an empty table passes through all stages.
"""

from __future__ import annotations

from importlib import import_module

from thalweg.llm import decontaminate, jaccard_join, mixing, token_files, toxicity
from thalweg.llm.common import prepared, stored
from thalweg.llm.registry import ORACLES, QUERIES, table

MODULES = ("token_files", "chat_format", "mixing", "bloom_lm", "decontaminate", "chunk_dedup", "jaccard_join", "quality_ledger", "toxicity", "secret_ledger", "whitening", "language_id", "importance")

for _module in MODULES:
    import_module(f"thalweg.llm.{_module}")


def drop_toxic(spark, docs, sf_dir):
    """Documents that the calibrated score rejects go."""
    return toxicity.reject_toxic(docs, table(prepared(spark), sf_dir, "labels"))


def drop_near_copies(spark, docs, sf_dir):
    """The first document of each class of near copies stays."""
    prepared(spark)
    return jaccard_join.keep_one(docs)


def drop_leaked(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(prepared(spark), sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """As many tokens as there are, no source drawn more than twice over; a document may come twice."""
    prepared(spark)
    return mixing.draw(docs, mixing.Mix(), marks=False)


def to_tokens(spark, docs, sf_dir):
    """Token files of what is left, described from the files."""
    prepared(spark)
    return token_files.encode_and_read(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_leaked),
    ("mixing", mix_sources),
    ("token_files", to_tokens),
]
#: Trees, alignment and the tokenizer can't be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each is written as Parquet and read again as the next one's input."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = run
