"""The corpus pipeline: five operators of marlstone.llm in a row, over the documents table.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import decontaminate, near_dedup, packing, pii, quality
from marlstone.llm.common import Scratch, free_name, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the quality rules; the others go."""
    name = free_name(docs, "ledger")
    return quality.ledger(docs, out=name).where(quality.passes(F.col(name).fail_bits)).select(*docs.columns)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each class of near duplicates."""
    name = free_name(docs, "near")
    return near_dedup.classes(docs, out=name).where(F.col(name).first).select(*docs.columns)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages cover less than a twentieth of the words, without passages of more than LONGEST words."""
    hits, clean = free_name(docs, "hits"), free_name(docs, "clean")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), out=hits).where(~decontaminate.contaminated(F.col(hits)))
    cut = decontaminate.remove_spans(found, hits=hits, longest=LONGEST, out=clean)
    same = F.col(clean).eqNullSafe(F.col("text"))
    changed = {"text": F.col(clean), "n_chars": F.when(same, F.col("n_chars")).otherwise(F.length(clean).cast("long"))}
    return cut.select(*(changed[c].alias(c) if c in changed else c for c in docs.columns))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and telling terms replaced in the text; n_chars follows the text."""
    name = free_name(docs, "pii")
    p = F.col(name)
    changed = {"text": p.text, "n_chars": F.when(p.changed, F.length(p.text).cast("long")).otherwise(F.col("n_chars"))}
    return pii.sanitise(docs, out=name).select(*(changed[c].alias(c) if c in changed else c for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with a checksum of their tokens."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("token_bytes").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


#: Words of a benchmark passage that may stay in a document that is clean otherwise: two windows.
LONGEST = 2 * decontaminate.WINDOW

STAGES = [
    ("quality_rules", keep_good),
    ("minhash_near_dedup", keep_first_copies),
    ("decontamination", keep_uncontaminated),
    ("pii", sanitise),
    ("packing", pack),
]

#: Near duplicates, co-occurrence and tokenizing are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder and read again, and go when the next stage's are there."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
