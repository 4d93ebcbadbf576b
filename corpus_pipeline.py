"""Corpus cleaning: each stage works on all that its predecessor kept.

Documents that the quality classifier rejects go; of each group of near-duplicates the smallest id stays; passages that
an earlier document has, too, are cut out of the later ones; documents with benchmark words go; what is left is encoded.
Between stages the documents are written to the shared folder, so nothing is computed twice or lost with an executor.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and further columns, which all
but the last hand on. Null and empty texts are scored like any other; they are linked with nothing, hold no passage
and no benchmark word, and have no ids. Of rows that repeat a key and its text one is kept; rows with a null key all are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from replyforge.llm import automaton, decontaminate, jaccard_join, quality_model, queries, suffix_dedup
from replyforge.sources.storage import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good ones."""
    return quality_model.keep(docs, queries.learnt_quality(spark, sf_dir), queries.GOOD)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: texts that share 80 % of their five-word shingles."""
    return jaccard_join.deduplicate(docs, percent=80, size=5)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of passages that documents with smaller ids have."""
    carry = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = suffix_dedup.remove_repeats(docs, outputs=("kept_text",), carry=carry)
    named = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*[named.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of a benchmark window."""
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return automaton.encode_decode(docs, path, outputs=("ids", "n_tokens", "decoded_sha256"), pieces=200_000, release=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: No stage but the decontamination can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
