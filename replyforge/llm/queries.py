"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyforge.llm import automaton, decontaminate, hard_negatives, jaccard_join, language, lexical_search, license_scan, packing, quality_model, quality_rules, suffix_dedup, token_count, token_files
from replyforge.llm.oracles import ORACLES  # noqa: F401  (registered with the queries)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when repeats of earlier documents are cut out."""
    return suffix_dedup.remove_repeats(
        table(spark, sf_dir, "documents"), outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256")
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return jaccard_join.join_components(table(spark, sf_dir, "documents"), percent=85, size=4)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document in the token files, read back from them."""
    folder = token_files.folder_for(spark)
    manifest = token_files.write(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder, end_id=2
    )
    return token_files.read(manifest, folder).withColumnRenamed("key", "doc_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and whether they are more than a context of 1024 holds."""
    counted = token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return automaton.encode_decode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words of every document."""
    marked = decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["first"])
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


#: Least score of a document that counts as good.
GOOD = 0.3


def learnt_quality(spark: SparkSession, sf_dir: str) -> quality_model.Model:
    """The model of the labelled documents that are not held out."""
    return quality_model.learn(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        quality_model.remainder(F.col("doc_id"), 5) != 0,
    )


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and class of every document."""
    scored = quality_model.score(table(spark, sf_dir, "documents"), learnt_quality(spark, sf_dir))
    return scored.select(
        "doc_id",
        (quality_model.remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs, quality_model.remainder(F.col("doc_id"), 4) != 2)
    return language.predict(docs, model).select(
        "doc_id", (quality_model.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document: their number, names and the best containment."""
    return licenses(table(spark, sf_dir, "documents"))


def licenses(docs: DataFrame) -> DataFrame:
    """One row per document; rows with a null key share what any of them holds, like rows that repeat a key."""
    found = license_scan.scan(docs).groupBy(F.col("doc_id").alias("found_id")).agg(
        F.count("*").alias("n_licenses"),
        F.array_join(F.array_sort(F.collect_list("license")), ",").alias("licenses"),
        F.max("containment").alias("containment"),
    )
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select(
        "doc_id",
        F.coalesce("n_licenses", F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 2048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    index = lexical_search.build(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), k=10)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hardest negatives of every hundredth vector's positives."""
    key, label = F.col("vec_id"), F.col("label")
    blocks = hard_negatives.store(
        table(spark, sf_dir, "embeddings"),
        anchor=key % 100 == 0,
        label=F.when(key % 7 == 0, (label + 1) % 10).otherwise(label),
    )
    return hard_negatives.mine(blocks)


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_jaccard_join, op3_token_files, op4_token_counts, op5_bpe_codec, op6_decontaminate, op7_quality_model, op8_language, op9_license_scan, op10_quality_rules, op11_packing, op12_lexical_search, op13_hard_negatives)}
