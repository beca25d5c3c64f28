"""The registered queries of the package: thin digests over the operators' own outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordon.llm.scratch import importable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.suffixdedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.quotes import link_quotes

    return link_quotes(table(spark, sf_dir, "conversations"))


def op3_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("detections")


def op4_jaccard_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.jaccard import similar_components

    found = similar_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op5_seed_align_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def op6_candidate_boosting_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.pii import KINDS, find_personal_data
    from cordon.llm.secrets import count_kind, span_text

    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.sort_array(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
        (F.size("base") + F.size("added")).cast("long").alias("n_spans"))


def op7_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from cordon.llm.tokens import read_documents, write_tokens
    from cordon.session import scratch_path

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_documents(spark, path)


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.hostrules import judge

    m = F.col("m")
    return judge(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"), m["n_dup_lines"].alias("n_dup_lines"),
        m["n_repeat_words"].alias("n_repeat_words"), "base_failed", "kept", F.col("n_failed").cast("long").alias("n_failed"),
        (F.round(F.col("host_rate") * 1e6) / 1e6).alias("host_rate"), "host_rejected")


def op9_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.secrets import count_kind, find_secrets, span_text

    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), count_kind(F.col("base"), "assign").alias("n_assign"),
        count_kind(F.col("base"), "access").alias("n_access"), count_kind(F.col("base"), "hex").alias("n_hex"),
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.sort_array(F.concat("base", "added"))).alias("spans"))


def op10_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.mixing import mix_sources

    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op11_postorder_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.merkle import FIELDS, folded, leaf_hash, manifest, proof_hash

    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = leaf_hash(*[F.translate("text", "\n", "") if c == "text" else F.col(c) for c in FIELDS])
    leaf = leaf_hash(*[F.col(c) for c in FIELDS])
    found = manifest(docs, other_leaf=F.when(chosen, tampered).otherwise(leaf))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"),
                        folded(F.col("other"), F.col("proof")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from cordon.llm.bytebpe import decode_ids, encode_texts

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = decode_ids(encode_texts(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return both.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op13_multi_index_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cordon.llm.negatives import mine, quantised, usable

    rows = table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, "vec_id", label, quantised(F.col("embedding")), F.col("vec_id") % 100 == 0)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_merge_dedup": op1_suffix_merge_dedup,
        "op2_quote_linking": op2_quote_linking,
        "op3_license_rules": op3_license_rules,
        "op4_jaccard_metric_join": op4_jaccard_metric_join,
        "op5_seed_align_decontamination": op5_seed_align_decontamination,
        "op6_candidate_boosting_pii": op6_candidate_boosting_pii,
        "op7_simple8b_tokens": op7_simple8b_tokens,
        "op8_host_rules": op8_host_rules,
        "op9_entropy_secrets": op9_entropy_secrets,
        "op10_fair_queue_mix": op10_fair_queue_mix,
        "op11_postorder_manifest": op11_postorder_manifest,
        "op12_recursive_bpe": op12_recursive_bpe,
        "op13_multi_index_negatives": op13_multi_index_negatives,
    }
