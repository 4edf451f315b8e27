"""The registered queries ``opN_<name>``: each operator over its whole table, and DuckDB SQL where SQL can express it.

Operator modules are imported when a query runs, so that listing the queries costs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm.ann import search

    return search(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm.quality_rules import quality_rules

    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.withColumn("failed_rules", F.array_join("failed_rules", ","))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm import language_id

    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    out = language_id.predict(docs, model)
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ledgerfold.llm.unigram_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm.jaccard_join import near_duplicates

    return near_duplicates(spark, table(spark, sf_dir, "documents")).drop("key1", "key2")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm.licenses import scan_licenses

    out = scan_licenses(table(spark, sf_dir, "documents"))
    joined = [F.array_join(c, ",").alias(c) for c in ("sentence_ids", "licenses", "unmatched")]
    return out.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), *joined)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm.packing import pack

    return pack(spark, table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm.token_files import scratch, token_digests, write_token_files

    return token_digests(spark, write_token_files(table(spark, sf_dir, "documents"), scratch(spark, "token-files")))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm import quality_model
    from ledgerfold.llm.language_id import held_out

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    apart = held_out(F.col("doc_id"), 4, 2)
    model = quality_model.fit(docs, labels.filter(~apart))
    out = quality_model.score(docs, model)
    return out.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ledgerfold.llm.byte_bpe import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm.spelling_variants import spelling_variants

    return spelling_variants(spark, table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm.conversation_repair import repair_digests

    return repair_digests(spark, table(spark, sf_dir, "conversations"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerfold.llm import personal_data

    docs = table(spark, sf_dir, "documents")
    return personal_data.find(docs, personal_data.fit(docs))


QUERIES = {"op1_ann": op1_ann, "op2_quality_rules": op2_quality_rules, "op3_language_id": op3_language_id, "op4_token_counts": op4_token_counts, "op5_jaccard_join": op5_jaccard_join, "op6_license_scan": op6_license_scan, "op7_best_fit_packing": op7_best_fit_packing, "op8_token_files": op8_token_files, "op9_quality_model": op9_quality_model, "op10_byte_bpe": op10_byte_bpe, "op11_spelling_variants": op11_spelling_variants, "op12_conversation_repair": op12_conversation_repair, "op13_personal_data": op13_personal_data}


def oracle_sql() -> dict[str, str]:
    from ledgerfold.llm import licenses, quality_rules

    return {"op2_quality_rules": quality_rules.oracle_sql(), "op6_license_scan": licenses.oracle_sql()}
