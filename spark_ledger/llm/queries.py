"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_ledger.llm import collocations, embedding_dedup, licenses, ngram_join, prefix_trie
from spark_ledger.llm.common import documents, read_table, shared_path, ship_package

TOKENIZER_DIR = None      # where the vocabulary files lie; None asks the installed package


def vocabulary(name: str) -> str:
    if TOKENIZER_DIR:
        return f"{TOKENIZER_DIR}/{name}"
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_e8_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.embedding_dedup import near_vectors
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.licenses import license_scan
    return license_scan(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.quality import quality
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality(documents(spark, sf_dir), trusted)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.secrets_scan import digests, scan
    return digests(scan(documents(spark, sf_dir)))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.sentencepiece_op import digests, encode_decode
    return digests(encode_decode(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model")))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.ngram_join import near_duplicates
    return near_duplicates(documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.substring_dedup import substring_dedup
    return substring_dedup(documents(spark, sf_dir), 50).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.packing import pack_documents
    return pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), 2048, 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.toxicity import fit, score
    docs = documents(spark, sf_dir)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = fit(docs, read_table(spark, sf_dir, "labels").where(~fold).select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", fold.alias("held_out"), "score", "predicted")


def op10_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.dac import read_tokens, write_tokens
    path = shared_path(spark, "dac")
    write_tokens(documents(spark, sf_dir), path, vocabulary("word_bpe_49k.json"), 2)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.prefix_trie import prefix_nodes
    return prefix_nodes(read_table(spark, sf_dir, "conversations")).drop("turn_key")


def op12_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spark_ledger.llm.lexicon import digests, encode_decode, fit
    docs, path = documents(spark, sf_dir), vocabulary("word_bpe_49k.json")
    return digests(encode_decode(docs, path, fit(docs, path)))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))


def _query(run):
    @functools.wraps(run)
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)
    return call


QUERIES = {f.__name__: _query(f) for f in (
    op1_e8_lattice_dedup, op2_license_scan, op3_quality_rules, op4_secret_scan, op5_sentencepiece, op6_ngram_jaccard_join,
    op7_substring_dedup, op8_best_fit_packing, op9_toxicity, op10_dac_tokens, op11_prefix_trie, op12_transducer_bpe, op13_collocations)}
ORACLES: dict[str, str] = {
    "op1_e8_lattice_dedup": embedding_dedup.oracle_sql(),
    "op2_license_scan": licenses.oracle_sql(),
    "op6_ngram_jaccard_join": ngram_join.oracle_sql(),
    "op11_prefix_trie": prefix_trie.oracle_sql(),
    "op13_collocations": collocations.oracle_sql(),
}
