"""Registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import bpe, chat, classifier, html_text, leaks, licenses, line_dedup, pii, prefix_trie, quality, simhash, token_links, url_data, url_lists

# The key of the registered query only; a real run passes a secret of its own.
SURROGATE_KEY = b"registered query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary; it is installed beside Python, not in this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(_table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(_table(spark, sf_dir, "documents"))


def op3_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(_table(spark, sf_dir, "documents"), vocabulary_file())


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_lists.evaluated(url_data.captures(pages), url_data.entries(pages))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licensed(_table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return quality.judged(documents, quality.weights(documents, quality.trusted_ids(_table(spark, sf_dir, "labels"))))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(_table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")
    return token_links.document_measures(_table(spark, sf_dir, "documents"), a, b)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(_table(spark, sf_dir, "conversations"))


# A conversation whose texts hold control strings, beside those of the table.
GUARDED = (-7, "\\### Assistant: </turn> ok")


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, text = GUARDED
    more = spark.createDataFrame([(conv, 0, "user", text), (conv, 1, "assistant", text)], told.schema)
    return chat.read_back(chat.formatted(told.union(more)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_line_dedup,
            op2_simhash_near_dedup,
            op3_bpe_encoding,
            op4_quality_classifier,
            op5_url_filters,
            op6_license_scans,
            op7_benchmark_decontamination,
            op8_quality_rules,
            op9_pii_surrogates,
            op10_html_extraction,
            op11_tokenizer_alignment,
            op12_prefix_trie,
            op13_chat_formatting,
        )
    }


def oracle_sql() -> dict[str, str]:
    conv, text = GUARDED
    more = f"SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES ({conv}, 0, 'user', '{text}'), ({conv}, 1, 'assistant', '{text}')"
    return {
        "op5_url_filters": url_data.ORACLE,
        "op6_license_scans": licenses.oracle(),
        "op7_benchmark_decontamination": leaks.oracle(),
        "op12_prefix_trie": prefix_trie.oracle(),
        "op13_chat_formatting": chat.oracle(f"({more})"),
    }
