"""The registered queries of the dealt operators, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmart.llm.common import scratch_path, table
from panelmart.llm.oracles import jaccard_sql, merkle_sql, quality_sql, substring_sql


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of every document."""
    from panelmart.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 50-word passages removed from every document."""
    from panelmart.llm.substring import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from panelmart.llm.html import extract_text

    return extract_text(table(spark, sf_dir, "pages"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every document, written and read back."""
    from panelmart.llm.tokenbin import TOKENIZER, read_digests, write_tokens

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file(TOKENIZER))
    return read_digests(spark, path)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    from panelmart.llm.decontam import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over every document."""
    from panelmart.llm.quality import judge

    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its PII replaced by surrogates."""
    from panelmart.llm.pii import replace_pii

    return replace_pii(table(spark, sf_dir, "documents"), count_col="n_entities").select("doc_id", "text", "n_entities")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL rules and boosted trees over every page."""
    from panelmart.llm.urls import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and fuzzy notices of every document."""
    from panelmart.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document and the text they decode to."""
    from panelmart.llm.spm import MODEL, encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_file(MODEL))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document aligned over two tokenizers."""
    from panelmart.llm.align import A_FILE, B_FILE, align

    return align(table(spark, sf_dir, "documents"), tokenizer_file(A_FILE), tokenizer_file(B_FILE))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of every document, and the roots that rows give of which some were tampered with."""
    from panelmart.llm import merkle

    # every seventh id by its checksum: one added to n_chars (a null stays)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    more = F.when(tampered, F.col("n_chars").cast("decimal(38,0)") + 1).otherwise(F.col("n_chars").cast("decimal(38,0)"))
    values = [more if c == "n_chars" else F.col(c) for c in merkle.FIELDS]
    rows = merkle.manifest(table(spark, sf_dir, "documents"), carry={"given": F.when(tampered, merkle.leaf_hash(values))})
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                       merkle.folded(F.coalesce("given", "leaf"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with alike shingle sets."""
    from panelmart.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_substring": op2_substring,
    "op3_html_text": op3_html_text,
    "op4_token_ids": op4_token_ids,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_pii": op7_pii,
    "op8_url_filters": op8_url_filters,
    "op9_licenses": op9_licenses,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_alignment": op11_alignment,
    "op12_merkle": op12_merkle,
    "op13_ngram_jaccard": op13_ngram_jaccard,
}
# The others are beyond SQL (seeded hashes, trained models, vocabularies, edit search) and
# are tested against brute-force versions in tests/llm.
ORACLES: dict[str, str] = {"op2_substring": substring_sql(), "op6_quality": quality_sql(), "op12_merkle": merkle_sql(),
                           "op13_ngram_jaccard": jaccard_sql()}
