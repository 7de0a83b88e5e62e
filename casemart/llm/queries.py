"""The registered queries of the operators, over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from casemart.llm.alignment import alignment_report
from casemart.llm.byte_bpe import encoding_report
from casemart.llm.embedding_dedup import vector_duplicates
from casemart.llm.lexical import LEXICAL_SQL, rank_documents
from casemart.llm.minhash_dedup import near_duplicates
from casemart.llm.mixing import MIX_SQL, mix_sources
from casemart.llm.packing import pack_documents
from casemart.llm.privacy import private_report
from casemart.llm.quality import score_quality, train_quality
from casemart.llm.substring_dedup import remove_repeats
from casemart.llm.top_k import TOP_K_SQL, top_k
from casemart.llm.toxicity import score_toxicity, train_toxicity
from casemart.llm.warc_revisits import REVISIT_SQL, page_captures, revisit_report


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated 35-word windows over all documents."""
    return remove_repeats(_table(spark, sf_dir, "documents"), window=35)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairwise-ranked quality of all documents."""
    docs = _table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, _table(spark, sf_dir, "labels")))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisit captures derived from all pages, resolved to full responses."""
    return revisit_report(page_captures(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy-or toxicity of all documents, with the sentences to blame."""
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, _table(spark, sf_dir, "labels")))


def op5_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms in all documents."""
    return private_report(_table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors at a cosine of 0.95."""
    return vector_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1,024 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    return top_k(_table(spark, sf_dir, "embeddings"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at a similarity of 0.85."""
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 3, 1, 2 of 150 % of their words."""
    return mix_sources(_table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for every item of the benchmark."""
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers over all documents, aligned, with corpus counts of linked ids."""
    return alignment_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as byte-level BPE ids, and back."""
    return encoding_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: Name -> (function of (spark, folder), SQL or None).
QUERIES = {
    "op1_substring_dedup": (op1_substring_dedup, None),
    "op2_quality_classifier": (op2_quality_classifier, None),
    "op3_warc_revisits": (op3_warc_revisits, REVISIT_SQL),
    "op4_toxicity": (op4_toxicity, None),
    "op5_privacy": (op5_privacy, None),
    "op6_embedding_dedup": (op6_embedding_dedup, None),
    "op7_packing": (op7_packing, None),
    "op8_exact_top_k": (op8_exact_top_k, TOP_K_SQL),
    "op9_minhash_dedup": (op9_minhash_dedup, None),
    "op10_mixing": (op10_mixing, MIX_SQL),
    "op11_lexical": (op11_lexical, LEXICAL_SQL),
    "op12_alignment": (op12_alignment, None),
    "op13_byte_bpe": (op13_byte_bpe, None),
}
