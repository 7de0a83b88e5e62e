"""From documents to packed training sequences, in five stages that each read what the last one wrote.

Every stage takes (spark, docs, folder with the tables) and returns a DataFrame; all but the last keep the columns of `documents` and
any further ones, whatever they are called. Without rows, every stage gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.llm.minhash_dedup import keep_one_of_each
from casemart.llm.mixing import take_mix
from casemart.llm.packing import pack_documents
from casemart.llm.privacy import sanitise
from casemart.llm.quality import keep_good, train_quality
from casemart.llm.storage import Scratch


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose pairwise-ranked quality reaches 0.3; the model learns from the labels of the documents at hand.

    Null and empty texts are scored as texts without words. Repeated rows have one score; ids whose labels contradict each other teach nothing. Without both
    labels, every score is 0.5 and all rows stay.
    """
    return keep_good(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), threshold=0.3)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a shingle similarity of 0.8 or more: the one with the smallest id, rows without an id last.

    Repeated rows are one group. Texts that are null or hold no word are linked with nothing and all stay.
    """
    return keep_one_of_each(docs, percent=80)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, disclosing terms generalised or removed; every row stays, and `n_chars` is counted anew.

    A null text stays null with 0 characters, an empty one stays empty.
    """
    return sanitise(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of weights 3, 1, 2 takes them: none, one or two times each.

    Texts without words weigh nothing. Null is a source of its own. Null and repeated ids are told apart by their text, equal rows by number.
    """
    return take_mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of 1,024 tokens.

    Null and empty texts are one end token. Repeated rows are packed as often as they occur. Special tokens' strings count as special tokens.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", good_quality),
    ("minhash near-dedup", one_of_near_duplicates),
    ("pii", without_private_data),
    ("mixing sources", mixed_sources),
    ("best-fit packing", packed_sequences),
]

#: SQL can express neither the trained model nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            scratch.drop(f"stage-{number - 1}")
    return docs
