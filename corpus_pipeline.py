"""From raw documents to packed training sequences, in five stages.

Every stage takes all that its predecessor kept; what it writes as Parquet is the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundscope.llm import dedup, packing, quality, simhash, toxicity
from roundscope.llm.common import fold, read
from roundscope.llm.queries import word_bpe_json
from roundscope.session import stored


#: Bytes of a passage that must not repeat: about 50 short words. Passages of over 50 words are longer.
PASSAGE_BYTES = 200


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose windows resemble toxic text go. The model learns from labelled documents of this input.

    Null and empty texts stay, repeated rows are judged alike, and without labels or rows none goes.
    """
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"), "toxic", fold(F.col("doc_id"), 4) != 2)
    return toxicity.drop_toxic(docs, model)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them; repeated rows go or stay together."""
    return quality.keep_good(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-equal SimHash fingerprints join, the one of the least id stays."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of ``PASSAGE_BYTES`` bytes that also start elsewhere in the corpus go; n_chars follows the text."""
    cut = dedup.with_repeats_cut(docs, width=PASSAGE_BYTES)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in cut.columns else cut


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of documents in sequences."""
    return packing.pack(docs, word_bpe_json())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_good),
    ("simhash_dedup", keep_one_of_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: Classifiers, fingerprints, suffix arrays and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the packed pieces."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
