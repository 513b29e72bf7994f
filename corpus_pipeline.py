"""A training-data pipeline: each stage gets the documents that the last one kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
run() writes each stage's rows to the shared folder and reads them again as the next one's.

All stages take whole texts, however long, and any other columns, whatever their names. A null
text is an empty one, and an empty table gives an empty one. Rows are known by doc_id (null is one
too) and text: where several share a doc_id, each is judged by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheaf.llm import decontaminate, exact_dedup, near_dedup, pieces, quality
from sheaf.llm.shared import stored, without_rows


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose perplexity is above their language's limit. At the limit, without
    words, or in a language without trusted text, a document stays; a null language is one of its
    own. Repeated rows are judged alike."""
    found = quality.quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without_rows(docs, found.where("NOT kept"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (blanks aside): the longest, of ties the one with the
    smallest doc_id, of rows that tie in both one. Empty texts are equal."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, five words, a similarity of 0.8 or more: the one
    with the smallest doc_id, of rows that share it one. Texts without words are alike to none."""
    found = near_dedup.near_components(docs, width=5, least=80)
    return without_rows(docs, found.where("NOT kept"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item, as it is or reworded. Null items are in
    nothing; an empty benchmark leaves all."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document that is left, its columns but the text, n_tokens, and the ids and the
    decoded text as digests."""
    import public_tokenizers

    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), text=False)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("SentencePiece", tokens),
]

#: The stages are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
