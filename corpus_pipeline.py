"""From raw documents to packed training sequences, one operator a stage.

Each stage gets the rows its predecessor kept, as written to Parquet and read again. All but
the last return the columns of ``documents``. The result is one row per piece of a
document in the mix: where its tokens lie in the document and in their sequence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard, mixing, packing, pii, rules
from ledgerloom.llm.queries import added_tokens, byte_bpe
from ledgerloom.llm.store import stored

#: Near duplicates: four fifths of five-word shingles.
SIMILARITY = jaccard.Threshold(80)
SHINGLE_WORDS = 5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates; a missing id is the largest."""
    return jaccard.one_of_each(docs, SIMILARITY, SHINGLE_WORDS, null_ids=True)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows the new text."""
    length = F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return pii.redact(docs).withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences; the tokens' checksum stands for the tokens."""
    pieces = packing.tokenize(docs, byte_bpe("tiktoken"), added=added_tokens())
    digested = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(stored(digested, "digested"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Learned spans, hashed thresholds and tokens are beyond SQL; small fixtures test the pipeline.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
