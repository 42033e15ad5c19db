"""A training corpus from raw documents: five stages, each a stored table.

``STAGES`` lists (name, function); a function takes (spark, docs, folder) and returns a DataFrame. All but the last
return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontamination, language, near_dedup, packing, pii
from tidewell.queries.common import Query, table
from tidewell.session import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A document stays if its language has this share of its letters.
MIN_SHARE = 0.4


def identified(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of one language, by the model of their own labels; ``lang`` becomes the language found.

    Rejected are texts without letters and those in which no language has ``MIN_SHARE`` of the letters.
    """
    found = language.identify(docs.select(*COLUMNS), language.fit(docs), keep=("lang", "source", "n_chars"))
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SHARE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def deduplicated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id."""
    return near_dedup.first_of_each(docs).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontamination.clean_documents(docs, table(spark, folder, "benchmark")).select(*COLUMNS)


def sanitised(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, their personal data replaced by tags; ``n_chars`` follows the text."""
    found = pii.find_personal_data(docs, keep=("lang", "source"))
    return found.select("doc_id", F.col("clean").alias("text"), "lang", "source", F.length("clean").cast("bigint").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token pieces and their place in sequences; a piece is ids ``start`` to ``start + length`` of its document."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identified),
    ("near_dedup", deduplicated),
    ("decontamination", decontaminated),
    ("pii", sanitised),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Models, samples and tokens are not SQL; the stages are tested against brute-force versions instead.
ORACLE_SQL = None

QUERIES = {"pipeline": Query(run, ORACLE_SQL)}
