"""A corpus pipeline: five stages over `documents`, each on all that the one before kept.

run() writes every stage as Parquet to the shared folder and reads it again for the next. All stages but the last
return the columns of `documents`; the last returns the encoded documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semstore.llm.common import staged, table
from semstore.llm.decontaminate import without_contaminated
from semstore.llm.pieces import encode
from semstore.llm.pii import redact
from semstore.llm.quality import keep_good
from semstore.llm.setsketch import near_duplicates

#: SQL cannot express the forests, the span classifier and the tokenizer: tests compare with a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and no forest rejects; n_chars stays as it was."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, one without an id only if none has one.

    Rows get a number first, so repeated and missing ids neither lose a text nor keep a copy.
    """
    rows = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(rows.select("_row", "text"), id_col="_row").select(F.col("doc_id").alias("_of"), "component_id")
    named = groups.join(rows.select("_row", "doc_id"), F.col("_of") == F.col("_row"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    kept = named.groupBy("component_id").agg(first.alias("first")).select(F.col("first._row").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than 5 % lie in benchmark windows."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars counts the new text."""
    return redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded text, and how many segments differ from the library's."""
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"), digest=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates_out),
    ("decontamination", decontaminated),
    ("personal data", personal_data_out),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
