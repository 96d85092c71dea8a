"""The corpus pipeline: language identification, near duplicates, benchmark
decontamination, personal data, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result to the shared folder and reads it back as the next
stage's documents.  All but the last stage return the columns of
``documents`` and decide on every document the stage before kept.  Nulls,
empty texts, repeated rows, empty tables and extra columns follow the
operators' docstrings: a null or letterless text goes at the first stage,
repeated rows are one document at the second.  Rows without a doc_id go
through the second and third stage by a key made of their text, so equal
texts are one document; they come after the rows that have an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentflow.llm import byte_bpe, decontaminate, language_id, near_dup, pii
from segmentflow.llm.common import held_out, read_table, staged


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language is rejected (operator 8)."""
    model = language_id.train(docs, ~held_out())
    found = language_id.identify(docs, model)
    return found.where(~F.col("lang_rejected")).select(*docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__key``: the id, or for rows without one a hash of
    the text, above 2**62."""
    made = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
    return docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), made))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group of near
    duplicates (operator 5); repeated rows of an id go too."""
    columns, docs = docs.columns, keyed(docs)
    found = near_dup.near_duplicates(docs, id_col="__key")
    dropped = staged(found.where(~F.col("kept")).select(F.col("__key").alias("__id")).distinct(), "dropped")
    again = docs.groupBy(F.col("__key").alias("__id")).count().where("count > 1").select("__id")
    again = staged(again.join(dropped, "__id", "left_anti"), "again")
    if again.isEmpty():
        return near_dup.without(docs, "__key", dropped).select(*columns)
    rest = near_dup.without(docs, "__key", dropped.union(again))
    once = near_dup.picked(docs, "__key", again).join(again, F.col("__key") == F.col("__id"))
    return rest.select(*columns).union(once.dropDuplicates(["__key", "text"]).select(*columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item (operator 10)."""
    columns, docs = docs.columns, keyed(docs)
    found = decontaminate.contaminated(docs, read_table(spark, sf_dir, "benchmark"), id_col="__key")
    held = staged(found.select(F.col("__key").alias("__id")).distinct(), "held")
    return near_dup.without(docs, "__key", held).select(*columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by ``[KIND]`` (operator 1); ``n_chars``
    follows the text."""
    clean = pii.redact(docs, pii.train(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text (operator 3): ids, and digests of ids and of the
    bytes they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.token_digests(docs, path, public_tokenizers.PATTERN, keep=["doc_id"])


STAGES = [
    ("language_id", language_stage),
    ("near_dup", near_dup_stage),
    ("decontaminate", decontamination_stage),
    ("pii", pii_stage),
    ("byte_bpe", token_stage),
]

# The language model, MinHash and the field can't be written as SQL; the
# stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
