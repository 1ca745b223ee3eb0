"""The corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function) in order.  Each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame; the caller writes it as Parquet and gives it to the next stage as its
``docs``.  All stages but the last return documents, whole rows with all their columns.
``run`` does exactly that with the table ``documents``.

Nulls, empty texts, repeated rows, further columns and empty tables: see each operator's
docstring.  In short: a null or blank text, or one without a letter, is rejected by the first
stage; rows with null ids are kept like any other; of identical rows the third stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import decontaminate, language_id, packing, simhash, toxicity
from panelcast.llm.common import delete_path, scratch_path, table, tokenizer_path

TOXIC_FROM = 0.5
SHINGLE, MAX_BITS = 3, 2
LEAK_SIMILARITY = 0.8
WINDOW, END_ID = 4096, 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages from the labelled documents; documents too far from all of them go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn toxicity from the labels of these documents; documents scored toxic go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), most=TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays, that with the smallest id."""
    return simhash.keep_one(docs, shingle=SHINGLE, most=MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, at most a fifth of its words edited, go."""
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"), similarity=LEAK_SIMILARITY)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into windows: one row for each piece, with the checksum of its ids."""
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=END_ID, window=WINDOW)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: Learned models, fingerprints and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written to the shared scratch folder and read again."""
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if held:
            delete_path(spark, held)
        held = path
    return STAGES[-1][1](spark, docs, sf_dir)
