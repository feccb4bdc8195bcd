"""The training-corpus pipeline: four stages over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
works on every row its predecessor kept and returns a DataFrame.  All but the
last return the columns of ``documents``; between stages the rows are written
as Parquet in the shared folder and read again.  A stage's working tables and
its input are deleted once its output is written; the last stage's input stays,
for the returned frame reads it.

Defined results: a null or empty text is kept like any other (the texts without
words are one near-duplicate group) and packs as its end id; a null doc_id is
kept unless it is toxic or a near-duplicate of a document with an id; of equal
rows one stays; very long texts are worked on whole; ties go to the smallest
doc_id; empty tables give no rows; other columns of any name are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import packing, simhash, substring, tokens, toxicity
from ledgerflow.llm.common import drop_stage, scratch, stage, table
from ledgerflow.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (operator 10): documents that the model rejects go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (operator 6): one document of each group stays."""
    return simhash.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup (operator 3): repeated runs of sentences go."""
    return substring.remove_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (operator 2): sequences of at most 4096 tokens."""
    return packing.pack(docs, tokenizer_path(), memory=tokens.SMALL)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: A trained model, XXH64 fingerprints and BPE ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        with scratch(spark) as kept:
            following = stage(function(spark, docs, sf_dir), name)
            kept.append(following)
        drop_stage(docs)
        docs = following
    return STAGES[-1][1](spark, docs, sf_dir)
