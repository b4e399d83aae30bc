"""The corpus pipeline: from the documents table to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the
columns of documents, and columns of any other name pass through. An empty table gives an empty result, and invalid
bytes of a text are read as U+FFFD.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import exact_dedup, language_id, mixing, near_dedup, packing
from corpusloom.llm._common import cut, table
from corpusloom.llm.queries import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters (null, empty and blank texts too), and those far from every language learned; all
    others stay, repeated rows each. Where no row has a language label, nothing is learned and none stays."""
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of texts that are equal but for white space: the longest, then the smallest id;
    null equals empty. Rows repeated with one id are a group as any other."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: five-word shingles, similarity 0.8 or more. Rows without a
    doc_id or without words stay; rows of one id stay or go together."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents in part, whole or repeatedly, as the sources' weights ask. A null source is a source; documents
    without words go, and of rows equal in id, source and text one stands for all."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens; a null text is one end token, a long one many pieces."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Neither the language models, nor the tokenizer, nor packing can be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
