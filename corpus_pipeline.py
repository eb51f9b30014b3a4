"""From raw documents to packed sequences: language ID, near-copies, decontamination, secrets, packing.

Each stage works on all that its predecessor kept and is written before the next one reads it.  All but the last return
the columns of documents:
1. language: documents without a language (null, or without a letter) go;
2. near_copies: of documents linked by 5-word shingles at a similarity of 0.8 or more the least doc_id stays;
3. decontaminate: documents that hold benchmark passages beyond the contract's share go;
4. secrets: documents stay, with each secret replaced by its kind, and n_chars counts the new text;
5. pack: pieces of 2048-token sequences.

Defined results: null and empty texts and those without a letter go in the first stage, so later ones meet them only if
called by themselves, and then keep them; texts of any length are judged whole; rows count by doc_id and text: equal rows
become one in the second stage (ties: the least doc_id, a null one last, then the least hash of the text), elsewhere each
row is judged by itself; columns may have any names; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import decontam, jaccard, language, packing, secrets
from tallyforge.llm.common import bounded, settled, table
from tallyforge.session import reach


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs)


def _near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.distinct(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(bounded(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("language", _language), ("near_copies", _near_copies), ("decontaminate", _decontaminate), ("secrets", _secrets), ("pack", _pack)]

#: SQL can't express cross-parsing, the tokenizer or the packing; tests/llm holds run() against brute force, stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(reach(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settled(docs)
    return docs
