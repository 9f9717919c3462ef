"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps with the columns of
``documents``; the last one returns where each document's token ids are. ``run`` writes
each stage's result in the shared folder and reads it for the next.

A null text counts as empty and ends at the first stage, as it has no letter. Null ids,
languages and sources are values like others; columns beyond those of ``documents``, whatever
their names, are carried along to the last stage. An empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from landspark.llm import decontamination, language_id, mixing, simhash, token_output
from landspark.llm.common import materialize, new_path, table
from landspark.llm.ngrams import held_out


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are far from every learned language or have no letter.

    Without a document to learn from there is no language, and every document goes.
    Repeated rows are decided alike.
    """
    model = language_id.LanguageModel.fit(docs.filter(~held_out()))
    return model.predict(docs).filter("NOT lang_rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similarity 0.8 or more on 5-word shingles.

    That of the least id stays, null ids last; of repeated rows one stays, the least by
    its other columns. Documents without words form one group.
    """
    return simhash.without_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage that is alike to a benchmark item.

    Items without words match nothing; repeated rows are decided alike.
    """
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share of a mix; a document may come twice, in part, or not at all.

    A null source is a source. Documents without words are never taken; repeated rows are
    taken as the rows they are.
    """
    return mixing.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token ids as Arrow files and reads back where each document's ids are.

    Null ids come first; rows of one id follow each other by text.
    """
    path = new_path(spark, "tokens")
    return token_output.read_tokens(token_output.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json")), path)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_token_ids),
]

#: The stages are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
