"""From raw documents to token ids, in stages that can be run one by one.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return
the columns of ``docs``. ``run`` writes each stage's result as a table and reads it
again for the next, so a lost executor costs a stage at most.

Defined cases, beside those of the operators: a null, empty or wordless text has no
language evidence of its own, fails the quality rules' base and so goes in the second
stage; very long texts go through whole; of repeated rows (equal id and shingle set) one
stays in the third stage, while one id with several texts keeps one of each group of
copies; a null id is an id; null is a language that is declared by none and a source of
its own; the fourth stage may take a document several times; extra columns stay, whatever
their names (the last stage's ids get a name that is free); an empty table passes as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricewise.llm import jaccard, langid, mixing, pieces, quality
from pricewise.llm.common import materialize, ship, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that is found go."""
    ship(spark)
    return langid.keep_known(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship(spark)
    return jaccard.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.draw(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a column ``ids`` of token ids."""
    ship(spark)
    return pieces.add_ids(docs, pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources", source_mix),
    ("SentencePiece encoding", token_ids),
]

#: SQL cannot express language ID, the join and encoding; tests compare the stages with
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
