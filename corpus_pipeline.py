"""The corpus pipeline: rules, classifier, near-duplicate join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept. Other columns of docs, of any
name, go through unchanged, but for n_chars, which mixing counts anew; an empty table gives none. Repeated rows are judged
each by the first two stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake.llm.labelled import keep_rows
from strandlake.llm.mil import fit_classifier
from strandlake.llm.mixing import mix_sources, mixed_documents
from strandlake.llm.ngram_join import one_of_each
from strandlake.llm.packing import pack_documents
from strandlake.llm.quality_rules import KEEP, fit_rules, passes
from strandlake.llm.queries import _vocabulary
from strandlake.llm.store import materialise

#: A document stays if the classifier's score is at least this.
SCORE = 0.3


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the boosted trees reject go; those with a null or empty text are among them. The trees
    are fitted on docs' own labelled texts; without labels of both kinds they reject nothing."""
    forest = fit_rules(docs, _labels(spark, sf_dir))
    return keep_rows(docs, lambda texts: passes(texts, forest, KEEP))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier scores below SCORE go. It is fitted on the documents table as op1 does: the
    rules have already removed nearly all labelled low-quality texts from docs. A null or empty text is scored like any
    other; without labels of both kinds all score 0.5 and stay."""
    model = fit_classifier(spark.read.parquet(f"{sf_dir}/documents.parquet"), _labels(spark, sf_dir))
    return keep_rows(docs, lambda texts: model.score(texts) >= SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join stays, that with the smallest doc_id; of rows that share it, the one with
    the smallest text. Null and empty texts are components of their own; rows without a doc_id stay."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents hold the words that the mix takes of them, with a row for each round. Null and empty texts give no row, identical
    rows one row a round; a null source is a source."""
    return mixed_documents(docs, mix_sources(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their ids; a null or empty text is the end id alone."""
    return pack_documents(docs, _vocabulary("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("quality classifier", quality_classifier), ("n-gram Jaccard join", near_duplicates), ("mixing", mix), ("packing", pack)]

#: Fitted models and hashed draws are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
