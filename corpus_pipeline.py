"""Training-corpus pipeline: five stages, each one operator of ``tidemark.llm``.

Every stage gets all that its predecessor kept, as a table reread from the
shared folder, and its decisions take effect.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import unused
from tidemark.llm import lines, mixing, packing, quality, simhash
from tidemark.llm import queries as Q
from tidemark.llm.common import table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts (score 0.5 or more)."""
    model = quality.train(docs, quality.train_fold(table(spark, sf_dir, "labels")))
    score = unused(docs.columns, "score")[0]
    return quality.scored(docs, model, name=score).filter(F.col(score) >= 0.5).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its later copies of three-line windows; ``n_chars`` follows the text."""
    kept = lines.dedup_lines(docs)
    return kept.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each SimHash component."""
    return simhash.one_of_each(docs, Q.SIMHASH_SHINGLE, Q.SIMHASH_DISTANCE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in random order."""
    return mixing.mix(docs, Q.MIX_WEIGHTS, Q.MIX_SEED).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences, with their token ids."""
    return packing.pack(docs, Q.tokenizer_path(), Q.SEQUENCE, Q.END_ID, digest=True)


STAGES = [
    ("quality classifier", classify),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources", mix),
    ("packing", pack),
]

#: SQL expresses neither the model nor the fingerprints' components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
