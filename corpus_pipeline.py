"""Documents through quality rules, near-duplicate removal, secret redaction, mixing and packing.

Each stage reads a written table: the result of the one before, as Parquet. So
when a stage begins, the interim tables of the stage before are read by nobody
any more, and are removed; what lies on disk is that of one stage.

Defined cases: a null text has no word, so the quality rules reject it; of repeated
rows and equal ids with near texts one row stays; a null id or source is a value like any
other; an empty table gives an empty result; extra columns travel along to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellpulse.llm import mixing, ngram_join, packing, quality_rules, secret_scan
from cellpulse.llm.common import stored, table
from cellpulse.session import discard, prepare, recorded, remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Interim tables of the last stage that ran, by application.
_left: dict[str, list[str]] = {}


def stage(work: Stage) -> Stage:
    """A stage that first removes what the stage before has left."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = prepare(spark).sparkContext.applicationId
        remove(spark, _left.pop(app, []))
        with recorded() as made:
            result = work(spark, docs, sf_dir)
        _left[app] = made
        return result

    return run_stage


@stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs)


@stage
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return ngram_join.one_of_each(docs)


@stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays."""
    return secret_scan.redact(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each repetition that the mix takes of a document."""
    return mixing.repeat(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all token sequences, with their ids."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality rules", keep_quality),
    ("near duplicates", keep_one_of_each),
    ("secret scan", redact_secrets),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]

#: MinHash, a trained model and a tokenizer decide the rows, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each one's result is a table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        before, docs = docs, stored(work(spark, docs, sf_dir), name.replace(" ", "_"))
        discard(before)
    return docs
