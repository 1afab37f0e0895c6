"""From documents to token ids: toxic ones out, one of each near-duplicate group, sources mixed, texts encoded.

``STAGES`` lists the steps in order; each takes ``(spark, docs, sf_dir)`` and works on all rows that the step
before it has kept. All but the last return the columns of ``docs``. Their results are written as Parquet in
the cluster's shared folder and read again as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, mixing, near_dedup, toxicity
from barloom.llm.queries import BPE_FILE, mix_targets
from barloom.llm.tables import plain_names, stored, table

#: Documents are rejected from this score on.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the labelled ones among them, does not call toxic."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    inner, at, back = plain_names(docs)
    return back(toxicity.score(inner, model, at["text"]).where(F.col("score") < TOXIC))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id."""
    return near_dedup.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate takes it."""
    sizes = stored(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "mix-sizes")
    return mixing.mix(docs, mix_targets(sizes))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) and their number for every document; the text is left out."""
    return bpe.encode(docs.select("doc_id", "source", "lang", "text"), BPE_FILE).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: SQL cannot express scores, groups of near duplicates or token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
