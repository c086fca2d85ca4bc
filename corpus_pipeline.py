"""From documents to packed training sequences, in stages that hand over through Parquet.

Toxic documents go, then exact copies, then all but one of each group of near
copies, then documents that hold passages of the benchmark; the rest is packed.
All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import decontamination, exact_dedup, near_dedup, packing, toxicity
from tillwatch.llm.queries import vocabulary
from tillwatch.llm.text import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on their labels, does not reject."""
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_chain(docs, chain, prefix="_chain_", verdict="_chain_rejects")
    return scored.filter("not _chain_rejects").select(*_names(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest doc_id."""
    return exact_dedup.content_sort(docs, prefix="_sort_").filter("_sort_kept").select(*_names(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    marked = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), prefix="_bench_")
    return marked.filter(F.size("_bench_spans") == 0).select(*_names(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 token ids."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: No stage list with trained models, links and token ids can be put in SQL.
ORACLE_SQL = None


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; what each one keeps is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
