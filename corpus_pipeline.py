"""The corpus pipeline: toxic documents, recurring lines, near duplicates and benchmark items go, and
what is left is packed into sequences. Each stage is written as Parquet and read by the next.

Defined results: a null text is scored as an empty one, has no lines, is no near duplicate and clean,
and gives packing one piece, its end id. Rows without doc_id are judged by their text; near dedup
keeps them all. Of rows that share a doc_id near dedup leaves one, of equal texts the one of the
smallest doc_id. Texts are read whole, however long. An empty table gives no rows. All stages but
the last return the columns they were given, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baleflow.llm import decontaminate, line_templates, near_dup, packing, toxicity
from baleflow.llm.common import documents, ready
from baleflow.session import written

#: Words in a shingle and percent of similarity, of near duplicates.
NEAR = near_dup.Similarity(5, 80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    labels = ready(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.ordinary(docs, toxicity.train(docs, labels))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of templates that recur across documents."""
    ready(spark)
    cleaned = line_templates.cleaned(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", length)
    return cleaned


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    ready(spark)
    return near_dup.one_of_each(docs, NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is alike to a benchmark item."""
    benchmark = ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Compression lengths, components and packing are beyond SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
