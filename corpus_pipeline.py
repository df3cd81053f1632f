"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` names each stage and its function (spark, docs, sf_dir). Every
stage works on all rows its predecessor kept; all but the last return the
columns of ``documents``. ``run`` writes each stage as Parquet in the shared
checkpoint folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import jaccard, langid, lines, mixing, packing
from tallyline.llm.common import documents, stage


#: a language must be this much likelier than all others together
MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an identified language; those without a letter go."""
    got = langid.identify_documents(docs, F.lit(True), docs.columns, out=("__lang", "__score"))
    return got.where((F.col("__lang") != langid.UND) & (F.col("__score") >= MIN_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of templates that recur in texts with lines of
    their own; ``n_chars`` follows."""
    got = lines.drop_boilerplate(docs)
    if "n_chars" in docs.columns:
        n = F.when(F.col("__n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        got = got.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return got.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles,
    similarity 0.8 or more)."""
    return jaccard.one_per_group(docs, shingle=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.mixed_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", best_fit_packing),
]

#: tokenizers and the trained language model are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
