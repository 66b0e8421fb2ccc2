"""Corpus pipeline over ``documents``: language ID, SimHash near-duplicates, surrogates, packing.

A stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.  All but the last return the
columns of ``documents``; the last returns the packing of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.llm.common import cut, free, importable
from constella.llm.langid import UNKNOWN, fit, predict
from constella.llm.queries import SURROGATE_KEY, packed
from constella.llm.simhash import components, fingerprinted
from constella.llm.surrogates import replace


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the languages that ``lang`` names; reject null texts, texts without letters, and texts
    that share no n-gram with any profile.  Profiles are learned from all documents with a lang."""
    importable(spark)
    found = predict(docs, fit(docs))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of rows linked by fingerprints two bits apart or fewer: that with the smallest id,
    and of those the smallest by text and the other columns (maps have no order and don't count).  Ids neither link rows nor tell them apart, so rows that
    share an id but not a text are judged by their texts, and rows without an id take part (an id goes before none)."""
    importable(spark)
    fp = free(docs, "_fp")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    others = [f.name for f in docs.schema.fields if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()]
    first = lambda at: F.struct(F.col(f"{at}doc_id").isNull().alias("unnamed"), *[
        F.col(f"{at}`{c}`").alias(f"c{i}") for i, c in enumerate(["doc_id", "text", *others])])
    # partial aggregates: a large group of copies is a row a task before each shuffle
    classes = cut(fingerprinted(docs, shingle=3, seed=42, name=fp).groupBy(F.col(fp).alias("fp")).agg(
        F.min_by(row, first("")).alias("row")), name="classes")
    kept = components(classes, radius=2).groupBy("root").agg(F.min_by("row", first("row.")).alias("row"))
    return kept.select("row.*").select(*docs.columns)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and secrets; every document stays.  ``n_chars`` follows the text."""
    found = replace(docs, key=SURROGATE_KEY)
    return found.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast("bigint")).otherwise(
        F.col("n_chars"))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in their bins."""
    importable(spark)
    return packed(docs)


STAGES = [("language", language), ("near_copies", near_copies), ("surrogates", surrogates), ("packing", packing)]

#: None: SQL has neither rank-order profiles, XXH64 nor best-fit packing; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name=name)
    return STAGES[-1][1](spark, docs, sf_dir)
