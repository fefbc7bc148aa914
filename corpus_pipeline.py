"""From raw documents to packed sequences: five stages, each a table of its own.

Each stage reads what its predecessor kept. Quality rules drop what they reject; line
dedup removes boilerplate lines, and documents of which no word is left; of each group
of near duplicates the document of the smallest id stays; documents that hold benchmark
windows go; the rest is packed.

Null texts fail the quality rules. Repeated rows are one near-duplicate group, of which
one row stays. An empty table passes through as an empty table. Columns other than
text and n_chars are handed on as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import contamination, jaccard, lines, packing, quality
from lotwise.llm.inputs import table
from lotwise.session import durable


def row_key() -> Column:
    """Tells rows apart where ids repeat; equal rows share it."""
    return F.xxhash64("doc_id", "text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.cleaned(docs)
    out = out.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row of the smallest id stays, of rows of one id the one of the
    lowest hash; rows without an id stay, one for each text, as nothing tells which group
    they are of. Rows are known by their own key, as texts of one id may differ."""
    keyed = docs.withColumn("__row", row_key())
    classes = jaccard.near_duplicates(keyed.select(F.col("__row").alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias("__row"), "component_id").distinct()
    rows = keyed.select("doc_id", "__row").distinct()
    named = rows.where("doc_id is not null").join(durable(classes, "classes").hint("merge"), "__row")
    first = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "__row")).alias("first"))
    nameless = rows.where("doc_id is null").select("__row")
    first = durable(first.select("first.__row").unionByName(nameless), "first")
    out = keyed.join(first.hint("merge"), "__row", "left_semi")
    return out.dropDuplicates(["__row"]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.withColumn("__row", row_key())
    index = contamination.build(keyed.select(F.col("__row").alias("doc_id"), "text"))
    found = contamination.search(index, table(spark, sf_dir, "benchmark"))
    hit = durable(found.where("n_hit > 0").select(F.col("doc_id").alias("__row")).distinct(), "hit")
    return keyed.join(hit.hint("merge"), "__row", "left_anti").drop("__row")


def retrieval_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("retrieval_packing", retrieval_packing),
]

# Hashed likelihood ratios and packing are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
