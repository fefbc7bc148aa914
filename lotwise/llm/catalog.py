"""The queries of these operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lotwise.llm import (
    collocations,
    contamination,
    conversations,
    html_text,
    jaccard,
    licences,
    lines,
    packing,
    personal,
    repeats,
    token_files,
    urls,
)
from lotwise.llm import quality as Q
from lotwise.llm.inputs import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return Q.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op3_benchmark_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    documents, items = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return contamination.report(documents, items)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families named in every document."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.listed(pages))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its cross-site boilerplate lines."""
    return lines.report(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return personal.personal_data(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids, read back from files."""
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and near-duplicate component of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired hash of every conversation."""
    return conversations.report(table(spark, sf_dir, "conversations"))


def op12_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that stand twice in the corpus."""
    return repeats.report(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language that hold together best."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_retrieval_packing": op2_retrieval_packing,
    "op3_benchmark_contamination": op3_benchmark_contamination,
    "op4_main_text": op4_main_text,
    "op5_licence_scan": op5_licence_scan,
    "op6_url_filter": op6_url_filter,
    "op7_line_dedup": op7_line_dedup,
    "op8_personal_data": op8_personal_data,
    "op9_token_files": op9_token_files,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_repeated_strings": op12_repeated_strings,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op6_url_filter": urls.SQL,
    "op7_line_dedup": lines.SQL,
    "op12_repeated_strings": repeats.SQL,
    "op13_collocations": collocations.SQL,
}
