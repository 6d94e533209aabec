"""One registered query for each corpus operator, over the whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeproof.llm.decontamination import CONTAMINATION_SQL, find_contamination
from lakeproof.llm.languages import language_report
from lakeproof.llm.merkle import MERKLE_SQL, verification
from lakeproof.llm.negatives import NEGATIVES_SQL, hard_negatives
from lakeproof.llm.packing import pack
from lakeproof.llm.pages import extract_pages
from lakeproof.llm.pii import find_personal_data
from lakeproof.llm.quality import quality_report
from lakeproof.llm.secrets import scan_secrets
from lakeproof.llm.similarity import SIMILARITY_SQL, similarity_components
from lakeproof.llm.support import table
from lakeproof.llm.tokenfiles import token_file_round_trip
from lakeproof.llm.toxicity import toxicity_report
from lakeproof.llm.vectors import LINK_SQL, link_vectors

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query, sql: str | None = None) -> Query:
    QUERIES[function.__name__] = function
    if sql is not None:
        ORACLES[function.__name__] = sql
    return function


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"))


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token files of all documents hold."""
    return token_file_round_trip(spark, table(spark, sf_dir, "documents"))


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find_personal_data(table(spark, sf_dir, "documents"))


@query
def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


query(op8_decontamination, CONTAMINATION_SQL)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every document."""
    return similarity_components(table(spark, sf_dir, "documents"))


query(op2_jaccard_join, SIMILARITY_SQL)


def op7_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near duplicates of every vector."""
    return link_vectors(table(spark, sf_dir, "embeddings"))


query(op7_vector_links, LINK_SQL)


@query
def op11_word_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language_report(table(spark, sf_dir, "documents"))


def op12_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


query(op12_segment_negatives, NEGATIVES_SQL)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verification of every document."""
    return verification(table(spark, sf_dir, "documents"))


query(op13_merkle_manifest, MERKLE_SQL)
