"""A pipeline from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
returns rows whose decisions the next stage sees. All but the last return the columns of
the documents. Between stages the rows are written to the shared folder, so every stage runs
once and a lost executor repeats only tasks of the current one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import lakeproof
from lakeproof.llm.decontamination import without_contaminated
from lakeproof.llm.packing import pack
from lakeproof.llm.secrets import redact_secrets
from lakeproof.llm.similarity import one_of_each_group
from lakeproof.llm.support import staged, table
from lakeproof.llm.toxicity import learn_lexicon, without_toxic

cloudpickle.register_pickle_by_value(lakeproof)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon doesn't reject, with all their columns.

    Null and empty texts stay, repeated rows are judged each, a null id teaches nothing. Without
    labels of both classes the fixed list alone decides. An empty table stays empty.
    """
    return without_toxic(docs, learn_lexicon(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id, with all its columns.

    Repeated rows stay once; of different texts that share an id the first one stays. Null and empty
    texts are near copies of nothing and stay, as do rows with a null id. An empty table stays empty.
    """
    return one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, with all their columns.

    Null and empty texts have no words and stay, a null id is judged by its text like any other,
    different texts under one id apart. Without benchmark items everything stays.
    """
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with all their columns, and a mark in place of every secret.

    A null text stays null and an empty one empty; ``n_chars``, if there is one, is brought up to
    date. Repeated rows and null ids are treated like others. An empty table stays empty.
    """
    return redact_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens.

    Null and empty texts are pieces of the end id alone, repeated rows have pieces each, a null id
    stays null. Other columns go. An empty table has no pieces.
    """
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("secret_scan", hide_secrets),
    ("packing", pack_sequences),
]

#: Lexicons learnt from labels, token vocabularies and packing have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
