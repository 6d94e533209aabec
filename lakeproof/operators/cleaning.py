"""Value clean-up before metrics are taken, and config rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.naming import field

BLANK_TEXT = "null"


def blank_to_null_text(df: DataFrame) -> DataFrame:
    """Empty text becomes the text ``null``; real nulls and other types stay."""
    return df.select([
        F.when(field(f.name) == "", BLANK_TEXT).otherwise(field(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else field(f.name)
        for f in df.schema
    ])


def void_to_string(df: DataFrame) -> DataFrame:
    """Columns without any type (all null) become text, so that they can be stored."""
    return df.select([
        field(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else field(f.name)
        for f in df.schema
    ])


def rewrite_schema_name(config: DataFrame, flag: str = "curated_flag", schema: str = "schema_name") -> DataFrame:
    """Flagged tables live in ``curated`` instead of ``published``."""
    rewritten = F.replace(F.col(schema), F.lit("published"), F.lit("curated"))
    return config.withColumn(schema, F.when(F.col(flag) == "1", rewritten).otherwise(F.col(schema)))
