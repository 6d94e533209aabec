"""Small tables for the corpus operators."""

import random

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.001"
SYLLABLES = "ba de fi go lu mar ten sol ri ka no pe".split()


def words(count: int, seed: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 4))) for _ in range(count)]


def prose(count: int, seed: int) -> str:
    return " ".join(words(count, seed))


def edited(text: str, edits: int, seed: int) -> str:
    draw, parts = random.Random(seed), text.split()
    for _ in range(edits):
        parts[draw.randrange(len(parts))] = f"edit{draw.randrange(1000)}"
    return " ".join(parts)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents with columns whose names clash with those of results and of intermediate tables."""
    schema = "doc_id bigint, text string, score string, component bigint, class string, version int, spans string"
    return spark.createDataFrame([(*row, "x", -1, "c", 7, None) for row in rows], schema)


def awkward() -> list[tuple]:
    """Nulls, empty, blank and long texts, ties and repeated rows."""
    long = prose(4000, 99)
    return [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, long), (5, long), (None, prose(50, 1)), (6, "é ß 中文 😀"), (7, "one")]
