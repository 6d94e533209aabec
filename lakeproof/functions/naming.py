"""Column and table names: prefixes, header clean-up, de-duplication."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Back-quote a column name so that dots are not read as struct access."""
    return "`" + name.replace("`", "``") + "`"


def field(name: str) -> Column:
    return F.col(quoted(name))


def bare_upper(name: str) -> str:
    """``table.column`` becomes ``COLUMN``."""
    return name.rsplit(".", 1)[-1].upper()


def clean_header(name: str) -> str:
    """Spaces, slashes and other non-word characters become one underscore."""
    return re.sub(r"[^\w]+", "_", name.strip()).strip("_") or "column"


def unique_names(names: Iterable[str]) -> list[str]:
    """Suffix repeats with ``_2``, ``_3`` ... ; Spark compares names without case."""
    taken: set[str] = set()
    result = []
    for name in names:
        candidate, n = name, 1
        while candidate.lower() in taken:
            n += 1
            candidate = f"{name}_{n}"
        taken.add(candidate.lower())
        result.append(candidate)
    return result


def table_part(qualified: Column) -> Column:
    """The last part of ``schema.table``."""
    return F.substring_index(qualified, ".", -1)
