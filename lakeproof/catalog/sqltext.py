"""SQL for the metric tables, written out per column as the oracle needs it."""

from __future__ import annotations

from collections.abc import Sequence


def union_all(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def primary_key_sql(relation: str, keys: Sequence[str], fields: int, schema: str, table: str) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    head = f"SELECT '{schema}' AS schema_name, '{table}' AS table_name"
    return union_all([
        f"{head}, 'unique count' AS measure, 'primary key' AS column_value, count(*) AS freq "
        f"FROM (SELECT DISTINCT {', '.join(keys)} FROM {relation} WHERE {present})",
        f"{head}, 'record count', '', count(*) FROM {relation}",
        f"{head}, 'field count', '', CAST({fields} AS BIGINT)",
    ])


def categorical_sql(relation: str, columns: Sequence[str], schema: str, table: str) -> str:
    return union_all([
        f"SELECT '{schema}' AS schema_name, '{table}' AS table_name, '{c}' AS column_name, {c} AS column_value, "
        f"count(*) AS freq FROM {relation} GROUP BY {c}"
        for c in columns
    ])


def numeric_sql(relation: str, columns: Sequence[str], schema: str, table: str) -> str:
    statistics = {
        "min_value": "min({c})", "max_value": "max({c})", "avg_value": "avg({c})", "stddev_value": "stddev_samp({c})",
        **{f"{t}0th_percentile": "quantile_disc({c}, 0." + str(t) + ")" for t in range(1, 10)},
        "null_values": "count(*) FILTER ({c} IS NULL)",
    }
    parts = []
    for c in columns:
        listed = ", ".join(
            f"struct_pack(variable := '{variable}', value := CAST({expression.format(c=c)} AS DOUBLE))"
            for variable, expression in statistics.items()
        )
        parts.append(
            f"SELECT '{schema}' AS schema_name, '{table}' AS table_name, '{c}' AS column_name, "
            f"s.variable AS variable, s.value AS value "
            f"FROM (SELECT unnest([{listed}]) AS s FROM {relation})"
        )
    return union_all(parts)


def date_sql(relation: str, columns: Sequence[str], schema: str, table: str) -> str:
    parts = []
    for c in columns:
        head = f"SELECT '{schema}' AS schema_name, '{table}' AS table_name, '{c}' AS column_name"
        parts += [
            f"{head}, '{p}' AS date_type, CAST({p}({c}) AS VARCHAR) AS column_value, "
            f"CAST(count(*) AS VARCHAR) AS freq FROM {relation} GROUP BY {p}({c})"
            for p in ("year", "month", "day")
        ]
        parts += [
            f"{head}, 'boundary', '{m}imum', CAST({m}({c}) AS VARCHAR) FROM {relation}" for m in ("max", "min")
        ]
    return union_all(parts)


MERGE = "CASE WHEN s._in_src IS NULL THEN 'right_only' WHEN t._in_tgt IS NULL THEN 'left_only' ELSE 'both' END AS _merge"


def joined_sql(
    source: str, target: str, keys: Sequence[str], others: Sequence[str], extra: str, how: str = "FULL OUTER"
) -> str:
    """Null-safe join of two metric relations, with the columns named as the compare operators name them."""
    on = " AND ".join(f"s.{k} IS NOT DISTINCT FROM t.{k}" for k in keys)
    selected = [f"CASE WHEN s._in_src THEN s.{k} ELSE t.{k} END AS {k}" for k in keys]
    selected += [f"s.{c} AS {c}, t.{c} AS {c}_tgt" for c in others]
    return (
        f"SELECT {', '.join(selected)}, {MERGE}{', ' + extra if extra else ''} "
        f"FROM (SELECT *, TRUE AS _in_src FROM ({source})) s {how} JOIN (SELECT *, TRUE AS _in_tgt FROM ({target})) t "
        f"ON {on}"
    )


def differences_sql(measure: str, prefix: str = "") -> str:
    diff, percent = (f"{prefix}ValueDiff", f"{prefix}PercentDiff") if prefix else ("value_diff", "percent_diff")
    s, t = f"CAST(s.{measure} AS DOUBLE)", f"CAST(t.{measure} AS DOUBLE)"
    return f"{s} - {t} AS {diff}, ({s} - {t}) / NULLIF({s}, 0) * 100 AS {percent}"
