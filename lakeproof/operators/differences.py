"""Where two copies of a table differ: a tree of hashes over ranges of keys.

Both copies are cut into ranges of their first key column, and every range is reduced to its number
of rows and hashes of them. Ranges whose hashes agree are done. The others are cut again, at keys
sampled from within them, and only they are read again, by filters that reach the scan. When that
no longer sets rows apart, the rows of the unequal ranges alone are compared key by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions.naming import field
from lakeproof.operators.sampling import fair_sample, row_order
from lakeproof.sinks.fingerprint import FINGERPRINT, hash_sums

#: Ranges that one range is cut into, most ranges that are looked at at a time, and most levels.
FANOUT, MOST_RANGES, MOST_LEVELS = 32, 256, 6
#: Rows of unequal ranges that are compared key by key without more cutting.
FEW_ROWS = 1_000_000
ADDED, LOST, CHANGED = "added", "lost", "changed"


@dataclass(frozen=True)
class Range:
    """Keys from ``low`` on and below ``high``; None is open. ``missing`` are the rows whose key is null."""

    low: object = None
    high: object = None
    missing: bool = False

    def holds(self, key: Column) -> Column:
        if self.missing:
            return key.isNull()
        ends = [key >= F.lit(self.low)] if self.low is not None else []
        ends += [key < F.lit(self.high)] if self.high is not None else []
        return reduce(Column.__and__, ends) if ends else key.isNotNull()


@dataclass(frozen=True)
class Level:
    """One step of the search: the ranges that were compared, those that differ, and the rows of each kind."""

    ranges: tuple[Range, ...]
    unequal: tuple[Range, ...]
    rows: int
    unequal_rows: int


def within(rows: DataFrame, key: str, ranges: Sequence[Range]) -> DataFrame:
    """The rows in any of some ranges, by a filter of few comparisons: ranges side by side are one."""
    joined: list[Range] = []
    for r in ranges:
        if joined and not r.missing and not joined[-1].missing and joined[-1].high is not None and joined[-1].high == r.low:
            joined[-1] = Range(joined[-1].low, r.high)
        else:
            joined.append(r)
    return rows.where(reduce(Column.__or__, [r.holds(field(key)) for r in joined])) if joined else rows.where(F.lit(False))


def _number(key: Column, bounds: Sequence[object], first: int = 0) -> Column:
    """How many bounds lie at or below a key, by halving: a key takes a few comparisons, whatever their number."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(key < F.lit(bounds[middle]), _number(key, bounds[:middle], first)).otherwise(_number(key, bounds[middle + 1:], first + middle + 1))


def _compared(source: DataFrame, target: DataFrame, key: str, ranges: Sequence[Range]) -> dict[int, tuple[int, bool]]:
    """For each range with rows: how many both copies hold together, and whether they agree."""
    edges = sorted({b for r in ranges for b in (r.low, r.high) if b is not None})
    number = F.when(field(key).isNull(), -1).otherwise(_number(field(key), edges))
    place = {-1 if r.missing else 0 if r.low is None else edges.index(r.low) + 1: k for k, r in enumerate(ranges)}
    sides = [
        within(side, key, ranges).select(number.alias("number"), F.lit(name).alias("side"), row_order(side).alias("h"))
        for name, side in (("source", source), ("target", target))
    ]
    sums = sides[0].unionByName(sides[1]).groupBy("number", "side").agg(*hash_sums())
    state = F.struct(*FINGERPRINT)
    found = sums.groupBy("number").agg(
        F.sum("row_count").alias("rows"),
        F.max(F.when(F.col("side") == "source", state)).eqNullSafe(F.max(F.when(F.col("side") == "target", state))).alias("equal"),
    ).collect()
    return {place[r["number"]]: (r["rows"], r["equal"]) for r in found}


def _cut(source: DataFrame, target: DataFrame, key: str, ranges: Sequence[Range], fanout: int, rows: int) -> list[Range]:
    """The ranges, cut at keys that are sampled from their rows in both copies."""
    wanted = min(fanout * len(ranges), MOST_RANGES)
    keys = [within(side, key, ranges).select(field(key).alias("key"), row_order(side).alias("drawn")) for side in (source, target)]
    sample = fair_sample(keys[0].unionByName(keys[1]), 16 * wanted, F.col("drawn"), rows).collect()
    drawn = sorted(r["key"] for r in sample if r["key"] is not None and r["key"] == r["key"])  # not null, and a number
    bounds = sorted(set(drawn[len(drawn) // wanted // 2::max(1, len(drawn) // wanted)]))
    cut = []
    for r in ranges:
        inner = [] if r.missing else [b for b in bounds if (r.low is None or b > r.low) and (r.high is None or b < r.high)]
        ends = [r.low, *inner, r.high]
        cut += [r] if not inner else [Range(a, b) for a, b in zip(ends, ends[1:])]
    return cut


def unequal_ranges(
    source: DataFrame, target: DataFrame, key: str, fanout: int = FANOUT, few_rows: int = FEW_ROWS, most_levels: int = MOST_LEVELS,
) -> list[Level]:
    """The steps of the search for ranges of ``key`` in which two copies differ; none differs if the last has none.

    What reaches the driver is one row per range, at most ``MOST_RANGES`` or as many as differ.
    """
    levels: list[Level] = []
    ranges = [Range(), Range(missing=True)]
    while True:
        found = _compared(source, target, key, ranges)
        unequal = tuple(r for k, r in enumerate(ranges) if not found.get(k, (0, True))[1])
        rows, left = (sum(n for k, (n, equal) in found.items() if which or not equal) for which in (True, False))
        levels.append(Level(tuple(ranges), unequal, rows, left))
        # another cut has to promise something: it can't if one value fills a range or differences are everywhere
        stuck = len(levels) > 1 and 2 * left > levels[-2].unequal_rows
        if not unequal or left <= few_rows or stuck or len(levels) > most_levels or len(unequal) >= MOST_RANGES // 2:
            return levels
        cut = _cut(source, target, key, unequal, fanout, left)
        if len(cut) == len(unequal):
            return levels
        ranges = cut


def compare_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key that two copies hold differently; see ``differences``. Compares all rows that it is given."""
    others = [c for c in source.columns if c not in keys]
    sides = [
        side.select(*[field(k) for k in keys], F.struct(*[field(c) for c in others] or [F.lit(0).alias("none")]).alias("values"), row_order(side).alias("h"),
                    F.lit(int(name == "source")).alias("is_source"))
        for name, side in (("source", source), ("target", target))
    ]
    by_row = sides[0].unionByName(sides[1]).groupBy(*[field(k) for k in keys], "h").agg(
        F.sum("is_source").alias("in_source"), F.sum(1 - F.col("is_source")).alias("in_target"), F.first("values").alias("values")
    )
    by_key = by_row.groupBy(*[field(k) for k in keys]).agg(
        F.sum("in_source").alias("source_rows"), F.sum("in_target").alias("target_rows"),
        F.sum(F.abs(F.col("in_source") - F.col("in_target"))).alias("apart"),
        F.first(F.when(F.col("in_source") > 0, F.col("values")), True).alias("old"), F.first(F.when(F.col("in_target") > 0, F.col("values")), True).alias("new"),
    ).where("apart > 0")
    state = F.when(F.col("source_rows") == 0, ADDED).when(F.col("target_rows") == 0, LOST).otherwise(CHANGED)
    changed = F.array_compact(F.array(*[
        F.when(~F.col("old").getField(c).eqNullSafe(F.col("new").getField(c)), F.lit(c)) for c in others
    ])) if others else F.array().cast("array<string>")
    single = (F.col("source_rows") == 1) & (F.col("target_rows") == 1)
    return by_key.select(
        *[field(k) for k in keys], state.alias("state"), "source_rows", "target_rows", F.when(single, F.concat_ws(",", changed)).alias("changed_columns")
    )


def differences(
    source: DataFrame, target: DataFrame, keys: Sequence[str], fanout: int = FANOUT, few_rows: int = FEW_ROWS, most_levels: int = MOST_LEVELS,
) -> DataFrame:
    """(keys, state, source_rows, target_rows, changed_columns) of the keys whose rows differ between two copies.

    ``state`` is added (only the target has the key), lost (only the source), or changed. Rows of one
    key are compared as a multiset; where both copies have a single one, ``changed_columns`` names what
    differs in it. Null equals null, in keys too. Only the source's columns count, and the target's are
    read as the source's types; a value that doesn't fit is null. Columns must not be called like
    the results. Equal copies, and empty ones, give no rows.

    The first key column's ranges are what is told apart; choose one by which files are laid out.
    """
    clash = {"state", "source_rows", "target_rows", "changed_columns"} & {k.lower() for k in keys}
    if clash or not keys:
        raise ValueError(f"keys {list(keys)} can't be told from results" if keys else "a comparison needs a key")
    copied = target.select([field(f.name).try_cast(f.dataType).alias(f.name) for f in source.schema])
    ranges = unequal_ranges(source, copied, keys[0], fanout, few_rows, most_levels)[-1].unequal
    return compare_keys(within(source, keys[0], ranges), within(copied, keys[0], ranges), keys)
