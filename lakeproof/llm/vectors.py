"""Near-duplicate vectors by collision-counting projections.

Every vector is projected on many random directions; close vectors lie close in each. The
projections are used twice:

* A few at a time, cut into cells, they deal the vectors out: two vectors meet in a table if
  all its projections put them into the same cells. How many tables it takes follows from the
  share of pairs at the threshold that may be missed, and how many projections make a table
  from the number of vectors, so that cells stay small at every size.
* Among the vectors that meet, other projections are sorted one by one, and each vector opens a
  window around itself; a pair is counted in every window that it shares. Pairs that reach a
  count that all but a few pairs at the threshold reach are verified with the vectors.

A pair that meets in several tables belongs to the first of them, so links are counted once
and no pair ever leaves its task: a task returns, for each vector, its number of links and
the smallest vector that it is connected with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.components import connected_components
from lakeproof.llm.support import in_slices, shuffle_tasks, staged

COSINE = 0.95
#: The share of pairs right at the threshold that may meet in no table; closer pairs are missed far less.
MISSED = 1e-3
#: Vectors that share a cell by chance, about.
CHANCE_IN_CELL = 12
CELL_WIDTH = 1.0
WINDOWS = 64
#: Half a window, in standard deviations of the difference of a pair at the threshold.
WINDOW_REACH = 1.5
#: By how many standard deviations a pair at the threshold may fall short of its mean count.
COUNT_SLACK = 6.0
BLOCK = 1024
#: Vectors of a cell up to which its pairs are counted one by one, and pairs that are counted at a time.
SHORT_RUN, PAIRS_AT_ONCE = 48, 20_000
LINK_SCHEMA = "class bigint, links bigint, least bigint"


@dataclass(frozen=True)
class Plan:
    """Projections per table, tables, and the window and count that a pair must reach."""

    width: int
    tables: int
    reach: float
    count: int
    cosine: float

    def directions(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Directions and shifts of the tables' cells, and the directions of the windows."""
        generator = np.random.default_rng([29, size])
        cells = generator.standard_normal((size, self.width * self.tables))
        return cells, generator.uniform(0, CELL_WIDTH, self.width * self.tables), generator.standard_normal((size, WINDOWS))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of every unit vector in every table, as one number."""
        cells, shifts, _ = self.directions(vectors.shape[1])
        places = np.floor((vectors @ cells + shifts) / CELL_WIDTH).astype(np.int64).view(np.uint64)
        keys = np.zeros((len(vectors), self.tables), np.uint64)
        for k in range(self.width):
            keys = (keys ^ places[:, k::self.width]) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
        keys = (keys + np.arange(self.tables, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) * np.uint64(0xBF58476D1CE4E5B9)
        return (keys ^ (keys >> np.uint64(32)) ^ np.uint64(vectors.shape[1])).view(np.int64)


def same_cell(distance: float, width: float = CELL_WIDTH) -> float:
    """How likely two vectors at a distance are in the same cell of one randomly shifted projection."""
    ratio = width / distance
    inside = math.erf(ratio / math.sqrt(2))
    return inside - math.sqrt(2 / math.pi) / ratio * (1 - math.exp(-ratio * ratio / 2))


def calibrate(vectors: int, cosine: float = COSINE, missed: float = MISSED) -> Plan:
    """The plan for so many vectors."""
    near, far = math.sqrt(2 - 2 * cosine), math.sqrt(2)
    width = max(1, math.ceil(math.log(max(vectors, 2) / CHANCE_IN_CELL) / -math.log(same_cell(far))))
    tables = math.ceil(math.log(missed) / math.log(1 - same_cell(near) ** width))
    share = math.erf(WINDOW_REACH / math.sqrt(2))
    count = math.floor(WINDOWS * share - COUNT_SLACK * math.sqrt(WINDOWS * share * (1 - share)))
    return Plan(width, tables, WINDOW_REACH * near, max(count, 0), cosine)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable(vector: list[float | None] | None) -> bool:
    """Whether a vector can link: not null, not zero, all components numbers."""
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(x != 0 for x in vector)


def vector_classes(embeddings: DataFrame) -> DataFrame:
    """(class, embedding, members): equal vectors as one, named by their smallest id."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    kept = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False)) & F.coalesce(some, F.lit(False))
    )
    return kept.groupBy("embedding").agg(F.min("vec_id").alias("class"), F.count("*").alias("members"))


def _dealt(classes: DataFrame, plan: Plan) -> DataFrame:
    """(class, members, embedding, cells), a cell for every table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 2048):
            vectors = batch["embedding"].to_pylist()
            sizes = np.array([len(v) for v in vectors])
            cells = np.zeros((len(vectors), plan.tables), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                cells[at] = plan.keys(unit(np.array([vectors[k] for k in at], np.float64)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(cells), pa.list_(pa.int64()))], [*batch.schema.names, "cells"]
            )

    return classes.select("class", "members", "embedding").mapInArrow(
        run, "class bigint, members bigint, embedding array<double>, cells array<bigint>"
    )


def _shared_windows(projected: np.ndarray, reach: float) -> np.ndarray:
    """How many windows each pair shares: per direction, vectors are sorted and windows are runs of ranks."""
    shared = np.zeros((len(projected), len(projected)), np.uint8)
    for values in projected.T:
        order = np.sort(values)
        rank = np.searchsorted(order, values)
        first, last = np.searchsorted(order, values - reach), np.searchsorted(order, values + reach, "right")
        shared += (rank[None, :] >= first[:, None]) & (rank[None, :] < last[:, None])
    return shared


@dataclass
class Block:
    """Rows of a batch as arrays: whole runs of rows with one cell and block."""

    classes: np.ndarray
    members: np.ndarray
    side: np.ndarray
    table: np.ndarray
    vectors: np.ndarray
    projected: np.ndarray

    def met_before(self, left: np.ndarray, right: np.ndarray, plan: Plan) -> np.ndarray:
        """Which pairs have met in a table before this one."""
        rows, at = np.unique(np.concatenate([left, right]), return_inverse=True)
        keys = plan.keys(self.vectors[rows])
        same = keys[at[:len(left)]] == keys[at[len(left):]]
        return (same & (np.arange(plan.tables)[None, :] < self.table[left][:, None])).any(axis=1)


def _triangle(size: int, known: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if size not in known:
        known[size] = np.triu_indices(size, 1)
    return known[size]


def _candidate_pairs(block: Block, bounds: list[int], plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one run that share enough windows. Short runs are counted pair by pair, all at once; long ones sorted."""
    lefts, rights = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    short: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def count_short() -> None:
        nonlocal waiting
        left, right = (np.concatenate(x) for x in zip(*short))
        near = (np.abs(block.projected[left] - block.projected[right]) <= plan.reach).sum(axis=1) >= plan.count
        lefts.append(left[near])
        rights.append(right[near])
        short.clear()
        waiting = 0

    for start, end in zip(bounds, bounds[1:]):
        size = end - start
        if size < 2:
            continue
        if size <= SHORT_RUN:
            left, right = _triangle(size, known)
            short.append((left + start, right + start))
            waiting += len(left)
            if waiting > PAIRS_AT_ONCE:
                count_short()
        else:
            shared = _shared_windows(block.projected[start:end], plan.reach)
            left, right = np.nonzero(np.triu((shared >= plan.count) & (shared.T >= plan.count), 1))
            lefts.append(left + start)
            rights.append(right + start)
    if short:
        count_short()
    left, right = np.concatenate(lefts), np.concatenate(rights)
    mixed = np.zeros(len(block.side), bool)
    for start, end in zip(bounds, bounds[1:]):
        mixed[start:end] = block.side[start] != block.side[end - 1] or (block.side[start:end] != block.side[start]).any()
    wanted = ~mixed[left] | (block.side[left] != block.side[right])
    return left[wanted], right[wanted]


def _block_links(block: Block, bounds: list[int], plan: Plan) -> pa.RecordBatch | None:
    """(class, links, least): what the pairs that met here first add to each vector."""
    left, right = _candidate_pairs(block, bounds, plan)
    classes, links = block.classes, np.zeros(len(block.classes), np.int64)
    least = classes.copy()
    found = []
    for start in range(0, len(left), PAIRS_AT_ONCE):
        a, b = left[start:start + PAIRS_AT_ONCE], right[start:start + PAIRS_AT_ONCE]
        linked = (block.vectors[a] * block.vectors[b]).sum(axis=1) >= plan.cosine
        a, b = a[linked], b[linked]
        fresh = ~block.met_before(a, b, plan) if len(a) else np.empty(0, bool)
        a, b = a[fresh], b[fresh]
        np.add.at(links, a, block.members[b])
        np.add.at(links, b, block.members[a])
        found.append((a, b))
    if not links.any():
        return None
    while True:  # the smallest class of each component
        lower = least.copy()
        for a, b in found:
            np.minimum.at(lower, a, least[b])
            np.minimum.at(lower, b, least[a])
        if (lower == least).all():
            break
        least = lower
    kept = links > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(x[kept], pa.int64()) for x in (classes, links, least)], ["class", "links", "least"]
    )


def _links(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        held: list[pa.RecordBatch] = []
        for batch in batches:
            rows = pa.Table.from_batches([*held, batch]).combine_chunks()
            cell, block = rows["cell"].to_numpy(), rows["block"].to_numpy()
            last = max(0, *(np.flatnonzero((np.diff(cell) != 0) | (np.diff(block) != 0)) + 1).tolist(), 0)
            if last:
                yield from of_rows(rows.slice(0, last), directions)
            held = rows.slice(last).to_batches()
        if held:
            yield from of_rows(pa.Table.from_batches(held), directions)

    def of_rows(rows: pa.Table, directions: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes = np.diff(rows["embedding"].combine_chunks().offsets.to_numpy())
        # a cell holds vectors of one length
        for size in np.unique(sizes):
            if size not in directions:
                directions[size] = plan.directions(int(size))[2]
            some = rows.filter(pa.array(sizes == size)).combine_chunks()
            vectors = unit(some["embedding"].combine_chunks().flatten().to_numpy().reshape(some.num_rows, -1))
            cell, part = some["cell"].to_numpy(), some["block"].to_numpy()
            bounds = [0, *(np.flatnonzero((np.diff(cell) != 0) | (np.diff(part) != 0)) + 1).tolist(), len(cell)]
            block = Block(
                *(some[c].to_numpy() for c in ("class", "members", "side", "table")), vectors, vectors @ directions[size]
            )
            found = _block_links(block, bounds, plan)
            if found is not None:
                yield found

    return run


def link_vectors(embeddings: DataFrame, cosine: float = COSINE, missed: float = MISSED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    nor do vectors of different lengths with each other. Equal vectors link with each other, and
    repeated rows are vectors of their own. A null vec_id links with nothing and is not kept.
    Other columns are not read.

    Equal vectors are compared once. A cell with more than ``BLOCK`` vectors is worked on by
    pairs of blocks, each in its own task.
    """
    classes = staged(vector_classes(embeddings), "vector-classes")
    plan = calibrate(classes.count(), cosine, missed)
    dealt = staged(_dealt(classes, plan), "vector-cells")
    cells = dealt.select("class", F.posexplode("cells").alias("table", "cell"))
    shared = cells.groupBy("cell").agg(F.count("*").alias("points")).where("points > 1")
    blocks = F.ceil(F.col("points") / BLOCK)
    placed = cells.join(shared, "cell").withColumn("side", F.pmod(F.xxhash64("class", F.lit("block")), blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    ).withColumn("block", F.least("side", "other") * blocks + F.greatest("side", "other"))
    rows = placed.join(dealt.select("class", "members", "embedding"), "class").select(
        "cell", "block", "table", "class", "members", "side", "embedding"
    )
    sorted_rows = rows.repartition(shuffle_tasks(embeddings.sparkSession), "cell", "block").sortWithinPartitions("cell", "block", "class")
    found = staged(sorted_rows.mapInArrow(_links(plan), LINK_SCHEMA), "vector-links")
    component = connected_components(found.select(F.col("class").alias("a"), F.col("least").alias("b")), "vectors")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    grouped = classes.join(links, "class", "left").join(component.withColumnRenamed("node", "class"), "class", "left").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"),
        F.coalesce("component", "class").alias("component_id"),
    )
    ids = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    named = ids.where("vec_id IS NOT NULL").join(grouped, "embedding", "left").unionByName(
        ids.where("vec_id IS NULL").withColumns({"n_links": F.lit(None).cast("bigint"), "component_id": F.lit(None).cast("bigint")})
    )
    return named.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


LINK_SQL = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= {COSINE}
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
), counted AS (
  SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(any_value(n_links), 0) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reach LEFT JOIN counted USING (vec_id) GROUP BY vec_id
"""
