"""Hard negatives by segment summaries.

Vectors of whole numbers are cut into segments, and every segment's mean and deviation are stored.
For two vectors, the products of the segments' means, plus or minus the products of their
deviations, times the segment's length, bound the inner product from both sides. A coarse summary
is looked at first, then finer ones, and only what may still be among the best is scored exactly.

Anchors and rows are dealt into blocks of bounded size, and every block of anchors meets every block
of rows in a task of its own. Blocks of rows come in rounds, small ones first: the best of one
round are the bar of the next, so that later blocks return little. Bars only ever drop what is
worse than enough better rows, so results are those of comparing everything.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeproof.llm.support import shuffle_tasks, staged

#: Segments of the stored summaries, coarse to fine; a vector of fewer components has one each.
SEGMENTS = (1, 4, 16)
#: Components are held between these bounds, so that scores of vectors of 2^15 components fit 64 bits.
LARGEST = 1 << 23
#: Numbers in a block of rows, and anchors of a block.
BLOCK_NUMBERS, BLOCK_ANCHORS = 1 << 21, 4096
#: Anchors and rows that a task compares at a time.
TILE_ANCHORS, TILE_ROWS = 256, 2048
#: By how much a round holds more blocks of rows than all before it.
GROWTH = 32
#: The share of a tile's pairs up to which they are looked at one by one instead of as one product.
FEW = 1 / 16
_FOUND = "anchor bigint, window int, id bigint, score bigint"


def summarise(vectors: np.ndarray) -> np.ndarray:
    """For every vector and summary, sqrt(length) * mean and sqrt(length) * deviation of every segment, in a row."""
    size, parts = vectors.shape[1], []
    for segments in SEGMENTS:
        ends = np.linspace(0, size, min(segments, max(size, 1)) + 1).astype(int)
        cut = [vectors[:, a:b].astype(np.float64) for a, b in zip(ends, ends[1:])]
        root = np.sqrt(np.diff(ends))
        parts.append(np.stack([c.mean(axis=1) if c.shape[1] else np.zeros(len(c)) for c in cut], axis=1) * root)
        parts.append(np.stack([c.std(axis=1) if c.shape[1] else np.zeros(len(c)) for c in cut], axis=1) * root)
    return np.concatenate(parts, axis=1)


def summary_spans(size: int) -> list[tuple[int, int, int]]:
    """(start, middle, end) of each summary in a row of ``summarise``: means, then deviations."""
    spans, at = [], 0
    for segments in SEGMENTS:
        count = min(segments, max(size, 1))
        spans.append((at, at + count, at + 2 * count))
        at += 2 * count
    return spans


@dataclass
class Vectors:
    """Rows of one size as arrays. ``vectors`` are whole numbers, ``summaries`` those of ``summarise``."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    summaries: np.ndarray

    def at(self, places: np.ndarray | slice) -> Vectors:
        return Vectors(self.ids[places], self.labels[places], self.vectors[places], self.summaries[places])

    @classmethod
    def of(cls, rows: pa.Table) -> Vectors:
        def flat(name: str, kind: type) -> np.ndarray:
            column = rows[name].combine_chunks()
            return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1 if len(column) and len(column[0]) else 0)

        return cls(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), flat("vector", np.int64), flat("summary", np.float64))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two arrays of whole numbers."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def tile_scores(anchors: Vectors, rows: Vectors, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the allowed pairs whose score is between the anchor's ``least`` and ``most``.

    Coarse summaries bound all pairs at once, finer ones the pairs that are left; when many are left,
    their tile is scored as one product.
    """
    left, right = np.nonzero(allowed)
    for number, (start, middle, end) in enumerate(summary_spans(anchors.vectors.shape[1])):
        if not len(left) or (number and len(left) > FEW * allowed.size):
            break
        a, r = anchors.summaries, rows.summaries
        if number:
            means = np.einsum("ij,ij->i", a[left, start:middle], r[right, start:middle])
            spread = np.einsum("ij,ij->i", a[left, middle:end], r[right, middle:end])
        else:
            means = (a[:, start:middle] @ r[:, start:middle].T)[left, right]
            spread = (a[:, middle:end] @ r[:, middle:end].T)[left, right]
        slack = 1e-6 * (1 + np.abs(means) + spread)
        kept = (means + spread + slack >= least[left]) & (means - spread - slack <= most[left])
        left, right = left[kept], right[kept]
    if len(left) > FEW * allowed.size:
        scores = products(anchors.vectors, rows.vectors)[left, right]
    else:
        big = float(np.abs(anchors.vectors).max(initial=0)) * float(np.abs(rows.vectors).max(initial=0)) * anchors.vectors.shape[1]
        kind = np.float64 if big < 1 << 53 else np.int64
        scores = np.einsum("ij,ij->i", anchors.vectors[left].astype(kind), rows.vectors[right].astype(kind)).astype(np.int64)
    kept = (scores >= least[left]) & (scores <= most[left])
    return left[kept], right[kept], scores[kept]


def best_of(anchors: Vectors, floors: np.ndarray, caps: np.ndarray, bars: np.ndarray, rows: Vectors, same: bool, top: int) -> pa.RecordBatch:
    """The ``top`` best rows of every anchor and window, as far as they reach the bars.

    A window holds the scores from its floor to its cap. Rows of the anchor's label take part if
    ``same``, rows of other labels else; the anchor itself never does. Higher scores are better, then smaller ids.
    """
    found = []
    for first in range(0, len(anchors.ids), TILE_ANCHORS):
        part = slice(first, first + TILE_ANCHORS)
        some, floor, cap = anchors.at(part), floors[part], caps[part]
        bar = np.maximum(bars[part], floor)
        kept = [np.zeros(0, np.int64)] * 4  # anchor, window, id, score
        for start in range(0, len(rows.ids), TILE_ROWS):
            tile = rows.at(slice(start, start + TILE_ROWS))
            allowed = (some.labels[:, None] == tile.labels[None, :]) == same
            allowed &= some.ids[:, None] != tile.ids[None, :]
            a, r, score = tile_scores(some, tile, allowed, bar.min(axis=1), cap.max(axis=1))
            one, window = np.nonzero((score[:, None] >= bar[a]) & (score[:, None] <= cap[a]))
            if not len(one):
                continue
            kept = [np.r_[old, new] for old, new in zip(kept, (a[one], window, tile.ids[r[one]], score[one]))]
            order = np.lexsort((kept[2], -kept[3], kept[1], kept[0]))
            kept = [k[order] for k in kept]
            group = kept[0] * bar.shape[1] + kept[1]
            place = np.arange(len(group)) - np.searchsorted(group, group)
            full = place == top - 1
            bar[kept[0][full], kept[1][full]] = kept[3][full]
            kept = [k[place < top] for k in kept]
        found.append([some.ids[kept[0]], kept[1].astype(np.int32), kept[2], kept[3]])
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], ["anchor", "window", "id", "score"])


def whole_numbers(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector, size) of the rows that take part: floor(scale * x) of every component, as int.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part.
    Components are held to +-2^23. Of rows that share an id, the one with the smallest label, then vector, is taken.
    """
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(F.lit(float(scale)) * x.cast("double")), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    rows = embeddings.select("vec_id", F.col("label").cast("bigint").alias("label"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False))
    )
    return (
        rows.select("vec_id", F.struct("label", held.alias("vector")).alias("row")).groupBy("vec_id").agg(F.min("row").alias("row"))
        .select("vec_id", "row.label", "row.vector", F.size("row.vector").alias("size"))
    )


def with_summaries(rows: DataFrame) -> DataFrame:
    """The rows with ``summary``, the means and deviations of their segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch["vector"].to_pylist()
            found: list[np.ndarray] = [np.zeros(0)] * len(vectors)
            sizes = np.array(list(map(len, vectors)))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for k, row in zip(at, summarise(np.array([vectors[k] for k in at], np.int64).reshape(len(at), size))):
                    found[k] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.float64()))], [*batch.schema.names, "summary"])

    return rows.mapInArrow(run, "vec_id bigint, label bigint, vector array<int>, size int, summary array<double>")


@dataclass(frozen=True)
class Blocks:
    """How many blocks anchors and rows are dealt into."""

    anchors: int
    rows: int

    def rounds(self) -> list[tuple[int, int]]:
        """The blocks of rows of each round: from, to."""
        ends = [self.rows]
        while ends[0] > GROWTH:
            ends.insert(0, math.ceil(ends[0] / GROWTH))
        return list(zip([0, *ends], ends))


def _block(count: int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")


def deal(anchors: int, rows: int, largest: int, tasks: int, numbers: int = BLOCK_NUMBERS, anchors_at_once: int = BLOCK_ANCHORS) -> Blocks:
    """Blocks of bounded size, and at least as many pairs of blocks as tasks can work on."""
    per_block = max(1, numbers // max(largest, 1))
    of_anchors = max(1, math.ceil(anchors / anchors_at_once))
    return Blocks(of_anchors, max(1, math.ceil(rows / per_block), min(math.ceil(tasks / of_anchors), math.ceil(rows / TILE_ROWS))))


def _search(anchors: DataFrame, rows: DataFrame, windows: int, blocks: Blocks, same: bool, top: int, label: str) -> DataFrame:
    """(anchor, window, id, score): the ``top`` best rows in the windows of every anchor.

    ``anchors`` have ``floors`` and ``caps`` of their windows.
    """
    def compare(key: tuple, some: pa.Table, others: pa.Table) -> pa.Table:
        if not some.num_rows or not others.num_rows:
            return pa.table({"anchor": pa.array([], pa.int64()), "window": pa.array([], pa.int32()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})

        def bounds(name: str) -> np.ndarray:
            return some[name].combine_chunks().flatten().to_numpy().astype(np.int64).reshape(-1, windows)

        return pa.Table.from_batches([best_of(Vectors.of(some), bounds("floors"), bounds("caps"), bounds("bars"), Vectors.of(others), same, top)])

    lowest = F.lit(-(1 << 62)).cast("bigint")
    best = None
    for start, end in blocks.rounds():
        bars = F.array(*[lowest] * windows)
        given = anchors
        if best is not None:
            full = best.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min("score").alias("bar")).where(F.col("n") >= top)
            reached = full.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "bar"))).alias("reached"))
            given = anchors.join(reached.withColumnRenamed("anchor", "vec_id"), "vec_id", "left")
            bars = F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), lambda w: F.coalesce(F.try_element_at("reached", w), lowest))
        names = ("vec_id", "label", "size", "vector", "summary", "floors", "caps")
        left = given.select(
            *(F.col(name).alias(name) for name in names), bars.alias("bars"), _block(blocks.anchors).alias("of_anchors"),
            F.explode(F.sequence(F.lit(start), F.lit(end - 1))).alias("of_rows"),
        )
        right = rows.withColumn("of_rows", _block(blocks.rows)).where(F.col("of_rows").between(start, end - 1)).withColumn(
            "of_anchors", F.explode(F.sequence(F.lit(0), F.lit(blocks.anchors - 1)))
        )
        keys = ("size", "of_anchors", "of_rows")
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, _FOUND)
        merged = found if best is None else best.unionByName(found)
        order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
        best = staged(merged.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).drop("place"), label)
    return best


def mine(
    embeddings: DataFrame, anchors: Column, relabelled: Column | None = None, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, numbers: int = BLOCK_NUMBERS, anchors_at_once: int = BLOCK_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of the anchors.

    The positives of an anchor are its best rows of the same label; the negatives of a pair are the
    best rows of other labels whose score is between ``low`` and ``high`` percent of the positive's.
    ``anchors`` says which rows are anchors, ``relabelled`` what label a row has instead of its own.

    Nulls, components that are not finite and repeated ids: see ``whole_numbers``. Vectors are only
    compared with those of the same size. Ties go to smaller ids. An anchor without positives, a
    positive without negatives and an empty table have no rows. Other columns don't matter.
    """
    spark = embeddings.sparkSession
    rows = whole_numbers(embeddings)
    if relabelled is not None:
        rows = rows.withColumn("label", relabelled.cast("bigint"))
    rows = staged(with_summaries(rows), "negatives-rows")
    chosen = rows.where(anchors)
    sizes = rows.agg(F.count("*"), F.count_if(anchors), F.max("size")).first()
    blocks = deal(sizes[1], sizes[0], sizes[2] or 0, shuffle_tasks(spark), numbers, anchors_at_once)
    wide = [F.array(F.lit(end).cast("bigint")) for end in (-(1 << 62), 1 << 62)]
    near = _search(chosen.withColumns({"floors": wide[0], "caps": wide[1]}), rows, 1, blocks, True, positives, "negatives-positives")
    near = near.withColumn("window", F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id")) - 1)
    # 100 * negative lies between low * positive and high * positive; an unused window holds nothing
    limits = near.select(
        "anchor", "window", F.expr(f"({low} * score + IF(score * {low} > 0, 99, 0)) div 100").alias("floor"),
        F.expr(f"({high} * score - IF(score * {high} < 0, 99, 0)) div 100").alias("cap"),
    )
    windows = F.sequence(F.lit(0), F.lit(positives - 1))
    listed = limits.groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "floor"))).alias("floor"),
        F.map_from_entries(F.collect_list(F.struct("window", "cap"))).alias("cap"),
    )
    bounded = chosen.join(listed.withColumnRenamed("anchor", "vec_id"), "vec_id").withColumns({
        "floors": F.transform(windows, lambda w: F.coalesce(F.try_element_at("floor", w), F.lit(1 << 62))),
        "caps": F.transform(windows, lambda w: F.coalesce(F.try_element_at("cap", w), F.lit(-(1 << 62)))),
    }).drop("floor", "cap")
    far = _search(bounded, rows, positives, blocks, False, negatives, "negatives-found")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("negative_score"), "negative_id")
    positive = near.select("anchor", "window", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        far.select("anchor", "window", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(positive, ["anchor", "window"]).select(
            F.col("anchor").alias("anchor_id"), "positive_id", F.row_number().over(order).alias("rank"), "negative_id",
            "positive_score", "negative_score",
        )
    )


def hard_negatives(embeddings: DataFrame, **options: int) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 100; where 7 divides the id, the label is moved by one of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return mine(embeddings, F.col("vec_id") % 100 == 0, moved, **options)


NEGATIVES_SQL = """
WITH numbers AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.vector, r.vector) AS BIGINT) AS score
    FROM numbers a JOIN numbers r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""
