"""Groups of documents whose shingle sets have a Jaccard similarity of 0.8 or more.

Count-vector R-tree: the shingles of a set are hashed into groups, the counts of the groups
are a point, and the summed smaller coordinates of two points bound their overlap. Pairs that
the bound lets pass are verified with the sets themselves.

One tree over all documents would be one task's work, and counts lie so close together that
every search would visit most of it. So the points are dealt into cells first: a set is in the
cells of its least shingle under each of ``CELL_ORDERS`` random orders. Two sets with similarity
s share the cell of one order with probability s, and miss all of them with 0.2 ** 24, about
2e-17, at 0.8: less than the chance that two 64-bit hashes meet. Every cell has its own tree.

1. Equal sets become one class.
2. Each cell's tree yields as few passing pairs as connect its points (a forest), so a large
   group of near copies gives about as many pairs as members; they are verified.
3. Where a cell still holds several components, its tree yields every passing pair across
   them, which are verified too. No link between components stays unseen.
4. Verified pairs and equal sets together give the components.

A cell with more points than ``BLOCK`` is worked on in blocks (step 2) and pairs of blocks
(step 3), each by its own task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.components import connected_components
from lakeproof.llm.counttree import CountTree, packed_counts, unpacked_counts
from lakeproof.llm.shingles import shingle_set
from lakeproof.llm.support import in_slices, shuffle_tasks, sized_join, staged, text_of

CELL_ORDERS = 24
BLOCK = 2048
_GENERATOR = np.random.default_rng(17)
_TIMES = (_GENERATOR.integers(1, 1 << 63, CELL_ORDERS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_PLUS = _GENERATOR.integers(0, 1 << 63, CELL_ORDERS, dtype=np.uint64)

SKETCH_SCHEMA = "doc_id bigint, n_shingles bigint, class bigint, counts binary, cells array<bigint>"
PAIR_SCHEMA = "a bigint, b bigint"


def cells_of(tokens: np.ndarray) -> np.ndarray:
    """The cell of a set under each order: the least value of its shingles there."""
    least = np.empty(CELL_ORDERS, np.uint64)
    for start in range(0, CELL_ORDERS, 8):
        orders = slice(start, start + 8)
        least[orders] = (tokens[:, None] * _TIMES[orders] + _PLUS[orders]).min(axis=0)
    return least.view(np.int64)


def set_class(tokens: np.ndarray) -> int:
    """A hash of the whole set; equal sets have equal classes."""
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).astype(np.int64))


def sketch(documents: DataFrame) -> DataFrame:
    """Per row: number of shingles, class, count vector and cells. Rows without shingles have no class and no cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets = [shingle_set(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"],
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "class": pa.array([set_class(s) if len(s) else None for s in sets], pa.int64()),
                "counts": pa.array([packed_counts(s) if len(s) else None for s in sets], pa.binary()),
                "cells": pa.array([cells_of(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
            })

    return documents.select("doc_id", text_of()).mapInArrow(run, SKETCH_SCHEMA)


def sets_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, tokens) of the wanted (doc_id, class) rows, from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets = [shingle_set(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "class": pa.array([set_class(s) if len(s) else None for s in sets], pa.int64()),
                "wanted": batch["wanted"],
                "tokens": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            })

    texts = sized_join(
        documents.select("doc_id", text_of()), wanted.groupBy("doc_id").agg(F.collect_set("class").alias("wanted")), "doc_id"
    )
    found = texts.select("text", "wanted").mapInArrow(run, "class bigint, wanted array<bigint>, tokens array<bigint>")
    return found.where(F.array_contains("wanted", F.col("class"))).groupBy("class").agg(F.first("tokens").alias("tokens"))


def _block_pairs(emit: Callable[[CountTree, dict[str, np.ndarray]], Iterator[tuple[int, int]]]):
    """A task function over rows sorted by (cell, block): one tree for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            cell, block = table["cell"].to_numpy(), table["block"].to_numpy()
            cuts = np.flatnonzero((np.diff(cell) != 0) | (np.diff(block) != 0)) + 1
            bounds = [0, *cuts.tolist()]
            found = [p for start, end in zip(bounds, bounds[1:]) for p in _of_block(table.slice(start, end - start))]
            held = table.slice(bounds[-1]).to_batches()
            yield _pair_batch(found)
        if held:
            yield _pair_batch(list(_of_block(pa.Table.from_batches(held).combine_chunks())))

    def _of_block(rows: pa.Table) -> Iterator[tuple[int, int]]:
        if rows.num_rows < 2:
            return
        points = np.stack([unpacked_counts(c) for c in rows["counts"].to_pylist()])
        tree = CountTree(points, rows["n_shingles"].to_numpy())
        classes = rows["class"].to_numpy()
        for i, j in emit(tree, {c: rows[c].to_numpy() for c in ("component", "side")}):
            if classes[i] != classes[j]:
                yield min(classes[i], classes[j]), max(classes[i], classes[j])

    return run


def _pair_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(sorted(set(found)), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _forest(tree: CountTree, columns: dict[str, np.ndarray]) -> Iterator[tuple[int, int]]:
    return tree.forest()


def _across(tree: CountTree, columns: dict[str, np.ndarray]) -> Iterator[tuple[int, int]]:
    side = columns["side"]
    return tree.pairs(columns["component"], side if side.min() != side.max() else None)


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of a block in one task, in an order that does not depend on how they came."""
    return rows.repartition(shuffle_tasks(rows.sparkSession), "cell", "block").sortWithinPartitions("cell", "block", "n_shingles", "class", "side")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets have a similarity of 0.8 or more."""
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("tokens").alias("left")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("tokens").alias("right")), "b"
    )
    overlap = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - overlap
    return both.where(100 * overlap >= 80 * union).select("a", "b")


def _share_of(key: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), parts)


def similar_classes(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): verified links between classes, enough to give every component."""
    cells = classes.select("class", F.explode("cells").alias("cell"))
    shared = cells.groupBy("cell").agg(F.count("*").alias("points")).where("points > 1")
    members = staged(
        cells.join(shared, "cell").join(classes.select("class", "doc_id", "n_shingles", "counts"), "class"), "cell-members"
    )
    blocks = F.ceil(F.col("points") / BLOCK)
    dealt = members.withColumn("block", _share_of(F.col("class"), blocks)).withColumns({
        "component": F.lit(0).cast("bigint"), "side": F.lit(0).cast("bigint"),
    })
    columns = ("cell", "block", "class", "n_shingles", "counts", "component", "side")
    tried = staged(_in_blocks(dealt.select(*columns)).mapInArrow(_block_pairs(_forest), PAIR_SCHEMA).distinct(), "forest-pairs")
    named = members.select("class", "doc_id").distinct()
    sets = staged(sets_of(documents, _of_pairs(tried, named)), "forest-sets")
    links = staged(_verified(tried, sets), "forest-links")

    component = connected_components(links, "class").select(F.col("node").alias("class"), "component")
    placed = members.join(component, "class", "left").withColumn("component", F.coalesce("component", "class"))
    mixed = placed.groupBy("cell").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    # a point goes to the pairs of its block with each block; in a cell of one block to that one
    own = _share_of(F.col("class"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    across = placed.join(mixed.select("cell"), "cell").withColumn("side", own).withColumn("other", other).withColumn(
        "block", F.least("side", "other") * blocks + F.greatest("side", "other")
    )
    passing = _in_blocks(across.select(*columns)).mapInArrow(_block_pairs(_across), PAIR_SCHEMA).distinct()
    left = staged(passing.join(tried, ["a", "b"], "left_anti"), "across-pairs")
    more = staged(sets_of(documents, _of_pairs(left, named)), "across-sets")
    return links.unionByName(_verified(left, more))


def _of_pairs(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """(doc_id, class) of the classes in some pairs."""
    return pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(named, "class")


def similarity_components(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Null and empty texts have no shingles and stand alone. Repeated rows share a component,
    as do different texts under one id, which are one document. A row with a null id is linked
    with nothing and has no component. Other columns are not read.
    """
    sketched = staged(sketch(documents), "sketches")
    known = sketched.where("doc_id IS NOT NULL AND class IS NOT NULL")
    classes = staged(known.groupBy("class", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), F.first("counts").alias("counts"), F.first("cells").alias("cells")
    ), "classes")
    first = classes.select("class", F.col("doc_id").alias("first"))
    links = similar_classes(documents, classes)
    between = links.join(first.select(F.col("class").alias("a"), F.col("first").alias("x")), "a").join(
        first.select(F.col("class").alias("b"), F.col("first").alias("y")), "b"
    ).select(F.col("x").alias("a"), F.col("y").alias("b"))
    copies = known.select("doc_id", "class").join(first, "class").where("doc_id <> first").select(
        F.col("doc_id").alias("a"), F.col("first").alias("b")
    )
    component = connected_components(between.unionByName(copies), "documents")
    return sketched.select("doc_id", "n_shingles").join(
        component.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    ).select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each_group(documents: DataFrame) -> DataFrame:
    """One row of each group of near copies, that of the smallest id, with all its columns.

    Of rows that share an id the one with the first text stays. Rows without an id are linked
    with nothing and stay; empty texts stay too.
    """
    copies = similarity_components(documents).where("doc_id <> component_id").select("doc_id").distinct()
    originals = sized_join(documents, copies, "doc_id", "left_anti")
    repeated = documents.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    repeated = staged(repeated, "repeated-ids")
    if not repeated.take(1):
        return originals.select(*documents.columns)
    first = originals.join(repeated, "doc_id").select(*documents.columns).groupBy("doc_id").agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in documents.columns]), F.coalesce("text", F.lit(""))).alias("row")
    ).select("row.*")
    return originals.join(repeated, "doc_id", "left_anti").select(*documents.columns).unionByName(first)


SIMILARITY_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS shingle
  FROM texts, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS starts(p) WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * o >= 80 * (s.n + t.n - o)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""
