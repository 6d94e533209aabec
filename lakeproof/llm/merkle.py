"""A Merkle manifest of a table: leaves, subtrees, proofs and their verification.

A leaf is the hash of a row's fields. Every tree (one for each value of a column) is reduced eight
nodes at a time; the tops of the trees are leaves of one more tree, whose top is the root.

Trees are cut into superblocks of four levels, 4096 leaves each. On the way up a group is one
superblock and gives one node, so the table shrinks by 4096 each time and a few rounds reach the
tops. On the way down every superblock meets the one row that says what lies outside of it: the
siblings from its top to the root. Nodes and outer row are cogrouped by superblock, and one function
reduces the nodes again, joins inner and outer siblings to proofs and folds each proof. No group
holds more than a superblock, whatever the size of a tree, and no tree passes through one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeproof.llm.support import staged

#: Nodes that become one, and levels of a superblock.
ARITY = 8
SPAN = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODES = "tree string, at bigint, size bigint, node string"
_PATHS = f"{_NODES}, subroot string, root string, places array<int>, siblings string"


def digest(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


def row_hash(fields: Sequence[str], changed: Mapping[str, Column] | None = None) -> Column:
    """The hash of fields, each as its byte count, a colon and its value, ``-`` for null."""
    def part(name: str) -> Column:
        value = (changed or {}).get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with ``at``, their rank from 0 in their ``tree``, and its ``size``.

    One range shuffle; the ranks before a partition come from one count per partition and tree,
    so neither a tree nor the rows of one key meet in a task.
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, seen = None, 0
        for batch in batches:
            places = []
            for name in batch["tree"].to_pylist():
                tree, seen = name, seen + 1 if name == tree else 0
                places.append(seen)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "inside"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    numbered = staged(
        rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
        .mapInArrow(number, f"{columns}, inside bigint").withColumn("part", F.spark_partition_id()),
        "merkle-ranks",
    )
    counts = numbered.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "tree", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
        F.sum("rows").over(Window.partitionBy("tree")).alias("size"),
    )
    return numbered.join(offsets, ["tree", "part"]).withColumn("at", F.col("inside") + F.col("offset")).drop("inside", "part", "offset")


def reduce_levels(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a superblock on each of its levels, the given ones first."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([digest("".join(below[k:k + ARITY])) for k in range(0, len(below), ARITY)])
    return found


def levels_of(size: int, span: int) -> int:
    """Levels that a superblock of a tree of so many nodes has above them."""
    levels = 0
    while size > 1 and levels < span:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def fold(node: str, places: Sequence[int], siblings: str) -> str:
    """The root that a node and its proof give. A place says where a node stands in a run of how many: place * 8 + others."""
    start = 0
    for place in places:
        place, others = divmod(place, ARITY)
        left, end = start + 64 * place, start + 64 * others
        node, start = digest(siblings[start:left] + node + siblings[left:end]), end
    return node


def _blocks(nodes: DataFrame, span: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"at div {ARITY**span}"))


def _tops(nodes: DataFrame, span: int) -> DataFrame:
    """The top of every superblock, as a node of the next table."""
    def top(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        size = int(group["size"].iloc[0])
        found = reduce_levels(group.sort_values("at")["node"].tolist(), levels_of(size, span))
        return pd.DataFrame({"tree": [key[0]], "at": [key[1]], "size": [-(-size // ARITY**span)], "node": [found[-1][0]]})

    return _blocks(nodes.select("tree", "at", "size", "node"), span).groupBy("tree", "block").applyInPandas(top, _NODES)


def _climb(nodes: DataFrame, span: int, label: str) -> list[DataFrame]:
    """The nodes and the tops of their superblocks, up to the table whose trees are one node each."""
    tables = [nodes]
    while (tables[-1].agg(F.max("size")).first()[0] or 0) > 1:
        tables.append(staged(_tops(tables[-1], span), label))
    return tables


def _descend(nodes: DataFrame, outer: DataFrame, span: int, extra: str = "") -> DataFrame:
    """The path to the root of every node, from the nodes of its superblock and the path of its top.

    ``extra`` names further columns of the nodes, with their types; a column ``presented`` among
    them is the node that is folded with the path, as column ``folded``.
    """
    names = [part.split()[0].strip("`") for part in extra.split(", ") if part]
    folds = "presented" in names
    schema = _PATHS + (f", {extra}" if extra else "") + (", folded string" if folds else "")

    def paths(key: tuple, inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner = inner.sort_values("at")
        top = above.iloc[0]
        found = reduce_levels(inner["node"].tolist(), levels_of(int(inner["size"].iloc[0]), span))[:-1]
        upper, beyond = list(top["places"]), top["siblings"]
        places, siblings = [], []
        for k in range(len(inner)):
            own, parts = [], []
            for level in found:
                first = k - k % ARITY
                run = level[first:first + ARITY]
                own.append((k - first) * ARITY + len(run) - 1)
                parts += run[:k - first] + run[k - first + 1:]
                k //= ARITY
            places.append(own + upper)
            siblings.append("".join(parts) + beyond)
        given = inner.drop(columns="block")
        given = given.assign(subroot=top["subroot"], root=top["root"], places=places, siblings=siblings)
        if folds:
            given["folded"] = [fold(*x) for x in zip(given["presented"], places, siblings)]
        return given

    keyed = outer.withColumnRenamed("at", "block").select("tree", "block", "subroot", "root", "places", "siblings")
    return _blocks(nodes, span).groupBy("tree", "block").cogroup(keyed.groupBy("tree", "block")).applyInPandas(paths, schema)


def manifest(
    rows: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "lang", order: str = "doc_id",
    presented: Mapping[str, Column] | None = None, span: int = SPAN,
) -> DataFrame:
    """(order column, tree, leaf, at, size, subroot, root, places, siblings, presented, folded) of every row.

    Leaves are hashes of ``fields``; each value of the column ``tree`` has a tree (null too, and
    first), in which leaves ascend by the column ``order``, null first. ``places`` and ``siblings``
    are the proof, from the leaf to the root: see ``fold``. ``presented`` gives other values for some
    fields; ``folded`` is the root that the leaf of those values gives with the proof of the stored row,
    so it equals ``root`` where nothing was changed.

    Null values, empty and long texts are hashed as they are. Rows with equal ids ascend by leaf;
    repeated rows are leaves of their own, and equal. An empty table has no rows. Other columns of
    the table don't matter, whatever their names.
    """
    kind = rows.schema[order].dataType.simpleString()
    leaves = staged(
        rows.select(
            F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("tree"), F.col(order).alias("key"),
            row_hash(fields).alias("node"), row_hash(fields, presented).alias("presented"),
        ).withColumn("copy", F.monotonically_increasing_id()),
        "merkle-leaves",
    )
    # copies of a row are told apart by a number that was written once, so a third of all rows may be one row
    placed = staged(ranked(leaves, ["key", "node", "copy"]).drop("copy"), "merkle-placed")
    tables = _climb(placed.select("tree", "at", "size", "node"), span, "merkle-nodes")
    subroots = tables[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    crown = staged(ranked(subroots, ["name"]), "merkle-subroots")
    above = _climb(crown.select("tree", "at", "size", "node"), span, "merkle-crown")
    root = above[-1].select(
        "tree", "at", "size", "node", F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"),
        F.array().cast("array<int>").alias("places"), F.lit("").alias("siblings"),
    )
    paths = root
    for nodes in reversed(above[1:-1]):
        paths = staged(_descend(nodes, paths, span), "merkle-paths")
    paths = staged(_descend(crown, paths, span, "name string"), "merkle-paths")
    paths = paths.select(F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("at"), F.col("node").alias("subroot"), "root", "places", "siblings")
    for nodes in reversed(tables[1:-1]):
        paths = staged(_descend(nodes, paths, span), "merkle-paths")
    found = _descend(placed, paths, span, f"key {kind}, presented string")
    return found.select(
        F.col("key").alias(order), F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("tree"),
        F.col("node").alias("leaf"), "at", "size", "subroot", "root", "places", "siblings", "presented", "folded",
    )


def lower_ascii(column: Column | str) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def verification(documents: DataFrame, every: int = 3, span: int = SPAN) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document.

    Where ``every`` divides the crc32 of the id as text, the text is tampered with before its proof
    is checked: A-Z become lower case. A null id is not tampered with. For null values, repeated
    rows and an empty table see ``manifest``.
    """
    tampered = F.crc32(F.col("doc_id").cast("string")) % every == 0
    text = F.when(F.coalesce(tampered, F.lit(False)), lower_ascii("text")).otherwise(F.col("text"))
    return manifest(documents, presented={"text": text}, span=span).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def _reduced(name: str, source: str, rounds: int) -> str:
    """SQL of the tables ``name``0, ``name``1 ...: levels of all trees of ``source`` (tree, pos, size, node), with links upward."""
    levels = [f"{name}0 AS ({source})"]
    for k in range(rounds):
        levels.append(
            f"{name}{k + 1} AS (SELECT tree, CASE WHEN size > 1 THEN pos // {ARITY} ELSE pos END AS pos, "
            f"(any_value(size) + {ARITY - 1}) // {ARITY} AS size, "
            f"CASE WHEN any_value(size) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE any_value(node) END AS node "
            f"FROM {name}{k} GROUP BY tree, size, CASE WHEN size > 1 THEN pos // {ARITY} ELSE pos END)"
        )
    return ",\n".join(levels)


def _walk(name: str, start: str, rounds: int, node: str) -> str:
    """SQL of the tables ``start``_0, ``start``_1 ...: rows climbing the levels of ``name``, with their proof and the folded node."""
    steps = []
    for k in range(rounds):
        before = f"{start}{k}"
        steps.append(f"""{start}{k + 1} AS (
SELECT w.* REPLACE (
    CASE WHEN r.size > 1 THEN w.pos // {ARITY} ELSE w.pos END AS pos,
    w.proof || CASE WHEN r.size > 1 THEN coalesce(list_aggregate(list_transform(list_filter(r.run, lambda x: x.pos <> w.pos), lambda x: x.node), 'string_agg', ''), '') ELSE '' END AS proof,
    CASE WHEN r.size > 1 THEN sha256(list_aggregate(list_transform(r.run, lambda x: CASE WHEN x.pos = w.pos THEN w.{node} ELSE x.node END), 'string_agg', '')) ELSE w.{node} END AS {node})
FROM {before} w JOIN (
    SELECT tree, size, CASE WHEN size > 1 THEN pos // {ARITY} ELSE pos END AS above, list({{'pos': pos, 'node': node}} ORDER BY pos) AS run
    FROM {name}{k} GROUP BY ALL) r
ON w.tree = r.tree AND CASE WHEN r.size > 1 THEN w.pos // {ARITY} ELSE w.pos END = r.above)""")
    return ",\n".join(steps)


def _hash_sql(text: str) -> str:
    parts = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"


#: crc32 in SQL: one bit of a byte after the other.
_CRC_SQL = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(str_split(CAST(doc_id AS VARCHAR), ''), "
    "lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
    "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
)
#: Levels that the SQL unrolls: enough for two million documents of a language and 64 languages.
_TREE_LEVELS, _CROWN_LEVELS = 7, 2
MERKLE_SQL = f"""
WITH leaves AS MATERIALIZED (
    SELECT coalesce('=' || lang, '') AS tree, doc_id, {_hash_sql("text")} AS node,
        CASE WHEN doc_id IS NOT NULL AND {_CRC_SQL} % 3 = 0 THEN
            {_hash_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
        ELSE {_hash_sql("text")} END AS shown
    FROM documents),
placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS size
    FROM leaves),
{_reduced("t", "SELECT tree, pos, size, node FROM placed", _TREE_LEVELS)},
tops AS (SELECT tree AS name, node, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS size FROM t{_TREE_LEVELS}),
{_reduced("c", "SELECT '' AS tree, pos, size, node FROM tops", _CROWN_LEVELS)},
w0 AS (SELECT tree, tree AS name, pos, doc_id, node AS leaf, shown AS folded, '' AS proof FROM placed),
{_walk("t", "w", _TREE_LEVELS, "folded")},
v0 AS (SELECT w.* REPLACE ('' AS tree, tops.pos AS pos), tops.node AS subroot FROM w{_TREE_LEVELS} w JOIN tops ON w.name = tops.name),
{_walk("c", "v", _CROWN_LEVELS, "folded")}
SELECT doc_id, leaf, subroot, c{_CROWN_LEVELS}.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = c{_CROWN_LEVELS}.node AS verified
FROM v{_CROWN_LEVELS} v, c{_CROWN_LEVELS}
"""
