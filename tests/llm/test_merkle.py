"""Merkle manifest: leaves, trees, proofs and verification against a plain version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakeproof.llm.catalog import ORACLES
from lakeproof.llm.merkle import fold, manifest, verification
from lakeproof.llm.support import table
from tests.llm.fixtures import prose
from tests.oracle import connect, differences

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, node string, tree string, at int, copy string, presented int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    values = [None if v is None else str(v) for v in row]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def climb(nodes):
    """(top, for each node its siblings by level and its place in the run)."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, where):
            first = at - at % 8
            path.append((nodes[first:first + 8], at - first))
        nodes = [h("".join(nodes[k:k + 8])) for k in range(0, len(nodes), 8)]
        where = [at // 8 for at in where]
    return nodes[0], paths


def plain(rows):
    """What the manifest must hold, with lists and loops."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    tops, found = {}, []
    for tree in order:
        trees[tree].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        tops[tree] = climb([leaf(r) for r in trees[tree]])
    root, upper = climb([tops[t][0] for t in order])
    for tree, above in zip(order, upper):
        top, paths = tops[tree]
        for row, path in zip(trees[tree], paths):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            text = row[4]
            if tampered and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node, siblings = leaf((*row[:4], text)), ""
            for run, at in path + above:
                siblings += "".join(run[:at] + run[at + 1:])
                node = h("".join(run[:at] + [node] + run[at + 1:]))
            found.append((row[0], leaf(row), top, root, h(siblings), node, node == root))
    return sorted(found, key=str)


def rows_of(counts):
    return [(k * 7 % 1000 + 1000 * n, f"s{k}", lang, len(prose(5, k)), prose(5, k).title()) for n, (lang, count) in enumerate(counts.items()) for k in range(count)]


AWKWARD = [
    (1, None, None, None, None), (1, None, None, None, None), (2, "", "", 0, ""), (2, "", "", 0, "B"), (None, "x", "de", 5, "Abc"),
    (None, None, "de", 5, "Abc"), (3, "é", "ß", 1, "É ß 中 😀 ABC"), (4, "a", "Z", 1, "A" * 1_000_000), (5, "a", "z", 1, "-"), (6, "-", "z", 1, "1:-"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "t", 1, "c", 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("rows, span", [
    (rows_of({"en": 1}), 4), (rows_of({"en": 8, "fr": 9, None: 1}), 1), (rows_of({"en": 600, "fr": 65, "de": 64}), 1),
    (rows_of({"en": 600, "fr": 2, "de": 64}), 2), (rows_of({f"l{k}": 1 + k % 3 for k in range(20)}), 1), (AWKWARD * 3, 1), (AWKWARD, 4), ([], 4),
])
def test_manifest_equals_a_plain_version(spark, rows, span):
    found = verification(frame(spark, rows), span=span)
    assert sorted(map(tuple, found.collect()), key=str) == (plain(rows) if rows else [])


def test_proofs_fold_to_the_root_and_only_for_their_leaf(spark):
    rows = rows_of({"en": 100, None: 9})
    for row in manifest(frame(spark, rows), span=1).collect():
        assert row["folded"] == row["root"] == fold(row["leaf"], row["places"], row["siblings"])
        assert fold(row["subroot"], row["places"], row["siblings"]) != row["root"]
        assert row["size"] == (100 if row["tree"] == "en" else 9) and 0 <= row["at"] < row["size"]


def test_other_fields_trees_and_changes(spark):
    rows = rows_of({"en": 30})
    found = manifest(frame(spark, rows), fields=("doc_id", "text"), tree="source", order="doc_id", presented={"text": F.lit("x")}, span=1)
    assert found.select("subroot").distinct().count() == 30 and found.where("folded = root").count() == 0


def test_a_tree_of_several_superblocks_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.1"
    assert differences(connect(sf_dir), verification(table(spark, sf_dir, "documents")), ORACLES["op13_merkle_manifest"]) == []


def test_no_text_is_shuffled(spark):
    plan = verification(frame(spark, rows_of({"en": 3})))._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
