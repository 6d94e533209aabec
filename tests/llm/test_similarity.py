"""The Jaccard join against brute force."""

import numpy as np

from lakeproof.llm import similarity
from lakeproof.llm.counttree import CountTree, count_vector
from lakeproof.llm.shingles import shingle_set
from lakeproof.llm.similarity import one_of_each_group, similarity_components
from tests.llm.fixtures import awkward, documents, edited, prose


def plain_shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = [plain_shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            close = a and b and 100 * len(a & b) >= 80 * len(a | b)
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if rows[i][0] is not None and rows[j][0] is not None and (close or same):
                top[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((d if d is not None else -1, len(s), least[find(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def found(frame):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"]) for r in frame.collect())


def sample():
    rows = list(awkward())
    for group in range(6):
        base = prose(120 + 40 * group, group)
        rows += [(100 * (group + 1) + k, edited(base, k % 7, 1000 * group + k)) for k in range(20)]
    # a chain: neighbours are close, ends are not; and a passage that many share
    chain = prose(200, 77).split()
    rows += [(900 + k, " ".join(chain[8 * k:8 * k + 100])) for k in range(10)]
    shared = prose(60, 88)
    rows += [(1000 + k, f"{prose(60, 2000 + k)} {shared}") for k in range(15)]
    rows += [(1100, "Five WORDS make one shingle"), (1101, "five words\tmake\none shingle"), (1102, "two words"), (1103, "Two  words")]
    return rows


def test_components_equal_brute_force(spark):
    rows = sample()
    assert found(similarity_components(documents(spark, rows).repartition(5))) == brute(rows)


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 4)
    rows = sample()
    assert found(similarity_components(documents(spark, rows).repartition(3))) == brute(rows)


def test_nothing_in_nothing_out(spark):
    assert similarity_components(documents(spark, [])).collect() == []
    assert one_of_each_group(documents(spark, [])).collect() == []


def test_one_row_of_each_group_stays(spark):
    rows = sample()
    least = {d for d, _, c in brute(rows) if d == c}
    kept = one_of_each_group(documents(spark, rows))
    assert kept.columns == documents(spark, []).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(least) and ids.count(None) == 1


def test_tree_finds_all_close_pairs():
    sets = [shingle_set(edited(prose(150, k // 12), k % 12, k)) for k in range(96)]
    tree = CountTree(np.stack([count_vector(s) for s in sets]), np.array([len(s) for s in sets]))
    close = {
        (i, j) for i in range(96) for j in range(i + 1, 96)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    }
    passed = {tuple(sorted(p)) for p in tree.pairs(np.arange(96))}
    assert close and close <= passed and len(passed) < 96 * 95 / 4
