"""Contamination against a plain search."""

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from lakeproof.llm import decontamination, support
from lakeproof.llm.decontamination import contamination_by_version, find_contamination, without_contaminated
from tests.llm.fixtures import awkward, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    found = []
    for doc_id, text in rows:
        w, hit, named = plain(text), set(), set()
        for item, passage in items:
            q = plain(passage)
            n = min(len(q), 10)
            windows = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    named |= {str(item)} - {"None"}
        listed = ",".join(sorted(named))
        found.append((str(doc_id), len(w), len(hit), len(named), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(found)


def sample():
    passage, other = prose(30, 301), prose(14, 302)
    short = "just four rare words"
    items = [(2, passage), (10, other), (10, other), (11, short), (12, passage[:60]), (13, None), (14, ""), (None, prose(12, 303)), (15, "ß É!")]
    rows = awkward() + [
        (20, f"{prose(40, 1)} {passage.upper()} {prose(9, 2)} {other}"), (21, f"x {short}, {short} y"), (22, passage[:50]),
        (23, prose(12, 303)), (24, f"{passage} {passage}"), (24, "other text under the same id"), (25, "das ß é hier"),
        (26, passage.replace(" ", " - ")),
    ]
    return rows, items


def bench(spark, items):
    return spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, version string")


def test_contamination_equals_plain_search(spark):
    rows, items = sample()
    found = find_contamination(documents(spark, rows).repartition(4), bench(spark, items)).collect()
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in found) == brute(rows, items)


def test_empty_tables(spark):
    rows, items = sample()
    clean = find_contamination(documents(spark, rows), bench(spark, [])).collect()
    assert len(clean) == len(rows) and not any(r["contaminated"] for r in clean)
    assert find_contamination(documents(spark, []), bench(spark, items)).collect() == []


def test_only_clean_rows_stay(spark):
    rows, items = sample()
    kept = without_contaminated(documents(spark, rows), bench(spark, items))
    assert kept.columns == documents(spark, []).columns
    clean = sorted(r[0] for r in brute(rows, items) if not r[-1])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == clean
    assert "_lit" not in kept.columns


def near_brute(rows, items):
    """For every row, how often a window's rarest term has all others within nine words."""
    windows = set()
    for _, passage in items:
        q = plain(passage)
        windows |= {tuple(q[i:i + 10]) for i in range(max(len(q) - 9, 1))} if q else set()
    words = [plain(text) for _, text in rows]
    times = Counter(w for ws in words for w in ws)
    rarest = [(w, min(set(w), key=lambda t: (times[t], t, w.index(t)))) for w in windows if all(times[t] for t in w)]
    return sorted((str(key), sum(w[p] == rare and set(window) <= set(w[max(p - 9, 0):p + 10]) for window, rare in rarest for p in range(len(w)))) for (key, _), w in zip(rows, words))


def test_proximity_equals_a_plain_search(spark):
    rows = [
        (1, "red green filler blue"), (2, "blue a b c d e f g h i j k l m n o red green"), (3, "green blue"), (4, "blue red x x red green green"),
        (5, " ".join(prose(30, 301).split()[::-1])), (6, prose(30, 301).replace(" ", " x ")), (7, prose(30, 301)), (8, "a b a"), (9, "b a a b a b"),
    ]
    items = [(1, "red green blue"), (2, prose(30, 301)), (3, "a b a"), (4, "solo"), (5, "a")]
    found = contamination_by_version(documents(spark, rows).repartition(3), bench(spark, items)).collect()
    assert sorted((str(r["doc_id"]), r["n_near"]) for r in found) == near_brute(rows, items)
    rows, items = sample()
    found = contamination_by_version(documents(spark, rows), bench(spark, items)).collect()
    assert sorted((str(r["doc_id"]), r["n_near"]) for r in found) == near_brute(rows, items)


def test_columns_named_like_helpers(spark):
    rows, items = sample()
    frame = documents(spark, rows).select("*", *[F.lit(42).alias(c) for c in ("hit_id", "hit_version", "row", "term", "position", "_hit_id")])
    kept = without_contaminated(frame, bench(spark, items))
    assert kept.columns == frame.columns and kept.where("hit_id <> 42 OR hit_version <> 42 OR _hit_id <> 42").count() == 0
    assert kept.count() == without_contaminated(documents(spark, rows), bench(spark, items)).count()


def test_no_text_is_shuffled(spark, monkeypatch):
    """Also where terms are too many to broadcast, rows of a posting's size are all that moves."""
    monkeypatch.setattr(support, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(support.sized_join, "__defaults__", ("inner", 0))
    rows, items = sample()
    plans = []
    write = decontamination.staged

    def seen(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(frame, label)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(decontamination, "staged", seen)
    try:
        found = contamination_by_version(documents(spark, rows), bench(spark, items))
        columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        assert sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in found.collect()) == brute(rows, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = [plan.split("Exchange")[1:] for plan in plans]
    assert any(below) and "Broadcast" not in "".join(plans)
    posted = next(plan for plan in plans if "posexplode" in plan)
    assert "words#" not in posted.split("Generate posexplode")[0] and "text#" not in posted.split("Generate posexplode")[0]


def test_a_text_of_a_million_characters(spark):
    passage = prose(30, 301)
    rows = [(1, f"{prose(60_000, 5)} {passage} {prose(60_000, 6)}"), (2, "x" * 1_000_000), (3, "rare " * 200_000)]
    items = [(1, passage), (2, "rare rare rare rare")]
    found = find_contamination(documents(spark, rows), bench(spark, items)).collect()
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in found) == brute(rows, items)


def test_native(spark):
    rows, items = sample()
    plan = contamination_by_version(documents(spark, rows), bench(spark, items))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
