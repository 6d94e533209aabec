"""Toxicity and quality: folding, exact marginals, held-out accuracy, awkward rows."""

import itertools
import math
import random
import re
import time

import numpy as np
import pytest

from lakeproof.llm.quality import FEATURES, LineField, fit_field, learn_field, line_features, lines_of, quality_report
from lakeproof.llm.support import held_out, table
from lakeproof.llm.toxicity import (
    EXCEPTIONS, INSULTS, SUBSTITUTES, Lexicon, fold, learn_lexicon, readings, score_toxicity, toxicity_report, without_toxic,
)
from tests.llm.fixtures import awkward, documents, prose

MIDDLE_DIR = "/root/testdata/sf0.1"
FIXED = Lexicon(dict.fromkeys(INSULTS, 2.0), {"grml": 3.0}, slope=2.0, intercept=-0.5)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def area_under_curve(positive, negative):
    positive, negative = np.array(positive)[:, None], np.array(negative)[None, :]
    return (positive > negative).mean() + 0.5 * (positive == negative).mean()


@pytest.mark.parametrize("disguised", ["1d10t", "ＩＤＩＯＴ", "іdіоt", "ïdíöt", "id​iot", "id!ot", "idi0t"])
def test_disguises_fold_away(disguised):
    assert fold(disguised).strip("!") == "idiot" and FIXED.load(f"you {disguised} there")[1] == 1


@pytest.mark.parametrize("text, matches", [
    ("0" * 1_000_000, 0), ("a" * 1_000_000, 0), ("a1" * 500_000, 0), ("1!" * 500_000 + "a", 0), ("idiot " * 100_000, 200_000), ("trash can " * 60_000, 0),
])
def test_long_texts_take_seconds(text, matches):
    lexicon = Lexicon(dict.fromkeys(INSULTS, 2.0), {"idio": 3.0})
    started = time.process_time()
    assert lexicon.load(text)[1] == matches
    assert time.process_time() - started < 30


def test_folding_equals_a_plain_pattern():
    """The one pass over runs against a pattern that says the same and takes cubic time."""
    plain = re.compile(r"[a-z0-9]*(?:[a-z][0-9@$!|]|[0-9@$]+[a-z])[a-z0-9@$!|]*[a-z0-9]")
    draw = random.Random(1)
    for _ in range(30_000):
        text = "".join(draw.choice("ab1@!| x4$") for _ in range(draw.randint(0, 14)))
        assert fold(text) == plain.sub(lambda m: m[0].translate(str.maketrans(SUBSTITUTES)), text)


def test_matches_equal_looking_everywhere():
    draw = random.Random(2)
    words = ["idiot", "trash", "can", "clown", "class", "car", "pig", "guinea", "iron", "x", "dumb", "bell", "garbage", "truck", "trashy"]
    for _ in range(300):
        text = " ".join(draw.choice(words) for _ in range(draw.randint(0, 12)))
        found = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[a-z]+", text) if m[0] in INSULTS and not (
            any(f" {text} "[at:at + len(e) + 2] == f" {e} " and at <= m.start() and m.end() <= at + len(e) for e in EXCEPTIONS for at in range(len(text)))
        )]
        assert sorted(FIXED.matches(text)) == found


def test_words_numbers_and_exceptions():
    assert fold("In 2019, 100 men!") == "in 2019, 100 men!"
    assert FIXED.load("put it into the trash can, class clown")[1] == 0
    assert FIXED.load("trash talk by a clown")[1] == 2
    assert FIXED.load("idiots idiotic scumbagger")[1] == 2
    assert FIXED.load("Grmlin and angrml")[1] == 1
    assert all(fold(e) == e for e in (*EXCEPTIONS, *INSULTS))
    assert FIXED.load("idiot " + "word " * 999)[0] < FIXED.load("idiot " + "word " * 99)[0]


@pytest.mark.parametrize("stem, disguised", [
    ("gromel", "gr0m3l"), ("gromel", "grоmеl"), ("gromel", "gro​mel"), ("gromel", "Ｇromel"), ("gromel", "grome1s"), ("gromel", "gr0me1"),
    ("grame", "gr@m3"), ("grimo", "gr1m0"), ("grüme", "grüm3"), ("grüme", "gru\u0308me"), (readings("дурак")[0], "дур@к"), ("covid19", "covid19"),
])
def test_learnt_stems_see_through_disguises(stem, disguised):
    lexicon = Lexicon(dict.fromkeys(INSULTS, 2.0), {stem: 3.0})
    assert lexicon.load(f"you {disguised} there!")[1] == 1


def test_exceptions_hold_for_learnt_stems():
    lexicon = Lexicon(dict.fromkeys(INSULTS, 2.0), {"garbag": 3.0, "collec": 3.0})
    assert lexicon.load("the garbage collector, a g@rbage c0llector")[1] == 0
    assert lexicon.load("garbagy collectors")[1] == 2


def test_disguised_words_are_learnt(spark):
    rows = [(k, f"{prose(20, k)} {('gr0mel', 'grоmel', 'gromel')[k % 3] if k % 2 else ''} {prose(20, -k)}") for k in range(120)]
    known = [(k, 1, k % 2) for k in range(120)]
    lexicon = learn_lexicon(documents(spark, rows), labels(spark, known), least_documents=30)
    assert "grom" in lexicon.stems and lexicon.load("a grоm3l")[1] == 1


def test_awkward_rows_are_scored(spark):
    frame = documents(spark, awkward() + [(50, "you stupid idiot"), (51, prose(80, 1))]).withColumnRenamed("score", "toxic")
    found = score_toxicity(frame, FIXED)
    assert sorted(found.columns) == sorted({*frame.columns, "toxic_matches", "toxic_load", "toxic_score"})
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(awkward()) + 2 and by_id[50]["toxic"] and not by_id[51]["toxic"] and by_id[1]["toxic_matches"] == 0
    kept = without_toxic(frame, FIXED)
    assert kept.columns == frame.columns and kept.count() == found.count() - 1
    assert without_toxic(documents(spark, []), FIXED).collect() == []


@pytest.mark.parametrize("report", [toxicity_report, quality_report])
def test_reports_without_usable_labels(spark, report):
    rows = awkward() + [(k, prose(30, k)) for k in range(100, 120)]
    for given in ([], [(k, None, None) for k in range(100, 120)], [(None, 1, 1)], [(k, 1, 1) for k in range(100, 120)]):
        found = report(documents(spark, rows), labels(spark, given)).collect()
        assert len(found) == len(rows)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in found)
    assert report(documents(spark, []), labels(spark, [])).collect() == []


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(4)
    field = LineField(draw.standard_normal(FEATURES) / 5, draw.standard_normal((2, 2)))
    for count in (1, 2, 5):
        x = draw.standard_normal((count, FEATURES))
        odds, weight = x @ field.weights, {}
        for path in itertools.product((0, 1), repeat=count):
            total = sum(o for o, y in zip(odds, path) if y) + sum(field.steps[a, b] for a, b in zip(path, path[1:]))
            weight[path] = math.exp(total)
        expected = [sum(w for p, w in weight.items() if p[k]) / sum(weight.values()) for k in range(count)]
        assert np.allclose(field.marginals(x), expected)


def test_neighbours_and_lengths():
    features, lengths = line_features([lines_of("One two two.\n\nAB cd!!! x"), [], lines_of("z")])
    assert features.shape == (3, FEATURES) and lengths.tolist() == [12, 10, 1]
    assert features[0, 17:34].tolist() == [0] * 17 and features[0, 34:51].tolist() == features[1, :17].tolist()
    assert features[2, 51:].tolist() == [0, 0, 1]


def test_fit_tells_lines_apart():
    draw = np.random.default_rng(5)
    truth = [int(draw.integers(2)) for _ in range(80)]
    sequences = [np.hstack([draw.standard_normal((4, FEATURES - 1)) + 0.5 * (2 * y - 1), np.ones((4, 1))]).astype(np.float32) for y in truth]
    field = fit_field(sequences, truth, rounds=60)
    assert np.mean([(field.marginals(s).mean() > 0.5) == y for s, y in zip(sequences, truth)]) > 0.95


def test_lines_beyond_the_first_hundred_are_learnt_from(spark):
    good = [f"{prose(9, k)}." for k in range(100)]
    texts = {1: "\n".join(good * 2), 0: "\n".join(good + ["$$ 00 ## 11 %%"] * 100)}
    rows = [(k, texts[k % 2]) for k in range(40)]
    field = learn_field(documents(spark, rows), labels(spark, [(k, k % 2, 0) for k in range(40)]), lines_per_class=1000)
    assert field.qualities([texts[1]])[0] > 0.7 > 0.3 > field.qualities([texts[0]])[0]


@pytest.mark.parametrize("report, label, least", [(toxicity_report, "toxic", 0.9), (quality_report, "quality", 0.98)])
def test_held_out_accuracy(spark, report, label, least):
    docs, known = table(spark, MIDDLE_DIR, "documents"), table(spark, MIDDLE_DIR, "labels")
    rows = report(docs, known).join(known, "doc_id").where("held_out").select("score", "predicted", label).collect()
    positive, negative = [[r["score"] for r in rows if r[label] == y] for y in (1, 0)]
    assert area_under_curve(positive, negative) > least
    assert np.mean([r["predicted"] == r[label] for r in rows]) > 0.95


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, known = table(spark, MIDDLE_DIR, "documents").limit(1500), table(spark, MIDDLE_DIR, "labels")
    flipped = known.withColumn("toxic", (1 - known["toxic"]) * held_out(3, 1).cast("int") + known["toxic"] * (~held_out(3, 1)).cast("int"))
    assert sorted(toxicity_report(docs, known).collect()) == sorted(toxicity_report(docs, flipped).collect())
