"""Languages of words: spans, exact marginals, gradients, code-switched text, held-out accuracy."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeproof.llm import languages
from lakeproof.llm.languages import (
    BUCKETS, LanguageField, Words, chain, code_points, fit_languages, label_languages, language_report, learn_languages, word_spans,
)
from lakeproof.llm.support import held_out, table
from tests.llm.fixtures import awkward

MIDDLE_DIR = "/root/testdata/sf0.1"
SYLLABLES = {"xx": "ba de fi go lu".split(), "yy": "kra pst vli drü zen".split(), "zz": "ñao eiu çoo ua ié".split()}


def text(lang, count, seed):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 4))) for _ in range(count))


def corpus(spark, rows):
    schema = "doc_id bigint, text string, lang string, source string, name string, drawn string, size string, score string, place int"
    return spark.createDataFrame([(*row, "s", "n", "d", "z", "x", 1) for row in rows], schema)


def small(spark):
    return corpus(spark, [(k, text(lang, 60, k), lang) for k, lang in enumerate(itertools.islice(itertools.cycle(SYLLABLES), 90))])


@pytest.fixture(scope="module")
def field(spark):
    return learn_languages(small(spark), held_out(4, 2))


def test_words_are_runs_of_letters():
    found = word_spans(code_points("Ab, c1d é́x ́ 中文😀z"))
    assert found.tolist() == [[0, 2], [4, 5], [6, 7], [8, 11], [14, 16], [17, 18]]
    assert len(code_points("İSTANBUL ẞ")) == 10 and word_spans(code_points("12 !? ́")).tolist() == []


def test_grams_are_those_of_each_word(monkeypatch):
    words = Words.of(["ab ab abcde", "", "x ab"])
    assert words.text.tolist() == [0, 0, 0, 2, 2]
    buckets, home = words.grams(words.spans)
    of = [sorted(buckets[home == k]) for k in range(5)]
    assert of[0] == of[1] == of[4] and len(of[0]) == 2 + 3 + 2 + 1 and len(of[2]) == 5 + 6 + 5 + 4 and len(of[3]) == 1 + 2 + 1
    hashes = words.hashes(slice(None))
    assert hashes[0] == hashes[1] == hashes[4] and len(set(hashes.tolist())) == 3
    monkeypatch.setattr(languages, "CHARS_AT_ONCE", 4)
    assert [(p.start, p.stop) for p in words.pieces()] == [(0, 2), (2, 5)]


@pytest.mark.parametrize("row", [1, 2, 3, 64])
def test_marginals_equal_enumeration(monkeypatch, row):
    monkeypatch.setattr(languages, "ROW", row)
    draw = np.random.default_rng(4)
    size = 3
    field = LanguageField(tuple("abc"), np.zeros((size, BUCKETS)), np.zeros(0, np.uint64), np.zeros((0, size)), 0.0, np.zeros(size), draw.standard_normal((size, size)))
    evidence, of = draw.standard_normal((9, size)), np.array([0, 0, 0, 0, 2, 3, 3, 3, 3])
    found = field.marginals(evidence, of)
    for text_number in (0, 2, 3):
        at = np.flatnonzero(of == text_number)
        expected = np.zeros((len(at), size))
        for path in itertools.product(range(size), repeat=len(at)):
            weight = np.exp(sum(evidence[p, y] for p, y in zip(at, path)) + sum(field.steps[a, b] for a, b in zip(path, path[1:])))
            for k, y in enumerate(path):
                expected[k, y] += weight
        assert np.allclose(found[at], expected / expected.sum(axis=1, keepdims=True))


def test_long_chains_stay_finite():
    emit = np.full((100_000, 3), np.exp(-languages.DEEPEST))
    emit[:, 1] = 1
    found = chain(emit, np.r_[True, np.zeros(99_999, bool)], np.exp(np.array([[2.0, -9, -9], [-9, 2, -9], [-9, -9, 2]])))
    assert np.isfinite(found).all() and (found.argmax(axis=1) == 1).all()


def test_switches_are_found(spark, field):
    assert field.names == ("xx", "yy", "zz") and (np.diag(field.steps) > field.steps.max(axis=1) - 1e-9).all()
    parts = [("xx", text("xx", 30, -1)), ("zz", text("zz", 20, -2)), ("yy", text("yy", 25, -3)), ("xx", text("xx", 9, -4))]
    mixed = " 12! ".join(p for _, p in parts)
    row = label_languages(corpus(spark, [(1, mixed, None)]), field).first()
    assert row["lang_pred"] == "xx" and 0.3 < row["score"] < 0.6
    right = 0
    for run in row["runs"]:
        for lang, part in parts:
            start = mixed.index(part)
            right += (run["lang"] == lang) * max(0, min(run["end"], start + len(part)) - max(run["start"], start))
    assert right / sum(len(p) for _, p in parts) > 0.97


def test_neighbours_decide_about_a_doubtful_word(field):
    """A word of no language takes that of its neighbours: the transitions are learnt."""
    for lang in SYLLABLES:
        words = Words.of([f"{text(lang, 10, -7)} q {text(lang, 10, -8)}"])
        marginals = field.label(words)
        at = int(np.flatnonzero(words.lengths() == 1)[0])
        assert field.names[marginals[at].argmax()] == lang


def test_awkward_rows_are_labelled(spark, field):
    rows = [(k, t, None) for k, t in awkward()] + [(70, "12 34 !?", "xx"), (71, "́", None), (72, text("yy", 3, 1), None)]
    found = label_languages(corpus(spark, rows), field).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert all((by_id[k]["lang_pred"], by_id[k]["score"], by_id[k]["runs"]) == ("und", 0.0, []) for k in (1, 2, 3, 70, 71))
    assert by_id[72]["lang_pred"] == "yy" and all(0 <= r["score"] <= 1 for r in found)
    assert label_languages(corpus(spark, []), field).collect() == []


@pytest.mark.parametrize("rows", [[], [(1, "abc", None)], [(1, None, "xx")], [(1, "12", "xx"), (None, "abc", "yy")], [(5, "abc", "xx")] * 3])
def test_reports_without_usable_languages(spark, rows):
    found = language_report(corpus(spark, rows)).collect()
    assert len(found) == len(rows) and all(r["lang_pred"] in ("und", "xx") and 0 <= r["score"] <= 1 for r in found)


def test_a_text_of_a_million_characters(spark, field):
    long = f"{text('xx', 100_000, 1)} {'kra' * 300_000} {text('xx', 100_000, 2)}"
    row = label_languages(corpus(spark, [(1, long, None), (2, "ba" * 500_000, None)]), field, runs=False).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in row] == ["xx", "xx"] and row[0]["score"] > 0.5


def test_longer_documents_and_more_languages_than_the_bounds(spark):
    docs = corpus(spark, [(k, text(lang, n, k), lang) for k, (lang, n) in enumerate([("xx", 50), ("xx", 50), ("yy", 50), ("zz", 50), ("xx", 5000), ("yy", 60)])])
    field = learn_languages(docs, F.lit(False), characters=1000, languages=2)
    assert field.names == ("xx", "yy")


def test_fit_is_the_likelihoods_slope():
    """After many steps the expected counts of steps equal the given ones, up to the ridge."""
    spans = [text(lang, 4, k) for k, lang in enumerate(["xx", "yy"] * 20)]
    field = fit_languages(("xx", "yy"), spans, [0, 1] * 20, rounds=200, ridge=0.0)
    words = Words.of([" ".join(spans)])
    truth = np.repeat([0, 1] * 20, 4)
    assert (field.label(words).argmax(axis=1) == truth).mean() == 1


def test_held_out_accuracy(spark):
    docs = table(spark, MIDDLE_DIR, "documents")
    rows = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 2000 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.995


def test_languages_of_held_out_rows_are_not_used(spark):
    docs = small(spark)
    hidden = docs.withColumn("lang", F.when(held_out(4, 2), F.lit("qq")).otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    assert sorted(language_report(docs).collect()) == sorted(language_report(hidden).collect())
