"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding disguises.

Folding lower-cases, strips accents and zero-width characters, maps letters of other
scripts that look Latin, and reads digits and signs inside a word as the letters they
stand for. The lexicon is a fixed list of insults together with stems learnt from
labelled documents; each entry has a weight. Stems are learnt from and matched on text
that is folded alike but keeps its accents, which tell words apart in many languages.
A document's load is the summed weight of its matches of either kind outside exception
phrases, per hundred words; two numbers fitted on the same labelled documents turn the
load into a score between 0 and 1.
"""

from __future__ import annotations

import math
import re
import string
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.support import fit_logistic, held_out, in_slices, text_of, training_sample

# Insults that count in any corpus, whole words after folding.
INSULTS = (
    "asshole bastard bitch clown crap creep cretin cunt dickhead disgusting dumbass dumb fag filth filthy fool freak "
    "fuck fucker fucking garbage hag idiot idiotic idiots imbecile imbeciles jerk kike loser losers lunatic maggot "
    "moron moronic morons nazi nigger parasite pathetic pervert pig prick pussy retard retarded scum scumbag shit "
    "shithead slut stupid subhuman sucker swine trash twat vermin wanker whore worthless"
).split()
# Phrases in which such words are harmless.
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bag", "trash collection", "take out the trash", "class clown",
    "clown fish", "clown car", "circus clown", "garbage collection", "garbage collector", "garbage truck",
    "garbage can", "guinea pig", "guinea pigs", "pig iron", "pig farm", "control freak", "fool proof", "april fool",
    "pussy willow", "pussy cat", "worthless check", "sore loser", "dumb bell", "dumb waiter", "filth and grime",
)
# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "α": "a",
    "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʏ": "y",
}
# What digits and signs stand for inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}

_LOOK = str.maketrans(LOOKALIKES | dict.fromkeys("­​‌‍⁠﻿", None))
_STRIP = re.compile(r"[̀-ͯ]+")
# runs of letters, digits and signs that aren't letters only, and a letter beside a digit or sign in one; both take one pass
_MIXED = re.compile(r"(?<![a-z0-9@$!|])[a-z]*+[0-9@$!|][a-z0-9@$!|]*+")
_BESIDE = re.compile(r"[a-z][0-9@$!|]|(?<![0-9@$])[0-9@$]++[a-z]")
_LETTERS_DIGITS = string.ascii_lowercase + string.digits
_SUBSTITUTE = str.maketrans(SUBSTITUTES)
_SIGNS = re.compile(r"[0-9@$!|]+")
_ONE_AS_L = str.maketrans(SUBSTITUTES | {"1": "l"})
_WORD = re.compile(r"[^\W_]+")

FEATURE_SCHEMA = "doc_id bigint, label int, load double"
STEM_LENGTHS = (4, 5, 6, 7, 8)


def _undisguised(mixed: re.Match) -> str:
    """A run with its digits and signs read as letters, if a letter stands beside one and more follows. Signs at its ends stay."""
    run = mixed[0]
    beside = _BESIDE.search(run)
    end = len(run.rstrip("@$!|"))
    if beside is None or end <= beside.end():
        return run
    start = len(run[:beside.start()].rstrip(_LETTERS_DIGITS))
    return run[:start] + run[start:end].translate(_SUBSTITUTE) + run[end:]


def fold(text: str) -> str:
    """Lower case, without accents, lookalikes and substitutes. Whole numbers and final signs stay."""
    folded = text.lower()
    if not folded.isascii():
        folded = _STRIP.sub("", unicodedata.normalize("NFKD", folded.translate(_LOOK))).translate(_LOOK)
    return _MIXED.sub(_undisguised, folded)


def readings(text: str) -> list[str]:
    """Lower case without lookalikes, with accents: as written, and with substitutes read as letters, 1 as i and as l.

    All are of one length, so places in one are places in the others. Whole numbers and signs at a word's end stay.
    """
    plain = text.lower()
    if not plain.isascii():
        plain = unicodedata.normalize("NFC", unicodedata.normalize("NFKD", plain).translate(_LOOK))
    places = []
    for m in _SIGNS.finditer(plain):
        start, end = m.span()
        after = plain[end:end + 1].isalpha()
        if not (start and plain[start - 1].isalpha()):
            if not after:
                continue
            while start < end and plain[start] in "!|":
                start += 1
        while not after and start < end and plain[end - 1] in "!|":
            end -= 1
        if start < end:
            places.append((start, end))
    if not places:
        return [plain]
    read = []
    for table in (_SUBSTITUTE, _ONE_AS_L):
        pieces, at = [], 0
        for start, end in places:
            pieces += plain[at:start], plain[start:end].translate(table)
            at = end
        read.append("".join([*pieces, plain[at:]]))
    return list(dict.fromkeys([plain, *read]))


def _automaton(entries: Iterable[str]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for entry in entries:
        built.add_word(entry, entry)
    built.make_automaton()
    return built


def _is_whole(text: str, start: int, end: int) -> bool:
    """Whether the span neither begins nor ends inside a word."""
    return not (start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum())


def _outside(found: list[tuple[int, int, str]], excepted: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans that lie within no exception."""
    if not excepted:
        return found
    starts, reach = zip(*sorted((a, b) for a, b, _ in excepted))
    reach = list(accumulate(reach, max))
    return [m for m in found if not (at := bisect_right(starts, m[0])) or reach[at - 1] < m[1]]


@dataclass(frozen=True)
class Lexicon:
    """Weights by entry. ``words`` match whole folded words, ``stems`` the start of a word in one of its readings."""

    words: dict[str, float]
    stems: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 1.0
    intercept: float = 0.0

    @cached_property
    def automata(self) -> tuple[ahocorasick.Automaton, ahocorasick.Automaton | None]:
        """For the fixed words and for the stems, both with the exceptions."""
        return tuple(_automaton({*e, *self.exceptions}) if e else None for e in (self.words, self.stems))

    def matches(self, folded: str) -> list[tuple[int, int, str]]:
        """(start, end, word) of the words outside exception phrases."""
        excepted, found = [], []
        for last, entry in self.automata[0].iter(folded) if self.words else ():
            start, end = last - len(entry) + 1, last + 1
            if _is_whole(folded, start, end):
                (excepted if entry in self.exceptions else found).append((start, end, entry))
        return _outside(found, excepted)

    def stem_matches(self, read: list[str]) -> list[tuple[int, int, str]]:
        """(start, end, stem) of the words that begin with a stem in a reading, outside exception phrases; a word counts once."""
        excepted, found = [], {}
        for text in read if self.stems else ():
            for last, entry in self.automata[1].iter(text):
                start, end = last - len(entry) + 1, last + 1
                if entry in self.exceptions:
                    if _is_whole(text, start, end):
                        excepted.append((start, end, entry))
                elif not start or not text[start - 1].isalnum():
                    found[start] = (start, end, entry)
        return _outside([found[start] for start in sorted(found)], excepted)

    def load(self, text: str) -> tuple[float, int]:
        """Summed weight per hundred words, and the number of matches."""
        lowered = text.lower()
        words, stems = self.matches(fold(text)), self.stem_matches(readings(text))
        if not words and not stems:
            return 0.0, 0
        weight = sum(self.words[e] for _, _, e in words) + sum(self.stems[e] for _, _, e in stems)
        length = sum(1 for _ in _WORD.finditer(lowered))
        return 100.0 * weight / max(length, 20), len(words) + len(stems)

    def score(self, load: float) -> float:
        return 1.0 / (1.0 + math.exp(-(self.intercept + self.slope * math.log1p(load))))


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, toxic, clean): in how many documents of either kind a word starts with the stem."""
    for batch in in_slices(batches):
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
            words = {w for read in readings(text) for w in _WORD.findall(read)}.difference(INSULTS)
            counts[label].update({word[:n] for word in words for n in STEM_LENGTHS if len(word) >= n})
        stems = list({**counts[0], **counts[1]})
        yield pa.RecordBatch.from_pydict({
            "stem": pa.array(stems, pa.string()),
            "toxic": pa.array([counts[1][s] for s in stems], pa.int64()),
            "clean": pa.array([counts[0][s] for s in stems], pa.int64()),
        })


def learn_lexicon(
    documents: DataFrame, labels: DataFrame, per_class: int = 2000, modulus: int = 3, remainder: int = 1,
    least_documents: int = 10, least_odds: float = 3.5, most_entries: int = 500,
) -> Lexicon:
    """The fixed insults and learnt stems with weights, and the fitted score.

    Learns from at most ``per_class`` documents of each class. A stem enters when at least
    ``least_documents`` toxic documents have it and its log odds are ``least_odds`` or more; the
    ``most_entries`` best are kept. Without labels of both classes the fixed list stands alone.

    Null text counts as empty. Null labels and null ids teach nothing, conflicting labels of one
    document count as 1, repeated rows of a document as often as they are there.
    """
    sample = training_sample(documents, labels, "toxic", held_out(modulus, remainder), per_class)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    words = dict.fromkeys(INSULTS, 2.0)
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon(words, {}, slope=2.0, intercept=-0.5)
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))
    learnt = (
        sample.mapInArrow(_stem_counts, "stem string, toxic bigint, clean bigint")
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= least_documents).withColumn("odds", odds).where(F.col("odds") >= least_odds)
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "stem").limit(most_entries).collect()
    )
    stems = {r["stem"]: float(r["odds"]) for r in learnt}
    # a longer stem says nothing new where a shorter one is in the lexicon
    stems = {s: w for s, w in stems.items() if not any(s[:n] in stems for n in STEM_LENGTHS if n < len(s))}
    lexicon = Lexicon(words, stems)
    loads = sample.mapInArrow(_loads(lexicon), FEATURE_SCHEMA).select("label", "load").toPandas()
    slope, intercept = fit_logistic(np.log1p(loads["load"].to_numpy()), loads["label"].to_numpy(dtype=float))
    return Lexicon(words, stems, slope=slope, intercept=intercept)


def _loads(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"],
                "label": batch["label"],
                "load": pa.array([lexicon.load(t)[0] for t in batch["text"].to_pylist()], pa.float64()),
            })

    return run


def score_toxicity(documents: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """The documents with ``toxic_matches``, ``toxic_load``, ``toxic_score`` and ``toxic``, one row for each row.

    Null text counts as empty and has no match. Repeated rows are scored each. Columns of
    these names that the documents have already are replaced.
    """
    fresh = ("toxic_matches", "toxic_load", "toxic_score", "toxic")
    kept = documents.select(*[F.col(f"`{c}`") for c in documents.columns if c not in fresh])
    wide = kept.withColumn("toxic_matches", F.lit(0).cast("bigint")).withColumn("toxic_load", F.lit(0.0))
    wide = wide.withColumn("toxic_score", F.lit(0.0)).withColumn("toxic", F.lit(False)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [lexicon.load(t or "") for t in batch["text"].to_pylist()]
            scores = [lexicon.score(load) for load, _ in found]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([n for _, n in found], pa.int64()),
                pa.array([load for load, _ in found], pa.float64()), pa.array(scores, pa.float64()),
                pa.array([s >= threshold for s in scores], pa.bool_()),
            ], [*batch.schema.names, *fresh])

    return kept.mapInArrow(run, wide)


def without_toxic(documents: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """The rows that score below the threshold, with all their columns, of any names. A null text stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            clean = [lexicon.score(lexicon.load(t or "")[0]) < threshold for t in batch["text"].to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def toxicity_report(documents: DataFrame, labels: DataFrame, **options: float) -> DataFrame:
    """(doc_id, held_out, score, predicted, matches) of every row of the documents.

    Null and empty text has no match and the lowest score. Repeated rows are scored each, a null id
    is held out, an empty table has no rows; other columns are not read. Labels: see ``learn_lexicon``.
    A long text takes time in proportion to its length, whatever runs of letters or digits it holds.
    """
    scored = score_toxicity(documents.select("doc_id", text_of()), learn_lexicon(documents, labels, **options))
    return scored.select(
        "doc_id", held_out(3, 1).alias("held_out"), F.col("toxic_score").alias("score"),
        F.col("toxic").cast("int").alias("predicted"), F.col("toxic_matches").alias("matches"),
    )
