"""Languages of words in code-switched text, by a linear-chain conditional random field.

A word is a run of letters. Its affixes and inner n-grams (up to four letters, with the word's ends
as letters of their own) and its entry in a lexicon of the sampled documents say how well it fits
each language; learned transitions say which language follows which. Forward-backward gives every
word the probability of each language; a document's language has the most letters by these.

The field learns from sequences that switch: spans of sampled documents of all languages follow one
another, so that transitions learn both to stay and to go. Forward-backward runs over all words of
many documents at once: the words are cut into rows of equal length, the rows advance together, and
one pass over the rows' ends joins them. A long document costs no more than many short ones.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeproof.llm.support import held_out, in_slices, text_of

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
#: Words of a row in forward-backward.
ROW = 64
#: Characters that a task turns into features at a time, beyond one word.
CHARS_AT_ONCE = 1_000_000
#: Steps of forward-backward between two scalings.
SCALED = 8
#: How far a language's evidence from one word may lie below the best one's, as a logarithm.
DEEPEST = 20.0
_POINTS = 0x40000
_LETTER, _MARK = 1, 2
_MULTIPLIERS = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _kinds() -> np.ndarray:
    """Whether a code point is a letter, or a mark that belongs to one."""
    first = {"L": _LETTER, "M": _MARK}
    return np.fromiter((first.get(unicodedata.category(chr(p))[0], 0) for p in range(_POINTS)), np.uint8, _POINTS)


_KIND = _kinds()


def code_points(text: str) -> np.ndarray:
    """The code points of a text in lower case, one for each of its own."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")


def word_spans(points: np.ndarray) -> np.ndarray:
    """(start, end) of every word: a run of letters and marks that holds a letter."""
    kind = np.where(points < _POINTS, _KIND[np.minimum(points, _POINTS - 1)], 0)
    inked = np.r_[False, kind > 0, False]
    edges = np.flatnonzero(inked[1:] != inked[:-1]).reshape(-1, 2)
    letters = np.r_[0, np.cumsum(kind == _LETTER)]
    return edges[letters[edges[:, 1]] > letters[edges[:, 0]]]


@dataclass
class Words:
    """Words of some texts: their spans in ``points`` and the text each is from."""

    points: np.ndarray
    spans: np.ndarray
    text: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        points, spans, text, at = [], [], [], 0
        for number, value in enumerate(texts):
            own = code_points(value)
            found = word_spans(own)
            points.append(own)
            spans.append(found + at)
            text.append(np.full(len(found), number))
            at += len(own)
        if not points:
            return cls(np.zeros(0, np.uint32), np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
        return cls(np.concatenate(points), np.concatenate(spans), np.concatenate(text))

    def lengths(self) -> np.ndarray:
        return self.spans[:, 1] - self.spans[:, 0]

    def pieces(self) -> Iterator[slice]:
        """Slices of the words, of about ``CHARS_AT_ONCE`` characters or one word."""
        if not len(self.spans):
            return
        share = (np.cumsum(self.lengths()) - 1) // CHARS_AT_ONCE
        starts = np.r_[0, np.flatnonzero(np.diff(share)) + 1, len(share)]
        yield from (slice(a, b) for a, b in zip(starts, starts[1:]))

    def hashes(self, part: slice) -> np.ndarray:
        """A 64-bit hash of each of some words."""
        spans = self.spans[part]
        sizes = spans[:, 1] - spans[:, 0]
        starts = np.cumsum(sizes) - sizes
        inside = np.arange(starts[-1] + sizes[-1]) - np.repeat(starts, sizes)
        letters = self.points[inside + np.repeat(spans[:, 0], sizes)].astype(np.uint64) + np.uint64(1)
        factors = _MULTIPLIERS[inside & 255]
        if sizes.max() > 256:
            factors = factors * ((inside >> 8).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        return np.add.reduceat(letters * factors, starts)

    def grams(self, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, number of the word) of every n-gram of some words."""
        sizes = spans[:, 1] - spans[:, 0] + 2
        ends = np.cumsum(sizes)
        home = np.repeat(np.arange(len(spans)), sizes)
        letters = np.zeros(ends[-1], np.uint32)
        inked = np.ones(ends[-1], bool)
        inked[ends - sizes] = inked[ends - 1] = False
        letters[inked] = self.points[(np.arange(ends[-1]) + (spans[:, 0] - 1 - (ends - sizes))[home])[inked]] + np.uint32(1)
        buckets, words = [], []
        rolled = letters * np.uint32(0x85EBCA6B)
        hashed = np.zeros(len(letters), np.uint32)
        for order in ORDERS:
            if len(letters) < order:
                break
            count = len(letters) - order + 1
            hashed = (hashed[:count] ^ rolled[order - 1:]) * np.uint32(0xC2B2AE35) + np.uint32(order)
            # within one word, and not only its end
            kept = np.flatnonzero(home[order - 1:] == home[:count] if order > 1 else inked)
            buckets.append(((hashed[kept] ^ (hashed[kept] >> np.uint32(15))) % np.uint32(BUCKETS)).astype(np.int32))
            words.append(home[kept])
        return np.concatenate(buckets), np.concatenate(words)


def chain(emit: np.ndarray, first: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Forward probabilities of every place of some chains that follow one another, up to a factor for each place.

    ``emit`` is positive, ``first`` marks where a chain begins, ``steps`` are weights from a label to the next.
    """
    count, labels = emit.shape
    rows = -(-count // ROW)
    padded = np.ones((rows * ROW, labels))
    padded[:count] = emit
    begins = np.zeros(rows * ROW, bool)
    begins[:count] = first
    padded, begins = padded.reshape(rows, ROW, labels), begins.reshape(rows, ROW)
    # what a row makes of what comes in: a product of matrices, in which a begin forgets the past
    through = np.broadcast_to(np.eye(labels), (rows, labels, labels)).copy()
    for k in range(ROW):
        moved = through @ steps
        new = np.flatnonzero(begins[:, k])
        moved[new] = through[new].sum(axis=2, keepdims=True)
        through = moved * padded[:, k, None, :]
        if k % SCALED == SCALED - 1:
            through /= through.sum(axis=(1, 2), keepdims=True)
    entry = np.full((rows, labels), 1 / labels)
    for r in range(1, rows):
        state = entry[r - 1] @ through[r - 1]
        entry[r] = state / state.sum()
    found = np.empty_like(padded)
    state = entry
    for k in range(ROW):
        state = state @ steps
        state[begins[:, k]] = 1.0
        state *= padded[:, k]
        if k % SCALED == SCALED - 1:
            state /= state.sum(axis=1, keepdims=True)
        found[:, k] = state
    return found.reshape(-1, labels)[:count]


@dataclass(frozen=True)
class LanguageField:
    """Weights of n-grams for every language, of the lexicon, of languages and of steps between them."""

    names: tuple[str, ...]
    grams: np.ndarray
    lexicon: np.ndarray
    shares: np.ndarray
    trust: float
    bias: np.ndarray
    steps: np.ndarray

    def evidence(self, words: Words, part: slice) -> np.ndarray:
        """The logarithm of how well some words fit each language."""
        distinct, at, back = np.unique(words.hashes(part), return_index=True, return_inverse=True)
        buckets, home = words.grams(words.spans[part][at])
        found = np.stack([np.bincount(home, weights=w[buckets], minlength=len(at)) for w in self.grams], axis=1)
        return (found + self.trust * self.known(distinct) + self.bias)[back]

    def known(self, whole: np.ndarray) -> np.ndarray:
        """Log shares of the languages for words of the lexicon, 0 for others."""
        at = np.minimum(np.searchsorted(self.lexicon, whole), max(len(self.lexicon) - 1, 0))
        if not len(self.lexicon):
            return np.zeros((len(whole), len(self.names)))
        return np.where((self.lexicon[at] == whole)[:, None], self.shares[at], 0.0)

    def marginals(self, evidence: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The probability of each language for every word, by forward-backward over each text."""
        emit = np.exp(np.maximum(evidence - evidence.max(axis=1, keepdims=True), -DEEPEST))
        change = text[1:] != text[:-1]
        forward = chain(emit, np.r_[True, change], np.exp(self.steps))
        backward = chain(emit[::-1], np.r_[True, change[::-1]], np.exp(self.steps.T))[::-1]
        joint = forward * backward / emit
        return joint / joint.sum(axis=1, keepdims=True)

    def label(self, words: Words) -> np.ndarray:
        """The probability of each language for every word."""
        if not len(words.spans) or not self.names:
            return np.zeros((len(words.spans), len(self.names)))
        return self.marginals(np.concatenate([self.evidence(words, part) for part in words.pieces()]), words.text)


def _weighed(words: Words, marginals: np.ndarray, texts: int) -> np.ndarray:
    """For every text and language, the letters that are of it."""
    weights = words.lengths()[:, None] * marginals
    return np.stack([np.bincount(words.text, weights=w, minlength=texts) for w in weights.T], axis=1) if marginals.shape[1] else np.zeros((texts, 0))


def fit_languages(
    names: tuple[str, ...], spans: list[str], labels: list[int], rounds: int = 30, rate: float = 0.15, ridge: float = 1e-4, least: int = 3,
) -> LanguageField:
    """Maximum likelihood by gradient steps with momentum, over one sequence of spans in their order.

    The lexicon holds words that occur ``least`` times; each word's share of languages leaves one
    occurrence out, so that the field learns how far to trust it where it is new.
    """
    words = Words.of(spans)
    buckets, home = words.grams(words.spans)
    whole = words.hashes(slice(None))
    truth = np.array(labels)[words.text]
    size = len(names)
    gold = np.eye(size)[truth]
    lexicon, place, times = np.unique(whole, return_inverse=True, return_counts=True)
    counts = np.stack([np.bincount(place, weights=g, minlength=len(lexicon)) for g in gold.T], axis=1)
    kept = times >= least

    def share(of: np.ndarray) -> np.ndarray:
        return np.log((of + 0.1) / (of.sum(axis=1, keepdims=True) + 0.1 * size)) + np.log(size)

    others = np.where(kept[place][:, None], share(counts[place] - gold), 0.0)
    one = np.zeros(len(truth), np.int64)  # a single sequence
    pairs = np.bincount(truth[:-1] * size + truth[1:], minlength=size * size).reshape(size, size)
    values = [np.zeros((size, BUCKETS)), np.zeros(()), np.zeros(size), np.zeros((size, size))]
    means, squares = ([np.zeros_like(v) for v in values] for _ in range(2))
    total = len(truth)
    for step in range(1, rounds + 1):
        grams, trust, bias, steps = values
        evidence = np.stack([np.bincount(home, weights=grams[k][buckets], minlength=total) for k in range(size)], axis=1)
        evidence += trust * others + bias
        emit = np.exp(np.maximum(evidence - evidence.max(axis=1, keepdims=True), -DEEPEST))
        first = np.r_[True, np.zeros(total - 1, bool)]
        forward, backward = chain(emit, first, np.exp(steps)), chain(emit[::-1], first, np.exp(steps.T))[::-1]
        joint = forward * backward / emit
        wrong = gold - joint / joint.sum(axis=1, keepdims=True)
        both = forward[:-1, :, None] * np.exp(steps) * backward[1:, None, :]
        expected = (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        slopes = [
            np.stack([np.bincount(buckets, weights=wrong[home, k], minlength=BUCKETS) for k in range(size)]), (wrong * others).sum(),
            wrong.sum(axis=0), pairs - expected,
        ]
        fresh = []
        for value, slope, mean, square in zip(values, slopes, means, squares):
            slope = slope / total - ridge * value
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            fresh.append(value + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6))
        values = fresh
    grams, trust, bias, steps = values
    return LanguageField(names, grams, lexicon[kept], share(counts[kept]), float(trust), bias, steps)


def _switching(texts: list[tuple[int, str]], most_words: int = 40) -> list[tuple[int, str]]:
    """Spans of 1 to ``most_words`` words of the texts, of changing languages."""
    draw = np.random.default_rng(11)
    waiting: dict[int, list[str]] = {}
    for label, text in texts:
        parts, at = text.split(), 0
        while at < len(parts):
            count = int(draw.integers(1, most_words + 1))
            waiting.setdefault(label, []).append(" ".join(parts[at:at + count]))
            at += count
    order = draw.permutation(np.repeat(list(waiting), [len(w) for w in waiting.values()])) if waiting else []
    places = {label: iter(spans) for label, spans in waiting.items()}
    return [(int(label), next(places[label])) for label in order]


def learn_languages(
    documents: DataFrame, kept_out: Column, per_language: int = 200, characters: int = 100_000, languages: int = 32,
) -> LanguageField:
    """A field fitted on a bounded sample of the documents that aren't ``kept_out`` and have a language.

    For each language, and for the ``languages`` most common ones at most, documents are taken by the
    hashes of their id and text, at most ``per_language`` and as long as they have ``characters`` in
    all; a longer document teaches nothing. That bounds what reaches the driver. Null text and empty
    text teach nothing. Without any usable row the field knows no language.
    """
    known = documents.where(~kept_out).select(
        "doc_id", F.col("lang").cast("string").alias("name"), F.length("text").alias("size"), F.xxhash64("doc_id", "text").alias("drawn")
    ).where("name IS NOT NULL AND size > 0")
    common = known.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(languages)
    drawn = Window.partitionBy("name").orderBy("drawn", "doc_id", "size")
    chosen = (
        known.where(F.col("size") <= characters).join(F.broadcast(common), "name", "left_semi")
        .withColumn("place", F.row_number().over(drawn)).where(F.col("place") <= per_language)
        .withColumn("before", F.sum("size").over(drawn.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("before") <= characters)
        .select("name", "drawn").distinct()
    )
    rows = (
        documents.where(~kept_out).select(F.col("lang").cast("string").alias("name"), "text", F.xxhash64("doc_id", "text").alias("drawn"))
        .join(F.broadcast(chosen), ["name", "drawn"]).groupBy("name", "drawn").agg(F.min("text").alias("text")).orderBy("name", "drawn").collect()
    )
    names = tuple(sorted({r["name"] for r in rows}))
    spans = _switching([(names.index(r["name"]), r["text"]) for r in rows])
    spans = [(label, span) for label, span in spans if len(word_spans(code_points(span)))]
    if not spans:
        size = len(names)
        return LanguageField(names, np.zeros((size, BUCKETS)), np.zeros(0, np.uint64), np.zeros((0, size)), 0.0, np.zeros(size), np.zeros((size, size)))
    return fit_languages(names, [s for _, s in spans], [k for k, _ in spans])


_RUNS = "array<struct<start: int, end: int, lang: string, score: double>>"


def _runs(words: Words, marginals: np.ndarray, names: tuple[str, ...], offset: int, part: slice) -> list[dict]:
    """Runs of words of one language: from the first word's start to the last one's end, and the words' mean probability."""
    best = marginals[part].argmax(axis=1)
    if not len(best):
        return []
    starts = np.r_[0, np.flatnonzero(best[1:] != best[:-1]) + 1]
    ends = np.r_[starts[1:], len(best)]
    sure = np.add.reduceat(marginals[part][np.arange(len(best)), best], starts) / (ends - starts)
    spans = words.spans[part] - offset
    return [
        {"start": int(spans[a, 0]), "end": int(spans[b - 1, 1]), "lang": names[best[a]], "score": float(s)} for a, b, s in zip(starts, ends, sure)
    ]


def label_languages(documents: DataFrame, field: LanguageField, runs: bool = True) -> DataFrame:
    """(doc_id, lang_pred, score, and with ``runs`` where which language is) of every row.

    ``lang_pred`` is the language with the most letters, ``score`` its share of them; ties go to the
    first name. Null text, and text without a letter, is ``und`` with score 0, and so is everything
    where the field knows no language. Offsets are code points. Repeated rows are labelled each;
    an empty table has no rows.
    """
    names = field.names

    def label(texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        words = Words.of(texts)
        marginals = field.label(words)
        weighed = _weighed(words, marginals, len(texts))
        borders = np.searchsorted(words.text, np.arange(len(texts) + 1))
        found, offset = [], 0
        for number, row in enumerate(weighed):
            part = slice(borders[number], borders[number + 1])
            own = _runs(words, marginals, names, offset, part) if runs and names else []
            best = int(row.argmax()) if len(row) and row.sum() > 0 else None
            found.append(("und", 0.0, []) if best is None else (names[best], float(row[best] / row.sum()), own))
            offset += len(texts[number])
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found: list[tuple[str, float, list[dict]]] = []
            group: list[str] = []
            for text in batch["text"].to_pylist():
                group.append(text)
                if sum(map(len, group)) > CHARS_AT_ONCE:
                    found += label(group)
                    group = []
            found += label(group)
            columns = {"doc_id": batch["doc_id"], "lang_pred": [f[0] for f in found], "score": pa.array([f[1] for f in found], pa.float64())}
            if runs:
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("score", pa.float64())]))
                columns["runs"] = pa.array([f[2] for f in found], kind)
            yield pa.RecordBatch.from_pydict(columns | {"lang_pred": pa.array(columns["lang_pred"], pa.string())})

    schema = "doc_id bigint, lang_pred string, score double" + (f", runs {_RUNS}" if runs else "")
    return documents.select("doc_id", text_of()).mapInArrow(run, schema)


def language_report(documents: DataFrame, **options: int) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, by a field that learns from rows that aren't held out.

    Awkward rows: see ``learn_languages`` and ``label_languages``; a null id is held out.
    """
    field = learn_languages(documents, held_out(4, 2), **options)
    return label_languages(documents, field, runs=False).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
