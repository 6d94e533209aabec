"""Document quality from a linear-chain conditional random field over lines.

Every line has seventeen numbers (character and word statistics) and sees those of the
line before and after it. The field labels each line good or bad; its forward-backward
marginals, weighted by line length, add up to the quality of the document. It learns
from documents whose label stands for all their lines.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.support import fit_logistic, held_out, in_slices, text_of, training_sample

SPACE, LOWER, UPPER, LETTER, DIGIT, END, PAUSE, SIGN, BREAK = range(9)
CLASSES = 9
LINE_FEATURES = 17
#: A line's own features, those of its neighbours, whether it has neighbours, and a constant.
FEATURES = 3 * LINE_FEATURES + 3
#: Characters of text that a task turns into features at a time, beyond one document.
CHARS_AT_ONCE = 2_000_000
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _classes() -> np.ndarray:
    """The class of every code point of the basic plane, from its Unicode category."""
    def of(point: int) -> int:
        character = chr(point)
        category = unicodedata.category(character)
        if character in ".!?…。":
            return END
        if category == "Ll":
            return LOWER
        if category == "Lu":
            return UPPER
        if category[0] in "LM":
            return LETTER
        if category[0] == "N":
            return DIGIT
        if category[0] == "Z" or character in "\t\r\v\f":
            return SPACE
        return PAUSE if character in ",;:'\"-()’“”«»¿¡" else SIGN

    table = np.fromiter(map(of, range(1 << 16)), np.uint8, 1 << 16)
    table[ord("\n")] = BREAK
    return table


_CLASS = _classes()


def lines_of(text: str) -> list[str]:
    """The lines that hold more than white space."""
    return [line for line in text.split("\n") if line.strip()]


def line_features(documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all lines of some documents, one after the other, and the lines' lengths."""
    lines = [line for document in documents for line in document]
    count = len(lines)
    if not count:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0)
    points = np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    kind = np.where(points < 1 << 16, _CLASS[np.minimum(points, (1 << 16) - 1)], LETTER).astype(np.int64)
    line = np.cumsum(kind == BREAK) - (kind == BREAK)
    counts = np.bincount(line * CLASSES + kind, minlength=count * CLASSES).reshape(count, CLASSES).astype(float)
    length = counts.sum(axis=1) - 1

    inked = (kind != SPACE) & (kind != BREAK)
    at = np.flatnonzero(inked)
    begins = np.r_[True, np.diff(at) > 1]
    first = np.flatnonzero(begins)
    number = np.cumsum(begins) - 1
    within = np.arange(len(at)) - first[number]
    hashes = np.add.reduceat((points[at].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[within & 255], first)
    home = line[at[first]]
    last = np.r_[first[1:], len(at)] - 1
    words = np.bincount(home, minlength=count).astype(float)
    per_word = 1 / np.maximum(words, 1)
    lettered = np.add.reduceat(((kind[at] >= LOWER) & (kind[at] <= LETTER)).astype(np.int64), first)
    same = np.r_[False, (hashes[1:] == hashes[:-1]) & (home[1:] == home[:-1])]
    distinct = np.unique(hashes * np.uint64(0x9E3779B97F4A7C15) + home.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), return_index=True)[1]

    def share(of_words: np.ndarray) -> np.ndarray:
        return np.bincount(home, weights=of_words, minlength=count) * per_word

    ink = np.maximum(counts[:, LOWER:BREAK].sum(axis=1), 1)
    document = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    seen: dict[tuple[int, str], int] = {}
    for key in zip(document.tolist(), lines):
        seen[key] = seen.get(key, 0) + 1
    ends = np.zeros(count)
    ends[home] = kind[at[last]] == END  # the last word of a line is written last
    own = np.stack([
        np.log1p(length) / 8, np.log1p(words) / 6, ink * per_word / 10,
        counts[:, LOWER] / ink, counts[:, UPPER] / ink, counts[:, LETTER] / ink, counts[:, DIGIT] / ink,
        5 * counts[:, END] / ink, 5 * counts[:, PAUSE] / ink, counts[:, SIGN] / ink,
        share((kind[at[last]] == SIGN).astype(float)), share((lettered == 0).astype(float)), share(same.astype(float)),
        np.bincount(home[distinct], minlength=count) * per_word, share((kind[at[first]] == UPPER).astype(float)), ends,
        np.fromiter((seen[k] > 1 for k in zip(document.tolist(), lines)), float, count),
    ], axis=1)
    before = np.r_[False, document[1:] == document[:-1]]
    after = np.r_[document[1:] == document[:-1], False]
    previous = np.where(before[:, None], np.roll(own, 1, axis=0), 0)
    following = np.where(after[:, None], np.roll(own, -1, axis=0), 0)
    full = np.concatenate([own, previous, following, before[:, None], after[:, None], np.ones((count, 1))], axis=1)
    return full.astype(np.float32), length


@dataclass(frozen=True)
class LineField:
    """Weights of the features for a good line over a bad one, and log weights of label pairs (before, after).

    ``slope`` and ``intercept`` turn the log odds of the weighted mean of marginals into those of a good document.
    """

    weights: np.ndarray
    steps: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def marginals(self, features: np.ndarray) -> np.ndarray:
        """The probability of each line of one document that it is good."""
        odds = (features @ self.weights).tolist()
        forward, backward = [0.0] * len(odds), [0.0] * len(odds)
        for i, own in enumerate(odds):
            forward[i] = own + (_carry(forward[i - 1], self.steps) if i else 0.0)
        flipped = self.steps.T
        for i in range(len(odds) - 2, -1, -1):
            backward[i] = _carry(backward[i + 1] + odds[i + 1], flipped)
        return 1 / (1 + np.exp(-np.clip(np.add(forward, backward), -40, 40)))

    def document(self, features: np.ndarray, lengths: np.ndarray) -> float:
        """Marginals weighted by line length, as the probability of a good document."""
        return 1 / (1 + math.exp(-self.intercept - self.slope * self.log_odds(features, lengths)))

    def log_odds(self, features: np.ndarray, lengths: np.ndarray) -> float:
        """Log odds of the weighted mean of marginals."""
        return _log_odds(float(self.marginals(features) @ lengths / lengths.sum()))

    def qualities(self, texts: list[str]) -> list[float]:
        """The quality of each text; a text without words has quality 0."""
        documents = [lines_of(t) for t in texts]
        features, lengths = line_features(documents)
        scores, at = [], 0
        for document in documents:
            end = at + len(document)
            scores.append(self.document(features[at:end], lengths[at:end]) if document else 0.0)
            at = end
        return scores


def _log_odds(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return math.log(share / (1 - share))


def _carry(odds: float, steps: np.ndarray) -> float:
    """Log odds of a line from those of its neighbour, through the label pairs."""
    odds = max(-40.0, min(40.0, odds))
    grown = math.exp(odds)
    return math.log(
        (math.exp(steps[0, 1]) + grown * math.exp(steps[1, 1])) / (math.exp(steps[0, 0]) + grown * math.exp(steps[1, 0]))
    )


def fit_field(sequences: list[np.ndarray], labels: list[int], rounds: int = 150, rate: float = 0.1, ridge: float = 1e-3) -> LineField:
    """Maximum likelihood by gradient steps with momentum; sequences of about one length advance together."""
    groups: dict[int, list[int]] = {}
    for k, sequence in enumerate(sequences):
        groups.setdefault((len(sequence) - 1).bit_length(), []).append(k)
    batches = [_padded([sequences[k] for k in group], np.array([labels[k] for k in group])) for _, group in sorted(groups.items())]
    total = float(sum(map(len, sequences)))
    weights, steps = np.zeros(FEATURES), np.zeros((2, 2))
    means = [np.zeros(FEATURES), np.zeros((2, 2))]
    squares = [np.zeros(FEATURES), np.zeros((2, 2))]
    for step in range(1, rounds + 1):
        gradients = [_gradients(*batch, weights, steps) for batch in batches]
        slopes = [
            sum(g for g, _ in gradients) / total - ridge * weights,
            sum(g for _, g in gradients) / total - ridge * steps,
        ]
        updated = []
        for value, slope, mean, square in zip((weights, steps), slopes, means, squares):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            updated.append(value + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8))
        weights, steps = updated
    return LineField(weights, steps)


def _padded(sequences: list[np.ndarray], truth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines, which places hold a line, labels of the lines, label pairs) of some sequences."""
    sizes = np.array([len(s) for s in sequences])
    mask = np.arange(sizes.max()) < sizes[:, None]
    pairs = sizes - 1
    gold = np.array([[pairs[truth == 0].sum(), 0], [0, pairs[truth == 1].sum()]], float)
    return np.concatenate(sequences), mask, np.repeat(truth, sizes), gold


def _gradients(
    flat: np.ndarray, mask: np.ndarray, gold_lines: np.ndarray, gold: np.ndarray, weights: np.ndarray, steps: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the log likelihood of some sequences, by forward-backward."""
    count, longest = mask.shape
    odds = np.zeros((count, longest))
    odds[mask] = flat @ weights.astype(np.float32)
    emit = np.stack([np.zeros_like(odds), odds], axis=2)
    alpha, beta = np.zeros((count, longest, 2)), np.zeros((count, longest, 2))
    alpha[:, 0] = emit[:, 0]
    for i in range(1, longest):
        alpha[:, i] = np.logaddexp(alpha[:, i - 1, :1] + steps[0], alpha[:, i - 1, 1:] + steps[1]) + emit[:, i]
    for i in range(longest - 2, -1, -1):
        onward = emit[:, i + 1] + beta[:, i + 1]
        carried = np.logaddexp(onward[:, :1] + steps[:, 0], onward[:, 1:] + steps[:, 1])
        beta[:, i] = np.where(mask[:, i + 1, None], carried, 0)
    joint = alpha + beta
    norm = np.logaddexp(joint[..., 0], joint[..., 1])
    good = np.exp(joint[..., 1] - norm)
    inner = mask[:, 1:]
    both = alpha[:, :-1, :, None] + steps + (emit + beta)[:, 1:, None, :]
    expected = np.exp(both - norm[:, 1:, None, None])[inner].sum(axis=0) if longest > 1 else np.zeros((2, 2))
    return flat.T @ (gold_lines - good[mask]), gold - expected


def learn_field(
    documents: DataFrame, labels: DataFrame, per_class: int = 1500, lines_per_class: int = 72_000, modulus: int = 5, remainder: int = 0,
) -> LineField:
    """A field fitted on at most ``per_class`` labelled documents of each class, with all their lines.

    Of these the weights learn from whole documents, by the hashes of their ids, until a class has
    ``lines_per_class`` lines; that bounds what reaches the driver to 40 MB and one document. The slope
    and intercept are fitted on the scores of all of them, computed in tasks. Without
    labels of both classes all lines are as likely good as bad.
    """
    sample = training_sample(documents, labels, "quality", held_out(modulus, remainder), per_class)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            lines = pa.array([len(lines_of(t)) for t in batch["text"].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "label": batch["label"], "lines": lines})

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 32):
            found = [line_features([lines_of(t)])[0].astype("<f4").tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "label": batch["label"], "features": pa.array(found, pa.binary()),
            })

    sizes = (
        sample.mapInArrow(count, "doc_id bigint, label int, lines bigint").where("lines > 0").groupBy("doc_id", "label")
        .agg(F.sum("lines").alias("lines")).withColumn("drawn", F.xxhash64("doc_id")).orderBy("drawn", "doc_id").collect()
    )
    taken, chosen = {0: 0, 1: 0}, []
    for row in sizes:
        if taken[row["label"]] < lines_per_class:
            taken[row["label"]] += row["lines"]
            chosen.append((row["doc_id"],))
    if not all(taken.values()):
        return LineField(np.zeros(FEATURES), np.zeros((2, 2)))
    ids = documents.sparkSession.createDataFrame(chosen, "doc_id bigint")
    rows = (
        sample.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label")
        .mapInArrow(features, "doc_id bigint, label int, features binary").orderBy("doc_id", "features").toArrow()
    )
    sequences = [np.frombuffer(f, "<f4").reshape(-1, FEATURES) for f in rows["features"].to_pylist()]
    kept = [(s, label) for s, label in zip(sequences, rows["label"].to_pylist()) if len(s)]
    field = fit_field([s for s, _ in kept], [label for _, label in kept])

    def odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 32):
            texts = [lines_of(t) for t in batch["text"].to_pylist()]
            found = [field.log_odds(*line_features([lines])) if lines else None for lines in texts]
            yield pa.RecordBatch.from_pydict({"label": batch["label"], "odds": pa.array(found, pa.float64())})

    scored = sample.mapInArrow(odds, "label int, odds double").where("odds IS NOT NULL").toPandas().sort_values(["odds", "label"])
    slope, intercept = fit_logistic(scored["odds"].to_numpy(), scored["label"].to_numpy(dtype=float))
    return LineField(field.weights, field.steps, slope, intercept)


def score_quality(documents: DataFrame, field: LineField) -> DataFrame:
    """(doc_id, score) of every row. Null text counts as empty and scores 0; repeated rows are scored each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            scores: list[float] = []
            group: list[str] = []
            for text in batch["text"].to_pylist():
                group.append(text)
                if sum(map(len, group)) > CHARS_AT_ONCE:
                    scores += field.qualities(group)
                    group = []
            scores += field.qualities(group)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "score": pa.array(scores, pa.float64())})

    return documents.select("doc_id", text_of()).mapInArrow(run, "doc_id bigint, score double")


def quality_report(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, **options: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of the documents.

    Null text, and text without words, scores 0. Repeated rows are scored each, a null id is held
    out, an empty table has no rows; other columns are not read. Null labels and null ids teach
    nothing, conflicting labels of one document count as 1.
    """
    return score_quality(documents, learn_field(documents, labels, **options)).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
