"""Personal data: four stated patterns, and identifiers found by bootstrapping from their contexts.

What the stated patterns find are the seeds. The words around a seed are lexical patterns, of
several widths: the word before, the two words before, the word after, the words on both sides.
Every other identifier-like string (with a digit, six characters or more) is an instance that
waits for evidence. Spark scores the graph of patterns and instances in rounds: a pattern is as
good as the share of known identifiers among all it stands beside, if it has enough distinct
ones; an instance is as good as its best pattern of each side, together. Instances that score
high enough are personal data too, and count as known in the next round.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.spans import Span, digest, in_kind_order, redacted, written
from lakeproof.llm.support import in_slices, staged, text_of

KINDS = ("email", "ip", "card", "phone", "context")
# The stated patterns. A look behind spares new starts inside a run of digits, which can't match either.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DIGITS = re.compile(r"[0-9]+")

_WORD = re.compile(r"\S+")
_ALNUM = frozenset(string.ascii_letters + string.digits)
#: Characters of an instance at least, and of a word that a pattern shows; a longer word is shown by its hash.
LEAST_CHARS, SHOWN_CHARS = 6, 40

FOUND = "array<struct<start:bigint,end:bigint,seed:boolean,instance:bigint,patterns:array<string>>>"
SCAN_SCHEMA = (
    "row_task int, row_nth bigint, doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    f"base_sha256 string, base_spans string, found {FOUND}"
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Matches of the stated pattern, found from each ``@`` so that long runs of letters cost no retries."""
    found, reach, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > reach and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            reach = domain.end()
            found.append(("email", start, reach))
        at = text.find("@", max(at + 1, reach))
    return found


def base_spans(text: str) -> list[Span]:
    """The stated patterns, by kind as listed and by start."""
    found = emails(text)
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return found


def words_of(text: str) -> list[tuple[int, int]]:
    """Start and end of every run of characters that aren't white space."""
    return [m.span() for m in _WORD.finditer(text)]


def candidates(text: str, words: list[tuple[int, int]], taken: list[Span]) -> list[tuple[int, int]]:
    """Identifier-like strings that touch no span: words with a digit, without the signs at their ends."""
    spans = sorted((start, end) for _, start, end in taken)
    starts, found = [start for start, _ in spans], []
    # only words that hold a digit are looked at
    homes = sorted({bisect_right(words, (m.start(), len(text))) - 1 for m in _DIGITS.finditer(text)})
    reach = list(accumulate((end for _, end in spans), max))
    for home in homes:
        start, end = words[home]
        while text[start] not in _ALNUM:
            start += 1
        while text[end - 1] not in _ALNUM:
            end -= 1
        before = bisect_left(starts, end)
        if end - start >= LEAST_CHARS and not (before and reach[before - 1] > start):
            found.append((start, end))
    return found


def patterns_of(text: str, words: list[tuple[int, int]], start: int, end: int, shown: Callable[[str], str]) -> list[str]:
    """The words around a span, in lower case and without signs at their ends: before, two before, after, on both sides."""
    first, last = bisect_right(words, (start, len(text))) - 1, bisect_left(words, (end, end))
    before = [shown(text[a:b]) for a, b in words[max(0, first - 2):first]]
    after = [shown(text[a:b]) for a, b in words[last:last + 1]]
    found = [f"{word} _" for word in before[-1:]]
    if len(before) == 2:
        found.append(f"{before[0]} {before[1]} _")
    found += [f"_ {word}" for word in after]
    if before and after:
        found.append(f"{before[-1]} _ {after[0]}")
    return found


def scan(documents: DataFrame) -> DataFrame:
    """Per row: counts and digest of the stated patterns, and all seeds and candidates that have words around them."""
    import xxhash

    def key(text: str) -> int:
        return xxhash.xxh64_intdigest(text.lower()) - (1 << 63)

    def shown(word: str) -> str:
        plain = word.strip(string.punctuation).lower() or word
        return plain if len(plain) <= SHOWN_CHARS else f"#{xxhash.xxh64_hexdigest(plain)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, nth = TaskContext.get().partitionId(), 0
        for batch in in_slices(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                spans = base_spans(text)
                words = words_of(text) if _DIGITS.search(text) or spans else []
                found = [(s, e, True) for _, s, e in spans] + [(s, e, False) for s, e in candidates(text, words, spans)]
                found = [(s, e, seed, key(text[s:e]), patterns_of(text, words, s, e, shown)) for s, e, seed in found]
                counts = [sum(s[0] == k for s in spans) for k in KINDS[:4]]
                rows.append((task, nth, doc_id, *counts, digest(spans), written(spans), [
                    dict(zip(("start", "end", "seed", "instance", "patterns"), f)) for f in found if f[4]
                ]))
                nth += 1
            spot = pa.list_(pa.struct([
                ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("instance", pa.int64()), ("patterns", pa.list_(pa.string())),
            ]))
            kinds = (pa.int32(), *[pa.int64()] * 6, pa.string(), pa.string(), spot)
            names = [f.split()[0] for f in SCAN_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return documents.select("doc_id", text_of()).mapInArrow(run, SCAN_SCHEMA)


def bootstrap(found: DataFrame, rounds: int = 3, least_seeds: int = 5, accepted: float = 0.8) -> DataFrame:
    """The instances (without the seeds) that score ``accepted`` or more, from (pattern, instance, seed) rows.

    Every round is two aggregations over the distinct edges. A pattern or an instance that
    occurs very often is summed before it is shuffled, and meets the edges in joins that
    adaptive execution splits.
    """
    edges = staged(found.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    known = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for _ in range(rounds):
        known = staged(known, "pii-scores")
        patterns = score_patterns(edges, known, least_seeds).where(F.col("confidence") >= accepted / 2)
        # patterns of one side say much the same, so only the best of a side counts
        side = F.when(F.col("pattern").startswith("_"), 2).when(F.col("pattern").endswith("_"), 1).otherwise(3)
        best = edges.where("NOT seed").select("pattern", "instance").join(patterns.select("pattern", "confidence"), "pattern").groupBy(
            "instance"
        ).agg(*(F.coalesce(F.max(F.when(side == k, F.col("confidence"))), F.lit(0.0)).alias(f"side{k}") for k in (1, 2, 3)))
        apart = 1 - (1 - F.col("side1")) * (1 - F.col("side2"))
        evidence = best.select("instance", F.greatest(apart, "side3").alias("evidence"))
        known = edges.groupBy("instance").agg(F.max("seed").alias("sure")).join(evidence, "instance", "left").select(
            "instance", F.when(F.col("sure"), 1.0).otherwise(F.coalesce("evidence", F.lit(0.0))).alias("score")
        )
    sure = edges.where("seed").select("instance").distinct()
    return known.where(F.col("score") >= accepted).join(sure, "instance", "left_anti").select("instance")


def score_patterns(edges: DataFrame, known: DataFrame, least_seeds: int) -> DataFrame:
    """(pattern, support, instances, confidence) of the patterns whose instances' scores add up to ``least_seeds``."""
    return edges.select("pattern", "instance").join(known, "instance").groupBy("pattern").agg(
        F.sum("score").alias("support"), F.count("*").alias("instances")
    ).where(F.col("support") >= least_seeds).withColumn("confidence", F.col("support") / F.col("instances"))


def find_personal_data(documents: DataFrame, rounds: int = 3, least_seeds: int = 5, accepted: float = 0.8) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row.

    Null text counts as empty: no spans, and the digest of the empty string. Repeated rows
    are scanned each, other columns are not read. A corpus without seeds has stated spans only.
    """
    scanned = staged(scan(documents), "pii-scan")
    found = scanned.select("row_task", "row_nth", F.inline("found"))
    edges = found.select(F.explode("patterns").alias("pattern"), "instance", "seed")
    more = found.where("NOT seed").join(bootstrap(edges, rounds, least_seeds, accepted), "instance").groupBy(
        "row_task", "row_nth"
    ).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("context")).select(
        "row_task", "row_nth",
        F.transform("context", lambda s: F.concat_ws(":", F.lit("context"), s["start"], s["end"])).alias("context"),
    )
    return scanned.drop("found").join(more, ["row_task", "row_nth"], "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.concat_ws(",", F.nullif("base_spans", F.lit("")), "context").alias("spans"),
    )


def parse_spans(spans: str) -> list[Span]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)]


def redact_text(text: str, spans: str, mark: str = "[private]") -> str:
    """A text with its written spans replaced."""
    return redacted(text, in_kind_order(parse_spans(spans), KINDS), mark)
