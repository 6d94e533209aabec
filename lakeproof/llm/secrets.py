"""Secrets in texts: three stated patterns, and strings that a public vocabulary cannot compress.

A vocabulary learnt from ordinary text needs about one token for four characters of
prose or of names, and one for two characters or fewer of a random key. So every long
run of key characters is encoded, and a run with few characters per token is a secret,
unless it is a known digest or an identifier. Where a name before the key hides it, the
value and the long parts of the run are encoded by themselves. What may be a word of
another language, letters with few digits at the end, is a secret only if a vocabulary
of many languages says so too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.encoding import RankEncoder
from lakeproof.llm.spans import Span, digest, in_text_order, redacted, written
from lakeproof.llm.support import in_slices, text_of

KINDS = ("assign", "access", "hex", "random")
# The stated patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Runs of key characters that are long enough to tell random from written.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LEAST_CHARS = 16
_PART = re.compile(r"[A-Za-z0-9]+")
# Shapes of digests and identifiers that are public by nature.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_HEX_ONLY = re.compile(r"[0-9a-fA-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
_DIGEST_NAME = re.compile(r"(?:md5|sha-?1|sha-?224|sha-?256|sha-?384|sha-?512|integrity)[-:=]\S*", re.IGNORECASE)
_WORDY = re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z]+)*[-_/]?[0-9]{0,4}")
_DATED = re.compile(r"(?:[0-9]{1,4}[-_/])+[0-9A-Za-z]{1,8}")

VOCABULARY = "byte_bpe_50k.tiktoken"
MULTILINGUAL = "byte_bpe_multi_50k.tiktoken"
CHARS_PER_TOKEN = 2.2


@dataclass(frozen=True)
class Efficiency:
    """Tells random strings by their characters per token of a vocabulary of ranks."""

    vocabulary: str = field(default_factory=lambda: public_tokenizers.path(VOCABULARY))
    chars_per_token: float = CHARS_PER_TOKEN
    multilingual: str = field(default_factory=lambda: public_tokenizers.path(MULTILINGUAL))

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        return RankEncoder(self.vocabulary).encoding

    @cached_property
    def multilingual_encoding(self) -> tiktoken.Encoding:
        return RankEncoder(self.multilingual).encoding

    def is_random(self, run: str) -> bool:
        """A run that may be words has to be random for the vocabulary of many languages too."""
        if len(run) >= self.chars_per_token * len(self.encoding.encode_ordinary(run)):
            return False
        return not _WORDY.fullmatch(run) or len(run) < self.chars_per_token * len(self.multilingual_encoding.encode_ordinary(run))


def base_spans(text: str) -> list[Span]:
    """The stated patterns: leftmost, non-overlapping within a kind."""
    return (
        [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
        + [("access", *m.span()) for m in ACCESS.finditer(text)]
        + [("hex", *m.span()) for m in HEX.finditer(text)]
    )


def is_known(run: str, before: str) -> bool:
    """Whether a run is a digest, a UUID, a date or a number."""
    if _HEX_ONLY.fullmatch(run) and len(run) in DIGEST_LENGTHS or run.isdigit():
        return True
    named = _DIGEST_NAME.search(before[-12:] + run)
    return bool(_UUID.fullmatch(run) or _DATED.fullmatch(run) or named)


def candidate_spans(run: str) -> Iterator[tuple[int, int]]:
    """A run as a whole, the values after its first '=' and last '/', and its parts between separators, the longest first."""
    end = len(run.rstrip("="))
    yield 0, len(run)
    for at in (run.find("=", 0, end), run.rfind("/", 0, end)):
        if at >= 0:
            yield at + 1, len(run)
    yield from sorted((m.span() for m in _PART.finditer(run)), key=lambda s: s[0] - s[1])


def random_spans(text: str, efficiency: Efficiency) -> list[Span]:
    """Runs of key characters, or else parts of them, with few characters per token, without digests and identifiers."""
    found = []
    for m in RUN.finditer(text):
        taken: list[tuple[int, int]] = []
        for start, end in dict.fromkeys(candidate_spans(m[0])):
            part, at = m[0][start:end], m.start() + start
            inked = sum(map(str.isalnum, part))
            if len(part) < LEAST_CHARS or any(a < end and start < b for a, b in taken):
                continue
            if 2 * inked < len(part) or not any(map(str.isalpha, part)):
                continue
            if is_known(part, text[max(0, at - 12):at]):
                taken.append((start, end))  # holds no other part
            elif efficiency.is_random(part):
                taken.append((start, end))
                found.append(("random", at, m.start() + end))
    return found


def secret_spans(text: str, efficiency: Efficiency) -> list[Span]:
    """All spans by start, then kind. A random run that a stated pattern covers in whole is not named again."""
    stated = base_spans(text)
    more = [
        s for s in random_spans(text, efficiency)
        if not any(start <= s[1] and s[2] <= end for _, start, end in stated)
    ]
    return in_text_order(stated + more, KINDS)


def scan_secrets(documents: DataFrame, efficiency: Efficiency = Efficiency()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row.

    Null text counts as empty: no spans, and the digest of the empty string. Repeated rows
    are scanned each, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [secret_spans(t, efficiency) for t in batch["text"].to_pylist()]
            count = {k: [sum(s[0] == k for s in spans) for spans in found] for k in KINDS}
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"],
                **{f"n_{k}": pa.array(count[k], pa.int64()) for k in KINDS[:3]},
                "base_sha256": pa.array([digest([s for s in spans if s[0] != "random"]) for spans in found], pa.string()),
                "spans": pa.array([written(spans) for spans in found], pa.string()),
            })

    return documents.select("doc_id", text_of()).mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def redact_secrets(documents: DataFrame, mark: str = "[secret]", efficiency: Efficiency = Efficiency()) -> DataFrame:
    """The documents with every secret in ``text`` replaced by the mark, and ``n_chars`` brought up to date.

    All rows and columns stay; a null text stays null. Repeated rows are handled each.
    """
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = [
                t and redacted(t, secret_spans(t, efficiency), mark) for t in batch["text"].to_pylist()
            ]
            columns = batch.columns
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    clean = documents.mapInArrow(run, documents.schema)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in documents.columns else clean
