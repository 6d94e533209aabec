"""Spans in texts: how they are written in results, and how they are cut out."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]


def in_text_order(spans: list[Span], kinds: tuple[str, ...]) -> list[Span]:
    """By start, then by kind as listed."""
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def in_kind_order(spans: list[Span], kinds: tuple[str, ...]) -> list[Span]:
    """By kind as listed, then by start."""
    return sorted(spans, key=lambda s: (kinds.index(s[0]), s[1], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(written(spans).encode()).hexdigest()


def redacted(text: str, spans: list[Span], mark: str) -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    pieces, reach = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= reach:
            pieces += [text[reach:start], mark]
        reach = max(reach, end)
    return "".join(pieces) + text[reach:]
