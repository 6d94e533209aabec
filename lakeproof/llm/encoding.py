"""Token ids of texts, faster than by encoding whole texts one after the other.

Byte-level vocabularies of ranks have an encoder of their own. Where words have an end of their own and
ids follow the order of merges, so do the others: a word's end is written as one more byte, which no
text that is encoded so holds, and ids are the ranks. For what is left: byte-pair merges act within the pieces into which a tokenizer's pattern splits a text, and
a piece lies within a word (with the space before it), so the ids of a text are those of its
words, one after the other. Words repeat far more than texts do.
"""

from __future__ import annotations

import base64
import json
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

#: Words, and pieces, that an encoder remembers: those of the last so many new ones, and twice as many at most.
REMEMBERED = 150_000
# Characters that Python counts as white space and the tokenizers' pattern doesn't, and the mark that splits at spaces.
_ODD = re.compile("[\x00\x1c-\x1f]")
#: Stands for the end of a word: a byte of texts that ``_ODD`` finds, which are encoded in another way.
END_OF_WORD = b"\x1f"
# Where a space is no word's beginning: inside or at the end of a run of white space.
_RUN = re.compile(r"\s (?:\s|\Z)")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class Remembered(dict):
    """A dictionary that fills itself. When it is full it becomes the old one, which lends what is still in use."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class PieceEncoder:
    """Encodes texts with one byte-level tokenizer file; ids come as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path) as file:
            layout = json.load(file)
        self.normalizes = layout["normalizer"] is not None
        steps = layout["pre_tokenizer"].get("pretokenizers", [layout["pre_tokenizer"]])
        stated = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split"]
        self.pattern = regex.compile(stated[0] if stated else public_tokenizers.PATTERN)
        self.letters = _byte_letters()
        merge = self.tokenizer.model.tokenize
        self.pieces = Remembered(lambda piece: _packed([
            t.id for t in merge(piece.encode().decode("latin-1").translate(self.letters))
        ]))
        self.words = Remembered(lambda word: b"".join(map(self.pieces.__getitem__, self.pieces_of(word))))

    def pieces_of(self, word: str) -> list[str]:
        """What the pattern makes of a word. A run of letters is one piece, and a sign after it another."""
        if self.normalizes and word.isalpha():
            return [word]
        if self.normalizes and word[:-1].isalpha() and word[-1] in ".,;:!?":
            return [word[:-1], word[-1]]
        return self.pattern.findall(word)

    def normalized(self, text: str) -> str | None:
        """The text in lower case as the tokenizer has it; none where words can't be told apart simply."""
        if _ODD.search(text):
            return None
        # the final sigma is lower-cased by its place, which the tokenizer doesn't do
        if "Σ" in text or "İ" in text:
            return self.tokenizer.normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).lower()

    def split(self, text: str) -> list[str] | None:
        """The words of a text, each with what precedes it; none where words can't be told apart simply."""
        if self.normalizes:
            plain = self.normalized(text)
            return plain if plain is None else plain.split()
        if _ODD.search(text):
            return None
        return self.pattern.findall(text) if _RUN.search(text) else text.replace(" ", "\x00 ").split("\x00")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without special tokens."""
        found = []
        for text in texts:
            words = self.split(text)
            if words is None:
                found.append(_packed(self.tokenizer.encode(text, add_special_tokens=False).ids))
            else:
                found.append(b"".join(map(self.words.__getitem__, words)))
        return found


class RankEncoder:
    """Encodes texts with a vocabulary of ranks, which gives the ids of the tokenizer file it comes from."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without special tokens."""
        return [_packed(self.encoding.encode_ordinary(text)) for text in texts]


class WordEndEncoder(PieceEncoder):
    """Encodes texts with a tokenizer file that normalises texts, drops white space and ends words with ``</w>``."""

    def __init__(self, path: str, layout: dict) -> None:
        super().__init__(path)
        back = {letter: byte for byte, letter in self.letters.items()}
        special = {token["content"] for token in layout["added_tokens"]}
        end = layout["model"]["end_of_word_suffix"]
        ranks = {
            bytes(back[c] for c in token.removesuffix(end)) + (END_OF_WORD if token.endswith(end) else b""): number
            for token, number in layout["model"]["vocab"].items() if token not in special
        }
        mark = re.escape(END_OF_WORD.decode())
        self.encoding = tiktoken.Encoding("words", pat_str=rf"[^{mark}]+{mark}", mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without special tokens."""
        found, mark = [], END_OF_WORD.decode()
        for text in texts:
            words = self.split(text)
            if words is None:
                found.append(_packed(self.tokenizer.encode(text, add_special_tokens=False).ids))
            elif words:
                pieces = [word if word.isalpha() else mark.join(self.pieces_of(word)) for word in words]
                found.append(_packed(self.encoding.encode_ordinary(mark.join(pieces) + mark)))
            else:
                found.append(b"")
        return found


def follows_merges(layout: dict) -> bool:
    """Whether words have an end, and every merge makes a token of a higher id than the merge before it."""
    model = layout["model"]
    if layout["normalizer"] is None or not model.get("end_of_word_suffix"):
        return False
    made = [model["vocab"]["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    return all(a < b for a, b in zip(made, made[1:]))


def encoder_of(path: str) -> PieceEncoder | RankEncoder:
    """The encoder of a vocabulary file, by its kind."""
    if path.endswith(".tiktoken"):
        return RankEncoder(path)
    with open(path) as file:
        layout = json.load(file)
    return WordEndEncoder(path, layout) if follows_merges(layout) else PieceEncoder(path)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()
