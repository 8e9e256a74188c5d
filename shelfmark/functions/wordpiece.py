"""Pieces of one word; called once per distinct word of a batch."""

from __future__ import annotations

import unicodedata
from collections.abc import Container

# Fixed value: a longer word is unknown as a whole.
MAX_WORD_CHARS = 100

# Tokens that also stand for themselves where a text spells them out.
SPELLED_TOKENS = frozenset({"[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"})

_ASCII_PUNCTUATION = frozenset("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def split_word(
    word: str, known: Container[str], longest: int, unknown: str, plain: bool = False
) -> list[str]:
    """Longest known pieces of a word from the left, later ones marked ``##``.

    No known piece has more than ``longest`` characters. With ``plain`` capitals and
    accents are removed first, and punctuation that comes out of composed characters
    stands alone.
    """
    if plain and word in SPELLED_TOKENS and word in known:
        return [word]
    parts = word_parts(word, plain)
    return [p for part in parts for p in _longest_pieces(part, known, longest, unknown)]


def word_parts(word: str, plain: bool, known: Container[str] = ()) -> list[str]:
    """The parts of a word that are cut into pieces each for itself."""
    if not plain:
        return [word]
    if word in SPELLED_TOKENS:
        return [word] if word in known else ["[", word[1:-1].lower(), "]"]
    return _plain_parts(word)


def _plain_parts(word: str) -> list[str]:
    if word.isascii():
        return [word.lower()]
    bare = (c for c in unicodedata.normalize("NFD", word) if unicodedata.category(c) != "Mn")
    spaced = "".join(f" {c} " if c in _ASCII_PUNCTUATION else c.lower() for c in bare)
    return spaced.split() if " " in spaced else [spaced] if spaced else []


def _longest_pieces(word: str, known: Container[str], longest: int, unknown: str) -> list[str]:
    length = len(word)
    if length > MAX_WORD_CHARS:
        return [unknown]
    pieces: list[str] = []
    start = 0
    while start < length:
        mark = "##" if start else ""
        for end in range(min(length, start + longest), start, -1):
            piece = mark + word[start:end]
            if piece in known:
                break
        else:
            return [unknown]
        pieces.append(piece)
        start = end
    return pieces
