"""Byte-level merging, piece by piece, as tokenizer files with a merge list ask for it."""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cache
from itertools import groupby

# Fixed value: the characters that Unicode calls white space, as the body of a pattern's class.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a merge list.

    Printable bytes stand for themselves as Latin-1, the others, in their order, for the characters
    from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


@cache
def _category(initial: str) -> str:
    """The characters of the general categories with an initial, as the body of a pattern's class."""
    body = []
    letters = (unicodedata.category(chr(c))[0] == initial for c in range(sys.maxunicode + 1))
    at = 0
    for wanted, run in groupby(letters):
        size = sum(1 for _ in run)
        if wanted:
            body.append(f"\\U{at:08x}-\\U{at + size - 1:08x}")
        at += size
    return "".join(body)


@cache
def piece_pattern() -> re.Pattern:
    """Contractions, letters, digits and other characters, each with a blank before; white space."""
    letter, digit = _category("L"), _category("N")
    return re.compile(
        rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{digit}]+| ?[^{_SPACE}{letter}{digit}]+"
        rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    )


def merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Symbols after all merges: again and again the leftmost pair of the lowest rank.

    ``merges`` has rank and merged symbol by pair. Pairs wait in a heap and symbols know their
    neighbours, so n symbols take n log n steps, however many merge.
    """
    n = len(symbols)
    symbols, before, after = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def offer(i: int) -> None:
        pair = symbols[i], symbols[after[i]]
        found = merges.get(pair)
        if found is not None:
            heapq.heappush(heap, (found[0], i, pair, found[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, (left, right), new = heapq.heappop(heap)
        j = after[i]
        # A pair is stale once one of its symbols has merged.
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        symbols[i], symbols[j], after[i] = new, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [s for s in symbols if s >= 0]


@dataclass
class ByteTokenizer:
    """What a tokenizer file says, and a memory of the pieces seen."""

    byte_ids: list[int]
    merges: dict[tuple[int, int], tuple[int, int]]
    added: list[tuple[str, int, bool, bool]]
    compose: bool
    lead: bool
    split: bool
    prefix: list[int]
    suffix: list[int]
    pad: int
    whole: dict[bytes, int] = field(default_factory=dict)
    #: Pieces remembered at most, and bytes of the longest one.
    max_pieces: int = 65_536
    max_bytes: int = 64

    def __post_init__(self):
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.added_ids = {content: i for content, i, _, _ in self.added}
        longest_first = sorted(self.added, key=lambda a: -len(a[0]))
        options = [
            (f"[{_SPACE}]*" if left else "") + re.escape(c) + (f"[{_SPACE}]*" if right else "")
            for c, _, left, right in longest_first
        ]
        self.added_pattern = re.compile(f"({'|'.join(options)})") if options else None
        self.space = re.compile(f"^[{_SPACE}]+|[{_SPACE}]+$")

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of ordinary text, and tokens that the text spells out, with their ids."""
        if self.added_pattern is None:
            yield text, None
            return
        for i, part in enumerate(self.added_pattern.split(text)):
            if i % 2:
                at = self.added_ids.get(part)
                yield part, self.added_ids[self.space.sub("", part)] if at is None else at
            elif part:
                yield part, None

    def ids(self, text: str, room: int) -> list[int]:
        """The first ids of a text, ``room`` at most."""
        out: list[int] = []
        for part, token in self.segments(text):
            if token is not None:
                out.append(token)
            else:
                if self.compose:
                    part = unicodedata.normalize("NFC", part)
                if self.lead and not part.startswith(" "):
                    part = " " + part
                pieces = (m.group() for m in piece_pattern().finditer(part)) if self.split else (part,)
                for piece in pieces:
                    out.extend(self.piece(piece))
                    if len(out) >= room:
                        break
            if len(out) >= room:
                break
        return out[:room]

    def piece(self, piece: str) -> list[int]:
        found = self.known.get(piece) or self.older.get(piece)
        if found is None:
            data = piece.encode()
            token = self.whole.get(data)
            found = [token] if token is not None else merged([self.byte_ids[b] for b in data], self.merges)
            if len(data) > self.max_bytes:
                return found
        # Two generations: what is used again survives.
        if len(self.known) >= self.max_pieces // 2:
            self.known, self.older = {}, self.known
        self.known[piece] = found
        return found


def parse_tokenizer(
    text: str,
    prefix: Sequence[str] | None = None,
    suffix: Sequence[str] | None = None,
    pad: str | None = None,
) -> ByteTokenizer:
    """A byte-level tokenizer from the JSON text of its file.

    ``prefix`` and ``suffix`` name the special tokens before and after a text and ``pad`` the one that
    fills it up; without them the file's own template and padding hold.
    """
    stored = json.loads(text)
    model = stored["model"]
    normalizer, splitter = stored.get("normalizer"), stored.get("pre_tokenizer") or {}
    unsupported = [
        *(n for n in ("dropout", "continuing_subword_prefix", "end_of_word_suffix") if model.get(n)),
        *(["type"] if model.get("type", "BPE") != "BPE" or "merges" not in model else []),
        *(["byte_fallback"] if model.get("byte_fallback") else []),
        *(["normalizer"] if normalizer and normalizer["type"] != "NFC" else []),
        *(["pre_tokenizer"] if splitter.get("type") != "ByteLevel" else []),
        *(["single_word"] if any(a.get("single_word") for a in stored.get("added_tokens", ())) else []),
    ]
    if unsupported:
        raise ValueError(f"This is no byte-level merge tokenizer; not supported: {unsupported}")
    vocab = model["vocab"]
    added = [
        (a["content"], a["id"], a.get("lstrip", False), a.get("rstrip", False))
        for a in stored.get("added_tokens", ())
    ]
    by_name = {**vocab, **{a[0]: a[1] for a in added}}
    before, after = _template(stored.get("post_processor"))
    filler = (stored.get("padding") or {}).get("pad_token", "[PAD]")
    wanted = [
        *(before if prefix is None else prefix),
        *(after if suffix is None else suffix),
        pad or filler,
    ]
    missing = [name for name in wanted if name not in by_name]
    if missing:
        raise ValueError(f"The tokenizer lacks {missing}")
    alphabet = byte_alphabet()
    byte_of = {c: b for b, c in enumerate(alphabet)}
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
    whole = {}
    if model.get("ignore_merges"):
        for token, i in vocab.items():
            if all(c in byte_of for c in token):
                whole[bytes(byte_of[c] for c in token)] = i
    return ByteTokenizer(
        byte_ids=[vocab[c] for c in alphabet],
        merges=merges,
        added=added,
        compose=bool(normalizer),
        lead=splitter.get("add_prefix_space", False),
        split=splitter.get("use_regex", True),
        prefix=[by_name[n] for n in (before if prefix is None else prefix)],
        suffix=[by_name[n] for n in (after if suffix is None else suffix)],
        pad=by_name[pad or filler],
        whole=whole,
    )


def _template(processor: dict | None) -> tuple[list[str], list[str]]:
    """Names of the special tokens that a file puts before and after a text."""
    kind = (processor or {}).get("type")
    if kind == "Sequence":
        found = [_template(p) for p in processor["processors"]]
        return [n for b, _ in found for n in b], [n for _, a in reversed(found) for n in a]
    if kind in ("BertProcessing", "RobertaProcessing"):
        return [processor["cls"][0]], [processor["sep"][0]]
    before, after, passed = [], [], False
    if kind == "TemplateProcessing":
        for part in processor["single"]:
            if "Sequence" in part:
                passed = True
            else:
                (after if passed else before).append(part["SpecialToken"]["id"])
    return before, after


def tokenizer_text(merges: Sequence[tuple[str, str]], specials: Sequence[str]) -> str:
    """A file's text for a merge list, best first: special tokens, then the 256 bytes, then merges.

    The merges are of bytes in their alphabet, as in such files.
    """
    tokens = dict.fromkeys([*specials, *byte_alphabet(), *(left + right for left, right in merges)])
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    return json.dumps(
        {
            "version": "1.0",
            "added_tokens": [{"id": i, "content": s, **flags} for i, s in enumerate(specials)],
            "normalizer": None,
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True},
            "post_processor": None,
            "model": {
                "type": "BPE",
                "vocab": {t: i for i, t in enumerate(tokens)},
                "merges": [list(pair) for pair in merges],
            },
        }
    )


def in_alphabet(data: bytes) -> str:
    alphabet = byte_alphabet()
    return "".join(alphabet[b] for b in data)
