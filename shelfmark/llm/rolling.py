"""Rolling word grams: word boundaries and gram hashes of whole Arrow batches in numpy.

Words are runs of digits, of a-z after lower-casing A-Z, and of characters beyond ASCII. A word's
hash is a polynomial over its bytes, taken from running sums, so no word becomes a Python object;
a gram's hash combines its words' hashes. Equal hashes are candidates only: each row carries its
gram's words, and joins compare them as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_batches, row_key, texts

#: Bytes that are worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
HASH_BYTES = 1 << 18

_MUL = 0x9E3779B97F4A7C15 | 1
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0
    for b in range(256)
)
_LUT = np.frombuffer(_WORD_BYTES, np.uint8)
GRAM_SCHEMA = (
    "doc_id {id_type}, key binary, n_words long, "
    "grams array<struct<position: int, hash: long, gram: string>>"
)


def string_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, and the n + 1 offsets of its values in them."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, each of one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


class Powers:
    """Powers of the multiplier and of its inverse modulo 2^64, as long as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = _powers(_MUL, n)
                self.down = _powers(pow(_MUL, -1, 1 << 64), n)
        return self.up[:n], self.down[:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_spans(
    data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = _LUT
) -> tuple[np.ndarray, ...]:
    """Normalised bytes, starts and ends of all words, and each row's first word (n + 1 values).

    ``letters`` gives each byte's normal form, 0 for those between words.
    """
    plain = letters[data]
    inside = np.concatenate([plain != 0, [False]])
    before = np.concatenate([[False], inside[:-1]])
    before[offsets[:-1]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]])
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return plain, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    plain: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers
) -> np.ndarray:
    """A 64-bit hash of each word's bytes, made for ``HASH_BYTES`` of text at a time."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(int(np.searchsorted(ends, base + HASH_BYTES, "right")), at + 1)
        part = plain[base : ends[stop - 1]]
        first, last = starts[at:stop] - base, ends[at:stop] - base
        with np.errstate(over="ignore"):
            up, down = powers.upto(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part.astype(np.uint64) * up[: len(part)], out=sums[1:])
            word = (sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)
            out[at:stop] = _mixed(word)
        at = stop
    return out


def gram_hashes(
    plain: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, powers: Powers
) -> np.ndarray:
    """Hash of the gram that begins at each word (meaningless where too few words follow)."""
    with np.errstate(over="ignore"):
        word = word_hashes(plain, starts, ends, powers)
        out = np.zeros(len(word), np.uint64)
        for k in range(length):
            out = out * np.uint64(_MUL)
            out[: len(word) - k] += word[k:]
    return _mixed(out)


def hash_table(hashes: np.ndarray) -> np.ndarray:
    """A one-hash filter: ``table[hash >> shift]`` is true for every given hash, and few others."""
    bits = min(max(16, int(len(hashes)).bit_length() + 5), 26)
    table = np.zeros(1 << bits, bool)
    table[hashes.astype(np.uint64) >> np.uint64(64 - bits)] = True
    return table


def _rolled(
    batch: pa.RecordBatch, length: int, table: np.ndarray | None, powers: Powers
) -> pa.RecordBatch:
    data, offsets = string_views(batch.column("text"))
    n_words, sizes = [], []
    positions, hashes, grams = [], [], []
    for first, last in blocks(offsets):
        base = offsets[first]
        part = data[base : offsets[last]]
        plain, starts, ends, per_row = word_spans(part, offsets[first : last + 1] - base)
        n_words.append(np.diff(per_row))
        hashed = gram_hashes(plain, starts, ends, length, powers)
        row = np.repeat(np.arange(last - first), np.diff(per_row))
        wanted = np.arange(len(starts)) + length <= per_row[1:][row]
        if table is not None:
            shift = np.uint64(65 - int(len(table)).bit_length())
            wanted &= table[hashed >> shift]
        at = np.flatnonzero(wanted)
        sizes.append(np.bincount(row[at], minlength=last - first))
        positions.append(at - per_row[:-1][row[at]])
        hashes.append(hashed[at].view(np.int64))
        raw = plain.tobytes()
        grams += [
            b" ".join([raw[starts[i] : ends[i]] for i in range(w, w + length)]) for w in at.tolist()
        ]
    ends = np.concatenate([[0], *[np.asarray(s) for s in sizes]]).cumsum().astype(np.int32)
    none = [np.zeros(0, np.int64)]
    values = pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate(none + positions).astype(np.int32)),
            pa.array(np.concatenate(none + hashes)),
            pa.array(grams, pa.binary()).cast(pa.string()),
        ],
        ["position", "hash", "gram"],
    )
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            batch.column("key"),
            pa.array(np.concatenate(none + n_words)),
            pa.ListArray.from_arrays(pa.array(ends), values),
        ],
        ["doc_id", "key", "n_words", "grams"],
    )


def rolling_grams(
    df: DataFrame,
    length: int,
    table: np.ndarray | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, key, n_words, grams`` per input row: position, hash and words of its grams.

    With ``table`` (``hash_table`` of one side of a join) only grams that may have a partner on
    that side are returned; without it, all are.
    """
    docs = texts(df, id_col, text_col).withColumn("key", row_key())
    shared = df.sparkSession.sparkContext.broadcast(table) if table is not None else None

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, known = Powers(), shared.value if shared is not None else None
        for batch in batches:
            yield _rolled(batch, length, known, powers)

    schema = GRAM_SCHEMA.format(id_type=docs.schema["doc_id"].dataType.simpleString())
    return map_batches(docs, stage, schema)


def exploded(rolled: DataFrame) -> DataFrame:
    """``doc_id, key, n_words, position, hash, gram``, a row per gram."""
    return rolled.select("doc_id", "key", "n_words", F.inline("grams"))
