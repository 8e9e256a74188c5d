"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: its lines, cut after sentence ends, and after every ``max_words`` words
where a sentence has more, so that an edit touches few of them. A paragraph's digest is its XXH64;
the digest of a repeated one is mixed with the number of its occurrence, so that repeats count.

A sketch has three rows of cells. Each digest falls into one cell of each row and adds to it: one to
its count, itself (exclusive or) to its keys, its check (a mix of it) to its checks. The sketch of one
version minus that of another leaves only the digests that differ. Peeling recovers them: a cell with
count 1 or -1 whose keys have the check of its checks holds a single digest, which is then taken
out of its three cells, which may leave other cells with a single one. Where peeling leaves cells that
aren't empty, the sketch was too small for the difference: both versions are sketched anew in twice
as many cells at least, under other cell functions, until it succeeds. The variance of the counts
and their sum tell how much larger to try.

The fingerprint is the sketch at its first size: for each cell the count (2 bytes), keys (8) and checks
(4), in base 64. Two fingerprints alone tell a difference of some eight paragraphs
(:func:`fingerprint_difference`); more takes the texts.

Likeness of two versions is the number of their common paragraphs over that of all distinct ones; of
two without any it is 1.

Defined cases: null texts count as empty, an empty or blank text has no paragraph and a fingerprint
of empty cells. Equal texts have equal fingerprints. Repeated rows stay. In :func:`neighbours` rows
with a null id come last, rows with one id are ordered by a hash of their text; rows equal in both
are interchangeable. A single row is its own next one. Empty tables give none. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Workspace, fresh_name, map_batches, texts

#: Cells of a fingerprint, three rows of six.
CELLS = 18
#: Words of a paragraph at most.
MAX_WORDS = 8
#: Cells of all sketches that are peeled together.
CELLS_AT_ONCE = 1 << 19

_CELL = np.dtype([("count", "<i2"), ("keys", "<u8"), ("checks", "<u4")])


def paragraph_pattern(max_words: int = MAX_WORDS) -> re.Pattern:
    """Runs of words within a line: to the end of a sentence, the line or ``max_words``."""
    return re.compile(rf"(?:\S*[^\s.!?][^\S\n]+){{0,{max_words - 1}}}\S+")


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def elements(texts: list[str], pattern: re.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of texts and the digests of their paragraphs, repeats told apart; sorted by both."""
    found = [pattern.findall(t) for t in texts]
    digest = np.array([xxhash.xxh64_intdigest(p) for ps in found for p in ps], np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(ps) for ps in found])
    order = np.lexsort((digest, owner))
    owner, digest = owner[order], digest[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (digest[1:] != digest[:-1])
    at = np.arange(len(owner))
    repeat = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    digest = np.where(repeat > 0, mixed(digest + repeat * np.uint64(0x9E3779B97F4A7C15)), digest)
    return owner, digest


@dataclass
class Sketches:
    """Sketches of many texts, a row each."""

    count: np.ndarray
    keys: np.ndarray
    checks: np.ndarray

    @classmethod
    def empty(cls, n: int, cells: int) -> Sketches:
        return cls(*(np.zeros((n, cells), t) for t in (np.int64, np.uint64, np.uint32)))

    @classmethod
    def of(cls, owner: np.ndarray, digest: np.ndarray, n: int, cells: int) -> Sketches:
        made = cls.empty(n, cells)
        made.add(owner, digest, 1)
        return made

    def add(self, owner: np.ndarray, digest: np.ndarray, sign: np.ndarray | int) -> None:
        cells = self.count.shape[1]
        check = (mixed(digest ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype(np.uint32)
        for at in cells_of(digest, cells):
            flat = owner * cells + at
            np.add.at(self.count.reshape(-1), flat, sign)
            np.bitwise_xor.at(self.keys.reshape(-1), flat, digest)
            np.bitwise_xor.at(self.checks.reshape(-1), flat, check)

    def __sub__(self, other: Sketches) -> Sketches:
        return Sketches(self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks)

    def guess(self) -> np.ndarray:
        """About how many digests the sketches hold: by the variance of the counts, which each digest
        changes by 1 or -1, and at least the sum of these."""
        count = self.count.reshape(len(self.count), 3, -1)
        spread = ((count - count.mean(axis=2, keepdims=True)) ** 2).sum(axis=(1, 2)) / 3
        return np.maximum(spread, np.abs(count[:, 0].sum(axis=1)))

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, digests and signs of what the sketches hold, and the rows that didn't empty.

        The sketches are emptied by it. Rows that didn't empty may have given some digests.
        """
        found = []
        cells = self.count.shape[1]
        rows = np.arange(len(self.count))
        while len(rows):
            check = mixed(self.keys[rows] ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)
            single = (np.abs(self.count[rows]) == 1) & (check.astype(np.uint32) == self.checks[rows])
            at, cell = np.nonzero(single)
            owner = rows[at]
            digest, sign = self.keys[owner, cell], self.count[owner, cell]
            # A digest alone in several of its cells is taken out once.
            order = np.lexsort((digest, owner))
            owner, digest, sign, cell = (x[order] for x in (owner, digest, sign, cell))
            first = np.ones(len(owner), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (digest[1:] != digest[:-1])
            # A digest in a cell that isn't its own is a chance match.
            own = np.any([c == cell for c in cells_of(digest, cells)], axis=0) if len(cell) else first
            owner, digest, sign = (x[first & own] for x in (owner, digest, sign))
            if not len(owner):
                break
            self.add(owner, digest, -sign)
            found.append((owner, digest, sign))
            rows = np.unique(owner)
            rows = rows[(self.count[rows] != 0).any(axis=1) | (self.keys[rows] != 0).any(axis=1)]
        left = (self.count != 0).any(axis=1) | (self.keys != 0).any(axis=1)
        none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        owner, digest, sign = (np.concatenate(x) for x in zip(none, *found))
        return owner, digest, sign, left

    def encoded(self) -> list[bytes]:
        out = np.zeros(self.count.shape, _CELL)
        out["count"], out["keys"], out["checks"] = self.count, self.keys, self.checks
        return [row.tobytes() for row in out]

    @classmethod
    def decoded(cls, fingerprints: list[str]) -> Sketches:
        cells = [np.frombuffer(base64.b64decode(f), _CELL) for f in fingerprints]
        table = np.stack(cells) if cells else np.zeros((0, CELLS), _CELL)
        return cls(table["count"].astype(np.int64), table["keys"].copy(), table["checks"].copy())


def cells_of(digest: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each digest in each of the three rows; other sizes have other functions."""
    width = np.uint64(cells // 3)
    seeds = [np.uint64((3 * cells + j) * 0x9E3779B97F4A7C15 % 2**64) for j in range(3)]
    return [(mixed(digest + s) % width).astype(np.int64) + j * cells // 3 for j, s in enumerate(seeds)]


@dataclass
class Differences:
    """Paragraph digests of one side only, ``sign`` 1 for left and -1 for right, by pair."""

    owner: np.ndarray
    digest: np.ndarray
    sign: np.ndarray
    cells: np.ndarray

    def counts(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.bincount(self.owner[self.sign == s], minlength=n) for s in (1, -1))


def differences(
    left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n: int, cells: int = CELLS
) -> Differences:
    """What the left and the right version of n pairs don't share, by sketches that suffice for it.

    ``cells`` of the result says how many cells each pair took.
    """
    sizes = np.full(n, cells)
    done = [], [], []
    pending = np.arange(n)
    while len(pending):
        again, tried = [], sizes[pending]
        for size in np.unique(tried):
            rows = pending[tried == size]
            step = max(1, CELLS_AT_ONCE // size)
            for part in (rows[a : a + step] for a in range(0, len(rows), step)):
                sides = [Sketches.of(*_of_rows(*side, part), len(part), size) for side in (left, right)]
                rest = sides[0] - sides[1]
                guess = rest.guess()
                owner, digest, sign, failed = rest.peel()
                fine = ~failed[owner]
                for values, new in zip(done, (part[owner[fine]], digest[fine], sign[fine])):
                    values.append(new)
                wanted = 3 * 2.0 ** np.ceil(np.log2(np.maximum(guess, 1) * 1.5 / 3))
                sizes[part[failed]] = np.maximum(2 * size, wanted[failed])
                again.append(part[failed])
        pending = np.concatenate(again)
    empty = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return Differences(*(np.concatenate([e, *d]) for e, d in zip(empty, done)), sizes)


def _of_rows(owner: np.ndarray, digest: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The elements of some rows (ascending), which are numbered anew."""
    a, b = np.searchsorted(owner, rows), np.searchsorted(owner, rows, "right")
    sizes = b - a
    at = np.arange(sizes.sum()) + np.repeat(a - (np.cumsum(sizes) - sizes), sizes)
    return np.repeat(np.arange(len(rows)), sizes), digest[at]


def likeness(left: np.ndarray, right: np.ndarray, found: Differences) -> np.ndarray:
    """Common paragraphs over all distinct ones, of pairs with so many on each side."""
    only_left, only_right = found.counts(len(left))
    common = left - only_left
    every = common + only_left + only_right
    return np.where(every > 0, common / np.maximum(every, 1), 1.0)


def fingerprint_difference(left: str, right: str) -> tuple[set[int], set[int]] | None:
    """Paragraph digests of one fingerprint only and of the other only, or None: too many for them."""
    rest = Sketches.decoded([left]) - Sketches.decoded([right])
    _, digest, sign, failed = rest.peel()
    return None if failed[0] else tuple({int(d) for d in digest[sign == s]} for s in (1, -1))


def compare_versions(
    df: DataFrame, left_col: str, right_col: str, cells: int = CELLS, max_words: int = MAX_WORDS
) -> DataFrame:
    """All columns and ``versions``: both fingerprints, likeness, cells taken, digests of each side only."""
    pattern, name = paragraph_pattern(max_words), fresh_name(df, "versions")
    kind = (
        "left_fingerprint string, right_fingerprint string, likeness double, cells int, "
        "only_left array<long>, only_right array<long>"
    )

    @F.arrow_udf(f"struct<{kind}>")
    def compare(left: pa.Array, right: pa.Array) -> pa.Array:
        n = len(left)
        sides = [elements([t or "" for t in side.to_pylist()], pattern) for side in (left, right)]
        found = differences(*sides, n, cells)
        sizes = [np.bincount(owner, minlength=n) for owner, _ in sides]
        marks = [
            [base64.b64encode(x).decode() for x in Sketches.of(*side, n, cells).encoded()] for side in sides
        ]
        only = []
        for s in (1, -1):
            owner, digest = found.owner[found.sign == s], found.digest[found.sign == s]
            order = np.lexsort((digest.view(np.int64), owner))
            ends = np.cumsum(np.bincount(owner, minlength=n))
            offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
            only.append(pa.ListArray.from_arrays(offsets, pa.array(digest[order].view(np.int64))))
        columns = [
            pa.array(marks[0]),
            pa.array(marks[1]),
            pa.array(likeness(*sizes, found)),
            pa.array(found.cells.astype(np.int32)),
            *only,
        ]
        names = [part.split()[0] for part in kind.split(", ")]
        return pa.StructArray.from_arrays(columns, names=names)

    return df.withColumn(name, compare(df[left_col], df[right_col]))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: As stored: digests and sketches in bytes, the result has them in hexadecimal digits and base 64.
STORED = (
    "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
_NAMES = [part.split()[0] for part in STORED.split(", ")]


def _compared(own: list[str], following: list[str], cells: int, pattern: re.Pattern) -> list[pa.Array]:
    """The columns of STORED for texts and the ones that follow them."""
    n, changed = len(own), [edited(a, b) for a, b in zip(own, following)]
    sides = [elements(side, pattern) for side in (own, changed, following)]
    sizes = [np.bincount(owner, minlength=n) for owner, _ in sides]
    near = [likeness(sizes[0], sizes[i], differences(sides[0], sides[i], n, cells)) for i in (1, 2)]
    marks = [Sketches.of(*side, n, cells).encoded() for side in sides[:2]]
    digests = [hashlib.sha256(t.encode()).digest() for t in changed]
    lengths = pa.array([len(t) for t in own], pa.int64())
    return [lengths, *map(pa.array, (digests, *marks, *near))]


def fingerprints(
    df: DataFrame,
    workspace: Workspace,
    cells: int = CELLS,
    max_words: int = MAX_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id`` and the columns of STORED, as text where these are bytes: each text against its edited text and the next document.

    The next document is that with the next smaller id; after the smallest comes the largest. Texts
    are sorted once, in ranges of ids. A range's last text waits for the next range's first: these,
    two texts of a range, are stored apart and meet in a join.
    """
    pattern = paragraph_pattern(max_words)
    docs = texts(df, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    order = F.desc_nulls_last("doc_id"), F.desc("tie")
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, own = batch["doc_id"], batch["text"].to_pylist()
            if before is None:
                yield _row(ids.slice(0, 1), None, part, "first", own[0])
            else:
                ids, own = pa.concat_arrays([before[0], ids]), [before[1], *own]
            if len(own) > 1:
                columns = _compared(own[:-1], own[1:], cells, pattern)
                yield _row(ids.slice(0, len(own) - 1), columns, part, None, None)
            before = ids.slice(len(own) - 1, 1), own[-1]
        if before is not None:
            yield _row(before[0], None, part, "last", before[1])

    schema = f"doc_id {kind}, {STORED}, part int, role string, text string"
    found = workspace.store(map_batches(ranged, run, schema), "versions")
    # Ranges ascend with the numbers of their tasks: what a range's last text waits for is the first
    # of the next range that has rows. There are as many as the sort had tasks.
    ends = found.filter(F.col("role").isNotNull())
    parts = sorted(r["part"] for r in ends.filter(F.col("role") == "last").select("part").collect())
    follows = list(zip(parts, parts[1:] + parts[:1]))
    pairs = df.sparkSession.createDataFrame(follows, "part int, next int")
    last = ends.filter(F.col("role") == "last").select("doc_id", "part", "text")
    first = ends.filter(F.col("role") == "first")
    first = first.select(F.col("part").alias("next"), F.col("text").alias("following"))
    waiting = last.join(pairs, "part").join(first, "next").select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, following = (batch[c].to_pylist() for c in ("text", "following"))
            columns = _compared(own, following, cells, pattern)
            yield pa.record_batch([batch["doc_id"], *columns], ["doc_id", *_NAMES])

    finished = map_batches(waiting, finish, f"doc_id {kind}, {STORED}")
    every = found.filter(F.col("role").isNull()).select("doc_id", *_NAMES).unionByName(finished)
    # Spark breaks base 64 into lines.
    marks = {c: F.translate(F.base64(c), "\r\n", "") for c in ("fingerprint", "edited_fingerprint")}
    return every.withColumns({"edited_sha256": F.lower(F.hex("edited_sha256")), **marks})


def _row(ids: pa.Array, columns: list[pa.Array] | None, part: int, role: str | None, text: str | None):
    n = len(ids)
    types = [pa.int64(), *[pa.binary()] * 3, *[pa.float64()] * 2]
    columns = columns or [pa.nulls(n, t) for t in types]
    tail = [pa.array([x] * n, t) for x, t in ((part, pa.int32()), (role, pa.string()), (text, pa.string()))]
    return pa.record_batch([ids, *columns, *tail], ["doc_id", *_NAMES, "part", "role", "text"])
