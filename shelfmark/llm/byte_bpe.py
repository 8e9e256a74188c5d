"""Byte-level BPE encoding and decoding by DuckDB recursive queries in each partition (operator 8).

A task splits its texts by the vocabulary's pattern and sends the distinct pieces it hasn't met to
an in-memory DuckDB connection of its own. There, each piece is a set of token-position rows. A
recursive query joins neighbouring rows to the merge table and contracts every piece's leftmost
pair of minimum rank until no pair is in the table; an ordered aggregation over the positions
gives the ids, another over the tokens' bytes decodes them. A piece that is a token itself is that
token. Texts are put together from their pieces.

Defined results: a null text counts as empty and has no ids; rows are independent, so repeated
rows and null ids each get a row; an empty table gives an empty result; other columns are ignored.
A long piece is first cut where no token has its two neighbouring bytes side by side, which no
merge can cross. A recursive query takes a step per pair and so time in the square of a part's length; the few
parts of more than ``LONG_BYTES`` bytes that no cut divides (runs of one letter or sign) are contracted
with a heap of pairs instead, in n log n steps, to the same tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from shelfmark.functions.bytelevel import merged
from shelfmark.llm.common import map_batches, texts

#: Pieces of one generation (some 200 MB). A worker remembers two: when one is full, the older of
#: the two goes, but for the pieces that came up again meanwhile.
MEMO_PIECES = 650_000
#: Characters of text whose pieces are held at once, pieces per recursive query, and contractions
#: per recursive query, which bound the rows it gathers.
BLOCK_CHARS = 4_000_000
QUERY_PIECES = 50_000
QUERY_STEPS = 24
#: Pieces of more bytes are cut first, and parts of more bytes are left to the heap.
LONG_BYTES = 48
#: Bytes of the parts that a recursive query takes together.
QUERY_BYTES = 400_000
#: Pairs that the heap has met and a worker keeps at hand.
KEPT_PAIRS = 20_000

#: A candidate's key orders by rank, then by place, and says how many bytes its left token and the
#: merged one have: 19, 28, 8 and 8 bits.
_KEY = "m.high + t.pos::BIGINT * 65536 + t.size * 256 + m.size AS key"
_STEPS = f"""
WITH RECURSIVE step AS (
    SELECT * FROM (
        WITH t AS (SELECT 0 AS n, piece, pos, size, id FROM state), {{paired}}
    )
    UNION ALL
    SELECT * FROM (
        WITH t AS MATERIALIZED (
            SELECT n + 1 AS n, piece, pos,
                CASE WHEN key = best THEN best & 255 ELSE size END AS size,
                CASE WHEN key = best THEN (best >> 44)::INTEGER ELSE id END AS id
            FROM step
            WHERE best IS NOT NULL AND n < {QUERY_STEPS}
                AND pos <> ((best >> 16) & 268435455) + ((best >> 8) & 255)
        ), {{paired}}
    )
)
SELECT piece, pos, size, id, best IS NOT NULL AS open FROM step
WHERE best IS NULL OR n = {QUERY_STEPS}
""".format(
    paired=f"""
        pairs AS MATERIALIZED (
            SELECT t.n, t.piece, t.pos, t.size, t.id, {_KEY} FROM t
            LEFT JOIN t f ON f.pos = t.pos + t.size AND f.piece = t.piece
            LEFT JOIN merges m ON m.first = t.id AND m.second = f.id
        )
        SELECT pairs.*, least.best FROM pairs
        JOIN (SELECT piece, min(key) AS best FROM pairs GROUP BY piece) least USING (piece)"""
)

# One thread aggregates rows in the order that they come in; each piece's bytes are compared with
# what it was made of.
_DECODE = """
SELECT piece, string_agg(text, ' ') AS ids, unhex(string_agg(hexed, '')) AS decoded
FROM (SELECT piece, text, hexed FROM final JOIN tokens USING (id) ORDER BY piece, pos)
GROUP BY piece
"""


@dataclass(frozen=True)
class RankFile:
    """A file of ``base64-token rank`` lines and the pattern that splits texts into pieces."""

    path: str
    pattern: str

    def tokens(self) -> dict[bytes, int]:
        with open(self.path, "rb") as file:
            rows = (line.split() for line in file if line.strip())
            return {base64.b64decode(token): int(rank) for token, rank in rows}


class MergeTable:
    """The merge table as sorted arrays, a few bytes a pair, for the heap; pairs met are kept at hand."""

    def __init__(self, pairs: pa.Table):
        first, second, rank = (pairs[c].to_numpy().astype(np.int64) for c in ("first", "second", "merged"))
        keys = first << 32 | second
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], rank[order]
        self.seen: dict[tuple[int, int], tuple[int, int] | None] = {}

    def get(self, pair: tuple[int, int]) -> tuple[int, int] | None:
        """Rank and merged token, which are the same here."""
        if pair not in self.seen:
            if len(self.seen) >= KEPT_PAIRS:
                self.seen.clear()
            key = pair[0] << 32 | pair[1]
            at = int(np.searchsorted(self.keys, key))
            found = at < len(self.keys) and int(self.keys[at]) == key
            self.seen[pair] = (int(self.ranks[at]),) * 2 if found else None
        return self.seen[pair]


class PieceCoder:
    """Encodes and decodes pieces in a DuckDB connection that only this object sees."""

    def __init__(self, tokens: dict[bytes, int]):
        import duckdb

        if max(tokens.values()) >= 1 << 19 or max(map(len, tokens)) > 255:
            raise ValueError("Keys hold ranks below 524,288 and tokens of 255 bytes at most.")
        self.tokens = tokens
        self.single = np.array([tokens.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.con = duckdb.connect(":memory:")
        self.con.execute("SET threads = 1")
        self.con.execute("SET memory_limit = '300MB'")
        self.con.execute("SET temp_directory = ''")
        listed = pa.table(
            {
                "id": pa.array(tokens.values(), pa.int32()),
                "bytes": pa.array(tokens.keys(), pa.binary()),
            }
        )
        self.con.register("listed", listed)
        self.con.execute(
            "CREATE TABLE tokens AS SELECT id, id::VARCHAR AS text, hex(bytes) AS hexed, "
            "octet_length(bytes)::BIGINT AS size FROM listed"
        )
        pairs = self._pairs()
        self.con.register("pairs", pairs)
        self.merges, self.bytes_of = MergeTable(pairs), {}
        self.con.execute(
            "CREATE TABLE merges AS SELECT first, second, merged::BIGINT * 17592186044416 AS high, "
            "size FROM pairs JOIN tokens ON id = merged"
        )
        self.together = np.zeros((256, 256), bool)
        for token in tokens:
            raw = np.frombuffer(token, np.uint8)
            self.together[raw[:-1], raw[1:]] = True

    def _pairs(self) -> pa.Table:
        """The merge table: two tokens whose bytes, one after the other, are a token."""
        known = self.tokens
        rows = [
            (known[t[:cut]], known[t[cut:]], rank)
            for t, rank in known.items()
            for cut in range(1, len(t))
            if t[:cut] in known and t[cut:] in known
        ]
        names = ["first", "second", "merged"]
        table = np.array(rows, np.int32).reshape(-1, 3)
        return pa.table({name: table[:, k].copy() for k, name in enumerate(names)})

    def _parts(self, piece: bytes) -> list[bytes]:
        if len(piece) <= LONG_BYTES:
            return [piece]
        raw = np.frombuffer(piece, np.uint8)
        cuts = [0, *(np.flatnonzero(~self.together[raw[:-1], raw[1:]]) + 1).tolist(), len(raw)]
        return [piece[a:b] for a, b in zip(cuts, cuts[1:])]

    def code(self, pieces: list[str]) -> dict[str, tuple[str, bytes]]:
        """Of each piece: its ids joined by spaces, and the bytes they decode to."""
        raws = [piece.encode() for piece in pieces]
        whole = np.fromiter(map(self.tokens.__contains__, raws), bool, len(raws))
        if max(map(len, raws), default=0) <= LONG_BYTES:
            return dict(zip(pieces, self._contract(raws, whole)))
        cut = [[raw] if known else self._parts(raw) for raw, known in zip(raws, whole.tolist())]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        parts = [part for own in cut for part in own]
        coded = self._coded(parts, np.repeat(whole, sizes))
        out, at = {}, 0
        for piece, n in zip(pieces, sizes.tolist()):
            ids, decoded = zip(*coded[at : at + n])
            out[piece] = (" ".join(ids), b"".join(decoded))
            at += n
        return out

    def _coded(self, parts: list[bytes], whole: np.ndarray) -> list[tuple[str, bytes]]:
        """Ids and decoded bytes of each part, by queries of bounded size or, if long, by the heap."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        long = (sizes > LONG_BYTES) & ~whole
        out: list = [None] * len(parts)
        for i in np.flatnonzero(long):
            out[i] = self._heaped(parts[i])
        short = np.flatnonzero(~long)
        lots = (np.cumsum(sizes[short]) - sizes[short]) // QUERY_BYTES
        for own in np.split(short, np.flatnonzero(np.diff(lots)) + 1):
            if len(own):
                for i, coded in zip(own, self._contract([parts[i] for i in own], whole[own])):
                    out[i] = coded
        return out

    def _heaped(self, part: bytes) -> tuple[str, bytes]:
        ids = merged(self.single[np.frombuffer(part, np.uint8)].tolist(), self.merges)
        if not self.bytes_of:
            self.bytes_of = {i: t for t, i in self.tokens.items()}
        return " ".join(map(str, ids)), b"".join(map(self.bytes_of.__getitem__, ids))

    def _contract(self, parts: list[bytes], whole: np.ndarray) -> list[tuple[str, bytes]]:
        """Ids and decoded bytes of each part; those marked ``whole`` are tokens as they are."""
        raw = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.cumsum(sizes) - sizes
        loose = np.repeat(~whole, sizes)
        tokens = np.flatnonzero(whole)
        ranks = [self.tokens[parts[k]] for k in tokens.tolist()]
        piece = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        state = pa.table(
            {
                "piece": piece[loose],
                "pos": np.flatnonzero(loose).astype(np.int32),
                "id": self.single[raw[loose]],
                "size": np.ones(int(loose.sum()), np.int64),
            }
        )
        names = ["piece", "pos", "id"]
        done = [
            pa.table(
                {
                    "piece": tokens.astype(np.int32),
                    "pos": starts[tokens].astype(np.int32),
                    "id": np.array(ranks, np.int32),
                }
            )
        ]
        while state.num_rows:
            self.con.register("state", state)
            reached = self.con.sql(_STEPS).to_arrow_table()
            self.con.unregister("state")
            more = reached.column("open")
            state = reached.filter(more).select([*names, "size"])
            done.append(reached.filter(pc.invert(more)).select(names))
        self.con.register("final", pa.concat_tables(done))
        rows = self.con.sql(_DECODE).to_arrow_table().sort_by("piece")
        self.con.unregister("final")
        decoded = rows.column("decoded").to_pylist()
        if decoded != parts:
            raise RuntimeError("Decoding doesn't give the bytes that were encoded.")
        return list(zip(rows.column("ids").to_pylist(), decoded))


class Memo:
    """Coded pieces of the last two generations."""

    def __init__(self, coder: PieceCoder, limit: int):
        self.coder, self.limit = coder, limit
        self.now: dict[str, tuple[str, bytes]] = {}
        self.old: dict[str, tuple[str, bytes]] = {}

    def coded(self, pieces: list[str]) -> dict[str, tuple[str, bytes]]:
        """A dict that has all the pieces."""
        wanted = set(pieces)
        missing = wanted - self.now.keys()
        if len(self.now) + len(missing) > self.limit:
            self.now, self.old, missing = {}, self.now, wanted
        again = missing & self.old.keys()
        self.now.update(zip(again, map(self.old.__getitem__, again)))
        fresh = list(missing - again)
        for first in range(0, len(fresh), QUERY_PIECES):
            self.now.update(self.coder.code(fresh[first : first + QUERY_PIECES]))
        return self.now


_MEMOS: dict[tuple[str, int], Memo] = {}


def _memo(digest: str, tokens: dict[bytes, int], limit: int) -> Memo:
    """This worker's coder and memo of a vocabulary, kept between tasks."""
    if (digest, limit) not in _MEMOS:
        _MEMOS[digest, limit] = Memo(PieceCoder(tokens), limit)
    return _MEMOS[digest, limit]


def _blocks(column: pa.Array, limit: int) -> Iterator[list[str]]:
    block, size = [], 0
    for scalar in column:
        value = scalar.as_py()
        if block and size + len(value) > limit:
            yield block
            block, size = [], 0
        block.append(value)
        size += len(value)
    if block:
        yield block


def encode(
    df: DataFrame,
    vocabulary: RankFile,
    keep_ids: bool = True,
    keep_decoded: bool = True,
    memo_pieces: int = MEMO_PIECES,
    block_chars: int = BLOCK_CHARS,
    keep_coder: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked, ``ids`` and ``decoded``.

    The digests are of the decimal ids joined by one space and of the decoded bytes.
    ``memo_pieces`` and ``block_chars`` trade a worker's memory for time and change no result, as does
    ``keep_coder``: without it a worker frees its connection and memo at a task's end, so that idle
    workers hold nothing and a task makes them anew.
    """
    docs = texts(df, id_col, text_col)
    tokens = vocabulary.tokens()
    digest = hashlib.sha256(repr(sorted(tokens.items())).encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""
    schema += ", decoded binary" if keep_decoded else ""

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(digest, shared.value, memo_pieces)
        try:
            yield from encoded(batches, memo)
        finally:
            if not keep_coder:
                del _MEMOS[digest, memo_pieces]
                memo.coder.con.close()

    def encoded(batches: Iterator[pa.RecordBatch], memo: Memo) -> Iterator[pa.RecordBatch]:
        import regex

        pattern = regex.compile(vocabulary.pattern)
        for batch in batches:
            at = 0
            for block in _blocks(batch.column("text"), block_chars):
                rows = [pattern.findall(text) for text in block]
                joined, raws, *made = _put_together(rows, memo)
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    ids = [np.array(own.split(), np.int32) for own in joined.to_pylist()]
                    made.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                if keep_decoded:
                    made.append(raws)
                    names.append("decoded")
                doc_ids = batch.column("doc_id").slice(at, len(block))
                at += len(block)
                yield pa.RecordBatch.from_arrays([doc_ids, *made], names)

    return map_batches(docs, stage, schema)


def _put_together(rows: list[list[str]], memo: Memo) -> list[pa.Array]:
    """Joined ids and decoded bytes of each row of pieces, number of tokens, and both digests."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = pa.array(list(chain.from_iterable(rows)), pa.string()).dictionary_encode()
    distinct = flat.dictionary.to_pylist()
    coded = memo.coded(distinct)
    ids, decoded = zip(*map(coded.__getitem__, distinct)) if distinct else ((), ())
    starts = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))

    def joined(values: tuple, kind: pa.DataType, between) -> pa.Array:
        taken = pa.array(values, kind).take(flat.indices)
        return pc.binary_join(pa.ListArray.from_arrays(starts, taken), between)

    texts_of_ids = joined(ids, pa.string(), " ")
    raws = joined(decoded, pa.binary(), pa.scalar(b"", pa.binary()))
    each = np.fromiter((i.count(" ") + 1 for i in ids), np.int64, len(ids))
    total = np.concatenate([[0], np.cumsum(each[flat.indices.to_numpy()])])
    ends = np.cumsum(sizes)
    n_tokens = total[ends] - total[ends - sizes]
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in texts_of_ids.to_pylist()]
    raw_digests = [hashlib.sha256(r).hexdigest() for r in raws.to_pylist()]
    return [texts_of_ids, raws, *map(pa.array, (n_tokens, digests, raw_digests))]
