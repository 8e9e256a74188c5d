"""Benchmark decontamination by greedy string tiling (operator 10).

Rolling grams of ``min_tile`` words (all words of a shorter item) of documents and benchmark items are
joined. A pair is a candidate if the grams that it shares can cover as many item words as the threshold asks for.
For candidates, the longest matches of still unmarked words are marked, longest first, until none of ``min_tile`` words
is left: running Karp-Rabin finds the equal windows, neighbouring ones on a diagonal are one match, and what
marking leaves of a match is a match again. The share of marked item words is the coverage. Since tiles may stand
in any order, a passage with reordered pieces is caught as well.

Words are runs of digits, of a-z after lower-casing A-Z, and of characters beyond ASCII. An item of fewer than
``min_tile`` words is one tile: it is found where it stands as a whole.

A document sends each of its shared grams once per place, whatever an item repeats, so a pair holds no
more than the document's words and the item's. Matches take the product of a gram's places in both.

Defined results: null and empty texts match nothing; a null ``doc_id`` is reported as null; rows
repeated with the same id and text are reported once; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.rolling import exploded, hash_table, rolling_grams

#: Words of the shortest tile, and the share of an item that tiles must cover.
MIN_TILE = 3
MIN_COVERAGE = 0.8
#: Benchmarks of up to so many grams (some 100 MB at most) are broadcast, and documents' grams
#: without a partner are left out of the join; larger benchmarks take a shuffle join of all grams.
MAX_BROADCAST_WORDS = 1_000_000

_BASE, _MOD = 1_000_003, (1 << 61) - 1


def _windows(tokens: list[str | None], length: int):
    """Position and Karp-Rabin hash of every window without a marked or missing token."""
    lead = pow(_BASE, length - 1, _MOD)
    value = run = 0
    for at, token in enumerate(tokens):
        if token is None:
            value = run = 0
            continue
        if run == length:
            value = (value - hash(tokens[at - length]) * lead) % _MOD
            run -= 1
        value = (value * _BASE + hash(token)) % _MOD
        run += 1
        if run == length:
            yield at - length + 1, value


def _matches(doc: list, item: list, length: int) -> np.ndarray:
    """Longest matches, rows of (words, doc position, item position): runs of equal windows on a diagonal."""
    table: dict[int, list[int]] = {}
    for at, value in _windows(item, length):
        table.setdefault(value, []).append(at)
    hits = [(at, table[value]) for at, value in _windows(doc, length) if value in table]
    if not hits:
        return np.zeros((0, 3), np.int64)
    at = np.repeat([a for a, _ in hits], [len(others) for _, others in hits])
    other = np.concatenate([others for _, others in hits])
    # Equal hashes are candidates: the words decide.
    number: dict = {}
    sides = [np.array([number.setdefault(t, len(number)) for t in side]) for side in (doc, item)]
    same = np.all([sides[0][at + k] == sides[1][other + k] for k in range(length)], axis=0)
    at, other = at[same], other[same]
    order = np.lexsort((at, at - other))
    at, other = at[order], other[order]
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(at) != 1) | (np.diff(other) != 1)
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(at))) + length - 1
    return np.stack([sizes, at[starts], other[starts]], axis=1)


def greedy_tiles(doc: list, item: list, min_tile: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles (words, doc position, item position), longest first; ``None`` never matches.

    Of equal matches that which stands first in the document, then in the item, is marked.
    """
    free = np.array([t is not None for t in doc], bool), np.array([t is not None for t in item], bool)
    left, tiles = int(free[1].sum()), []
    queue = [(-n, a, b) for n, a, b in _matches(doc, item, min_tile).tolist()]
    heapq.heapify(queue)
    while queue and left >= min_tile:
        n, a, b = heapq.heappop(queue)
        n = -n
        unmarked = free[0][a : a + n] & free[1][b : b + n]
        if unmarked.all():
            free[0][a : a + n] = free[1][b : b + n] = False
            left -= n
            tiles.append((n, a, b))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([False], unmarked, [False]))))
        for start, stop in edges.reshape(-1, 2).tolist():
            if stop - start >= min_tile:
                heapq.heappush(queue, (start - stop, a + start, b + start))
    return tiles


def _spread(grams: list[tuple[int, str]]) -> list[str | None]:
    """The words of grams at their positions, gaps closed up with a missing word in between."""
    words: dict[int, str] = {}
    for position, gram in grams:
        for k, word in enumerate(gram.split(" ")):
            words[position + k] = word
    out: list[str | None] = []
    last = None
    for at in sorted(words):
        if last is not None and at > last + 1:
            out.append(None)
        out.append(words[at])
        last = at
    return out


def _tile_shared(doc: list, item: list, min_tile: int, need: int) -> tuple[int, int]:
    """Marked item words and number of tiles, from the document's shared grams and all of the item's.

    Only words inside shared grams can be in a tile. Where they are fewer than ``need``, none is looked for.
    """
    shared = {gram for _, gram in doc}
    item = [(at, gram) for at, gram in item if gram in shared]
    if len({at + k for at, _ in item for k in range(min_tile)}) < need:
        return 0, 0
    tiles = greedy_tiles(_spread(doc), _spread(item), min_tile)
    return sum(n for n, _, _ in tiles), len(tiles)


def contaminated(
    df: DataFrame,
    items: DataFrame,
    min_coverage: float = MIN_COVERAGE,
    min_tile: int = MIN_TILE,
    max_broadcast_words: int = MAX_BROADCAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``key, doc_id, item_id, n_item_words, n_covered, coverage, n_tiles`` per contaminated pair.

    ``key`` is ``row_key`` of the document's id and text.
    """
    items = items.dropDuplicates([item_id_col, item_text_col])
    n_words = rolling_grams(items, 1, None, item_id_col, item_text_col).select("n_words").filter("n_words > 0")
    tiles = n_words.select(F.least("n_words", F.lit(min_tile)).alias("tile")).distinct()
    found = []
    # One pass, and one more for each length of items shorter than a tile.
    for tile in sorted({min_tile} | {r["tile"] for r in tiles.collect()}):
        grams = exploded(rolling_grams(items, tile, None, item_id_col, item_text_col)).select(
            F.col("doc_id").alias("item_id"),
            F.col("key").alias("item_key"),
            F.col("n_words").alias("n_item_words"),
            F.col("position").alias("at"),
            F.col("hash").alias("item_hash"),
            F.col("gram").alias("item_gram"),
        )
        if tile < min_tile:
            grams = grams.filter(F.col("n_item_words") == tile)
        found.append(_covered(df, grams, tile, min_coverage, max_broadcast_words, id_col, text_col))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def _covered(
    df: DataFrame,
    item_grams: DataFrame,
    tile: int,
    min_coverage: float,
    max_broadcast_words: int,
    id_col: str,
    text_col: str,
) -> DataFrame:
    """:func:`contaminated` for items whose tiles have ``tile`` words at least, by their grams."""
    small = item_grams.count() <= max_broadcast_words
    known = None
    if small:
        hashes = item_grams.select("item_hash").distinct().toPandas()["item_hash"]
        known = hash_table(hashes.to_numpy())
    item = "item_key", "item_id", "n_item_words"
    places = item_grams.groupBy(*item, "item_hash", "item_gram").agg(F.count("*").alias("n_places"))
    lists = item_grams.groupBy("item_key").agg(F.collect_list(F.struct("at", "item_gram")).alias("item_list"))
    if small:
        places, lists = F.broadcast(places), F.broadcast(lists)
    rolled = exploded(rolling_grams(df, tile, known, id_col, text_col))
    same = (F.col("hash") == F.col("item_hash")) & (F.col("gram") == F.col("item_gram"))
    pairs = rolled.join(places, same).groupBy("key", "item_key").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("item_id").alias("item_id"),
        F.first("n_item_words").alias("n_item_words"),
        F.collect_set(F.struct("position", "gram")).alias("shared"),
        F.collect_set(F.struct("gram", "n_places")).alias("grams"),
    )
    need = F.ceil(F.col("n_item_words") * F.lit(float(min_coverage)))
    # A shared gram covers its own words at each of its places: more can't be covered.
    most = F.aggregate("grams", F.lit(0).cast("long"), lambda n, g: n + g["n_places"]) * tile
    pairs = pairs.filter(most >= need).drop("grams").join(lists, "item_key")

    @F.pandas_udf("n_covered long, n_tiles long")
    def tiled(shared: pd.Series, item_list: pd.Series, need: pd.Series) -> pd.DataFrame:
        rows = [
            _tile_shared(
                [(s["position"], s["gram"]) for s in doc],
                [(s["at"], s["item_gram"]) for s in item],
                tile,
                least,
            )
            for doc, item, least in zip(shared, item_list, need)
        ]
        return pd.DataFrame(rows, columns=["n_covered", "n_tiles"], dtype="int64")

    return (
        pairs.withColumn("t", tiled("shared", "item_list", need))
        .select(
            "key",
            "doc_id",
            "item_id",
            F.col("n_item_words").cast("long").alias("n_item_words"),
            F.col("t.n_covered").alias("n_covered"),
            (F.col("t.n_covered") / F.col("n_item_words")).alias("coverage"),
            F.col("t.n_tiles").alias("n_tiles"),
        )
        .filter(F.col("n_covered") >= need)
    )
