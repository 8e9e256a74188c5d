"""SimHash near-duplicates by bit-sliced comparison (operator 7).

A fingerprint has a bit for each of the 64 places of a shingle's hash, set if more than half of
the text's shingles have it set. Distinct fingerprints are dealt into buckets by every pair of
five bit blocks: two fingerprints at three differing bits or fewer agree in two blocks at least,
so they meet. Inside a bucket the fingerprints are stored as bit planes, 64 lanes to a word. A
query is compared with a whole word of lanes at a time: the differing bits of each plane are added
to two carry-save counter bits with a sticky overflow, and a word of lanes is abandoned once every
lane has overflowed. A bucket yields a spanning forest of its links, never all pairs, and the
forests are joined to components by alternating star contraction over stored tables.

A bucket of more than ``MAX_BUCKET`` fingerprints is cut into chunks, and every two chunks meet in
a task of their own, so no bucket is left to one task and no link is lost.

Defined results: a null text counts as empty and has the fingerprint zero; fewer words than a
shingle make one shingle; a null id never is a component's smallest id, and a component without
any other id is null; repeated rows each get a row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Workspace, map_batches, row_key, texts

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
MAX_BUCKET = 16_384
#: (query, word of lanes) combinations that are compared at once, and fingerprints that are
#: gathered before they are compared.
STEP = 1 << 18
GATHER = 1 << 16

_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, length: int = SHINGLE_WORDS) -> int:
    """SimHash of the XXH64 values (seed 42) of all shingles, repeats included."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode().lower().split()  # bytes: A-Z only, and only the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= length:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    stops = (ends - 1).tolist()[length - 1 :]
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(majority).tobytes(), "big")


def fingerprints(
    df: DataFrame,
    length: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, key, bits`` per row; ``bits`` is the fingerprint as a signed long."""
    docs = texts(df, id_col, text_col).withColumn("key", row_key())
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(text.as_py(), length) for text in batch.column("text")]
            bits = pa.array(np.array(made, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), bits], ["doc_id", "key", "bits"]
            )

    return map_batches(docs, stage, f"doc_id {id_type}, key binary, bits long")


def block_masks(radius: int = RADIUS) -> list[int]:
    """Masks of the bucket keys: all choices of two of ``radius + 2`` blocks of the 64 bits."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int).tolist()
    parts = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(parts, 2)]


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 planes of the values' bits; value n is lane n % 64 of word n // 64."""
    words = -(-len(values) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[: len(values)] = values
    raw = padded.astype("<u8").view(np.uint8).reshape(-1, 8)
    lanes = np.unpackbits(raw, axis=1, bitorder="little").T
    planes = np.packbits(np.ascontiguousarray(lanes), axis=1, bitorder="little")
    return planes.view("<u8").astype(np.uint64)


def close_lanes(
    planes: np.ndarray, queries: np.ndarray, words: np.ndarray, radius: int = RADIUS
) -> tuple[np.ndarray, np.ndarray]:
    """Which (query, word) combinations have lanes within the radius, and which lanes those are.

    A lane's distance is held in carry-save counter bits; what is carried out of the last is
    sticky. Combinations in which all lanes are beyond the radius are dropped after every plane
    that can finish one.
    """
    n_bits = radius.bit_length()
    if radius != (1 << n_bits) - 1:
        raise ValueError("The radius must be one less than a power of two.")
    alive = np.arange(len(queries))
    counters = [np.zeros(len(queries), np.uint64) for _ in range(n_bits)]
    beyond = np.zeros(len(queries), np.uint64)
    query, word = queries, words
    for place in range(64):
        wanted = np.uint64(0) - ((query >> np.uint64(place)) & np.uint64(1))
        carry = planes[place][word] ^ wanted
        for k, counter in enumerate(counters):
            counters[k], carry = counter ^ carry, counter & carry
        beyond = beyond | carry
        if place >= 12 and place % 4 == 0:
            keep = beyond != _ONES
            if keep.sum() < 0.9 * len(keep):
                alive, query, word, beyond = alive[keep], query[keep], word[keep], beyond[keep]
                counters = [c[keep] for c in counters]
        if not len(alive):
            break
    near = ~beyond
    found = near != 0
    return alive[found], near[found]


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        above = parent[parent]
        if np.array_equal(above, parent):
            return parent
        parent = above


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest index reached) after linking a[i] with b[i]."""
    while True:
        parent = _roots(parent)
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def forest(values: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Links (pairs of indices) that connect what chains of close values connect in a group.

    ``group`` is sorted: the group's number of each value. Lanes of other groups that share a word
    may link as well; their distance is as real.
    """
    n = len(values)
    planes = bit_planes(values)
    ends = np.searchsorted(group, group, "right")
    # Each value is compared with the words from its own to its group's last.
    first, last = np.arange(n) // 64, (ends - 1) // 64
    counts = last - first + 1
    parent = np.arange(n)
    at = 0
    totals = np.cumsum(counts)
    while at < n:
        done = totals[at - 1] if at else 0
        stop = max(int(np.searchsorted(totals, done + STEP, "right")), at + 1)
        index = np.repeat(np.arange(at, stop), counts[at:stop])
        offset = np.arange(len(index)) - np.repeat(totals[at:stop] - counts[at:stop] - done, counts[at:stop])
        words = first[index] + offset
        hits, near = close_lanes(planes, values[index], words, radius)
        for lane in range(64):
            has = (near >> np.uint64(lane)) & np.uint64(1) != 0
            other = words[hits[has]] * 64 + lane
            own = index[hits[has]]
            real = (other < n) & (other > own)
            if real.any():
                parent = _union(parent, own[real], other[real])
        at = stop
    parent = _roots(parent)
    linked = np.flatnonzero(parent != np.arange(n))
    return np.stack([parent[linked], linked], axis=1)


def bucket_links(distinct: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``a, b`` (a < b as longs): links that connect the distinct fingerprints in each bucket."""
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in block_masks(radius)]
    entry = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("round"), F.col("bits").bitwiseAND(F.lit(m)).alias("bucket"))
                for n, m in enumerate(masks)
            ]
        )
    )
    entries = distinct.select("bits", entry.alias("e")).select("bits", "e.round", "e.bucket")
    large = entries.groupBy("round", "bucket").agg(F.count("*").alias("n")).filter(F.col("n") > max_bucket)
    chunks = F.ceil(F.col("n") / F.lit(max_bucket)).cast("int")
    entries = entries.join(large, ["round", "bucket"], "left").withColumn(
        "chunks", F.coalesce(chunks, F.lit(1))
    )
    own = F.pmod(F.xxhash64("bits"), F.col("chunks")).cast("int")
    others = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("chunks") - 1)
    )
    entries = entries.select("bits", "round", "bucket", own.alias("own"), F.explode(others).alias("o"))
    dealt = entries.select(
        "bits", F.xxhash64("round", "bucket", F.least("own", "o"), F.greatest("own", "o")).alias("group")
    )

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, group = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def links(values: np.ndarray, groups: np.ndarray) -> pa.RecordBatch:
            pairs = values[forest(values, groups, radius)].reshape(-1, 2).view(np.int64)
            pairs = np.sort(pairs, axis=1)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"]
            )

        for batch in batches:
            bits = np.concatenate([bits, np.asarray(batch.column("bits")).view(np.uint64)])
            group = np.concatenate([group, np.asarray(batch.column("group"))])
            if len(bits) >= GATHER:  # all groups but the last are whole
                cut = int(np.searchsorted(group, group[-1], "left"))
                if cut:
                    yield links(bits[:cut], group[:cut])
                    bits, group = bits[cut:], group[cut:]
        yield links(bits, group)

    sorted_groups = dealt.repartition("group").sortWithinPartitions("group")
    return map_batches(sorted_groups, stage, "a long, b long").distinct()


def components(links: DataFrame, workspace: Workspace) -> DataFrame:
    """``node, root`` of all nodes with a link: the smallest node that chains of links reach.

    Large-star and small-star steps alternate until nothing changes; each pair of steps is a
    stored table, so the plan doesn't grow and a lost executor costs one step.
    """
    links = workspace.store(links.select("a", "b").filter("a <> b"), "links")
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(low, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select("e.a", F.col("e.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        after = workspace.store(small, "links")
        moved = after.join(links, (after["a"] == links["a"]) & (after["b"] == links["b"]), "left_anti")
        gone = links.join(after, (after["a"] == links["a"]) & (after["b"] == links["b"]), "left_anti")
        settled = moved.isEmpty() and gone.isEmpty()
        links = after
        if settled:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    df: DataFrame,
    length: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    max_bucket: int = MAX_BUCKET,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """``doc_id, key, bits, root, component_id`` per row.

    The id is the smallest ``doc_id`` reachable; ``root``, a fingerprint, tells components apart
    whatever their ids.
    """
    workspace = workspace or Workspace(df.sparkSession)
    marked = workspace.store(fingerprints(df, length, id_col, text_col), "fingerprints")
    classes = workspace.store(
        marked.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes"
    )
    roots = components(bucket_links(classes.select("bits"), radius, max_bucket), workspace)
    rooted = classes.join(roots, classes["bits"] == roots["node"], "left").select(
        "bits", "first_id", F.coalesce("root", "bits").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = rooted.join(smallest, "root").select("bits", "root", "component_id")
    return marked.join(of_class, "bits").select("doc_id", "key", "bits", "root", "component_id")


def as_hex(bits: Column | str) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
