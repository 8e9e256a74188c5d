"""Removal of repeated byte strings by interval expansion on a suffix order (operator 6).

Every byte covered by a string of ``length`` bytes that also starts earlier in the corpus (in a
smaller id, or further left) is removed. No one task can order all suffixes of a corpus, so equal
strings are first brought together:

1. Each window of ``length`` bytes picks an anchor, its leftmost gram of smallest hash. Equal
   windows pick equal anchors at equal offsets. Neighbouring windows with one anchor form a run;
   the bytes of a run are its context.
2. Runs with equal anchors *and* contexts are one class with a first place; all windows of its other
   places start earlier. Classes are formed by partial aggregation, so groups of copies meet as
   counts. A bit table of the anchors that occur twice keeps the others out of all shuffles.
3. Where an anchor has several contexts, the first place of each is fetched from its text, and a task
   orders all suffixes of its contexts. On the Burrows-Wheeler transform of that order, interval
   boundaries spread by backward extension, breadth first: after step n, the neighbours whose
   common prefix is shorter than n are apart. It stops at ``length``: what is still together
   shares a window. An anchor with very many contexts is cut into chunks; the chunks' first windows
   then meet by their digests.

Classes are told apart by the anchor's and the context's 64-bit hash, the texts of rows that share an
id by two independent ones, the windows of step 3 by their bytes.

Order: ids ascending (texts by their bytes, NaN after the numbers), null last; of rows with one id, an arbitrary fixed order by content. Rows
repeated with the same id and text are one document in this respect: all of them get its result.
Defined results: null and empty texts and those shorter than ``length`` bytes lose nothing; an
empty table gives an empty result; other columns pass through untouched where asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import Workspace, fresh_name, map_batches
from shelfmark.llm.rolling import Powers, _mixed, blocks, string_views

LENGTH = 100
#: Bytes of an anchor gram.
GRAM = 32
#: Contexts of one anchor that a task compares at once, and bytes of contexts in one suffix order.
MAX_CONTEXTS = 2048
ORDER_BYTES = 1 << 18
#: Bits of the table of repeated anchors: 16 for each, within these bounds (32 MB at most). Beyond
#: them the table lets more through, which costs shuffling and changes no result.
MIN_TABLE_BITS, MAX_TABLE_BITS = 20, 28
#: Bytes of a text whose windows are anchored at once; hashes keep 40 bits beside the place.
PIECE_BYTES = 2 << 20
BLOCK_BYTES = 1 << 18
_PLACE_BITS = 24

#: What a document is known by: its id and two independent 64-bit hashes of its text, as any number
#: of rows can share an id (or have none).
DOC = ("ord", "tie", "tie2")
_RUN = "anchor long, context long, ord long, tie long, tie2 long, place long"


def identified(
    df: DataFrame, id_col: str, text_col: str, workspace: Workspace
) -> tuple[DataFrame, tuple[str, ...]]:
    """The rows with an order (null ids last) and tie-breakers by content, and their names.

    Whole numbers are their own order. Ids of other types get numbers that ascend with them: the
    distinct ids are sorted by range, numbered and stored, and joined to the rows.
    """
    names = tuple(fresh_name(df, f"dedup_{c}") for c in DOC)
    text = F.coalesce(df[text_col], F.lit(""))
    order = df[id_col]
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        own = fresh_name(df, "dedup_id")
        distinct = df.select(df[id_col].alias(own)).filter(F.col(own).isNotNull()).distinct().orderBy(own)
        numbered = workspace.store(
            distinct.withColumn(names[0], F.monotonically_increasing_id()), "id-order"
        )
        df = df.join(numbered, df[id_col] == numbered[own], "left").drop(own)
        order = F.col(names[0])
    order = F.coalesce(order.cast("long"), F.lit((1 << 63) - 1))
    made = (order, F.xxhash64(text), F.xxhash64(F.md5(text)))
    return df.withColumns(dict(zip(names, made))), names


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int, powers: Powers
) -> tuple[np.ndarray, ...]:
    """Row, start in the row, windows, anchor hash and context hash of all runs in some texts."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none
    with np.errstate(over="ignore"):
        up, down = powers.upto(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        hashed = _mixed((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        shift = np.uint64(_PLACE_BITS)
        keyed = (hashed >> shift << shift) | np.arange(len(hashed), dtype=np.uint64)
        low = _sliding_min(keyed, length - gram + 1)
        anchor = (low & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        row = np.searchsorted(offsets, np.arange(len(anchor)), "right") - 1
        whole = np.arange(len(anchor)) + length <= offsets[row + 1]
        change = np.ones(len(anchor), bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(change)
        size = np.diff(np.append(first, len(anchor)))
        # The last windows of a row reach into the next one: runs are cut to whole windows.
        fits = np.add.reduceat(whole.astype(np.int64), first)
        first, size = first[fits > 0], fits[fits > 0]
        stop = first + size + length - 1
        spelled = (sums[stop] - sums[first]) * down[first] * np.uint64(0xD6E8FEB86659FD93)
        context = _mixed(spelled + size.astype(np.uint64)).view(np.int64)
    own = row[first]
    return own, first - offsets[own], size, hashed[anchor[first]].view(np.int64), context


def _pieces(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets, rows and starts of texts; a long text comes in pieces that share no window."""
    data, offsets = string_views(column)
    for first, last in blocks(offsets, BLOCK_BYTES):
        base = offsets[first]
        if offsets[last] - base <= PIECE_BYTES:
            rows = np.arange(first, last)
            none = np.zeros(len(rows), np.int64)
            yield data[base : offsets[last]], offsets[first : last + 1] - base, rows, none
            continue
        for row in range(first, last):
            text = data[offsets[row] : offsets[row + 1]]
            for start in range(0, max(len(text), 1), PIECE_BYTES):
                part = text[start : start + PIECE_BYTES + length - 1]
                yield part, np.array([0, len(part)]), np.array([row]), np.array([start])


def _packed(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return start << 8 | size


def anchored_runs(
    docs: DataFrame, length: int, gram: int, table: np.ndarray | None = None, bits: int = 0
) -> DataFrame:
    """``anchor, context, ord, tie, tie2, place`` of all runs, or of those that ``table`` lets through.

    ``place`` is the run's start in its text times 256 plus its windows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table) if table is not None else None

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, known = Powers(), shared.value if shared is not None else None
        for batch in batches:
            doc = [batch.column(c).to_numpy() for c in DOC]
            for data, offsets, rows, starts in _pieces(batch.column("text"), length):
                row, start, size, anchor, context = runs(data, offsets, length, gram, powers)
                if known is not None:
                    keep = _let_through(known, bits, anchor)
                    row, start, size, anchor, context = (
                        v[keep] for v in (row, start, size, anchor, context)
                    )
                own = rows[row]
                place = _packed(start + starts[row], size)
                columns = [anchor, context, *[c[own] for c in doc], place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["anchor", "context", *DOC, "place"]
                )

    return map_batches(docs, stage, _RUN)


def repeated_table(anchors: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for the low bits of every anchor that occurs twice or more, and their number.

    (Anchors are smallest hashes, so their leading bits are mostly zero.)
    """
    twice = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    spark = anchors.sparkSession
    workspace = Workspace(spark)
    twice = workspace.store(twice, "repeated-anchors")
    bits = min(max((16 * twice.count()).bit_length(), MIN_TABLE_BITS), MAX_TABLE_BITS)
    at = F.col("anchor").bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        twice.select(at.alias("at"))
        .selectExpr("shiftright(at, 6) AS word", "shiftleft(1L, cast(at & 63 AS int)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    table = np.zeros((1 << bits) // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    workspace.clear()
    return table.view(np.uint8), bits


def among(df: DataFrame, table: np.ndarray, bits: int) -> DataFrame:
    """The rows whose anchor a bit table lets through."""
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf(T.BooleanType())
    def known(anchor: pa.Array) -> pa.Array:
        return pa.array(_let_through(shared.value, bits, anchor.to_numpy()))

    return df.filter(known("anchor"))


def _let_through(table: np.ndarray, bits: int, anchor: np.ndarray) -> np.ndarray:
    at = anchor.view(np.uint64) & np.uint64((1 << bits) - 1)
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a symbol array (0 lowest) in the order of their first ``depth`` symbols.

    Ranks by seven symbols are refined to twice as many at a time, where they aren't single yet.
    """
    n, reach = len(text), 7
    key = np.zeros(n, np.uint64)
    for k in range(reach):
        key <<= np.uint64(9)
        key[: n - k] |= text[k:].astype(np.uint64)
    order = np.argsort(key)
    fresh = _changes(key[order])
    rank = np.zeros(n + depth, np.int64)  # 0: beyond the end
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) + 1
    shared = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    while reach < depth and len(shared):
        step = min(reach, depth - reach)
        suffix = order[shared]
        key = rank[suffix] << 32 | rank[suffix + step]
        by = np.argsort(key)
        suffix = order[shared] = suffix[by]
        fresh = _changes(key[by])
        rank[suffix] = shared[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))] + 1
        shared = shared[~(fresh & np.append(fresh[1:], True))]
        reach += step
    return order


def _changes(values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def expand_intervals(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place of the order, the interval of suffixes whose first ``length`` symbols agree.

    ``came[i]`` is where the suffix one symbol longer than that at place i stands, that is, where
    the transform's symbol before suffix i leads. Two neighbours one symbol longer are parted in a
    step if the suffixes they come from were parted before; only neighbours still together are
    looked at again, so their common prefixes are found in increasing order.
    """
    n = len(text)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    before = text[order - 1]  # the Burrows-Wheeler transform, cyclic
    came = place[order - 1]
    source = np.empty(n, np.int32)
    source[came] = np.arange(n, dtype=np.int32)
    symbol = np.empty(n, before.dtype)
    symbol[came] = before
    apart = _changes(symbol)  # intervals of one symbol
    together = np.flatnonzero(~apart)
    here, there = source[together], source[together - 1]
    interval = np.cumsum(apart, dtype=np.int32)
    done = 0
    for _ in range(length - 1):
        parted = interval[here] != interval[there]
        found = np.count_nonzero(parted)
        if found == done:  # none that weren't parted before
            if found == len(together):
                break
            continue
        apart[together[parted]] = True
        interval = np.cumsum(apart, dtype=np.int32)
        done = found
        if 8 * found > len(together):
            stays = ~parted
            together, here, there = together[stays], here[stays], there[stays]
            done = 0
    return np.cumsum(apart)


def _joined(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (bytes plus one, 0 after each context) and the place of each context."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.zeros(at[-1], np.uint16)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    text[inside] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.uint16) + 1
    return text, at


def repeats(
    contexts: list[bytes], doc: np.ndarray, start: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some contexts: their context, offset, and whether an equal one is earlier.

    ``doc`` ranks the contexts' documents; ``start`` is where a context begins in its document.
    """
    text, at = _joined(contexts)
    order = suffix_order(text, length)
    interval = np.empty(len(text), np.int64)
    interval[order] = expand_intervals(text, order, length)
    sizes = np.diff(at) - length  # windows of each context
    context = np.repeat(np.arange(len(contexts)), sizes)
    offset = np.arange(len(context)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    group = interval[at[context] + offset]
    place = start[context] + offset
    sort = np.lexsort((place, doc[context], group))
    heads = np.ones(len(sort), bool)
    heads[1:] = group[sort][1:] != group[sort][:-1]
    head = sort[np.flatnonzero(heads)[np.cumsum(heads) - 1]]
    earlier = np.empty(len(sort), bool)
    earlier[sort] = (doc[context][head] != doc[context][sort]) | (place[head] != place[sort])
    return context, offset, earlier


def _ranks(doc: list[np.ndarray]) -> np.ndarray:
    by = np.lexsort(doc[::-1])
    fresh = np.zeros(len(by), bool)
    fresh[:1] = True
    for column in doc:
        fresh[1:] |= column[by][1:] != column[by][:-1]
    out = np.empty(len(by), np.int64)
    out[by] = np.cumsum(fresh)
    return out


_FETCHED = "part long, split boolean, ord long, tie long, tie2 long, start long, bytes binary"
_FOUND = "ord long, tie long, tie2 long, first long, stop long, window binary"


def fetched_contexts(joined: DataFrame, text_col: str, length: int) -> DataFrame:
    """A row per asked context, with its bytes, from rows that end in what ``DOC`` names and ``asked``."""
    at = joined.columns.index(text_col)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_views(pc.fill_null(batch.column(at), ""))
            *doc, lists = batch.columns[-len(DOC) - 1 :]
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            values = lists.flatten()
            place = values.field("place").to_numpy()
            start, windows = place >> 8, place & 255
            base = offsets[row] + start
            raw = [data[a : a + w + length - 1].tobytes() for a, w in zip(base.tolist(), windows.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    values.field("part"),
                    values.field("split"),
                    *[c.take(pa.array(row)) for c in doc],
                    pa.array(start),
                    pa.array(raw, pa.binary()),
                ],
                ["part", "split", *DOC, "start", "bytes"],
            )

    return map_batches(joined, stage, _FETCHED)


def compared_contexts(fetched: DataFrame, length: int) -> DataFrame:
    """Spans of windows that an equal one precedes; of split parts also the first windows' digests."""

    def compared(columns: dict[str, np.ndarray], contexts: list[bytes]) -> pa.RecordBatch:
        doc, start, split = [columns[c] for c in DOC], columns["start"], columns["split"]
        context, offset, earlier = repeats(contexts, _ranks(doc), start, length)
        hit = np.flatnonzero(earlier)
        fresh = np.ones(len(hit), bool)
        fresh[1:] = (context[hit][1:] != context[hit][:-1]) | (offset[hit][1:] != offset[hit][:-1] + 1)
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(hit)) - 1 if len(hit) else head
        own = context[hit[head]]
        first = start[own] + offset[hit[head]]
        stop = start[own] + offset[hit[tail]] + length
        heads = np.flatnonzero(~earlier & split[context])
        digests = [
            hashlib.blake2b(contexts[c][o : o + length], digest_size=16).digest()
            for c, o in zip(context[heads].tolist(), offset[heads].tolist())
        ]
        other = context[heads]
        place = start[other] + offset[heads]
        return pa.RecordBatch.from_arrays(
            [
                *[pa.array(np.concatenate([c[own], c[other]])) for c in doc],
                pa.array(np.concatenate([first, place])),
                pa.array(np.concatenate([stop, place + length])),
                pa.array([None] * len(own) + digests, pa.binary()),
            ],
            [*DOC, "first", "stop", "window"],
        )

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("part", "split", *DOC, "start")
        held: list[pa.RecordBatch] = []

        def arrays(rows: pa.Table) -> tuple[dict[str, np.ndarray], list[bytes]]:
            return {c: rows.column(c).to_numpy() for c in names}, rows.column("bytes").to_pylist()

        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                held.append(batch.slice(at, 4096))
                size += held[-1].column("bytes").nbytes
                if size < ORDER_BYTES:
                    continue
                rows = pa.Table.from_batches(held)
                part = rows.column("part").to_numpy()
                cut = int(np.searchsorted(part, part[-1], "left"))  # whole parts only
                if cut:
                    yield compared(*arrays(rows.slice(0, cut)))
                    held, size = rows.slice(cut).combine_chunks().to_batches(), 0
        if held:
            rows = pa.Table.from_batches(held)
            if rows.num_rows:
                yield compared(*arrays(rows))

    ordered = fetched.repartition("part").sortWithinPartitions("part")
    return map_batches(ordered, stage, _FOUND)


def repeated_spans(
    docs: DataFrame,
    names: tuple[str, ...],
    text_col: str,
    workspace: Workspace,
    length: int = LENGTH,
    gram: int = GRAM,
    max_contexts: int = MAX_CONTEXTS,
) -> DataFrame:
    """``ord, tie, tie2, spans`` of the documents that lose something; spans may touch and overlap.

    ``docs`` is shuffled by order and tie-breakers (``names``) with all its columns, as a later join of the
    result needs it, so that one exchange serves both.
    """
    if not 0 < gram < length or length - gram + 1 > 255:
        raise ValueError("An anchor gram is shorter than the window, by 254 bytes at most.")
    slim = docs.select(
        *[docs[name].alias(c) for name, c in zip(names, DOC)],
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    table, bits = repeated_table(anchored_runs(slim, length, gram).select("anchor"))
    found = workspace.store(anchored_runs(slim, length, gram, table, bits), "runs")
    classes = workspace.store(
        found.groupBy("anchor", "context").agg(
            F.min(F.struct(*DOC, "place")).alias("head"), F.count("*").alias("n")
        ),
        "run-classes",
    )
    # All places of a class but its first are preceded by the first, window by window.
    several = classes.filter("n > 1").select("anchor", "context", "head")
    here = F.struct(*DOC, "place")
    later = (
        found.join(several, ["anchor", "context"])
        .filter(here != F.col("head"))
        .select(
            *DOC,
            F.shiftright("place", 8).alias("first"),
            (F.shiftright("place", 8) + F.col("place").bitwiseAND(F.lit(255)) + (length - 1)).alias("stop"),
        )
    )
    # First places of different classes with one anchor are compared with each other.
    # Anchors of one class, most of them, stay out of the shuffle.
    alike = among(classes, *repeated_table(classes.select("anchor")))
    shared = alike.groupBy("anchor").agg(F.count("*").alias("contexts")).filter("contexts > 1")
    chunks = F.ceil(F.col("contexts") / F.lit(max_contexts))
    asked = (
        alike.join(shared, "anchor")
        .select(
            *[F.col(f"head.{c}").alias(f"asked_{c}") for c in DOC],
            F.struct(
                F.xxhash64("anchor", F.pmod(F.xxhash64("context"), chunks)).alias("part"),
                (F.col("contexts") > max_contexts).alias("split"),
                F.col("head.place").alias("place"),
            ).alias("ask"),
        )
        .groupBy(*[f"asked_{c}" for c in DOC])
        .agg(F.collect_list("ask").alias("asked"))
    )
    same = [docs[name] == asked[f"asked_{c}"] for name, c in zip(names, DOC)]
    fetched = fetched_contexts(docs.join(asked, same), text_col, length)
    # First windows of chunks meet by their digests; the others are spread by what they are.
    spread = F.coalesce("window", F.unhex(F.sha1(F.concat_ws(":", *DOC, "first"))))
    line = Window.partitionBy("spread").orderBy(*DOC, "first")
    start = F.struct(*DOC, "first")
    earlier = (
        compared_contexts(fetched, length)
        .withColumn("spread", spread)
        .withColumn("earliest", F.first(start).over(line))
        .filter(F.col("window").isNull() | (start != F.col("earliest")))
        .select(*DOC, "first", "stop")
    )
    return later.union(earlier).groupBy(*DOC).agg(
        F.collect_list(F.struct("first", "stop")).alias("spans")
    )


def _merged(spans: np.ndarray) -> np.ndarray:
    """Maximal spans, in order; spans that touch are one."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    fresh = np.ones(len(spans), bool)
    fresh[1:] = spans[1:, 0] > reach[:-1]
    head = np.flatnonzero(fresh)
    return np.stack([spans[head, 0], reach[np.append(head[1:], len(spans)) - 1]], axis=1)


def _cut(text: pa.Array, spans: pa.Array, keep: bool) -> pa.StructArray:
    data, offsets = string_views(text)
    lists = spans.offsets.to_numpy()
    values = spans.flatten()
    pairs = np.stack([values.field("first").to_numpy(), values.field("stop").to_numpy()], axis=1)
    lists = lists - lists[0]
    removed, counts, digests, kept = [], [], [], []
    for k in range(len(text)):
        own = data[offsets[k] : offsets[k + 1]]
        merged = _merged(pairs[lists[k] : lists[k + 1]])
        if len(merged):
            stays = np.ones(len(own), bool)
            for first, stop in merged.tolist():
                stays[first:stop] = False
            own = own[stays]
        removed.append(int((merged[:, 1] - merged[:, 0]).sum()))
        counts.append(len(merged))
        raw = own.tobytes()
        digests.append(hashlib.sha256(raw).hexdigest())
        kept.append(raw if keep else None)
    return pa.StructArray.from_arrays(
        [
            pa.array(removed, pa.int64()),
            pa.array(counts, pa.int64()),
            pa.array(digests, pa.string()),
            pa.array(kept, pa.binary()),
        ],
        ["n_removed", "n_spans", "kept_sha256", "kept"],
    )


def deduplicate(
    df: DataFrame,
    length: int = LENGTH,
    keep: bool = True,
    gram: int = GRAM,
    max_contexts: int = MAX_CONTEXTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """All rows and columns with a struct ``dedup``: ``n_bytes, n_removed, n_spans, kept_sha256``
    and, if ``keep``, the bytes that are left as ``kept`` (else null)."""
    workspace = workspace or Workspace(df.sparkSession)
    out = fresh_name(df, "dedup")
    marked, names = identified(df, id_col, text_col, workspace)
    spans = repeated_spans(marked, names, text_col, workspace, length, gram, max_contexts)
    lost = spans.select(*[F.col(c).alias(f"lost_{c}") for c in DOC], "spans")

    @F.arrow_udf("n_removed long, n_spans long, kept_sha256 string, kept binary")
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        return _cut(text, spans, keep)

    none = F.array().cast("array<struct<first: bigint, stop: bigint>>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = fresh_name(marked, "spans_")
    joined = marked.join(
        lost.withColumnRenamed("spans", name),
        [marked[n] == lost[f"lost_{c}"] for n, c in zip(names, DOC)],
        "left",
    ).withColumn(out, cut(text, F.coalesce(F.col(name), none)))
    n_bytes = F.octet_length(text).cast("long")
    return joined.withColumn(out, F.col(out).withField("n_bytes", n_bytes)).select(*df.columns, out)


@F.arrow_udf(T.StringType())
def as_text(kept: pa.Array) -> pa.Array:
    """Kept bytes as text, without the bytes of characters that were cut through."""
    return pa.array([v.decode(errors="ignore") if v is not None else None for v in kept.to_pylist()])
