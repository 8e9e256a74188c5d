"""Ranked lexical search by the Best Position Algorithm on impact-ordered lists.

``build_index`` deals the documents into blocks of bounded size and stores, for every term of a
block, its documents in the order of their impact. ``search`` walks the lists of an item's terms
from the top, in lockstep. Whatever document it meets it looks up in the item's other lists at
once (direct access), which also tells the document's position there. A list's best position is
the last one of the unbroken run of seen positions from its top: no unseen document of the block
can have more than the sum of the impacts that follow the best positions. That bound falls faster
than one from the positions read last. A block is left as soon as its bound is strictly below the
k-th score found so far, by this block or those that the task searched before; an equal bound
goes on, for ties go to the smaller id.

Lists are as long as their block has documents, so no task holds a frequent term's postings of the
whole corpus. What leaves a task are its k best per item; the k best of these are the result.

Integers throughout: an occurrence count ``tf`` in a document of ``n`` terms has the impact
``1000000000 * tf div (1000 * tf + 8 * m)`` with ``m = 10 + 90 * n * N div L`` for ``N`` documents
with terms and ``L`` terms in all; a term's weight is ``floor(1000 ln((2N + 2) / (2df + 1)))``.

Defined cases: null texts and texts without terms are in no list and not counted in ``N``; items
without terms, or whose terms no document holds, have no rows; an empty table of documents or items
gives none. Repeated rows of documents are ranked each, those with a null id behind equal scores
with one; every row of items is an item. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from shelfmark.llm.common import Workspace, map_batches, texts

#: Documents and postings (a term of a document) at which a block is closed.
BLOCK_DOCS = 8_192
BLOCK_POSTINGS = 1_000_000
#: Postings in an Arrow batch of lists.
BATCH_POSTINGS = 100_000
#: Term occurrences of the items that one pass over the index takes; they are collected and
#: broadcast. More items take more passes.
LOT_TERMS = 500_000
#: Positions read at first from every list; each round reads twice as many.
FIRST_STEP = 8

#: Pairs of a list and a document that are looked up at once.
DIRECT_PAIRS = 1_000_000

_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(
    b if b >= 0x80 or bytes([b]).lower() in _ALNUM else 0x20 for b in bytes(range(256)).lower()
)


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and of other characters beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_TABLE).split()


def impact(tf: int, n: int, docs: int, occurrences: int) -> int:
    return 1_000_000_000 * tf // (1_000 * tf + 8 * (10 + 90 * n * docs // occurrences))


@dataclass(frozen=True)
class Index:
    """Stored lists ``(block, term, docs, impacts, ids)`` and what they were made from.

    ``docs`` are numbers within the block, in the order of the ids; the row with a null term has
    the block's ids.
    """

    lists: DataFrame
    n_docs: int
    n_terms: int
    id_type: DataType


def collection_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and terms with repeats, of ``texts`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(terms(t)) for t in batch["text"].to_pylist()]
            yield pa.record_batch(
                {"d": pa.array([sum(map(bool, sizes))]), "t": pa.array([sum(sizes)])}
            )

    counted = map_batches(docs.select("text"), count, "d long, t long")
    row = counted.agg(F.sum("d"), F.sum("t")).first()
    return row[0] or 0, row[1] or 0


class _Block:
    """Documents whose lists are made together."""

    def __init__(self, n_docs: int, n_terms: int, most: int):
        self.total, self.most = (n_docs, n_terms), most
        self.ids: list = []
        self.vocabulary: defaultdict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.term: list[int] = []
        self.impacts: list[int] = []
        self.sizes: list[int] = []

    def add(self, doc_id, words: list[bytes]) -> None:
        counts = Counter(words)
        self.ids.append(doc_id)
        self.sizes.append(len(counts))
        self.term.extend(map(self.vocabulary.__getitem__, counts))
        value = {tf: impact(tf, len(words), *self.total) for tf in set(counts.values())}
        self.impacts.extend(map(value.__getitem__, counts.values()))

    def full(self) -> bool:
        return len(self.ids) >= self.most or len(self.term) >= BLOCK_POSTINGS

    def batches(self, number: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        order = sorted(range(len(self.ids)), key=lambda i: _nulls_last(self.ids[i]))
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        ids = pa.array([[self.ids[i] for i in order]], pa.list_(id_type))
        none = pa.nulls(1, pa.list_(pa.int32()))
        yield _lists(number, pa.nulls(1, pa.string()), none, none.cast(pa.list_(pa.int64())), ids)
        doc = np.repeat(rank, self.sizes)
        term, value = np.array(self.term, np.int32), np.array(self.impacts, np.int64)
        by_impact = np.lexsort((doc, -value, term))
        doc, value = doc[by_impact], value[by_impact]
        ends = np.cumsum(np.bincount(term, minlength=len(self.vocabulary)))
        names = pa.array(list(self.vocabulary), pa.binary()).cast(pa.string())
        a = 0
        while a < len(ends):
            first = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, first + BATCH_POSTINGS, "right")))
            offsets = pa.array(np.concatenate(([0], ends[a:b] - first)).astype(np.int32))
            part = slice(first, ends[b - 1])
            docs = pa.ListArray.from_arrays(offsets, pa.array(doc[part]))
            values = pa.ListArray.from_arrays(offsets, pa.array(value[part]))
            yield _lists(number, names.slice(a, b - a), docs, values, pa.nulls(b - a, ids.type))
            a = b


def _lists(number, term, docs, impacts, ids) -> pa.RecordBatch:
    blocks = pa.array(np.full(len(term), number, np.int64))
    return pa.record_batch([blocks, term, docs, impacts, ids], ["block", "term", "docs", "impacts", "ids"])


def build_index(
    df: DataFrame,
    workspace: Workspace,
    block_docs: int = BLOCK_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Index:
    """Store the impact-ordered lists of all terms of all documents.

    The documents are read twice: for the size of the collection, on which impacts depend, and for
    the lists.
    """
    docs = texts(df, id_col, text_col)
    n_docs, n_terms = collection_size(docs)
    id_type = docs.schema["doc_id"].dataType

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block(n_docs, n_terms, block_docs)
        kind = to_arrow_type(id_type)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                if words := terms(text):
                    block.add(doc_id, words)
                if block.full():
                    yield from block.batches(number, kind)
                    number, block = number + 1, _Block(n_docs, n_terms, block_docs)
        yield from block.batches(number, kind)

    schema = (
        "block long, term string, docs array<int>, impacts array<long>, "
        f"ids array<{id_type.simpleString()}>"
    )
    return Index(workspace.store(map_batches(docs, build, schema), "lists"), n_docs, n_terms, id_type)


class _Lists:
    """The lists of one block, by impact and by document."""

    def __init__(self, names: list[str], sizes: list[int], docs: list, impacts: list, ids: list):
        self.ids, self.number = ids, {t: i for i, t in enumerate(names)}
        self.docs, self.impacts = np.concatenate(docs).astype(np.int64), np.concatenate(impacts)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        keys = np.repeat(np.arange(len(sizes)), sizes) * len(ids) + self.docs
        self.place = np.argsort(keys)
        self.keys = keys[self.place]

    def direct(self, lists: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of documents in lists, and whether they are there, both ``lists`` by ``docs``."""
        wanted = (lists[:, None] * len(self.ids) + docs[None, :]).ravel()
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        shape = len(lists), len(docs)
        return self.place[at].reshape(shape), (self.keys[at] == wanted).reshape(shape)

    def best(
        self, lists: np.ndarray, weights: np.ndarray, k: int, known: list[int]
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents with their scores, the k best among them, and how many were looked at.

        ``known`` are the best scores of other blocks, k at most.
        """
        starts, ends = self.starts[lists], self.ends[lists]
        seen = [np.zeros(b - a, bool) for a, b in zip(starts, ends)]
        run = np.zeros(len(lists), np.int64)  # best positions
        met = np.zeros(len(self.ids), bool)
        found, scores, top = [], [], np.array(known, np.int64)
        depth, step = 0, FIRST_STEP
        while True:
            read = [self.docs[a + depth : min(a + depth + step, b)] for a, b in zip(starts, ends)]
            fresh = np.concatenate(read)
            fresh = np.unique(fresh[~met[fresh]])
            met[fresh] = True
            at_once = max(1, DIRECT_PAIRS // len(lists))
            for docs in (fresh[a : a + at_once] for a in range(0, len(fresh), at_once)):
                place, held = self.direct(lists, docs)
                score = (np.where(held, self.impacts[place], 0) * weights[:, None]).sum(axis=0)
                for i, flags in enumerate(seen):
                    flags[place[i][held[i]] - starts[i]] = True
                found.append(docs)
                scores.append(score)
                top = np.sort(np.concatenate((top, score)))[-k:]
            bound = 0
            for i, flags in enumerate(seen):
                rest = flags[run[i] :]
                gap = int(rest.argmin()) if len(rest) else 0
                run[i] += gap if len(rest) and not rest[gap] else len(rest)
                if run[i] < len(flags):
                    bound += int(self.impacts[starts[i] + run[i]]) * int(weights[i])
            if bound == 0 or (len(top) == k and bound < top[0]):
                break
            depth, step = depth + step, step * 2
        return np.concatenate(found), np.concatenate(scores), int(met.sum())


def _nulls_last(value) -> tuple:
    return (True,) if value is None else (False, value)


def _smallest_first(pair: tuple) -> tuple:
    return -pair[0], _nulls_last(pair[1])


def _searcher(items, k: int, id_type: pa.DataType):
    """Stage from index rows, block by block, to the k best of the task's documents per item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = defaultdict(list)

        def close(rows: list, ids: list) -> None:
            if not rows or not ids:
                return
            block = _Lists(*map(list, zip(*rows)), ids)
            for item, (names, weights) in items.value.items():
                held = [(block.number[t], w) for t, w in zip(names, weights) if t in block.number]
                if not held:
                    continue
                lists, weight = (np.array(x, np.int64) for x in zip(*held))
                before = best[item]
                docs, scores, _ = block.best(lists, weight, k, [s for s, _ in before])
                if len(docs) > k:
                    # Numbers follow ids: ties within the block go to the smaller one.
                    order = np.lexsort((docs, -scores))[:k]
                    docs, scores = docs[order], scores[order]
                new = [(int(s), ids[d]) for d, s in zip(docs, scores) if s > 0]
                best[item] = sorted(before + new, key=_smallest_first)[:k]

        current, rows, ids = None, [], []
        for batch in batches:
            blocks, names = batch["block"].to_pylist(), batch["term"].to_pylist()
            docs, impacts = batch["docs"], batch["impacts"]
            for i, (number, name) in enumerate(zip(blocks, names)):
                if number != current:
                    close(rows, ids)
                    current, rows, ids = number, [], []
                if name is None:
                    ids = batch["ids"][i].as_py()
                else:
                    doc = docs[i].values.to_numpy()
                    rows.append((name, len(doc), doc, impacts[i].values.to_numpy()))
        close(rows, ids)
        flat = [(item, s, d) for item, top in best.items() for s, d in top]
        item, score, doc = zip(*flat) if flat else ((), (), ())
        yield pa.record_batch(
            [pa.array(item, pa.int64()), pa.array(score, pa.int64()), pa.array(doc, id_type)],
            ["item", "score", "doc_id"],
        )

    return search


def item_terms(items: DataFrame, id_col: str, text_col: str, workspace: Workspace) -> DataFrame:
    """Stored rows ``(item, item_id, term)``, each term of an item once; ``item`` numbers the rows."""
    numbered = items.select(
        F.monotonically_increasing_id().alias("item"),
        items[id_col].alias("item_id"),
        F.coalesce(items[text_col], F.lit("")).alias("text"),
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch["text"].to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            names = pa.array([t for f in found for t in f], pa.binary()).cast(pa.string())
            taken = batch.select(["item", "item_id"]).take(pa.array(rows))
            yield pa.record_batch([*taken.columns, names], ["item", "item_id", "term"])

    kind = items.schema[id_col].dataType.simpleString()
    return workspace.store(map_batches(numbered, split, f"item long, item_id {kind}, term string"), "items")


def search(
    index: Index,
    items: DataFrame,
    workspace: Workspace,
    k: int = 10,
    lot_terms: int = LOT_TERMS,
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's k best documents with a score above 0."""
    spark = items.sparkSession
    asked = item_terms(items, item_id_col, item_text_col, workspace)
    n_lots = max(1, math.ceil(asked.count() / lot_terms))
    lot_of = F.pmod(F.xxhash64("item"), F.lit(n_lots))
    parts = [
        _search_lot(spark, index, asked.filter(lot_of == lot), workspace, k) for lot in range(n_lots)
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    names = asked.select("item", "item_id").distinct()
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _search_lot(
    spark: SparkSession, index: Index, asked: DataFrame, workspace: Workspace, k: int
) -> DataFrame:
    """Stored ``(item, score, doc_id)``: the k best of every task's documents per item."""
    # A lot has LOT_TERMS rows or so, and no more distinct terms: small enough for a broadcast.
    wanted = F.broadcast(asked.select("term").distinct())
    held = index.lists.join(wanted, "term", "left_semi")
    df = dict(held.groupBy("term").agg(F.sum(F.size("docs"))).collect())
    lot: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
    for item, term in asked.select("item", "term").collect():
        weight = math.floor(1_000 * math.log((2 * index.n_docs + 2) / (2 * df.get(term, 0) + 1)))
        if term in df and weight > 0:
            lot[item][0].append(term)
            lot[item][1].append(weight)
    shared = spark.sparkContext.broadcast(dict(lot))
    heads = index.lists.filter(F.col("term").isNull())
    rows = held.select(*index.lists.columns).unionByName(heads)
    rows = rows.repartition("block").sortWithinPartitions("block", F.asc_nulls_first("term"))
    stage = _searcher(shared, k, to_arrow_type(index.id_type))
    schema = f"item long, score long, doc_id {index.id_type.simpleString()}"
    found = workspace.store(map_batches(rows, stage, schema), "best")
    shared.destroy()
    return found
