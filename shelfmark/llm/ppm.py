"""Language-model scores by prediction by partial matching over bytes (operator 9).

A trie of byte contexts, up to ``order`` bytes long (seven at most), holds what followed each context in the training
texts, as tables keyed by context. A byte's probability comes from the longest context; a byte not
seen there is reached by an escape (as probable as the context has distinct successors) to the
next shorter context, in which the symbols seen before are excluded, down to a uniform choice
among the symbols never seen. A text begins after ``order`` line feeds and ends with an end symbol, so
its probability is one number; its base-10 logarithm is the score. Words give a second, plain
score: smoothed frequencies of blank-separated words, with an end token per text.

What is looked up grows with the corpus, so it is never broadcast whole: keys with at least a
fixed share of all occurrences (of which there can be no more than the share's inverse) are sent
to every task as sorted arrays, and a text's other words and contexts are joined. None of the
joined keys is frequent.

Defined results: a null text counts as empty (only the end is scored); a null id counts as an
empty one for the hold-out; repeated rows each get a row and count each; without training texts
all counts are 0 and the symbols uniform; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Workspace, map_batches, row_key, texts
from shelfmark.llm.rolling import Powers, blocks, string_views, word_hashes, word_spans

#: Bytes of the longest context unless asked otherwise, and at most: a key of a context and its
#: successor has 64 bits.
ORDER = 3
MAX_ORDER = 7
#: A key is broadcast if it has a share of 1 / MAX_BROADCAST_KEYS of all occurrences or more.
MAX_BROADCAST_KEYS = 1 << 22
#: Contexts whose probabilities are worked out at once.
BATCH_CONTEXTS = 1024
#: Words that a task counts before it hands them on.
FLUSH_WORDS = 400_000

_END_SYMBOL = 0xFF  # no byte of UTF-8
_START_BYTE = 0x0A
#: Lower-cased bytes plus one; 0 between words.
_WORDS = np.array(
    [0 if b == 0x20 or 0x09 <= b <= 0x0D else b + 33 if 0x41 <= b <= 0x5A else b + 1 for b in range(256)],
    np.uint16,
)


def held_out(doc_id: Column | str, buckets: int = 7, held: int = 2) -> Column:
    """Whether the CRC-32 of the id as text falls in the bucket that is kept from training."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % buckets == held


def gram_keys(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Context and successor of every byte and end, as 64-bit keys, and each row's first key."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    at = np.concatenate([[0], np.cumsum(sizes + order + 1)])
    padded = np.empty(at[-1], np.uint8)
    body = np.ones(at[-1], bool)
    for k in range(order):
        padded[at[:-1] + k] = _START_BYTE
        body[at[:-1] + k] = False
    padded[at[1:] - 1] = _END_SYMBOL
    body[at[1:] - 1] = False
    padded[body] = data
    body[at[1:] - 1] = True
    keys = padded[order:].astype(np.uint64)
    for k in range(1, order + 1):
        keys |= padded[order - k : len(padded) - k].astype(np.uint64) << np.uint64(8 * k)
    return keys[body[order:]], at - order * np.arange(n + 1)


def word_counts(training: DataFrame) -> DataFrame:
    """``word, n`` of all training texts; the empty word is the end of a text."""

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
                ["word", "n"],
            )
            counts.clear()
            return batch

        for batch in batches:
            for value in batch.column("text"):
                counts.update(value.as_py().encode().lower().split())
                if len(counts) > FLUSH_WORDS:
                    yield flushed()
            counts[b""] += batch.num_rows
        if counts:
            yield flushed()

    rows = map_batches(training.select("text"), stage, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n, n_all`` of all texts: occurrences in training texts and in all."""

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_views(batch.column("text"))
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for first, last in blocks(offsets, 4 << 20):
                base = offsets[first]
                keys, at = gram_keys(data[base : offsets[last]], offsets[first : last + 1] - base, order)
                part = np.repeat(train[first:last], np.diff(at))
                found, inverse_counts = np.unique(keys, return_counts=True)
                trained, counts = np.unique(keys[part], return_counts=True)
                n = np.zeros(len(found), np.int64)
                n[np.searchsorted(found, trained)] = counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.view(np.int64)),
                        pa.array(n),
                        pa.array(inverse_counts.astype(np.int64)),
                    ],
                    ["gram", "n", "n_all"],
                )

    rows = map_batches(docs.select("text", "held_out"), stage, "gram long, n long, n_all long")
    return rows.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))


def symbol_probabilities(counts: list[np.ndarray]) -> np.ndarray:
    """Probabilities of the 256 symbols, from their counts after ever shorter contexts.

    Counts have the symbols in the last dimension; others stand for several contexts.
    """
    shape = counts[0].shape if counts else (256,)
    out, excluded, escape = np.zeros(shape), np.zeros(shape, bool), np.ones((*shape[:-1], 1))
    for after in counts:
        after = np.where(excluded, 0, after)
        seen = after > 0
        total, distinct = after.sum(-1, keepdims=True), seen.sum(-1, keepdims=True)
        excluded |= seen
        distinct = np.where(excluded.all(-1, keepdims=True), 0, distinct)  # nothing is left to escape to
        known = np.maximum(total + distinct, 1)
        out = np.where(seen, escape * after / known, out)
        escape = np.where(total > 0, escape * distinct / known, escape)
    left = np.maximum(256 - excluded.sum(-1, keepdims=True), 1)
    return np.where(excluded, out, escape / left)


def gram_scores(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n_all, log10_p`` of every gram that any text has."""
    symbol = F.col("gram").bitwiseAND(F.lit(255))
    root = np.zeros(256, np.int64)
    for row in grams.groupBy(symbol.alias("s")).agg(F.sum("n").alias("n")).collect():
        root[row["s"]] = row["n"]
    longest = grams.groupBy(F.shiftrightunsigned("gram", 8).alias("context")).agg(
        F.collect_list(F.struct(symbol.cast("short").alias("s"), "n", "n_all")).alias("after")
    )
    # Long contexts first: what follows a short one is the longer list, and goes through fewer joins.
    for shorter in range(order - 1, 0, -1):
        key = F.col("gram").bitwiseAND(F.lit((1 << 8 * (shorter + 1)) - 1))
        successors = grams.filter("n > 0").groupBy(key.alias("g")).agg(F.sum("n").alias("n"))
        own = F.struct(F.col("g").bitwiseAND(F.lit(255)).cast("short").alias("s"), "n")
        node = successors.groupBy(F.shiftright("g", 8).alias(f"context_{shorter}")).agg(
            F.collect_list(own).alias(f"after_{shorter}")
        )
        key = F.col("context").bitwiseAND(F.lit((1 << 8 * shorter) - 1))
        node = F.broadcast(node) if shorter == 1 else node  # of 256 contexts at most
        longest = longest.join(node, key == F.col(f"context_{shorter}"), "left").drop(f"context_{shorter}")

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dense(column: pa.Array) -> np.ndarray:
            out = np.zeros((len(column), 256), np.int64)
            sizes = pc.fill_null(column.value_lengths(), 0).to_numpy()
            values = column.flatten()
            row = np.repeat(np.arange(len(column)), sizes)
            out[row, values.field("s").to_numpy()] = values.field("n").to_numpy()
            return out

        for whole in batches:
            for first in range(0, whole.num_rows, BATCH_CONTEXTS):
                batch = whole.slice(first, BATCH_CONTEXTS)
                after = batch.column("after")
                shorter = [dense(batch.column(f"after_{o}")) for o in range(order - 1, 0, -1)]
                p = symbol_probabilities([dense(after), *shorter, root])
                row = np.repeat(np.arange(len(after)), after.value_lengths().to_numpy())
                values = after.flatten()
                symbols = values.field("s").to_numpy().astype(np.int64)
                contexts = batch.column("context").to_numpy()[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(contexts << 8 | symbols),
                        values.field("n_all"),
                        pa.array(np.log10(p[row, symbols])),
                    ],
                    ["gram", "n_all", "log10_p"],
                )

    return map_batches(longest, stage, "gram long, n_all long, log10_p double")


class Lookup:
    """Values of sorted keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __call__(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, and which of the wanted keys are there."""
        if not len(self.keys):
            return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.values[at], self.keys[at] == wanted


def _hashed(words: list[bytes]) -> np.ndarray:
    """Hashes of whole words, as texts' words get them."""
    column = pa.array(words, pa.binary())
    data, offsets = string_views(column)
    plain, starts, ends, _ = word_spans(data, offsets, _WORDS)
    return word_hashes(plain, starts, ends, Powers())


def _frequent(rows: DataFrame, key: str, count: str, value: str, least: float) -> tuple[pa.ChunkedArray, np.ndarray]:
    """Keys and values with ``least`` occurrences or more: at most all occurrences / least."""
    table = rows.filter(F.col(count) >= least).select(key, value).toArrow()
    return table.column(key), table.column(value).to_numpy().astype(np.float64)


SCORED = (
    "doc_id {id_type}, key binary, held_out boolean, n_tokens long, n_known long, log_words double, "
    "score double, words array<struct<word: binary, n: int>>, grams array<struct<gram: long, n: int>>"
)


def _lists(rows: np.ndarray, n_rows: int, fields: list[pa.Array], names: list[str]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, names))


def local_scores(
    docs: DataFrame, words: Lookup, ends: float, grams: Lookup, order: int = ORDER
) -> DataFrame:
    """Per text: sums over frequent words and grams, and counts of the others, to be joined.

    ``words`` gives counts by hash, ``ends`` is the end token's count, ``grams`` gives logarithms.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, grams))
    schema = SCORED.format(id_type=docs.schema["doc_id"].dataType.simpleString())

    def part(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> list[pa.Array]:
        counted, known_grams = shared.value
        n_rows = len(offsets) - 1
        plain, starts, stops, per_row = word_spans(data, offsets, _WORDS)
        row = np.repeat(np.arange(n_rows), np.diff(per_row))
        hashes = word_hashes(plain, starts, stops, powers)
        distinct, place, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        count, there = counted(distinct)
        hot = there[inverse]
        log_words = np.bincount(row[hot], np.log10(count + 1)[inverse[hot]], n_rows) + np.log10(ends + 1)
        n_known = np.bincount(row[hot], minlength=n_rows) + (ends > 0)
        n_tokens = np.diff(per_row) + 1
        cold, n_cold = np.unique(row[~hot] * len(distinct) + inverse[~hot], return_counts=True)
        cold_row, cold_word = np.divmod(cold, max(len(distinct), 1))
        raw = data.tobytes().lower()
        own = place[cold_word]
        spelled = [raw[a:b] for a, b in zip(starts[own].tolist(), stops[own].tolist())]
        keys, at = gram_keys(data, offsets, order)
        key_row = np.repeat(np.arange(n_rows), np.diff(at))
        distinct_keys, key_of = np.unique(keys, return_inverse=True)
        value, there = known_grams(distinct_keys)
        value = np.where(there, value, 0.0)
        score = np.bincount(key_row, value[key_of], n_rows)
        rare = ~there[key_of]
        rare_of, n_rare = np.unique(key_row[rare] * len(distinct_keys) + key_of[rare], return_counts=True)
        rare_row, rare_key = np.divmod(rare_of, max(len(distinct_keys), 1))
        return [
            pa.array(n_tokens.astype(np.int64)),
            pa.array(n_known.astype(np.int64)),
            pa.array(log_words),
            pa.array(score),
            _lists(
                cold_row,
                n_rows,
                [pa.array(spelled, pa.binary()), pa.array(n_cold.astype(np.int32))],
                ["word", "n"],
            ),
            _lists(
                rare_row,
                n_rows,
                [pa.array(distinct_keys[rare_key].view(np.int64)), pa.array(n_rare.astype(np.int32))],
                ["gram", "n"],
            ),
        ]

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        names = ["doc_id", "key", "held_out", "n_tokens", "n_known", "log_words", "score", "words", "grams"]
        for batch in batches:
            data, offsets = string_views(batch.column("text"))
            for first, last in blocks(offsets, 2 << 20):
                base = offsets[first]
                own = batch.slice(first, last - first)
                made = part(data[base : offsets[last]], offsets[first : last + 1] - base, powers)
                columns = [own.column(c) for c in ("doc_id", "key", "held_out")]
                yield pa.RecordBatch.from_arrays([*columns, *made], names)

    return map_batches(docs.select("doc_id", "key", "held_out", "text"), stage, schema)


def score(
    df: DataFrame,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
    order: int = ORDER,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``order`` is the number of bytes of the longest context.
    """
    if not 1 <= order <= MAX_ORDER:
        raise ValueError(f"Contexts have 1 to {MAX_ORDER} bytes.")
    workspace = workspace or Workspace(df.sparkSession)
    docs = texts(df, id_col, text_col).withColumns({"key": row_key(), "held_out": held_out("doc_id")})
    words = workspace.store(word_counts(docs.filter(~F.col("held_out"))), "words")
    n, v, ends = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count("*"),
        F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("n"))), F.lit(0)),
    ).first()
    grams = workspace.store(gram_scores(workspace.store(gram_counts(docs, order), "gram-counts"), order), "grams")
    n_grams = grams.agg(F.coalesce(F.sum("n_all"), F.lit(0))).first()[0]
    spelled = words.filter(F.octet_length("word") > 0)
    hot_words, counts = _frequent(spelled, "word", "n", "n", n / max_broadcast_keys)
    hot_grams, logs = _frequent(grams, "gram", "n_all", "log10_p", n_grams / max_broadcast_keys)
    scored = workspace.store(
        local_scores(
            docs,
            Lookup(_hashed(hot_words.to_pylist()), counts),
            float(ends),
            Lookup(hot_grams.to_numpy().astype(np.int64).view(np.uint64), logs),
            order,
        ),
        "scored",
    )
    rare_words = (
        scored.select("key", F.inline("words").alias("word", "times"))
        .join(spelled, "word")
        .groupBy(F.col("key").alias("word_key"))
        .agg(
            F.sum("times").alias("more_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_words"),
        )
    )
    rare_grams = (
        scored.select("key", F.inline("grams").alias("gram", "times"))
        .join(grams, "gram")
        .groupBy(F.col("key").alias("gram_key"))
        .agg(F.sum(F.col("times") * F.col("log10_p")).alias("more_score"))
    )
    copies = scored.groupBy("key").agg(F.count("*").alias("copies"))
    return _completed(scored, rare_words, rare_grams, copies, n, v)


def _completed(scored, rare_words, rare_grams, copies, n: int, v: int) -> DataFrame:
    """Add what was joined; equal rows had their words joined once each, hence the division."""
    several = copies.filter("copies > 1").withColumnRenamed("key", "copy_key")
    joined = (
        scored.join(rare_words, scored["key"] == rare_words["word_key"], "left")
        .join(rare_grams, scored["key"] == rare_grams["gram_key"], "left")
        .join(several, scored["key"] == several["copy_key"], "left")
    )
    share = F.coalesce("copies", F.lit(1))
    zero = F.lit(0)
    log_words = F.col("log_words") + F.coalesce(F.col("more_words") / share, F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.col("more_known") / share, zero)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (log_words - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
        (F.col("score") + F.coalesce(F.col("more_score") / share, F.lit(0.0))).alias("score"),
    )


def adaptive_code_length(text: str, order: int = ORDER) -> float:
    """log10 probability of a text under a trie that learns from the text itself as it goes."""
    data = bytes([_START_BYTE] * order) + text.encode() + bytes([_END_SYMBOL])
    trie: dict[bytes, np.ndarray] = {}
    total = 0.0
    for at in range(order, len(data)):
        contexts = [data[at - k : at] for k in range(order, -1, -1)]
        nodes = [trie.setdefault(c, np.zeros(256, np.int64)) for c in contexts]
        total += np.log10(symbol_probabilities(nodes)[data[at]])
        for node in nodes:
            node[data[at]] += 1
    return float(total)
