"""Vocabularies and fixed-length token arrays.

``encode`` is a narrow pass: the JVM normalises the text and one Arrow function per batch
splits it and looks the words up in a broadcast vocabulary. Rows are neither
exploded nor shuffled, so neither a frequent word nor a large source can skew it. A
vocabulary too large to broadcast is joined instead, if the caller says so.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import words
from shelfmark.functions.wordpiece import MAX_WORD_CHARS, SPELLED_TOKENS, split_word, word_parts
from shelfmark.session import remove, scratch_path

# Names and, in a vocabulary built here, ids of the special tokens.
PAD, UNK, CLS, SEP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
SPECIAL_TOKENS = (PAD, UNK, CLS, SEP)
MAX_LENGTH = 512

# What uncased WordPiece normalising drops, and what it sets apart, namely
# punctuation, ideographs and spelled-out special tokens. The lookahead passes over most
# characters cheaply.
_DROPPED = r"[\p{C}\p{Mn}\x{FFFD}&&[^\t\n\r]]"
_SET_APART = (
    r"(?![a-zA-Z0-9\s])(?:\[(?:PAD|UNK|CLS|SEP|MASK)\]|[\p{Punct}\p{P}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}"
    r"\x{2A700}-\x{2CEAF}\x{2F800}-\x{2FA1F}])"
)

#: Rows of a vocabulary that may be collected and broadcast to the tasks, unless the caller says
#: otherwise (some 100 MB per task's Python process).
MAX_BROADCAST_TOKENS = 500_000
STRATEGIES = ("broadcast", "join")

#: Rows of a batch whose words a task holds at once; a batch may have some 10,000 rows.
ROWS_AT_ONCE = 256

#: Rows whose distinct words are joined to a vocabulary together, at most.
BLOCK_ROWS = 2048
#: Blocks for every copy of a joined vocabulary.
BLOCKS_A_SALT = 1024
#: Words of a block whose substrings are looked at together.
WORDS_AT_ONCE = 1 << 16

#: The bit table that rules strings out of a vocabulary has 2 ** TABLE_BITS bits, 8 MB. A string's place
#: comes from its first bytes; no piece has more than four for each of MAX_WORD_CHARS characters and its mark.
TABLE_BITS = 26
PLACE_BYTES = 512
# Any odd numbers would do.
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C55), np.uint64(0xD6E8FEB86659FD93)
# Fixed value: what continuing pieces begin with, and the hash of it.
_MARK = b"##"
_MARKED = np.uint64(((0x23 + 1) * int(_BASE) + 0x23 + 1) % (1 << 64))

ENCODED_TYPE = "struct<input_ids:array<int>,n_real:int>"
BLOCK_TYPE = "_block long, _rows binary, _words binary, _wanted array<string>"


def normalized(text: Column, normalizer: str = "simple") -> Column:
    """Text whose words, split at white space, are the words to look up; never null.

    ``simple`` lowers, ``punctuation`` also sets ASCII punctuation apart, ``wordpiece``
    follows uncased WordPiece: control characters and accents go, punctuation and
    ideographs stand alone. (Case and precomposed accents are then handled with the
    pieces, once per distinct word of a batch.)
    """
    if normalizer == "simple":
        text = F.lower(text)
    elif normalizer == "punctuation":
        text = F.regexp_replace(F.lower(text), r"[!-/:-@\[-`{-~]", " $0 ")
    elif normalizer == "wordpiece":
        text = F.regexp_replace(F.regexp_replace(text, _DROPPED, ""), _SET_APART, " $0 ")
    else:
        raise ValueError("normalizer must be 'simple', 'punctuation' or 'wordpiece'")
    return F.coalesce(text, F.lit(""))


def word_array(text: Column, normalizer: str = "simple") -> Column:
    """The normalised words of a text."""
    return words(normalized(text, normalizer))


def count_words(df: DataFrame, text: str, normalizer: str = "simple") -> DataFrame:
    """Occurrences of every distinct word: ``(token, n)``, combined before the shuffle."""
    exploded = df.select(F.explode(word_array(F.col(text), normalizer)).alias("token"))
    return exploded.groupBy("token").agg(F.count("*").alias("n"))


def build_vocab(
    df: DataFrame,
    text: str,
    size: int,
    normalizer: str = "simple",
    subwords: bool = False,
    max_word_chars: int = MAX_WORD_CHARS,
    scratch: list[str] | None = None,
) -> DataFrame:
    """Vocabulary ``(token, id, n)`` of the most frequent tokens, special tokens first.

    ``size`` counts the special tokens. Ties go to the smaller token. With ``subwords``
    the candidates are the beginnings of words and, marked ``##``, their endings and
    single inner characters, each weighted by the word's count; words of more than
    ``max_word_chars`` characters, which encoding takes as unknown, give none. The words are counted when
    this is called, once. The table that the result reads is added to ``scratch``: it can go
    when the result is written.
    """
    if size <= len(SPECIAL_TOKENS):
        raise ValueError(f"size must exceed the {len(SPECIAL_TOKENS)} special tokens")
    counts = count_words(df, text, normalizer)
    if subwords:
        counts = _piece_counts(counts, max_word_chars)
    ordinary = counts.filter(~F.col("token").isin(*SPECIAL_TOKENS))
    return _ranked(ordinary, size - len(SPECIAL_TOKENS), df.sparkSession, [] if scratch is None else scratch)


def _ranked(counts: DataFrame, k: int, spark: SparkSession, scratch: list[str]) -> DataFrame:
    """The ``k`` most frequent tokens behind the special ones, with their ids.

    The counts are stored once. From their histogram comes the frequency at which the
    vocabulary ends; tokens below it are dropped, the others are sorted in ranges, and a
    range's first id follows from the sizes of the ranges before it. No task sees all tokens.
    """
    counted: list[str] = []
    counts = _stored(counts, "counts", counted)
    ranged = counts.filter(F.col("n") >= _least_count(counts, k))
    ranged = ranged.repartitionByRange(F.desc("n"), "token").sortWithinPartitions(
        F.desc("n"), "token"
    )
    place = F.monotonically_increasing_id()
    ranged = _stored(
        ranged.select(
            "token",
            "n",
            F.shiftright(place, 33).alias("part"),
            place.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
        ),
        "ranges",
        scratch,
    )
    remove(spark, counted)
    sizes = dict(ranged.groupBy("part").agg(F.count("*")).collect())
    first, starts = len(SPECIAL_TOKENS), {}
    for part in sorted(sizes):
        starts[part] = first
        first += sizes[part]
    start = F.lit(0).cast("bigint")
    if starts:
        pairs = [F.lit(x).cast("bigint") for item in starts.items() for x in item]
        start = F.create_map(*pairs)[F.col("part")]
    ranked = ranged.select("token", (start + F.col("at")).alias("id"), "n")
    ranked = ranked.filter(F.col("id") < k + len(SPECIAL_TOKENS))
    rows = ", ".join(f"('{t}', {i}, 0L)" for i, t in enumerate(SPECIAL_TOKENS))
    special = spark.sql(f"SELECT * FROM VALUES {rows} AS special(token, id, n)")
    return special.unionByName(ranked.withColumn("id", F.col("id").cast("int")))


def _least_count(counts: DataFrame, k: int) -> int:
    """The count of the ``k``-th most frequent token, 1 if there are fewer.

    First the power of two that it lies above, then the count itself: the rows collected are
    distinct counts between two powers of two.
    """
    power = F.floor(F.log2("n"))
    left = k
    for row in sorted(counts.groupBy(power.alias("p")).count().collect(), reverse=True):
        if row["count"] >= left:
            within = counts.filter(power == row["p"]).groupBy("n").count().collect()
            for n, tokens in sorted(within, reverse=True):
                left -= tokens
                if left <= 0:
                    return n
        left -= row["count"]
    return 1


def _stored(df: DataFrame, name: str, scratch: list[str]) -> DataFrame:
    """The table written to the shared folder, which ``scratch`` gains, and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    scratch.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _piece_counts(counts: DataFrame, max_word_chars: int) -> DataFrame:
    """Weighted candidate pieces, from distinct words only."""
    token, length = F.col("token"), F.length("token")
    positions = F.sequence(F.lit(1), length)
    heads = F.transform(positions, lambda i: F.substr(token, F.lit(1), i))
    tails = F.transform(positions, lambda i: F.concat(F.lit("##"), F.substr(token, i + 1)))
    inner = F.transform(positions, lambda i: F.concat(F.lit("##"), F.substr(token, i, F.lit(1))))
    # The tail after the last character is empty; the first character is no continuation.
    pieces = F.concat(heads, F.slice(tails, 1, length - 1), F.slice(inner, F.lit(2), length - 1))
    return (
        counts.filter(length <= max_word_chars)
        # A two-letter word's tail is its inner character too: count it once per word.
        .select(F.explode(F.array_distinct(pieces)).alias("token"), "n")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Vocabulary ``(token, id)`` from a file with one token per line; the id is the line."""
    lines = spark.read.text(path, wholetext=True).select(
        F.posexplode(F.split("value", "\r?\n")).alias("id", "token")
    )
    return lines.filter(F.col("token") != "").select("token", "id")


def encode(
    df: DataFrame,
    vocab: DataFrame,
    text: str = "combined_text",
    max_length: int = MAX_LENGTH,
    normalizer: str = "simple",
    subwords: bool = False,
    key: str | None = None,
    keep_text: bool = False,
    strategy: str = "broadcast",
    max_tokens: int = MAX_BROADCAST_TOKENS,
    scratch: list[str] | None = None,
) -> DataFrame:
    """Replace a text column by ``input_ids`` and ``attention_mask`` of fixed length.

    ``[CLS]`` + tokens + ``[SEP]``, truncated and padded to ``max_length``; the mask is 1
    for real tokens. With ``subwords`` a word outside the vocabulary is split into its
    longest pieces.

    Strategy ``broadcast`` reads the vocabulary when this is called and refuses one of more
    than ``max_tokens`` rows; ``join`` takes any vocabulary and a unique ``key``
    (:func:`encode_joined`, which adds to ``scratch``). Both give the same arrays.
    """
    _check_length(max_length)
    if strategy not in STRATEGIES:
        raise ValueError(f"The strategy is one of {STRATEGIES}, not {strategy!r}.")
    if strategy == "join":
        if key is None:
            raise ValueError("Joining a vocabulary takes a unique key.")
        options = {"subwords": subwords, "keep_text": keep_text, "scratch": scratch}
        return encode_joined(df, vocab, key, text, max_length, normalizer, **options)
    table = _collected(vocab, max_tokens)
    plain = normalizer == "wordpiece"
    encoder = _encoder(df.sparkSession, table, max_length, subwords, plain)
    encoded = df.withColumn("_encoded", encoder(normalized(F.col(text), normalizer)))
    mask = _mask(F.col("_encoded.n_real"), max_length).alias("attention_mask")
    dropped = ["_encoded"] if keep_text else ["_encoded", text]
    return encoded.select("*", "_encoded.input_ids", mask).drop(*dropped)


def encode_joined(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    text: str = "combined_text",
    max_length: int = MAX_LENGTH,
    normalizer: str = "simple",
    salts: int = 32,
    subwords: bool = False,
    keep_text: bool = False,
    scratch: list[str] | None = None,
) -> DataFrame:
    """:func:`encode` for a vocabulary of any size, by joins on the word.

    The rows of each task go into blocks of ``BLOCK_ROWS`` at most, which are stored: a block has the
    numbers of its rows' words and its distinct words, packed, and the distinct strings to look up, words
    or, with ``subwords``, the substrings that they can be cut into. Strings that a bit table of the
    vocabulary rules out are not among them. Only these strings are joined to the vocabulary and come back to their block, where one Arrow function
    cuts the words and replaces them by their ids: neither the texts nor every substring of a word is
    shuffled. Where a word may come from many blocks, the vocabulary is copied to up to ``salts`` join keys,
    over which they spread. A key that is null or not unique is refused before anything is encoded. The
    table of the blocks is written when this is called and added to ``scratch``: it can go when the
    result is written.
    """
    _check_length(max_length)
    by_key = df.groupBy(key).agg(F.count("*").alias("n"))
    bad = F.when((F.col("n") > 1) | F.col(key).isNull(), F.struct(F.col(key).cast("string")))
    n_rows, wrong = by_key.agg(F.sum("n"), F.first(bad, ignorenulls=True)).first()
    if wrong is not None:
        raise ValueError(f"Key is not unique: {wrong[0]}")
    specials = _special_ids(vocab.filter(F.col("token").isin(*SPECIAL_TOKENS)).toArrow())
    room, plain = max_length - 2, normalizer == "wordpiece"
    reachable = F.slice(word_array(F.col(text), normalizer), 1, max(room, 1))
    rows = df.select(F.col(key).alias("_key"), reachable.alias("_words"))
    blocks = rows.mapInArrow(_block_builder(df.sparkSession, vocab, subwords, plain), BLOCK_TYPE)
    blocks = _stored(blocks, "blocks", [] if scratch is None else scratch)
    wanted = blocks.select("_block", F.explode(F.array_distinct("_wanted")).alias("token"))
    known, on = vocab.select("token", F.col("id").cast("int").alias("id")), ["token"]
    copies = min(salts, (n_rows or 0) // (BLOCK_ROWS * BLOCKS_A_SALT))
    if copies > 1:
        on = ["token", "_salt"]
        known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        wanted = wanted.withColumn("_salt", F.pmod(F.xxhash64("_block"), F.lit(copies)).cast("int"))
    found = wanted.join(known, on).select(F.col("_block").alias("_of"), "token", "id")
    ids_type = T.StructType().add("_key", df.schema[key].dataType).add("_ids", T.ArrayType(T.IntegerType()))
    by_row = (
        blocks.drop("_wanted")
        .groupBy("_block")
        .cogroup(found.groupBy("_of"))
        .applyInArrow(_block_encoder(room, specials[UNK], subwords, plain), ids_type)
        .withColumnRenamed("_key", key)
    )
    joined = df.join(by_row, key, "left")
    ids = F.coalesce("_ids", F.array().cast("array<int>"))
    n_pad = F.lit(max_length - 2) - F.size(ids)
    framed = F.concat(
        F.array(F.lit(specials[CLS])),
        ids,
        F.array(F.lit(specials[SEP])),
        F.array_repeat(F.lit(specials[PAD]), n_pad),
    )
    mask = _mask(F.size(ids) + 2, max_length)
    out = joined.withColumn("input_ids", framed).withColumn("attention_mask", mask)
    return out.drop("_ids", *([] if keep_text else [text]))


def _block_builder(spark: SparkSession, vocab: DataFrame, subwords: bool, plain: bool):
    """Arrow function from rows with their words to blocks, of ``BLOCK_TYPE``.

    A row's codes are places in the block's words. Without ``subwords`` these are only the words that
    may be in the vocabulary; the place behind them stands for all others.
    """
    bits, longest = _token_bits(vocab)
    shared, most = spark.sparkContext.broadcast(bits), BLOCK_ROWS

    def block(rows: pa.RecordBatch, number: int) -> pa.RecordBatch:
        word_lists = rows["_words"]
        coded = word_lists.flatten().dictionary_encode()
        codes, words_of = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.string())
        if subwords:
            wanted = _candidates(words_of, plain, shared.value, longest)
        else:
            may = _in_table(shared.value, _places(words_of))
            places = np.where(may, np.cumsum(may) - 1, np.count_nonzero(may))
            codes, wanted = places[codes], words_of.filter(pa.array(may))
            words_of = wanted
        per_row = pc.list_value_length(word_lists).to_numpy(zero_copy_only=False)
        code_lists = _lists(pa.array(codes.astype(np.int32)), per_row)
        packed = [_packed([rows["_key"], code_lists], ["_key", "_codes"]), _packed([words_of], ["_words"])]
        columns = [pa.array([number]), *(pa.array([p], pa.binary()) for p in packed), _lists(wanted, [len(wanted)])]
        return pa.RecordBatch.from_arrays(columns, names=["_block", "_rows", "_words", "_wanted"])

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                yield block(batch.slice(at, most), number)
                number += 1

    return run


def _packed(columns: list[pa.Array], names: list[str]) -> bytes:
    """Columns as one compressed string of bytes."""
    batch, sink = pa.RecordBatch.from_arrays(columns, names=names), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: pa.ChunkedArray) -> pa.RecordBatch:
    return pa.ipc.open_stream(packed[0].as_buffer()).read_next_batch()


def _block_encoder(room: int, unknown: int, subwords: bool, plain: bool):
    """Arrow function from a block and the ids of its known strings to the first ids of each row."""

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        rows, words_of = _unpacked(block["_rows"]), _unpacked(block["_words"])["_words"]
        code_lists = rows["_codes"]
        found = found.sort_by("id")
        known, ids = found["token"].combine_chunks(), found["id"].to_numpy().astype(np.int32)
        if subwords:
            id_of = dict(zip(known.to_pylist(), ids.tolist())) | {UNK: unknown}
            longest = pc.max(pc.utf8_length(known)).as_py() or 0
            split = [split_word(w, id_of, longest, UNK, plain) for w in words_of.to_pylist()]
            sizes = np.array([len(s) for s in split], dtype=np.int64)
            flat = np.array([id_of[p] for s in split for p in s], dtype=np.int32)
        else:
            at = pc.index_in(words_of, value_set=known).fill_null(len(known))
            # A word that was not found takes the id behind the others, as do the words left out.
            flat = np.append(ids, np.int32(unknown))[np.append(at.to_numpy(zero_copy_only=False), len(known))]
            sizes = np.ones(len(flat), dtype=np.int64)
        row = np.repeat(
            np.arange(rows.num_rows), pc.list_value_length(code_lists).to_numpy(zero_copy_only=False)
        )
        which = code_lists.flatten().to_numpy(zero_copy_only=False)
        run_sizes = sizes[which]
        row_ids = flat[_run_positions((np.cumsum(sizes) - sizes)[which], run_sizes)]
        row_sizes = np.bincount(np.repeat(row, run_sizes), minlength=rows.num_rows)
        fits = _run_positions(np.zeros(rows.num_rows, dtype=np.int64), row_sizes) < room
        lists = _lists(pa.array(row_ids[fits]), np.minimum(row_sizes, room))
        return pa.table([rows["_key"], lists], names=["_key", "_ids"])

    return run


def _token_bits(vocab: DataFrame) -> tuple[np.ndarray, int]:
    """A bit table with the place of every token set, 64 bits a number, and the most bytes of a token.

    Its size does not depend on the vocabulary: the more tokens, the more strings that are none pass it.
    """

    @F.arrow_udf("long")
    def place_of(tokens: pa.Array) -> pa.Array:
        return pa.array(_places(tokens.cast(pa.string())))

    places = vocab.select(place_of("token").alias("place"), F.octet_length("token").alias("size"))
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    found = places.groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits"), F.max("size").alias("size"))
    found = found.toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), dtype=np.uint64)
    table[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return table, pc.max(found["size"]).as_py() or 0


def _in_table(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


def _bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings end to end, and where each begins and the last one ends."""
    offsets = np.frombuffer(strings.buffers()[1] or b"\0\0\0\0", dtype=np.int32)
    offsets = offsets[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = np.frombuffer(strings.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _growing(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray):
    """Hashes strings byte by byte: of those that have another byte, which, where it ends, their place."""
    which = np.arange(len(starts))
    at = starts
    while True:
        more = at < ends
        which, at, ends, state = which[more], at[more], ends[more], state[more]
        if not len(which):
            return
        state = state * _BASE + data[at] + np.uint64(1)
        at = at + 1
        yield which, at, ((state * _MIX) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _places(strings: pa.Array) -> np.ndarray:
    """Places of strings in the bit table, by their first ``PLACE_BYTES`` bytes."""
    data, offsets = _bytes(strings)
    ends = np.minimum(offsets[1:], offsets[:-1] + PLACE_BYTES)
    places = np.zeros(len(strings), dtype=np.int64)
    for which, at, place in _growing(data, offsets[:-1], ends, np.zeros(len(strings), dtype=np.uint64)):
        places[which] = place
    return places


def _candidates(words_of: pa.Array, plain: bool, table: np.ndarray, longest: int) -> pa.Array:
    """Pieces that words may be cut into: substrings, those inside a word marked, that the table does not rule out.

    Few are named more than once.
    """
    if plain:
        # A spelled-out special token is itself or its parts, as the vocabulary has it.
        parts = ((w, *word_parts(w, True)) if w in SPELLED_TOKENS else word_parts(w, True) for w in words_of.to_pylist())
        words_of = pa.array([p for some in parts for p in some], pa.string())
    words_of = words_of.filter(pc.less_equal(pc.utf8_length(words_of), MAX_WORD_CHARS))
    starts = range(0, len(words_of), WORDS_AT_ONCE)
    found = [p for at in starts for p in _pieces(words_of.slice(at, WORDS_AT_ONCE), table, longest)]
    return pa.concat_arrays([pa.array([], pa.string()), *found])


def _pieces(words_of: pa.Array, table: np.ndarray, longest: int):
    data, offsets = _bytes(words_of)
    # Characters begin at bytes that continue no other one.
    begins = np.append((data & 0xC0) != 0x80, True)
    starts = np.flatnonzero(begins[:-1])
    ends = np.repeat(offsets[1:], np.diff(offsets))[starts]
    head = np.zeros(len(data), dtype=bool)
    head[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    head = head[starts]
    state = np.where(head, np.uint64(0), _MARKED)
    ends = np.minimum(ends, starts + np.where(head, longest, longest - len(_MARK)))
    for size, (which, at, place) in enumerate(_growing(data, starts, ends, state), 1):
        which = which[begins[at] & _in_table(table, place)]
        for mark, some in ((b"", which[head[which]]), (_MARK, which[~head[which]])):
            if len(some):
                yield _distinct(data[starts[some][:, None] + np.arange(size)], mark)


def _distinct(rows: np.ndarray, mark: bytes) -> pa.Array:
    """The distinct rows of a matrix of bytes as strings behind a mark."""
    n, size = rows.shape
    kinds = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), n, [None, pa.py_buffer(rows.tobytes())]).unique()
    kept = np.frombuffer(kinds.buffers()[1], dtype=np.uint8)[: len(kinds) * size].reshape(-1, size)
    marks = np.tile(np.frombuffer(mark, dtype=np.uint8), (len(kept), 1))
    offsets = np.arange(len(kept) + 1, dtype=np.int32) * (size + len(mark))
    values = np.hstack([marks, kept]).tobytes()
    return pa.StringArray.from_buffers(len(kept), pa.py_buffer(offsets.tobytes()), pa.py_buffer(values))


def ensure_encoded(df: DataFrame, vocab: DataFrame | None = None, **options) -> DataFrame:
    """Use stored token arrays where the input has them, else encode its text."""
    if "input_ids" in df.columns and "attention_mask" in df.columns:
        return df
    if vocab is None:
        raise ValueError("The input is not encoded and there is no vocabulary.")
    return encode(df, vocab, **options)


def subword_table(
    distinct_words: DataFrame,
    vocab: DataFrame,
    token: str = "token",
    plain: bool = False,
    strategy: str = "broadcast",
    max_tokens: int = MAX_BROADCAST_TOKENS,
) -> DataFrame:
    """Pieces of each distinct word: adds ``pieces`` (array of strings) and ``piece_ids``.

    Longest piece first from the left, later pieces marked ``##``; a word that cannot be
    covered is ``[UNK]``. ``plain`` removes capitals and accents first. Strategy
    ``broadcast`` refuses a vocabulary of more than ``max_tokens`` rows; ``join`` takes any and
    joins each word's substrings to it.
    """
    if strategy == "join":
        return _joined_pieces(distinct_words, vocab, token, plain)
    table = _collected(vocab, max_tokens)
    _special_ids(table)
    shared = distinct_words.sparkSession.sparkContext.broadcast(_token_ids(table))
    longest = _longest(table)

    @F.arrow_udf("array<string>")
    def pieces_of(tokens: pa.Array) -> pa.Array:
        known = shared.value
        return pa.array(
            [split_word(w, known, longest, UNK, plain) for w in tokens.to_pylist()],
            pa.list_(pa.string()),
        )

    @F.arrow_udf("array<int>")
    def ids_of(pieces: pa.Array) -> pa.Array:
        known = shared.value
        ids = pa.array([known[p] for p in pieces.flatten().to_pylist()], pa.int32())
        lengths = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        return _lists(ids, lengths)

    return distinct_words.withColumn("pieces", pieces_of(token)).withColumn(
        "piece_ids", ids_of("pieces")
    )


def _joined_pieces(words_df: DataFrame, vocab: DataFrame, token: str, plain: bool) -> DataFrame:
    """:func:`subword_table` by a join of every substring, a word at most once per part."""
    known = vocab.select(F.col("token").alias("_piece"), F.col("id").alias("_id"))
    longest = known.agg(F.max(F.length("_piece"))).first()[0] or 0

    # Spelled-out special tokens stand for themselves where the vocabulary has them.
    spelled_tokens = [r[0] for r in known.select("_piece").filter(F.col("_piece").isin(*SPELLED_TOKENS)).collect()]

    @F.arrow_udf("array<string>")
    def parts_of(tokens: pa.Array) -> pa.Array:
        spelled = [word_parts(w, plain, spelled_tokens) for w in tokens.to_pylist()]
        return pa.array(spelled, pa.list_(pa.string()))

    parts = words_df.withColumn("_parts", parts_of(token))
    exploded = parts.select(token, F.posexplode("_parts").alias("_part", "_word"))
    size = F.length("_word")
    cuts = (
        exploded.filter(size <= MAX_WORD_CHARS)
        .select(token, "_part", "_word", F.explode(F.sequence(F.lit(1), size)).alias("_from"))
        .select(
            "*",
            F.explode(
                F.sequence(F.lit(1), F.least(size - F.col("_from") + 1, F.lit(longest)))
            ).alias("_size"),
        )
    )
    mark = F.when(F.col("_from") > 1, F.lit("##")).otherwise("")
    piece = F.concat(mark, F.substr("_word", F.col("_from"), F.col("_size")))
    matched = cuts.withColumn("_piece", piece).join(known, "_piece")
    # Length and id in one number, which is aggregated by hashing; the piece follows from the length.
    sized = F.shiftleft(F.col("_size").cast("bigint"), 32).bitwiseOR(F.col("_id").cast("bigint"))
    best = matched.groupBy(token, "_part", "_from").agg(F.max(sized).alias("best"))
    by_part = best.groupBy(token, "_part").agg(
        F.sort_array(F.collect_list(F.struct("_from", "best"))).alias("_best")
    )
    unknown = vocab.filter(F.col("token") == UNK).select("id").first()[0]
    empty = F.struct(
        F.lit(1).alias("next"),
        F.array().cast("array<string>").alias("pieces"),
        F.array().cast("array<int>").alias("ids"),
    )

    def follow(state, start):
        length = F.shiftright(start["best"], 32).cast("int")
        found = F.concat(
            F.when(start["_from"] > 1, F.lit("##")).otherwise(""), F.substr("_word", start["_from"], length)
        )
        found_id = start["best"].bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        step = F.struct(
            (state["next"] + length).alias("next"),
            F.concat(state["pieces"], F.array(found)).alias("pieces"),
            F.concat(state["ids"], F.array(found_id)).alias("ids"),
        )
        return F.when(start["_from"] == state["next"], step).otherwise(state)

    walked = (
        exploded.join(by_part, [token, "_part"], "left")
        .withColumn("_walk", F.aggregate(F.coalesce("_best", F.array()), empty, follow))
        .withColumn("_whole", F.col("_walk.next") == size + 1)
    )
    pieces = F.when(F.col("_whole"), F.col("_walk.pieces")).otherwise(F.array(F.lit(UNK)))
    ids = F.when(F.col("_whole"), F.col("_walk.ids")).otherwise(F.array(F.lit(unknown)))
    by_word = walked.groupBy(token).agg(
        F.sort_array(F.collect_list(F.struct("_part", pieces.alias("p"), ids.alias("i")))).alias("_all")
    )
    none_text, none_ids = F.array().cast("array<string>"), F.array().cast("array<int>")
    return words_df.join(by_word, token, "left").select(
        *words_df.columns,
        F.coalesce(F.flatten("_all.p"), none_text).alias("pieces"),
        F.coalesce(F.flatten("_all.i"), none_ids).alias("piece_ids"),
    )


def _collected(vocab: DataFrame, max_tokens: int) -> pa.Table:
    table = vocab.select("token", "id").limit(max_tokens + 1).toArrow()
    if table.num_rows > max_tokens:
        raise ValueError(
            f"The vocabulary has over {max_tokens} tokens; use strategy 'join' or raise max_tokens."
        )
    return table


def _check_length(max_length: int) -> None:
    if max_length < 2:
        raise ValueError("max_length must leave room for [CLS] and [SEP]")


def _mask(n_real: Column, max_length: int) -> Column:
    """1 for each real token, 0 for padding."""
    zeros = F.array_repeat(F.lit(0), F.lit(max_length) - n_real)
    return F.concat(F.array_repeat(F.lit(1), n_real), zeros)


def _token_ids(table: pa.Table) -> dict[str, int]:
    return dict(zip(table["token"].to_pylist(), table["id"].to_pylist()))


def _longest(table: pa.Table) -> int:
    return pc.max(pc.utf8_length(table["token"])).as_py() or 0


def _special_ids(table: pa.Table) -> dict[str, int]:
    ids = _token_ids(table)
    missing = [t for t in SPECIAL_TOKENS if t not in ids]
    if missing:
        raise ValueError(f"The vocabulary lacks {missing}")
    return ids


def _lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def padded_lists(ids: np.ndarray, n_real: np.ndarray) -> pa.Array:
    """Rows of padded ids and their numbers of real ones, of ``ENCODED_TYPE``."""
    lists = _lists(pa.array(ids.ravel()), np.full(*ids.shape))
    return pa.StructArray.from_arrays([lists, pa.array(n_real)], names=["input_ids", "n_real"])


def _encoder(
    spark: SparkSession, table: pa.Table, max_length: int, subwords: bool, plain: bool
):
    """Arrow function from normalised texts to padded ids and their number, batch by batch."""
    specials = _special_ids(table)
    token_ids = _token_ids(table) if subwords else {}
    token_array = table["token"].combine_chunks()
    id_array = table["id"].to_numpy().astype(np.int32)
    shared = spark.sparkContext.broadcast((token_array, id_array, token_ids))
    pad, unk, cls, sep = (specials[t] for t in SPECIAL_TOKENS)
    room = max_length - 2
    longest = _longest(table)

    def ids_of(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each distinct word, end to end, and how many each word has."""
        tokens, ids, known = shared.value
        sizes = np.ones(len(distinct), dtype=np.int64)
        looked_up = pc.ascii_lower(distinct) if plain else distinct
        at = pc.index_in(looked_up, value_set=tokens)
        whole = pc.is_valid(at)
        at = at.fill_null(0).to_numpy(zero_copy_only=False)
        if not subwords:
            return np.where(whole.to_numpy(zero_copy_only=False), ids[at], unk), sizes
        # A known word is its own longest piece; only the others are split.
        whole = pc.and_(whole, pc.less_equal(pc.utf8_length(distinct), MAX_WORD_CHARS))
        if plain:
            whole = pc.and_(whole, pc.string_is_ascii(distinct))
        whole = whole.to_numpy(zero_copy_only=False)
        rest = distinct.filter(pa.array(~whole)).to_pylist()
        split = [[known[p] for p in split_word(w, known, longest, UNK, plain)] for w in rest]
        sizes[~whole] = [len(s) for s in split]
        flat = np.empty(int(sizes.sum()), dtype=np.int32)
        from_whole = np.repeat(whole, sizes)
        flat[from_whole] = ids[at[whole]]
        flat[~from_whole] = [i for s in split for i in s]
        return flat, sizes

    @F.arrow_udf(ENCODED_TYPE)
    def run(texts: pa.Array) -> pa.Array:
        n = len(texts)
        out = np.full((n, max_length), pad, dtype=np.int32)
        n_real = np.full(n, 2, dtype=np.int32)
        out[:, 0] = cls
        # The words of a few rows at a time, of which only numbers and the distinct ones stay.
        starts = range(0, n, ROWS_AT_ONCE)
        parts = [_first_words(texts.slice(at, ROWS_AT_ONCE), room) for at in starts]
        if not parts:
            return padded_lists(out, n_real)
        # Look up each distinct word of the batch once.
        seen = pa.chunked_array([words_seen for words_seen, _ in parts]).unify_dictionaries()
        flat, sizes = ids_of(seen.chunk(0).dictionary)
        run_starts = np.cumsum(sizes) - sizes
        for at, words_seen, (_, per_row) in zip(starts, seen.chunks, parts):
            some = out[at : at + ROWS_AT_ONCE]
            # Replace every word by its run of ids.
            which = words_seen.indices.to_numpy(zero_copy_only=False)
            run_sizes = sizes[which]
            ids = flat[_run_positions(run_starts[which], run_sizes)]
            # Place the runs into the rows, cutting what does not fit.
            row = np.repeat(np.repeat(np.arange(len(some)), per_row), run_sizes)
            row_sizes = np.bincount(row, minlength=len(some))
            column = _run_positions(np.zeros(len(some), dtype=np.int64), row_sizes)
            fits = column < room
            kept = np.minimum(row_sizes, room)
            some[row[fits], column[fits] + 1] = ids[fits]
            some[np.arange(len(some)), kept + 1] = sep
            n_real[at : at + ROWS_AT_ONCE] = kept + 2
        return padded_lists(out, n_real)

    return run


def _first_words(texts: pa.Array, room: int) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts end to end, ``room`` of each text at most, and how many each has.

    Splits at the same characters as the JVM does for the vocabulary. A word gives at least one
    id, so words beyond the room cannot be reached; what follows them is not split.
    """
    most = max(room, 1)
    trimmed = pc.utf8_trim_whitespace(texts)
    word_lists = pc.list_slice(pc.utf8_split_whitespace(trimmed, max_splits=most), 0, most)
    per_row = pc.list_value_length(word_lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # An empty text has one empty word, which is none.
    per_row[pc.equal(trimmed, "").to_numpy(zero_copy_only=False)] = 0
    all_words = word_lists.flatten()
    return all_words.filter(pc.not_equal(all_words, "")).dictionary_encode(), per_row


def _run_positions(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` (``sizes[i]`` numbers) for every i, end to end."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)
