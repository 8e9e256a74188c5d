"""Subword vocabularies trained on a corpus by merging pairs of symbols.

The corpus counts once, as distinct words with their number. A word is a string with one character
per symbol, so that a merge is a replacement within the string and needs no join. Two tables live
from round to round: the words, and the occurrences of every pair of neighbouring symbols. A round

1. collects the best pairs, a bounded number, and takes from them, best first, until one shares a symbol
   with those before it: what is taken so can't change the counts of the others, and no pair that the
   merges create can come before them;
2. rewrites the words, row by row. Only words that a merge has changed are shuffled: their old pairs
   are taken off the counts and their new ones put on.

Both tables are written to the shared folder every round, and the ones before are deleted.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.bytelevel import byte_alphabet, piece_pattern, tokenizer_text
from shelfmark.operators.tokens import SPECIAL_TOKENS, count_words
from shelfmark.session import remove, scratch_path

#: Pairs that a round looks at.
MOST_AT_ONCE = 256
MARK = "##"


def _character(symbol: int) -> str:
    """The character of a symbol's number; their order is that of the numbers."""
    code = 0x100 + symbol
    return chr(code if code < 0xD800 else code + 0x800)


def _number(character: str) -> int:
    code = ord(character)
    return (code if code < 0xD800 else code - 0x800) - 0x100


def _pairs(symbols: Column) -> Column:
    each = F.regexp_extract_all(symbols, F.lit("(?s)(.)"), F.lit(1))
    lefts, rights = F.slice(each, 1, F.greatest(F.size(each) - 1, F.lit(0))), F.slice(each, 2, 1 << 30)
    return F.zip_with(lefts, rights, lambda a, b: F.concat(a, b))


def train_merges(
    counts: DataFrame,
    n_merges: int,
    marked: bool = False,
    score: str = "count",
    min_count: int = 1,
    alphabet: Sequence[str] | None = None,
) -> tuple[list[str], list[tuple[str, str, int]]]:
    """Symbols to begin with, and ``(left, right, n)`` of every merge, in their order.

    ``counts`` has distinct words, ``token``, with their number, ``n``. Symbols are characters; with
    ``marked`` all but a word's first are marked ``##``. The best pair has the largest number of occurrences or,
    with ``score="likelihood"``, the largest such number over the product of its symbols' numbers
    (one pair a round then, for a merge can raise others). Of equal ones the pair with the older
    symbols comes first: by the younger one of the two, the left and the right one, those to begin with
    being in the order of their text. Training ends early when no pair has ``min_count``
    occurrences. ``alphabet`` adds symbols that the words may lack.
    """
    if score not in ("count", "likelihood"):
        raise ValueError("score must be 'count' or 'likelihood'")
    spark, paths = counts.sparkSession, []

    def store(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        given = store(counts.filter(F.col("token") != "").select("token", "n"), "words")
        each = F.regexp_extract_all(F.col("token"), F.lit("(?s)(.)"), F.lit(1))
        names = F.transform(each, lambda c, i: F.when(i > 0, F.concat(F.lit(MARK), c)).otherwise(c)) if marked else each
        found = given.select(F.explode(names).alias("s")).distinct().collect()
        symbols = sorted({r["s"] for r in found} | set(alphabet or ()))
        # First characters and others have symbols of their own if these are marked.
        first = [s for s in symbols if not (marked and s.startswith(MARK) and len(s) > len(MARK))]
        rest = [s for s in symbols if s not in set(first)] if marked else first
        at = {s: _character(i) for i, s in enumerate(symbols)}
        head = _translated(F.substring("token", 1, 1), first, at, 0)
        tail = _translated(F.substring("token", 2, 1 << 30), rest, at, len(MARK) if marked else 0)
        words = given.select(F.concat(head, tail).alias("s"), F.lit(None).cast("string").alias("old"), "n")
        words = store(words, "symbols")
        pairs = words.select(F.explode(_pairs(F.col("s"))).alias("pair"), "n")
        pairs = store(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
        start, merges = list(symbols), []
        while len(merges) < n_merges:
            taken = _best(pairs, words, n_merges - len(merges), score, min_count)
            if not taken:
                break
            written = F.col("s")
            for pair, n in taken:
                left, right = (symbols[_number(c)] for c in pair)
                merges.append((left, right, n))
                joined = left + (right[len(MARK) :] if marked and right.startswith(MARK) else right)
                symbols.append(joined)
                written = F.replace(written, F.lit(pair), F.lit(_character(len(symbols) - 1)))
            if len(merges) >= n_merges:
                break
            before = list(paths)
            changed = F.when(written != F.col("s"), F.col("s"))
            words = store(words.select(written.alias("s"), changed.alias("old"), "n"), "symbols")
            touched = words.filter(F.col("old").isNotNull())
            off = touched.select(F.explode(_pairs(F.col("old"))).alias("pair"), (-F.col("n")).alias("n"))
            on = touched.select(F.explode(_pairs(F.col("s"))).alias("pair"), "n")
            summed = pairs.unionByName(off).unionByName(on).groupBy("pair").agg(F.sum("n").alias("n"))
            pairs = store(summed.filter(F.col("n") > 0), "pairs")
            remove(spark, before)
            del paths[: len(before)]
        return start, merges
    finally:
        remove(spark, paths)


def _translated(text: Column, symbols: list[str], at: dict[str, str], skip: int) -> Column:
    return F.translate(text, "".join(s[skip:] for s in symbols), "".join(at[s] for s in symbols))


def _best(pairs: DataFrame, words: DataFrame, wanted: int, score: str, min_count: int) -> list[tuple[str, int]]:
    """The pairs that can merge in one round, best first, with their occurrences."""
    left, right = F.substring("pair", 1, 1), F.substring("pair", 2, 1)
    ties = F.greatest(left, right), left, right
    pairs = pairs.filter(F.col("n") >= min_count)
    if score == "likelihood":
        each = F.regexp_extract_all(F.col("s"), F.lit("(?s)(.)"), F.lit(1))
        # As many rows as there are symbols.
        numbers = words.select(F.explode(each).alias("symbol"), "n").groupBy("symbol").agg(F.sum("n").alias("m"))
        sides = [numbers.select(F.col("symbol").alias(c), F.col("m").alias(f"{c}_n")) for c in ("l", "r")]
        scored = pairs.withColumns({"l": left, "r": right}).join(sides[0], "l").join(sides[1], "r")
        value = F.col("n") / (F.col("l_n").cast("double") * F.col("r_n"))
        row = scored.orderBy(value.desc(), *ties).select("pair", "n").first()
        return [(row["pair"], row["n"])] if row else []
    top = pairs.orderBy(F.desc("n"), *ties).limit(min(wanted, MOST_AT_ONCE)).collect()
    taken, used = [], set()
    for row in top:
        if used & set(row["pair"]):
            break
        used |= set(row["pair"])
        taken.append((row["pair"], row["n"]))
    return taken


def merge_table(spark, merges: list[tuple[str, str, int]]) -> DataFrame:
    """``rank, left, right, n``, from 0."""
    rows = [(rank, *m) for rank, m in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left string, right string, n long")


def train_wordpiece(
    df: DataFrame, text: str, size: int, normalizer: str = "simple", score: str = "likelihood", min_count: int = 2
) -> DataFrame:
    """Vocabulary ``(token, id)`` for ``tokens.encode(..., subwords=True)``, special tokens first.

    Then come the characters in their order and the merged pieces in the order of their merges;
    ``size`` counts all.
    """
    spark, counts = df.sparkSession, count_words(df, text, normalizer)
    counts = counts.filter(~F.col("token").isin(*SPECIAL_TOKENS))
    path = scratch_path(spark, "counts")
    counts.write.parquet(path)
    try:
        counts = spark.read.parquet(path)
        each = F.regexp_extract_all(F.col("token"), F.lit("(?s)(.)"), F.lit(1))
        names = F.transform(each, lambda c, i: F.when(i > 0, F.concat(F.lit(MARK), c)).otherwise(c))
        n_symbols = counts.select(F.explode(names)).distinct().count()
        room = size - len(SPECIAL_TOKENS) - n_symbols
        start, merges = train_merges(counts, max(room, 0), True, score, min_count)
    finally:
        remove(spark, [path])
    pieces = [left + right.removeprefix(MARK) for left, right, _ in merges]
    tokens = list(dict.fromkeys([*SPECIAL_TOKENS, *start, *pieces]))
    return spark.createDataFrame(list(zip(tokens, range(len(tokens)))), "token string, id int")


def count_pieces(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of every piece that byte-level encoding cuts texts into, its bytes as characters."""
    alphabet = byte_alphabet()

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        pattern, known = piece_pattern(), {}
        out = []
        for value in texts.to_pylist():
            pieces = pattern.findall(value or "")
            for piece in pieces:
                if piece not in known:
                    known[piece] = "".join(alphabet[b] for b in piece.encode())
            out.append([known[p] for p in pieces])
        return pa.array(out, pa.list_(pa.string()))

    exploded = df.select(F.explode(cut(F.col(text))).alias("token"))
    return exploded.groupBy("token").agg(F.count("*").alias("n"))


def train_byte_level(df: DataFrame, text: str, n_merges: int, specials: Sequence[str], min_count: int = 2) -> str:
    """The text of a tokenizer file with a byte-level merge list trained on the texts."""
    _, merges = train_merges(count_pieces(df, text), n_merges, min_count=min_count, alphabet=byte_alphabet())
    return tokenizer_text([(left, right) for left, right, _ in merges], specials)
