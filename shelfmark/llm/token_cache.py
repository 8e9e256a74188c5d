"""Token counts through a digest cache (operator 2).

A document's content digest and the digest of the tokenizer's version are joined to the stored
counts. Only contents without a stored count are encoded, each once however many documents hold
it, and the new counts are appended to the cache, a Parquet table in the shared folder. What
another run appended at the same time doesn't matter: equal keys have equal counts.

Defined results: a null text counts as empty (0 bytes, 0 tokens); rows with equal texts, null ids
and repeated rows each get a row; an empty table gives an empty result and appends nothing; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import map_batches, texts
from shelfmark.session import shared_dir

CACHE_SCHEMA = "content binary, tokenizer binary, n_tokens long"
#: Words of a generation of those whose counts a worker keeps, and of those that it has met once. It
#: remembers two generations of each: when one is full, the older of the two goes.
MEMO_WORDS = 200_000
ONCE_WORDS = 500_000
#: Words that are handed to the tokenizer at once, whose encodings take some kB each, and rows
#: whose words are held at once.
ENCODE_WORDS = 2_000
ROWS = 256
_BLANK_RUNS = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class TokenizerFile:
    """A vocabulary file: ``.json`` of the tokenizers library or ``.model`` of sentencepiece.

    ``by_word`` states that the tokenizer drops blanks and never merges across them. Then blanks
    are normalised away before the digest, and a text's count is the sum over its words.
    """

    path: str
    by_word: bool = False

    def content(self) -> bytes:
        with open(self.path, "rb") as file:
            return file.read()

    def digest(self) -> bytes:
        """Digest of the vocabulary, the library's version and the normalisation."""
        if self.path.endswith(".model"):
            import sentencepiece as library
        else:
            import tokenizers as library
        version = f"{library.__name__} {library.__version__} by_word={self.by_word}\n"
        return hashlib.sha256(version.encode() + self.content()).digest()


def counter(tokenizer: TokenizerFile, content: bytes):
    """A function from a list of texts to their numbers of tokens, without added tokens."""
    if tokenizer.path.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda batch: [len(ids) for ids in processor.encode(batch, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import Tokenizer

    model = Tokenizer.from_buffer(content)
    model.no_truncation()
    model.no_padding()
    return lambda batch: [
        len(e.ids) for e in model.encode_batch_fast(batch, add_special_tokens=False)
    ]


def normalised(text: Column, tokenizer: TokenizerFile) -> Column:
    if not tokenizer.by_word:
        return text
    return F.trim(F.regexp_replace(text, _BLANK_RUNS, " "))


class WordCounter:
    """Token counts of texts as the sums over their words.

    Most words of a corpus are met once. A word is first counted together with the other new words
    of its text, which is cheaper than alone; the second time it is counted alone and remembered.
    """

    def __init__(self, count):
        self.count = count
        self.memo: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.once: set[int] = set()
        self.older_once: set[int] = set()

    def __call__(self, batch: list[str]) -> list[int]:
        rows = [text.split(" ") if text else [] for text in batch]
        self._remember(rows)
        memo, totals, new = self.memo, [], []
        for i, row in enumerate(rows):
            known = [memo.get(w) for w in row]
            if None in known:
                new.append((i, " ".join([w for w, n in zip(row, known) if n is None])))
            totals.append(sum(n for n in known if n))
        for (i, _), n in zip(new, self.count([text for _, text in new])):
            totals[i] += n
        return totals

    def _remember(self, rows: list[list[str]]) -> None:
        """Count the words that come again, here or from before; note the others."""
        if len(self.memo) >= MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        if len(self.once) >= ONCE_WORDS:
            self.once, self.older_once = set(), self.once
        memo, again, met = self.memo, {}, set()
        for row in rows:
            for word in row:
                if word in memo:
                    continue
                if word in self.older:
                    memo[word] = self.older[word]
                elif word in met:
                    again[word] = None
                else:
                    met.add(word)
        for word in met:
            key = hash(word)
            if word not in again and (key in self.once or key in self.older_once):
                again[word] = None
            self.once.add(key)
        words = list(again)
        for at in range(0, len(words), ENCODE_WORDS):
            part = words[at : at + ENCODE_WORDS]
            memo.update(zip(part, self.count(part)))


#: The counter of a worker, which goes from task to task.
_KEPT: dict[bytes, object] = {}


def _worker_counter(tokenizer: TokenizerFile, version: bytes, content: bytes):
    if version not in _KEPT:
        count = counter(tokenizer, content)
        _KEPT.clear()
        _KEPT[version] = WordCounter(count) if tokenizer.by_word else count
    return _KEPT[version]


def encode_counts(misses: DataFrame, tokenizer: TokenizerFile) -> DataFrame:
    """``content, tokenizer, n_tokens`` for every row of ``content, text``."""
    version = tokenizer.digest()
    shared = misses.sparkSession.sparkContext.broadcast(tokenizer.content())

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _worker_counter(tokenizer, version, shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                values = part.column("text").to_pylist()
                counts = count(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("content"),
                        pa.array([version] * part.num_rows, pa.binary()),
                        pa.array(counts, pa.int64()),
                    ],
                    ["content", "tokenizer", "n_tokens"],
                )

    return map_batches(misses, stage, CACHE_SCHEMA)


def cache_path(spark: SparkSession, tokenizer: TokenizerFile) -> str:
    """The tokenizer version's own cache below the shared folder, where a later run finds it."""
    return f"{shared_dir(spark)}/token-cache-{tokenizer.digest().hex()[:32]}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored_counts(spark: SparkSession, cache_path: str, tokenizer: TokenizerFile) -> DataFrame:
    """``content, n_tokens`` of the cache for this tokenizer version, one row per content."""
    if not _exists(spark, cache_path):
        return spark.createDataFrame([], "content binary, n_tokens long")
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    mine = rows.filter(F.col("tokenizer") == F.lit(tokenizer.digest()))
    return mine.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    df: DataFrame,
    tokenizer: TokenizerFile,
    cache_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row; the cache gains what it didn't have.

    Texts move once, by digest and after equal ones have met within each task; the documents
    themselves are joined as digests.
    """
    spark = df.sparkSession
    docs = texts(df, id_col, text_col)
    content = normalised(F.col("text"), tokenizer)
    digest = F.unhex(F.sha2(content, 256)).alias("content")
    misses = (
        docs.select(digest, content.alias("text"))
        .join(stored_counts(spark, cache_path, tokenizer), "content", "left_anti")
        .groupBy("content")
        .agg(F.first("text").alias("text"))
    )
    encode_counts(misses, tokenizer).write.mode("append").parquet(cache_path)
    keyed = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest)
    counts = stored_counts(spark, cache_path, tokenizer)
    return keyed.join(counts, "content", "left").select("doc_id", "n_bytes", "n_tokens")
