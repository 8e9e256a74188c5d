"""Fixed-length token arrays by a tokenizer file with a byte-level merge list.

A narrow pass, like :func:`shelfmark.operators.tokens.encode`: no rows are exploded or shuffled. A text
is cut into pieces by a fixed pattern, a piece's bytes are merged by rank, and each worker remembers
the pieces it has merged. Reading stops at the piece that fills the array, so a long text costs no
more than its beginning. The file goes to the tasks as a whole; its size is checked first.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.bytelevel import ByteTokenizer, parse_tokenizer
from shelfmark.operators.tokens import ENCODED_TYPE, MAX_BROADCAST_TOKENS, MAX_LENGTH, padded_lists

#: A tokenizer as a table: the text of its file and the names of the special tokens, one row.
SCHEMA = "value string, prefix array<string>, suffix array<string>, pad string"


def read_tokenizer(
    spark: SparkSession,
    path: str,
    prefix: Sequence[str] | None = None,
    suffix: Sequence[str] | None = None,
    pad: str | None = None,
) -> DataFrame:
    """The tokenizer of a JSON file, with the tokens that frame a text if the file's own shall not."""
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    parse_tokenizer(text, prefix, suffix, pad)
    names = [list(x) if x is not None else None for x in (prefix, suffix)]
    return spark.createDataFrame([(text, *names, pad)], SCHEMA)


def collected(tokenizer: DataFrame, max_tokens: int = MAX_BROADCAST_TOKENS) -> ByteTokenizer:
    parsed = parse_tokenizer(*tokenizer.select("value", "prefix", "suffix", "pad").first())
    if len(parsed.merges) > max_tokens:
        raise ValueError(f"The tokenizer has over {max_tokens} merges; raise max_tokens.")
    return parsed


def encode(
    df: DataFrame,
    tokenizer: DataFrame,
    text: str = "combined_text",
    max_length: int = MAX_LENGTH,
    keep_text: bool = False,
    max_tokens: int = MAX_BROADCAST_TOKENS,
) -> DataFrame:
    """Replace a text column by ``input_ids`` and ``attention_mask`` of fixed length.

    Ids are those of the library that the file is made for, truncated and padded on the right; the mask
    is 1 for real tokens. A null text counts as empty.
    """
    parsed = collected(tokenizer, max_tokens)
    room = max_length - len(parsed.prefix) - len(parsed.suffix)
    if room < 0:
        raise ValueError("max_length must leave room for the tokens that frame a text")
    shared = df.sparkSession.sparkContext.broadcast(parsed)

    @F.arrow_udf(ENCODED_TYPE)
    def run(texts: pa.Array) -> pa.Array:
        tokenizer = shared.value
        out = np.full((len(texts), max_length), tokenizer.pad, np.int32)
        n_real = np.zeros(len(texts), np.int32)
        # Text by text: a batch as Python strings takes several times its bytes.
        for i in range(len(texts)):
            value = texts[i].as_py()
            ids = tokenizer.prefix + (tokenizer.ids(value, room) if value and room else []) + tokenizer.suffix
            out[i, : len(ids)], n_real[i] = ids, len(ids)
        return padded_lists(out, n_real)

    encoded = df.withColumn("_encoded", run(F.col(text)))
    zeros = F.array_repeat(F.lit(0), F.lit(max_length) - F.col("_encoded.n_real"))
    mask = F.concat(F.array_repeat(F.lit(1), F.col("_encoded.n_real")), zeros)
    dropped = ["_encoded"] if keep_text else ["_encoded", text]
    return encoded.select("*", "_encoded.input_ids", mask.alias("attention_mask")).drop(*dropped)
