"""Language identification by a linear-chain conditional random field over words (operator 5).

Every word of a text gets label probabilities by forward-backward, from its affixes, character
n-grams and the word itself as a lexicon entry (all hashed), and from learned transitions, so
passages of a second language are labelled as such. A document's language has the largest share
of its words' probabilities; that share is the score.

The field is trained on a bounded sample of labelled documents: their words carry the document's
label, and runs of words from documents of different languages are strung together so that the
transitions see switches. Words are runs of letters of the lower-cased text; digits, blanks,
punctuation and other ASCII separate them.

Defined results: a null text, a text without a letter, and any text where nothing could be learned
get ``und`` with score 0; a null id counts as an empty one for the hold-out; repeated rows each
get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import crf
from shelfmark.llm.common import give_back
from shelfmark.llm.rolling import Powers, blocks, string_views, word_hashes, word_spans

UNKNOWN = "und"
#: Bounds of the training sample: texts per language, and steps of the optimiser; seed of its draw.
DRAW_SEED = 5
TRAINING_DOCS = 250
TRAINING_STEPS = 40
#: Mean words of a run and words of a training sequence.
RUN_WORDS = 40
SEQUENCE_WORDS = 256
FEATURE_BITS = 18
#: Bytes of text that are labelled at once (a longer text is a block of its own), and distinct
#: words whose features are held at once.
BLOCK_BYTES = 4 << 20
SCORED_WORDS = 16_384

_LETTERS = np.array(
    [b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b > 0x7F else 0 for b in range(256)],
    np.uint8,
)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_START, _END = 1, 2


def held_out(doc_id: Column | str, buckets: int = 4, held: int = 2) -> Column:
    """Whether the CRC-32 of the id as text falls in the bucket that is kept from training."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % buckets == held


def _word_types(
    plain: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers
) -> tuple[np.ndarray, np.ndarray]:
    """Index of one place of each distinct word, and the distinct word of each place."""
    hashes = word_hashes(plain, starts, ends, powers)
    _, place, types = np.unique(hashes, return_index=True, return_inverse=True)
    return place, types


def _features(plain: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> crf.Features:
    """Hashed n-grams of two to four bytes of each word between marks, and the word itself.

    N-grams that hold a mark are the word's affixes.
    """
    sizes = ends - starts + 2
    at = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(at[-1]) - np.repeat(at[:-1], sizes) + np.repeat(starts, sizes) - 1
    letters = plain[np.clip(index, 0, max(len(plain) - 1, 0))].astype(np.uint64)
    letters[at[:-1]] = _START
    letters[at[1:] - 1] = _END
    room = np.repeat(at[1:], sizes) - np.arange(at[-1])
    word = np.repeat(np.arange(len(sizes)), sizes)
    flat, owner = [], []
    shift = np.uint64(64 - FEATURE_BITS)
    with np.errstate(over="ignore"):
        gram = letters.copy()
        for n in range(2, 5):
            gram = gram[:-1] * np.uint64(257) + letters[n - 1 :]
            real = room[: len(gram)] >= n
            flat.append((gram[real] * _MUL) >> shift)
            owner.append(word[: len(gram)][real])
        whole = np.zeros(len(sizes), np.uint64)
        if len(sizes):
            scaled = letters * (np.uint64(0xD6E8FEB86659FD93) ** _within(at, sizes))
            whole = np.add.reduceat(scaled, at[:-1])
        flat.append((whole * _MUL) >> shift)
        owner.append(np.arange(len(sizes)))
    flat, owner = np.concatenate(flat).astype(np.int64), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(sizes))
    return crf.Features(flat[order], np.concatenate([[0], np.cumsum(counts)]))


def _within(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return (np.arange(at[-1]) - np.repeat(at[:-1], sizes)).astype(np.uint64)


def _prepared(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lowered = pa.array([v.lower() if v else "" for v in column.to_pylist()], pa.large_string())
    return string_views(lowered)


def training_sample(labelled: DataFrame, per_language: int = TRAINING_DOCS) -> list[tuple[str, str]]:
    """(text, label) of at most ``per_language`` distinct texts of each label, chosen by a hash.

    Rows need ``text, lang``; those without a text or a label are passed over. Copies of a text are
    one, whatever their ids, and the bound is applied before anything is collected.
    """
    known = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    content = F.xxhash64("text", F.lit(DRAW_SEED))
    counts = known.groupBy("lang").agg(F.approx_count_distinct(content).alias("n"))
    # A row per label is broadcast, of which the field holds 2^18 weights each.
    # Twice as many as wanted are drawn, so that chance and the estimate leave enough of them.
    share = (2.0 * per_language / F.col("n")).alias("share")
    drawn = (
        known.withColumn("draw", F.pmod(content, F.lit(1 << 30)) / F.lit(float(1 << 30)))
        .join(F.broadcast(counts.select(F.col("lang").alias("of"), share)), F.col("lang") == F.col("of"))
        .filter(F.col("draw") < F.col("share"))
        .dropDuplicates(["lang", "text"])
    )
    first = Window.partitionBy("lang").orderBy("draw", "text")
    chosen = drawn.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= per_language)
    rows = chosen.select("lang", "place", "text").collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["place"]))]


def train(sample: list[tuple[str, str]], steps: int = TRAINING_STEPS, seed: int = 7) -> crf.Field | None:
    """A field from labelled texts; None if there is no word to learn from."""
    names = sorted({lang for _, lang in sample})
    plain, offsets = _prepared(pa.array([t for t, _ in sample], pa.string()))
    plain, starts, ends, per_row = word_spans(plain[: offsets[-1]], offsets, _LETTERS)
    if not len(starts):
        return None
    place, types = _word_types(plain, starts, ends, Powers())
    features = _features(plain, starts[place], ends[place])
    number = {name: k for k, name in enumerate(names)}
    label = np.repeat([number[lang] for _, lang in sample], np.diff(per_row))
    order = _strung(per_row, np.random.default_rng(seed))
    lengths = np.full(-(-len(order) // SEQUENCE_WORDS), SEQUENCE_WORDS)
    lengths[-1] = len(order) - SEQUENCE_WORDS * (len(lengths) - 1)
    return crf.train(features, types[order], label[order], lengths, names, 1 << FEATURE_BITS, steps)


def _strung(per_row: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Positions in a new order: all documents cut into runs, the runs shuffled."""
    cuts = rng.random(per_row[-1]) < 1 / RUN_WORDS
    cuts[per_row[:-1][per_row[:-1] < per_row[-1]]] = True
    first = np.flatnonzero(cuts)
    last = np.append(first[1:], per_row[-1])
    shuffled = rng.permutation(len(first))
    return np.concatenate([np.arange(first[k], last[k]) for k in shuffled])


def label_words(
    field: crf.Field, plain: np.ndarray, offsets: np.ndarray, powers: Powers
) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of all words, and each row's first word (n + 1 values)."""
    plain, starts, ends, per_row = word_spans(plain, offsets, _LETTERS)
    if not len(starts):
        return np.zeros((0, len(field.labels)), np.float32), per_row
    place, types = _word_types(plain, starts, ends, powers)
    scores = np.empty((len(place), len(field.labels)), np.float32)
    for at in range(0, len(place), SCORED_WORDS):
        own = place[at : at + SCORED_WORDS]
        scores[at : at + len(own)] = _features(plain, starts[own], ends[own]).scores(field.emission)
    chains = crf.Chains(np.diff(per_row))
    likely, _ = crf.marginals(field, scores[types], chains, np.float32)
    return likely, per_row


def _shares(field: crf.Field | None, column: pa.Array, powers: Powers) -> tuple[list, list, list]:
    """Language, score and number of switches between words' best labels, per text."""
    names, scores, switches = [], [], []
    if field is None:
        return [UNKNOWN] * len(column), [0.0] * len(column), [0] * len(column)
    for first, last in blocks(string_views(pc.fill_null(column, ""))[1], BLOCK_BYTES):
        part = column.slice(first, last - first)
        plain, offsets = _prepared(part)
        likely, per_row = label_words(field, plain[: offsets[-1]], offsets, powers)
        sums = np.zeros((len(likely) + 1, len(field.labels)))
        np.cumsum(likely, axis=0, dtype=np.float64, out=sums[1:])
        total = sums[per_row[1:]] - sums[per_row[:-1]]
        best = total.argmax(axis=1)
        n = np.diff(per_row)
        share = np.clip(total[np.arange(len(n)), best] / np.maximum(n, 1), 0, 1)
        word_best = likely.argmax(axis=1)
        turns = np.zeros(len(likely) + 1, np.int64)
        turns[2:] = np.cumsum(word_best[1:] != word_best[:-1]) if len(likely) > 1 else 0
        # turns[k]: changes between words 0..k-1; those between rows don't count.
        inner = np.where(n > 0, turns[per_row[1:]] - turns[np.minimum(per_row[:-1] + 1, len(likely))], 0)
        for k in range(len(n)):
            raw = plain[offsets[k] : offsets[k + 1]]
            known = n[k] > 0 and (_ascii_letter(raw) or _has_letter(part[k].as_py()))
            names.append(field.labels[best[k]] if known else UNKNOWN)
            scores.append(float(share[k]) if known else 0.0)
            switches.append(int(inner[k]) if known else 0)
    return names, scores, switches


def _ascii_letter(raw: np.ndarray) -> bool:
    return bool(((raw >= 0x61) & (raw <= 0x7A)).any())


def _has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def predict_column(df: DataFrame, field: crf.Field | None):
    """A function from a text column to ``lang_pred, score, n_switches`` (a struct column)."""
    shared = df.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf("lang_pred string, score double, n_switches long")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        powers = Powers()
        for column in batches:
            names, scores, switches = _shares(shared.value, column, powers)
            kinds = (pa.string(), pa.float64(), pa.int64())
            made = [pa.array(v, kind) for v, kind in zip((names, scores, switches), kinds)]
            yield pa.StructArray.from_arrays(made, ["lang_pred", "score", "n_switches"])
        give_back()

    return predict


def identify(
    df: DataFrame,
    per_language: int = TRAINING_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, n_switches`` per row, trained on the rest's labels."""
    field = train_on(df, per_language, id_col, text_col, lang_col)
    predict = predict_column(df, field)
    return df.select(
        df[id_col].alias("doc_id"), held_out(df[id_col]).alias("held_out"), predict(df[text_col]).alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score", "p.n_switches")


def train_on(
    df: DataFrame,
    per_language: int = TRAINING_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> crf.Field | None:
    """A field trained on the labelled documents that aren't held out."""
    labelled = df.select(
        df[id_col].alias("doc_id"), df[text_col].alias("text"), df[lang_col].alias("lang")
    ).filter(~held_out("doc_id"))
    return train(training_sample(labelled, per_language))
