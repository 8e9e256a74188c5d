import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import token_cache as t
from shelfmark.llm.common import Workspace
from tests.llm.samples import ODD, frame, sentences, with_clashes

WORDS = t.TokenizerFile(public_tokenizers.path("word_bpe_49k.json"), by_word=True)
PIECES = t.TokenizerFile(public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = [
    "Special <|endoftext|> strings<|startoftext|>inside",
    "blanks \x0b\x0c\r\n\t and \x1c \x85 \xa0   others",
    "don't I'm 12 34 ΟΔΟΣ İstanbul ẞ ﬁ é é ́x",
    sentences(3000),
]


@pytest.fixture()
def cache(spark):
    workspace = Workspace(spark)
    yield workspace.path("cache")
    workspace.clear()


def test_counts_equal_the_library(spark, cache):
    rows = ODD + list(enumerate(TEXTS, 50))
    model = Tokenizer.from_file(WORDS.path)
    got = t.token_counts(with_clashes(frame(spark, rows)), WORDS, cache).collect()
    want = [
        (i, len((x or "").encode()), len(model.encode(x or "", add_special_tokens=False).ids))
        for i, x in rows
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_sentencepiece_counts_equal_the_library(spark, cache):
    import sentencepiece

    rows = ODD + list(enumerate(TEXTS, 50))
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES.path)
    got = t.token_counts(frame(spark, rows), PIECES, cache).collect()
    want = [(i, len((x or "").encode()), len(model.encode(x or ""))) for i, x in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_only_distinct_misses_are_encoded(spark, cache):
    first = frame(spark, [(1, "a  b"), (2, "a b"), (3, "c")])
    t.token_counts(first, WORDS, cache).collect()
    assert spark.read.parquet(cache).count() == 2
    more = frame(spark, [(4, "c"), (5, " a\nb "), (6, "d")])
    assert t.token_counts(more, WORDS, cache).count() == 3
    assert spark.read.parquet(cache).count() == 3


def test_a_second_run_of_the_query_encodes_nothing(spark):
    from shelfmark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    path = t.cache_path(spark, WORDS)
    first = sorted(QUERIES["op2_token_counts"](spark, folder).collect())
    stored = spark.read.parquet(path).count()
    assert stored >= len({r.doc_id for r in first}) / 2
    assert sorted(QUERIES["op2_token_counts"](spark, folder).collect()) == first
    assert spark.read.parquet(path).count() == stored


def test_stored_counts_are_used_as_they_are(spark, cache):
    docs = frame(spark, [(1, "c")])
    t.token_counts(docs, WORDS, cache).collect()
    wrong = spark.read.parquet(cache).withColumn("n_tokens", F.lit(99).cast("long"))
    wrong.write.parquet(cache + "/copy")
    assert t.token_counts(docs, WORDS, cache + "/copy").first().n_tokens == 99


def test_another_tokenizer_has_its_own_counts(spark, cache):
    docs = frame(spark, [(1, sentences(50))])
    one = t.token_counts(docs, WORDS, cache).first().n_tokens
    two = t.token_counts(docs, PIECES, cache).first().n_tokens
    assert one != two and spark.read.parquet(cache).count() == 2
    assert t.token_counts(docs, WORDS, cache).first().n_tokens == one


def test_empty_table(spark, cache):
    assert t.token_counts(frame(spark, []), WORDS, cache).count() == 0


def test_generations_of_words_keep_the_counts(monkeypatch):
    import random

    monkeypatch.setattr(t, "MEMO_WORDS", 5)
    monkeypatch.setattr(t, "ONCE_WORDS", 7)
    rng, asked = random.Random(1), []

    def count(batch):
        asked.extend(batch)
        return [sum(map(len, text.split())) for text in batch]

    counter = t.WordCounter(count)
    for _ in range(200):
        batch = [" ".join("w" * rng.randint(1, 30) for _ in range(rng.randint(0, 9))) for _ in range(4)]
        assert counter(batch) == [len(x.replace(" ", "")) for x in batch]
    assert any(" " in x for x in asked) and any(" " not in x for x in asked)
