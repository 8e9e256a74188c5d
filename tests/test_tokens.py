import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import BertWordPieceTokenizer

from shelfmark.functions.wordpiece import split_word
from shelfmark.operators import tokens
from shelfmark.sources.readers import read_parquet

TINY = "/root/testdata/sf0.001/documents.parquet"
ODD = [
    "",
    "   \n",
    None,
    "plain words here plain",
    "ÀÉÎ õü naïve Straße ΣΑΣ İstanbul ŉ",
    "中文字 mixed中文 text ア 한국어",
    "soft\xadhyphen zero​width nul\x00 bell\x07 tab\tnew\nline nel\x85end ls end fs\x1cend",
    "é ́̂ alone ≠ ≮ `~^$+|<=> don't [UNK] a[SEP]b [PAD] [sep] [[MASK]] [MASK",
    "x" * 100 + " " + "x" * 101 + " " + "é" * 100,
    "price: $9,99 — “quoted” ¿qué? №5 ½ 😀 a_b � end",
    " ".join(f"w{i}" for i in range(700)),
]


def framed(ids, length):
    real = [2, *ids[: length - 2], 3]
    return real + [0] * (length - len(real)), [1] * len(real) + [0] * (length - len(real))


@pytest.fixture(scope="module")
def documents(spark):
    return read_parquet(spark, TINY).select("doc_id", "text")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string").repartition(3)


def test_vocabulary(documents, texts):
    counts = Counter(w for t in texts.values() for w in t.lower().split())
    best = sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:496]
    rows = tokens.build_vocab(documents, "text", 500).orderBy("id").collect()
    assert [(r.token, r.id) for r in rows[:4]] == [("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3)]
    assert [(r.token, r.n) for r in rows[4:]] == best
    assert [r.id for r in rows] == list(range(500))
    with pytest.raises(ValueError):
        tokens.build_vocab(documents, "text", 4)


@pytest.mark.parametrize("length", [2, 3, 64, 512])
def test_encode(documents, texts, length):
    vocab = tokens.build_vocab(documents, "text", 300)
    ids = {r.token: r.id for r in vocab.collect()}
    out = tokens.encode(documents, vocab, "text", length)
    assert out.columns == ["doc_id", "input_ids", "attention_mask"]
    assert dict(out.dtypes)["input_ids"] == "array<int>"
    for r in out.collect():
        expected = framed([ids.get(w, 1) for w in texts[r.doc_id].lower().split()], length)
        assert (r.input_ids, r.attention_mask) == expected


def test_encode_joined_is_encode(documents, odd):
    vocab = tokens.build_vocab(documents, "text", 300)
    for df in (documents, odd):
        narrow = tokens.encode(df, vocab, "text", 40)
        joined = tokens.encode_joined(df, vocab, "doc_id", "text", 40, salts=5)
        assert sorted(narrow.collect()) == sorted(joined.select(narrow.columns).collect())


def test_large_vocabulary_is_joined(documents):
    vocab = tokens.build_vocab(documents, "text", 300)
    narrow = sorted(tokens.encode(documents, vocab, "text", 40).collect())
    with pytest.raises(ValueError, match="over 100 tokens"):
        tokens.encode(documents, vocab, "text", 40, max_tokens=100)
    with pytest.raises(ValueError, match="over 100 tokens"):
        tokens.subword_table(vocab, vocab, max_tokens=100)
    joined = tokens.encode(documents, vocab, "text", 40, key="doc_id", strategy="join")
    assert sorted(joined.select("doc_id", "input_ids", "attention_mask").collect()) == narrow


def test_joined_needs_a_unique_key(spark, documents):
    vocab = tokens.build_vocab(documents, "text", 300)
    for other in ("", "b c"):
        df = spark.createDataFrame([(1, "a b"), (1, other)], "k int, t string")
        with pytest.raises(Exception, match="Key is not unique: 1"):
            tokens.encode_joined(df, vocab, "k", "t", 8).collect()


def test_no_shuffle_and_one_python_pass(documents):
    encoded = tokens.encode(documents, tokens.build_vocab(documents, "text", 300), "text")
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_short_length_and_missing_specials(spark, documents):
    vocab = tokens.build_vocab(documents, "text", 300)
    with pytest.raises(ValueError):
        tokens.encode(documents, vocab, "text", 1)
    with pytest.raises(ValueError, match="lacks"):
        tokens.encode(documents, vocab.filter("id > 1"), "text")


def test_keep_text(documents):
    vocab = tokens.build_vocab(documents, "text", 300)
    assert tokens.encode(documents, vocab, "text", 8, keep_text=True).columns == [
        "doc_id", "text", "input_ids", "attention_mask",
    ]


def test_ensure_encoded(records, documents):
    vocab = tokens.build_vocab(documents, "text", 300)
    stored = tokens.ensure_encoded(records, vocab, text="title")
    assert tokens.ensure_encoded(stored) is stored
    row = stored.first()
    assert len(row.input_ids) == len(row.attention_mask) == 512
    with pytest.raises(ValueError):
        tokens.ensure_encoded(records)


def test_punctuation_normalizer(spark):
    df = spark.createDataFrame([("Don't stop, O.K.?",)], "t string")
    got = df.select(tokens.word_array(F.col("t"), "punctuation").alias("w")).first().w
    assert got == ["don", "'", "t", "stop", ",", "o", ".", "k", ".", "?"]
    with pytest.raises(ValueError):
        tokens.word_array(F.col("t"), "other")


@pytest.fixture(scope="module")
def pretrained(texts, tmp_path_factory):
    """A WordPiece vocabulary file, special tokens not at the start."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789σßıα中文한"
    pieces = ["[PAD]", "[unused1]", "[UNK]", *letters, *(f"##{c}" for c in letters)]
    pieces += list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~—“”¿") + ["[CLS]", "[SEP]", "[MASK]"]
    counts = Counter(w for t in texts.values() for w in t.lower().split())
    common = [w for w, _ in counts.most_common(300) if w.isascii() and w.isalpha()]
    pieces += common + [f"##{w}" for w in common if len(w) < 5]
    pieces = list(dict.fromkeys(pieces))
    path = tmp_path_factory.mktemp("vocab") / "vocab.txt"
    path.write_text("\n".join(pieces) + "\n", encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("length", [16, 512])
def test_wordpiece_equals_the_published_tokenizer(spark, documents, odd, texts, pretrained, length):
    vocab = tokens.read_vocab(spark, pretrained)
    expected = BertWordPieceTokenizer(pretrained, lowercase=True)
    expected.enable_truncation(length)
    expected.enable_padding(length=length)
    options = {"normalizer": "wordpiece", "subwords": True}
    for df, source in ((documents, texts), (odd, dict(enumerate(ODD)))):
        for r in tokens.encode(df, vocab, "text", length, **options).collect():
            theirs = expected.encode(source[r.doc_id] or "")
            assert r.input_ids == theirs.ids, source[r.doc_id]
            assert r.attention_mask == theirs.attention_mask


def test_read_vocab_ids_are_lines(spark, pretrained):
    lines = open(pretrained, encoding="utf-8").read().split("\n")[:-1]
    rows = tokens.read_vocab(spark, pretrained).collect()
    assert {r.token: r.id for r in rows} == {t: i for i, t in enumerate(lines)}


def test_subword_table_and_encoding_agree(documents, texts):
    vocab = tokens.build_vocab(documents, "text", 400, subwords=True)
    ids = {r.token: r.id for r in vocab.collect()}
    table = tokens.subword_table(tokens.count_words(documents, "text"), vocab)
    pieces = {r.token: r for r in table.collect()}
    assert set(pieces) == {w for t in texts.values() for w in t.lower().split()}
    for token, r in pieces.items():
        assert r.piece_ids == [ids[p] for p in r.pieces]
        if r.pieces != ["[UNK]"]:
            assert "".join(p.removeprefix("##") if i else p for i, p in enumerate(r.pieces)) == token
    for r in tokens.encode(documents, vocab, "text", 64, subwords=True).collect():
        flat = [i for w in texts[r.doc_id].lower().split() for i in pieces[w].piece_ids]
        assert (r.input_ids, r.attention_mask) == framed(flat, 64)


def test_split_word():
    known = {"un", "##aff", "##able", "##a", "able"}
    assert split_word("unaffable", known, 6, "[UNK]") == ["un", "##aff", "##able"]
    assert split_word("unx", known, 6, "[UNK]") == ["[UNK]"]
    assert split_word("ABLE", known, 6, "[UNK]", plain=True) == ["able"]
    assert split_word("́", known, 6, "[UNK]", plain=True) == []


def test_vocabulary_plan_has_no_single_task(spark):
    """Neither a top-k through one task nor a window without partitions."""
    df = spark.createDataFrame([(" ".join(f"w{j}" for j in range(i)),) for i in range(1, 60)], "text string")
    vocab = tokens.build_vocab(df, "text", 30)
    plan = vocab._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" not in plan and "Window" not in plan and "SinglePartition" not in plan
    rows = sorted(vocab.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == list(range(30))
    assert [r.token for r in rows[4:]] == [f"w{j}" for j in range(26)]


@pytest.mark.parametrize("size", [5, 6, 7, 20, 1000])
def test_vocabulary_ties_and_sizes(spark, size):
    rows = [("b a c d",), ("c d e",), ("x y z z z z",)]
    vocab = tokens.build_vocab(spark.createDataFrame(rows, "text string"), "text", size)
    want = ["z", "c", "d", "a", "b", "e", "x", "y"][: size - 4]
    assert [r.token for r in sorted(vocab.collect(), key=lambda r: r.id)][4:] == want


def test_empty_corpus_has_the_special_tokens(spark):
    vocab = tokens.build_vocab(spark.createDataFrame([], "text string"), "text", 10)
    assert sorted(r.token for r in vocab.collect()) == sorted(tokens.SPECIAL_TOKENS)


def test_large_vocabularies_are_joined_when_asked(spark):
    rows = [(i, f"Unwanted affable w{i % 9} [UNK] na\u00efve {'x' * (95 + i)}") for i in range(10)] + [(10, ""), (11, None)]
    df = spark.createDataFrame(rows, "key long, text string")
    pieces = [*tokens.SPECIAL_TOKENS, "un", "##want", "##ed", "aff", "##able", "w", "##1", "##2", "naive", "x", "##x"]
    vocab = spark.createDataFrame(list(enumerate(pieces)), "id int, token string").select("token", "id")
    with pytest.raises(ValueError, match="over 3 tokens"):
        tokens.encode(df, vocab, "text", max_tokens=3)
    with pytest.raises(ValueError, match="unique key"):
        tokens.encode(df, vocab, "text", strategy="join")
    with pytest.raises(ValueError, match="strategy"):
        tokens.encode(df, vocab, "text", strategy="guess")
    for normalizer in ("simple", "wordpiece"):
        for subwords in (False, True):
            options = {"text": "text", "max_length": 24, "normalizer": normalizer, "subwords": subwords}
            if normalizer == "wordpiece" and not subwords:
                continue  # capitals and accents go with the pieces
            one = tokens.encode(df, vocab, **options).orderBy("key").collect()
            two = tokens.encode(df, vocab, **options, key="key", strategy="join").orderBy("key").collect()
            assert [(r.key, r.input_ids, r.attention_mask) for r in one] == [
                (r.key, r.input_ids, r.attention_mask) for r in two
            ]


def test_joined_keys_are_checked_first(spark):
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(tokens.SPECIAL_TOKENS)], "token string, id int")
    for rows in ([(1, "a"), (1, "b")], [(None, "a"), (2, "b")]):
        df = spark.createDataFrame(rows, "key long, text string")
        with pytest.raises(ValueError, match="Key is not unique"):
            tokens.encode_joined(df, vocab, "key", "text")


def test_memory_of_a_batch_is_that_of_its_arrays(spark):
    """A batch of long texts takes little more than its ids; words beyond the room are not split."""
    vocab = spark.createDataFrame(
        [(t, i) for i, t in enumerate((*tokens.SPECIAL_TOKENS, "a", "b"))], "token string, id int"
    )
    texts = pa.array(["a b c " * 200] * 6_000 + [""])
    run = tokens._encoder(spark, vocab.toArrow(), 512, False, False).func
    run(texts.slice(0, 1))
    tracemalloc.start()
    try:
        out = run(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * out.nbytes
    assert out[0].as_py()["input_ids"] == [2, *[4, 5, 1] * 170, 3]
    assert out[6_000].as_py() == {"input_ids": [2, 3, *[0] * 510], "n_real": 2}
    seen, per_row = tokens._first_words(pa.array(["a b c d e f", " ", "b"]), 2)
    assert (seen.to_pylist(), per_row.tolist()) == (["a", "b", "b"], [2, 0, 1])


def test_joined_words_are_those_of_a_block(spark, monkeypatch):
    """Occurrences are not joined one by one: a word goes to the vocabulary once per block."""
    monkeypatch.setattr(tokens, "BLOCK_ROWS", 16)
    rows = [(i, "the cat sat the " * 20 + f"w{i % 7}") for i in range(64)] + [(64, ""), (65, None)]
    df = spark.createDataFrame(rows, "k long, t string")
    vocab = tokens.build_vocab(df, "t", 9)
    for length in (2, 3, 40, 100):
        narrow = tokens.encode(df, vocab, "t", length)
        joined = tokens.encode(df, vocab, "t", length, key="k", strategy="join")
        assert sorted(narrow.collect()) == sorted(joined.select(narrow.columns).collect())
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "array_distinct" in plan and "CoGroup" in plan


WORDS = ["naïve", "中文字", "##ed", "abab", "a", "x" * 100, "y" * 101, "😀é", "-", "unwanted"]


@pytest.mark.parametrize("all_bits", [False, True])
def test_candidates_are_the_substrings_that_may_be_known(all_bits):
    """All substrings where the bit table is full; with a vocabulary's table its tokens and hardly another."""
    every = set()
    for w in (w for w in WORDS if len(w) <= 100):
        spans = [(i, j) for i in range(len(w)) for j in range(i + 1, len(w) + 1)]
        every |= {("##" if i else "") + w[i:j] for i, j in spans}
    known = sorted({"na", "##ï", "##ïve", "##文", "##ed", "ab", "##é", "##é😀", "x" * 100, "##" + "x" * 99, "missing"})
    table = np.zeros(1 << (tokens.TABLE_BITS - 6), dtype=np.uint64)
    for place in tokens._places(pa.array(known)):
        table[place >> 6] |= np.uint64(1) << np.uint64(place & 63)
    if all_bits:
        table[:] = np.uint64(0xFFFFFFFFFFFFFFFF)
    found = tokens._candidates(pa.array(["sliced", *WORDS]).slice(1), False, table, 402)
    found.validate(full=True)
    assert set(found.to_pylist()) == (every if all_bits else every & set(known))
    short = tokens._candidates(pa.array(WORDS), False, table, 4).to_pylist()
    assert set(short) == {p for p in found.to_pylist() if len(p.encode()) <= 4}
    assert tokens._candidates(pa.array([], pa.string()), False, table, 402).to_pylist() == []


def test_joined_substrings_are_those_that_may_be_known(spark):
    """Neither all substrings of the words nor the texts are shuffled; a word's pieces are as in ``encode``."""
    rows = [(i, " ".join(f"{j * 7919 + i:x}suffix{j:b}" for j in range(60))) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, t string")
    vocab = tokens.build_vocab(df, "t", 150, subwords=True)
    scratch = []
    joined = tokens.encode(df, vocab, "t", 300, subwords=True, key="k", strategy="join", scratch=scratch)
    narrow = tokens.encode(df, vocab, "t", 300, subwords=True)
    assert sorted(narrow.collect()) == sorted(joined.select(narrow.columns).collect())
    (blocks,) = scratch
    wanted = {r[0] for r in spark.read.parquet(blocks).select(F.explode("_wanted")).collect()}
    known = {r.token for r in vocab.collect()}
    assert 100 < len(wanted) < 2 * len(known)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan


@pytest.mark.parametrize("normalizer", ["simple", "wordpiece"])
def test_words_of_many_blocks_go_to_copies_of_the_vocabulary(spark, odd, monkeypatch, normalizer):
    rows = [(100 + i, f"Unwanted affable w{i % 9} naïve [UNK] [MASK] zzz") for i in range(30)]
    df = odd.unionByName(spark.createDataFrame(rows, odd.schema))
    pieces = [*tokens.SPECIAL_TOKENS, "un", "##want", "##ed", "aff", "##able", "w", "##1", "naive", "naïve", "x", "##x", "[", "mask", "]"]
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(pieces)], "token string, id int")
    monkeypatch.setattr(tokens, "BLOCK_ROWS", 3)
    monkeypatch.setattr(tokens, "BLOCKS_A_SALT", 2)
    narrow = tokens.encode(df, vocab, "text", 40, normalizer, subwords=True)
    joined = tokens.encode_joined(df, vocab, "doc_id", "text", 40, normalizer, salts=4, subwords=True)
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(narrow.collect()) == sorted(joined.select(narrow.columns).collect())
