import json
import random
import time
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.functions import bytelevel
from shelfmark.operators import byte_tokens
from shelfmark.queries import views

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

MERGES = [tuple(map(bytelevel.in_alphabet, pair)) for pair in views.MERGES]
END = "<|endoftext|>"
ODD = [
    None,
    "",
    " ",
    "a",
    "  two  blanks\n\n\tand more 　 ",
    "don't we'll I'VE 'tis 've",
    "naïve é 的字 👍🏽 ß ½ ² Ⅷ ١٢٣ \x00 \x1c \x85 ​",
    f"one{END}two {END}{END} <|endoftext",
    "=" * 300 + "-" * 77,
    "word " * 900,
]


@pytest.fixture(scope="module")
def path():
    return public.path("byte_bpe_50k.json")


def library(path, length):
    tokenizer = tokenizers.Tokenizer.from_file(path)
    pair = (END, tokenizer.token_to_id(END))
    tokenizer.post_processor = tokenizers.processors.TemplateProcessing(
        single=f"{END} $A {END}", special_tokens=[pair]
    )
    tokenizer.enable_truncation(length)
    tokenizer.enable_padding(length=length, pad_id=pair[1], pad_token=END)
    return tokenizer


@pytest.mark.parametrize("length", [2, 3, 64, 512])
def test_arrays_equal_the_library(spark, path, length):
    rows = [(i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "i int, combined_text string")
    names = {"prefix": [END], "suffix": [END], "pad": END}
    found = byte_tokens.encode(df, byte_tokens.read_tokenizer(spark, path, **names), max_length=length)
    known = library(path, length)
    for row in found.collect():
        want = known.encode(ODD[row.i] or "")
        assert row.input_ids == want.ids
        assert row.attention_mask == want.attention_mask
    assert found.columns == ["i", "input_ids", "attention_mask"]


def test_documents_equal_the_library(spark, path):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    names = {"prefix": [END], "suffix": [END], "pad": END}
    tokenizer = byte_tokens.read_tokenizer(spark, path, **names)
    found = byte_tokens.encode(df, tokenizer, "text", keep_text=True).collect()
    known = library(path, 512)
    assert all(r.input_ids == known.encode(r.text).ids for r in found)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abehtn '\n\t.=19é的  "), max_size=40) | st.text(max_size=30))
def test_any_text(text):
    path = public.path("byte_bpe_50k.json")
    if not hasattr(test_any_text, "pair"):
        parsed = bytelevel.parse_tokenizer(open(path).read(), [], [], END)
        test_any_text.pair = parsed, tokenizers.Tokenizer.from_file(path)
    ours, theirs = test_any_text.pair
    assert ours.ids(text, 10**6) == theirs.encode(text).ids


@pytest.mark.parametrize("piece", ["a" * 1_000_000, "=" * 1_000_000, "aGVsbG8gd29ybGQ" * 60_000])
def test_long_pieces_end(path, piece):
    parsed = bytelevel.parse_tokenizer(open(path).read(), [], [], END)
    start = time.perf_counter()
    ids = parsed.ids(piece, 10**9)
    assert time.perf_counter() - start < 60
    assert ids == tokenizers.Tokenizer.from_file(path).encode(piece).ids


def test_merging_equals_the_plain_loop():
    rng = random.Random(1)
    for _ in range(200):
        merges, symbols = {}, list(range(4))
        for rank in range(12):
            pair = rng.choice(symbols), rng.choice(symbols)
            if pair not in merges:
                merges[pair] = (rank, len(symbols))
                symbols.append(len(symbols))
        word = [rng.randrange(4) for _ in range(rng.randrange(30))]
        want = list(word)
        while True:
            ranked = [(merges[p][0], i) for i, p in enumerate(zip(want, want[1:])) if p in merges]
            if not ranked:
                break
            _, i = min(ranked)
            want[i : i + 2] = [merges[want[i], want[i + 1]][1]]
        assert bytelevel.merged(word, merges) == want


@pytest.mark.parametrize("lead", [False, True])
def test_small_file_and_its_own_template(tmp_path, spark, lead):
    names = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"]
    stored = json.loads(bytelevel.tokenizer_text(MERGES, names))
    stored["normalizer"] = {"type": "NFC"}
    stored["pre_tokenizer"] |= {"add_prefix_space": lead, "trim_offsets": True}
    special = {n: {"id": n, "ids": [i], "tokens": [n]} for i, n in enumerate(names)}
    part = [{"SpecialToken": {"id": n, "type_id": 0}} for n in ("[CLS]", "[SEP]")]
    single = [part[0], {"Sequence": {"id": "A", "type_id": 0}}, part[1]]
    stored["post_processor"] = {
        "type": "TemplateProcessing", "single": single, "pair": single, "special_tokens": special
    }
    mask = {"id": 271, "content": "[MASK]", "single_word": False, "lstrip": True, "rstrip": False}
    stored["added_tokens"].append({**mask, "normalized": False, "special": True})
    stored["model"]["vocab"]["[MASK]"] = 275
    stored["added_tokens"][-1]["id"] = 275
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(stored))
    known = tokenizers.Tokenizer.from_file(str(path))
    known.enable_padding(length=40, pad_id=0, pad_token="[PAD]")
    known.enable_truncation(40)
    texts = ["then the end", "é é", "a [MASK] b[SEP]c", "", "[CLS]"]
    df = spark.createDataFrame([(t,) for t in texts], "combined_text string")
    tokenizer = byte_tokens.read_tokenizer(spark, str(path))
    found = byte_tokens.encode(df, tokenizer, max_length=40, keep_text=True).collect()
    assert [r.input_ids for r in found] == [known.encode(t).ids for t in texts]


def test_what_is_refused(tmp_path, spark, path):
    stored = json.loads(bytelevel.tokenizer_text(MERGES, ["[PAD]"]))
    with pytest.raises(ValueError, match="lacks"):
        bytelevel.parse_tokenizer(json.dumps(stored), prefix=["[CLS]"])
    stored["model"]["type"] = "WordPiece"
    with pytest.raises(ValueError, match="no byte-level"):
        bytelevel.parse_tokenizer(json.dumps(stored))
    tokenizer = byte_tokens.read_tokenizer(spark, path, [END], [END], END)
    df = spark.createDataFrame([("a",)], "combined_text string")
    with pytest.raises(ValueError, match="max_length"):
        byte_tokens.encode(df, tokenizer, max_length=1)
    with pytest.raises(ValueError, match="merges"):
        byte_tokens.encode(df, tokenizer, max_tokens=10)


def test_a_batch_is_read_text_by_text(spark, monkeypatch):
    """The texts of a batch are not all Python strings at once."""
    text = bytelevel.tokenizer_text(MERGES, ["[PAD]"])
    table = spark.createDataFrame([(text, [], [], "[PAD]")], byte_tokens.SCHEMA)
    made = []
    monkeypatch.setattr(byte_tokens.F, "arrow_udf", lambda _: lambda f: made.append(f) or (lambda c: byte_tokens.F.lit(None).cast(byte_tokens.ENCODED_TYPE)))
    byte_tokens.encode(spark.createDataFrame([("a",)], "t string"), table, "t", 8)
    texts = pa.array(["there and " * 2_000] * 500)
    made[0](texts.slice(0, 1))
    tracemalloc.start()
    try:
        out = made[0](texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < texts.nbytes / 4
    assert len(set(map(str, out.to_pylist()))) == 1
