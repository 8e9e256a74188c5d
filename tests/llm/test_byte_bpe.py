import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from shelfmark.llm import byte_bpe as b
from tests.llm.samples import ODD, frame, sentences, with_clashes

VOCABULARY = b.RankFile(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=VOCABULARY.pattern, mergeable_ranks=VOCABULARY.tokens(), special_tokens={}
    )


@pytest.fixture(scope="module")
def coder():
    return b.PieceCoder(VOCABULARY.tokens())


def test_pieces_equal_the_library(coder, library):
    rng = random.Random(2)
    pieces = [" the", "a", "a" * 300, "漢字仮名" * 60, "\n\n  ", "👍🏽" * 9, "x" * 47 + "é" * 9]
    pieces += ["".join(rng.choice("abcdeéthingß ") for _ in range(n)) for n in range(1, 200)]
    coded = coder.code(pieces)
    for piece in pieces:
        want = library._encode_single_piece(piece)
        assert coded[piece] == (" ".join(map(str, want)), piece.encode())


def test_long_pieces_end(coder, library):
    import base64
    import time

    rng = random.Random(5)
    pieces = {
        "letters": "a" * 1_000_000,
        "signs": "=" * 1_000_000,
        "mixed signs": "=-" * 100_000 + "-" * 50_001,
        "base64": base64.b64encode(rng.randbytes(750_000)).decode(),
        "words": "".join(rng.choice(["lorem", "ipsum", "dolor", "qx", "thing"]) for _ in range(3_000)),
    }
    for name, piece in pieces.items():
        start = time.perf_counter()
        ids, raw = coder.code([piece])[piece]
        assert time.perf_counter() - start < 60, name
        assert raw == piece.encode()
        if len(piece) <= 20_000 or name == "base64":
            assert ids == " ".join(map(str, library._encode_single_piece(piece))), name


@pytest.mark.parametrize("n", [49, 50, 51, 64, 100, 127, 1000, 4097])
def test_runs_equal_the_library(coder, library, n):
    for piece in ("a" * n, "=" * n, "ab" * n, "aab" * n, "-=" * n + "=", "hello" * n):
        assert coder.code([piece])[piece][0] == " ".join(map(str, library._encode_single_piece(piece)))


def test_pairs_that_rank_before_their_parts():
    tokens = {bytes([b]): b for b in range(256)} | {b"aaa": 256, b"aa": 257, b"aab": 258, b"ba": 259, b"baa": 255 + 5}
    other = b.PieceCoder(tokens)
    known = tiktoken.Encoding("own", pat_str=".+", mergeable_ranks=tokens, special_tokens={})
    rng = random.Random(1)
    pieces = ["aab" * 30 + "a" * 31] + ["".join(rng.choices("aaab", k=rng.randint(49, 120))) for _ in range(40)]
    for piece, coded in other.code(pieces).items():
        assert coded[0] == " ".join(map(str, known._encode_single_piece(piece)))


def test_documents_equal_the_library(spark, library):
    rows = ODD + [(30, sentences(4000)), (31, "don't <|endoftext|> I'LL  \x1c\x85\xa0 12345  ")]
    got = b.encode(with_clashes(frame(spark, rows)), VOCABULARY).collect()
    assert len(got) == len(rows)
    want = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        raw = (text or "").encode()
        want.append((i, len(ids), digest, hashlib.sha256(raw).hexdigest(), ids, raw))
    assert sorted(((*r[:5], bytes(r.decoded)) for r in got), key=repr) == sorted(want, key=repr)


def test_decoding_gives_the_text_back(spark):
    rows = [(i, sentences(100, i) + chr(0x1F600 + i)) for i in range(20)]
    for r in b.encode(frame(spark, rows), VOCABULARY).collect():
        assert bytes(r.decoded).decode() == dict(rows)[r.doc_id]


def test_digests_only(spark):
    columns = b.encode(frame(spark, []), VOCABULARY, keep_ids=False, keep_decoded=False)
    assert columns.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert columns.count() == 0


def test_a_coder_freed_after_each_task_changes_nothing(spark):
    df = frame(spark, ODD * 3).repartition(5)
    kept = b.encode(df, VOCABULARY).select("doc_id", "ids_sha256", "decoded_sha256")
    freed = b.encode(df, VOCABULARY, memo_pieces=7, keep_coder=False).select(*kept.columns)
    assert sorted(map(str, kept.collect())) == sorted(map(str, freed.collect()))
    assert sorted(map(str, freed.collect())) == sorted(map(str, kept.collect()))
