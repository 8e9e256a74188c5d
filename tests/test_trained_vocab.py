import json
import random
from collections import Counter

import pytest

from shelfmark.functions import bytelevel
from shelfmark.operators import byte_tokens, tokens, trained_vocab


def plain(counts, n_merges, marked=False, score="count", min_count=1):
    """The same training, one merge at a time, everything counted anew."""
    words = [(["##" + c if marked and i else c for i, c in enumerate(w)], n) for w, n in counts.items()]
    symbols = sorted({s for w, _ in words for s in w})
    age = {s: i for i, s in enumerate(symbols)}
    # Equal texts of different merges are different symbols.
    words = [([age[s] for s in w], n) for w, n in words]
    merges = []
    while len(merges) < n_merges:
        pairs, single = Counter(), Counter()
        for w, n in words:
            for p in zip(w, w[1:]):
                pairs[p] += n
            for s in w:
                single[s] += n
        value = {
            p: n if score == "count" else n / (float(single[p[0]]) * single[p[1]])
            for p, n in pairs.items()
            if n >= min_count
        }
        if not value:
            break
        a, b = min(value, key=lambda p: (-value[p], max(p), p))
        left, right = symbols[a], symbols[b]
        merges.append((left, right, pairs[a, b]))
        symbols.append(left + (right[2:] if marked and right.startswith("##") else right))
        new = len(symbols) - 1
        for w, _ in words:
            i = 0
            while i < len(w) - 1:
                if (w[i], w[i + 1]) == (a, b):
                    w[i : i + 2] = [new]
                i += 1
    return symbols[: len(symbols) - len(merges)], merges


def corpus(seed, n=300, alphabet="abcdeé的"):
    rng = random.Random(seed)
    return {"".join(rng.choices(alphabet, k=rng.randint(1, 8))): rng.randint(1, 20) for _ in range(n)}


@pytest.mark.parametrize("marked, score", [(False, "count"), (True, "count"), (True, "likelihood")])
def test_merges_equal_the_plain_loop(spark, marked, score):
    counts = corpus(1) | {"aaaaaa": 7, "x": 3, "##": 2}
    df = spark.createDataFrame(list(counts.items()), "token string, n long")
    n = 40 if score == "count" else 8
    assert trained_vocab.train_merges(df, n, marked, score, 3) == plain(counts, n, marked, score, 3)


def test_training_ends_without_pairs(spark):
    df = spark.createDataFrame([("ab", 5), ("c", 9), ("", 3)], "token string, n long")
    assert trained_vocab.train_merges(df, 10) == (["a", "b", "c"], [("a", "b", 5)])
    assert trained_vocab.train_merges(df.limit(0), 10) == ([], [])
    assert trained_vocab.train_merges(df, 0)[1] == []
    assert trained_vocab.train_merges(df, 10, min_count=6)[1] == []
    with pytest.raises(ValueError, match="score"):
        trained_vocab.train_merges(df, 1, score="best")


def test_scratch_is_removed(spark):
    import os

    from shelfmark import session

    folder = session.scratch_dir(spark)
    before = set(os.listdir(folder))
    df = spark.createDataFrame(list(corpus(2, 50).items()), "token string, n long")
    trained_vocab.train_merges(df, 6)
    assert set(os.listdir(folder)) == before


def test_wordpiece_vocabulary_encodes(spark):
    df = spark.createDataFrame([("low lower lowest newer newest",), (None,)], "combined_text string")
    vocab = trained_vocab.train_wordpiece(df, "combined_text", 30, score="count")
    rows = {r.token: r.id for r in vocab.collect()}
    assert [rows[t] for t in tokens.SPECIAL_TOKENS] == [0, 1, 2, 3]
    assert len(rows) <= 30 and sorted(rows.values()) == list(range(len(rows)))
    found = tokens.encode(df, vocab, max_length=30, subwords=True).first()
    assert rows["[UNK]"] not in found.input_ids


def test_byte_level_file_equals_a_plain_trainer_and_encodes(spark):
    texts = ["the theme of the thing, thé thé", "thinner things; the end", "  the\n\nend", None]
    df = spark.createDataFrame([(t,) for t in texts], "combined_text string")
    text = trained_vocab.train_byte_level(df, "combined_text", 20, ["[PAD]", "[CLS]", "[SEP]"])
    alphabet = bytelevel.byte_alphabet()
    counts = Counter(
        "".join(alphabet[b] for b in p.encode())
        for t in texts
        for p in bytelevel.piece_pattern().findall(t or "")
    )
    # Symbols that the texts lack don't change the order of those that they have.
    want = [[a, b] for a, b, _ in plain(counts, 20, min_count=2)[1]]
    assert json.loads(text)["model"]["merges"] == want
    parsed = bytelevel.parse_tokenizer(text, ["[CLS]"], ["[SEP]"])
    assert len(parsed.ids(texts[0], 10**6)) < len(texts[0])
    assert byte_tokens.SCHEMA.startswith("value")
