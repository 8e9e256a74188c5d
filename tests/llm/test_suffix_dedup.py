import hashlib
import random

import numpy as np
import pytest

from shelfmark.llm import suffix_dedup as s
from shelfmark.llm.rolling import Powers
from tests.llm.samples import ODD, frame, sentences, with_clashes


def brute_force(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            window = raw[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i, text] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def corpus():
    rng = random.Random(5)
    passages = [sentences(20, 50 + k) for k in range(4)]
    base = sentences(60, 99)
    rows = ODD + [(10, "a" * 500), (11, "ab" * 300), (12, "a" * 150), (13, "的" * 90), (14, "的" * 90)]
    for i in range(20, 70):
        parts = [sentences(rng.randint(1, 8), i), rng.choice(passages), sentences(rng.randint(0, 8), i + 1)]
        rows.append((i, " ".join([*parts, rng.choice(passages)[rng.randint(0, 40) :], "end"])))
    for i in range(70, 100):
        words = base.split()
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((i, " ".join(words)))
    return rows + [(100, base), (101, base), (101, base), (None, base), (102, base * 3)]


@pytest.mark.parametrize("max_contexts", [2048, 3])
def test_documents_equal_brute_force(spark, max_contexts):
    rows = corpus()
    found = s.deduplicate(with_clashes(frame(spark, rows)), max_contexts=max_contexts)
    found = found.select("doc_id", "text", f"{found.columns[-1]}.*").collect()
    want = brute_force(rows)
    assert len(found) == len(rows)
    for r in found:
        got = (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept))
        assert got == want[r.doc_id, r.text], r.doc_id


def test_test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute_force([tuple(r) for r in docs.collect()])
    for r in s.deduplicate(docs).select("doc_id", "text", "dedup.*").collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) == want[r.doc_id, r.text]


def test_texts_of_equal_hashes_without_an_id_stay_apart(spark):
    passage = sentences(30, 7)
    alike = [f"{k} {passage[k % 40:]}" for k in (110898, 136361)]
    rows = [(1, passage), (None, alike[0]), (None, alike[1])]
    df = frame(spark, rows)
    assert df.filter("doc_id IS NULL").selectExpr("hash(text) AS h").distinct().count() == 1
    want = brute_force(rows)
    for r in s.deduplicate(df).select("doc_id", "text", "dedup.*").collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) == want[r.doc_id, r.text]


def test_ids_of_other_types_order_the_documents(spark):
    rows = corpus()
    want = brute_force(rows)
    for kind, shown in (("string", "lpad(doc_id, 9, '0')"), ("double", "doc_id / 1000")):
        df = with_clashes(frame(spark, rows)).selectExpr("*", f"cast({shown} AS {kind}) AS name")
        found = s.deduplicate(df, id_col="name")
        assert found.columns[:-1] == df.columns
        found = found.select("doc_id", "text", f"{found.columns[-1]}.*").collect()
        assert len(found) == len(rows)
        for r in found:
            got = (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept))
            assert got == want[r.doc_id, r.text], r.doc_id


def test_text_ids_sort_by_their_bytes(spark):
    passage = sentences(40, 11)
    rows = [("10", passage), ("9", passage), ("B", passage), ("a", passage), (None, passage)]
    found = s.deduplicate(frame(spark, rows, "doc_id string, text string")).collect()
    assert {r["doc_id"] for r in found if r["dedup"]["n_removed"] == 0} == {"10"}


@pytest.mark.parametrize("seed", range(20))
def test_intervals_equal_prefixes(seed):
    rng = random.Random(seed)
    contexts = ["".join(rng.choice("ab") for _ in range(rng.randint(8, 40))).encode() for _ in range(12)]
    text, at = s._joined(contexts)
    order = s.suffix_order(text, 8)
    interval = np.empty(len(text), np.int64)
    interval[order] = s.expand_intervals(text, order, 8)
    by_prefix = {}
    for c, context in enumerate(contexts):
        for o in range(len(context) - 7):
            by_prefix.setdefault(context[o : o + 8], set()).add(int(interval[at[c] + o]))
    assert all(len(v) == 1 for v in by_prefix.values())
    assert len(set().union(*by_prefix.values())) == len(by_prefix)


def test_equal_windows_have_equal_anchors_and_every_window_one_run():
    rng = random.Random(1)
    shared = bytes(rng.randrange(256) for _ in range(400))
    texts = [bytes(rng.randrange(256) for _ in range(n)) + shared[a:b] for n, a, b in ((0, 0, 400), (37, 50, 350), (205, 0, 160))]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, start, size, anchor, _ = s.runs(data, offsets, 100, 16, Powers())
    windows = {}
    for r, a, n, h in zip(row, start, size, anchor):
        for at in range(a, a + n):
            window = texts[r][at : at + 100]
            assert len(window) == 100
            windows.setdefault(window, []).append(h)
    assert sum(map(len, windows.values())) == sum(max(0, len(t) - 99) for t in texts)
    assert all(len(set(v)) == 1 for v in windows.values()) and max(map(len, windows.values())) == 3


def test_long_texts_are_anchored_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(s, "PIECE_BYTES", 3000)
    import pyarrow as pa

    text = sentences(2000, 4)
    pieces = list(s._pieces(pa.array([text, "short", None and "", text[:50]]), 100))
    starts = sorted({int(p[3][0]) + k for p in pieces if p[2][0] == 0 for k in range(max(0, len(p[0]) - 99))})
    assert starts[: len(text.encode()) - 99] == list(range(len(text.encode()) - 99))


def test_empty_table(spark):
    assert s.deduplicate(frame(spark, [])).count() == 0


def test_bytes_of_cut_characters_go(spark):
    df = spark.createDataFrame([(bytearray("aé".encode()[:2]),), (bytearray("aé".encode()),), (None,)], "kept binary")
    assert [r[0] for r in df.select(s.as_text("kept")).collect()] == ["a", "aé", None]
