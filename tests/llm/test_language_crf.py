import zlib

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import language_crf as l
from shelfmark.llm.rolling import Powers, string_views
from tests.llm.samples import ODD, frame, with_clashes

SF_DIR = "/root/testdata/sf0.01"
EN = "the weather is nice and we are going to the beach with the children this afternoon"
DE = "das wetter ist schön und wir gehen heute nachmittag mit den kindern an den strand"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_held_out_documents_are_recognised(documents):
    found = l.identify(documents).alias("p").join(documents.alias("d"), "doc_id")
    rows = found.select("doc_id", "held_out", "lang_pred", "score", "d.lang").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    right = [r.lang == r.lang_pred for r in rows if r.held_out and r.lang]
    assert len(right) > 200 and np.mean(right) > 0.98


def test_labels_of_held_out_documents_are_not_used(spark):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(60)]
    true = frame(spark, rows, "doc_id long, text string, lang string")
    lies = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else g) for i, t, g in rows]
    false = frame(spark, lies, "doc_id long, text string, lang string")
    assert sorted(l.identify(true).collect()) == sorted(l.identify(false).collect())


def test_code_switched_words_get_their_own_labels():
    field = l.train([(EN, "en"), (DE, "de")] * 20)
    text = EN + " " + DE + " " + EN
    data, offsets = string_views(pa.array([text]))
    likely, per_row = l.label_words(field, data, offsets, Powers())
    n, m = len(EN.split()), len(DE.split())
    best = [field.labels[k] for k in likely.argmax(axis=1)]
    assert per_row.tolist() == [0, 2 * n + m]
    want = ["en"] * n + ["de"] * m + ["en"] * n
    assert np.mean([a == b for a, b in zip(best, want)]) > 0.95
    assert l._shares(field, pa.array([text]), Powers())[2][0] >= 2


def test_odd_texts(spark):
    rows = ODD + [(20, "12 345 ... !!"), (21, "«—» €"), (22, "٣ ½"), (23, "的字")]
    rows = [(i, t, None) for i, t in rows] + [(30 + i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(40)]
    found = l.identify(with_clashes(frame(spark, rows, "doc_id long, text string, lang string"))).collect()
    assert len(found) == len(rows)
    unknown = {r.doc_id for r in found if r.lang_pred == "und"}
    assert {1, 2, 3, 20, 21, 22} <= unknown and not unknown & {4, 5, 6, 23, 30, 31}
    assert all((r.score == 0) == (r.lang_pred == "und") for r in found)


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string, lang string"
    assert l.identify(frame(spark, [], schema)).count() == 0
    rows = [(i, EN, None) for i in range(5)]
    assert {r.lang_pred for r in l.identify(frame(spark, rows, schema)).collect()} == {"und"}


def test_blocks_of_rows_change_nothing(monkeypatch):
    field = l.train([(EN, "en"), (DE, "de")] * 5)
    column = pa.array([EN, None, DE + " " + EN, "", "x", DE * 9, "..."])
    whole = l._shares(field, column, Powers())
    monkeypatch.setattr(l, "BLOCK_BYTES", 64)
    parts = l._shares(field, column, Powers())
    assert whole[0] == parts[0] and whole[2] == parts[2] and whole[1] == pytest.approx(parts[1], abs=1e-5)


def test_sample_is_bounded(documents):
    sample = l.training_sample(documents, 20)
    languages = [g for _, g in sample]
    assert {languages.count(g) for g in set(languages)} <= set(range(10, 21)) and len(set(languages)) == 4


def test_copies_without_an_id_are_one_text(spark):
    rows = [(None, EN, "en")] * 5_000 + [(i, f"{DE} {i} wort{i}", "de") for i in range(40)] + [(1, None, "en"), (2, EN, None)]
    sample = l.training_sample(frame(spark, rows, "doc_id long, text string, lang string"), 20)
    assert [g for _, g in sample].count("en") == 1
    assert [g for _, g in sample].count("de") == 20 and len(set(sample)) == len(sample)
