import corpus_pipeline as p
from shelfmark.llm.common import Workspace
from tests.llm.samples import frame, sentences

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, spans int"


def documents(spark, rows):
    full = [(i, t, lang, "s", None if t is None else len(t), "k", 1) for i, t, lang in rows]
    return frame(spark, full, SCHEMA)


def kept(df):
    return sorted((r.doc_id for r in df.collect()), key=repr)


def test_stages_keep_the_columns_and_run(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    workspace, counts = Workspace(spark), []
    assert [n for n, _ in p.STAGES][0].startswith("language") and len(p.STAGES) == 5
    for name, stage in p.STAGES[:-1]:
        after = workspace.store(stage(spark, docs, SF_DIR), "stage")
        assert after.dtypes == docs.dtypes
        docs = after
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]
    rows = p.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert len(rows) == counts[-1] and all(len(r.ids) == r.n_tokens for r in rows)
    assert sorted(map(repr, rows)) == sorted(map(repr, p.run(spark, SF_DIR).collect()))
    workspace.clear()


def labelled():
    en, de = "the house is by the sea and we like it", "das haus ist am meer und wir mögen es"
    return [(100 + i, en if i % 2 else de, "en" if i % 2 else "de") for i in range(30)]


def test_language_stage(spark):
    rows = [*labelled(), (1, None, None), (2, "12 34", "en"), (None, "das haus und das meer", None)]
    left = p.identify_language(spark, documents(spark, rows), SF_DIR)
    assert kept(left) == kept(documents(spark, [*labelled(), (None, "x", None)]))


def test_documents_of_several_languages_stay(spark):
    words = {"en": "house sea like and the we", "de": "haus meer mögen und das wir", "fr": "maison mer aimer et la nous"}
    rows = [(100 + i, w * 3, g) for i, (g, w) in enumerate(words.items())]
    mixed = " ".join(words.values())
    left = p.identify_language(spark, documents(spark, [*rows, (1, mixed, None), (2, mixed * 400, None)]), SF_DIR)
    assert {r.doc_id for r in left.collect()} == {1, 2, 100, 101, 102}


def test_copies_and_long_texts(spark):
    hot = sentences(200, 3)
    rows = [(i, hot, "en") for i in range(50)] + [(100, sentences(30_000, 4), "en"), (101, "=" * 100_000, "en")]
    docs = documents(spark, rows)
    assert {r.doc_id for r in p.drop_near_duplicates(spark, docs, SF_DIR).collect()} == {0, 100, 101}
    found = p.tokenize(spark, docs, SF_DIR).collect()
    assert len(found) == len(rows) and len({r.ids_sha256 for r in found if r.doc_id < 50}) == 1


def test_one_document_of_each_group_stays(spark):
    base = sentences(300)
    rows = [(5, base, "en"), (3, base, "en"), (3, base, "en"), (None, base, "en"), (9, sentences(300, 8), "en")]
    rows += [(None, None, None), (7, None, None)]
    assert kept(p.drop_near_duplicates(spark, documents(spark, rows), SF_DIR)) == [3, 7, 9]


def test_texts_lose_repeats(spark):
    base = "é" + sentences(40)
    rows = [(1, base, "en"), (2, "new " + base, "en"), (3, None, None)]
    found = {r.doc_id: r for r in p.remove_repeats(spark, documents(spark, rows), SF_DIR).collect()}
    assert found[1].text == base and found[2].text == "new " and found[3].text is None
    assert found[2].n_chars == 4 and found[1].n_chars == len(base)


def test_contaminated_documents_go(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    rows = [(1, "before " + item + " after", "en"), (2, sentences(50), "en"), (3, None, None)]
    assert kept(p.decontaminate(spark, documents(spark, rows), SF_DIR)) == [2, 3]


def test_stages_on_empty_tables(spark):
    none = documents(spark, [])
    for _, stage in p.STAGES:
        assert stage(spark, none, SF_DIR).count() == 0
