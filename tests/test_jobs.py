import json

import pytest
import yaml
from pyspark.sql import functions as F

from shelfmark.__main__ import main
from shelfmark.plans import jobs, model
from shelfmark.plans.config import read_config
from shelfmark.queries import views
from shelfmark.queries.registry import RECORD_DDL
from shelfmark.sources import readers, writers
from shelfmark.streaming import scoring

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def jsonl(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "records")
    writers.write_jsonl(views.products(spark, TINY).drop("doc_id"), path)
    return path


def etl_config(jsonl, out, **etl):
    return {
        "etl_pipeline": {
            "input_path": jsonl,
            "output_path": out,
            "data_fraction": 1.0,
            "seed": 42,
            "label_column": "main_cat",
            "text_columns": ["asin", "title", "description", "feature", "brand"],
            **etl,
        },
        "tokenizer": {"max_length": 32, "vocab_size": 400},
    }


def test_config_file_and_overrides(tmp_path):
    path = tmp_path / "config.yaml"
    path.write_text(yaml.safe_dump({"etl_pipeline": {"data_fraction": 1.0}, "tokenizer": {"max_length": 512}}))
    settings = read_config(str(path), extra=1)
    assert settings["etl_pipeline"]["data_fraction"] == 1.0 and settings["extra"] == 1


def test_etl_from_a_yaml_file(spark, jsonl, tmp_path):
    path = tmp_path / "config.yaml"
    path.write_text(yaml.safe_dump(etl_config(jsonl, str(tmp_path / "out"))))
    out = jobs.run_etl(spark, str(path))
    assert out.columns == ["combined_text", "main_cat"] and out.count() == 200


def test_etl_with_corpus_vocabulary(spark, jsonl, tmp_path):
    config = etl_config(jsonl, str(tmp_path / "out"), tokenizer_model="corpus", schema=RECORD_DDL)
    for subwords in (False, True):
        config["tokenizer"]["subwords"] = subwords
        out = jobs.run_etl(spark, config)
        assert out.columns == ["main_cat", "input_ids", "attention_mask"] and out.count() == 200
        sizes = out.select(F.size("input_ids").alias("a"), F.size("attention_mask").alias("b"))
        assert sizes.distinct().collect() == [(32, 32)]


def test_etl_with_a_vocabulary_file(spark, jsonl, tmp_path):
    vocab = tmp_path / "vocab.txt"
    vocab.write_text("\n".join(["[PAD]", "[UNK]", "[CLS]", "[SEP]", "the", "of", "##s", "|", "["]))
    config = etl_config(jsonl, str(tmp_path / "out"), tokenizer_model=str(vocab))
    out = jobs.run_etl(spark, config)
    # asin, then the separator and the title.
    assert {r.input_ids[0] for r in out.collect()} == {2}
    assert {r.input_ids[2] for r in out.collect()} == {7}


def test_malformed_lines(spark, tmp_path):
    source = tmp_path / "raw.jsonl"
    source.write_text('{"asin": "1", "main_cat": "de"}\n{"asin": "2", \n{"asin": "3"}\n')
    schema = "asin string, main_cat string"
    config = etl_config(str(source), str(tmp_path / "out"), text_columns=["asin"], schema=schema)
    kept = jobs.run_etl(spark, config)
    assert sorted(r.combined_text for r in kept.collect()) == ["", "1", "3"]
    rejected = str(tmp_path / "rejected")
    kept = jobs.run_etl(spark, config, rejected_path=rejected)
    assert sorted(r.combined_text for r in kept.collect()) == ["1", "3"]
    lines = [json.loads(r.value) for r in spark.read.text(rejected).collect()]
    assert lines == [{"_corrupt_record": '{"asin": "2", '}]


def test_etl_sample(spark, jsonl, tmp_path):
    out = jobs.run_etl(spark, etl_config(jsonl, str(tmp_path / "out")), data_fraction=0.5)
    assert 60 < out.count() < 140
    with pytest.raises(ValueError, match="fraction"):
        jobs.run_etl(spark, etl_config(jsonl, str(tmp_path / "out")), data_fraction=2)


def train_config(path, **more):
    return {
        "input_data_path": path,
        "classes": views.LANGUAGES,
        "batch_size": 16,
        "num_features": 1 << 12,
        "candidates": [{"maxIter": 1, "regParam": 10.0}, {"maxIter": 8, "regParam": 0.01}],
        **more,
    }


@pytest.fixture(scope="module")
def trained(spark, jsonl, tmp_path_factory):
    base = tmp_path_factory.mktemp("train")
    config = etl_config(jsonl, str(base / "processed"), keep=["asin"], schema=RECORD_DDL)
    jobs.run_etl(spark, config)
    stored = str(base / "model")
    result = jobs.run_train(spark, train_config(str(base / "processed"), key="asin", model_path=stored))
    return result, stored


def test_training_keeps_the_lowest_validation_loss(trained):
    result, _ = trained
    tried = result.classifier.validation
    assert len(tried) == 2 and tried[1][1] < tried[0][1]
    assert result.classifier.model.stages[-1].getRegParam() == 0.01
    rows = {r.split: r for r in result.metrics.collect()}
    assert set(rows) == {"train", "val", "test"}
    assert sum(r.n_rows for r in rows.values()) == 200
    assert rows["val"].avg_loss == pytest.approx(tried[1][1])
    assert rows["test"].accuracy > 0.7
    assert sum(r.n for r in result.confusion.collect()) == rows["test"].n_rows
    steps = {r.split: r for r in result.steps.collect()}
    assert steps["train"].n_rows == rows["train"].n_rows


def test_training_is_repeatable(spark, trained, tmp_path, jsonl):
    result, _ = trained
    first = sorted(result.metrics.collect())
    assert first == sorted(result.metrics.collect())


def test_scoring_a_table_and_a_stream(spark, trained, jsonl, tmp_path):
    _, stored = trained
    batch = jobs.run_predict(spark, stored, readers.read_jsonl(spark, jsonl, schema=RECORD_DDL))
    expected = {r.asin: (r.prediction, r.predicted) for r in batch.collect()}
    assert len(expected) == 200 and {c for _, c in expected.values()} <= set(views.LANGUAGES)
    records = scoring.read_record_stream(spark, jsonl, RECORD_DDL)
    out = str(tmp_path / "scored")
    for _ in range(2):  # the second run finds nothing new
        query = scoring.score_stream(
            spark, stored, records, out, str(tmp_path / "progress"), ["asin", "prediction", "predicted"]
        )
        assert query.awaitTermination(120)
    rows = readers.read_parquet(spark, out).collect()
    assert len(rows) == 200
    assert {r.asin: (r.prediction, r.predicted) for r in rows} == expected


def test_model_is_stored_with_its_text_rules(spark, trained):
    result, stored = trained
    loaded = model.load(spark, stored)
    assert loaded.spec == result.classifier.spec


def test_training_on_token_arrays(spark, jsonl, tmp_path):
    """Raw records, batch or stream, score as the stored token arrays do."""
    vocab_path, stored = str(tmp_path / "vocab"), str(tmp_path / "model")
    config = etl_config(
        jsonl, str(tmp_path / "out"), tokenizer_model="corpus", schema=RECORD_DDL,
        keep=["asin"], vocab_path=vocab_path,
    )
    encoded = jobs.run_etl(spark, config)
    settings = train_config(
        str(tmp_path / "out"), data_fraction=0.9, vocab_path=vocab_path, max_length=32, model_path=stored
    )
    result = jobs.run_train(spark, settings)
    assert result.classifier.spec.encoded
    expected = {r.asin: r.predicted for r in jobs.score(result.classifier, encoded).collect()}
    raw = readers.read_jsonl(spark, jsonl, schema=RECORD_DDL)
    assert {r.asin: r.predicted for r in jobs.run_predict(spark, stored, raw).collect()} == expected
    records, out = scoring.read_record_stream(spark, jsonl, RECORD_DDL), str(tmp_path / "scored")
    query = scoring.score_stream(spark, stored, records, out, str(tmp_path / "progress"), ["asin", "predicted"])
    assert query.awaitTermination(120)
    assert {r.asin: r.predicted for r in readers.read_parquet(spark, out).collect()} == expected


def test_encoded_model_without_vocabulary(spark, jsonl, tmp_path):
    config = etl_config(jsonl, str(tmp_path / "out"), tokenizer_model="corpus", schema=RECORD_DDL)
    copy = str(tmp_path / "copy")  # the table alone, without the note on how it was made
    writers.write_parquet(jobs.run_etl(spark, config), copy)
    result = jobs.run_train(spark, train_config(copy, candidates=[{"maxIter": 1}]))
    with pytest.raises(ValueError, match="no vocabulary"):
        jobs.score(result.classifier, readers.read_jsonl(spark, jsonl, schema=RECORD_DDL))


def test_unseen_label_fails_training(spark, jsonl, tmp_path):
    jobs.run_etl(spark, etl_config(jsonl, str(tmp_path / "out")))
    with pytest.raises(Exception, match="Unseen label"):
        jobs.run_train(spark, train_config(str(tmp_path / "out"), classes=["de", "en"]))


def test_large_models_are_refused(spark):
    spec = model.TextSpec(classes=tuple(f"c{i}" for i in range(1000)))
    with pytest.raises(ValueError, match="max_coefficients"):
        model.train(None, None, spec, num_features=1 << 16)
    with pytest.raises(ValueError, match="8000 coefficients"):
        model.train(None, None, spec, num_features=8, max_coefficients=7999)


def test_class_without_training_rows(spark):
    rows = [(f"word{i % 2} common", "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "combined_text string, main_cat string")
    spec = model.TextSpec(classes=("a", "b", "c"))
    classifier = model.train(df, df, spec, num_features=64)
    out = model.predict(classifier, df).collect()
    assert {len(r.scores) for r in out} == {3}
    assert all(r.predicted == r.main_cat for r in out)


def test_terms_are_counted_once(spark, jsonl, tmp_path, monkeypatch):
    """The split table has term counts and no text, and trains the model that the text trains."""
    out, seen = str(tmp_path / "out"), []
    jobs.run_etl(spark, etl_config(jsonl, out, keep=["asin"], schema=RECORD_DDL))
    export = jobs.splits.export_shards
    monkeypatch.setattr(jobs.splits, "export_shards", lambda df, *a, **b: seen.append(df.columns) or export(df, *a, **b))
    jobs.run_train(spark, train_config(out, key="asin", candidates=[{"maxIter": 1}]))
    assert seen == [["split", "tf", "main_cat"]]
    df, spec = readers.read_parquet(spark, out), model.TextSpec(classes=views.LANGUAGES)
    counted = model.with_term_counts(df, spec, 64)
    assert "combined_text" not in counted.columns
    one = model.train(df, df, spec, [{"maxIter": 3}], 64)
    two = model.train(counted, counted, spec, [{"maxIter": 3}], 64, counted=True)
    assert one.validation[0][1] == pytest.approx(two.validation[0][1])
    expected = {r.asin: r.predicted for r in model.predict(one, df).collect()}
    assert {r.asin: r.predicted for r in model.predict(two, counted, counted=True).collect()} == expected


def test_command_line(spark, jsonl, tmp_path, capsys):
    config, processed = tmp_path / "etl.yaml", str(tmp_path / "processed")
    config.write_text(yaml.safe_dump(etl_config(jsonl, processed)))
    main(["etl", str(config)])
    settings = train_config(processed, classes=list(views.LANGUAGES))
    config.write_text(yaml.safe_dump(settings))
    stored, scored = str(tmp_path / "model"), str(tmp_path / "scored")
    main(["train", "--config", str(config), "--data_fraction", "0.9", "--model_path", stored])
    assert '"split": "test"' in capsys.readouterr().out
    main(["predict", "--model_path", stored, "--input_path", jsonl, "--output_path", scored])
    assert readers.read_parquet(spark, scored).count() == 200
    out = str(tmp_path / "profile")
    main(["profile", "--input_path", jsonl, "--output_path", out, "--schema", RECORD_DDL])
    names = ("summary", "category_counts", "words_per_category", "avg_words", "box_stats")
    tables = {n: readers.read_parquet(spark, f"{out}/{n}") for n in names}
    assert tables["summary"].first().total_rows == 200
    assert tables["box_stats"].count() == tables["avg_words"].count() == 4


def test_profile_job(spark):
    tables = jobs.run_profile(views.products(spark, TINY), "main_cat", "description")
    assert set(tables) == {"summary", "category_counts", "words_per_category", "avg_words", "box_stats"}
    assert tables["summary"].first().total_rows == 200


def test_profile_writes_all_categories(spark, tmp_path):
    source, out = tmp_path / "raw.jsonl", str(tmp_path / "profile")
    lines = [json.dumps({"main_cat": f"c{i % 150}", "description": ["a b"] * (i % 4)}) for i in range(600)]
    source.write_text("\n".join(lines))
    main(["profile", "--input_path", str(source), "--output_path", out])
    for name in ("category_counts", "avg_words", "box_stats"):
        assert readers.read_parquet(spark, f"{out}/{name}").count() == 150


def vocabulary_file(tmp_path):
    words = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "the", "th", "##e", "##s", "of", "|", "[", "a", "##a", "'"]
    path = tmp_path / "vocab.txt"
    path.write_text("\n".join(words + [f"##{c}" for c in "bcdfghijklmnoprtuvwxyz"]))
    return str(path)


def test_one_encoding_from_etl_to_scoring(spark, jsonl, tmp_path):
    """A vocabulary file, other columns and rules: scoring raw records encodes as the ETL did."""
    out, stored = str(tmp_path / "out"), str(tmp_path / "model")
    config = etl_config(
        jsonl, out, tokenizer_model=vocabulary_file(tmp_path), schema=RECORD_DDL, keep=["asin"],
        text_columns=["title", "brand", "asin"], list_style="join", skip="falsy",
    )
    encoded = jobs.run_etl(spark, config)
    want = {r.asin: r.input_ids for r in encoded.collect()}
    jobs.run_train(spark, train_config(out, key="asin", model_path=stored, candidates=[{"maxIter": 2}]))
    raw = readers.read_jsonl(spark, jsonl, schema=RECORD_DDL)
    got = {r.asin: list(r.input_ids) for r in jobs.run_predict(spark, stored, raw).collect()}
    assert got == want


def test_contradicting_settings_are_refused(spark, jsonl, tmp_path):
    jobs.run_etl(spark, etl_config(jsonl, str(tmp_path / "out")))
    for wrong in ({"text_columns": ["title"]}, {"skip": "falsy"}, {"max_length": 7}):
        with pytest.raises(ValueError, match="not made with the given settings"):
            jobs.run_train(spark, train_config(str(tmp_path / "out"), **wrong))


def test_joined_vocabulary_in_the_etl(spark, jsonl, tmp_path):
    arrays = []
    for strategy in ("broadcast", "join"):
        config = etl_config(jsonl, str(tmp_path / strategy), tokenizer_model="corpus", keep=["asin"])
        config["tokenizer"] |= {"strategy": strategy, "key": "asin", "subwords": True}
        arrays.append({r.asin: list(r.input_ids) for r in jobs.run_etl(spark, config).collect()})
    assert arrays[0] == arrays[1]


def test_scoring_refuses_missing_columns(spark, trained, jsonl):
    _, stored = trained
    raw = readers.read_jsonl(spark, jsonl, schema=RECORD_DDL)
    with pytest.raises(ValueError, match="lack.*title"):
        jobs.run_predict(spark, stored, raw.drop("title"))
    records = scoring.read_record_stream(spark, jsonl, RECORD_DDL).drop("title")
    with pytest.raises(ValueError, match="lack.*title"):
        jobs.run_predict(spark, stored, records)


def test_records_that_do_not_conform_are_set_apart(spark, jsonl, tmp_path):
    out, stored = str(tmp_path / "out"), str(tmp_path / "model")
    record = {"asin": "str", "title": "str", "brand": "str"}
    jobs.run_etl(spark, etl_config(jsonl, out, schema=RECORD_DDL, record=record))
    jobs.run_train(spark, train_config(out, model_path=stored, candidates=[{"maxIter": 1}]))
    raw = readers.read_jsonl(spark, jsonl, schema=RECORD_DDL)
    n_bad = raw.filter("brand IS NULL").count()
    assert 0 < n_bad < 200
    scored = jobs.run_predict(spark, stored, raw)
    rejected = jobs.rejected_records(spark, stored, raw)
    assert (scored.count(), rejected.count()) == (200 - n_bad, n_bad)
    assert {r.reject_reason for r in rejected.collect()} == {"brand: null"}
    records = scoring.read_record_stream(spark, jsonl, RECORD_DDL)
    path = str(tmp_path / "rejected")
    scoring.reject_stream(spark, stored, records, path, str(tmp_path / "progress")).awaitTermination(120)
    assert readers.read_parquet(spark, path).count() == n_bad


def test_a_loaded_model_can_be_saved_over_itself(spark, jsonl, tmp_path):
    out, stored = str(tmp_path / "out"), tmp_path / "model"
    jobs.run_etl(spark, etl_config(jsonl, out, tokenizer_model="corpus", schema=RECORD_DDL))
    jobs.run_train(spark, train_config(out, model_path=str(stored), candidates=[{"maxIter": 1}]))
    raw = readers.read_jsonl(spark, jsonl, schema=RECORD_DDL)
    before = sorted(r.predicted for r in jobs.run_predict(spark, str(stored), raw).collect())
    model.save(model.load(spark, str(stored)), str(stored))
    after = sorted(r.predicted for r in jobs.run_predict(spark, str(stored), raw).collect())
    assert before == after
    assert len([p for p in stored.iterdir() if p.name.startswith("v-")]) == 1


def test_jobs_leave_no_scratch_but_their_results(spark, jsonl, tmp_path):
    from pathlib import Path

    from shelfmark.session import scratch_dir, shared_dir

    assert scratch_dir(spark).startswith(shared_dir(spark))
    folder = Path(scratch_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    jobs.run_etl(spark, etl_config(jsonl, str(tmp_path / "out"), tokenizer_model="corpus", schema=RECORD_DDL))
    with pytest.raises(Exception, match="Unseen label"):
        jobs.run_train(spark, train_config(str(tmp_path / "out"), classes=["de", "en"]))
    jobs.run_train(spark, train_config(str(tmp_path / "out"), candidates=[{"maxIter": 1}]))
    assert set(folder.iterdir()) == before


def test_joined_vocabularies_score_streams_once(spark, jsonl, tmp_path):
    config = etl_config(jsonl, str(tmp_path / "out"), tokenizer_model="corpus", keep=["asin"], schema=RECORD_DDL)
    config["tokenizer"] |= {"strategy": "join", "key": "asin"}
    jobs.run_etl(spark, config)
    stored = str(tmp_path / "model")
    jobs.run_train(spark, train_config(str(tmp_path / "out"), model_path=stored, candidates=[{"maxIter": 1}]))
    raw = readers.read_jsonl(spark, jsonl, schema=RECORD_DDL)
    want = sorted((r.asin, r.prediction) for r in jobs.run_predict(spark, stored, raw).collect())
    records = scoring.read_record_stream(spark, jsonl, RECORD_DDL)
    with pytest.raises(ValueError, match="score_stream"):
        jobs.run_predict(spark, stored, records)
    out = str(tmp_path / "scored")
    # Another checkpoint repeats the batch, as after a failure before it was noted.
    for progress in ("first", "second"):
        query = scoring.score_stream(spark, stored, records, out, str(tmp_path / progress), ["asin", "prediction"])
        query.awaitTermination(120)
        assert sorted((r.asin, r.prediction) for r in readers.read_parquet(spark, out).collect()) == want


def test_joined_scoring_stores_no_text_twice(spark, jsonl, tmp_path):
    """Numbered records are stored without their combined text; a stream's batch leaves no table behind."""
    from pathlib import Path

    from shelfmark.session import scratch_dir

    config = etl_config(jsonl, str(tmp_path / "out"), tokenizer_model="corpus", keep=["asin"], schema=RECORD_DDL)
    config["tokenizer"] |= {"strategy": "join", "key": "asin"}
    jobs.run_etl(spark, config)
    stored, scratch = str(tmp_path / "model"), []
    jobs.run_train(spark, train_config(str(tmp_path / "out"), model_path=stored, candidates=[{"maxIter": 1}]))
    raw = readers.read_jsonl(spark, jsonl, schema=RECORD_DDL)
    scored = jobs.score(model.load(spark, stored), raw, scratch=scratch)
    by_key = jobs.run_predict(spark, stored, raw, "asin")
    assert sorted(scored.columns) == sorted(by_key.columns)
    columns = ["asin", "title", "input_ids", "prediction"]
    assert sorted(scored.select(columns).collect()) == sorted(by_key.select(columns).collect())
    numbered, _ = scratch
    assert "combined_text" not in spark.read.parquet(numbered).columns
    folder = Path(scratch_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    records = scoring.read_record_stream(spark, jsonl, RECORD_DDL)
    out, progress = str(tmp_path / "scored"), str(tmp_path / "progress")
    scoring.score_stream(spark, stored, records, out, progress, ["asin", "prediction"]).awaitTermination(120)
    assert set(folder.iterdir()) == before


def test_split_table_has_few_files(spark, tmp_path):
    """Files of the split table follow its size, not the batch size."""
    df = spark.range(5000).selectExpr("concat('w', id % 7) AS combined_text", "concat('c', id % 2) AS main_cat")
    writers.write_parquet(df, str(tmp_path / "in"))
    seen, export = [], jobs.splits.export_shards
    jobs.splits.export_shards = lambda table, path, *a, **k: (export(table, path, *a, **k), seen.append(spark.read.parquet(path).inputFiles()))
    try:
        settings = {"classes": ["c0", "c1"], "num_features": 16, "candidates": [{"maxIter": 1}]}
        jobs.run_train(spark, {"input_data_path": str(tmp_path / "in"), **settings})
    finally:
        jobs.splits.export_shards = export
    assert len(seen[0]) <= 3 * 8


def test_malformed_lines_are_counted(spark, tmp_path):
    source = tmp_path / "raw.jsonl"
    source.write_text('{"asin": "1"}\n{"asin": "2", \n{"asin": "3"}\n{"other": 1}\n')
    row = jobs.malformed_lines(readers.read_jsonl(spark, str(source), schema="asin string")).first()
    assert (row.n_lines, row.n_malformed, row.n_blank) == (4, 1, 1)
