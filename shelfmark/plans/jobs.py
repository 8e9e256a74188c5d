"""The four jobs: ETL, training, scoring and profiling."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.labels import CATEGORIES
from shelfmark.operators import byte_tokens, evaluate, prep, profile, splits, tokens
from shelfmark.plans import epochs, model
from shelfmark.plans.config import Config, read_config
from shelfmark.session import exists, read_note, remove, scratch_path, write_note
from shelfmark.sources.readers import CORRUPT_COLUMN, dealt, read_jsonl, read_parquet
from shelfmark.sources.writers import write_jsonl, write_parquet

# ``tokenizer_model`` value that asks for a vocabulary made from the data themselves.
CORPUS = "corpus"

# Normalizer of a spec whose vocabulary is a tokenizer file with a byte-level merge list.
BYTE_LEVEL = "byte_level"

_ROW = "_row_number"

# Where the ETL keeps, inside its output, how the text was made. Readers of the table pass over
# names that begin with an underscore.
SPEC_NOTE = "_spec"


def run_etl(spark: SparkSession, config: Config, **overrides) -> DataFrame:
    """JSON-lines → combined text or token arrays → Parquet; returns the written table.

    Settings ``etl_pipeline``: ``input_path``, ``output_path``, ``data_fraction``, ``seed``,
    ``sample_key`` (draws by key), ``label_column``, ``text_columns`` and optionally ``schema``
    (DDL), ``partitions`` (deals rows of gzip files out), ``list_style``, ``skip``, ``keep``,
    ``record`` (field types that scoring is to check), ``tokenizer_model``: ``corpus``, or the
    path of a WordPiece vocabulary file or, ending in ``.json``, of a tokenizer file with a byte-level
    merge list, ``vocab_path``, where to keep the vocabulary (default:
    inside the output), and, with a schema, ``rejected_path``, where lines that do not parse go
    (else they stay, as rows of nulls; :func:`malformed_lines` counts them). Settings
    ``tokenizer``: ``max_length``, ``strategy`` (``broadcast`` or ``join``) and ``key`` for
    ``join``, for ``corpus``, ``vocab_size`` and ``subwords``, and, for a tokenizer file that doesn't
    say it itself, ``prefix`` and ``suffix``, lists of the tokens that frame a text, and ``pad``.

    How the text was made and encoded is stored with the output; training reads it there.
    """
    settings = read_config(config)
    etl = {**settings["etl_pipeline"], **overrides}
    tokenizer = settings.get("tokenizer") or {}
    raw = read_jsonl(
        spark,
        etl["input_path"],
        etl.get("data_fraction", 1.0),
        etl.get("seed", 42),
        schema=etl.get("schema"),
        key=etl.get("sample_key"),
    )
    # The probe for a first row comes before rows are dealt out: behind that exchange it would
    # read all input.
    prep.validate_input(raw, etl.get("text_columns"), etl.get("label_column", prep.LABEL_COLUMN))
    if etl.get("rejected_path") and CORRUPT_COLUMN in raw.columns:
        malformed = F.col(CORRUPT_COLUMN).isNotNull()
        write_jsonl(raw.filter(malformed), etl["rejected_path"])
        raw = raw.filter(~malformed)
    spec = etl_spec(etl, tokenizer)
    scratch: list[str] = []
    try:
        out, spec = preprocess_records(dealt(raw, etl.get("partitions")), etl, tokenizer, spec, scratch)
        write_parquet(out, etl["output_path"])
        if spec.encoded and not etl.get("vocab_path"):
            kept = f"{etl['output_path']}/_vocab"
            write_parquet(read_parquet(spark, spec.vocab_path), kept)
            spec = replace(spec, vocab_path=kept)
        write_note(spark, f"{etl['output_path']}/{SPEC_NOTE}", model.spec_to_json(spec))
    finally:
        remove(spark, scratch)
    return read_parquet(spark, etl["output_path"])


def malformed_lines(df: DataFrame) -> DataFrame:
    """One row, for records read with a schema: lines, those that did not parse, and those that
    did but have none of the fields."""
    malformed = F.col(CORRUPT_COLUMN).isNotNull()
    fields = [F.col(c) for c in df.columns if c != CORRUPT_COLUMN]
    blank = ~malformed & F.coalesce(*[f.cast("string") for f in fields]).isNull()
    return df.agg(
        F.count("*").alias("n_lines"),
        F.count(F.when(malformed, 1)).alias("n_malformed"),
        F.count(F.when(blank, 1)).alias("n_blank"),
    )


def etl_spec(etl: dict, tokenizer: dict) -> model.TextSpec:
    """How the ETL makes its text, before a vocabulary is known."""
    source = etl.get("tokenizer_model")
    return model.TextSpec(
        classes=(),
        text_columns=tuple(etl.get("text_columns") or prep.TEXT_COLUMNS),
        label_column=etl.get("label_column", prep.LABEL_COLUMN),
        list_style=etl.get("list_style", "repr"),
        skip=etl.get("skip", "null"),
        encoded=bool(source),
        max_length=tokenizer.get("max_length", tokens.MAX_LENGTH),
        normalizer=_normalizer(source),
        subwords=bool(source) and tokenizer.get("subwords", source != CORPUS),
        strategy=tokenizer.get("strategy", "broadcast"),
        record=tuple((etl.get("record") or {}).items()),
    )


def _normalizer(source: str | None) -> str:
    if source in (None, "", CORPUS):
        return "simple"
    return BYTE_LEVEL if source.endswith(".json") else "wordpiece"


def preprocess_records(
    raw: DataFrame, etl: dict, tokenizer: dict, spec: model.TextSpec, scratch: list[str]
) -> tuple[DataFrame, model.TextSpec]:
    """The transformation step of :func:`run_etl`, for validated records.

    Adds the tables that can go once the result is written to ``scratch``.
    """
    spark = raw.sparkSession
    combined = prep.preprocess(
        raw,
        spec.text_columns,
        spec.label_column,
        list_style=spec.list_style,
        skip=spec.skip,
        keep=etl.get("keep", ()),
        validate=False,
    )
    if not spec.encoded:
        return combined, spec
    source = etl["tokenizer_model"]
    vocab_path = etl.get("vocab_path")
    if not vocab_path:
        vocab_path = scratch_path(spark, "vocab")
        scratch.append(vocab_path)
    if source == CORPUS:
        # Two passes over the text: from a columnar copy, not from the JSON lines again.
        copy = scratch_path(spark, "combined")
        scratch.append(copy)
        write_parquet(combined, copy)
        combined = read_parquet(spark, copy)
        size = tokenizer.get("vocab_size", 30_000)
        vocab = tokens.build_vocab(
            combined, prep.COMBINED_COLUMN, size, subwords=spec.subwords, scratch=scratch
        )
    elif spec.normalizer == BYTE_LEVEL:
        names = (tokenizer.get(n) for n in ("prefix", "suffix", "pad"))
        vocab = byte_tokens.read_tokenizer(spark, source, *names)
    else:
        vocab = tokens.read_vocab(spark, source)
    write_parquet(vocab, vocab_path)
    spec = replace(spec, vocab_path=vocab_path)
    return _encoded(combined, spec, tokenizer.get("key"), scratch), spec


def _encoded(
    df: DataFrame, spec: model.TextSpec, key: str | None = None, scratch: list[str] | None = None
) -> DataFrame:
    """Token arrays as the spec makes them."""
    vocab = read_parquet(df.sparkSession, spec.vocab_path) if spec.vocab_path else None
    if spec.normalizer == BYTE_LEVEL and vocab is not None and "input_ids" not in df.columns:
        return byte_tokens.encode(df, vocab, spec.text, spec.max_length)
    return tokens.ensure_encoded(
        df,
        vocab,
        text=spec.text,
        max_length=spec.max_length,
        normalizer=spec.normalizer,
        subwords=spec.subwords,
        strategy=spec.strategy,
        key=key,
        scratch=scratch,
    )


@dataclass(frozen=True)
class TrainingResult:
    classifier: model.Classifier
    metrics: DataFrame
    confusion: DataFrame
    steps: DataFrame


def training_spec(spark: SparkSession, df: DataFrame, settings: dict) -> model.TextSpec:
    """The spec stored with the input, else one from the settings; they must not contradict."""
    note = f"{settings['input_data_path']}/{SPEC_NOTE}"
    given = {n: settings[n] for n in model.SPEC_SETTINGS if settings.get(n) is not None}
    for name in ("text_columns", "record"):
        if name in given:
            given[name] = tuple(dict(given[name]).items() if name == "record" else given[name])
    classes = tuple(settings.get("classes") or CATEGORIES)
    encoded = "input_ids" in df.columns
    if not exists(spark, note):
        return model.TextSpec(classes=classes, encoded=encoded, **given)
    spec = replace(model.spec_from_json(read_note(spark, note)), classes=classes)
    wrong = [n for n, value in given.items() if getattr(spec, n) != value]
    if wrong or spec.encoded != encoded:
        raise ValueError(f"The input was not made with the given settings: {wrong or 'encoded'}")
    return spec


def run_train(spark: SparkSession, config: Config, **overrides) -> TrainingResult:
    """Sample, split, train, evaluate every split, store the model.

    Settings: ``input_data_path``, ``data_fraction``, ``seed``, ``batch_size``,
    ``test_batch_size``, ``num_epochs``, ``key`` (column or columns; default: the text or
    the token arrays), ``classes``, ``candidates``, ``num_features``, ``max_coefficients``,
    ``model_path``. ``trainer``: ``candidates`` (default) fits every candidate and keeps the best;
    ``epochs`` trains ``num_epochs`` epochs of batches of ``batch_size`` and keeps the best, with
    ``learning_rate``, ``rounds``, ``shard_rows`` and ``state_path``, from which a training that was
    broken off goes on. How the text was made comes from the input, where the ETL stored it; for
    other inputs the settings of :data:`model.SPEC_SETTINGS` say it.
    """
    settings = read_config(config, **overrides)
    df = read_parquet(spark, settings["input_data_path"])
    spec = training_spec(spark, df, settings)
    content = "input_ids" if spec.encoded else spec.text
    key = settings.get("key") or content
    seed = settings.get("seed", 42)
    sampled = splits.sample(df, float(settings.get("data_fraction", 1.0)), seed, key)
    inputs = ["input_ids", "attention_mask"] if spec.encoded else [spec.text]
    keys = [key] if isinstance(key, str) else list(key)
    columns = dict.fromkeys([*keys, *inputs, spec.label_column])
    marked = splits.assign_split(sampled.select(*columns), key, seed)
    # The candidates, their losses and the evaluation need term counts only: terms are counted on the
    # way to the split table, not in each of these passes.
    counted = settings.get("trainer", "candidates") != "epochs"
    if counted:
        num_features = settings.get("num_features", model.NUM_FEATURES)
        most = settings.get("max_coefficients", model.MAX_COEFFICIENTS)
        model.check_coefficients(spec, num_features, most)
        marked = model.with_term_counts(marked, spec, num_features)
        marked = marked.select("split", model.TERM_COUNTS, spec.label_column)
    # The split table is written once; every later step opens the folders it needs. The
    # order is drawn per row, not by content: copies of one text must not share a task.
    shards = scratch_path(spark, "shards")
    batch_size = settings.get("batch_size", 8)
    try:
        splits.export_shards(marked, shards, batch_size, None, seed=seed)
        table = read_parquet(spark, shards)
        train_df, val_df = (table.filter(F.col("split") == s) for s in ("train", "val"))
        classifier = _trained(train_df, val_df, spec, settings)
        if settings.get("model_path"):
            model.save(classifier, settings["model_path"])
        scored = model.predict(classifier, model.with_label_id(table, spec), counted)
        scored = scored.withColumn(model.LABEL_ID, F.col(model.LABEL_ID).cast("int"))
        # All rows are scored once; what is kept of them are a few counts, splits times labels times
        # predictions at most.
        counts = evaluate.scored_counts(scored, model.LABEL_ID)
        counts = spark.createDataFrame(counts.collect(), counts.schema)
    finally:
        remove(spark, [shards])
    test = counts.filter(F.col("split") == "test").select(model.LABEL_ID, "prediction", "n")
    rows = counts.groupBy("split").agg(F.sum("n").alias("n_rows"))
    return TrainingResult(
        classifier,
        evaluate.metrics_of_counts(counts, model.LABEL_ID, by=["split"]),
        evaluate.with_share(test, model.LABEL_ID),
        splits.steps_of_counts(
            rows, batch_size, settings.get("num_epochs", 1), settings.get("test_batch_size")
        ),
    )


def _trained(
    train_df: DataFrame, val_df: DataFrame, spec: model.TextSpec, settings: dict
) -> model.Classifier:
    if settings.get("trainer", "candidates") == "epochs":
        names = {f.name for f in fields(epochs.EpochSettings)}
        chosen = epochs.EpochSettings(**{n: v for n, v in settings.items() if n in names})
        return model.train_epochs(train_df, val_df, spec, chosen, settings.get("state_path"))
    names = ("candidates", "num_features", "max_coefficients")
    return model.train(train_df, val_df, spec, counted=True, **{n: settings[n] for n in names if n in settings})


def run_predict(
    spark: SparkSession, model_path: str, df: DataFrame, key: str | None = None
) -> DataFrame:
    """Score records, batch or streaming, with a stored classifier.

    The text is combined in the column order and with the rules of the training, and
    encoded with the vocabulary of the training where the model needs token arrays. Records
    without one of the text columns are refused; where the model has a record declaration,
    only conforming records are scored (:func:`rejected_records` has the others). A model whose
    vocabulary is joined takes a unique ``key`` of the records; without one they are numbered and stored first.
    """
    return score(model.load(spark, model_path), df, key)


def conforming(classifier: model.Classifier, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that the model's declaration admits, with all their columns, and the others."""
    declared = dict(classifier.spec.record)
    if not declared:
        return df, df.limit(0) if not df.isStreaming else df.filter(F.lit(False))
    _, rejected = prep.conform(df, declared, CORRUPT_COLUMN)
    return prep.conforming(df, declared, CORRUPT_COLUMN), rejected


def rejected_records(spark: SparkSession, model_path: str, df: DataFrame) -> DataFrame:
    """The records that :func:`run_predict` does not score, each with its ``reject_reason``."""
    return conforming(model.load(spark, model_path), df)[1]


def joins_vocabulary(classifier: model.Classifier) -> bool:
    """Whether raw text is encoded by joins, which a stream can do batch by batch only."""
    spec = classifier.spec
    return spec.encoded and spec.strategy == "join" and spec.normalizer != BYTE_LEVEL


def score(
    classifier: model.Classifier, df: DataFrame, key: str | None = None, scratch: list[str] | None = None
) -> DataFrame:
    """:func:`run_predict` with a classifier at hand.

    Adds the tables that can go once the result is written to ``scratch``.
    """
    spec = classifier.spec
    ready = "input_ids" in df.columns if spec.encoded else spec.text in df.columns
    joins = joins_vocabulary(classifier) and not ready
    numbered = joins and key is None
    if not ready:
        missing = [c for c in spec.text_columns if c not in df.columns]
        if missing:
            raise ValueError(f"The model was trained on columns that the records lack: {missing}")
        df, _ = conforming(classifier, df)
        if joins and df.isStreaming:
            raise ValueError("This model joins its vocabulary: score the stream with score_stream.")
        if numbered:
            # Numbers that a repeated task can't change: the records are stored with them, their text is made
            # when it is read.
            df, key = _numbered(df, scratch), _ROW
        df = prep.combine_text(df, spec.text_columns, spec.text, spec.list_style, spec.skip)
    if joins:
        df = _encoded(df, spec, key, scratch)
        if numbered:
            df = df.drop(_ROW)
    elif spec.encoded:
        df = _encoded(df, replace(spec, strategy="broadcast"))
    return model.predict(classifier, df)


def _numbered(df: DataFrame, scratch: list[str] | None) -> DataFrame:
    """The rows as they are stored, with a unique number each."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "numbered")
    if scratch is not None:
        scratch.append(path)
    df = df.withColumn(_ROW, F.monotonically_increasing_id())
    df.write.option("compression", "zstd").parquet(path)
    return read_parquet(spark, path)


def run_profile(
    df: DataFrame, category: str, text: str, strict: bool = False
) -> dict[str, DataFrame]:
    """The profiling tables of a data set.

    The rows are read once, to a histogram of word counts per category; it is stored and all
    five tables derive from it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "word-histogram")
    write_parquet(profile.words_per_category(df, category, text, strict), path)
    histogram = read_parquet(spark, path)
    return {
        "summary": profile.summary_of(histogram, category),
        "category_counts": profile.category_counts_of(histogram, category),
        "words_per_category": histogram,
        "avg_words": profile.avg_words_of(histogram, category),
        "box_stats": profile.box_stats_of(histogram, category),
    }
