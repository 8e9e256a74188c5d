"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import bytelevel, labels
from shelfmark.functions.text import render_text, words
from shelfmark.operators import byte_tokens, evaluate, prep, profile, splits, tokens, trained_vocab
from shelfmark.plans import epochs, jobs, model
from shelfmark.queries import views
from shelfmark.session import scratch_path, write_note
from shelfmark.sources import readers, writers
from shelfmark.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]

TEXT = prep.COMBINED_COLUMN
SEED = 42
VOCAB_SIZE = 30_000
RECORD_DDL = (
    "asin string, title string, description array<string>, feature array<string>, "
    "brand string, main_cat string, image array<string>, price string"
)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Sources and sinks


@query
def scan_documents(spark, sf_dir):
    """Parquet scan with a pushed filter and pruned columns."""
    df = views.documents(spark, sf_dir)
    return df.filter(F.col("lang") == "de").select("doc_id", "source", "n_chars")


@query
def jsonl_read(spark, sf_dir):
    """Records written as gzipped JSON-lines and read back with a schema."""
    path = scratch_path(spark, "records")
    writers.write_jsonl(views.products(spark, sf_dir).drop("doc_id"), path)
    df = readers.read_jsonl(spark, path, schema=RECORD_DDL)
    n_lines = F.size("description").alias("n_lines")
    return df.select("asin", "title", "brand", "price", "main_cat", n_lines)


@query
def jsonl_sample(spark, sf_dir):
    """Gzipped JSON-lines read with types inferred and a fraction of the keys kept."""
    path = scratch_path(spark, "records")
    writers.write_jsonl(views.products(spark, sf_dir).drop("doc_id"), path)
    df = readers.read_jsonl(spark, path, fraction=0.25, seed=7, key="asin")
    return df.select("asin", "main_cat")


@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "combined")
    df = _combined(spark, sf_dir)
    writers.write_parquet(df, path)
    return readers.read_parquet(spark, path)


@query
def take_rows(spark, sf_dir):
    df = views.products(spark, sf_dir, spread=False)
    return readers.take_rows(df, 100, ["asin", "title", "brand", "price"], order_by="doc_id")


@query
def take_any_rows(spark, sf_dir):
    """Any 100 rows: their number, and how many of them are products in all fields."""
    df = views.products(spark, sf_dir, spread=False)
    content = F.xxhash64(*[F.col(c) for c in views.RECORD]).alias("content")
    taken = readers.take_rows(df, 100, list(views.RECORD)).select("asin", content)
    known = df.select("asin", content, F.lit(1).alias("known"))
    return taken.join(known, ["asin", "content"], "left").agg(
        F.count("*").alias("n_rows"),
        F.count("known").alias("n_known"),
        F.countDistinct("asin").alias("n_keys"),
    )


# Validation, projection, combination


@query
def validated_projection(spark, sf_dir):
    """Validated records projected to text columns and label."""
    df = views.products(spark, sf_dir, spread=False)
    wanted = ["asin", "title", "brand"]
    prep.validate_input(df, wanted)
    return prep.project_columns(df, wanted)


@query
def combine_repr(spark, sf_dir):
    return _combined(spark, sf_dir)


@query
def combine_join(spark, sf_dir):
    return _combined(spark, sf_dir, list_style="join")


@query
def combine_flatten(spark, sf_dir):
    df = prep.combine_text(views.products(spark, sf_dir), list_style="flatten")
    return df.select("asin", TEXT)


@query
def combine_falsy(spark, sf_dir):
    """The serving rule: declared order, no image, empty values left out."""
    df = prep.combine_text(
        views.products(spark, sf_dir), list(views.RECORD), skip="falsy", exclude=["image"]
    )
    return df.select("asin", TEXT)


@query
def render_scalars(spark, sf_dir):
    """Integers, doubles of all magnitudes, booleans and number lists as text."""
    keys = F.array(F.col("l_orderkey"), F.col("l_linenumber").cast("bigint"), F.lit(None))
    lineitem = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet", views.cores(spark))
    df = lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * 1e6).alias("large"),
        (F.col("l_extendedprice") * 2.0**60).alias("huge"),
        (F.col("l_discount") / 512.0).alias("small"),
        (F.col("l_tax") / -65536.0).alias("tiny"),
        (F.col("l_quantity") > 25).alias("flag"),
        keys.alias("keys"),
    )
    values = ["l_orderkey", "price", "large", "huge", "small", "tiny", "flag", "keys"]
    rendered = prep.combine_text(df, values, out="rendered")
    keys_text = render_text(F.col("keys"), df.schema["keys"].dataType).alias("keys_text")
    return rendered.select("l_orderkey", "l_linenumber", "rendered", keys_text)


@query
def conform_valid(spark, sf_dir):
    valid, _ = prep.conform(views.products(spark, sf_dir), views.RECORD)
    lists = [F.size(c).alias(f"n_{c}") for c in ("description", "feature", "image")]
    return valid.select("asin", "brand", "price", "title", *lists)


@query
def conform_lines(spark, sf_dir):
    """JSON lines of mixed types, each value judged by its own; conforming fields or a reason per line."""
    docs, mode = views.documents(spark, sf_dir), F.col("doc_id") % 6
    title, tags = F.col("text").alias("title"), F.array("lang").alias("tags")
    whole = F.to_json(F.struct(F.col("doc_id").alias("id"), title, tags))
    line = (
        F.when(mode == 1, F.to_json(F.struct(F.col("doc_id").alias("id"), F.array("text").alias("title"), tags)))
        .when(mode == 2, F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), title, tags)))
        .when(mode == 3, F.to_json(F.struct(F.col("doc_id").alias("id"), title, F.array("doc_id").alias("tags"))))
        .when(mode == 4, F.substring(whole, F.lit(1), F.length(whole) - 1))
        .otherwise(whole)
    )
    path = scratch_path(spark, "lines")
    docs.select(line.alias("value")).write.option("compression", "gzip").text(path)
    declared = {"id": "int", "title": "str", "tags": "List[str]"}
    valid, rejected = prep.conform_lines(readers.read_lines(spark, path), declared)
    none = F.lit(None).cast("string")
    number = F.regexp_extract("value", r'^\{"id":"?(\d+)', 1).cast("long")
    return valid.select("id", F.md5("title").alias("title_md5"), F.col("tags")[0].alias("tag"), F.lit("").alias("reject_reason")).union(
        rejected.select(number, none, none, "reject_reason")
    )


@query
def conform_rejected(spark, sf_dir):
    _, rejected = prep.conform(views.products(spark, sf_dir), views.RECORD)
    return rejected.select("asin", "main_cat", "reject_reason")


# Labels


@query
def label_encode(spark, sf_dir):
    label_id = labels.encode(F.col("category"), labels.CATEGORIES).alias("label_id")
    return views.categories(spark, sf_dir).select("doc_id", label_id)


@query
def label_encode_partial(spark, sf_dir):
    """Labels outside a shorter class list become null."""
    label_id = labels.encode(F.col("category"), labels.CATEGORIES[::2], on_unseen="null")
    return views.categories(spark, sf_dir).select("doc_id", label_id.alias("label_id"))


@query
def label_decode(spark, sf_dir):
    df = views.predictions(spark, sf_dir)
    name = labels.decode(F.col("prediction"), views.LANGUAGES).alias("predicted")
    return df.select("doc_id", "prediction", name)


@query
def category_slug(spark, sf_dir):
    df = views.categories(spark, sf_dir).groupBy("category").agg(F.count("*").alias("n_rows"))
    return df.select("category", labels.slug(F.col("category")).alias("slug"), "n_rows")


@query
def best_class(spark, sf_dir):
    df = views.predictions(spark, sf_dir)
    return df.select("doc_id", labels.argmax(F.col("scores")).alias("best"))


# Profiling


@query
def summary(spark, sf_dir):
    return profile.summary(views.products(spark, sf_dir, spread=False), "main_cat")


@query
def brand_summary(spark, sf_dir):
    """Null is one of the distinct values."""
    return profile.summary(views.products(spark, sf_dir, spread=False), "brand")


@query
def category_counts(spark, sf_dir):
    return profile.category_counts(views.products(spark, sf_dir, spread=False), "main_cat")


@query
def word_counts(spark, sf_dir):
    df = profile.with_word_count(views.products(spark, sf_dir), "description")
    return df.select("asin", "num_words")


@query
def words_per_category(spark, sf_dir):
    return profile.words_per_category(views.products(spark, sf_dir), "main_cat", "description")


@query
def avg_words(spark, sf_dir):
    df = profile.avg_words(views.products(spark, sf_dir), "main_cat", "description")
    return df.select("main_cat", F.round("average_num_words", 6).alias("average_num_words"))


@query
def box_stats(spark, sf_dir):
    df = profile.box_stats(views.products(spark, sf_dir), "main_cat", "description")
    return _rounded(df)


@query
def box_stats_by_brand(spark, sf_dir):
    return _rounded(profile.box_stats(views.products(spark, sf_dir), "brand", "description"))


# Sampling, splitting, shuffling


@query
def hash_sample(spark, sf_dir):
    df = splits.sample(views.documents(spark, sf_dir), 0.3, SEED, "doc_id")
    return df.select("doc_id", "lang")


@query
def bernoulli_sample(spark, sf_dir):
    """A sample by Spark's own draws: per language its part of the documents, and the whole's size.

    The size is right within five standard deviations.
    """
    docs = views.documents(spark, sf_dir).select("doc_id", "lang")
    drawn = splits.sample(docs, 0.3, SEED).select("doc_id", F.lit(1).alias("drawn"))
    joined = docs.join(drawn, "doc_id", "left")
    per_lang = joined.groupBy("lang").agg(
        F.countDistinct("doc_id").alias("n_documents"),
        F.count("*").alias("n_joined"),
        (F.count("drawn") <= F.count("*")).alias("is_part"),
    )
    total = joined.agg(F.count("*").alias("n"), F.count("drawn").alias("k"))
    near = F.abs(F.col("k") - 0.3 * F.col("n")) <= 5 * F.sqrt(0.21 * F.col("n"))
    return per_lang.join(total.select(near.alias("size_is_near")))


@query
def hash_split(spark, sf_dir):
    df = splits.assign_split(views.documents(spark, sf_dir), "doc_id", SEED)
    return df.select("doc_id", "split")


@query
def hash_three_way(spark, sf_dir):
    """The three frames of a split, counted per language."""
    parts = splits.three_way(views.documents(spark, sf_dir), SEED, "doc_id")
    return _part_counts(parts)


@query
def random_three_way(spark, sf_dir):
    """Spark's own split: its parts are disjoint, make up each language, and have their shares."""
    parts = splits.three_way(views.documents(spark, sf_dir), SEED)
    named = [df.select("doc_id", "lang", F.lit(n).alias("split")) for n, df in zip(splits.SPLITS, parts)]
    union = named[0].unionByName(named[1]).unionByName(named[2])
    total = union.agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col("split") == n, 1)).alias(n) for n in splits.SPLITS]
    )
    near = F.lit(True)
    for name, share in zip(splits.SPLITS, (0.64, 0.16, 0.2)):
        off = F.abs(F.col(name) - share * F.col("n"))
        near = near & (off <= 5 * F.sqrt(share * (1 - share) * F.col("n")))
    per_lang = union.groupBy("lang").agg(
        F.count("*").alias("n_rows"), F.countDistinct("doc_id").alias("n_documents")
    )
    return per_lang.join(total.select(near.alias("shares_are_near")))


@query
def plan_steps(spark, sf_dir):
    marked = splits.assign_split(views.documents(spark, sf_dir), "doc_id", SEED)
    return splits.plan_steps(marked, batch_size=16, epochs=3, test_batch_size=64)


@query
def shuffle_rows(spark, sf_dir):
    return splits.shuffle(views.documents(spark, sf_dir).select("doc_id", "lang"), SEED, "doc_id")


@query
def reshuffle_rows(spark, sf_dir):
    """A shuffled table in another order, by another seed."""
    df = splits.shuffle(views.documents(spark, sf_dir).select("doc_id", "lang"), SEED, "doc_id")
    return splits.shuffle(df, SEED + 1, "doc_id")


@query
def scatter_rows(spark, sf_dir):
    df = views.documents(spark, sf_dir).select("doc_id", "lang")
    return splits.shuffle(df, SEED, "doc_id", mode="scatter")


@query
def export_shards(spark, sf_dir):
    """Training files per split, read back."""
    path = scratch_path(spark, "shards")
    df = splits.assign_split(views.documents(spark, sf_dir), "doc_id", SEED)
    splits.export_shards(df.select("doc_id", "lang", "split"), path, 16, seed=SEED, key="doc_id")
    return readers.read_parquet(spark, path)


# Tokens


def _combined(spark, sf_dir, **options):
    """Validated on the first row, then dealt out and combined."""
    df = views.products(spark, sf_dir, spread=False)
    return prep.preprocess(df, keep=["asin"], partitions=views.cores(spark), **options)


@query
def vocab(spark, sf_dir):
    return tokens.build_vocab(_combined(spark, sf_dir), TEXT, VOCAB_SIZE)


@query
def encode(spark, sf_dir):
    df = _combined(spark, sf_dir)
    encoded = tokens.encode(df, tokens.build_vocab(df, TEXT, VOCAB_SIZE))
    return _encoded_text(encoded)


@query
def encode_joined(spark, sf_dir):
    """The same by joins, for vocabularies beyond the broadcast bound."""
    df = _combined(spark, sf_dir)
    table = tokens.build_vocab(df, TEXT, VOCAB_SIZE)
    return _encoded_text(tokens.encode(df, table, key="asin", strategy="join"))


@query
def encode_lengths(spark, sf_dir):
    """Real tokens per record at the full length."""
    df = _combined(spark, sf_dir)
    encoded = tokens.encode(df, tokens.build_vocab(df, TEXT, VOCAB_SIZE))
    real = F.size(F.filter("attention_mask", lambda m: m == 1)).alias("n_tokens")
    return encoded.select("asin", real, F.size("input_ids").alias("length"))


@query
def reuse_encoded(spark, sf_dir):
    """Stored token arrays are used as they are."""
    path = scratch_path(spark, "encoded")
    df = _combined(spark, sf_dir)
    vocab_table = tokens.build_vocab(df, TEXT, VOCAB_SIZE)
    writers.write_parquet(tokens.ensure_encoded(df, vocab_table), path)
    return _encoded_text(tokens.ensure_encoded(readers.read_parquet(spark, path)))


def _byte_tokenizer(spark) -> str:
    """The path of a tokenizer file with the merge list."""
    path = scratch_path(spark, "tokenizer") + ".json"
    merges = [tuple(map(bytelevel.in_alphabet, pair)) for pair in views.MERGES]
    write_note(spark, path, bytelevel.tokenizer_text(merges, tokens.SPECIAL_TOKENS))
    return path


@query
def trained_merges(spark, sf_dir):
    """The first merges of a subword vocabulary trained on the documents' words."""
    counts = tokens.count_words(views.documents(spark, sf_dir, spread=True), "text")
    return trained_vocab.merge_table(spark, trained_vocab.train_merges(counts, 24)[1])


FRAME = {"prefix": [tokens.CLS], "suffix": [tokens.SEP], "pad": tokens.PAD}


@query
def encode_byte_level(spark, sf_dir):
    """Whole documents by a tokenizer file with a byte-level merge list."""
    tokenizer = byte_tokens.read_tokenizer(spark, _byte_tokenizer(spark), **FRAME)
    encoded = byte_tokens.encode(views.documents(spark, sf_dir, spread=True), tokenizer, "text")
    return _encoded_text(encoded, "doc_id")


@query
def etl_byte_level(spark, sf_dir):
    """ETL job with such a tokenizer file."""
    settings = _etl_settings(spark, sf_dir, tokenizer_model=_byte_tokenizer(spark))
    settings["tokenizer"] = {"max_length": tokens.MAX_LENGTH, **FRAME}
    return _encoded_text(jobs.run_etl(spark, settings))


def _piece_vocab(spark, sf_dir):
    df = views.documents(spark, sf_dir, spread=True)
    return tokens.build_vocab(df, "text", VOCAB_SIZE, subwords=True)


@query
def piece_vocab(spark, sf_dir):
    return _piece_vocab(spark, sf_dir)


@query
def subword_table(spark, sf_dir):
    """Pieces of every distinct word of the documents."""
    distinct = tokens.count_words(views.documents(spark, sf_dir, spread=True), "text")
    table = tokens.subword_table(distinct, _piece_vocab(spark, sf_dir))
    pieces = F.array_join("pieces", " ").alias("pieces")
    return table.select("token", pieces, F.size("piece_ids").alias("n_pieces"))


@query
def encode_subwords(spark, sf_dir):
    df = views.documents(spark, sf_dir, spread=True).select("doc_id", "text")
    encoded = tokens.encode(df, _piece_vocab(spark, sf_dir), "text", subwords=True)
    return _encoded_text(encoded, "doc_id")


@query
def encode_subwords_joined(spark, sf_dir):
    """The same by joins: each word's substrings, then each word's pieces."""
    df = views.documents(spark, sf_dir, spread=True).select("doc_id", "text")
    table = _piece_vocab(spark, sf_dir)
    encoded = tokens.encode(df, table, "text", subwords=True, key="doc_id", strategy="join")
    return _encoded_text(encoded, "doc_id")


# Evaluation


@query
def metrics(spark, sf_dir):
    return _rounded(evaluate.metrics(views.predictions(spark, sf_dir)))


@query
def metrics_by_split(spark, sf_dir):
    return _rounded(evaluate.by_split(views.predictions(spark, sf_dir)))


@query
def confusion_long(spark, sf_dir):
    df = evaluate.confusion(views.predictions(spark, sf_dir), normalize=True)
    return _rounded(df)


@query
def confusion_wide(spark, sf_dir):
    return evaluate.confusion_wide(views.predictions(spark, sf_dir), len(views.LANGUAGES))


@query
def confusion_percent(spark, sf_dir):
    """One class more than there are: its row and column are all zero."""
    df = views.predictions(spark, sf_dir)
    return _rounded(evaluate.confusion_wide(df, len(views.LANGUAGES) + 1, percent=True))


@query
def log_loss(spark, sf_dir):
    return _rounded(evaluate.log_loss(views.predictions(spark, sf_dir), by=["split"]))


# Model and jobs


def _language_settings(input_path, model_path=None):
    return {
        "input_data_path": input_path,
        "classes": views.LANGUAGES,
        "key": "asin",
        "batch_size": 16,
        "model_path": model_path,
    }


def _etl_settings(spark, sf_dir, **etl):
    source, target = scratch_path(spark, "records"), scratch_path(spark, "processed")
    writers.write_jsonl(views.products(spark, sf_dir).drop("doc_id"), source)
    return {
        "etl_pipeline": {
            "input_path": source,
            "output_path": target,
            "data_fraction": 1.0,
            "seed": SEED,
            "label_column": "main_cat",
            "keep": ["asin"],
            "schema": RECORD_DDL,
            **etl,
        },
        "tokenizer": {"max_length": tokens.MAX_LENGTH, "vocab_size": VOCAB_SIZE},
    }


@query
def etl_text(spark, sf_dir):
    """ETL job without a tokenizer."""
    return jobs.run_etl(spark, _etl_settings(spark, sf_dir))


@query
def etl_encoded(spark, sf_dir):
    """ETL job with a vocabulary of the corpus."""
    settings = _etl_settings(spark, sf_dir, tokenizer_model="corpus")
    return _encoded_text(jobs.run_etl(spark, settings))


CANDIDATES = [{"maxIter": 5, "regParam": 0.5}, {"maxIter": 20, "regParam": 0.01}]


@query
def train_text(spark, sf_dir):
    """Training job on text: rows of every split, and what must hold for loss and accuracy."""
    settings = _etl_settings(spark, sf_dir)
    jobs.run_etl(spark, settings)
    train = _language_settings(settings["etl_pipeline"]["output_path"])
    result = jobs.run_train(spark, {**train, "candidates": CANDIDATES})
    losses = [loss for _, loss in result.classifier.validation]
    is_kept = F.when(F.col("split") == "val", F.abs(F.col("avg_loss") - min(losses)) < 1e-9)
    return result.metrics.select(
        "split",
        "n_rows",
        F.coalesce(is_kept, F.lit(True)).alias("loss_is_the_lowest"),
        (F.col("avg_loss") < F.log(F.lit(len(views.LANGUAGES)))).alias("beats_guessing"),
        (F.col("accuracy") > 0.5).alias("mostly_right"),
    )


@query
def train_encoded(spark, sf_dir):
    """Training job on token arrays: support of the labels in the test split's confusion."""
    settings = _etl_settings(spark, sf_dir, tokenizer_model="corpus")
    jobs.run_etl(spark, settings)
    train = _language_settings(settings["etl_pipeline"]["output_path"])
    per_label = jobs.run_train(spark, train).confusion.groupBy("label").agg(
        F.sum("n").alias("n_rows"),
        F.round(F.sum("share"), 6).alias("share"),
        (F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))) * 2 > F.sum("n")).alias(
            "mostly_right"
        ),
    )
    return per_label


@query
def train_epochs(spark, sf_dir):
    """Four epochs on the lengths of words: each epoch's loss and accuracy on the rows held out.

    A batch is a shard here, so that a round is one step along the mean gradient of all rows.
    """
    df = views.documents(spark, sf_dir, spread=True).filter(F.col("lang").isNotNull())
    lengths = F.transform(words(F.lower("text")), F.length)
    df = df.select("doc_id", "lang", F.concat(F.array(F.lit(0)), lengths, F.array(F.lit(0))).alias("input_ids"))
    df = df.withColumn("attention_mask", F.transform("input_ids", lambda t: F.lit(1)))
    spec = model.TextSpec(classes=views.LANGUAGES, label_column="lang", encoded=True)
    settings = epochs.EpochSettings(num_epochs=4, batch_size=1 << 30, rounds=1, num_features=8)
    held_out = F.col("doc_id") % 5 == 0
    trained = model.train_epochs(df.filter(~held_out), df.filter(held_out), spec, settings)
    rows = [tuple(x.values()) for x, _ in trained.validation]
    names = "epoch int, train_rows long, val_loss double, val_accuracy double"
    return _rounded(spark.createDataFrame(rows, names))


def _stored_model(spark, sf_dir, tokenizer=None, **etl):
    settings, stored = _etl_settings(spark, sf_dir, **etl), scratch_path(spark, "model")
    settings["tokenizer"] |= tokenizer or {}
    encoded = jobs.run_etl(spark, settings)
    jobs.run_train(spark, _language_settings(settings["etl_pipeline"]["output_path"], stored))
    return settings["etl_pipeline"]["input_path"], stored, encoded


@query
def predict_records(spark, sf_dir):
    """Raw records scored with a stored model: the class is the best-scored one, and named so."""
    _, stored, _ = _stored_model(spark, sf_dir)
    scored = jobs.run_predict(spark, stored, views.products(spark, sf_dir))
    names = F.array(*[F.lit(c) for c in views.LANGUAGES])
    total = F.aggregate("scores", F.lit(0.0), lambda a, b: a + b)
    best = F.get("scores", F.col("prediction")) == F.array_max("scores")
    return scored.select(
        "asin",
        "main_cat",
        best.alias("is_best"),
        (F.get(names, F.col("prediction")) == F.col("predicted")).alias("is_named"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
    )


@query
def predict_stream(spark, sf_dir):
    """The same records arriving as files get the classes that the table gets."""
    source, stored, _ = _stored_model(spark, sf_dir)
    records = scoring.read_record_stream(spark, source, RECORD_DDL)
    out, progress = scratch_path(spark, "scored"), scratch_path(spark, "progress")
    columns = ["asin", "main_cat", "prediction", "predicted"]
    scoring.score_stream(spark, stored, records, out, progress, columns).awaitTermination()
    batch = jobs.run_predict(spark, stored, views.products(spark, sf_dir))
    batch = batch.select("asin", F.col("prediction").alias("in_batch"))
    both = readers.read_parquet(spark, out).join(batch, "asin")
    return both.select("asin", "main_cat", (F.col("prediction") == F.col("in_batch")).alias("same"))


@query
def predict_joined(spark, sf_dir):
    """A model whose vocabulary is joined scores a table, with a key and without, and a stream alike."""
    joined = {"strategy": "join", "key": "asin"}
    source, stored, _ = _stored_model(spark, sf_dir, joined, tokenizer_model="corpus")
    records = scoring.read_record_stream(spark, source, RECORD_DDL)
    out, progress = scratch_path(spark, "scored"), scratch_path(spark, "progress")
    columns = ["asin", "main_cat", "prediction"]
    scoring.score_stream(spark, stored, records, out, progress, columns).awaitTermination()
    both = readers.read_parquet(spark, out)
    for name, key in (("with_key", "asin"), ("without_key", None)):
        batch = jobs.run_predict(spark, stored, views.products(spark, sf_dir), key)
        both = both.join(batch.select("asin", F.col("prediction").alias(name)), "asin")
    same = (F.col("prediction") == F.col("with_key")) & (F.col("prediction") == F.col("without_key"))
    return both.select("asin", "main_cat", same.alias("same"))


@query
def predict_rejected(spark, sf_dir):
    """A model with a declaration scores conforming records; the others get their reason."""
    _, stored, _ = _stored_model(spark, sf_dir, record=views.RECORD)
    records = views.products(spark, sf_dir)
    rejected = jobs.rejected_records(spark, stored, records)
    scored = jobs.run_predict(spark, stored, records).filter(F.col("predicted").isNotNull())
    columns = ("asin", "main_cat", "reject_reason")
    return rejected.select(*columns).unionByName(
        scored.withColumn("reject_reason", F.lit("")).select(*columns)
    )


@query
def encoding_contract(spark, sf_dir):
    """A vocabulary file through ETL, training and scoring: raw records score as encoded there."""
    pieces = tokens.build_vocab(views.documents(spark, sf_dir, spread=True), "text", 4_000, subwords=True)
    path = scratch_path(spark, "vocabulary-file")
    ordered = pieces.select("token", "id").coalesce(1).sortWithinPartitions("id").select("token")
    ordered.write.text(path)
    _, stored, encoded = _stored_model(spark, sf_dir, tokenizer_model=path)
    scored = jobs.run_predict(spark, stored, views.products(spark, sf_dir))
    stored_ids = encoded.select("asin", F.col("input_ids").alias("stored_ids"))
    both = scored.join(stored_ids, "asin")
    return both.select("asin", "main_cat", (F.col("input_ids") == F.col("stored_ids")).alias("same"))


@query
def profile_job(spark, sf_dir):
    """The profile's five tables side by side, a row per category and number of words."""
    tables = jobs.run_profile(views.products(spark, sf_dir), "main_cat", "description")
    one = tables["box_stats"].drop("n_rows").join(tables["category_counts"], "main_cat")
    one = one.join(tables["avg_words"], "main_cat").crossJoin(tables["summary"])
    return _rounded(tables["words_per_category"].join(one, "main_cat"))


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, for comparing."""
    return df.select(
        *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _part_counts(parts) -> DataFrame:
    named = [df.withColumn("split", F.lit(n)) for n, df in zip(splits.SPLITS, parts)]
    union = named[0].unionByName(named[1]).unionByName(named[2])
    return union.groupBy("split", "lang").agg(F.count("*").alias("n_rows"))


def _encoded_text(encoded: DataFrame, key: str = "asin") -> DataFrame:
    """The token arrays of every record, written out for comparing."""
    arrays = [F.array_join(c, " ").alias(c) for c in ("input_ids", "attention_mask")]
    return encoded.select(key, *arrays)
