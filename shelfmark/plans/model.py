"""Text classifier: hashed term counts, inverse document frequency, logistic regression."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shelfmark.functions import labels
from shelfmark.functions.text import WORD_BREAK
from shelfmark.operators import evaluate, prep, tokens
from shelfmark.plans import epochs
from shelfmark.session import exists, read_note, remove, write_note
from shelfmark.sources.readers import read_parquet
from shelfmark.sources.writers import write_parquet

LABEL_ID = "label"
#: Hashed term counts of a text, before their weights.
TERM_COUNTS = "tf"
#: Coefficients, one double per feature and class, that the driver and every task may hold.
MAX_COEFFICIENTS = 10_000_000
NUM_FEATURES = 1 << 16


@dataclass(frozen=True)
class TextSpec:
    """How the classifier's input text was made; stored with the model."""

    classes: tuple[str, ...]
    text_columns: tuple[str, ...] = prep.TEXT_COLUMNS
    label_column: str = prep.LABEL_COLUMN
    text: str = prep.COMBINED_COLUMN
    list_style: str = "repr"
    skip: str = "null"
    encoded: bool = False
    # For models of token arrays: how raw text becomes them.
    vocab_path: str | None = None
    max_length: int = tokens.MAX_LENGTH
    normalizer: str = "simple"
    subwords: bool = False
    strategy: str = "broadcast"
    # Field types of the records, if the caller declared them: {field: type} as pairs.
    record: tuple[tuple[str, str], ...] = ()


#: Settings of a spec that a job may give; those stored beside its input win no argument.
SPEC_SETTINGS = (
    "text_columns label_column list_style skip vocab_path max_length normalizer subwords "
    "strategy record"
).split()


def spec_to_json(spec: TextSpec) -> str:
    return json.dumps(asdict(spec))


def spec_from_json(text: str) -> TextSpec:
    stored = json.loads(text)
    for name in ("classes", "text_columns"):
        stored[name] = tuple(stored[name])
    stored["record"] = tuple(map(tuple, stored.get("record", ())))
    return TextSpec(**stored)


@dataclass(frozen=True)
class Classifier:
    model: PipelineModel | epochs.HashedLinear
    spec: TextSpec
    validation: tuple[tuple[Mapping, float], ...] = ()


def feature_stages(spec: TextSpec, num_features: int) -> list:
    """From text, or from token arrays without frame and padding, to hashed TF-IDF."""
    if spec.encoded:
        terms = SQLTransformer(
            statement="SELECT *, slice(input_ids, 2, size(filter(attention_mask, m -> m = 1)) - 2)"
            " AS terms FROM __THIS__"
        )
    else:
        terms = RegexTokenizer(inputCol=spec.text, outputCol="terms", pattern=WORD_BREAK)
    counts = HashingTF(inputCol="terms", outputCol=TERM_COUNTS, numFeatures=num_features)
    return [terms, counts, IDF(inputCol=TERM_COUNTS, outputCol="features")]


def with_term_counts(df: DataFrame, spec: TextSpec, num_features: int = NUM_FEATURES) -> DataFrame:
    """The text, or the token arrays, replaced by their term counts."""
    counted = PipelineModel(feature_stages(spec, num_features)[:-1]).transform(df)
    inputs = ("input_ids", "attention_mask") if spec.encoded else (spec.text,)
    return counted.drop("terms", *inputs)


def with_label_id(df: DataFrame, spec: TextSpec) -> DataFrame:
    """Add the class id of the label; a label outside the classes fails the query."""
    classes = sorted(set(spec.classes))
    # The class list as metadata: a class without training rows still has its score.
    meta = {"ml_attr": {"type": "nominal", "name": LABEL_ID, "vals": classes}}
    label_id = labels.encode(F.col(spec.label_column), classes).cast("double")
    return df.withColumn(LABEL_ID, label_id.alias(LABEL_ID, metadata=meta))


def train(
    train_df: DataFrame,
    val_df: DataFrame,
    spec: TextSpec,
    candidates: Sequence[Mapping] = ({"maxIter": 20, "regParam": 0.01},),
    num_features: int = NUM_FEATURES,
    max_coefficients: int = MAX_COEFFICIENTS,
    counted: bool = False,
) -> Classifier:
    """Fit every candidate on the training rows; keep the lowest validation loss.

    ``max_coefficients`` bounds features times classes, eight bytes each on the driver and in
    every task.
    Terms are counted once, then held for the weights and all candidates (spilling to
    disk; a lost block is recomputed); rows that are ``counted`` (:func:`with_term_counts`) are read
    where they are stored. Rows stay on the executors: only gradients, which
    are bounded by features times classes, are summed to the driver.
    """
    check_coefficients(spec, num_features, max_coefficients)
    *counting, weights = feature_stages(spec, num_features)
    held, counts = [], []
    for df in (train_df, val_df):
        df = with_label_id(df if counted else with_term_counts(df, spec, num_features), spec)
        counts.append(df.select(TERM_COUNTS, LABEL_ID))
        if not counted:
            held.append(counts[-1].persist(StorageLevel.MEMORY_AND_DISK))
    best, best_loss, tried = None, float("inf"), []
    try:
        weighing = weights.fit(counts[0])
        train_ready, val_ready = (weighing.transform(c).select("features", LABEL_ID) for c in counts)
        for params in candidates:
            learner = LogisticRegression(
                featuresCol="features", labelCol=LABEL_ID, family="multinomial", **params
            )
            fitted = learner.fit(train_ready)
            scores = vector_to_array("probability").alias("scores")
            scored = fitted.transform(val_ready).select(LABEL_ID, scores)
            loss = evaluate.log_loss(scored, LABEL_ID).first()["avg_loss"]
            # Without validation rows there is no loss; the first candidate then stands.
            tried.append((dict(params), loss))
            if best is None or (loss is not None and loss < best_loss):
                best, best_loss = fitted, float("inf") if loss is None else loss
    finally:
        for df in held:
            df.unpersist()
    return Classifier(PipelineModel([*counting, weighing, best]), spec, tuple(tried))


def check_coefficients(spec: TextSpec, num_features: int, max_coefficients: int) -> None:
    wanted = num_features * len(set(spec.classes))
    if wanted > max_coefficients:
        raise ValueError(f"{wanted} coefficients are more than max_coefficients.")


def predict(classifier: Classifier, df: DataFrame, counted: bool = False) -> DataFrame:
    """Add ``scores``, ``prediction`` (class id) and ``predicted`` (class name).

    Rows that are ``counted`` have their term counts (:func:`with_term_counts`) in place of a text.
    """
    if isinstance(classifier.model, epochs.HashedLinear):
        scored = classifier.model.transform(df, classifier.spec)
    else:
        stages = classifier.model.stages[2:] if counted else classifier.model.stages
        scored = PipelineModel(stages).transform(df)
        scored = scored.withColumn("scores", vector_to_array("probability"))
        scored = scored.drop("terms", TERM_COUNTS, "features", "rawPrediction", "probability")
    return scored.withColumn("prediction", F.col("prediction").cast("int")).withColumn(
        "predicted", labels.decode(F.col("prediction"), classifier.spec.classes)
    )


def train_epochs(
    train_df: DataFrame,
    val_df: DataFrame,
    spec: TextSpec,
    settings: epochs.EpochSettings,
    state_path: str | None = None,
) -> Classifier:
    """Train by epochs (:mod:`shelfmark.plans.epochs`); ``validation`` has each epoch with its loss."""
    classes = sorted(set(spec.classes))
    label_id = labels.encode(F.col(spec.label_column), classes)
    found, tried = epochs.train(train_df, val_df, spec, label_id, len(classes), settings, state_path)
    return Classifier(found, spec, tuple((x, x["val_loss"]) for x in tried))


def save(classifier: Classifier, path: str) -> None:
    """Store the model and, beside it, how its text is made, vocabulary included.

    All goes to a new folder below ``path``; the note that names it is written last, and only
    then the folder that it named before is deleted. Saving a loaded model to its own path is
    no special case, and a failure leaves the old model as it was.
    """
    spark, spec = SparkSession.getActiveSession(), classifier.spec
    name = f"v-{uuid.uuid4().hex}"
    folder = f"{path}/{name}"
    if isinstance(classifier.model, epochs.HashedLinear):
        classifier.model.save(spark, f"{folder}/weights")
    else:
        classifier.model.write().save(f"{folder}/model")
    if spec.vocab_path:
        write_parquet(read_parquet(spark, spec.vocab_path), f"{folder}/vocab")
        spec = replace(spec, vocab_path=f"{folder}/vocab")
    write_note(spark, f"{folder}/spec", spec_to_json(spec))
    before = read_note(spark, f"{path}/current") if exists(spark, f"{path}/current") else None
    write_note(spark, f"{path}/current", name)
    if before:
        remove(spark, [f"{path}/{before}"])


def load(spark: SparkSession, path: str) -> Classifier:
    folder = f"{path}/{read_note(spark, f'{path}/current')}"
    spec = spec_from_json(read_note(spark, f"{folder}/spec"))
    if spec.vocab_path:
        spec = replace(spec, vocab_path=f"{folder}/vocab")
    if exists(spark, f"{folder}/weights"):
        return Classifier(epochs.HashedLinear.load(spark, f"{folder}/weights"), spec)
    return Classifier(PipelineModel.load(f"{folder}/model"), spec)
