"""Classification metrics as tables. Only the label/prediction counts are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    normalize: bool = False,
) -> DataFrame:
    """Confusion counts in long form ``(*by, label, prediction, n)``.

    ``normalize`` adds ``share``, the part of the actual class that got this prediction.
    """
    counts = df.groupBy(*by, label, prediction).agg(F.count("*").alias("n"))
    return with_share(counts, label, by) if normalize else counts


def with_share(counts: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Add the ``share`` of each count in its actual class."""
    # The window sees the counts only, one row per pair of classes.
    total = F.sum("n").over(Window.partitionBy(*by, label))
    return counts.withColumn("share", F.col("n") / total)


def confusion_wide(
    df: DataFrame,
    n_classes: int,
    label: str = "label",
    prediction: str = "prediction",
    percent: bool = False,
) -> DataFrame:
    """Confusion matrix: one row per actual class, one column ``p<id>`` per predicted one.

    Every class has its row and its column, also without any record. ``percent`` gives
    row percentages instead of counts. A label or prediction that is null or no class fails
    the query.
    """
    spark = df.sparkSession
    classes = spark.range(n_classes).select(F.col("id").cast("int").alias("_class"))
    counts = confusion(df, label, prediction).select(
        _class_id(label, n_classes).alias(label),
        _class_id(prediction, n_classes).alias("_prediction"),
        "n",
    )
    pivoted = counts.groupBy(label).pivot("_prediction", list(range(n_classes))).agg(F.sum("n"))
    names = [str(i) for i in range(n_classes)]
    total = sum((F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in names), F.lit(0))
    rows = classes.join(pivoted, F.col("_class") == F.col(label), "left")
    cells = []
    for name in names:
        cell = F.coalesce(F.col(f"`{name}`"), F.lit(0))
        if percent:
            cell = F.coalesce(F.try_divide(cell * 100.0, total), F.lit(0.0))
        cells.append(cell.alias(f"p{name}"))
    return rows.select(F.col("_class").alias(label), *cells)


def _class_id(column: str, n_classes: int) -> Column:
    """The id as it is, if it is one of the classes."""
    value = F.col(column)
    shown = F.coalesce(value.cast("string"), F.lit("null"))
    error = F.raise_error(F.concat(F.lit(f"{column} is none of {n_classes} classes: "), shown))
    return F.when(value.between(0, n_classes - 1), value).otherwise(error.cast("int"))


def metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, one row per ``by`` group.

    Classes are those among the labels or the predictions; an undefined ratio is 0.
    """
    return metrics_of_counts(confusion(df, label, prediction, by), label, prediction, by)


def metrics_of_counts(
    counts: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """:func:`metrics` from the counts ``n`` that :func:`confusion` gives.

    Where the counts also carry a ``loss``, its mean is the column ``avg_loss``.
    """
    hits = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(F.lit(0))
    actual = {"support": F.col("n"), "predicted": F.lit(0).cast("bigint"), "hits": hits}
    predicted = {**dict.fromkeys(actual, F.lit(0).cast("bigint")), "predicted": F.col("n")}
    if "loss" in counts.columns:
        actual["loss"], predicted["loss"] = F.col("loss"), F.lit(0.0)

    def role(column: str, values: dict[str, Column]) -> Column:
        named = [value.alias(name) for name, value in values.items()]
        return F.struct(F.col(column).alias("class"), *named)

    # Each count is read twice, as support of its label and as size of its prediction.
    both = F.inline(F.array(role(label, actual), role(prediction, predicted)))
    per_class = (
        counts.select(*by, both)
        .groupBy(*by, "class")
        .agg(*[F.sum(name).alias(name) for name in actual])
    )
    total, support = F.sum("support"), F.col("support")

    def weighted(numerator: Column, denominator: Column) -> Column:
        ratio = F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))
        return F.sum(ratio * support) / total

    aggregates = [
        total.alias("n_rows"),
        (F.sum("hits") / total).alias("accuracy"),
        weighted(2.0 * F.col("hits"), support + F.col("predicted")).alias("f1_score"),
        weighted(F.col("hits"), F.col("predicted")).alias("precision"),
        weighted(F.col("hits"), support).alias("recall"),
    ]
    if "loss" in actual:
        aggregates.append((F.sum("loss") / total).alias("avg_loss"))
    return per_class.groupBy(*by).agg(*aggregates)


def _row_loss(label: str, scores: str) -> Column:
    true_score = F.get(F.col(scores), F.col(label).cast("int"))
    shown = F.coalesce(F.col(label).cast("string"), F.lit("null"))
    error = F.raise_error(F.concat(F.lit("No score for label "), shown)).cast("double")
    loss = -F.ln(F.greatest(true_score, F.lit(1e-15)))
    return F.when(true_score.isNotNull(), loss).otherwise(error)


def log_loss(
    df: DataFrame, label: str = "label", scores: str = "scores", by: Sequence[str] = ()
) -> DataFrame:
    """Mean negative log probability of the true class over the rows.

    A row whose label is null or has no score fails the query.
    """
    return df.groupBy(*by).agg(F.avg(_row_loss(label, scores)).alias("avg_loss"))


def by_split(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    scores: str = "scores",
    split: str = "split",
) -> DataFrame:
    """Loss and metrics of every split, in one pass over the scored rows."""
    counts = scored_counts(df, label, prediction, scores, split)
    return metrics_of_counts(counts, label, prediction, [split])


def scored_counts(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    scores: str = "scores",
    split: str = "split",
) -> DataFrame:
    """Rows ``n`` and summed ``loss`` per split, label and prediction.

    A few rows, from which metrics, confusion and row counts all derive.
    """
    return df.groupBy(split, label, prediction).agg(
        F.count("*").alias("n"), F.sum(_row_loss(label, scores)).alias("loss")
    )
