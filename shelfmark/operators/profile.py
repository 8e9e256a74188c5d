"""Counts and word-count distributions per category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import word_count


def summary(df: DataFrame, category: str) -> DataFrame:
    """One row: number of rows and of distinct categories, null being a category."""
    counts = df.groupBy(category).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_categories"),
    )


def category_counts(df: DataFrame, category: str) -> DataFrame:
    """Rows per category, sorted by category, null first."""
    return df.groupBy(category).agg(F.count("*").alias("count")).orderBy(category)


def with_word_count(
    df: DataFrame, text: str, out: str = "num_words", strict: bool = False
) -> DataFrame:
    """Add the number of words of a text or list column."""
    return df.withColumn(out, word_count(F.col(text), df.schema[text].dataType, strict))


def words_per_category(
    df: DataFrame, category: str, text: str, strict: bool = False
) -> DataFrame:
    """All word counts of each category, as ``(category, num_words, n_rows)``.

    The multiset is complete but run-length coded: its size is the number of distinct
    word counts, not of rows, and it is combined before the shuffle, so a category that
    holds most rows is no heavier than another.
    """
    counted = with_word_count(df, text, strict=strict)
    return counted.groupBy(category, "num_words").agg(F.count("*").alias("n_rows"))


def avg_words(df: DataFrame, category: str, text: str, strict: bool = False) -> DataFrame:
    """Mean word count per category; rows without text count 0."""
    counted = with_word_count(df, text, strict=strict)
    return counted.groupBy(category).agg(F.avg("num_words").alias("average_num_words"))


def box_stats(df: DataFrame, category: str, text: str, strict: bool = False) -> DataFrame:
    """Box-plot figures of the word counts per category.

    Exact quartiles (linear interpolation), whiskers at the outermost values within 1.5
    interquartile ranges of the box, number of rows beyond them. Works on the histogram
    of :func:`words_per_category`, so the rows are shuffled only as its counts.
    """
    return box_stats_of(words_per_category(df, category, text, strict), category)


def box_stats_of(histogram: DataFrame, category: str) -> DataFrame:
    """:func:`box_stats` from ``(category, num_words, n_rows)``."""
    per_category = Window.partitionBy(category)
    shares = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = F.percentile(F.col("num_words"), shares, F.col("n_rows"))
    boxed = histogram.withColumn("q", quartiles.over(per_category)).select(
        category,
        "num_words",
        "n_rows",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    within = F.col("num_words").between(F.col("q1") - reach, F.col("q3") + reach)
    inside = F.when(within, F.col("num_words"))
    # A whisker never ends inside the box.
    low = F.least(F.min(inside).over(per_category), F.col("q1"))
    high = F.greatest(F.max(inside).over(per_category), F.col("q3"))
    whiskered = boxed.select("*", low.alias("whisker_low"), high.alias("whisker_high"))
    outside = ~F.col("num_words").between(F.col("whisker_low"), F.col("whisker_high"))
    per_box = [category, "q1", "median", "q3", "whisker_low", "whisker_high"]
    return whiskered.groupBy(*per_box).agg(
        F.sum("n_rows").alias("n_rows"),
        F.coalesce(F.sum(F.when(outside, F.col("n_rows"))), F.lit(0)).alias("n_outliers"),
        F.min("num_words").alias("min_words"),
        F.max("num_words").alias("max_words"),
        (F.sum(F.col("num_words") * F.col("n_rows")) / F.sum("n_rows")).alias("mean_words"),
    )


def summary_of(histogram: DataFrame, category: str) -> DataFrame:
    """:func:`summary` from ``(category, num_words, n_rows)``."""
    per_category = histogram.groupBy(category).agg(F.sum("n_rows").alias("n"))
    return per_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_categories"),
    )


def category_counts_of(histogram: DataFrame, category: str) -> DataFrame:
    """:func:`category_counts` from ``(category, num_words, n_rows)``."""
    return histogram.groupBy(category).agg(F.sum("n_rows").alias("count")).orderBy(category)


def avg_words_of(histogram: DataFrame, category: str) -> DataFrame:
    """:func:`avg_words` from ``(category, num_words, n_rows)``."""
    mean = F.sum(F.col("num_words") * F.col("n_rows")) / F.sum("n_rows")
    return histogram.groupBy(category).agg(mean.alias("average_num_words"))
