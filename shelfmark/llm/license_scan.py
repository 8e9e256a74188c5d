"""Licence scan by diagonal voting (operator 3).

Every rolling three-word gram of every document is joined, by hash and then by its words, to the
positions of the licence templates. Matches vote for the diagonal (document position minus
template position); neighbouring diagonals of a template merge, which bridges a few inserted or
lost words, and a merged span counts if it covers enough of the template within a bounded length.

Words are runs of digits, of a-z after lower-casing A-Z, and of characters beyond ASCII. A phrase
counts at every place where its words stand consecutively. Templates are a fixed list of a few
hundred words, so their grams are broadcast, and a bit table of their hashes keeps grams without
any partner out of the join.

Defined results: a null or empty text has no words, no places and score 0; null ids and repeated
rows give one result row per input row; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import Workspace
from shelfmark.llm.rolling import exploded, hash_table, rolling_grams

GRAM = 3
#: Share of a template's words that a merged span must cover, and how far diagonals may lie apart.
MIN_COVERAGE = 0.8
SLACK = 4


@dataclass(frozen=True)
class Template:
    """Words of a licence and its label; the places of a ``phrase`` must match word by word."""

    label: str
    text: str
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", self.text.lower())


#: Phrases and their labels.
PHRASES = (
    Template("mit", "under the mit license", phrase=True),
    Template("apache-2", "apache license version 2", phrase=True),
    Template("cc-by-nc", "cc by nc", phrase=True),
)

#: Sentences of public licence texts and notices.
NOTICES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ),
    Template("gpl-3", "licensed under the GNU General Public License, version 3", phrase=True),
    Template(
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    Template("all-rights-reserved", "All rights reserved", phrase=True),
)


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """``template, at, template_hash, template_gram`` of every gram of every template."""
    short = [t.text for t in templates if len(t.words) < GRAM]
    if short:
        raise ValueError(f"A template needs {GRAM} words or more: {short[0]!r}")
    rows = spark.createDataFrame(
        [(n, t.text) for n, t in enumerate(templates)], "template int, text string"
    )
    return exploded(rolling_grams(rows, GRAM, id_col="template")).select(
        F.col("doc_id").alias("template"),
        F.col("position").alias("at"),
        F.col("hash").alias("template_hash"),
        F.col("gram").alias("template_gram"),
    )


def matches(rolled: DataFrame, fixed: DataFrame) -> DataFrame:
    """``key, template, at, position`` for every gram that documents and templates share."""
    same = (F.col("hash") == F.col("template_hash")) & (F.col("gram") == F.col("template_gram"))
    joined = exploded(rolled).join(F.broadcast(fixed), same)
    return joined.select("key", "template", "at", "position").distinct()


def spans(
    found: DataFrame,
    templates: Sequence[Template],
    min_coverage: float = MIN_COVERAGE,
    slack: int = SLACK,
) -> DataFrame:
    """``key, template, first_word, last_word, coverage`` of the verified spans.

    ``last_word`` is the span's last word. For a phrase, every diagonal with all votes is a span.
    """
    spark = found.sparkSession
    facts = F.broadcast(
        spark.createDataFrame(
            [(n, len(t.words), t.phrase) for n, t in enumerate(templates)],
            "template int, length int, phrase boolean",
        )
    )
    votes = (
        found.withColumn("diagonal", F.col("position") - F.col("at"))
        .groupBy("key", "template", "diagonal")
        .agg(F.collect_list("at").alias("at"))
        .join(facts, "template")
    )
    line = Window.partitionBy("key", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(line)
    starts = F.when(F.col("phrase") | F.coalesce(step > slack, F.lit(True)), 1).otherwise(0)
    merged = (
        votes.withColumn("starts", starts)
        .withColumn("cluster", F.sum("starts").over(line))
        .groupBy("key", "template", "cluster", "length", "phrase")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
            F.min(F.col("diagonal") + F.array_min("at")).alias("first_word"),
            F.max(F.col("diagonal") + F.array_max("at") + GRAM - 1).alias("last_word"),
        )
    )
    covered = F.size(
        F.array_distinct(
            F.flatten(F.transform("at", lambda a: F.sequence(a, a + GRAM - 1)))
        )
    )
    merged = merged.withColumn("coverage", covered / F.col("length"))
    extent = F.col("last_word") - F.col("first_word") + 1
    loose = (F.col("coverage") >= min_coverage) & (extent <= F.col("length") * 2)
    whole = F.col("coverage") >= 1
    return merged.filter(F.when(F.col("phrase"), whole).otherwise(loose)).select(
        "key", "template", "first_word", "last_word", "coverage"
    )


def scan(
    df: DataFrame,
    phrases: Sequence[Template] = PHRASES,
    notices: Sequence[Template] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """Per input row: ``doc_id, n_words``, places of the phrases, labels of both lists, score.

    ``first_word`` and ``last_word`` are the smallest and largest start of a phrase (null without
    one). The score is the best coverage of a verified span, 0 without one.
    """
    spark = df.sparkSession
    workspace = workspace or Workspace(spark)
    templates = [*phrases, *notices]
    fixed = template_grams(spark, templates)
    table = hash_table(np.array([r[0] for r in fixed.select("template_hash").collect()], np.int64))
    rolled = workspace.store(
        rolling_grams(df, GRAM, table, id_col, text_col), "licence-grams"
    )
    names = F.array(*[F.lit(t.label) for t in templates])
    base = F.col("template") < len(phrases)
    label = F.get(names, F.col("template"))
    per_doc = (
        spans(matches(rolled, fixed), templates)
        .groupBy(F.col("key").alias("found"))
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(F.when(base, label))), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.collect_set(label)), ",").alias("labels"),
            F.count("*").alias("n_spans"),
            F.max("coverage").alias("score"),
        )
    )
    joined = rolled.select("doc_id", "key", "n_words").join(per_doc, F.col("key") == F.col("found"), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", zero).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
