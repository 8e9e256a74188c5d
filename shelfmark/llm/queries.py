"""The operators' registered queries: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    byte_bpe,
    html_crf,
    impact_search,
    language_crf,
    license_scan,
    ppm,
    quality_rules,
    rtree_negatives,
    simhash,
    suffix_dedup,
    tiling,
    token_cache,
    version_sketch,
)
from shelfmark.llm.common import Workspace
from shelfmark.sources.readers import read_parquet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return quality_rules.store_ledger(entries, Workspace(spark))


@query
def op1_quality_rules(spark, sf_dir):
    """The rule ledger of all documents with the verdict of the full policy."""
    base = F.lit(quality_rules.BASE.mask())
    verdict = quality_rules.apply_policy(_ledger(spark, sf_dir), quality_rules.FULL)
    return verdict.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failures").bitwiseAND(base) != 0).alias("base_failed"),
        "kept",
        "failures",
        "policy",
    )


@query
def quality_ablations(spark, sf_dir):
    """What each rule of two policies costs, from the stored bits."""
    policies = (quality_rules.BASE, quality_rules.FULL)
    return quality_rules.ablations(_ledger(spark, sf_dir), policies)


#: Tokens beyond which a document is over the limit.
TOKEN_LIMIT = 2048


@query
def op2_token_counts(spark, sf_dir):
    """Tokens of all documents by the word-level BPE; what an earlier run has counted is not encoded."""
    tokenizer = token_cache.TokenizerFile(
        public_tokenizers.path("word_bpe_49k.json"), by_word=True
    )
    cache = token_cache.cache_path(spark, tokenizer)
    counts = token_cache.token_counts(table(spark, sf_dir, "documents"), tokenizer, cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op3_license_scan(spark, sf_dir):
    """Licence phrases and notices in all documents."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op4_main_text(spark, sf_dir):
    """Main text of all pages."""
    found = html_crf.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op5_language_id(spark, sf_dir):
    """Languages of all documents, learnt from the labels of those that aren't held out."""
    return language_crf.identify(table(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark, sf_dir):
    """What is left of all documents without byte strings that also start earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.deduplicate(docs, keep=False)
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return found.select("doc_id", *[f"dedup.{c}" for c in columns])


@query
def op7_simhash(spark, sf_dir):
    """Near-duplicate components of all documents' fingerprints."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("bits").alias("fingerprint"), "component_id")


def rank_file() -> byte_bpe.RankFile:
    return byte_bpe.RankFile(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query
def op8_byte_bpe(spark, sf_dir):
    """Digests of all documents' ids and of what they decode to."""
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.encode(docs, rank_file(), keep_ids=False, keep_decoded=False)


#: Bytes of the longest context of the language model.
LM_ORDER = 5


@query
def op9_lm_scores(spark, sf_dir):
    """Word and byte-context scores of all documents."""
    return ppm.score(table(spark, sf_dir, "documents"), order=LM_ORDER)


@query
def op10_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item, with the share of the item that tiles cover."""
    found = tiling.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("key")


@query
def op11_lexical_search(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    lists, found = Workspace(spark), Workspace(spark)
    index = impact_search.build_index(table(spark, sf_dir, "documents"), lists)
    best = impact_search.search(index, table(spark, sf_dir, "benchmark"), found)
    lists.clear()
    return best


@query
def op12_hard_negatives(spark, sf_dir):
    """Ten hard negatives for each of five positives of every hundredth vector."""
    rows = rtree_negatives.vectors(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return rtree_negatives.mine(rows, rows.filter(F.col("vec_id") % 100 == 0), Workspace(spark))


@query
def op13_fingerprints(spark, sf_dir):
    """Sketches of all documents, against their edited text and the next document."""
    return version_sketch.fingerprints(table(spark, sf_dir, "documents"), Workspace(spark))
