"""Corpus preparation: stages over ``documents``, each written as Parquet and read by the next.

Each stage takes and returns the columns of ``documents``, whatever else the table has beside
``doc_id, text, lang``; the last returns tokens. Rows are told apart by id and text, so null ids
and repeated ids are no special case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import byte_bpe, language_crf, simhash, suffix_dedup, tiling
from shelfmark.llm.common import Workspace, fresh_name, row_key
from shelfmark.llm.queries import rank_file, table

#: Pieces that the tokenizing workers remember and characters that they hold, fewer than alone:
#: executors that ran the stages before have less memory to spare.
MEMO_PIECES = 100_000
BLOCK_CHARS = 1_000_000


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    name = fresh_name(docs, "row_key")
    return docs.withColumn(name, row_key(docs["doc_id"], F.coalesce(docs["text"], F.lit("")))), name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go; those of several stay.

    A null text and one without a letter have no language; nor has any where nothing could be learned. An empty
    table stays empty.
    """
    predict = language_crf.predict_column(docs, language_crf.train_on(docs))
    name = fresh_name(docs, "prediction")
    known = F.col(name)["lang_pred"] != language_crf.UNKNOWN
    return docs.withColumn(name, predict(docs["text"])).filter(known).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of close fingerprints, the document with the smallest id stays.

    Null ids come last; of rows with one id, one is chosen by a digest of id and text; of rows equal in both, one
    stays. Texts without words are one component. An empty table stays empty.
    """
    found = simhash.near_duplicates(docs)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
    kept = first.select(F.col("first.key").alias("kept_key"))
    keyed, name = _keyed(docs)
    stays = keyed.join(kept, keyed[name] == kept["kept_key"], "left_semi")
    return stays.dropDuplicates([name]).drop(name)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the byte strings that also start earlier; ``n_chars`` follows the text.

    No row goes; a null text stays null. Bytes of a character that is cut through go with it.
    """
    cut = suffix_dedup.deduplicate(docs)
    name = cut.columns[-1]
    cut = cut.withColumn("text", F.when(F.col("text").isNotNull(), suffix_dedup.as_text(F.col(name)["kept"])))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.length("text").cast(kind))
    return cut.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, all rows of the same id and text alike.

    Without benchmark items, and for null texts, nothing goes.
    """
    found = tiling.contaminated(docs, table(spark, sf_dir, "benchmark")).select("key").distinct()
    keyed, name = _keyed(docs)
    return keyed.join(found, keyed[name] == found["key"], "left_anti").drop(name)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, their digest, and that of the bytes they decode to.

    A row per row, null and empty texts with no ids.
    """
    return byte_bpe.encode(
        docs,
        rank_file(),
        keep_decoded=False,
        memo_pieces=MEMO_PIECES,
        block_chars=BLOCK_CHARS,
        keep_coder=False,
    )


STAGES = [
    ("language identification", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("repeated strings", remove_repeats),
    ("benchmark decontamination", decontaminate),
    ("byte-level tokens", tokenize),
]

#: Labels of a trained field decide the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    workspace, docs = Workspace(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = workspace.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
