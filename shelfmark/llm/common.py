"""Helpers that the corpus operators share: row keys, Arrow stages, tables in the shared folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import scratch_path

#: Code points 0x09-0x0D and 0x20, which separate words in the operators on blank-separated words.
BLANKS = "\t\n\x0b\x0c\r "

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id`` and ``text`` (null: empty) and nothing else, so that no name can clash."""
    return df.select(
        df[id_col].alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text")
    )


def row_key(doc_id: Column | str = "doc_id", text: Column | str = "text") -> Column:
    """A key that tells rows apart by id and content, null ids included.

    Rows with the same id and text share it: whatever is computed for one holds for the other.
    """
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.col(text) if isinstance(text, str) else text
    shown = doc_id.cast("string")
    # The id's length comes first, so that ids and texts can't run into each other; no id has none.
    known = F.coalesce(F.concat(F.length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))
    return F.unhex(F.substring(F.sha2(F.concat(known, F.lit(":"), text), 256), 1, 32))


def ascii_lower(text: Column | str) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def give_back() -> None:
    """Return freed memory to the system.

    Spark keeps idle Python workers; what their allocators hold would count against the executor
    while other stages run.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame, stage: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` that gives the worker's memory back at a task's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from stage(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


#: Rows of an Arrow batch while a table is stored. Texts of some kB each make batches of some MB,
#: held once by the JVM and once or twice by a Python worker.
STORE_BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Workspace:
    """Intermediate tables in the shared folder; they cut lineage and survive lost executors.

    ``clear`` deletes them. A lazy result that reads them must be written before that.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def path(self, name: str) -> str:
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path, before = self.path(name), self.spark.conf.get(_BATCH_CONF)
        self.spark.conf.set(_BATCH_CONF, STORE_BATCH_ROWS)
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(_BATCH_CONF, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
        self.paths = []
