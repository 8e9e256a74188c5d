"""Score records as files arrive, with the same plan as the batch job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.plans import jobs, model
from shelfmark.session import remove
from shelfmark.sources.readers import jsonl_schema
from shelfmark.sources.writers import write_parquet


def read_record_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, file_format: str = "json"
) -> DataFrame:
    """Stream of records from a folder of JSON-lines or Parquet files."""
    if file_format == "json":
        schema = jsonl_schema(schema)
    return spark.readStream.schema(schema).format(file_format).load(path)


def score_stream(
    spark: SparkSession,
    model_path: str,
    records: DataFrame,
    out_path: str,
    checkpoint_path: str,
    columns: Sequence[str] = ("prediction", "predicted"),
    **trigger,
) -> StreamingQuery:
    """Append predictions as Parquet files, each record once.

    Scoring is stateless, so the stream needs no watermark. The default trigger handles
    what is there and stops.

    A model whose vocabulary is joined scores batch by batch, each into a folder named by its number,
    ``batch=n``: a batch that is repeated after a failure replaces what it had written.
    """
    classifier = model.load(spark, model_path)
    if not jobs.joins_vocabulary(classifier):
        return _append(jobs.score(classifier, records).select(*columns), out_path, checkpoint_path, trigger)

    def write(batch: DataFrame, number: int) -> None:
        scratch: list[str] = []
        try:
            scored = jobs.score(classifier, batch, scratch=scratch)
            write_parquet(scored.select(*columns), f"{out_path}/batch={number}")
        finally:
            remove(batch.sparkSession, scratch)

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def reject_stream(
    spark: SparkSession,
    model_path: str,
    records: DataFrame,
    out_path: str,
    checkpoint_path: str,
    **trigger,
) -> StreamingQuery:
    """Append the records that :func:`score_stream` does not score, each with its reason."""
    rejected = jobs.rejected_records(spark, model_path, records)
    return _append(rejected, out_path, checkpoint_path, trigger)


def _append(df: DataFrame, out_path: str, checkpoint_path: str, trigger: dict) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint_path)
    chosen = trigger or {"availableNow": True}
    return writer.outputMode("append").trigger(**chosen).start(out_path)
