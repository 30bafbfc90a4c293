"""Micro-batch scoring of arriving transactions.

The re-aimed form of a request/response model service: new transaction
files land in a folder, a Structured Streaming query scores each micro-batch
with the frozen regressor and classifier (the same stateless ``transform``
as batch scoring) and appends the scores to a Parquet sink.  No server and
no state store: the stream is stateless, so the checkpoint only records
which files were processed (exactly-once with the file sink).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from domus.operators.models import score_batch


def score_stream(spark: SparkSession, source_dir: str, schema: StructType | str, reg_features: list[str],
                 regressor, cls_features: list[str], classifier, sink_dir: str, checkpoint_dir: str,
                 keep: list[str] | None = None, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the scoring stream.  ``available_now`` processes what is there
    and stops (batch-like runs); otherwise it keeps running."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(source_dir)
    scored = score_batch(rows, reg_features, regressor, cls_features, classifier)
    if keep:
        scored = scored.select(*keep, "predicted_price", "predicted_class", "probability_below_market")
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
