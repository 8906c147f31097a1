"""Score what has arrived since the last run, each row once.

A saved pipeline and model are row-wise expressions, so they apply to a stream as to a table. The
checkpoint folder remembers which files were scored; with the default trigger a run takes up all
new ones, in bounded batches, and ends. A driver or executor lost in between repeats a batch, and the file sink's
log makes its rows count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.scoring import score
from tabloom.sinks.predictions import drop_vectors
from tabloom.sources.fitted import load_model, load_pipeline


def arriving(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", files_per_batch: int = 1000, **options) -> DataFrame:
    """Files under ``path`` as a stream; ``options`` are those of the format, such as ``header`` and ``sep``."""
    reader = spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.options(**options).load(path)


def score_arriving(
    stream: DataFrame, pipeline_path: str, kind: str, model_path: str, output_path: str, checkpoint_path: str, once: bool = True, **trigger
) -> StreamingQuery:
    """Score ``stream`` with a saved pipeline and model and append the result as Parquet, without vectors.

    Returns the running query: with ``once`` it ends when everything that is there has been scored,
    otherwise it follows ``trigger`` (``processingTime="1 minute"``, say) until it is stopped. The
    target column may be absent. Pipelines with categories indexed by a join are for tables only."""
    scored = score(stream, load_pipeline(pipeline_path), load_model(kind, model_path))
    writer = drop_vectors(scored).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint_path).option("path", output_path)
    return writer.trigger(availableNow=True).start() if once else writer.trigger(**trigger).start()
