"""Prediction output."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame


def drop_vectors(df: DataFrame, index_prefix: str | None = None) -> DataFrame:
    """Drop every vector column, found by type, and optionally the category indexes by prefix."""
    vectors = [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]
    indexes = [c for c in df.columns if index_prefix and c.startswith(index_prefix)]
    return df.drop(*vectors, *indexes)


def write_predictions(
    df: DataFrame, path: str, file_format: str = "csv", single_file: bool = False, index_prefix: str | None = "idx_"
) -> None:
    """Write predictions without their vector columns, replacing what is there.

    Every task writes its own file. ``single_file`` funnels all rows through one task and is for
    small results that someone opens by hand.
    """
    flat = drop_vectors(df, index_prefix)
    if single_file:
        flat = flat.coalesce(1)
    writer = flat.write.mode("overwrite").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
