"""Stored documents as a stream (an extension: a new part file is a new batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from papyrine.schema import DOCUMENT, with_defaults
from papyrine.storage import TIMESTAMP


def stream_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the part files that are there and of those that come."""
    return with_defaults(spark.readStream.schema(DOCUMENT).option("timestampFormat", TIMESTAMP).json(path))
