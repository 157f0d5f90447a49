"""Connectors, in the order in which `all` runs them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from papyrine.sources.readers import EpoSource, GooglePatentsSource, PubmedSource, UsptoSource

REGISTRY = {s.name(): s for s in (PubmedSource, GooglePatentsSource, UsptoSource, EpoSource)}


def register(spark: SparkSession) -> None:
    """Make the connectors known to spark.read.format()."""
    for source in REGISTRY.values():
        spark.dataSource.register(source)
