"""Named queries over the given tables and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from reviewmill.catalog.views import Views

MODULES = ("corpus", "mining", "tenancy", "kpi", "evaluation", "io", "modelling", "streams", "bundles")


def _load(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"reviewmill.catalog.{name}"), attribute)
        clash = merged.keys() & part.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        merged.update(part)
    return merged


def _bind(build: Callable[[Views], DataFrame], partitions: int | None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Views(spark, sf_dir, partitions))

    run.__doc__ = build.__doc__
    return run


def all_queries(partitions: int | None = None) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query; ``partitions`` as in ``Views``."""
    return {name: _bind(build, partitions) for name, build in _load("QUERIES").items()}


def all_oracles() -> dict[str, str]:
    return _load("ORACLES")
