"""Every query of the engine by name: (spark, sf_dir) -> DataFrame, and the DuckDB statement that gives the same rows."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from .registry import QUERIES, SQL

for _name in ("q_vectors", "q_matching", "q_exposure", "q_scoring", "q_stats", "q_agreement", "q_pairwise", "q_sources", "q_files"):
    import_module(f"{__package__}.{_name}")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["flagship_district_exposure"](spark, sf_dir)


__all__ = ["QUERIES", "SQL", "flagship"]
