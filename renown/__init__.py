"""Entity reach analytics on Spark: DataFrame in, DataFrame out."""

from renown.model import FACT_COLUMNS, FACT_SCHEMA, Metric, SourceSpec

__all__ = ["FACT_COLUMNS", "FACT_SCHEMA", "Metric", "SourceSpec"]
