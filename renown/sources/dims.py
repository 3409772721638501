"""Small reference tables: the entities we expect and what they are called."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.functions.names import canonical_key
from renown.model import TITLE_OVERRIDES


def entity_list(
    spark: SparkSession, names: Iterable[str], title_overrides: Mapping[str, str] = TITLE_OVERRIDES
) -> DataFrame:
    """A configured list of names as a table (seq, entity_name, title_override), as ``title_lookup`` takes it."""
    names = list(names)
    overrides = title_overrides
    return spark.createDataFrame(
        pa.table(
            {
                "seq": pa.array(range(len(names)), pa.int64()),
                "entity_name": pa.array(names, pa.string()),
                "title_override": pa.array([overrides.get(n) for n in names], pa.string()),
            }
        )
    )


def entity_dim(entities: DataFrame) -> DataFrame:
    """One row per name key: (entity_key, entity_name); the later ``seq`` wins a clash.

    Names without a Latin letter or digit have no key and are left out, so they
    match nothing and keep their own spelling.
    """
    return (
        entities.select("seq", "entity_name", canonical_key("entity_name").alias("entity_key"))
        .where(F.col("entity_key") != "")
        .groupBy("entity_key")
        .agg(F.max_by("entity_name", "seq").alias("entity_name"))
    )
