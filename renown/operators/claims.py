"""Claim ids out of nested JSON, and their labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.functions.variants import items, text

#: Where a label lies below its id, and where ids lie in a response.
LABEL_PATH, ENTITIES = "$.labels.en.value", "$.entities"

GENRE_PROPERTY = "P136"


def claim_ids(entity: Column, property_id: str = GENRE_PROPERTY) -> Column:
    """Ids claimed for a property, in order, blanks dropped; ``entity`` is VARIANT."""
    ids = F.transform(
        items(entity, f"$.claims.{property_id}"),
        lambda claim: text(claim, "$.mainsnak.datavalue.value.id"),
    )
    named = F.filter(ids, lambda claimed: F.coalesce(claimed, F.lit("")) != "")
    return F.coalesce(named, F.array().cast("array<string>"))


def ordered_labels(
    records: DataFrame, labels: DataFrame, key: str, ids: str = "ids", max_ids: int | None = None
) -> DataFrame:
    """(key, labels): the labels of each record's ids in the order of the ids.

    With ``max_ids`` only the first ids of a record are looked up. Ids without a label drop out
    and a record without any label gives no row. ``key`` is unique, so a group
    is never longer than the id list of one record. ``labels`` has one row per
    ``id``; an id many records share is split by the adaptive skew join.
    """
    listed = F.col(ids)
    wanted = listed
    if max_ids is not None:
        looked_up = F.slice(listed, 1, max_ids)
        wanted = F.transform(listed, lambda one: F.when(F.array_contains(looked_up, one), one))
    positions = records.select(key, F.posexplode(wanted).alias("position", "id")).where(
        F.col("id").isNotNull()
    )
    found = positions.join(labels.where(F.col("label") != ""), "id")
    return (
        found.groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("position", "label"))).alias("pairs"))
        .select(key, F.col("pairs.label").alias("labels"))
    )


def nested_labels(
    response: Column, ids: Column, max_ids: int | None = None, path: str = LABEL_PATH
) -> Column:
    """Labels of ids out of the response that answers for them, in the order of the ids.

    ``response`` is VARIANT with a map from id to record under ``entities``. The map becomes a column
    and every id is looked up in its own row, so nothing is joined or shuffled. Ids the map lacks, records
    without a label and blank labels drop out; a response without such a map gives an empty list.

    The map is the one item of a list that is transformed: a lambda's variable is worked out once per row,
    whatever it refers to outside itself once per id, down to the parse of the response.
    """
    wanted = ids if max_ids is None else F.slice(ids, 1, max_ids)
    entities = F.array(F.try_variant_get(response, ENTITIES, "map<string,variant>"))
    labels = F.transform(
        entities, lambda known: F.transform(wanted, lambda one: text(F.element_at(known, one), path))
    )[0]
    found = F.filter(labels, lambda label: F.coalesce(label, F.lit("")) != "")
    return F.coalesce(found, F.array().cast("array<string>"))


def exploded_labels(responses: DataFrame, response: str = "response", path: str = LABEL_PATH) -> DataFrame:
    """(id, label) of every id that any of the responses answers for, one row per id.

    For responses that lie apart from the records; feed it to ``ordered_labels``. Of several labels of
    one id the first in text order counts. An id in most of the responses collapses before the shuffle.
    """
    entities = F.try_variant_get(response, ENTITIES, "map<string,variant>")
    return (
        responses.select(F.explode(entities).alias("id", "entity"))
        .select("id", text(F.col("entity"), path).alias("label"))
        .where(F.coalesce("label", F.lit("")) != "")
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
