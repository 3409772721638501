"""Tag lists to the joined text of the fact table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from renown.functions.variants import is_object, items, text

SEPARATOR = ", "
#: Length of a short tag list, for those who ask for one; lists are whole by default.
SHORT_LIST = 5


def join_or_null(tags: Column) -> Column:
    """Joined text, null for an empty or missing list."""
    return F.when(F.array_size(tags) > 0, F.array_join(tags, SEPARATOR))


def first_of(listed: Column, most: int | None) -> Column:
    """The first items of a list, all of them without a limit."""
    return listed if most is None else F.slice(listed, 1, most)


def first_names(listed: Column, most: int | None = None) -> Column:
    """Non-blank names among the first tags of a list, blanks dropped after the cut.

    Elements are plain text or objects with a ``name``.
    """
    names = F.transform(
        first_of(listed, most),
        lambda item: F.when(is_object(item), text(item, "$.name")).otherwise(text(item)),
    )
    return F.filter(names, lambda name: F.coalesce(name, F.lit("")) != "")


def tags_or_text(value: Column, listed: Column, names: Column) -> Column:
    """Joined names of a list; a value that is no list stands as text, blank as null."""
    as_text = F.nullif(text(value), F.lit(""))
    return F.when(listed.isNull(), as_text).otherwise(join_or_null(names))


def distinct_tags(*values: Column) -> Column:
    """All non-blank values, lists flattened, first mention kept."""
    parts = [
        F.coalesce(F.transform(items(value), lambda item: text(item)), F.array(text(value)))
        for value in values
    ]
    kept = F.filter(F.flatten(F.array(*parts)), lambda tag: F.coalesce(tag, F.lit("")) != "")
    return join_or_null(F.array_distinct(kept))
