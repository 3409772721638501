"""Reading loosely typed JSON fields.

A raw field can be absent, an explicit JSON null, a number, a numeral in quotes
or something else entirely, and these cases differ in meaning. VARIANT columns
keep them apart: SQL NULL is "absent", a variant null is an explicit null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(value: Column, path: str = "$") -> Column:
    """The field as text; null when absent or null."""
    return F.try_variant_get(value, path, "string")


def whole(value: Column, path: str = "$") -> Column:
    """The field as BIGINT: numbers truncate, numerals in quotes must be whole."""
    return F.try_variant_get(value, path, "bigint")


def member(value: Column, path: str) -> Column:
    """A nested field, still as VARIANT."""
    return F.try_variant_get(value, path, "variant")


def items(value: Column, path: str = "$") -> Column:
    """The elements of an array; null when the field is no array."""
    return F.try_variant_get(value, path, "array<variant>")


def records(value: Column, fields: str, path: str = "$") -> Column:
    """The elements of an array as structs; an element without fields is null."""
    return F.try_variant_get(value, path, f"array<struct<{fields}>>")


def is_blank(value: Column) -> Column:
    """Absent, null or the empty string."""
    return F.coalesce(text(value), F.lit("")) == ""


def is_object(value: Column) -> Column:
    """Only an object can be read as a map. Its values stay unread, whatever lies below them."""
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def not_an_object(value: Column) -> Column:
    """Present but without named fields."""
    return value.isNotNull() & ~is_object(value)


def optional_count(value: Column) -> tuple[Column, Column]:
    """(count, is it broken): blank means unknown, other junk is broken."""
    count = whole(value)
    return count, ~is_blank(value) & count.isNull()


def counted(value: Column) -> tuple[Column, Column]:
    """(count, is it broken): absent means zero, null and junk are broken."""
    count = whole(value)
    return F.coalesce(count, F.lit(0)), value.isNotNull() & count.isNull()


def count_or_zero(value: Column) -> tuple[Column, Column]:
    """(count, is it broken): blank means zero, other junk is broken."""
    count, broken = optional_count(value)
    return F.coalesce(count, F.lit(0)), broken


def identifier(value: Column) -> Column:
    """An id as text: absent gives ``""``, an explicit null stays null."""
    return F.when(value.isNull(), F.lit("")).otherwise(text(value))
