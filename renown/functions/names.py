"""Name keys as native column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compatibility forms of ASCII characters all lie below this code point.
_FOLD_LIMIT = 0x20000


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """Which non-ASCII characters stand for ASCII letters, digits or ``&``.

    Derived from the Unicode decompositions: two aligned strings for the
    one-to-one cases and a map for characters that expand to several.
    """
    source, target, expand = [], [], {}
    for code in range(0x80, _FOLD_LIMIT):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        kept = "".join(
            c
            for c in unicodedata.normalize("NFKD", char)
            if c.isascii() and (c.isalnum() or c == "&")
        )
        if len(kept) == 1:
            source.append(char)
            target.append(kept)
        elif kept:
            expand[char] = kept
    return "".join(source), "".join(target), expand


def _fold(name: Column) -> Column:
    source, target, expand = fold_tables()
    table = F.str_to_map(
        F.lit(",".join(f"{char}:{kept}" for char, kept in expand.items())),
        F.lit(","),
        F.lit(":"),
    )
    spelled_out = F.array_join(
        F.transform(F.split(name, ""), lambda c: F.coalesce(F.element_at(table, c), c)), ""
    )
    # Removing the expanding characters by table lookup tells whether there are any.
    without = F.translate(name, "".join(expand), "")
    return F.translate(F.when(without == name, name).otherwise(spelled_out), source, target)


def canonical_key(name: Column | str) -> Column:
    """Comparison key: accents folded, ``&`` read as "and", only ``[a-z0-9]`` left.

    Null and names without a Latin letter or digit give ``""``. Letters that do
    not decompose (``ø æ ß ł``) are dropped, not guessed. ASCII names, told by
    their byte length, skip the folding.
    """
    name = F.col(name) if isinstance(name, str) else name
    ascii_only = F.octet_length(name) == F.char_length(name)
    folded = F.when(ascii_only, name).otherwise(_fold(name))
    spoken = F.replace(folded, F.lit("&"), F.lit("and"))
    return F.coalesce(F.lower(F.regexp_replace(spoken, "[^A-Za-z0-9]+", "")), F.lit(""))


def non_blank(value: Column) -> Column:
    """The value, or null when it is empty."""
    return F.nullif(value, F.lit(""))
