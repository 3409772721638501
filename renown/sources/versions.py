"""Versioned folders: readers see a replacement when one empty file appears.

Every write goes to a folder of its own, ``v=<version>``, which nothing changes afterwards. A
write that is complete is published by an empty file per replaced unit (a snapshot
date, say) in ``_current``: its name holds the unit, a number that counts the unit's replacements
and the version. The highest number is in force. To create one file is atomic on every file
system, so a unit is always wholly old or wholly new: a job that fails, at whatever
point, leaves a folder nobody refers to. Running readers keep the files they began
with until ``vacuum`` removes what has been replaced for long enough.

One listing of ``_current`` tells all units and versions; no data and no other folder is looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

from renown.sources import files

_STAMP = "%Y%m%dT%H%M%S"
_CURRENT = "_current"


@dataclass(frozen=True, order=True)
class Pointer:
    """Which version a unit has after its ``number``-th replacement."""

    unit: str
    number: int
    version: str

    @property
    def name(self) -> str:
        return f"{self.unit}~{self.number:012d}~{self.version}"

    @staticmethod
    def read(name: str) -> Pointer:
        unit, number, version = name.split("~")
        return Pointer(unit, int(number), version)


def new_version() -> str:
    """A name no other write has; it begins with the time, for ``vacuum``."""
    return f"{datetime.now(timezone.utc):{_STAMP}}-{uuid.uuid4().hex[:16]}"


def folder(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/v={version}"


def _pointers(spark: SparkSession, root: str) -> list[Pointer]:
    return [Pointer.read(n) for n in files.names(spark, f"{root.rstrip('/')}/{_CURRENT}")]


def current(spark: SparkSession, root: str) -> dict[str, Pointer]:
    """The pointer in force per unit. Of two of the same number the later name counts."""
    return {p.unit: p for p in sorted(_pointers(spark, root))}


def publish(spark: SparkSession, root: str, units: Iterable[str], version: str) -> None:
    """Make a finished version the current one of each of the units, one after the other."""
    known = current(spark, root)
    for unit in sorted(units):
        number = known[unit].number + 1 if unit in known else 1
        pointer = Pointer(unit, number, version)
        files.create(spark, f"{root.rstrip('/')}/{_CURRENT}/{pointer.name}")


def vacuum(
    spark: SparkSession,
    root: str,
    part_of: Callable[[str], str] | None = None,
    older_than: timedelta = timedelta(days=3),
) -> list[str]:
    """Remove what no unit refers to any more and tell what was removed.

    Versions whose write began less than ``older_than`` ago stay, for readers and for writes that
    are still running: choose it longer than any of these takes. ``part_of`` names the folder
    of a unit inside a version, so that replaced units of a version in use go as well.
    """
    pointers = _pointers(spark, root)
    in_force = current(spark, root)
    used = {p.version for p in in_force.values()}
    limit = datetime.now(timezone.utc) - older_than

    def old(version: str) -> bool:
        written = datetime.strptime(version.partition("-")[0], _STAMP).replace(tzinfo=timezone.utc)
        return written < limit

    gone = []
    # Pointers first: a pointer must never outlive what it points to.
    for pointer in pointers:
        if pointer != in_force[pointer.unit] and old(in_force[pointer.unit].version):
            gone.append(f"{root.rstrip('/')}/{_CURRENT}/{pointer.name}")
            if part_of and pointer.version in used and in_force[pointer.unit].version != pointer.version:
                gone.append(f"{folder(root, pointer.version)}/{part_of(pointer.unit)}")
    kept = used | {
        p.version for p in pointers if f"{root.rstrip('/')}/{_CURRENT}/{p.name}" not in gone
    }
    for name in files.names(spark, root):
        version = name.removeprefix("v=")
        if name.startswith("v=") and version not in kept and old(version):
            gone.append(folder(root, version))
    for path in gone:
        files.delete(spark, path)
    return gone
