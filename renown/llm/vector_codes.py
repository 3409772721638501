"""Product codes of vectors in whole numbers, with Walsh-Hadamard distances.

Vectors become integers and are cut into equal parts; each part is coded by the
nearest entry of its codebook, and the codebooks move to the floored means of their
parts for some rounds. Parts and entries, padded with zeros to a power of two, go through
an integer Walsh-Hadamard transform: squared differences of the transforms are those of
the parts times the padded length. They are added up in sequency order, and an entry
leaves as soon as its sum passes that of a known good entry. Nothing is rounded.

Spark holds the vectors; a round brings one sum per codebook number to the driver,
whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import Stage

#: Units per 1.0, parts per vector, entries per part, rounds of moving them.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Integers below this, divided by the padded length of a part, keep transforms and sums of squares in 64 bits.
SAFE = 1 << 30
#: Vectors that are compared with all entries at once.
ROWS = 4096


def walsh_order(width: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``width`` (a power of two) by their number of sign changes."""
    at = np.arange(width)
    odd = np.array([[(int(i) & int(j)).bit_count() & 1 for j in at] for i in at])
    return np.argsort((np.diff(odd, axis=1) != 0).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis, padded with zeros, in sequency order."""
    size = x.shape[-1]
    width = padded(size)
    t = np.zeros((*x.shape[:-1], width), x.dtype)
    t[..., :size] = x
    half = 1
    while half < width:
        pairs = t.reshape(*t.shape[:-1], width // (2 * half), 2, half)
        a, b = pairs[..., 0, :], pairs[..., 1, :]
        t = np.stack([a + b, a - b], axis=-2).reshape(t.shape)
        half *= 2
    return t[..., walsh_order(width)]


def nearest(t: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest of the transformed ``entries``, ties to the lower, and the distance times the width.

    The entry nearest in the first coefficient gives each row its bound. Entries whose sum
    so far is above the bound are out; those that last to the end have their whole distance.
    """
    sums = (t[:, :1] - entries[None, :, 0]) ** 2
    guess = sums.argmin(axis=1)
    bound = ((t - entries[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums, limit = sums[row, entry], bound[row]
    for c in range(1, t.shape[1]):
        sums = sums + (t[row, c] - entries[entry, c]) ** 2
        stays = (sums <= limit).astype(bool)
        if not stays.all():
            row, entry, sums, limit = row[stays], entry[stays], sums[stays], limit[stays]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(sums, first) if len(row) else sums
    best = np.flatnonzero(sums == np.repeat(least, np.diff(np.append(first, len(row)))))
    best = best[np.diff(row[best], prepend=-1) != 0]
    return entry[best], least


def padded(width: int) -> int:
    """The next power of two."""
    return 1 << max(width - 1, 0).bit_length()


def whole_numbers(values: np.ndarray, width: int) -> np.ndarray:
    """floor(SCALE * x). Numbers too large for 64-bit squares in parts of ``width`` become Python integers."""
    values = values.astype(np.float64)
    if not len(values) or np.abs(values).max() < SAFE // padded(width) / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    exact = [int(v) * SCALE if abs(v) >= 1 << 52 else math.floor(v * SCALE) for v in values.tolist()]
    return np.array(exact, dtype=object)


@dataclass(frozen=True)
class Codebooks:
    """Entries per part, as nested tuples of integers: part, entry, position."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]

    @property
    def width(self) -> int:
        return len(self.entries[0][0])

    def digest(self) -> str:
        flat = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()

    def transformed(self) -> list[np.ndarray]:
        biggest = max((abs(x) for part in self.entries for e in part for x in e), default=0)
        kind = np.int64 if biggest < SAFE // padded(self.width) else object
        return [transform(np.array(part, dtype=kind).reshape(len(part), -1)) for part in self.entries]

    def assign(self, x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Entry per row and part, and squared distance per row, of integers (rows, parts * width)."""
        codes = np.zeros((len(x), len(books)), np.int64)
        errors = np.zeros(len(x), object)
        for p, book in enumerate(books):
            t = transform(x[:, p * self.width : (p + 1) * self.width])
            if not self.width or not len(x):
                continue
            codes[:, p], scaled = nearest(t, book)
            errors = errors + scaled.astype(object) // t.shape[1]
        return codes, errors


def sound(vector: str) -> Column:
    """The vector is there and all its components are finite numbers."""
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")).cast("double"))
    )
    return F.col(vector).isNotNull() & ~odd


def _matrices(batch, parts: int, width: int):
    """Slices of a batch (its last column the vectors of ``parts * width`` components) with their integers."""
    for at in range(0, batch.num_rows, ROWS):
        some = batch.slice(at, ROWS)
        flat = some.column(some.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
        yield some, whole_numbers(flat, width).reshape(some.num_rows, parts * width)


def starting_entries(kept: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """Codebooks from the vectors of the smallest ids, ties by the vectors; None without a vector that can be cut."""
    can_cut = kept.where(F.size("v") % parts == 0)
    least = can_cut.orderBy(F.asc_nulls_last("id"), "v")
    one = least.limit(1).collect()
    if not one:
        return None
    size = len(one[0]["v"])
    rows = least.where(F.size("v") == size).limit(entries).collect()
    width = size // parts
    numbers = [whole_numbers(np.array(r["v"], np.float64), width).tolist() for r in rows]
    return Codebooks(
        tuple(
            tuple(tuple(int(x) for x in v[p * width : (p + 1) * width]) for v in numbers)
            for p in range(parts)
        )
    )


def moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry to the floored mean of its parts, unused ones stay."""
    parts, entries, width = len(books.entries), len(books.entries[0]), books.width
    step = width + 1

    def run(batches):
        ready = books.transformed()
        totals = np.zeros(parts * entries * step, object)
        for batch in batches:
            for _, x in _matrices(batch, parts, width):
                codes, _ = books.assign(x, ready)
                for p in range(parts):
                    part = x[:, p * width : (p + 1) * width]
                    order = np.argsort(codes[:, p], kind="stable")
                    used, first = np.unique(codes[order, p], return_index=True)
                    counts = np.diff(np.append(first, len(x)))
                    sums = np.add.reduceat(part[order], first, axis=0) if width else part[first]
                    for e, n, s in zip(used.tolist(), counts.tolist(), sums):
                        slot = (p * entries + e) * step
                        totals[slot : slot + width] += s.astype(object)
                        totals[slot + width] += n
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array([str(totals[i]) for i in at], pa.string())], ["slot", "total"]
        )

    sums = vectors.select("v").mapInArrow(run, "slot int, total string")
    gathered = sums.groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    total = {r["slot"]: int(r["total"]) for r in gathered.collect()}  # parts * entries * (width + 1) rows at most

    def entry(p: int, e: int) -> tuple[int, ...]:
        slot = (p * entries + e) * step
        n = total.get(slot + width, 0)
        if not n:
            return books.entries[p][e]
        return tuple(total.get(slot + i, 0) // n for i in range(width))

    return Codebooks(tuple(tuple(entry(p, e) for e in range(entries)) for p in range(parts)))


def fit(vectors: DataFrame, start: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` rounds over all rows of ``v``."""
    books = start
    for _ in range(rounds):
        books = moved(vectors, books)
    return books


def compress(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """``id_col, label_col, code, error`` per sound vector, and the codebooks that the codes point into.

    ``code`` is an array of entry indexes in part order. Null vectors and those with a null or
    non-finite component are left out. All vectors should have one length, a multiple of ``parts``: one of a
    length other than that of the first codebook vector stays with null code and error. Fewer vectors than
    ``entries`` make smaller codebooks, an empty table gives no rows and no codebooks. Equal ids stay
    rows of their own, null ids come last in the order of ids. An error beyond 64 bits is null. Other
    columns are not read.
    """
    kept = rows.where(sound(vector_col)).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")
    )
    names = kept.select(F.col("id").alias(id_col), F.col("label").alias(label_col))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in names.schema.fields]
    result = ", ".join([*kinds, "code array<int>, error long"])
    start = starting_entries(kept, parts, entries)
    if start is None:
        none = names.withColumn("code", F.lit(None).cast("array<int>"))
        return none.withColumn("error", F.lit(None).cast("long")), None
    size = start.width * parts
    fits = F.size("v") == size
    books = fit(kept.where(fits), start, rounds)

    def run(batches):
        ready = books.transformed()
        for batch in batches:
            for some, x in _matrices(batch, parts, start.width):
                codes, errors = books.assign(x, ready)
                flat = pa.array(codes.astype(np.int32).ravel(), pa.int32())
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        some.column(1),
                        pa.ListArray.from_arrays(offsets, flat),
                        pa.array([e if e < 1 << 63 else None for e in errors.tolist()], pa.int64()),
                    ],
                    [id_col, label_col, "code", "error"],
                )

    coded = kept.where(fits).select("id", "label", "v").mapInArrow(run, result)
    other = kept.where(~fits).select(
        F.col("id").alias(id_col),
        F.col("label").alias(label_col),
        F.lit(None).cast("array<int>").alias("code"),
        F.lit(None).cast("long").alias("error"),
    )
    return coded.unionByName(other), books


def with_label_errors(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded`` and ``label_error``, the sum of ``error`` over all rows of the label; null labels are one label.

    The rows are kept first, as two jobs read them; the sums have one row per label,
    so an adaptive join may split a label that holds most rows.
    """
    coded = Stage(coded.sparkSession).keep(coded)
    sums = coded.groupBy(F.col(label_col).alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")
    )
    return coded.join(sums, F.col(label_col).eqNullSafe(F.col("_label")), "left").drop("_label")


def hex_code(code: Column) -> Column:
    """Two hex digits per index, joined."""
    return F.array_join(F.transform(code, lambda i: F.lower(F.lpad(F.hex(i.cast("long")), 2, "0"))), "")
