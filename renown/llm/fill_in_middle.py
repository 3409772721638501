"""Fill-in-middle documents over seekable compressed frames.

A text is kept as independent zstandard frames with the running number of units
(code points) at the end of each. Cutting it into prefix, middle and suffix opens
only the frames that a cut goes through; all others are carried over as they are, in
their new order. Digests and searches stream over the frames, one open at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import text_of
from renown.llm.hashing import sliced

#: Units per frame of a stored text.
FRAME_UNITS = 1 << 14
#: What starts the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares, in hundredths, of plain documents and of suffix-first ones among the others.
PLAIN, SUFFIX_FIRST = 10, 20
FORMS = ("plain", "psm", "spm")


class Frames:
    """Units in independent frames: ``ends[k]`` is the number of units up to the end of frame ``k``."""

    def __init__(self, ends: list[int] | None = None, data: list[bytes] | None = None):
        self.ends, self.data = ends or [], data or []

    @property
    def units(self) -> int:
        return self.ends[-1] if self.ends else 0

    def open(self, k: int) -> str:
        return zstandard.ZstdDecompressor().decompress(self.data[k]).decode()

    def spans(self, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """Frame, first and last unit in it, for every frame with a unit of start..end."""
        k = bisect_right(self.ends, start)
        while start < end:
            first = self.ends[k - 1] if k else 0
            last = min(end, self.ends[k])
            yield k, start - first, last - first
            start, k = last, k + 1

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[str]:
        """The text from unit ``start`` to ``end``, a frame at a time."""
        for k, a, b in self.spans(start, self.units if end is None else end):
            yield self.open(k)[a:b]

    def find(self, what: str, start: int = 0) -> int:
        """The first unit of the first ``what`` at ``start`` or after, also across frames; -1 if none."""
        held, at = "", start
        for text in self.stream(start):
            held += text
            found = held.find(what)
            if found >= 0:
                return at + found
            keep = min(len(held), len(what) - 1)
            at += len(held) - keep
            held = held[len(held) - keep :]
        return -1

    def digest(self, *ranges: tuple[int, int]) -> str:
        """SHA-256 of the ranges in their order, all units if none is given."""
        h = hashlib.sha256()
        for start, end in ranges or ((0, self.units),):
            for text in self.stream(start, end):
                h.update(text.encode())
        return h.hexdigest()


class Writer:
    """Puts texts and ready frames together; texts that follow each other share frames."""

    def __init__(self, frame_units: int = FRAME_UNITS):
        self.frame_units, self.frames = frame_units, Frames()
        self._held: list[str] = []
        self._size = 0

    def _close(self) -> None:
        if self._size:
            packed = zstandard.ZstdCompressor(level=1).compress("".join(self._held).encode())
            self._add(packed, self._size)
            self._held, self._size = [], 0

    def _add(self, packed: bytes, units: int) -> None:
        self.frames.ends.append(self.frames.units + units)
        self.frames.data.append(packed)

    def text(self, text: str) -> None:
        for at in range(0, len(text), self.frame_units):
            some = text[at : at + self.frame_units]
            if self._size + len(some) > self.frame_units:
                self._close()
            self._held.append(some)
            self._size += len(some)

    def copy(self, source: Frames, start: int, end: int) -> None:
        """Units of ``source``: whole frames as they are, cut ones opened."""
        for k, a, b in source.spans(start, end):
            units = source.ends[k] - (source.ends[k - 1] if k else 0)
            # A short whole frame joins its neighbours when these are open anyway.
            if b - a < units or (self._size and self._size + units <= self.frame_units):
                self.text(source.open(k)[a:b])
            else:
                self._close()
                self._add(source.data[k], units)

    def done(self) -> Frames:
        self._close()
        return self.frames


def pack(text: str, frame_units: int = FRAME_UNITS) -> Frames:
    writer = Writer(frame_units)
    writer.text(text)
    return writer.done()


def rearrange(text: Frames, form: str, first: int, second: int, frame_units: int = FRAME_UNITS) -> Frames:
    """The document in its new order; ``first`` and ``second`` are where the middle starts and ends."""
    if form == "plain":
        return text
    prefix, middle, suffix = (PREFIX, 0, first), (MIDDLE, first, second), (SUFFIX, second, text.units)
    out = Writer(frame_units)
    for mark, start, end in (prefix, suffix, middle) if form == "psm" else (suffix, prefix, middle):
        out.text(mark)
        out.copy(text, start, end)
    return out.done()


def original_ranges(output: Frames, form: str) -> list[tuple[int, int]]:
    """Where prefix, middle and suffix lie in a rearranged document, found by its markers alone."""
    if form == "plain":
        return [(0, output.units)]
    one, two = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    # The text holds no marker, and no marker can begin in text and end in a marker.
    second = output.find(two, len(one))
    third = output.find(MIDDLE, second + len(two))
    a, b = (len(one), second), (second + len(two), third)
    c = (third + len(MIDDLE), output.units)
    return [a, c, b] if form == "psm" else [b, c, a]


_FRAMES = [("ends", pa.list_(pa.int64())), ("frames", pa.list_(pa.binary()))]


def _arrays(all_frames: list[Frames]) -> list[pa.Array]:
    return [
        pa.array([f.ends for f in all_frames], _FRAMES[0][1]),
        pa.array([f.data for f in all_frames], _FRAMES[1][1]),
    ]


def store(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_units: int = FRAME_UNITS
) -> DataFrame:
    """``id_col, n, marked, ends, frames`` per row: its text in frames, ``n`` units long.

    Null counts as empty and has no frame; repeated rows and ids stay rows of their
    own, a null id stays null, other columns are not read. ``marked`` says that the text
    holds a marker. An empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias(id_col), text_of(text_col).alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        for some in sliced(batches, 512):
            texts = some.column(1).to_pylist()
            marked = [any(m in t for m in (PREFIX, SUFFIX, MIDDLE)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(marked, pa.bool_()),
                    *_arrays([pack(t, frame_units) for t in texts]),
                ],
                [id_col, "n", "marked", "ends", "frames"],
            )

    return rows.mapInArrow(
        run, f"`{id_col}` {kind}, n long, marked boolean, ends array<long>, frames array<binary>"
    )


def _draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2^32 per document, from its id alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def plan(stored: DataFrame, id_col: str = "doc_id", seed: int = 1) -> DataFrame:
    """``stored`` with ``form`` and the lengths of prefix and middle, null where the document stays plain.

    A null id draws as an empty one.
    """
    h1, h2, h3, h4 = _draws(id_col, seed)
    n = F.col("n")
    first, second = F.least(h1 % (n + 1), h2 % (n + 1)), F.greatest(h1 % (n + 1), h2 % (n + 1))
    plain = (n == 0) | F.col("marked") | (h3 % 100 >= 100 - PLAIN)
    form = F.when(plain, "plain").when(h4 % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    return stored.withColumns(
        {
            "form": form,
            "prefix_chars": F.when(~plain, first),
            "middle_chars": F.when(~plain, second - first),
        }
    )


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    frame_units: int = FRAME_UNITS,
) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, ends, frames`` per row: the document in its new order.

    Null texts are empty and plain; see ``store`` and ``plan`` for the other cases.
    """
    planned = plan(store(docs, id_col, text_col, frame_units), id_col, seed).drop("marked")
    carried = [id_col, "n", "form", "prefix_chars", "middle_chars"]
    planned = planned.select(*carried, "ends", "frames")

    def run(batches):
        for some in sliced(batches, 512):
            form, prefix, middle, ends, data = (some.column(c).to_pylist() for c in range(2, 7))
            out = [
                rearrange(Frames(e, d), f, a or 0, (a or 0) + (m or 0), frame_units)
                for f, a, m, e, d in zip(form, prefix, middle, ends, data)
            ]
            yield pa.RecordBatch.from_arrays(
                [some.column(c) for c in range(5)] + _arrays(out), some.schema.names
            )

    return planned.mapInArrow(run, planned.schema)


def texts(transformed: DataFrame, restored: bool = False, name: str = "text") -> DataFrame:
    """The documents as text, in their new order or, ``restored``, in the old one again."""
    keep = [c for c in transformed.columns if c not in ("ends", "frames", name)]
    rows = transformed.select("form", "ends", "frames", *[F.col(c).alias(f"_{c}") for c in keep])

    def run(batches):
        for some in sliced(batches, 64):
            out = []
            for form, ends, data in zip(*(some.column(c).to_pylist() for c in range(3))):
                held = Frames(ends, data)
                ranges = original_ranges(held, form) if restored else [(0, held.units)]
                out.append("".join(t for a, b in ranges for t in held.stream(a, b)))
            yield pa.RecordBatch.from_arrays(
                [some.column(c) for c in range(3, len(keep) + 3)] + [pa.array(out, pa.string())],
                [*keep, name],
            )

    fields = [f"`{c}` {transformed.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(run, ", ".join([*fields, f"`{name}` string"]))


def digests(transformed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The columns of ``transform`` but its frames, with the SHA-256 of the output and of the text rebuilt from it."""
    carried = [id_col, "n", "form", "prefix_chars", "middle_chars"]
    rows = transformed.select(*carried, "ends", "frames")

    def run(batches):
        for some in sliced(batches, 512):
            out, back = [], []
            for form, ends, data in zip(*(some.column(c).to_pylist() for c in (2, 5, 6))):
                held = Frames(ends, data)
                out.append(held.digest())
                back.append(held.digest(*original_ranges(held, form)))
            yield pa.RecordBatch.from_arrays(
                [some.column(c) for c in range(5)] + [pa.array(out), pa.array(back)],
                [*carried, "output_sha256", "restored_sha256"],
            )

    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried]
    return rows.mapInArrow(run, ", ".join([*fields, "output_sha256 string", "restored_sha256 string"]))
