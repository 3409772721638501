"""Words of many texts as 64-bit numbers, by a few numpy passes over their bytes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
#: Bytes of text that are looked at together; bounds the memory of a pass.
BLOCK = 1 << 18

LETTERS = np.zeros(256, bool)
LETTERS[[*range(97, 123), *range(128, 256)]] = True
#: Letters and digits of ASCII and all bytes of other characters.
WORD_BYTES = LETTERS.copy()
WORD_BYTES[48:58] = True
#: All but space and \x09 to \x0D.
SOLID_BYTES = np.ones(256, bool)
SOLID_BYTES[[32, *range(9, 14)]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = U(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE), np.full(n, inverse)
    up[0] = down[0] = U(1)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _pieces(texts: list[str | None], lower: bool) -> Iterator[tuple[int, bytes]]:
    """Texts as bytes; one longer than a block is cut between words, a longer word anywhere."""
    for i, text in enumerate(texts):
        if not text:
            continue
        raw = (text.lower() if lower else text).encode("utf-8", "replace")
        at = 0
        while len(raw) - at > BLOCK:
            cut = max(raw.rfind(c, at, at + BLOCK) for c in (b" ", b"\n")) + 1
            cut = cut if cut > at else at + BLOCK
            yield i, raw[at:cut]
            at = cut
        yield i, raw[at:]


def blocks(
    texts: list[str | None], table: np.ndarray = WORD_BYTES, lower: bool = True
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of some texts, and for each word in them its text's number, start and end.

    Blocks come in the order of the texts; a text may run on in the next one.
    """
    held, size = [], 0

    def done():
        raw = np.frombuffer(b"".join(p + b"\n" for _, p in held), np.uint8)
        ends = np.cumsum([len(p) + 1 for _, p in held])
        edge = np.flatnonzero(np.diff(table[raw].view(np.int8), prepend=np.int8(0)))
        start, end = edge[0::2], edge[1::2]
        owner = np.array([i for i, _ in held])[np.searchsorted(ends, start, "right")]
        return raw, owner, start, end

    for i, piece in _pieces(texts, lower):
        if held and size + len(piece) > BLOCK:
            yield done()
            held, size = [], 0
        held.append((i, piece))
        size += len(piece) + 1
    if held:
        yield done()


class Sums:
    """Running sums of a block's bytes, from which any stretch of it has its hash."""

    def __init__(self, raw: np.ndarray):
        n = len(raw) + 1
        up, self.down = (p[:n] for p in _powers(max(2 * BLOCK, 1 << int(n).bit_length())))
        self.sums = np.zeros(n, U)
        np.cumsum((raw.astype(U) + U(1)) * up[:-1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word, in the order of the words."""
    owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for raw, owner, start, end in blocks(texts):
        owners.append(owner)
        hashes.append(Sums(raw).hash(start, end))
    return np.concatenate(owners), np.concatenate(hashes)


def shingle_hashes(owner: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every run of ``n`` words; fewer words make one run."""
    if not len(words):
        return owner, words
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    counts = np.diff(np.append(first, len(owner)))
    take = np.maximum(counts - n + 1, 1)
    of = np.repeat(owner[first], take)
    at = np.arange(len(of)) - np.repeat(np.cumsum(take) - take, take) + np.repeat(first, take)
    last = np.repeat(first + counts, take)
    h = np.zeros(len(of), U)
    for k in range(n):
        w = words[np.minimum(at + k, len(words) - 1)]
        h = mix(h * BASE + np.where(at + k < last, w, U(k + 1)))
    return of, h


_REMEMBERED: dict[str, Callable[[], None]] = {}


def remembers(owner: str, forget: Callable[[], None]) -> None:
    """Tell that this worker process holds something of ``owner`` between tasks, and how to drop it."""
    _REMEMBERED[owner] = forget


def forget_others(owner: str | None = None) -> None:
    """Drop what tasks of other operators left in this worker process, which Spark uses for all of them."""
    others = [name for name in _REMEMBERED if name != owner]
    for name in others:
        _REMEMBERED.pop(name)()
    if others:
        gc.collect()
        # the memory goes back to the machine, not only to this process
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def sliced(batches, rows: int):
    """Arrow batches cut to a bounded number of rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def parts(batches, columns: tuple[str, ...], rows: int = 512):
    """Python lists of the columns of Arrow batches, a bounded number of rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            some = batch.slice(at, rows)
            yield tuple(some.column(c).to_pylist() for c in columns)
