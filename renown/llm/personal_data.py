"""Personal data: generators propose overlapping spans, boosted trees on format and context judge them.

Fixed rules give the base spans, which always count. Beyond them, generators of high recall
propose every span that could be an address, a card or a phone number: also spelled-out mail
addresses, and all windows of neighbouring groups of digits, as numbers that touch defeat
the rules. Boosted trees per kind, calibrated on rows they have not seen, judge them, and
spans above the kind's threshold are added, best first, where they overlap no other.

The examples to learn from come from all documents: base spans and their fragments, spans
that fail a check, and variations of base spans in their own context (two in a row,
other separators, spelled out, one digit changed). They stay in a table; the driver gets counts of a fixed size.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.llm.boosting import BINS, Calibration, Trees, calibrate, grow_trees, threshold_for
from renown.llm.frames import Stage, text_of
from renown.llm.hashing import sliced

#: The kinds in their order, and what the base spans must follow.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){15,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Characters before and after a span that count as its context.
CONTEXT = 40
WORD_BUCKETS = 1024
#: Margins are counted in steps of its inverse, up to so much on either side.
MARGIN_STEPS, MARGIN_END = 1024, 32
#: Share of right spans that a threshold must hold on unseen examples, and how many must be above it.
PRECISION, LEAST_RIGHT = 0.99, 20
#: Spans judged at once.
BLOCK = 20_000

Span = tuple[int, int, int]  # kind, start, end


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(digits: str) -> bool:
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    back = digits[::-1]
    return (sum(map(int, back[::2])) + sum(doubled[int(c)] for c in back[1::2])) % 10 == 0


def _octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part[-4:] or 0) <= 255 for part in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches by walking from each @, so that long words cost nothing twice."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """What the fixed rules find, by kind, then start."""
    found = [(EMAIL, *s) for s in _emails(text)]
    found += [(IP, *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        digits = digits_of(m[0])
        if len(digits) <= 19 and passes_luhn(digits):
            found.append((CARD, *m.span()))
    if "+" in text:
        found += [(PHONE, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return found


_DIGITS = re.compile(r"[0-9]+")
_GAP = re.compile(r"[ ().-]{1,3}")
_AT = re.compile(r"@|[(\[{] ?at ?[)\]}]| at ", re.IGNORECASE)
_NAME = re.compile(r"[\w.%+-]+ ?$")
_HOST = re.compile(r" ?[\w-]+(?:\.[\w-]+)*")
_SPELLED_HOST = re.compile(
    r" ?[\w-]+(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )[\w-]+)*(?: ?[(\[{] ?dot ?[)\]}] ?| dot )[\w-]+(?:\.[\w-]+)*",
    re.IGNORECASE,
)


def candidates(text: str) -> Iterator[Span]:
    """Every span that could be personal data; they may overlap. Linear in the length of the text."""
    for m in _AT.finditer(text):
        near = max(0, m.start() - 64)
        name = _NAME.search(text[near : m.start()])
        if name is None:
            continue
        start = near + name.start()
        host = (_HOST if m[0] == "@" else _SPELLED_HOST).match(text, m.end())
        if host:
            yield EMAIL, start, host.end()
        if m[0] == "@" and (spelled := _SPELLED_HOST.match(text, m.end())):
            yield EMAIL, start, spelled.end()
    chain: deque[tuple[int, int]] = deque()  # groups of digits with short gaps between them
    gaps: deque[str] = deque()
    for m in _DIGITS.finditer(text):
        start, end = m.span()
        gap = text[chain[-1][1] : start] if chain and start - chain[-1][1] <= 3 else ""
        if chain and not _GAP.fullmatch(gap):
            chain.clear()
            gaps.clear()
        elif chain:
            gaps.append(gap)
        chain.append((start, end))
        size, plain, dots = 0, True, True
        for k in range(len(chain) - 1, -1, -1):
            size += chain[k][1] - chain[k][0]
            if size > 19:
                # no window that starts here or before is short enough any more
                for _ in range(k + 1):
                    chain.popleft()
                    if gaps:
                        gaps.popleft()
                break
            if k < len(chain) - 1:
                plain, dots = plain and gaps[k] in (" ", "-"), dots and gaps[k] == "."
            first = chain[k][0]
            if plain and size >= 13:
                yield CARD, first, end
            if dots and len(chain) - k == 4:
                yield IP, first, end
            if 7 <= size <= 15:
                if first and text[first - 1] == "(":
                    first -= 1
                if first and text[first - 1] == "+":
                    first -= 1
                yield PHONE, first, end


def _plausible(text: str, span: Span) -> bool:
    """The span passes the checks of its kind, so that not being a base span does not make it wrong."""
    kind, start, end = span
    part = text[start:end]
    digits = digits_of(part)
    if kind == CARD:
        return passes_luhn(digits)
    if kind == IP:
        return _octets(part)
    if kind == PHONE:
        return part[0] in "+(" and 8 <= len(digits) <= 15
    return True


def _class_of(text: str, at: int) -> int:
    """What sort of character stands there."""
    if not 0 <= at < len(text):
        return 0
    c = text[at]
    if c.isspace():
        return 1
    if "0" <= c <= "9":
        return 2
    return 3 if c.isalpha() else 4 + min(".,-:;()@_+/".find(c) + 1, 11)


_WORD = re.compile(r"[^\W\d_]+")
FORMAT_FEATURES = 24


def format_features(text: str, span: Span) -> list[int]:
    """What a span and its edges look like, as numbers of 0 to 31."""
    _, start, end = span
    part = text[start:end]
    digits = digits_of(part)
    groups = [len(g) for g in _DIGITS.findall(part)] or [0]
    _, _, host = part.partition("@")
    numbers = [
        end - start,
        len(digits),
        len(groups),
        groups[0],
        groups[-1],
        max(groups),
        min(groups),
        part.count("."),
        part.count("-"),
        part.count(" "),
        part.count("("),
        part.count("@"),
        int(part[0] == "+"),
        int(len(digits) > 0 and passes_luhn(digits)),
        int(part.count(".") == 3 and _DIGITS.fullmatch(part.replace(".", "0")) is not None and _octets(part)),
        len(set(digits)),
        int(digits[:1] or 0),
        sum(c.isalpha() for c in part),
        host.count("."),
        len(host.rpartition(".")[2]),
        _class_of(text, start - 1),
        _class_of(text, start - 2),
        _class_of(text, end),
        _class_of(text, end + 1),
    ]
    return [min(n, BINS - 1) for n in numbers]


def context_words(text: str, span: Span) -> list[int]:
    """Buckets of the three words before and the two after, with their side."""
    _, start, end = span
    before = _WORD.findall(text[max(0, start - CONTEXT) : start])[-3:]
    after = _WORD.findall(text[end : end + CONTEXT])[:2]
    sides = ((before, b"<"), (after, b">"))
    return [crc32(w.lower().encode("utf-8", "replace") + side) % WORD_BUCKETS for ws, side in sides for w in ws]


def _overlaps(span: Span, others: Iterable[Span]) -> bool:
    return any(span[1] < o[2] and o[1] < span[2] for o in others)


def _variations(text: str, spans: list[Span]) -> Iterator[tuple[str, Span, set[Span]]]:
    """Short texts around altered base spans, the altered part, and which spans that touch it are right."""
    for n, (kind, start, end) in enumerate(spans):
        part = text[start:end]
        before = text[max(0, start - CONTEXT) : start]
        after = text[end : end + CONTEXT]
        at = len(before)

        def alone(new: str, right: bool):
            part_of = (kind, at, at + len(new))
            return before + new + after, part_of, ({part_of} if right else set())

        other, a, b = spans[n - 1]  # the span itself where it is the only one
        for gap in (" ", ", "):
            second = at + len(part) + len(gap)
            both = {(kind, at, at + len(part)), (other, second, second + b - a)}
            yield before + part + gap + text[a:b] + after, (kind, at, second + b - a), both
        if kind == EMAIL:
            name, _, host = part.partition("@")
            for mark, dot in ((" (at) ", " (dot) "), (" at ", " dot "), ("[at]", "[dot]")):
                yield alone(name + mark + host.replace(".", dot), True)
            yield alone(name + "@" + host.partition(".")[0], False)
            yield alone(f"{name} at {host.partition('.')[0]}", False)
        elif kind == CARD:
            digits = digits_of(part)
            for gap in ("-", " "):
                yield alone(gap.join(digits[k : k + 4] for k in range(0, len(digits), 4)), True)
            for k in (0, 7, len(digits) - 1):
                yield alone(digits[:k] + str((int(digits[k]) + 1 + n % 8) % 10) + digits[k + 1 :], False)
            yield alone(digits[:12], False)
        elif kind == IP:
            yield alone(part + ".1", False)
            yield alone("3" + part.rjust(15, "0"), False)
            yield alone(part.rpartition(".")[0] + ".999", False)
        else:
            yield alone(part[:-1] + "77777777", False)
            yield alone(digits_of(part), False)
            if "(" in part:
                yield alone(part[part.index("(") :], True)


def examples(text: str) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """Kind, whether it is right, format features and context words of spans whose answer is known."""

    def shown(where: str, span: Span, right: bool):
        return span[0], int(right), format_features(where, span), context_words(where, span)

    base = base_spans(text)
    known = sorted((a, b, k) for k, a, b in base)
    starts = [a for a, _, _ in known]
    longest = max((b - a for a, b, _ in known), default=0)
    for span in candidates(text):
        kind, start, end = span
        near = known[bisect_left(starts, start - longest) : bisect_left(starts, end)]
        near = [(k, a, b) for a, b, k in near]
        if span in near:
            yield shown(text, span, True)
        elif _overlaps(span, near) or not _plausible(text, span):
            yield shown(text, span, False)
    for varied, altered, right in _variations(text, base):
        own = {s for s in base_spans(varied) if not _overlaps(s, right)}
        for span in candidates(varied):
            if span in right or (_overlaps(span, [altered]) and span not in own):
                yield shown(varied, span, span in right)


@dataclass(frozen=True)
class Judge:
    """The model of one kind: word weights, trees, calibration, threshold."""

    words: np.ndarray
    trees: Trees
    calibration: Calibration
    threshold: float

    def features(self, shapes: list[list[int]], words: list[list[int]]) -> np.ndarray:
        weight = np.array([self.words[w].sum() if w else 0.0 for w in words])
        context = np.clip(np.round(4 * weight) + BINS // 2, 0, BINS - 1)
        return np.column_stack([np.array(shapes, np.int64).reshape(-1, FORMAT_FEATURES), context.astype(np.int64)])

    def probability(self, shapes: list[list[int]], words: list[list[int]]) -> np.ndarray:
        return self.calibration.probability(self.trees.margin(self.features(shapes, words)))


def _word_weights(sums: np.ndarray, yes: int, no: int) -> np.ndarray:
    """Smoothed log odds of a right span, per bucket of context words, from the examples with each bucket, wrong and right ones."""
    yes, no = max(yes, 1), max(no, 1)
    return np.log((sums[1] + 5) / (yes + 5) * (no + 5) / (sums[0] + 5)) * (sums.sum(axis=0) > 0)


Model = tuple[Judge | None, ...]


_EXAMPLE = "kind int, right int, fold int, draw long, shape binary, words binary"


def _examples(chosen: DataFrame) -> DataFrame:
    """The examples of all rows of ``text``, each with the part it serves and a draw; equal ones once."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = set()
                for one in batch.slice(at, 64).column(0).to_pylist():
                    for kind, right, shape, words in examples(one):
                        rows.add((kind, right, bytes(shape), b"".join(w.to_bytes(2, "big") for w in words)))
                out = [
                    (kind, right, crc32(shape + words) // 7 % 3, crc32(bytes([kind, right]) + shape + words), shape, words)
                    for kind, right, shape, words in rows
                ]
                columns = list(zip(*out)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    names = [c.split(" ")[0] for c in _EXAMPLE.split(", ")]
    return chosen.mapInArrow(run, _EXAMPLE).distinct()


def _unpacked(words: bytes) -> list[int]:
    return [int.from_bytes(words[i : i + 2], "big") for i in range(0, len(words), 2)]


def _word_sums(found: DataFrame) -> np.ndarray:
    """Per kind, whether it is right, and bucket: examples with such a context word."""

    def run(batches):
        sums: Counter[int] = Counter()
        for batch in batches:
            for kind, right, words in zip(*(c.to_pylist() for c in batch.columns)):
                first = (2 * kind + right) * WORD_BUCKETS
                sums.update(first + w for w in set(_unpacked(words)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], ["cell", "n"]
        )

    added = found.select("kind", "right", "words").mapInArrow(run, "cell long, n long")
    total = added.groupBy("cell").agg(F.sum("n")).toArrow()
    sums = np.zeros(len(KINDS) * 2 * WORD_BUCKETS)
    sums[total.column(0).to_numpy()] = total.column(1).to_numpy()
    return sums.reshape(len(KINDS), 2, WORD_BUCKETS)


def _features(found: DataFrame, weights: dict[int, np.ndarray]) -> DataFrame:
    """``kind, fold, x, yes, n``: how many examples of each fold have these features, and how many of them are right."""
    shared = found.sparkSession.sparkContext.broadcast({k: Judge(w, None, None, 2.0) for k, w in weights.items()})

    def run(batches):
        for batch in batches:
            kinds = batch.column(0).to_numpy()
            for kind, judge in shared.value.items():
                some = batch.filter(pa.array(kinds == kind))
                if not some.num_rows:
                    continue
                shapes = np.frombuffer(b"".join(some.column(3).to_pylist()), np.uint8).reshape(-1, FORMAT_FEATURES)
                x = judge.features(shapes, [_unpacked(w) for w in some.column(4).to_pylist()]).astype(np.uint8)
                packed = pa.array([row.tobytes() for row in x], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), some.column(2), packed], names)

    names = ["kind", "fold", "right", "x"]
    rows = found.select("kind", "fold", "right", "shape", "words").mapInArrow(run, "kind int, fold int, right int, x binary")
    return rows.groupBy("kind", "fold", "x").agg(F.sum("right").alias("yes"), F.count("*").alias("n"))


def _margins(rows: DataFrame, trees: dict[int, Trees]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind the margins of all rows, in steps, whether they are right, and how many there are of each."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for batch in batches:
            kinds, yes, n = (batch.column(k).to_numpy() for k in (0, 2, 3))
            every = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, FORMAT_FEATURES + 1)
            step = np.zeros(len(kinds), np.int64)
            for kind, of in shared.value.items():
                pick = np.flatnonzero(kinds == kind)
                margin = np.clip(of.margin(every[pick].astype(np.int64)), -MARGIN_END, MARGIN_END)
                step[pick] = np.floor(margin * MARGIN_STEPS)
            columns = [batch.column(0), pa.array(step), pa.array(yes), pa.array(n - yes)]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "step", "yes", "no"])

    each = rows.select("kind", "x", "yes", "n").mapInArrow(run, "kind int, step long, yes long, no long")
    found = each.groupBy("kind", "step").agg(F.sum("yes"), F.sum("no")).orderBy("kind", "step").toArrow()
    kinds, steps, yes, no = (found.column(k).to_numpy() for k in range(4))
    out = {}
    for kind in trees:
        own = kinds == kind
        # the least margin of a step, so that a threshold takes the whole step
        margin, times = np.tile(steps[own] / MARGIN_STEPS, 2), np.concatenate([yes[own], no[own]]).astype(float)
        right, some = np.repeat([1.0, 0.0], own.sum()), times > 0
        out[kind] = margin[some], right[some], times[some]
    return out


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int | None = None,
    max_examples: int | None = None,
) -> Model:
    """One judge per kind, from the examples of all rows; equal examples, as of copies, count once.

    Word weights come from fold 0, trees from fold 1, calibration and threshold from fold 2. A kind without enough examples
    has no judge. Whoever wants to learn from less may ask for about ``max_rows`` rows, chosen by a hash of id and text, and at most
    ``max_examples`` examples a kind. Examples stay in a table; the driver gets sums per bucket, node and step.
    """
    text = text_of(text_col)
    chosen = docs
    if max_rows is not None and (n := docs.count()) > max_rows:
        draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), text), F.lit(1 << 20))
        chosen = docs.where(draw < int((1 << 20) * max_rows / n))
    store = Stage(docs.sparkSession)
    found = store.keep(_examples(chosen.select(text.alias("text")).where(F.col("text").rlike("[0-9@]| at "))))
    if max_examples is not None:
        some = [found.where(F.col("kind") == k).orderBy("draw", "shape", "words").limit(max_examples) for k in range(len(KINDS))]
        found = store.keep(reduce(DataFrame.unionByName, some))
    n = np.zeros((len(KINDS), 3, 2), np.int64)
    for row in found.groupBy("kind", "fold", "right").count().collect():
        n[row.kind, row.fold, row.right] = row["count"]
    learnt = [kind for kind in range(len(KINDS)) if n[kind].all()]
    if not learnt:
        store.clear()
        return (None,) * len(KINDS)
    sums = _word_sums(found.where("fold = 0"))
    weights = {kind: _word_weights(sums[kind], n[kind, 0, 1], n[kind, 0, 0]) for kind in learnt}
    rows = store.keep(_features(found.where("fold > 0"), weights))
    shares = {kind: n[kind, 1, 1] / n[kind, 1].sum() for kind in learnt}
    trees = grow_trees(rows.where("fold = 1"), shares, FORMAT_FEATURES + 1)
    judges: list[Judge | None] = [None] * len(KINDS)
    for kind, (margin, right, times) in _margins(rows.where("fold = 2"), trees).items():
        calibration = calibrate(margin, right, times=times)
        threshold = threshold_for(calibration.probability(margin), right, PRECISION, LEAST_RIGHT, times)
        judges[kind] = Judge(weights[kind], trees[kind], calibration, threshold)
    store.clear()
    return tuple(judges)


def _above(text: str, model: Model, base: set[Span]) -> Iterator[tuple[float, Span]]:
    """Candidates above their kind's threshold, but base spans; a block of them is judged at once."""
    held: list[list[Span]] = [[] for _ in KINDS]

    def judged(kind: int):
        spans, held[kind] = held[kind], []
        shapes = [format_features(text, s) for s in spans]
        p = model[kind].probability(shapes, [context_words(text, s) for s in spans])
        for i in np.flatnonzero(p >= model[kind].threshold):
            yield float(p[i]), spans[i]

    for span in candidates(text):
        if model[span[0]] is None or span in base:
            continue
        held[span[0]].append(span)
        if len(held[span[0]]) >= BLOCK:
            yield from judged(span[0])
    for kind in range(len(KINDS)):
        if held[kind]:
            yield from judged(kind)


def find_spans(text: str, model: Model) -> list[tuple[int, int, int, bool, float]]:
    """Kind, start, end, whether it is a base span and its probability, by kind, then start."""
    base = base_spans(text)
    found = [(*s, True, 1.0) for s in base]
    added = sorted(_above(text, model, set(base)), key=lambda x: (-x[0], x[1][1], -x[1][2], x[1][0]))
    # What is taken, as stretches that neither overlap nor touch each other's inside; base spans may overlap.
    starts: list[int] = []
    stops: list[int] = []
    for start, end in sorted((a, b) for _, a, b in base) if added else ():
        if stops and start < stops[-1]:
            stops[-1] = max(stops[-1], end)
        else:
            starts.append(start)
            stops.append(end)
    for p, (kind, start, end) in added:
        at = bisect_left(starts, end)
        if at and stops[at - 1] > start:
            continue
        starts.insert(at, start)
        stops.insert(at, end)
        found.append((kind, start, end, False, p))
    return sorted(found)


FINDINGS = "array<struct<kind:string, start:int, stop:int, base:boolean, score:double>>"
_FINDING = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]
    )
)


def _map(docs: DataFrame, id_col: str, text_col: str, model: Model, name: str, kind: str, arrow, of) -> DataFrame:
    rows = docs.select(F.col(id_col).alias(id_col), text_of(text_col).alias("_text"))

    def run(batches):
        for some in sliced(batches, 512):
            values = [of(t, find_spans(t, model)) for t in some.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(values, arrow)], [id_col, name])

    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, `{name}` {kind}")


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, findings`` per row, findings by kind, then start; places are code points.

    Null texts count as empty and have an empty list; repeated rows and null ids stay rows of
    their own; other columns are not read; an empty table gives no rows.
    """

    def of(text, spans):
        return [dict(kind=KINDS[k], start=a, stop=b, base=s, score=p) for k, a, b, s, p in spans]

    return _map(docs, id_col, text_col, model, "findings", FINDINGS, _FINDING, of)


def redact(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text`` per row: every found span, or run of overlapping ones, replaced by its kind in angle brackets."""

    def of(text, spans):
        out, at = [], 0
        for kind, start, end, _, _ in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
            if start >= at:
                out += [text[at:start], f"<{KINDS[kind].upper()}>"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    return _map(docs, id_col, text_col, model, "text", "string", pa.string(), of)


def joined(findings: Column) -> Column:
    """``kind:start:end`` of findings, comma-joined."""
    return F.array_join(
        F.transform(
            findings,
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string")),
        ),
        ",",
    )


def base_only(findings: Column) -> Column:
    return F.filter(findings, lambda x: x["base"])


def count_of(findings: Column, kind: str) -> Column:
    """Base spans of a kind."""
    return F.size(F.filter(findings, lambda x: x["base"] & (x["kind"] == kind))).cast("long")
