"""Product codes against exhaustive integer search."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from renown.llm.vector_codes import (
    compress,
    hex_code,
    nearest,
    transform,
    walsh_order,
    with_label_errors,
)

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, id string, v string"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [
        (i, [math.floor(4096 * x) for x in v], lab)
        for i, v, lab in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : p * w + w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            found = [
                min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p]))
                for p in range(parts)
            ]
            out.append(([k for _, k in found], sum(d for d, _ in found)))
        return out

    for _ in range(rounds):
        members = defaultdict(list)
        for c, (codes, _) in zip(cut, assign()):
            for p, k in enumerate(codes):
                members[p, k].append(c[p])
        for (p, k), parts_of in members.items():
            books[p][k] = [sum(x) // len(parts_of) for x in zip(*parts_of)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    per_label = defaultdict(int)
    coded = assign()
    for (_, _, lab), (_, e) in zip(kept, coded):
        per_label[lab] += e
    return digest, sorted(
        ((i, "".join(f"{k:02x}" for k in codes), e, per_label[lab]) for (i, _, lab), (codes, e) in zip(kept, coded)),
        key=str,
    )


def run(spark, rows):
    """The rows with null columns and columns whose names clash with inner ones."""
    df = spark.createDataFrame([(*r, None, "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    coded, books = compress(df)
    out = with_label_errors(coded).select("vec_id", hex_code(F.col("code")), "error", "label_error")
    return (books.digest() if books else None), sorted(map(tuple, out.collect()), key=str)


def vectors(seed, n, size, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) for _ in range(size)], r.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize(("size", "spread"), [(64, 0.1), (40, 1.0), (8, 0.001), (24, 4e4)])
def test_equals_exhaustive_search(spark, size, spread):
    """Also parts padded from 5 and 3, many ties, and numbers beyond 64-bit squares."""
    rows = vectors(size, 150, size, spread)
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    """Nulls, NaN, infinities, repeated ids and rows, null ids, zeros, equal vectors."""
    rows = vectors(1, 30, 16)
    rows += [(31, None, 1), (32, [None] * 16, 1), (33, [math.nan] * 16, 1), (34, [-math.inf] * 16, 2)]
    rows += [(5, rows[5][1], 1), (5, rows[6][1], None), (None, rows[7][1], 2), (0, [0.0] * 16, 1), rows[3]]
    assert run(spark, rows) == brute(rows)


def test_few_and_no_vectors(spark):
    rows = vectors(2, 3, 16)
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == (None, [])


def test_other_lengths_have_no_code(spark):
    rows = vectors(3, 20, 16)
    odd = [(100, [0.5] * 24, 1), (-1, [0.5] * 5, 1), (101, [], 1)]
    digest, got = run(spark, rows + odd)
    wanted_digest, wanted = brute(rows)
    assert digest == wanted_digest
    assert [g[:3] for g in got if g[0] not in (100, -1, 101)] == [w[:3] for w in wanted]
    assert {g[:3] for g in got if g[0] in (100, -1, 101)} == {(100, None, None), (-1, None, None), (101, None, None)}


def test_sequency_order():
    """Row k of the ordered matrix changes its sign k times."""
    for width in (1, 2, 8, 64):
        rows = transform(np.eye(width, dtype=np.int64)).T
        assert [(np.diff(r) != 0).sum() for r in rows] == list(range(width))
        assert len(set(walsh_order(width))) == width


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 9), st.integers(1, 20), st.integers(0, 10**6))
def test_nearest(size, entries, seed):
    r = np.random.default_rng(seed)
    x, e = r.integers(-4, 5, (50, size)), r.integers(-4, 5, (entries, size))
    at, scaled = nearest(transform(x), transform(e))
    whole = ((x[:, None, :] - e[None]) ** 2).sum(axis=2)
    assert (at == whole.argmin(axis=1)).all()
    width = transform(x).shape[1]
    assert (scaled == whole.min(axis=1) * width).all()
