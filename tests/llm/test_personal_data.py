"""Personal data against plain patterns, and judges on planted spans."""

import random
import re

import numpy as np
import pytest
from helpers import prose
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from renown.llm.boosting import calibrate, fit_trees, threshold_for
from renown.llm.personal_data import (
    KINDS,
    base_only,
    base_spans,
    candidates,
    count_of,
    find,
    find_spans,
    fit,
    joined,
    passes_luhn,
    redact,
)

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((k, *m.span()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.text("0123456789.-+@ ()ab%é\n", max_size=60))
@example("a@b@c.d.e@f.g")
@example("x.@-.-.a@b..c")
@example("1.2.3.4.5.6.7.8 1.2.3 0001.255.256.1 00001.2.3.255")
@example("+1 (234) 555-1234 4111111111111111 4111111111111111")
@example("4111-1111 1111-1111 +4111111111111111111")
@example("0" * 40 + " " + "0" * 18)
def test_base_spans(text):
    assert base_spans(text) == brute(text)


@given(st.text("0123456789", min_size=1, max_size=30))
def test_luhn(digits):
    assert passes_luhn(digits) == luhn(digits)


def with_check_digit(r):
    head = "4" + "".join(r.choice("0123456789") for _ in range(14))
    return next(head + d for d in "0123456789" if luhn(head + d))


def planted(seed, n):
    """Texts with data of each kind, and numbers and codes that are none."""
    r = random.Random(seed)
    for k in range(n):
        card, bad = with_check_digit(r), with_check_digit(r)
        spans = [
            f"{r.choice('abcde')}{prose(k, 1)}.{r.randrange(99)}@mail{r.randrange(9)}.example.com",
            ".".join(str(r.randrange(256)) for _ in range(4)),
            card,
            f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}",
            bad[:-1] + str((int(bad[-1]) + 5) % 10),
            str(r.randrange(10**6, 10**9)),
            f"v{r.randrange(9)}.{r.randrange(9)}.{r.randrange(9)}",
            f"{r.randrange(300, 999)}.1.2.{r.randrange(300, 900)}",
        ]
        words = prose(seed * 1000 + k, 60).split()
        for s in r.sample(spans, 4):
            words.insert(r.randrange(len(words)), s)
        yield k, " ".join(words)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(list(planted(1, 700)), "doc_id long, text string")
    return fit(docs)


def test_every_kind_has_a_judge(model):
    assert all(j is not None and j.threshold <= 1 for j in model)


def test_judges_add_what_the_rules_lose(model):
    r = random.Random(5)
    added = {"card": 0, "phone": 0, "email": 0}
    for k in range(40):
        a, b = with_check_digit(r), with_check_digit(r)
        phone = f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}"
        lead = prose(k, 9)
        text = f"{lead} {a} {b} {prose(k, 5)}"
        assert not brute(text)
        added["card"] += [s[:3] for s in find_spans(text, model)] == [
            (2, len(lead) + 1, len(lead) + 17),
            (2, len(lead) + 18, len(lead) + 34),
        ]
        text = f"{lead} {phone} {a} {prose(k, 5)}"
        added["phone"] += (3, len(lead) + 1, len(lead) + 1 + len(phone)) in [s[:3] for s in find_spans(text, model)]
        text = f"{lead} bob.{k} (at) mail{k % 9} (dot) example (dot) com {prose(k, 5)}"
        added["email"] += any(s[0] == 0 and text[s[1] : s[2]].startswith("bob.") for s in find_spans(text, model))
    assert min(added.values()) >= 32, added


def test_judges_leave_other_numbers_alone(model):
    r = random.Random(6)
    wrong = 0
    for k in range(100):
        card = with_check_digit(r)
        bad = card[:-1] + str((int(card[-1]) + 1 + k % 9) % 10)
        text = f"{prose(k, 5)} {bad} {prose(k, 3)} {r.randrange(10**8)} of {r.randrange(300, 900)}.7.8.999 at {prose(k, 9)}"
        wrong += len(find_spans(text, model))
    assert wrong <= 2


def test_base_spans_always_stay(model):
    for _, text in planted(2, 100):
        found = find_spans(text, model)
        assert [s[:3] for s in found if s[3]] == sorted(base_spans(text))
        added = [s for s in found if not s[3]]
        assert not [
            (x, y) for x in added for y in found if x is not y and x[1] < y[2] and y[1] < x[2]
        ]


def test_edges_through_spark(model, edge_docs, edge_pairs, no_docs, spark):
    """Nulls, empties, repeated rows, long texts, clashing columns, no rows."""
    extra = [(20, "mail a.b@c.de now"), (20, "mail a.b@c.de now"), (21, "1 2 3 4 5 " * 20_000), (22, "@" * 5000)]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    docs = edge_docs.unionByName(more, allowMissingColumns=True).withColumn("findings", F.lit(1))
    found = find(docs, model)
    got = found.select(
        "doc_id",
        *[count_of(F.col("findings"), k) for k in KINDS],
        joined(base_only(F.col("findings"))),
        joined(F.col("findings")),
    ).collect()
    wanted = []
    for i, t in edge_pairs + extra:
        spans = brute(t)
        wanted.append((i, *[sum(s[0] == k for s in spans) for k in range(4)], ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(wanted, key=str)
    assert find(no_docs, model).count() == 0
    assert [r.text for r in redact(docs.where("doc_id = 20"), model).collect()] == ["mail <EMAIL> now"] * 2


def test_nothing_to_learn_from(spark, no_docs):
    none = fit(no_docs)
    assert none == (None,) * 4
    assert [s[:4] for s in find_spans("x a.b@c.de", none)] == [(0, 2, 10, True)]


def test_the_bounds_hold(spark):
    docs = spark.createDataFrame(list(planted(3, 200)), "doc_id long, text string")
    assert len(fit(docs, max_rows=50, max_examples=60)) == 4


def test_candidates_are_linear_in_the_text():
    assert sum(1 for _ in candidates("1 " * 50_000)) < 50_000 * 30


def test_trees_learn_an_interaction():
    r = np.random.default_rng(1)
    x = r.integers(0, 32, (4000, 6))
    y = ((x[:, 1] > 15) ^ (x[:, 4] > 9)).astype(float)
    trees = fit_trees(x[:2000], y[:2000])
    assert ((trees.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.97


def test_calibration_and_threshold():
    r = np.random.default_rng(2)
    margin = r.normal(0, 2, 20_000)
    y = (r.random(20_000) < 1 / (1 + np.exp(-(0.5 * margin - 1)))).astype(float)
    fitted = calibrate(margin, y)
    assert abs(fitted.slope - 0.5) < 0.05 and abs(fitted.offset + 1) < 0.1
    p = fitted.probability(margin)
    at = threshold_for(p, y, 0.8, 20)
    assert y[p >= at].mean() >= 0.8
    separate = calibrate(np.array([-5.0] * 50 + [5.0] * 50), np.array([0.0] * 50 + [1.0] * 50))
    assert 0 < separate.slope < 5
    assert threshold_for(np.array([0.9, 0.1]), np.array([1.0, 0.0]), 0.99, 20) > 1


def test_every_row_gives_examples(spark, monkeypatch):
    """No row is left out, however many there are."""
    from renown.llm import personal_data

    seen = []

    def counted(chosen):
        seen.append(chosen.count())
        return spark.createDataFrame([], personal_data._EXAMPLE)

    monkeypatch.setattr(personal_data, "_examples", counted)
    docs = spark.range(70_000).selectExpr("id AS doc_id", "concat('n ', id) AS text")
    assert fit(docs) == (None,) * 4 and seen == [70_000]


def test_trees_of_a_table_are_those_of_its_rows(spark):
    """Whatever its partitions, and with equal rows as one."""
    from renown.llm.boosting import grow_trees

    r = np.random.default_rng(3)
    kinds, x = r.integers(0, 2, 3000), r.integers(0, 32, (3000, 3))
    x[2000:] = x[:1000]
    y = ((x[:, 0] > 15) ^ (x[:, 2] > 9) ^ (r.random(3000) < 0.1)).astype(int)
    rows = spark.createDataFrame(
        [(int(k), bytes(a.astype(np.uint8)), int(b)) for k, a, b in zip(kinds, x, y)], "kind int, x binary, y int"
    )
    rows = rows.groupBy("kind", "x").agg(F.sum("y").alias("yes"), F.count("*").alias("n")).cache()
    shares = {k: float(y[kinds == k].mean()) for k in (0, 1)}
    grown = [grow_trees(t, shares, 3, trees=2, depth=3) for t in (rows.coalesce(1), rows.repartition(5))]
    for k in (0, 1):
        local = fit_trees(x[kinds == k], y[kinds == k].astype(float), trees=2, depth=3)
        for found in grown:
            assert np.allclose(found[k].margin(x), local.margin(x), atol=1e-6)
        assert all(np.array_equal(getattr(grown[0][k], a), getattr(grown[1][k], a)) for a in ("feature", "cut", "value"))
