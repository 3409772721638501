"""Fill-in-middle over frames against plain strings."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from renown.llm.fill_in_middle import Frames, Writer, digests, original_ranges, pack, rearrange, texts, transform


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    """The definition, on whole strings."""
    text = text or ""
    key = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    p, m, s = "<P>" + text[:a], "<M>" + text[a:b], "<S>" + text[b:]
    form = "spm" if h4 % 100 < 20 else "psm"
    return (doc_id, n, form, a, b - a, s + p + m if form == "spm" else p + s + m)


@pytest.mark.parametrize("frame_units", [1 << 14, 5, 1])
def test_digests(edge_docs, edge_pairs, frame_units):
    """Every edge row: null, empty, long, repeated, markers, columns of clashing names."""
    got = sorted(map(tuple, digests(transform(edge_docs, frame_units=frame_units)).collect()), key=str)
    wanted = [(*brute(i, t)[:5], sha(brute(i, t)[5]), sha(t or "")) for i, t in edge_pairs]
    assert got == sorted(wanted, key=str)


def test_texts_and_all_forms(spark):
    pairs = [(k, f"text {k} of <some é😀 kind> " * (k % 7)) for k in range(300)]
    pairs += [(900, "has <M> inside"), (901, "<P"), (902, "S>"), (903, "<<S<P")]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    moved = transform(docs, frame_units=7)
    wanted = [brute(*p) for p in pairs]
    assert {w[2] for w in wanted} == {"plain", "psm", "spm"}
    out = {r.doc_id: (r.form, r.text) for r in texts(moved).collect()}
    assert out == {w[0]: (w[2], w[5]) for w in wanted}
    assert {(r.doc_id, r.text) for r in texts(moved, restored=True).collect()} == set(pairs)


def test_nothing(no_docs):
    none = digests(transform(no_docs))
    assert none.count() == 0 and none.columns[-2:] == ["output_sha256", "restored_sha256"]


def test_text_ids(spark):
    docs = spark.createDataFrame([("x-1", "some text")], "doc_id string, text string")
    assert digests(transform(docs)).first()[0] == "x-1"


@settings(max_examples=200, deadline=None)
@given(st.text("<>PSMab\n", max_size=40), st.integers(0, 40), st.integers(0, 40), st.integers(1, 9), st.booleans())
def test_rebuilt_from_output_and_form(text, one, two, frame_units, psm):
    """Beside any text without a marker, cut anywhere, also within what looks like one."""
    for marker in ("<P>", "<S>", "<M>"):
        text = text.replace(marker, "")
    if any(m in text for m in ("<P>", "<S>", "<M>")):
        return
    a, b = sorted((min(one, len(text)), min(two, len(text))))
    form = "psm" if psm else "spm"
    held = pack(text, frame_units)
    assert "".join(held.stream()) == text and held.units == len(text)
    out = rearrange(held, form, a, b, frame_units)
    p, s, m = "<P>" + text[:a], "<S>" + text[b:], "<M>" + text[a:b]
    assert "".join(out.stream()) == (p + s if psm else s + p) + m
    assert out.digest(*original_ranges(out, form)) == sha(text)


def test_only_cut_frames_are_opened(monkeypatch):
    held = pack("".join(chr(97 + k % 26) for k in range(1000)), 10)
    opened = []
    real = Frames.open
    monkeypatch.setattr(Frames, "open", lambda self, k: opened.append(k) or real(self, k))
    out = Writer(10)
    out.copy(held, 15, 987)
    assert sorted(opened) == [1, 98]
    assert out.done().units == 972
