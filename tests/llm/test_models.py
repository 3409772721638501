"""BPE, packing, near dedup, page text, toxicity, languages and the language model against plain Python."""

import hashlib
import html
import json
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from helpers import SCHEMA, prose, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from renown.llm import bpe, html_text, language_id, lm, near_dedup, packing, toxicity

SF = "/root/testdata/sf0.001"
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
MULTI_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = Tokenizer.from_file(BPE_FILE)


def ids_of(packed):
    return list(memoryview(packed).cast("I"))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_bpe_as_the_library(text):
    v = bpe.vocabulary(BPE_FILE)
    for t in (text, text + "<|endoftext|> x", re.sub(r"\W", "", text) * 40):
        wanted = LIBRARY.encode(t, add_special_tokens=False).ids
        assert ids_of(v.encode(t)) == wanted
        assert v.decode(v.encode(t)) == LIBRARY.decode(wanted, skip_special_tokens=False) == t


def test_bpe_long_words_as_short_ones():
    v = bpe.vocabulary(BPE_FILE)
    for raw in (b"ab" * 60, b"thethethe" * 13, bytes(range(97, 123)) * 4, b"a" * 127):
        assert v._long(raw) == v._short(raw)


def test_bpe_rows(spark, edge_docs, edge_pairs, no_docs):
    coded = bpe.encode(edge_docs, BPE_FILE)
    got = bpe.decode(coded, BPE_FILE).collect()
    wanted = [(i, LIBRARY.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in edge_pairs]
    assert sorted(str((r.doc_id, ids_of(r.ids), r.text)) for r in got) == sorted(map(str, wanted))
    assert bpe.encode(no_docs, BPE_FILE).count() == 0


def brute_best_fit(sizes, length):
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [b for b in bins if sum(sizes[k] for k in b) + sizes[i] <= length]
        tightest = max(fits, key=lambda b: sum(sizes[k] for k in b), default=None)
        if tightest is None:
            bins.append([i])
        else:
            tightest.append(i)
    return bins


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_best_fit(sizes):
    got = packing.best_fit_decreasing(sizes, 20)
    level = lambda bins: sorted(sorted(sizes[i] for i in b) for b in bins)
    assert sorted(i for b in got for i in b) == list(range(len(sizes)))
    assert [sum(x) for x in level(got)] == [sum(x) for x in level(got)] and len(got) == len(brute_best_fit(sizes, 20))
    assert all(sum(sizes[i] for i in b) <= 20 for b in got)


def test_pack_loses_nothing(spark, edge_docs, no_docs, tmp_path):
    coded = bpe.encode(edge_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), BPE_FILE)
    packed = packing.pack(coded, length=64, window_tokens=1000).collect()
    parts = defaultdict(dict)
    for r in packed:
        ids, places = ids_of(r.ids), ids_of(r.positions)
        assert len(ids) == len(places) == 64 and r.n_tokens == r.cu_seqlens[-1]
        for d, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b] == list(range(b - a))
            parts[d][start] = ids[a:b]
    whole = {d: sum((p[k] for k in sorted(p)), []) for d, p in parts.items()}
    assert whole == {r.doc_id: ids_of(r.ids) for r in coded.collect() if r.ids}
    assert packing.pack(bpe.encode(no_docs, BPE_FILE)).count() == 0
    written = packing.write_packed(edge_docs, str(tmp_path / "m"), BPE_FILE, rows=8, length=64).collect()
    assert all(len(r.ids) == len(r.positions) == r.n_rows * 64 * 4 for r in written)


def shingles(text):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(pairs):
    sets = {i: shingles(t) for i, t in pairs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_near_classes(spark, edge_pairs, no_docs):
    base = prose(21, 200).split()
    pairs = [(i, t) for i, t in edge_pairs if i is not None]
    for k in range(60):  # variants of one text, some too far away
        w = list(base)
        for j in range(k % 12):
            w[(j * 17 + k) % 200] = f"edit{k}x{j}"
        pairs.append((1000 + k, " ".join(w)))
    df = spark.createDataFrame(rows_of(pairs + [(None, "x y")]), SCHEMA).repartition(4)
    got = near_dedup.near_classes(df).collect()
    assert len(got) == len(pairs)
    wanted = brute_classes(pairs)
    assert {r.doc_id: r.class_id for r in got} == wanted
    sizes = Counter(wanted[i] for i, _ in pairs)
    assert all(r.class_size == sizes[r.class_id] for r in got)
    assert near_dedup.near_classes(no_docs).count() == 0
    kept = near_dedup.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in wanted if wanted[i] == i} | {None}


def test_repeats_inside_a_text_hide_no_link(spark):
    """A fifth of the shingles a thousand times over leaves the set, and so the link, nearly as it was."""
    pairs = []
    for k in range(8):
        words = prose(70 + k, 104).split()
        pairs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words + words[:24] * 1000))]
    got = near_dedup.near_classes(spark.createDataFrame(rows_of(pairs), SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i - i % 2 for i, _ in pairs} == brute_classes(pairs)


def test_blocks_count_common_shingles(monkeypatch):
    monkeypatch.setattr(near_dedup, "TERMS_AT_ONCE", 7)
    r = np.random.default_rng(5)
    left, right = ([np.unique(r.integers(0, 60, k)).astype(np.uint64) for k in sizes] for sizes in ((0, 9, 40), (30, 1)))
    wanted = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert near_dedup.shared_counts(left, right).tolist() == wanted
    assert not near_dedup.shared_counts(left[:1], right).any()


def test_spanning_pairs_connect_all():
    pairs = [[1, 2], [2, 3], [1, 3], [7, 8], [3, 8], [2, 7]]
    assert near_dedup.spanning(pairs) == [[1, 2], [2, 3], [7, 8], [3, 8]]
    assert near_dedup.spanning([]) == []


def test_signatures_estimate_probability_jaccard():
    a, b = prose(31, 3000), prose(31, 2400) + " " + prose(32, 600)
    owner, shingle, weight = near_dedup.weighted_shingles([a, b, None])
    kept = near_dedup.signatures(owner, shingle, weight, 3, 4096)
    one, two = shingles(a), shingles(b)
    exact = len(one & two) / len(one | two)
    assert abs((kept[0] == kept[1]).mean() - exact) < 0.03 and not kept[2].any()


PAGES = {
    "<html><head><title>T</title></head><body><nav><a>m</a></nav><article><h1>A &amp; B</h1><p><b>One"
    "<br>two<p>x &lt; y</p><aside>ad</aside><ul><li>Of.</li></ul><div class='comments'><p>no</p></div>"
    "</article><footer>f</footer>": "A & B\n\nOne two\n\nx < y\n\nOf.",
    "": "",
    "plain  text\n only": "plain text only",
    "<script>var a='</p>'</script><!-- <p>no</p> -->": "",
    "<div id=menu><a href=x>menu</a></div><div>" + "word " * 30 + "</div><div>end</div>": "word " * 29 + "word\n\nend",
    "<article><p>unclosed <em>tag": "unclosed tag",
    "<p>a &nbsp;b</p><p>c</p>": "a b\n\nc",
}


def test_main_text_of_made_up_pages():
    for page, wanted in PAGES.items():
        assert html_text.main_text(page) == wanted, page
    assert html_text.main_text(None) == ""
    assert len(html_text.main_text("<article>" + "<p>long</p>" * 50_000)) == 6 * 50_000 - 2


def article_of(page):
    inner = page[page.index("<article>") : page.index("</article>")].replace("<br>", " ")
    lines = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|article)>", inner)]
    return "\n\n".join(filter(None, lines))


def test_main_text_of_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = contract.queries()["op10_html_text"](spark, SF).collect()
    assert {r.page_id: (r.text, r.n_chars) for r in got} == {
        i: (article_of(p), len(article_of(p))) for i, p in pages.items()
    }


def held(i, modulus, rest):
    return zlib.crc32(str(i).encode()) % modulus == rest


def test_factorization_machine_learns_a_meeting():
    """One of two terms is harmless, both are not: no sum of weights does it."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (2000, 2)).astype(np.uint8)
    y = (x[:, 0] ^ x[:, 1]).astype(float)
    m = toxicity.train(x, y, np.array([0, 3]), epochs=200)
    s = 0.5 * ((x @ m.vectors) ** 2 - x.astype(float) @ m.vectors**2).sum(1) + m.bias + x @ m.weights
    assert (((s > 0) == y).mean()) > 0.99


def test_toxicity(spark, edge_docs, edge_pairs, no_docs):
    texts = [(k, prose(k, 30) + (" rotten fool rotten" if k % 4 == 0 else "")) for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = [(k, int(k % 4 == 0)) for k, _ in texts] + [(None, 1), (900, None)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    for r in toxicity.toxicity(docs, labels).collect():
        assert r.held_out == held(r.doc_id, 3, 1) and r.predicted == int(r.score >= 0.7)
        assert r.predicted == int(r.doc_id % 4 == 0)
    got = toxicity.toxicity(edge_docs, labels)
    assert got.count() == len(edge_pairs) and got.where("score NOT BETWEEN 0 AND 1").count() == 0
    assert toxicity.toxicity(no_docs, labels).count() == 0
    assert toxicity.without_toxic(edge_docs, labels).columns == edge_docs.columns
    none = toxicity.toxicity(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]


def brute_forward(word, p, pieces):
    total = [1.0]
    for j in range(1, len(word) + 1):
        total.append(sum(total[i] * p.get(word[i:j], 0) for i in range(j)))
    return total[-1]


def test_forward_sums_all_segmentations():
    pieces = [b" ", b"a", b"b", b"ab", b" a", b"bab", b" ab"]
    rng = np.random.default_rng(3)
    p = np.vstack([rng.random((len(pieces), 2)), np.zeros((1, 2))])
    words = [b"abab", b"babb", b"aaab"]
    for at, rows in language_id.by_length(words):
        got = language_id.forward(language_id.Lattice(pieces).grid(rows), p, len(at), rows.shape[1])[-1]
        for k, i in enumerate(at):
            for lang in (0, 1):
                table = {x: p[n, lang] for n, x in enumerate(pieces)}
                assert math.isclose(got[k, lang], brute_forward(b" " + words[i], table, pieces))


def test_language(spark, edge_docs, edge_pairs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs, MULTI_FILE)
    told = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    unseen = [i for i in truth if held(i, 5, 0)]
    assert all(told[i].held_out == held(i, 5, 0) and 0 <= told[i].score <= 1 for i in truth)
    assert sum(told[i].lang_pred == truth[i] for i in unseen) >= 0.95 * len(unseen)
    got = language_id.identify(edge_docs, model).collect()
    assert len(got) == len(edge_pairs)
    assert {r.doc_id for r in got if r.lang_pred == "und"} >= {10, 11, 12}
    assert language_id.identify(no_docs, model).count() == 0
    empty = language_id.fit(no_docs, MULTI_FILE)
    assert {r.lang_pred for r in language_id.identify(edge_docs, empty).collect()} == {"und"}


def log_forward(word, pieces, p):
    """The sum over all segmentations by its definition, in logarithms."""
    index = {x: k for k, x in enumerate(pieces)}
    longest = max(map(len, pieces))
    alpha = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        terms = [
            alpha[i] + math.log(p[index[word[i:j]]])
            for i in range(max(0, j - longest), j)
            if word[i:j] in index and alpha[i] > -math.inf
        ]
        if terms:
            top = max(terms)
            alpha[j] = top + math.log(sum(math.exp(t - top) for t in terms))
    return alpha[-1]


def test_long_words_are_summed_over_all_segmentations():
    """A sentence without blanks, a run of 5,000 letters, and the same sums as for short words."""
    pieces = language_id.read_pieces(MULTI_FILE)
    assert len(set(pieces)) == len(pieces) and not any(p != p.lower() for p in pieces)
    rng = np.random.default_rng(3)
    p = rng.random((len(pieces) + 1, 2))
    p[-1] = 0
    p /= p.sum(0)
    lattice = language_id.Lattice(pieces)
    for text in ("机器学习正在改变我们的世界和生活方式", "донаудампфшифффартсгезелльшафт" * 3, "ab" * 2500, "x"):
        word = b" " + text.encode()
        got = language_id.forward_long(lattice, word, p)
        assert got == pytest.approx([log_forward(word, pieces, p[:, k]) for k in range(2)], rel=1e-9)
    rows = np.frombuffer(b" abcdef", np.uint8).reshape(1, 7)
    short = language_id.forward(lattice.grid(rows), p, 1, 7)[-1][0]
    assert np.log(short) == pytest.approx(language_id.forward_long(lattice, b" abcdef", p))


def test_scores_of_texts_without_blanks():
    """Through the model, beside short words: the text's score is that of its words, whatever their length."""
    pieces = language_id.read_pieces(MULTI_FILE)
    p = np.random.default_rng(4).random((len(pieces) + 1, 2))
    p[-1] = 0
    model = language_id.LanguageModel(["a", "b"], pieces, p / p.sum(0))
    long, short = "机器学习正在改变我们的世界和生活方式", "kurz"
    together = model.scores([f"{long} {short}, {long}", long, short, ""])
    assert together[0] == pytest.approx(2 * together[1] + together[2])
    assert together[3].tolist() == [0, 0]
    whole = [log_forward(b" " + long.encode(), pieces, model.p[:, k]) for k in range(2)]
    assert together[1] == pytest.approx(whole)


@given(st.text(max_size=60))
def test_stretches_lie_between_characters(text):
    raw = text.encode("utf-8", "replace")
    cut = language_id.stretches(raw)
    assert b"".join(cut) == raw and all(len(x) <= language_id.WORD for x in cut)
    assert all(x.decode("utf-8") is not None for x in cut)


def test_bounded_rows(spark):
    from renown.llm.frames import bounded_rows

    rows = spark.createDataFrame([(i % 50, "same") for i in range(500)] + [(None, None)] * 9, "a long, b string")
    assert bounded_rows(rows, 20).count() == 20 and bounded_rows(rows, 1000).count() == 51
    assert bounded_rows(rows.limit(0), 5).count() == 0
    once, again = (sorted(map(str, bounded_rows(rows.repartition(n), 20).collect())) for n in (1, 7))
    assert once == again


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w] + [None]


def plain_score(text, counts, c, p):
    """The probability of a text by loops over its tokens: group, class in the group, word in the class."""

    def softmax(z):
        e = [math.exp(x - max(z)) for x in z]
        return [x / sum(e) for x in e]

    total, near, far = 0.0, len(c.mass), len(c.mass)
    for word in words_of(text):
        raw = lm.END if word is None else word.encode()
        ctx = [float(a * x + b * y) for a, x, b, y in zip(p.vectors[near], p.places[0], p.vectors[far], p.places[1])]
        target = c.of(raw)
        group, place = divmod(target, c.size)
        z = [sum(x * y for x, y in zip(ctx, map(float, g))) + float(b) for g, b in zip(p.groups, p.group_bias)]
        total += math.log10(softmax(z)[group])
        first = group * c.size
        z = [
            sum(x * y for x, y in zip(ctx, map(float, p.outputs[k]))) + float(p.bias[k])
            for k in range(first, first + c.size)
        ]
        total += math.log10(softmax(z)[place])
        if raw not in c.own:
            total += math.log10((counts[word] + 0.5) / c.mass[target])
        near, far = target, near
    return total


@pytest.mark.parametrize("table_words, classes", [(lm.TABLE_WORDS, lm.LEAST_CLASSES), (20, 10)])
def test_scores(spark, edge_docs, edge_pairs, table_words, classes, monkeypatch):
    """Counts and both scores against plain Python, with all words in every task and with most of them joined."""
    seen, modelled = {}, lm._modelled
    monkeypatch.setattr(lm, "_modelled", lambda coded, c, p: seen.update(c=c, p=p) or modelled(coded, c, p))
    options = {"table_words": table_words, "least_classes": classes, "classes_per_root": 0}
    got = lm.score(edge_docs, **options).collect()
    counts = Counter(w for i, t in edge_pairs if not held("" if i is None else i, 5, 1) for w in words_of(t))
    total, distinct = sum(counts.values()), len(counts)
    wanted = []
    for i, t in edge_pairs:
        ws = words_of(t)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        wanted.append((str(i), held("" if i is None else i, 5, 1), len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 6)))
    rows = [
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
    ]
    assert sorted(rows) == sorted(wanted)
    short = [(i, t) for i, t in edge_pairs if len(t or "") < 5000]
    plain = {(i, len(words_of(t))): plain_score(t, counts, **seen) for i, t in short}
    for r in got:
        if (r.doc_id, r.n_tokens) in plain and r.n_tokens < 5000:
            assert r.score == pytest.approx(plain[r.doc_id, r.n_tokens], rel=1e-4, abs=1e-4)


def test_model_is_normalised(spark):
    """Over all known words and the unseen ones of every shared class, after any two classes."""
    rows = [(w.encode(), n) for w, n in [("a", 50), ("b", 20), ("running", 5), ("going", 3), ("x", 1), ("ö", 2)]]
    counts = spark.createDataFrame([*rows, (lm.END, 9)], "word binary, n long")
    vocabulary = lm.frequent(counts, 3)
    c = lm.classes(counts, vocabulary, 3)
    assert set(c.own) == {b"a", b"b", lm.END} and c.n == 3 + len(c.shared)
    p = lm.start(c)
    p = lm.Parameters(*(x + np.random.default_rng(1).normal(0, 0.5, x.shape).astype(np.float32) * (x > -100) for x in p.all))
    for near, far in [(0, 1), (c.n - 1, 0), (len(c.mass), len(c.mass))]:
        mass = 0.0
        for word, n in [*rows, (lm.END, 9)]:
            k = c.of(word)
            share = 1 if word in c.own else (n + 0.5) / c.mass[k]
            mass += share * 10 ** lm.log10_probability(p, c.size, *(np.array([x]) for x in (k, near, far)))[0]
        for k in c.shared:
            mass += 0.5 / c.mass[k] * 10 ** lm.log10_probability(p, c.size, *(np.array([x]) for x in (k, near, far)))[0]
        assert mass == pytest.approx(1, abs=1e-5)


def _made(n_classes, size, seed=3):
    """Classes of falling mass, not all groups full, and parameters that are not those of the start."""
    groups = -(-n_classes // size)
    mass = np.zeros(groups * size)
    mass[:n_classes] = 1000 / (np.arange(n_classes) + 1)
    c = lm.Classes({lm.END: 0}, np.array([n_classes - 1]), mass, size)
    p = lm.start(c)
    rng = np.random.default_rng(seed)
    return c, lm.Parameters(*((x + rng.normal(0, 0.3, x.shape) * (x > -100)).astype(np.float32) for x in p.all))


def test_scoring_holds_few_logits_at_once():
    """Logits of many tokens times all groups took 52 MB and more, and each pass over them went to memory."""
    c, p = _made(40_000, 200)
    rng = np.random.default_rng(5)
    target = np.minimum(rng.geometric(0.001, lm.SCORED) - 1, c.n - 1)
    near, far = rng.integers(0, len(c.mass) + 1, (2, lm.SCORED))
    tracemalloc.start()
    logs = lm.log10_probability(p, c.size, target, near, far)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45_000_000

    def softmax(layer, bias, context, chosen):
        z = layer.astype(float) @ context + bias
        return z[chosen] - z.max() - math.log(np.exp(z - z.max()).sum())

    for k in [*range(0, lm.SCORED, 997), lm.SCORED - 1]:
        context = (p.vectors[near[k]] * p.places[0] + p.vectors[far[k]] * p.places[1]).astype(float)
        group, place = divmod(target[k], c.size)
        of = slice(group * c.size, (group + 1) * c.size)
        wanted = softmax(p.groups, p.group_bias, context, group) + softmax(p.outputs[of], p.bias[of], context, place)
        assert logs[k] == pytest.approx(wanted / math.log(10), abs=1e-4)
    assert len(lm.log10_probability(p, c.size, target[:0], near[:0], far[:0])) == 0


def test_a_step_sums_the_gradients_of_each_row():
    """Every row moves by the sum over its uses, those of the padding column stay zero."""
    c, p = _made(300, 20)
    trainer = lm.Trainer(c, p, 1)
    rng = np.random.default_rng(6)
    rows, of = np.minimum(rng.geometric(0.05, 3000) - 1, 299), rng.integers(0, 500, 3000)
    source, factor = rng.normal(size=(500, lm.WIDTH + 2)).astype(np.float32), rng.normal(size=3000).astype(np.float32)
    source[:, -1] = 0
    before = trainer.values[3].astype(float)
    assert np.array_equal(before[:, : lm.WIDTH + 1], np.column_stack([p.outputs, p.bias]).astype(float))
    trainer._step(3, rows, of, source, factor, 500)
    grad = np.zeros(before.shape)
    np.add.at(grad, rows, source[of].astype(float) * factor[:, None])
    grad /= math.sqrt(500)
    wanted = before - 0.05 * grad / np.sqrt(1e-3 + grad**2)
    assert np.allclose(trainer.values[3], wanted, atol=1e-4) and not trainer.values[3][:, -1].any()
    assert np.array_equal(trainer.used[3], np.bincount(rows, minlength=len(c.mass)))


def test_classes_grow_with_the_words(spark):
    def made(distinct):
        counts = spark.range(distinct).selectExpr("CAST(concat('w', id) AS binary) AS word", "1000000 DIV (id + 1) + 1 AS n")
        most = int(lm.CLASSES_PER_ROOT * distinct**0.5)
        return lm.classes(counts, lm.frequent(counts, lm.TABLE_WORDS), most).n

    assert made(40_000) > 1.5 * made(10_000) > 900


@pytest.fixture(scope="module")
def sums_by_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {}
    for n in (1, 16, 256):
        held_out = lm.score(docs.repartition(n)).where("held_out")
        out[n] = held_out.agg(F.sum("score"), F.sum("base_score")).first()
    return out


def test_model_gains_the_same_whatever_the_partitions(sums_by_partitions):
    gains = {n: score - base for n, (score, base) in sums_by_partitions.items()}
    assert gains[1] > 10_000
    assert all(abs(g - gains[1]) < 0.01 * gains[1] for g in gains.values())


def test_scores_of_nothing_and_without_training_rows(spark, no_docs):
    assert lm.score(no_docs).count() == 0
    held_out = next(i for i in range(100) if held(i, 5, 1))
    (row,) = lm.score(spark.createDataFrame([(held_out, "a b")], "doc_id long, text string")).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score < 0


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == columns, name
        assert after.exceptAll(docs).count() == 0, name
        docs = spark.createDataFrame(after.collect(), after.schema)
    left = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: ids_of(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: LIBRARY.encode(t or "", add_special_tokens=False).ids for i, t in left.items()}
    bare = {re.sub(r"\s", "", t) for t in left.values()}
    assert len(bare) == len(left)
    assert brute_classes(list(left.items())) == {i: i for i in left}


def test_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in contract.queries()["op1_bpe"](spark, SF).collect():
        ids = np.array(LIBRARY.encode(docs[r.doc_id], add_special_tokens=False).ids, "<u4")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_vocabulary_file_has_the_pattern():
    with open(BPE_FILE, encoding="utf-8") as f:
        assert json.load(f)["pre_tokenizer"]["use_regex"]
