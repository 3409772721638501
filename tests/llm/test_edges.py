"""Nulls, repeated rows, text ids, clashing columns and empty tables, where the other tests leave them out."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import SCHEMA, prose, rows_of
from pyspark.sql import functions as F

import corpus_pipeline
from renown.llm import bpe, fill_in_middle, html_text, lm, packing, personal_data, secrets

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def test_page_text_of_odd_rows(spark):
    page = "<html><body><article><p>" + prose(1, 40) + "</p></article></body></html>"
    rows = [(1, "u", page, "old"), (1, "u", page, "old"), (2, None, None, "old"), (None, "u", "", None), (3, "u", "<p></p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    got = html_text.extract(pages)
    assert got.columns == pages.columns
    texts = Counter((r.page_id, r.main_text) for r in got.collect())
    assert texts == {(1, prose(1, 40)): 2, (2, ""): 1, (None, ""): 1, (3, ""): 1}
    assert html_text.extract(pages.limit(0)).count() == 0


def unpacked(rows):
    """All pieces of all documents: (id, start, ids), each as often as it occurs."""
    found = Counter()
    for r in rows:
        ids = np.frombuffer(r.ids, np.uint32).tolist()
        for d, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            found[d, start, tuple(ids[a:b])] += 1
    return found


@pytest.mark.parametrize("window_tokens", [500, 10**6])
def test_packing_keeps_nulls_and_repeated_rows(spark, edge_docs, edge_pairs, window_tokens):
    docs = edge_docs.withColumns({"key": F.lit("x"), "ids": F.lit("x"), "starts": F.lit(1)})
    v = bpe.vocabulary(BPE_FILE)
    wanted = Counter()
    for i, t in edge_pairs:
        ids = np.frombuffer(v.encode(t), np.uint32).tolist()
        for at in range(0, len(ids), 64):
            wanted[i, at, tuple(ids[at : at + 64])] += 1
    packed = packing.pack_documents(docs, BPE_FILE, length=64, window_tokens=window_tokens)
    assert unpacked(packed.collect()) == wanted
    apart = packing.pack(bpe.encode(docs, BPE_FILE), length=64, window_tokens=window_tokens)
    assert unpacked(apart.collect()) == wanted


def test_packing_fills_rows_behind_the_last_segment(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string")
    (row,) = packing.pack_documents(docs.coalesce(1), BPE_FILE, length=16, pad=7).collect()
    ids, places = (np.frombuffer(x, np.uint32).tolist() for x in (row.ids, row.positions))
    assert row.cu_seqlens[0] == 0 and row.cu_seqlens[-1] == row.n_tokens < 16
    assert ids[row.n_tokens :] == [7] * (16 - row.n_tokens) and set(places[row.n_tokens :]) == {0}


def test_packed_files(spark, edge_docs, no_docs, tmp_path):
    written = packing.write_packed(edge_docs, str(tmp_path / "m"), BPE_FILE, rows=4, length=64).collect()
    rows = Counter()
    for r in written:
        ids = np.frombuffer(r.ids, np.uint32).reshape(r.n_rows, 64)
        for k in range(r.n_rows):
            for d, start, a, b in zip(r.doc_ids[k], r.starts[k], r.cu_seqlens[k], r.cu_seqlens[k][1:]):
                rows[d, start, tuple(ids[k, a:b].tolist())] += 1
    assert rows == unpacked(packing.pack_documents(edge_docs, BPE_FILE, length=64).collect())
    assert packing.write_packed(no_docs, str(tmp_path / "none"), BPE_FILE).count() == 0


def test_text_ids(spark):
    """Ids that are no numbers go through unchanged."""
    docs = spark.createDataFrame([("a-1", "one two"), ("b", None), (None, "x")], "doc_id string, text string")
    ids = {"a-1", "b", None}
    assert {r.doc_id for r in lm.score(docs).collect()} == ids
    assert {d for r in packing.pack_documents(docs, BPE_FILE).collect() for d in r.doc_ids} == {"a-1", None}
    assert {r.doc_id for r in fill_in_middle.digests(fill_in_middle.transform(docs)).collect()} == ids
    assert {r.doc_id for r in personal_data.find(docs, (None,) * 4).collect()} == ids


def test_secret_scan_among_clashing_columns(spark):
    rows = [(1, "token = abcdefghijklmnop", 1, "b", "p"), (1, "token = abcdefghijklmnop", 1, "b", "p"), (2, None, 2, None, None), (None, "AKIA" + "A" * 20, 3, "x", "y")]
    table = spark.createDataFrame(rows, "doc_id long, text string, blob long, body string, path string")
    found, ledger = secrets.scan_versions(table, "doc_id", "text")
    got = Counter((r.path, secrets_of(r.findings)) for r in found.collect())
    assert got == {(1, "assign:0:24"): 2, (2, ""): 1, (None, "access:0:24"): 1}
    assert ledger.columns == ["blob", "rules", "findings"] and ledger.count() == 3


def secrets_of(findings):
    return ",".join(f"{x.kind}:{x.start}:{x.stop}" for x in findings)


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, columns that clash with inner ones, through all stages."""
    same = prose(1, 100)
    pairs = [(1, same), (2, same), (2, same), (3, same + " more"), (4, None), (5, ""), (None, same), (None, None), (6, prose(9, 5000))]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame(rows_of(pairs), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    wanted = bpe.vocabulary(BPE_FILE)
    ids = Counter((r.doc_id, r.n_tokens) for r in got)

    def n(text):
        return len(wanted.encode(text)) // 4

    # of 1, 2 and 3 one text stays; of the empty ones one id; rows without an id cannot be told apart and stay
    assert ids[None, n(same)] == 1 and ids[None, 0] == 1 and ids[6, n(prose(9, 5000))] == 1
    assert len([i for i in got if i.doc_id in (1, 2, 3)]) == 1
    assert len([i for i in got if i.doc_id in (4, 5)]) == 1
    docs = spark.createDataFrame(rows_of(pairs), SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_pipeline_on_an_empty_table(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_small_batches_come_and_go(spark):
    from renown.llm import frames

    before = spark.conf.get(frames.BATCH_SETTING)
    with frames.small_batches(spark):
        assert int(spark.conf.get(frames.BATCH_SETTING)) <= frames.BATCH_ROWS
    assert spark.conf.get(frames.BATCH_SETTING) == before
    assert re.fullmatch(r"\d+", before)


def test_stage_tables_go_when_nobody_needs_them(spark):
    import os

    from renown.llm.frames import Stage

    store = Stage(spark)
    first, second = store.keep(spark.range(3)), store.keep(spark.range(4))
    store.clear(second)
    assert second.count() == 4 and not os.path.exists(f"{store.root}/0") and os.path.exists(f"{store.root}/1")
    with pytest.raises(Exception):
        first.collect()
    store.clear()
    assert not os.path.exists(f"{store.root}/1")
