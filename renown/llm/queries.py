"""The operators on the driver tables, under their production parameters."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    fill_in_middle,
    html_text,
    language_id,
    lm,
    near_dedup,
    packing,
    personal_data,
    secrets,
    toxicity,
    vector_codes,
)
from renown.llm.frames import ship, table


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they stand for, as digests."""
    coded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary_path())
    return bpe.decode(coded, vocabulary_path()).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from two thirds of the labels."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of those with one."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, vocabulary_path("byte_bpe_multi_50k.tiktoken"))
    return language_id.identify(docs, model)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document."""
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed sequences of token ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of equal texts stays, for every document."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; each document is the only version of its path."""
    found, _ = secrets.scan_versions(table(spark, sf_dir, "documents"), "doc_id", "text")
    spans = secrets.joined_spans(F.col("findings"))
    kinds = [secrets.count_of(F.col("findings"), r.kind).alias(f"n_{r.kind}") for r in secrets.RULES]
    return found.select(
        F.col("path").alias("doc_id"), *kinds, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and log-bilinear log probabilities of every document."""
    return lm.score(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item inside a document, with its exact containment."""
    return decontaminate.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    text = F.col("main_text")
    return found.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings under codebooks fitted to all of them."""
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_errors(coded).select(
        "vec_id",
        vector_codes.hex_code(F.col("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and rearranged for infilling, and its text rebuilt from that, as digests."""
    return fill_in_middle.digests(fill_in_middle.transform(table(spark, sf_dir, "documents")))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: what the fixed rules find, and what the judges add."""
    docs = table(spark, sf_dir, "documents")
    found = personal_data.find(docs, personal_data.fit(docs))
    base = personal_data.base_only(F.col("findings"))
    kinds = [personal_data.count_of(F.col("findings"), k).alias(f"n_{k}") for k in personal_data.KINDS]
    return found.select(
        "doc_id",
        *kinds,
        F.sha2(personal_data.joined(base), 256).alias("base_sha256"),
        personal_data.joined(F.col("findings")).alias("spans"),
    )


def shipped(query):
    """The query, with this package sent to the workers first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


LLM_QUERIES = {
    f.__name__: shipped(f)
    for f in (
        op1_bpe,
        op2_toxicity,
        op3_language_id,
        op4_near_dedup,
        op5_packing,
        op6_exact_dedup,
        op7_secret_scan,
        op8_lm_scores,
        op9_decontamination,
        op10_html_text,
        op11_vector_codes,
        op12_fill_in_middle,
        op13_personal_data,
    )
}



def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """One common table per assignment and per move of the entries."""

    def assign(k: int) -> str:
        return f"""
        a{k} AS MATERIALIZED (
            SELECT rid, p.part, min({{'d': list_sum(list_transform(range(1, len(p.x) + 1),
                   lambda i: (p.x[i] - e.x[i]) * (p.x[i] - e.x[i]))), 'e': e.entry}}) AS best
            FROM p JOIN e{k} AS e ON p.part = e.part GROUP BY rid, p.part)"""

    def move(k: int) -> str:
        return f"""
        s{k} AS MATERIALIZED (
            SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos)::BIGINT[] AS x
            FROM (SELECT a.part, a.best.e AS entry, pos, sum(p.x[pos]) AS s, count(*) AS n
                  FROM a{k - 1} AS a JOIN p USING (rid, part), range(1, (SELECT max(len(x)) FROM p) + 1) AS r(pos)
                  GROUP BY ALL) GROUP BY part, entry),
        e{k} AS MATERIALIZED (
            SELECT part, entry, coalesce(s.x, e.x) AS x
            FROM e{k - 1} AS e LEFT JOIN s{k} AS s USING (part, entry))"""

    steps = [f"{assign(k - 1)},{move(k)}" for k in range(1, rounds + 1)] + [assign(rounds)]
    return f"""
        WITH k AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
                   list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (
            SELECT rid, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x
            FROM k, range({parts}) AS r(part)),
        e0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, x FROM p WHERE rid <= {entries}),
        {",".join(steps)},
        c AS (
            SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
            FROM a{rounds} GROUP BY rid),
        b AS (
            SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
            FROM e{rounds})
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM k JOIN c USING (rid), b
    """


LLM_ORACLES = {
    "op11_vector_codes": _vector_codes_sql(),
    "op12_fill_in_middle": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || doc_id) AS h FROM documents),
        u AS (
            SELECT doc_id, x, length(x)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                   ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
        c AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90
                        THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
        s AS (
            SELECT *, '<P>' || substring(x, 1, a) AS p, '<M>' || substring(x, a + 1, b - a) AS m,
                   '<S>' || substring(x, b + 1) AS q FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN p || q || m ELSE q || p || m END) AS output_sha256,
               sha256(x) AS restored_sha256 FROM s
    """,
    "op6_exact_dedup": r"""
        WITH bare AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, text_sha256
        FROM bare WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
    """,
    "op7_secret_scan": r"""
        WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS x FROM documents),
        m AS (
            SELECT r, 0 AS rank, 'assign' AS kind, 12 AS least, regexp_extract_all(x, '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS whole,
                   regexp_extract_all(x, '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) AS part, regexp_split_to_array(x, '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS gaps FROM t
            UNION ALL
            SELECT r, 1, 'access', 18, regexp_extract_all(x, 'AKIA[A-Z0-9]+'), regexp_extract_all(x, 'AKIA[A-Z0-9]+'), regexp_split_to_array(x, 'AKIA[A-Z0-9]+') FROM t
            UNION ALL
            SELECT r, 2, 'hex', 16, regexp_extract_all(x, '[0-9a-f]{16,}'), regexp_extract_all(x, '[0-9a-f]{16,}'), regexp_split_to_array(x, '[0-9a-f]{16,}') FROM t),
        h AS (
            SELECT r, rank, kind, least, unnest(range(1, len(whole) + 1)) AS k, unnest(list_transform(whole, lambda s: length(s))) AS size,
                   unnest(list_transform(part, lambda s: length(s))) AS judged,
                   unnest(list_transform(gaps[:len(whole)], lambda s: length(s))) AS gap FROM m WHERE len(whole) > 0),
        s AS (
            SELECT *, sum(gap + size) OVER (PARTITION BY r, rank ORDER BY k) AS stop FROM h),
        f AS (
            SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
                   string_agg(kind || ':' || (stop - size) || ':' || stop, ',' ORDER BY stop - size, rank) AS spans
            FROM s WHERE judged >= least GROUP BY r)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM t LEFT JOIN f USING (r)
    """,
    "op9_decontamination": r"""
        WITH w AS (
            SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
                   '[^\pL\pM\pN]+'), lambda x: x <> '') AS ws FROM documents
            UNION ALL
            SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
                   '[^\pL\pM\pN]+'), lambda x: x <> '') FROM benchmark),
        p AS (
            SELECT side, id, CASE WHEN len(ws) >= 5 THEN ws
                   ELSE list_resize(ws, 5, '') END AS ws FROM w WHERE len(ws) > 0),
        s AS (
            SELECT DISTINCT side, id, array_to_string(ws[k:k + 4], ' ') AS sh
            FROM (SELECT side, id, ws, unnest(range(1, len(ws) - 3)) AS k FROM p)),
        n AS (SELECT id AS item_id, count(*) AS n_shingles FROM s WHERE side = 'i' GROUP BY id),
        c AS (
            SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
            FROM s AS d JOIN s AS i ON d.sh = i.sh AND d.side = 'd' AND i.side = 'i' GROUP BY d.id, i.id)
        SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
        FROM c JOIN n USING (item_id) WHERE n_shared / n_shingles >= 0.8
    """,
}
