"""The same questions in plain SQL over the driver tables."""

from __future__ import annotations

OBS_SALES = """obs AS (
  SELECT c_name AS entity_name, CAST(c_custkey AS VARCHAR) AS entity_id,
         o_orderpriority AS source,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS snapshot_date,
         CAST(FLOOR(MAX(o_totalprice) / 1000) AS BIGINT) AS score,
         COUNT(*) AS reach,
         CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS volume,
         concat_ws(', ', lower(c_mktsegment), MIN(o_orderstatus)) AS tags
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY c_name, c_custkey, o_orderpriority,
           CAST(date_trunc('year', o_orderdate) AS DATE), c_mktsegment)"""

OBS_EVENTS = """obs AS (
  SELECT concat('User ', CAST(user_id AS VARCHAR)) AS entity_name,
         CAST(user_id AS VARCHAR) AS entity_id, event_type AS source,
         CAST(date_trunc('week', ts) AS DATE) AS snapshot_date,
         CAST(FLOOR(MAX(value)) AS BIGINT) AS score,
         COUNT(*) AS reach,
         CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS volume,
         concat('k', MIN(json_extract_string(props, '$.k'))) AS tags
  FROM events GROUP BY user_id, event_type, CAST(date_trunc('week', ts) AS DATE))"""

LATEST = "latest AS (SELECT * FROM obs WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM obs))"
SALES_LATEST = f"WITH {OBS_SALES}, {LATEST}"

FAULTY = f"""{OBS_EVENTS}, faulty_once AS (
  SELECT * REPLACE (score - 50 AS score, NULLIF(entity_id, '7') AS entity_id)
  FROM obs),
faulty AS (
  SELECT * FROM faulty_once
  UNION ALL SELECT * FROM faulty_once WHERE entity_id LIKE '%3'),
thin AS (SELECT * FROM faulty WHERE source <> 'signup' OR entity_id < '5'),
expected AS (
  SELECT DISTINCT concat('User ', CAST(user_id AS VARCHAR)) AS entity_name FROM events
  WHERE concat('User ', CAST(user_id AS VARCHAR)) NOT LIKE '%9'),
newest AS (SELECT * FROM thin WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM thin))"""
WITH_FAULTY = f"WITH {FAULTY}"

FACTS = "* REPLACE (strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date)"

#: Which count of which source makes a signal.
SIGNALS = {
    "urgent_reach": ("1-URGENT", "reach"),
    "high_reach": ("2-HIGH", "reach"),
    "medium_reach": ("3-MEDIUM", "reach"),
    "unspecified_volume": ("4-NOT SPECIFIED", "volume"),
    "low_score": ("5-LOW", "score"),
}


def _each(template: str) -> str:
    """``template`` once per signal, comma-joined."""
    return ", ".join(
        template.format(signal=k, source=source, column=column) for k, (source, column) in SIGNALS.items()
    )


METRICS = f"""chosen AS (
  SELECT * FROM (VALUES {_each("('{signal}', '{source}', '{column}')")}) AS t(signal, source, measure)),
counts AS (UNPIVOT latest ON score, reach, volume INTO NAME measure VALUE amount),
metrics AS (
  SELECT entity_name, signal, CAST(amount AS DOUBLE) AS metric_value
  FROM counts JOIN chosen USING (source, measure))"""

#: Places by definition: how many values are smaller, and how many distinct ones are at least as large.
PLACES = """tally AS (
  SELECT signal, metric_value, COUNT(*) AS ties FROM metrics WHERE metric_value > 0 GROUP BY ALL),
places AS (
  SELECT signal, metric_value,
         SUM(ties) OVER (PARTITION BY signal ORDER BY metric_value) - ties AS smaller,
         SUM(ties) OVER (PARTITION BY signal) - 1 AS others,
         COUNT(*) OVER (PARTITION BY signal ORDER BY metric_value DESC) AS signal_rank
  FROM tally)"""

PERCENTILES = f"""{PLACES}, percentiles AS (
  SELECT entity_name, signal, metric_value,
         CASE WHEN others = 0 THEN 0.0::DOUBLE ELSE smaller::DOUBLE / others::DOUBLE END AS percentile
  FROM metrics JOIN places USING (signal, metric_value))"""

RANKS = f"""{PLACES}, ranks AS (
  SELECT entity_name, signal, signal_rank FROM metrics JOIN places USING (signal, metric_value))"""

SIGNAL_COLUMNS = _each("MAX({column}) FILTER (source = '{source}') AS {signal}")

PRIMARY_TAGS = """arg_min(tags, list_position(
    ['1-URGENT', '5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH'], source))
  FILTER (tags IS NOT NULL) AS primary_tags"""

COMPOSITE = f"""{SALES_LATEST}, {METRICS}, {PERCENTILES},
  spread AS (PIVOT percentiles ON signal IN ({_each("'{signal}'")}) USING MAX(percentile) GROUP BY entity_name),
  filled AS (SELECT *, {" + ".join(f"(({k} IS NOT NULL)::BIGINT)" for k in SIGNALS)} AS present FROM spread)
  SELECT entity_name, present AS metric_signals,
         ROUND(({" + ".join(f"COALESCE({k}, 0)" for k in SIGNALS)}) / present * 100, 2) AS composite_reach_score,
         {", ".join(f"ROUND({k} * 100, 2) AS {k}" for k in SIGNALS)}
  FROM filled"""

SCORECARD = f"""{SALES_LATEST}
  SELECT entity_name, MAX(volume) FILTER (source = '1-URGENT') AS urgent_volume, {SIGNAL_COLUMNS}, {PRIMARY_TAGS}
  FROM latest GROUP BY entity_name"""

GAP = f"""{SALES_LATEST}, {METRICS}, {RANKS}, held AS (
    SELECT entity_name, list(signal_rank) AS r, list(signal || '=' || signal_rank) AS texts
    FROM ranks GROUP BY entity_name)
  SELECT entity_name, len(r) AS signals_present, list_min(r) AS best_rank, list_max(r) AS worst_rank,
         list_max(r) - list_min(r) AS rank_spread, array_to_string(list_sort(texts), '; ') AS rank_details
  FROM held WHERE len(r) > 1"""

#: A tag weighs as often as it is given to an entity; its means take that weight.
TAGS = f"""{SALES_LATEST}, said AS (
    SELECT tag, entity_name, COUNT(*) AS weight
    FROM (SELECT entity_name, trim(piece) AS tag FROM latest, unnest(string_split(tags, ',')) AS t(piece))
    WHERE lower(tag) NOT IN ('', 'p') GROUP BY ALL),
  measured AS (SELECT entity_name, {SIGNAL_COLUMNS} FROM latest GROUP BY entity_name)
  SELECT tag, COUNT(*) AS entity_count, {", ".join(
      f"ROUND(SUM(weight * {k})::DOUBLE / SUM(weight) FILTER ({k} IS NOT NULL), {int(c == 'score')}) AS avg_{k}"
      for k, (_, c) in SIGNALS.items())}
  FROM said JOIN measured USING (entity_name) GROUP BY tag HAVING COUNT(*) > 1"""

KNOWN = """COALESCE(bool_or(entity_id IS NOT NULL) FILTER (source LIKE '%-{0}'), false)::INTEGER AS has_{0}_id"""
COVERAGE = f"""{SALES_LATEST}
  SELECT entity_name, {", ".join(KNOWN.format(s) for s in ("URGENT", "HIGH", "LOW"))},
         COALESCE(string_agg(tags, ' | ' ORDER BY source DESC)
                  FILTER (source IN ('5-LOW', '2-HIGH', '1-URGENT')), '') AS enrichment_tags
  FROM latest GROUP BY entity_name"""

VARIANTS = """variants AS (
  SELECT * REPLACE (CASE source
      WHEN '1-URGENT' THEN upper(entity_name)
      WHEN '2-HIGH' THEN replace(entity_name, '#', ' & ')
      WHEN '3-MEDIUM' THEN replace(entity_name, 'o', 'ö')
      WHEN '4-NOT SPECIFIED' THEN replace(entity_name, '#', '-')
      ELSE concat(entity_name, '!') END AS entity_name)
  FROM obs)"""


def _key(name: str) -> str:
    return (
        f"regexp_replace(lower(strip_accents(replace({name}, '&', 'and'))), '[^a-z0-9]', '', 'g')"
    )


DIM = f"""listed AS (
  SELECT c_custkey AS seq, c_name AS configured FROM customer WHERE c_nationkey <> 3
  UNION ALL
  SELECT c_custkey + 1000000000000, upper(c_name) FROM customer WHERE c_nationkey = 5),
dim AS (
  SELECT {_key("configured")} AS entity_key, arg_max(configured, seq) AS configured
  FROM listed GROUP BY 1)"""

MERGED_IDS = """candidates AS (
  SELECT concat('C', o_custkey) AS entity_name, concat('O', o_orderkey) AS entity_id,
         0 AS priority, -o_orderkey AS place
  FROM orders WHERE o_orderpriority <> '5-LOW'
  UNION ALL
  SELECT concat('C', user_id), concat('E', event_id), 1, event_id FROM events),
merged AS (
  SELECT entity_name, entity_id, priority FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_name ORDER BY priority, place, entity_id) AS rn
    FROM candidates) WHERE rn = 1)"""


# --- expected rows of the normalisers, tag lists of five at most ------------


def _digit(default: str, **by_digit: str) -> str:
    whens = " ".join(
        f"WHEN entity_id LIKE '%{digit[1:]}' THEN {value}" for digit, value in by_digit.items()
    )
    return f"CASE {whens} ELSE {default} END"


_NAME = """CASE WHEN entity_id LIKE '%2' THEN 'Unknown'
                ELSE COALESCE(configured, CASE WHEN entity_id LIKE '%1' THEN entity_name
                                               ELSE upper(entity_name) END) END"""

_SEGMENT = "split_part(tags, ', ', 1)"
_STATUS = "split_part(tags, ', ', 2)"


def _normalized(source, entity_id, score="NULL", reach="NULL", volume="NULL", tags="NULL", skip=()):
    kept = " AND ".join(f"entity_id NOT LIKE '%{digit}'" for digit in skip) or "TRUE"
    return f"""SELECT {_NAME} AS entity_name, {entity_id} AS entity_id, '{source}' AS source,
         '2026-04-26' AS snapshot_date, CAST({score} AS BIGINT) AS score,
         CAST({reach} AS BIGINT) AS reach, CAST({volume} AS BIGINT) AS volume,
         CAST({tags} AS VARCHAR) AS tags
  FROM obs LEFT JOIN dim ON entity_key = {_key("entity_name")} WHERE {kept}"""


_STARS = "CAST(concat(score // 100, '.', lpad(CAST(score % 100 AS VARCHAR), 2, '0')) AS DOUBLE)"

NORMALIZED = {
    "norm_nested_struct": _normalized(
        "spotify",
        _digit("concat('sp', entity_id)", d3="''", d4="NULL"),
        score=_digit("score", d8="NULL"),
        reach=_digit("reach", d5="NULL", d7="NULL"),
        tags=f"concat({_SEGMENT}, ', ', {_STATUS}, ', x, y')",
        skip=(6, 9),
    ),
    "norm_stats_tags": _normalized(
        "lastfm",
        _digit("concat('mb-', entity_id)", d3=f"replace(lower({_NAME}), ' ', '')"),
        score=_digit("reach", d5="0"),
        reach=_digit("reach", d5="0"),
        volume=_digit("volume", d4="0", d5="0"),
        tags=_digit(
            f"concat({_SEGMENT}, ', ', {_STATUS}, ', ', source, ', , e')", d7="NULL", d8="NULL"
        ),
        skip=(6, 9),
    ),
    "norm_fan_count": _normalized(
        "deezer", "entity_id", score=_digit("reach", d7="0"), reach=_digit("reach", d7="0"),
        skip=(8, 9),
    ),
    "norm_rating_tags": _normalized(
        "musicbrainz",
        "concat('mb', entity_id)",
        score=_digit(f"trunc({_STARS} * 20)", d3="score // 100 * 20", d4="0", d5="0"),
        reach=_digit("reach", d3="0", d5="0"),
        tags=_digit(f"concat('e, ', {_STATUS}, ', b, d, ', {_SEGMENT})", d7="NULL"),
        skip=(6, 8),
    ),
    "norm_array_size": _normalized(
        "listenbrainz",
        "concat('mb', entity_id)",
        score=_digit("volume", d3="NULL", d4="NULL", d5="NULL"),
        reach=_digit("reach", d7="NULL", d8="NULL"),
        volume=_digit("volume", d3="NULL", d4="NULL", d5="NULL"),
        skip=(6,),
    ),
    "norm_window_views": _normalized(
        "wikimedia",
        _digit("concat('T ', entity_id)", d3=_NAME, d4="NULL"),
        score=_digit("reach", d5="NULL"),
        reach=_digit("reach", d5="NULL"),
        volume="volume",
        skip=(6,),
    ),
    "norm_join_nonempty": _normalized(
        "theaudiodb",
        "entity_id",
        tags=_digit(
            f"concat({_SEGMENT}, ', ', {_STATUS})",
            d3=_SEGMENT,
            d4=f"concat({_SEGMENT}, ', a')",
            d5=f"concat({_SEGMENT}, ', ', {_STATUS}, ', calm')",
            d6="NULL",
        ),
    ),
    "norm_catalog": _normalized(
        "itunes", _digit("entity_id", d3="''"), tags=_digit(_SEGMENT, d4="NULL", d5="''")
    ),
    "norm_claim_labels": _normalized(
        "wikidata",
        "concat('Q', entity_id)",
        tags=_digit(
            f"concat({_SEGMENT}, ', ', {_STATUS}, ', c, d')", d3="NULL", d4="NULL", d5="'plain'"
        ),
    ),
}
# the same with all tags of a record, as the mappers give them by default
NORMALIZED_ALL = {
    **NORMALIZED,
    "norm_nested_struct": _normalized(
        "spotify",
        _digit("concat('sp', entity_id)", d3="''", d4="NULL"),
        score=_digit("score", d8="NULL"),
        reach=_digit("reach", d5="NULL", d7="NULL"),
        tags=f"concat({_SEGMENT}, ', ', {_STATUS}, ', x, y, z')",
        skip=(6, 9),
    ),
    "norm_stats_tags": _normalized(
        "lastfm",
        _digit("concat('mb-', entity_id)", d3=f"replace(lower({_NAME}), ' ', '')"),
        score=_digit("reach", d5="0"),
        reach=_digit("reach", d5="0"),
        volume=_digit("volume", d4="0", d5="0"),
        tags=_digit(
            f"concat({_SEGMENT}, ', ', {_STATUS}, ', ', source, ', , e, f')", d7="NULL", d8="NULL"
        ),
        skip=(6, 9),
    ),
    "norm_rating_tags": _normalized(
        "musicbrainz",
        "concat('mb', entity_id)",
        score=_digit(f"trunc({_STARS} * 20)", d3="score // 100 * 20", d4="0", d5="0"),
        reach=_digit("reach", d3="0", d5="0"),
        tags=_digit(f"concat('e, ', {_STATUS}, ', b, d, ', {_SEGMENT}, ', c')", d7="NULL"),
        skip=(6, 8),
    ),
    "norm_claim_labels": _normalized(
        "wikidata",
        "concat('Q', entity_id)",
        tags=_digit(
            f"concat({_SEGMENT}, ', ', {_STATUS}, ', c, d, e')", d3="NULL", d4="NULL", d5="'plain'"
        ),
    ),
}
WITH_DIM = f"WITH {OBS_SALES}, {DIM}"


def _rejects(source: str, reason: str, digit: int, first: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"""SELECT '{source}' AS source, '{reason}' AS reject_reason, COUNT(*) AS n_rows,
         {first} AS first_malformed
  FROM obs WHERE entity_id LIKE '%{digit}' HAVING COUNT(*) > 0"""


REJECTS = " UNION ALL ".join(
    [
        _rejects("spotify", "followers: no object", 6),
        _rejects("spotify", "popularity: no count", 9),
        _rejects("lastfm", "stats.listeners: no count", 6),
        _rejects("lastfm", "tags: no object", 9),
        _rejects("deezer", "nb_fan: no count", 8),
        _rejects("deezer", "nb_fan: no count", 9),
        _rejects("deezer", "malformed JSON", 4, "MIN(concat('{\"id\":', entity_id, ','))"),
        _rejects("musicbrainz", "rating: no object", 6),
        _rejects("musicbrainz", "tags: tag without name", 8),
        _rejects("listenbrainz", "total_listen_count: no count", 6),
        _rejects("wikimedia", "total_window_views: no count", 6),
    ]
)


# --- validation report -----------------------------------------------------


def _check(position, check, observed, threshold, passed, source="NULL", frm="totals"):
    return f"""SELECT {position} AS place, '{check}' AS "check", CAST({source} AS VARCHAR) AS source,
         {passed} AS passed, CAST({observed} AS DOUBLE) AS observed,
         CAST({threshold} AS DOUBLE) AS threshold FROM {frm}"""


def _coverage(position, source, minimum):
    return _check(
        position, "coverage", f"n_rows / CAST(n AS DOUBLE)", minimum,
        f"n_rows / CAST(n AS DOUBLE) >= {minimum}", f"'{source}'",
        f"(SELECT COUNT(*) AS n_rows FROM newest WHERE source = '{source}'), size WHERE n_rows > 0",
    )


def _metric_rows(position, source, minimum):
    return _check(
        position, "metric rows", "n_rows", f"FLOOR(n * {minimum})", f"n_rows >= FLOOR(n * {minimum})",
        f"'{source}'",
        f"""(SELECT COUNT(*) AS n_rows FROM newest
             WHERE source = '{source}' AND score IS NOT NULL), size""",
    )


REPORT = f"""{WITH_FAULTY}, size AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM expected),
required AS (SELECT unnest(['click', 'purchase', 'trial', 'view']) AS source),
totals AS (
  SELECT (SELECT COUNT(*) FROM newest WHERE entity_name IS NULL OR entity_id IS NULL
             OR source IS NULL OR snapshot_date IS NULL) AS null_keys,
         (SELECT COUNT(*) FROM (SELECT DISTINCT entity_name FROM newest)) AS present,
         (SELECT COUNT(DISTINCT entity_name) FROM newest
           WHERE entity_name NOT IN (SELECT entity_name FROM expected)) AS unexpected,
         (SELECT COUNT(*) FROM (SELECT 1 FROM newest GROUP BY entity_name, source, snapshot_date
                                HAVING COUNT(*) > 1)) AS duplicates,
         (SELECT COUNT(DISTINCT source) FROM newest) AS sources,
         (SELECT COUNT(*) FROM required
           WHERE source NOT IN (SELECT source FROM newest)) AS absent,
         (SELECT COUNT(*) FROM required WHERE source NOT IN
           (SELECT source FROM newest WHERE score IS NOT NULL)) AS unscored,
         (SELECT COUNT(*) FROM newest WHERE score < 0 OR reach < 0 OR volume < 0) AS negative,
         (SELECT COUNT(*) FROM newest
           WHERE source = 'purchase' AND (score < 0 OR score > 100)) AS unbounded,
         (SELECT n FROM size) AS n),
checks AS (
  {_check(1, "columns present", 0, 0, "TRUE")}
  UNION ALL {_check(2, "keys filled", "null_keys", 0, "null_keys = 0")}
  UNION ALL {_check(3, "entity count", "present", "n", "present = n")}
  UNION ALL {_check(4, "names in list", "unexpected", 0, "unexpected = 0")}
  UNION ALL {_check(5, "no duplicates", "duplicates", 0, "duplicates = 0")}
  UNION ALL {_check(6, "source count", "sources", 6, "sources >= 6")}
  UNION ALL {_check(7, "required sources present", "absent", 0, "absent = 0")}
  UNION ALL {_coverage(8, "click", 0.95)}
  UNION ALL {_coverage(9, "error", 0.5)}
  UNION ALL {_coverage(10, "purchase", 0.9)}
  UNION ALL {_coverage(11, "signup", 0.75)}
  UNION ALL {_coverage(12, "trial", 0.5)}
  UNION ALL {_check(13, "no metric below zero", "negative", 0, "negative = 0")}
  UNION ALL {_check(14, "required sources scored", "unscored", 0, "unscored = 0")}
  UNION ALL {_metric_rows(15, "click", 0.95)}
  UNION ALL {_metric_rows(16, "purchase", 0.9)}
  UNION ALL {_metric_rows(17, "trial", 0.5)}
  UNION ALL {_metric_rows(18, "view", 0.95)}
  UNION ALL {_check(19, "bounded scores", "unbounded", 0, "unbounded = 0")}),
verdict AS (
  SELECT * FROM checks
  UNION ALL
  SELECT 20, 'overall', NULL, bool_and(passed),
         CAST(COUNT(*) FILTER (WHERE NOT passed) AS DOUBLE), 0.0 FROM checks)
SELECT CAST(row_number() OVER (ORDER BY place) - 1 AS INTEGER) AS position,
       "check", source, passed, observed, threshold FROM verdict"""


def _labels(which: str) -> str:
    return f"""WITH ids AS (
        SELECT o_orderkey, i AS position,
               CASE i WHEN 11 THEN o_custkey + 34 ELSE o_custkey + i * 17 END AS id
        FROM orders, range(0, 12) t(i) WHERE {which})
      SELECT o_orderkey, string_agg(p_name, '; ' ORDER BY position) AS labels
      FROM ids JOIN part ON p_partkey = id GROUP BY o_orderkey"""


ORACLES = {
    "latest_snapshot": f"{SALES_LATEST} SELECT {FACTS} FROM latest",
    "enabled_source_view": f"""WITH {OBS_SALES}
      SELECT source, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, COUNT(*) AS n_rows,
             CAST(SUM(reach) AS BIGINT) AS reach, MAX(tags) AS tags
      FROM obs WHERE source IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
      GROUP BY source, snapshot_date""",
    "metric_signals": f"{SALES_LATEST}, {METRICS} SELECT * FROM metrics",
    "pivot_signals": f"{SALES_LATEST} SELECT entity_name, {SIGNAL_COLUMNS} FROM latest GROUP BY entity_name",
    "priority_tags": f"{SALES_LATEST} SELECT entity_name, {PRIMARY_TAGS} FROM latest GROUP BY entity_name",
    "signal_percentile": f"{SALES_LATEST}, {METRICS}, {PERCENTILES} SELECT * FROM percentiles",
    "signal_dense_rank": f"{SALES_LATEST}, {METRICS}, {RANKS} SELECT * FROM ranks",
    "scorecard": f"""{SCORECARD} ORDER BY urgent_reach DESC NULLS LAST, high_reach DESC NULLS LAST,
      medium_reach DESC NULLS LAST, entity_name LIMIT 50""",
    "scorecard_all": SCORECARD,
    "composite_reach": f"""{COMPOSITE}
      ORDER BY composite_reach_score DESC, metric_signals DESC, entity_name LIMIT 25""",
    "composite_reach_all": COMPOSITE,
    "source_gap": f"{GAP} ORDER BY rank_spread DESC, signals_present DESC, entity_name LIMIT 25",
    "source_gap_all": GAP,
    "tag_reach": f"{TAGS} ORDER BY entity_count DESC, avg_urgent_reach DESC NULLS LAST, tag LIMIT 50",
    "tag_reach_all": TAGS,
    "metadata_coverage": f"""{COVERAGE}
      ORDER BY has_URGENT_id + has_HIGH_id + has_LOW_id DESC, entity_name LIMIT 50""",
    "metadata_coverage_all": COVERAGE,
    "entity_profile": f"""WITH {OBS_SALES}
      SELECT entity_name, source, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date,
             score, reach, volume, tags
      FROM obs WHERE lower(entity_name) = lower('customer#000000007')""",
    "entity_profile_events": f"""WITH {OBS_EVENTS}
      SELECT entity_name, source, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date,
             score, reach, volume, tags
      FROM obs WHERE entity_name = 'User 7'""",
    "health_summary": f"""{SALES_LATEST},
      per_source AS (SELECT source, COUNT(*) AS n FROM latest GROUP BY source),
      names AS (SELECT DISTINCT entity_name FROM latest)
      SELECT CAST(SUM(n) AS BIGINT) AS latest_snapshot_rows, (SELECT COUNT(*) FROM names) AS unique_entities,
             COUNT(*) AS enabled_sources, string_agg(source, '; ' ORDER BY source) AS sources_present,
             (SELECT strftime(MAX(snapshot_date), '%Y-%m-%d') FROM obs) AS latest_snapshot
      FROM per_source""",
    "check_null_keys": f"""{WITH_FAULTY} SELECT {FACTS} FROM faulty
      WHERE entity_name IS NULL OR entity_id IS NULL OR source IS NULL OR snapshot_date IS NULL""",
    "check_negative": f"""{WITH_FAULTY} SELECT {FACTS} FROM faulty
      WHERE score < 0 OR reach < 0 OR volume < 0""",
    "check_bounds": f"""{WITH_FAULTY} SELECT {FACTS} FROM faulty
      WHERE source = 'purchase' AND (score < 0 OR score > 100)""",
    "check_unexpected_names": f"""{WITH_FAULTY} SELECT DISTINCT entity_name FROM faulty
      WHERE entity_name NOT IN (SELECT entity_name FROM expected)""",
    "check_duplicates": f"""{WITH_FAULTY}
      SELECT entity_name, source, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date,
             COUNT(*) AS n_rows
      FROM faulty GROUP BY entity_name, source, snapshot_date HAVING COUNT(*) > 1""",
    "distinct_entities": f"{WITH_FAULTY} SELECT DISTINCT entity_name FROM faulty",
    "source_counts": f"{WITH_FAULTY} SELECT source, COUNT(*) AS n_rows FROM faulty GROUP BY source",
    "coverage_by_source": f"""{WITH_FAULTY}, counted AS (
        SELECT source, COUNT(*) AS n_rows, (SELECT COUNT(*) FROM expected) AS n_expected
        FROM newest GROUP BY source),
      least AS (SELECT * FROM (VALUES ('click', CAST(0.95 AS DOUBLE)), ('error', 0.5),
        ('purchase', 0.9), ('signup', 0.75), ('trial', 0.5)) AS t(source, min_coverage))
      SELECT source, n_rows, n_expected, n_rows / CAST(n_expected AS DOUBLE) AS coverage,
             min_coverage, n_rows / CAST(n_expected AS DOUBLE) >= min_coverage AS passed
      FROM counted LEFT JOIN least USING (source)""",
    "validation_report": REPORT,
    "canonical_key": f"""WITH {OBS_SALES}, {VARIANTS}
      SELECT DISTINCT entity_name, {_key("entity_name")} AS entity_key FROM variants""",
    "canonicalize_names": f"""WITH {OBS_SALES}, {VARIANTS}, {DIM}
      SELECT COALESCE(configured, entity_name) AS entity_name, entity_id, source,
             strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, score, reach, volume, tags
      FROM variants LEFT JOIN dim ON entity_key = {_key("entity_name")}""",
    "priority_id_merge": f"WITH {MERGED_IDS} SELECT * FROM merged",
    "semi_join_known": f"""WITH {MERGED_IDS}
      SELECT concat('C', c_custkey) AS entity_name, c_mktsegment AS segment FROM customer
      WHERE concat('C', c_custkey) IN (SELECT entity_name FROM merged)""",
    "override_fallback": """WITH pages AS (
        SELECT concat('C', o_custkey) AS page_title, COUNT(*) AS views FROM orders GROUP BY 1),
      entities AS (
        SELECT concat('C', c_custkey) AS entity_name,
               CASE WHEN c_nationkey < 5 THEN concat('C', c_custkey + 1)
                    ELSE concat('C', c_custkey) END AS title,
               concat('C', c_nationkey) AS search_title
        FROM customer)
      SELECT entity_name, COALESCE(a.page_title, b.page_title) AS page_title,
             COALESCE(a.views, b.views) AS views
      FROM entities LEFT JOIN pages a ON a.page_title = title
           LEFT JOIN pages b ON b.page_title = search_title
      WHERE a.page_title IS NOT NULL OR b.page_title IS NOT NULL""",
    "detail_over_search": """SELECT p_partkey,
        CASE WHEN p_size <= 25 THEN upper(p_brand) ELSE p_brand END AS p_brand,
        CASE WHEN p_size <= 25 THEN NULLIF(p_type, 'ECONOMY') ELSE p_type END AS p_type,
        CASE WHEN p_size <= 25 THEN p_size + 100 ELSE p_size END AS p_size
      FROM part""",
    "top1_per_key": """SELECT l_orderkey, l_extendedprice, l_partkey, l_suppkey, l_linenumber
      FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC,
              l_partkey, l_suppkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""",
    "incremental_enrich": """WITH found AS (
        SELECT c_name AS entity_name, c_nationkey, c_mktsegment,
               (SELECT MAX(o_orderpriority) FROM orders WHERE o_custkey = c_custkey) AS looked_up
        FROM customer)
      SELECT entity_name, CASE WHEN c_nationkey < 10 THEN c_mktsegment ELSE looked_up END AS record,
             c_nationkey < 10 AS from_cache
      FROM found WHERE c_nationkey < 10 OR looked_up IS NOT NULL""",
    "nested_claims": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_returnflag = 'R' THEN concat('Q', l_suppkey)
             ELSE concat('Q', l_partkey, '; Q', l_suppkey) END AS ids
      FROM lineitem""",
    "ordered_label_join": _labels("TRUE"),
    "ordered_label_join_all": _labels("TRUE"),
    # id 11 repeats id 2, so it is looked up although it is not among the first ten places
    "ordered_label_join_first_ten": _labels("i <> 10"),
    "nested_labels": """WITH ids AS (
        SELECT o_orderkey, i, o_custkey * 3 + i * 17 AS id FROM orders, range(12) AS t(i))
      SELECT o_orderkey, COALESCE(string_agg('genre ' || id % 97, '; ' ORDER BY i)
               FILTER (id % 7 <> 0 AND id % 5 > 1), '') AS labels
      FROM ids GROUP BY o_orderkey""",
    "exploded_labels": """WITH ids AS (
        SELECT o_orderkey, unnest([0, 1, 2]) AS place,
               unnest([o_custkey, 1000000000 + o_orderkey % 4, o_custkey + 1]) AS id FROM orders),
      named AS (
        SELECT p_partkey AS id, p_name AS label FROM part
        UNION SELECT 1000000000 + p_partkey % 3, 'shared ' || p_partkey % 3 FROM part)
      SELECT o_orderkey, string_agg(label, '; ' ORDER BY place) AS labels
      FROM ids JOIN named USING (id) GROUP BY o_orderkey""",
    "rolling_month_window": """WITH monthly AS (
        SELECT CAST(o_custkey AS VARCHAR) AS page_title,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS views
        FROM orders GROUP BY 1, 2)
      SELECT page_title, '1997120100' AS period_start, '1998050100' AS period_end,
             arg_max(views, month) AS latest_month_views,
             CAST(SUM(views) AS BIGINT) AS total_window_views
      FROM monthly WHERE month BETWEEN DATE '1997-12-01' AND DATE '1998-05-01'
      GROUP BY page_title""",
    "raw_json_scan": f"""WITH {OBS_SALES}
      SELECT CASE WHEN entity_id LIKE '%1' OR entity_id LIKE '%4' THEN NULL
                  WHEN entity_id LIKE '%2' THEN '' ELSE upper(entity_name) END AS source_artist_name,
             CASE WHEN entity_id LIKE '%1' THEN entity_name
                  WHEN entity_id LIKE '%2' OR entity_id LIKE '%4' THEN NULL ELSE 'other' END AS name,
             CASE WHEN entity_id LIKE '%4' THEN NULL ELSE entity_id END AS id,
             {_digit("reach", d4="NULL", d7="NULL", d8="NULL", d9="NULL")} AS nb_fan,
             entity_id LIKE '%8' AS nb_fan_is_null,
             CASE WHEN entity_id LIKE '%4' THEN concat('{{"id":', entity_id, ',') END AS broken_line
      FROM obs""",
    "raw_json_roundtrip": f"""WITH {OBS_SALES}
      SELECT entity_name, CASE WHEN snapshot_date = (SELECT MAX(snapshot_date) FROM obs)
                               THEN reach + 1 ELSE reach END AS nb_fan,
             strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, 'deezer' AS source
      FROM obs""",
    "conform_schema": f"""WITH {OBS_SALES}
      SELECT entity_name, entity_id, source, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date,
             CASE WHEN entity_id LIKE '%9' THEN NULL ELSE score END AS score, reach,
             CAST(NULL AS BIGINT) AS volume, CAST(NULL AS VARCHAR) AS tags
      FROM obs""",
    "quarantine_split": f"""WITH {OBS_SALES}, parts AS ({REJECTS})
      SELECT source, reject_reason, CAST(SUM(n_rows) AS BIGINT) AS n_rows,
             MIN(first_malformed) AS first_malformed
      FROM parts GROUP BY source, reject_reason""",
    **{key: f"{WITH_DIM} {sql}" for key, sql in NORMALIZED_ALL.items()},
    **{f"{key}_all": f"{WITH_DIM} {sql}" for key, sql in NORMALIZED_ALL.items() if sql != NORMALIZED[key]},
    **{f"{key}_first_five": f"{WITH_DIM} {sql}" for key, sql in NORMALIZED.items() if sql != NORMALIZED_ALL[key]},
    **{
        key: f"{WITH_DIM} " + " UNION ALL ".join(NORMALIZED_ALL.values())
        for key in ("normalize_union", "normalize_union_all", "normalize_landed")
    },
    "normalize_union_first_five": f"{WITH_DIM} " + " UNION ALL ".join(NORMALIZED.values()),
    "scan_snapshots": f"WITH {OBS_EVENTS}, {LATEST} SELECT {FACTS} FROM latest",
    "snapshot_roundtrip": f"WITH {OBS_SALES} SELECT {FACTS} FROM obs",
    "snapshot_replace": f"""WITH {OBS_SALES}, newest AS (SELECT MAX(snapshot_date) AS d FROM obs)
      SELECT entity_name, entity_id, source, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date,
             CASE WHEN snapshot_date = d THEN score + 1 ELSE score END AS score, reach, volume, tags
      FROM obs, newest WHERE snapshot_date < d OR source = '1-URGENT'""",
    "snapshot_failed_swap": f"WITH {OBS_SALES} SELECT {FACTS} FROM obs",
    "snapshot_newest": f"""WITH {OBS_EVENTS}, dates AS (
        SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date DESC) AS place FROM obs GROUP BY 1),
      left_over AS (SELECT obs.* FROM obs JOIN dates USING (snapshot_date)
                    WHERE place > 2 OR (place = 2 AND source NOT IN ('view', 'click')))
      SELECT {FACTS} FROM left_over WHERE snapshot_date = (
        SELECT MAX(snapshot_date) FROM left_over WHERE source IN ('view', 'click'))""",
    "snapshot_dates": f"""WITH {OBS_SALES}, newest AS (SELECT MAX(snapshot_date) AS d FROM obs)
      SELECT strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date,
             CASE WHEN snapshot_date = d THEN 2 ELSE 1 END AS replacements
      FROM obs, newest GROUP BY snapshot_date, d""",
    "entity_profile_stored": f"""WITH {OBS_SALES}, {VARIANTS}
      SELECT 'Customer#000000007' AS entity_name, source, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date,
             score, reach, volume, tags
      FROM variants WHERE {_key("entity_name")} = 'customer000000007'""",
    "missing_columns_report": f"""WITH {OBS_SALES}, wanted AS (
        SELECT * FROM (VALUES ('entity_name', 'string'), ('entity_id', 'string'), ('source', 'string'),
          ('score', 'bigint'), ('reach', 'bigint'), ('volume', 'bigint'), ('tags', 'string'))
          AS t("column", expected_type)),
      dates AS (SELECT snapshot_date, snapshot_date = MAX(snapshot_date) OVER () AS is_old FROM obs GROUP BY 1),
      held AS (
        SELECT snapshot_date, "column", expected_type, CASE WHEN is_old AND "column" = 'tags' THEN NULL
               WHEN is_old AND "column" = 'score' THEN 'int' ELSE expected_type END AS stored_type
        FROM dates, wanted)
      SELECT strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, "column", expected_type, stored_type,
             COALESCE(stored_type = expected_type, FALSE) AS passed FROM held""",
    "cache_roundtrip": """WITH found AS (
        SELECT c_name AS entity_name, c_nationkey < 10 AS from_cache,
               (SELECT MAX(o_orderpriority) FROM orders WHERE o_custkey = c_custkey) AS looked_up
        FROM customer)
      SELECT entity_name, CASE WHEN from_cache THEN 'first ' ELSE 'second ' END || looked_up AS record,
             from_cache, CAST(2 AS BIGINT) AS n_rounds
      FROM found WHERE looked_up IS NOT NULL""",
    "cache_lost_file": """SELECT c_name AS entity_name, reverse(c_name) AS record, FALSE AS from_cache,
        CAST(2 AS BIGINT) AS written_in FROM customer""",
}
