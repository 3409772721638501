"""Secret scans with an incremental blob ledger, with native functions only.

A ledger holds, for each pair of blob (content address of one version of a
file) and rule version, what the scan of it found. A run scans the pairs that
the ledger lacks, once each however many paths hold the blob, and joins all
findings back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from renown.llm.frames import Stage, text_of


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap, kept if group ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Kinds and patterns that the results must follow.
RULES = (
    Rule(
        "assign",
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # the longest runs of 16 and more are the runs of [0-9a-f]+ with 16 and more
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: To be raised with any change of the rules.
RULES_VERSION = 1

FINDINGS = "array<struct<start:int, rank:int, kind:string, stop:int>>"


def _hits(rank: int, rule: Rule) -> Column:
    """Per match of one rule: what lies between it and the match before, its length, the judged part's length."""
    found = F.regexp_extract_all("body", F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.transform(F.split("body", rule.pattern, -1), F.length)
    if rule.group:
        whole = F.regexp_extract_all("body", F.lit(rule.pattern), F.lit(0))
    else:
        whole = found
    rows = F.arrays_zip(
        F.transform(whole, F.length).alias("size"),
        F.transform(found, F.length).alias("part"),
        F.slice(gaps, F.lit(1), F.size(found)).alias("gap"),
    )
    rows = F.when(F.size(found) > 0, rows).cast("array<struct<size:int, part:int, gap:int>>")
    return F.struct(F.lit(rank).alias("rank"), rows.alias("rows"))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, findings`` for rows of ``blob, body``; findings by start, then in the order of the rules.

    Places are running sums over one blob's matches, in code points.
    """
    hits = blobs.select("blob", F.inline(F.array(*[_hits(i, r) for i, r in enumerate(rules)])))
    hits = hits.select("blob", "rank", F.posexplode_outer("rows").alias("n", "hit"))
    so_far = W.partitionBy("blob", "rank").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    ends = hits.withColumn("stop", F.sum(F.col("hit.gap") + F.col("hit.size")).over(so_far).cast("int"))
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("rank") + 1)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rank") + 1)
    one = F.when(
        F.col("hit.part") >= least,
        F.struct((F.col("stop") - F.col("hit.size")).alias("start"), "rank", kind.alias("kind"), "stop"),
    )
    found = ends.select("blob", one.alias("one")).groupBy("blob").agg(F.collect_list("one").alias("all"))
    return found.select("blob", F.array_sort("all").cast(FINDINGS).alias("findings"))


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], f"blob binary, rules int, findings {FINDINGS}")


def scan_versions(
    versions: DataFrame,
    path_col: str = "path",
    body_col: str = "body",
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    rules_version: int = RULES_VERSION,
) -> tuple[DataFrame, DataFrame]:
    """What each path's version holds, and the ledger to hand to the next run.

    ``versions`` has one row per path and version; null bodies count as empty,
    equal rows are one blob and stay separate rows of the result, other columns
    are not read. The first result has ``path`` and ``findings`` (empty where
    there are none); an empty table gives empty results. The second has one row
    per blob and rule version, old ones included. Pairs in ``ledger`` are not scanned.
    A blob's address is the SHA-256 of its body.
    """
    spark = versions.sparkSession
    store = Stage(spark)
    ledger = empty_ledger(spark) if ledger is None else ledger
    at = versions.select(
        F.col(path_col).alias("path"),
        F.unhex(F.sha2(text_of(body_col), 256)).alias("blob"),
        text_of(body_col).alias("body"),
    )
    known = ledger.where(F.col("rules") == rules_version)
    unseen = at.select("blob", "body").dropDuplicates(["blob", "body"])
    unseen = unseen.join(known.select("blob"), "blob", "left_anti")
    fresh = store.keep(scan(unseen, rules))
    fresh = fresh.select("blob", F.lit(rules_version).alias("rules"), "findings")
    grown = ledger.select("blob", "rules", "findings").unionByName(fresh)
    telling = grown.where((F.col("rules") == rules_version) & (F.size("findings") > 0))
    telling = telling.select("blob", "findings")
    found = at.select("path", "blob").join(telling, "blob", "left")
    return (
        found.select("path", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings")),
        grown,
    )


def joined_spans(findings: Column) -> Column:
    """``kind:start:end`` of all findings, comma-joined."""
    return F.array_join(
        F.transform(
            findings,
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string")),
        ),
        ",",
    )


def count_of(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda x: x["kind"] == kind)).cast("long")
