"""Decisions over file inventories: what to process, hold, keep, archive or select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.functions.labels import score_terms
from arealoom.operators.windows import top_n


def rule_chain(rules: list[tuple[Column, str, str]], default: tuple[str, str]) -> dict[str, Column]:
    """First rule that holds gives (status, reason)."""
    status, reason = None, None
    for cond, s, r in rules:
        hit = F.coalesce(cond, F.lit(False))
        status = F.when(hit, s) if status is None else status.when(hit, s)
        reason = F.when(hit, r) if reason is None else reason.when(hit, r)
    return {"status": status.otherwise(default[0]), "reason": reason.otherwise(default[1])}


# Families that are processed by their own plan and stay raw here.
FOUNDATION_FAMILIES = ["geography", "index", "modelled", "census"]


def hold_rules(
    name: str = "file_name",
    ext: str = "file_extension",
    path: str = "path",
    family: str = "family",
    foundation=None,
    extract_family: str = "regional_profiles",
) -> list[tuple[Column, str, str]]:
    """Why a file is held back from automated staging."""
    n, e, p = F.lower(name), F.lower(ext), F.lower(path)
    return [
        (n == ".extracted", "held_marker_file", "extraction marker, not data"),
        (e == ".pdf", "held_report_context", "report, not parsed into a table"),
        (e.isin(".html", ".download"), "held_source_page_snapshot", "page snapshot, provenance only"),
        ((e == ".txt") & F.contains(n, F.lit("readme")), "held_readme_metadata", "metadata, not a table"),
        (~e.isin(".csv", ".xlsx", ".xls", ".zip"), "held_unsupported_extension", "unsupported extension"),
        (
            (F.col(family) == extract_family) & F.contains(p, F.lit("individual")),
            "held_already_processed_extract", "individual extract, use the processed table",
        ),
        (
            F.col(family).isin(list(foundation or FOUNDATION_FAMILIES)),
            "held_raw_foundation_source", "processed by its own plan",
        ),
    ]


def apply_hold_rules(inv: DataFrame, rules=None, **columns) -> DataFrame:
    chain = rule_chain(rules or hold_rules(**columns), ("process", ""))
    return inv.withColumns({"stage_status": chain["status"], "stage_reason": chain["reason"]})


def recommendation_rules(
    path="path", name="file_name", ext="file_extension", size="size", hint="hint", copies="group_size"
) -> list[tuple[Column, str, str]]:
    """Keep, archive or review, from name, extension, size and number of equal copies."""
    p, n, e = F.lower(F.replace(F.col(path), F.lit("\\"), F.lit("/"))), F.lower(name), F.lower(ext)
    return [
        (F.col(copies) > 1, "review_duplicate_keep_one_active_copy", "same content in several places"),
        (p.rlike("browser|capture|network|screenshot"), "archive_browser_capture_debris", "capture artefact"),
        (e.isin(".tmp", ".crdownload", ".part"), "delete_or_archive_partial_download", "partial download"),
        (
            e.isin(".png", ".jpg", ".jpeg", ".gif", ".ico", ".exe", ".dll", ".woff", ".woff2"),
            "archive_non_data_binary", "binary without data",
        ),
        (n.rlike("duplicate|copy"), "review_named_duplicate", "name suggests a copy"),
        (e.isin(".html", ".htm"), "keep_source_page_snapshot", "page snapshot"),
        (e.isin(".xlsx", ".xls", ".xlsm", ".csv", ".tsv"), "keep_pending_schema_inspection", "candidate table"),
        (e == ".zip", "keep_or_extract_after_member_review", "archive"),
        (F.col(size) == 0, "archive_or_delete_zero_byte_file", "no bytes"),
        (F.col(hint) == "unknown", "manual_review_unknown_file", "family unknown"),
    ]


def recommend(inv: DataFrame, **columns) -> DataFrame:
    chain = rule_chain(recommendation_rules(**columns), ("keep", "no issue"))
    return inv.withColumns({"recommendation": chain["status"], "recommendation_reason": chain["reason"]})


def choose_source(
    inv: DataFrame, group, text: str, weights, order: list[str], min_score: int = 20
) -> DataFrame:
    """Best source per group by weighted terms in its text, when it scores enough."""
    groups = [group] if isinstance(group, str) else list(group)
    scored = inv.withColumn("score", score_terms(text, weights)).filter(F.col("score") >= min_score)
    # each task keeps one row of a group before the shuffle, so no text sits in an aggregate buffer
    return top_n(scored, groups, [F.desc("score"), *[F.col(o) for o in order]], 1)
