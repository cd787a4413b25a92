"""Rule tables to labels, scores and signals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealoom.functions import vocab
from arealoom.functions.text import _col, bind, trim_all

__all__ = [
    "canonical_header", "classify", "join_readiness", "labels", "match_text", "pattern_points",
    "score_terms", "signals",
]


def match_text(c) -> Column:
    """Lower-case words separated by single spaces, the form that label rules are written for."""
    return trim_all(F.regexp_replace(F.lower(F.coalesce(_col(c).cast("string"), F.lit(""))), "[^a-z0-9]+", " "))


def classify(c, rules, default: str | None = None) -> Column:
    """First rule whose pattern is found; ``rules`` is a list of (label, pattern)."""
    rules = list(rules)
    if not rules:
        return F.lit(default)

    def chain(text):
        out = F
        for label, pattern in rules:
            out = out.when(text.rlike(pattern), label)
        return out if default is None else out.otherwise(default)

    return chain(F.col(c)) if isinstance(c, str) else bind(c, chain)


def labels(c, rules=None, sep: str = ";", none: str = "unknown") -> Column:
    """Every rule whose pattern is found, in rule order, joined."""
    text = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    named = list(rules or vocab.TEXT_GEOGRAPHIES)
    hits = bind(text, lambda t: F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(n)) for n, p in named])))
    return F.coalesce(F.nullif(F.array_join(hits, sep), F.lit("")), F.lit(none))


def signals(c, rules=None) -> dict[str, Column]:
    """One boolean per signal."""
    text = match_text(c)
    return {name: text.rlike(pattern) for name, pattern in rules or vocab.SIGNALS}


def score_terms(c, weights) -> Column:
    """Sum of the weights of the terms found; ``weights`` is a list of (term, weight)."""
    terms = list(weights)

    def total(text):
        points = F.lit(0)
        for term, weight in terms:
            points = points + F.when(F.contains(text, F.lit(term)), weight).otherwise(0)
        return points

    return bind(F.lower(F.coalesce(_col(c).cast("string"), F.lit(""))), total)


def pattern_points(text: Column, table) -> Column:
    """Sum of the points of the patterns found; ``table`` is a list of (points, pattern)."""
    return sum((F.when(text.rlike(pattern), points).otherwise(0) for points, pattern in table), F.lit(0))


def join_readiness(flags: dict[str, Column], family: Column | None = None) -> dict[str, Column]:
    """Whether a source can be joined now, from its signals; with the use that follows."""
    bridged = (
        flags["has_lga_signal"] | flags["has_service_district_signal"] | flags["has_phn_signal"]
    )
    market = F.lit(False) if family is None else family.isin("market_insights", "market_concentration")
    ready = (
        F.when(flags["has_sa2_signal"], "joinable_now_sa2")
        .when(flags["has_sa3_signal"], "joinable_now_sa3")
        .when(bridged, "context_only_unbridged")
        .when(flags["has_state_signal"], "context_only_state")
        .when(market, "context_only_review")
        .otherwise("manual_review")
    )
    use = (
        F.when(F.startswith(ready, F.lit("joinable_now")), "eligible_for_sensitivity_layer")
        .when(F.startswith(ready, F.lit("context_only")), "hold_for_descriptive_context")
        .otherwise("exclude_until_manual_review")
    )
    return {"join_readiness": ready, "use_rule": use}


def canonical_header(c, index_key: str, prefix: str = "seifa") -> Column:
    """Header text to the canonical name of an index measure."""
    text = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "_")
    level = F.contains(text, F.lit("sa2")) | F.contains(text, F.lit("statistical_area_level_2"))
    scope = F.when(F.contains(text, F.lit("state")), "_state").otherwise("_australia")
    measure = F.when(F.contains(text, F.lit("score")), F.lit("score"))
    for name in ("rank", "decile", "percentile"):
        measure = measure.when(F.contains(text, F.lit(name)), F.concat(F.lit(name), scope))
    return (
        F.when(level & F.contains(text, F.lit("code")), "sa2_code_2021")
        .when(level & F.contains(text, F.lit("name")), "sa2_name_2021")
        .otherwise(F.concat(F.lit(f"{prefix}_{index_key}_"), measure))
    )
