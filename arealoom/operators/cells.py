"""Header-less sheets as a cell grid (file, sheet, row_idx, col_idx, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealoom.functions import vocab
from arealoom.functions.text import clean_text, key_slug, trim_all
from arealoom.operators.audit import ContractError
from arealoom.operators.windows import top_n

_SHEET = ["file", "sheet"]


def header_scores(cells: DataFrame, keywords=None, max_rows: int = 30) -> DataFrame:
    """Score of every leading row: five per keyword found plus one per non-empty cell.

    The keywords found are bits of whole numbers, so that a row is one short entry of a hash aggregate."""
    words = keywords or vocab.HEADER_KEYWORDS
    text = F.lower(trim_all("value"))
    masks = [
        sum((F.contains(text, F.lit(w)).cast("long") * (1 << i) for i, w in enumerate(words[at : at + 62])), F.lit(0))
        for at in range(0, len(words), 62)
    ]
    hits = sum((F.bit_count(F.col(f"__{i}")) for i in range(len(masks))), F.lit(0))
    return (
        cells.filter((F.col("row_idx") < max_rows) & F.col("value").isNotNull() & (text != ""))
        .groupBy(*_SHEET, "row_idx")
        .agg(F.count("*").alias("filled"), *[F.bit_or(m).alias(f"__{i}") for i, m in enumerate(masks)])
        .select(*_SHEET, "row_idx", (hits * 5 + F.col("filled")).alias("score"))
    )


def detect_header_row(cells: DataFrame, keywords=None, max_rows: int = 30) -> DataFrame:
    """The best-scored leading row of each sheet, the earliest on ties.

    Score and row are one whole number, which hash aggregates hold; a struct would be sorted."""
    scores = header_scores(cells, keywords, max_rows)
    rank = F.shiftleft("score", 32) + (F.lit(1 << 31) - F.col("row_idx"))
    best = scores.groupBy(*_SHEET).agg(F.max(rank).alias("__best"))
    row = F.lit(1 << 31) - F.col("__best").bitwiseAND((1 << 32) - 1)
    return best.select(
        *_SHEET,
        row.cast(cells.schema["row_idx"].dataType).alias("header_row"),
        F.shiftright("__best", 32).alias("score"),
    )


def combine_headers(cells: DataFrame, header_rows: DataFrame, window: int = 5, sep: str = " | ") -> DataFrame:
    """Header of each column from up to ``window`` rows ending at the header row: merged cells are
    filled to the right, consecutive repeats down the column are joined once.

    Cells are dealt by sheet once. The exchange before the join also lets Spark measure them: cells that are
    made of short rows look small enough for a broadcast to its estimate."""
    last = header_rows.select(*_SHEET, F.col("header_row").alias("__last"))
    first = F.greatest(F.lit(0), F.col("__last") - (window - 1))
    near = (F.col("row_idx") >= first) & (F.col("row_idx") <= F.col("__last"))
    # only the cells of the header rows are cleaned
    text = F.when(near, clean_text("value"))
    columns = (
        cells.filter("col_idx IS NOT NULL").repartition(*[F.col(c) for c in _SHEET])
        .join(last, _SHEET)
        .select(*_SHEET, "col_idx", "row_idx", "__last", text.alias("value"))
        .groupBy(*_SHEET, "col_idx")
        .agg(
            F.max("__last").alias("__last"),
            F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("row_idx", "value")))).alias("__s"),
        )
    )

    def texts_of(i: int):
        here = F.filter("__s", lambda x: x["row_idx"] == F.col("__last") - (window - 1 - i))
        return F.when(F.size(here) > 0, F.transform(here, lambda x: x["value"]))

    # One row of a sheet has at most 16,384 columns in the formats that hold merged cells.
    rightwards = Window.partitionBy(*_SHEET).orderBy("col_idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = [f"__r{i}" for i in range(window)]
    filled = columns.select(*_SHEET, "col_idx", *[texts_of(i).alias(r) for i, r in enumerate(rows)]).select(
        *_SHEET, "col_idx", *[F.last(r, ignorenulls=True).over(rightwards).alias(r) for r in rows]
    )
    kept = filled.withColumn("__w", F.flatten(F.array_compact(F.array(*rows)))).filter(F.size("__w") > 0).withColumn(
        "__w",
        F.filter("__w", lambda x, i: (i == 0) | (x != F.try_element_at("__w", F.greatest(i, F.lit(1))))),
    )
    return kept.select(*_SHEET, "col_idx", F.array_join("__w", sep).alias("header"))


def column_labels(cells: DataFrame, rows: int = 12, keep: int = 5, sep: str = " | ") -> DataFrame:
    """Label guess of each column: its first few distinct texts among the leading rows, whole, and told
    apart by their whole slugs. ``rows`` and ``keep`` are what makes a label a guess at the head of a
    sheet; both can be any size."""
    text = trim_all("value")
    firsts = (
        cells.filter((F.col("row_idx") < rows) & F.col("value").isNotNull())
        .select(*_SHEET, "col_idx", "row_idx", text.alias("label"), key_slug(text, 200, "plain", "").alias("key"))
        .filter((F.col("key") != "") & ~F.startswith(F.lower("label"), F.lit("unnamed")))
        .groupBy(*_SHEET, "col_idx", "key")
        .agg(F.min(F.struct("row_idx", "label")).alias("__f"))
    )
    return firsts.groupBy(*_SHEET, "col_idx").agg(
        F.array_join(
            F.transform(F.slice(F.array_sort(F.collect_list("__f")), 1, keep), lambda x: x["label"]), sep
        ).alias("column_label")
    )


def choose_table(candidates: DataFrame, group, score: str, order: list[str], min_score: float = 120,
                 strict: bool = False) -> DataFrame:
    """Best candidate parse per group with at least ``min_score``; ``strict`` raises for a group
    without one."""
    groups = [group] if isinstance(group, str) else list(group)
    best = top_n(candidates, groups, [F.col(score).desc_nulls_last(), *[F.col(o) for o in order]], 1)
    if strict:
        weak = best.filter(F.col(score).isNull() | (F.col(score) < min_score))
        if not weak.limit(1).isEmpty():
            raise ContractError(f"no candidate reaches {min_score} for {weak.select(*groups).first()}")
    return best.filter(F.col(score) >= min_score)
