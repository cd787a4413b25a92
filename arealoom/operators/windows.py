"""First-of-group, best-of-group and carried-forward operators.

``row_number() <= k`` keeps at most k rows per group and task before its shuffle (Spark plans a
group limit), so a hot group costs k rows per task. Operators that label every row rank only the
winners and join them back on a unique id. Fills over long runs work in blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealoom.session import col_name, materialise


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def top_n(df: DataFrame, group, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of every group by ``order``."""
    w = Window.partitionBy(*_names(group)).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= n).drop("__rank")


def top_n_demoted(
    df: DataFrame, group, demote: Column, order: list[Column], n: int
) -> DataFrame:
    """``top_n`` with summary rows after all others."""
    return top_n(df, group, [demote.asc(), *order], n)


def dedupe_first(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return top_n(df, keys, order, 1)


def best_candidate(df: DataFrame, group, score: str, tie: str) -> DataFrame:
    """Highest score per group, ties to the smallest ``tie``."""
    return top_n(df, group, [F.col(score).desc_nulls_last(), F.col(tie).asc()], 1)


def label_winners(
    df: DataFrame, winners: DataFrame, unique_id: str, name: str, yes: str, no: str
) -> DataFrame:
    """Label every row by whether its id won. The join is on the unique id, so a hot group is
    spread over all tasks."""
    marked = winners.select(F.col(unique_id), F.lit(1).alias("__won"))
    return df.join(marked, unique_id, "left").withColumn(
        name, F.when(F.col("__won").isNotNull(), yes).otherwise(no)
    ).drop("__won")


def select_best(
    df: DataFrame,
    family: str,
    order: list[Column],
    unique_id: str,
    eligible: Column | None = None,
    name: str = "selection_status",
    yes: str = "selected",
    no: str = "not_selected",
) -> DataFrame:
    """Best row per family among eligible rows; every row is kept and labelled."""
    pool = df if eligible is None else df.filter(eligible)
    return label_winners(df, top_n(pool, family, order, 1), unique_id, name, yes, no)


def latest_per_group(
    df: DataFrame, text: str, pattern: str, stamp: str, unique_id: str
) -> DataFrame:
    """Latest row per name prefix is kept, older ones go to the archive."""
    grouped = df.withColumn("name_group", F.regexp_extract(text, pattern, 1))
    newest = top_n(
        grouped.filter(F.col("name_group") != ""),
        "name_group",
        [F.col(stamp).desc_nulls_last(), F.col(unique_id).desc()],
        1,
    )
    labelled = label_winners(grouped, newest, unique_id, "retention", "keep_latest", "archive_older")
    return labelled.withColumn(
        "retention", F.when(F.col("name_group") == "", "not_grouped").otherwise(F.col("retention"))
    )


def diverse_top_n(
    df: DataFrame, group, order: list[Column], n: int, unique_id: str
) -> DataFrame:
    """Best row of every group first, then the best of the rest, ``n`` in all.

    The ``n`` best rows overall hold enough of the rest to fill up, so only they and the group
    winners are compared."""
    firsts = top_n(df, group, order, 1).withColumn("group_first", F.lit(True))
    head = df.orderBy(*order).limit(n).withColumn("group_first", F.lit(False))
    rest = head.join(firsts.select(unique_id), unique_id, "left_anti")
    pool = firsts.unionByName(rest)
    return pool.orderBy(F.desc("group_first"), *order).limit(n)


def numbered_hashes(hashes: DataFrame, hash_col: str, name: str, prefix: int = 3) -> DataFrame:
    """Consecutive numbers, in hash order, for a table of distinct hex hashes.

    Hashes are spread evenly by their prefix: rows are numbered within a prefix and shifted by the
    count of earlier prefixes, a table of at most ``16 ** prefix`` rows."""
    tagged = hashes.withColumn("__prefix", F.substring(hash_col, 1, prefix))
    sizes = tagged.groupBy("__prefix").agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "__prefix", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__shift")
    )
    inside = Window.partitionBy("__prefix").orderBy(hash_col)
    return (
        tagged.withColumn("__rn", F.row_number().over(inside))
        .join(shifts, "__prefix")
        .withColumn(name, F.col("__shift") + F.col("__rn"))
        .drop("__prefix", "__rn", "__shift")
    )


def duplicate_groups(
    inv: DataFrame, hash_col: str, path: str, penalty: Column | None = None
) -> DataFrame:
    """Files with equal content: group number, size, and which copy to keep (least penalty, then
    shortest path, then first path). Paths are unique."""
    cost = F.lit(0) if penalty is None else penalty
    rank = F.struct(cost.alias("a"), F.length(path).alias("b"), F.lower(path).alias("c"))
    groups = (
        inv.filter(F.col(hash_col).isNotNull())
        .groupBy(hash_col)
        .agg(F.count("*").alias("group_size"), F.min_by(path, rank).alias("__keep"))
        .filter("group_size > 1")
    )
    numbered = numbered_hashes(groups, hash_col, "duplicate_group_id")
    kept = F.col(path) == F.col("__keep")
    return (
        inv.join(numbered, hash_col)
        .withColumn("suggested_keep", kept)
        .withColumn(
            "suggested_action", F.when(kept, "keep_active_copy").otherwise("archive_duplicate_copy")
        )
        .drop("__keep")
    )


def ffill(
    df: DataFrame, partition, order: str, columns: list[str], block: int | None = 4096
) -> DataFrame:
    """Carry the last non-null value forward within a partition.

    ``order`` is a whole number, unique in its partition. Rows are filled inside blocks of
    ``block`` positions; the last value of each earlier block fills what is still empty. A window
    therefore never holds more than one block of rows, or one row per block. ``block=None`` is for
    partitions that are short by nature, such as one row of a sheet: one plain window."""
    keys = _names(partition)
    if block is None:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select(
            *[F.last(c, ignorenulls=True).over(w).alias(c) if c in columns else F.col(col_name(c)) for c in df.columns]
        )
    blocked = df.withColumn("__block", F.floor(F.col(order) / block))
    inside = Window.partitionBy(*keys, "__block").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    filled = blocked.select(
        *[col_name(c) for c in blocked.columns if c not in columns],
        *[F.last(c, ignorenulls=True).over(inside).alias(c) for c in columns],
    )
    last = blocked.groupBy(*keys, "__block").agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__last_{c}")
            for c in columns
        ]
    )
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = last.select(
        *keys,
        "__block",
        *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__in_{c}") for c in columns],
    )
    joined = filled.join(carry, [*keys, "__block"])
    return joined.select(
        *[
            F.coalesce(F.col(c), F.col(f"__in_{c}")).alias(c) if c in columns else F.col(col_name(c))
            for c in df.columns
        ]
    )


def carry_context(
    tokens: DataFrame, page: str, position: str, tag: str, text: str, levels=("h2", "h3", "h4")
) -> DataFrame:
    """Headings in force at every token; a heading clears the levels below it.

    Each level carries (position, text) of its last heading; a lower heading counts only when it
    stands after the last heading of every level above."""
    marked = tokens.select(
        "*",
        *[
            F.when(F.col(tag) == level, F.struct(F.col(position).alias("p"), F.col(text).alias("t")))
            .alias(f"__{level}")
            for level in levels
        ],
    )
    filled = ffill(marked, page, position, [f"__{level}" for level in levels])
    out, above = [], None
    for level in levels:
        here = F.col(f"__{level}")
        live = here["t"] if above is None else F.when(here["p"] > above, here["t"])
        out.append(F.coalesce(live, F.lit("")).alias(level))
        place = F.coalesce(here["p"], F.lit(-1))
        above = place if above is None else F.greatest(above, place)
    return filled.select(*[col_name(c) for c in tokens.columns], *out)


def sort_nulls_last(df: DataFrame, *spec: str) -> DataFrame:
    """Sort by names, ``-name`` for descending, nulls last either way."""
    return df.orderBy(
        *[
            F.col(s[1:]).desc_nulls_last() if s.startswith("-") else F.col(s).asc_nulls_last()
            for s in spec
        ]
    )


def numbered_sort(df: DataFrame, *spec: str, name: str = "place") -> DataFrame:
    """Every row with its place from 1 in the order of ``sort_nulls_last``.

    The sort deals ranges over tasks; each task numbers its own rows, and a table of one row per task
    holds where each range begins. The sorted rows are written once, as a second sort may cut its
    ranges elsewhere."""
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranges = sort_nulls_last(df, *spec).withColumns({"__range": F.spark_partition_id(), "__within": within})
    stored = materialise(ranges, "sorted")
    along = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    begins = stored.groupBy("__range").agg(F.count("*").alias("__n")).select(
        "__range", F.coalesce(F.sum("__n").over(along), F.lit(0)).alias("__before")
    )
    placed = stored.join(begins, "__range").withColumn(name, F.col("__before") + F.col("__within") + 1)
    return placed.drop("__range", "__within", "__before")


def head(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Stack by column name; a column missing from a table is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def matched_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def missing_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def all_keys(frames: list[DataFrame], key: str) -> DataFrame:
    return reduce(DataFrame.union, [f.select(key) for f in frames]).distinct()


def merge_records(
    frames: list[tuple[str, DataFrame]], key: str, fill: list[str], order: str, sep: str = ";", counted: bool = False
) -> DataFrame:
    """One record per key: the origin of every record joined in the order of ``frames``, blanks
    filled from later records.

    Records are counted per key and source first, so what is shuffled and listed is one entry per
    source. The joined text names an origin once for each of its records, as long as that is; with
    ``counted`` it names each origin once, with the number of its records (``a*3``)."""
    parts = []
    for i, (origin, frame) in enumerate(frames):
        blank_free = [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) for c in fill]
        rows = frame.select(key, F.col(order).alias("__order"), *blank_free)
        parts.append(
            rows.groupBy(key).agg(
                F.count("*").alias("__n"),
                *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__order"))).alias(c) for c in fill],
            ).select("*", F.lit(i).alias("__i"), F.lit(origin).alias("__origin"))
        )
    entries = F.array_sort(F.collect_list(F.struct("__i", "__origin", "__n")))
    if counted:
        repeated = F.transform(entries, lambda x: F.concat(x["__origin"], F.lit("*"), x["__n"].cast("string")))
    else:
        repeated = F.flatten(F.transform(entries, lambda x: F.array_repeat(x["__origin"], x["__n"].cast("int"))))
    return union_all(parts).groupBy(key).agg(
        F.array_join(repeated, sep).alias("record_origin"),
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__i"))).alias(c) for c in fill],
    )
