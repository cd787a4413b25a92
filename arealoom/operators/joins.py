"""Contract-checked joins.

No join carries a broadcast hint: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``. Beyond that AQE splits the hot keys of a join of two tables,
but not of a join onto an aggregate of the same key: the aggregate stands between its exchange and
the join. ``spread_join`` gives such an aggregate an exchange of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.functions.text import norm_code, path_parts
from arealoom.operators.audit import ContractError, expect_unique
from arealoom.session import col_name


def spread_join(left: DataFrame, right: DataFrame, on: list[tuple[Column, str]], how: str = "left") -> DataFrame:
    """Join onto ``right``, an aggregate with one row per key, so that AQE can split hot keys of the left.

    ``on`` pairs a key of the left with a column of ``right``; the key columns of ``right`` are left out
    of the result. AQE splits a join only where both sides come straight from an exchange of their
    own. A hash of the keys, asked for beside them, gives the aggregate one: it is small (a row per
    key), and the rows of a hot key are then dealt over tasks by the map tasks they come from, repeated
    rows too. A side under the broadcast threshold is broadcast by its measured size. Only the columns
    that are used later are read.
    """
    ours = [f.dataType for f in left.select(*[c for c, _ in on]).schema.fields]
    theirs = [f.dataType for f in right.select(*[col_name(n) for _, n in on]).schema.fields]

    def common(column: Column, i: int) -> Column:
        # the type that Spark compares the two keys in
        if ours[i] == theirs[i]:
            return column
        return F.coalesce(F.lit(None).cast(ours[i]), F.lit(None).cast(theirs[i]), column)

    keys = [f"__on{i}" for i in range(len(on))]
    others = [F.col(col_name(c)) for c in right.columns if c not in [name for _, name in on]]
    keyed = right.select(*[F.col(col_name(name)).alias(k) for k, (_, name) in zip(keys, on, strict=True)], *others)
    keyed = keyed.withColumn("__print", F.xxhash64(*[common(F.col(k), i) for i, k in enumerate(keys)]))
    same = F.xxhash64(*[common(c, i) for i, (c, _) in enumerate(on)]) == F.col("__print")
    for k, (column, _) in zip(keys, on, strict=True):
        same = same & (column == F.col(k))
    return left.join(keyed, same, how).drop("__print", *keys)


def _names(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def settle_collisions(
    left: DataFrame, right: DataFrame, on, policy: str = "fail", suffixes=("_left", "_right")
) -> tuple[DataFrame, DataFrame]:
    """Give both sides of a join distinct column names: ``fail``, ``drop_left``, ``drop_right``,
    ``rename_right`` or ``suffix`` both."""
    keys = _names(on)
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    if not shared:
        return left, right
    if policy == "fail":
        raise ContractError(f"columns on both sides of the join: {shared}")
    if policy == "drop_left":
        return left.drop(*shared), right
    if policy == "drop_right":
        return left, right.drop(*shared)
    if policy == "rename_right":
        return left, right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    if policy == "suffix":
        return (
            left.withColumnsRenamed({c: c + suffixes[0] for c in shared}),
            right.withColumnsRenamed({c: c + suffixes[1] for c in shared}),
        )
    raise ValueError(f"unknown collision policy {policy!r}")


def contract_join(
    left: DataFrame,
    right: DataFrame,
    on,
    how: str = "left",
    validate: str = "1:1",
    flag: str | None = None,
    collision: str = "fail",
    suffixes=("_left", "_right"),
    check: bool = True,
) -> DataFrame:
    """Join under a declared cardinality (``1:1``, ``m:1``, ``1:m``, ``m:n``).

    A broken contract raises before any row is joined; the check reads only the key columns.
    ``flag`` names a presence column that is false, not null, on unmatched rows. Null keys never
    match.
    """
    keys = _names(on)
    left, right = settle_collisions(left, right, keys, collision, suffixes)
    if check:
        if validate in ("1:1", "1:m"):
            expect_unique(left, keys)
        if validate in ("1:1", "m:1"):
            expect_unique(right, keys)
    if not flag:
        return left.join(right, keys, how)
    joined = left.join(right.withColumn(flag, F.lit(True)), keys, how)
    rest = [F.col(col_name(c)) for c in joined.columns if c != flag]
    return joined.select(*rest, F.coalesce(flag, F.lit(False)).alias(flag))


def join_with_indicator(left: DataFrame, right: DataFrame, on, name: str = "merge_status") -> DataFrame:
    """Left join that says ``both`` or ``left_only`` on every row."""
    keys = _names(on)
    marked = right.withColumn("__right", F.lit(1))
    joined = left.join(marked, keys, "left")
    return joined.withColumn(
        name, F.when(F.col("__right").isNull(), "left_only").otherwise("both")
    ).drop("__right")


def unmatched(left: DataFrame, right: DataFrame, on, reason: str) -> DataFrame:
    return left.join(right.select(*_names(on)), _names(on), "left_anti").withColumn(
        "reason", F.lit(reason)
    )


def in_spine(df: DataFrame, spine: DataFrame, key) -> DataFrame:
    return df.join(spine.select(*_names(key)), _names(key), "left_semi")


def compose_bridge(fine_to_a: DataFrame, fine_to_b: DataFrame, unit, how: str = "inner") -> DataFrame:
    """Two mappings of the same fine unit make a mapping between their targets."""
    fine_to_a, fine_to_b = settle_collisions(fine_to_a, fine_to_b, unit, "rename_right", ("", "_b"))
    return fine_to_a.join(fine_to_b, _names(unit), how)


def merge_wide(frames: list[DataFrame], key) -> DataFrame:
    """Full outer merge of tables that hold one row per key; a column seen before is skipped.

    The tables are stacked and folded by key, so any number of them costs one shuffle. The same
    aggregate counts the rows of each table and raises where a key has two in one.
    """
    keys = _names(key)
    seen, kept = set(keys), []
    for frame in frames:
        fresh = [c for c in frame.columns if c not in seen]
        seen.update(fresh)
        mark = F.lit(1).alias(f"__row{len(kept)}")
        kept.append(frame.select(*keys, *[col_name(c) for c in fresh], mark))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept)
    marks = [f"__row{i}" for i in range(len(kept))]
    values = [c for c in stacked.columns if c not in keys and c not in marks]
    folded = stacked.groupBy(*keys).agg(
        *[F.first(col_name(c), ignorenulls=True).alias(c) for c in values],
        F.greatest(*[F.count(m) for m in marks], F.lit(0), F.lit(0)).alias("__most"),
    )
    once = F.when(F.col("__most") <= 1, True).otherwise(
        F.raise_error(F.concat(F.lit("a table to merge has several rows for key "), F.to_json(F.struct(*keys))))
    )
    return folded.filter(once).drop("__most")


def fallback_join(
    left: DataFrame,
    right: DataFrame,
    exact: tuple[str, str],
    derived: tuple[str, str],
    scope: str = "row",
    on_ambiguous: str = "refuse",
) -> DataFrame:
    """Left join on the exact key; rows without a match try a derived key.

    A derived key that stands for several exact keys is never used: its rows stay unmatched
    (``refuse``) or the join raises. ``scope="table"`` tries the derived key only when no row at
    all matches exactly. Adds ``join_method``.

    Keys are settled on the distinct (exact, derived) pairs of the left, where ``right`` is joined too;
    the rows of the left, which may be wide, take part in one join only.
    """
    (le, re_), (ld, rd) = exact, derived
    pairs = right.select(F.col(re_).alias("__re"), F.col(rd).alias("__rd")).distinct()
    known = pairs.groupBy("__re").agg(F.lit(True).alias("__known"))
    short = pairs.filter("__rd is not null and __re is not null").groupBy("__rd").agg(
        F.min("__re").alias("__only"), (F.min("__re") != F.max("__re")).alias("__ambiguous")
    )
    if on_ambiguous == "raise" and not short.filter("__ambiguous").limit(1).isEmpty():
        raise ContractError(f"derived key {rd} stands for several values of {re_}")
    asked = left.select(F.col(le).alias("__le"), F.col(ld).alias("__ld")).distinct()
    first = asked.join(known, F.col("__le") == F.col("__re"), "left").drop("__re")
    if scope == "table" and not first.filter("__known").limit(1).isEmpty():
        short = short.limit(0)
    short = short.withColumn("__short", F.lit(True))
    settled = first.join(short, F.col("__ld") == F.col("__rd"), "left").select(
        "__le",
        "__ld",
        F.when(F.col("__known"), F.col("__le")).when(~F.col("__ambiguous"), F.col("__only")).alias("__key"),
        F.when(F.col("__known"), "exact_key")
        .when(F.col("__ambiguous"), "ambiguous_derived_key")
        .when(F.col("__short"), "derived_key")
        .otherwise("unmatched")
        .alias("join_method"),
    )
    answer = settled.join(right, F.col("__key") == F.col(re_), "left").drop("__key")
    joined = left.join(answer, F.equal_null(F.col(le), F.col("__le")) & F.equal_null(F.col(ld), F.col("__ld")))
    return joined.select(*[left[col_name(c)] for c in left.columns], "join_method", *[answer[col_name(c)] for c in right.columns])


def flag_membership(df: DataFrame, members: DataFrame, key, name: str) -> DataFrame:
    keys = _names(key)
    marked = members.select(*keys).distinct().withColumn(name, F.lit(True))
    found = spread_join(df, marked, [(F.col(k), k) for k in keys])
    return found.withColumn(name, F.coalesce(name, F.lit(False)))


def reconcile_paths(
    register: DataFrame,
    inventory: DataFrame,
    moves: DataFrame,
    path: str = "path",
    active: str = "active",
    source: str = "source_path",
    destination: str = "destination_path",
) -> DataFrame:
    """Find where registered files live now: the path itself, then the move plan, then the file
    name among active files, then among archived ones. Adds ``new_path`` and ``path_status``."""
    here = inventory.select(
        F.lower(path).alias("__here"), F.col(path).alias("__path"), F.col(active).alias("__active")
    )
    planned = (
        moves.select(F.lower(source).alias("__from"), F.lower(destination).alias("__to"))
        .join(here, F.col("__to") == F.col("__here"), "inner")
        .groupBy("__from")
        .agg(F.min("__path").alias("__planned"))
    )
    by_name = (
        here.withColumn("__name", F.substring_index("__here", "/", -1))
        .groupBy("__name")
        .agg(
            F.count_if("__active").alias("__n_active"),
            F.count_if(~F.col("__active")).alias("__n_archive"),
            F.min(F.when(F.col("__active"), F.col("__path"))).alias("__first_active"),
            F.min(F.when(~F.col("__active"), F.col("__path"))).alias("__first_archive"),
        )
    )
    by_path = (
        here.select(F.col("__here").alias("__key"), F.col("__path").alias("__valid"))
        .unionByName(planned.select(F.col("__from").alias("__key"), "__planned"), allowMissingColumns=True)
        .groupBy("__key")
        .agg(F.min("__valid").alias("__valid"), F.min("__planned").alias("__planned"))
    )
    joined = spread_join(register, by_path, [(F.lower(path), "__key")])
    joined = spread_join(joined, by_name, [(F.lower(path_parts(path)["file_name"]), "__name")])
    status = (
        F.when(F.col("__valid").isNotNull(), "path_still_valid")
        .when(F.col("__planned").isNotNull(), "reconciled_from_move_plan")
        .when(F.col("__n_active") == 1, "unique_active_name")
        .when(F.col("__n_active") > 1, "first_of_several_active_names")
        .when(F.col("__n_archive") == 1, "unique_archive_name")
        .when(F.col("__n_archive") > 1, "first_of_several_archive_names")
        .otherwise("missing")
    )
    found = F.coalesce("__valid", "__planned", "__first_active", "__first_archive")
    return joined.select(
        *[F.col(col_name(c)) for c in register.columns],
        F.coalesce(found, F.col(path)).alias("new_path"),
        status.alias("path_status"),
    )


def lookup_manifest(
    files: DataFrame, manifest: DataFrame, path: str, manifest_path: str, value: str, order: str
) -> DataFrame:
    """Value of the manifest row with the same path, or else the same file name, in any case. The
    last manifest row by ``order`` wins."""
    rows = manifest.select(
        F.lower(manifest_path).alias("__p"), F.col(value).alias("__v"), F.col(order).alias("__o")
    )
    by_path = rows.groupBy("__p").agg(F.max_by("__v", "__o").alias("__by_path"))
    by_name = rows.groupBy(F.substring_index("__p", "/", -1).alias("__n")).agg(
        F.max_by("__v", "__o").alias("__by_name")
    )
    low = F.lower(path)
    found = spread_join(files, by_path, [(low, "__p")])
    found = spread_join(found, by_name, [(F.substring_index(low, "/", -1), "__n")])
    return found.withColumn(value, F.coalesce("__by_path", "__by_name")).drop("__by_path", "__by_name")


def ending_with(names: DataFrame, paths: DataFrame, name: str, path: str) -> DataFrame:
    """The rows of ``paths`` with every distinct ``name`` that their path ends with, as ``name``.

    An equality join: each path is cut to its last n characters for each length n that a name has
    (lengths are few), and only cuts that are names are kept. Empty names end nothing."""
    asked = names.select(F.col(name).alias("__n")).filter("length(__n) > 0").distinct()
    sizes = asked.agg(F.collect_set(F.length("__n"))).scalar()
    length = F.length(F.col(path))
    fitting = F.filter("__sizes", lambda n: n <= length)
    cuts = F.transform(fitting, lambda n: F.substr(F.col(path), length - n + 1, n))
    ends = paths.filter(F.col(path).isNotNull()).withColumn("__sizes", sizes).withColumn(name, F.explode(cuts)).drop("__sizes")
    return ends.join(asked, F.col(name) == F.col("__n"), "left_semi")


def lookup_any(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[Column, Column]],
    order: str,
    take: list[str],
    suffixes: list[tuple[str, str]] = (),
) -> DataFrame:
    """First row of ``right``, by ``order``, that agrees with a left row on any of several keys, or whose
    path ends with a left name; ``suffixes`` pairs columns of names with columns of paths.

    The OR is split into one equality per key, and ``right`` is first cut to its first row per
    key value, so a key shared by many rows multiplies nothing.
    """
    packed = F.struct(F.col(order).alias("__order"), *[F.col(c).alias(c) for c in take])
    sides = [(left_key, right.select(right_key.alias("__k"), packed.alias("__row"))) for left_key, right_key in keys]
    for name, path in suffixes:
        paths = right.select(F.col(path).alias("__path"), packed.alias("__row"))
        ends = ending_with(left.select(F.col(name).alias("__k")), paths, "__k", "__path")
        sides.append((F.col(name), ends.select("__k", "__row")))
    joined, names = left, []
    for i, (left_key, side) in enumerate(sides):
        first = side.filter("__k is not null").groupBy(F.col("__k").alias(f"__k{i}")).agg(F.min("__row").alias(f"__row{i}"))
        joined = spread_join(joined, first, [(left_key, f"__k{i}")])
        names.append(f"__row{i}")
    best = F.array_min(F.array_compact(F.array(*names)))
    return joined.withColumn("__best", best).select(
        *[F.col(col_name(c)) for c in left.columns], *[F.col(f"__best.{c}").alias(c) for c in take]
    )


def unpivot_text(df: DataFrame, columns=None, ids=()) -> DataFrame:
    """(ids, column_name, value) with every value as text, in one pass over the table."""
    names = [c for c in (columns or df.columns) if c not in ids]
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(col_name(c)).cast("string").alias("value"))
            for c in names
        ]
    )
    return df.select(*ids, F.inline(pairs))


def discover_keys(
    df: DataFrame,
    targets: dict[str, Column | DataFrame],
    columns=None,
    min_rate: float = 0.85,
) -> DataFrame:
    """Match every column of ``df`` against every target key set.

    One distinct pass over (column, value) serves all targets. Match rate is the share of the
    column's distinct values found in the target, coverage the share of the target found.
    """
    names = sorted(targets)
    sets = reduce(
        DataFrame.unionByName,
        [
            targets[n].select(F.lit(n).alias("target"), norm_code(F.col(targets[n].columns[0])).alias("value"))
            for n in names
        ],
    ).filter("value is not null").distinct()
    sizes = sets.groupBy("target").agg(F.count("*").alias("target_keys"))
    values = (
        unpivot_text(df, columns)
        .select("column_name", norm_code("value").alias("value"))
        .filter("value is not null")
        .distinct()
    )
    unique = values.groupBy("column_name").agg(F.count("*").alias("unique_values"))
    hits = values.join(sets, "value").groupBy("column_name", "target").agg(
        F.count("*").alias("matched_values")
    )
    grid = unique.select("*", F.explode(F.array(*[F.lit(n) for n in names])).alias("target"))
    matched = F.coalesce("matched_values", F.lit(0).cast("long"))
    rate = matched / F.col("unique_values")
    return (
        grid.join(hits, ["column_name", "target"], "left")
        .join(sizes, "target", "left")
        .select(
            "column_name",
            "target",
            "unique_values",
            matched.alias("matched_values"),
            rate.alias("match_rate"),
            F.try_divide(matched, F.col("target_keys")).alias("coverage"),
            F.when(rate >= min_rate, "join_candidate")
            .when(rate > 0, "manual_review_key_match_below_threshold")
            .otherwise("hold_no_validated_key_match")
            .alias("recommendation"),
        )
    )
