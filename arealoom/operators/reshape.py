"""Long to wide, wide to long, and measures selected by specification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.functions.text import key_slug
from arealoom.session import col_name


def listed(name, names: list[str]) -> Column:
    """The name where it is listed; any other raises when the row is read. Null stays null."""
    column = F.col(name) if isinstance(name, str) else name
    unknown = F.raise_error(F.concat(F.lit("name not listed for the pivot: "), column.cast("string")))
    return F.when(column.isNull() | column.isin(list(names)), column).otherwise(unknown)


def pivot_first(
    df: DataFrame, key, name: str, value: str, names: list[str], order: Column
) -> DataFrame:
    """Widen a long table; of repeated cells the first by ``order`` is kept.

    ``names`` is given, so no job is spent on finding them and the columns are stable; a row with
    another name raises instead of vanishing."""
    keys = [key] if isinstance(key, str) else list(key)
    checked = df.withColumn("__name", listed(F.col(col_name(name)), names))
    return checked.groupBy(*keys).pivot("__name", names).agg(F.min_by(value, order))


def pivot_sum(
    df: DataFrame,
    key,
    descriptors: list[str],
    value: str,
    names: list[str],
    fill: float | None = 0.0,
    prefix: str = "",
    max_len: int = 90,
) -> DataFrame:
    """Widen on the joined descriptors, summing; absent cells become ``fill``. A label over ``max_len``
    ends in a hash of the whole, so different descriptors never share a column; a label that is not
    in ``names`` raises."""
    keys = [key] if isinstance(key, str) else list(key)
    label = listed(key_slug(F.concat_ws("__", *descriptors), max_len, "plain"), names)
    wide = df.withColumn("__label", label).groupBy(*keys).pivot("__label", names).agg(F.sum(value))
    cells = [
        F.col(col_name(n)) if fill is None else F.coalesce(F.col(col_name(n)), F.lit(fill))
        for n in names
    ]
    return wide.select(*keys, *[c.alias(prefix + n) for c, n in zip(cells, names)])


def melt(df: DataFrame, ids: list[str], cols: list[str], name="column_name", value="value") -> DataFrame:
    """Indicator columns to rows, nulls left out."""
    return df.unpivot(ids, cols, name, value).filter(F.col(value).isNotNull())


def spec_condition(spec: dict[str, str]) -> Column:
    """All columns equal their value; an empty value accepts blank or null."""
    cond = F.lit(True)
    for column, wanted in spec.items():
        c = F.col(col_name(column))
        if wanted == "":
            cond = cond & (F.trim(F.coalesce(c, F.lit(""))) == "")
        else:
            cond = cond & (c == wanted)
    return cond


def select_measures(
    long: DataFrame,
    key,
    specs: dict[str, dict[str, str]],
    number: str,
    raw: str,
    status: str,
    order: Column,
    year: str | None = None,
    years: list | None = None,
) -> DataFrame:
    """Value, raw text and publication status of each specified measure, one row per key. With ``years``
    each measure is taken for each of these values of the column ``year``, named by both.

    All measures come from one conditional aggregate. A measure that no row of the whole table
    carries is marked ``not_found_in_extract``; one missing for a key only is null."""
    keys = [key] if isinstance(key, str) else list(key)
    if years is not None:
        specs = {f"{name}_{y}": {**spec, year: str(y)} for y in years for name, spec in specs.items()}
    conditions = {name: spec_condition(spec) for name, spec in specs.items()}
    aggs = []
    for name, cond in conditions.items():
        cell = F.struct(
            F.col(number).alias("number"), F.col(raw).alias("raw"), F.col(status).alias("status")
        )
        aggs.append(F.min_by(cell, F.when(cond, order)).alias(name))
    wide = long.groupBy(*keys).agg(*aggs)
    found = long.agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in conditions.items()])
    out = []
    for name in conditions:
        known = found.select(name).scalar()
        cell = F.col(name)
        out += [
            cell["number"].alias(name),
            cell["raw"].alias(f"{name}_source_value"),
            F.when(~known, "not_found_in_extract").otherwise(cell["status"]).alias(
                f"{name}_publication_status"
            ),
        ]
    return wide.select(*keys, *out)
