"""Sorts, pages and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def recent_page(df: DataFrame, order: list[Column], page: int, size: int, cols: list[str]) -> DataFrame:
    """One page of the sorted rows, each with the total; the order must be total."""
    total = df.agg(F.count("*"))
    paged = df.select(*cols).orderBy(*order).offset((page - 1) * size).limit(size)
    return paged.select("*", total.scalar().alias("total"))


def _before(order: list[str], row: tuple) -> Column:
    """Whether a row comes strictly before the given one; NULL is the least value."""
    out = F.lit(False)
    for name, value in reversed(list(zip(order, row))):
        c, descending = F.col(name.removeprefix("-")), name.startswith("-")
        if value is None:
            earlier, same = (c.isNotNull() if descending else F.lit(False)), c.isNull()
        else:
            v = F.lit(value)
            earlier = (c > v) if descending else (c < v) | c.isNull()
            same = c == v
        out = F.coalesce(earlier, F.lit(False)) | (F.coalesce(same, F.lit(False)) & out)
    return out


def deep_page(
    df: DataFrame, order: list[str], page: int, size: int, cols: list[str], ranges: int = 64, rows_per_range: int = 1_000_000, seed: int = 7,
) -> DataFrame:
    """One page of the sorted rows, each with the total, without sorting what lies before it.

    `order` names columns, "-name" for descending; together they must be a total order.
    Borders drawn from a sample cut the rows into about `ranges` ranges, which are
    counted in one pass, without a shuffle; sums of the counts tell which ranges
    hold the page. That is repeated within them until they are small, and only they are
    sorted. The driver sees the sample's keys and the counts; the counts are exact,
    so the page is, however the sample fell.
    """
    names = [n.removeprefix("-") for n in order]
    keys = [F.desc(n.removeprefix("-")) if n.startswith("-") else F.asc(n) for n in order]
    total = rows = df.count()
    skip, found = (page - 1) * size, df
    while rows > max(rows_per_range, 2 * size):
        share = min(1.0, 50 * ranges / rows)
        drawn = [tuple(r) for r in found.select(*names).sample(share, seed).orderBy(*keys).limit(200 * ranges).collect()]
        step = max(1, len(drawn) // ranges)
        borders = list(dict.fromkeys(drawn[step::step]))
        if not borders:
            break
        counted = found.agg(*[F.count_if(_before(order, b)).alias(f"b{k}") for k, b in enumerate(borders)]).first()
        low = max((k for k in range(len(borders)) if counted[k] <= skip), default=None)
        high = min((k for k in range(len(borders)) if counted[k] >= skip + size), default=None)
        begin = 0 if low is None else counted[low]
        end = rows if high is None else counted[high]
        if end - begin >= rows:
            break
        if low is not None:
            found = found.filter(~_before(order, borders[low]))
        if high is not None:
            found = found.filter(_before(order, borders[high]))
        skip, rows, seed = skip - begin, end - begin, seed + 1
    paged = found.select(*cols).orderBy(*keys).offset(skip).limit(size)
    return paged.withColumn("total", F.lit(total).cast("long"))


def recent_sample(df: DataFrame, non_empty: Column, order: list[Column], n: int = 5) -> DataFrame:
    return df.filter(non_empty).orderBy(*order).limit(n)


def display_top(df: DataFrame, order: list[Column], n: int = 10) -> DataFrame:
    """The first n hits, each with the number of all hits."""
    total = df.agg(F.count("*"))
    return df.orderBy(*order).limit(n).select("*", total.scalar().alias("total"))


def union_tables(*tables: DataFrame) -> DataFrame:
    """Tables one after another; a column missing in one is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_channels(df: DataFrame, channel: str, wanted: list) -> DataFrame:
    """The rows of the wanted channels, in one scan of a store that holds all of them."""
    return df.filter(F.col(channel).isin(wanted))


def set_difference(all_rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return all_rows.join(done.select(*keys), keys, "left_anti")
