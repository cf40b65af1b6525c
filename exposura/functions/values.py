"""Array, map, JSON and number functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def map_skip_empty(m: Column) -> Column:
    return F.map_filter(m, lambda k, v: v.isNotNull() & (v != ""))


def map_prefix_strip(m: Column, prefix: str = "extra_data.") -> Column:
    """extra_data.x becomes x; other keys stay."""
    return F.transform_keys(
        m, lambda k, v: F.when(k.startswith(prefix), F.substr(k, F.lit(len(prefix) + 1))).otherwise(k)
    )


def map_merge(first: Column, second: Column) -> Column:
    """Update: a key of the second map replaces that of the first."""
    kept = F.map_filter(first, lambda k, v: ~F.map_contains_key(second, k))
    return F.map_concat(kept, second)


def json_get(c: Column, key: str) -> Column:
    return F.get_json_object(c, f"$.{key}")


def last_non_empty(*cols: Column) -> Column:
    return first_non_empty(*reversed(cols))


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def skip_rate(skipped: Column, parsed: Column) -> Column:
    return F.coalesce(F.try_divide(skipped.cast("double"), parsed.cast("double")), F.lit(0.0))


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)
