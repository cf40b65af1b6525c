"""Line work inside one text value.

A text is split, filtered and joined again within its own row, so cleaning a
corpus needs no shuffle whatever the number of lines.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

from exposura import rules
from exposura.functions.text import bind, contains_any, strip, symbol_ratio


def split_lines(c: Column) -> Column:
    return F.split(F.replace(c, F.lit("\r\n"), F.lit("\n")), "\n", -1)


def is_banner(line: Column) -> Column:
    """Blank, decorative, comment, promotional or a lone address.

    Patterns tied to the start of a line are tried only where its first
    characters allow them.
    """

    def verdict(s: Column) -> Column:
        decorative = F.left(s, F.lit(1)).rlike(rules.DECORATIVE_LINE) & s.rlike(rules.DECORATIVE_LINE)
        comment = reduce(lambda a, b: a | b, [s.startswith(x) for x in rules.COMMENT_STARTS])
        lone = F.left(s, F.lit(4)).rlike("(?i)http") & s.rlike(rules.LONE_URL_LINE)
        return (s == "") | decorative | comment | lone | contains_any(s, rules.BANNER_KEYWORDS)

    return bind(strip(line), verdict)


def is_symbol_line(line: Column, ratio: float = 0.8) -> Column:
    """Over ten characters, and a higher share of symbols than the ratio.

    So many symbols cannot be spread without some standing side by side; lines
    without such a run are settled by a search and need no count.
    """
    run = math.ceil(11 * ratio / (11 * (1 - ratio) + 1))
    crowded = f"{rules.SYMBOL_CLASS}{{{max(1, run)}}}"
    return bind(
        strip(line), lambda s: (F.length(s) > 10) & s.rlike(crowded) & (symbol_ratio(s) > ratio)
    )


def _keep(c: Column, test) -> Column:
    return F.array_join(F.filter(split_lines(c), test), "\n")


def drop_banner_lines(c: Column) -> Column:
    return _keep(c, lambda x: ~is_banner(x))


def drop_symbol_lines(c: Column, ratio: float = 0.8) -> Column:
    return _keep(c, lambda x: ~is_symbol_line(x, ratio))


def drop_keyword_lines(c: Column, words: list[str] = rules.SKIP_WORDS) -> Column:
    """Blank lines and lines holding a skip word go; the rest is stripped."""
    kept = F.filter(
        F.transform(split_lines(c), strip), lambda x: (x != "") & ~contains_any(x, words)
    )
    return F.array_join(kept, "\n")


def line_clean(c: Column) -> Column:
    """Banner and symbol lines removed in one pass."""
    return _keep(c, lambda x: ~is_banner(x) & ~is_symbol_line(x))


def separator_position(c: Column, pattern: str = rules.SEPARATOR_LINE) -> Column:
    """Position of the first separator line, from 1; NULL without one."""
    flags = F.transform(split_lines(c), lambda x: x.rlike(pattern))
    return F.nullif(F.array_position(flags, True), F.lit(0).cast("long"))


def is_art(line: Column) -> Column:
    return F.length(line) - F.length(F.regexp_replace(line, f"[{rules.ART_CHARS}]", "")) > 3


def is_spam(line: Column) -> Column:
    s = strip(line)
    other = F.length(F.regexp_replace(s, r"[\x00-\x7f]", ""))
    return (F.length(s) > 0) & (other * 2 > F.length(s))


def strip_watermark(
    c: Column, pattern: str = rules.SEPARATOR_LINE, keep_prefixes: list[str] | None = None
) -> Column:
    """Text after the first separator line, up to the next art block.

    Blank lines at its start and spam lines go. A text without a separator is
    returned as it is.
    """
    lines = split_lines(c)
    start = separator_position(c, pattern)
    tail = F.slice(lines, start.cast("int") + 1, F.greatest(F.size(lines) - start.cast("int"), F.lit(0)))
    first_data = F.array_position(F.transform(tail, lambda x: strip(x) != ""), True).cast("int")
    body = F.when(
        first_data > 0, F.slice(tail, first_data, F.greatest(F.size(tail) - first_data + 1, F.lit(0)))
    ).otherwise(F.slice(tail, 1, 0))
    art = F.array_position(F.transform(body, is_art), True).cast("int")
    shown = F.when(art > 0, F.slice(body, 1, F.greatest(art - 1, F.lit(0)))).otherwise(body)

    def wanted(x: Column) -> Column:
        ok = ~is_spam(x)
        for prefix in keep_prefixes or []:
            ok = ok | strip(x).startswith(prefix)
        return ok

    return F.when(start.isNull(), c).otherwise(F.array_join(F.filter(shown, wanted), "\n"))


def blocks(c: Column, start: str) -> Column:
    """Text cut before every line that starts with the pattern."""
    return F.split(c, rf"\n(?={start})", -1)


def numbered_lines(c: Column) -> Column:
    """(line_number, line) of the lines that are neither blank nor comments."""
    pairs = F.transform(
        split_lines(c),
        lambda x, i: F.struct((i + 1).cast("long").alias("line_number"), x.alias("line")),
    )
    return F.filter(pairs, lambda p: (strip(p["line"]) != "") & ~p["line"].startswith("#"))
