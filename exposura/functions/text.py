"""String functions."""

from __future__ import annotations

import re

from functools import reduce

from pyspark.sql import Column, functions as F

from exposura import rules


WHITE_SPACE = " \t\n\r\f\x0b"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_token(c: Column) -> Column:
    """Placeholder words become NULL; anything else is stripped."""
    clean = strip(c)
    return F.when(~F.lower(clean).isin(rules.NULL_TOKENS), clean)


def norm_email(c: Column) -> Column:
    return F.lower(strip(c))


def norm_phone(c: Column) -> Column:
    """Digits only; a leading plus is kept."""
    clean = strip(c)
    digits = F.regexp_replace(clean, "[^0-9]", "")
    return F.when(clean.startswith("+"), F.concat(F.lit("+"), digits)).otherwise(digits)


def is_phone(c: Column) -> Column:
    clean = strip(c)
    digits = F.length(F.regexp_replace(clean, "[^0-9]", ""))
    return clean.rlike(r"^\+?[0-9][0-9\s\-(). ]{6,19}$") & digits.between(7, 15)


def asset_kind(c: Column) -> Column:
    digits = F.regexp_replace(c, r"[\s\-+().]", "")
    return (
        F.when(c.contains("@"), "email")
        .when(digits.rlike("^[0-9]{7,15}$"), "phone")
        .when(c.contains(".") & ~c.startswith("http"), "domain")
        .otherwise("username")
    )


def asset_kind2(c: Column) -> Column:
    return (
        F.when(c.rlike(r"^[^@]+@[^@]+\.[^@]+"), "email")
        .when(c.rlike("^https?://"), "url")
        .when(c.rlike(r"^(?:[a-zA-Z0-9-]+\.)+[a-zA-Z]{2,}$"), "domain")
        .when(~c.rlike("^[0-9]+$") & ~c.contains(" ") & ~c.contains("."), "username")
        .otherwise("keyword")
    )


def is_ip(c: Column) -> Column:
    return c.rlike(r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$")


def is_url(c: Column) -> Column:
    low = F.lower(c)
    return (
        F.when(low.rlike(r"^(https?://|android://|chrome://|ftp://|www\.)"), True)
        .when(c.contains("@"), False)
        .when(low.contains("/") & low.contains("."), True)
        .otherwise(low.rlike(r"^(?:[a-z0-9\-]+\.)+[a-z]{2,6}$"))
    )


def is_valid_host(c: Column) -> Column:
    low = F.lower(strip(c))
    return (F.length(low) >= 3) & (
        low.rlike("^(https?|android|ftp|ssh|mongodb|mysql)://")
        | low.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}(:[0-9]+)?$")
        | (low.contains("[") & low.contains("]"))
        | (low.contains(".") & low.rlike(r"\p{L}"))
    )


def norm_host(c: Column) -> Column:
    """No trailing slash; the scheme in lower case, or the whole where there is none."""
    clean = F.regexp_replace(strip(c), "/+$", "")
    scheme = F.regexp_extract(clean, "^(.*?://)", 1)
    rest = F.substr(clean, F.length(scheme) + 1)
    return F.when(scheme != "", F.concat(F.lower(scheme), rest)).otherwise(F.lower(clean))


def fix_double_scheme(c: Column) -> Column:
    """The first of several stacked schemes is kept."""
    return F.regexp_replace(c, "^(https?://)(?:https?://)+", "$1")


def url_host(c: Column) -> Column:
    return F.regexp_extract(c, "https?://([^/:]+)", 1)


def host_of(c: Column) -> Column:
    """Host of an address, e-mail or bare host, lower case, without port."""
    tail = F.substring_index(c, "@", -1)
    no_scheme = F.regexp_replace(tail, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.lower(F.regexp_extract(no_scheme, r"^([^/:?#\s]+)", 1))


def parse_suffixes(lines: list[str]) -> list[str]:
    """Entries of a public-suffix file; blank lines and // comments are no entries."""
    return [line.split()[0].lower() for line in lines if line.strip() and not line.strip().startswith("//")]


def registered_domain(c: Column, suffixes: list[str]) -> Column:
    """Longest listed public suffix plus one label, or "" when none is listed.

    An entry "*.name" makes every label before the name part of the suffix; "!a.name"
    excepts that host from it, which is then a registered domain itself. Each ending of the host is looked up in the list as a hashed set, from the
    longest down, so a list of thousands costs a few lookups and no join.
    """
    plain: dict[int, list[str]] = {}
    wild: dict[int, list[str]] = {}
    excepted: dict[int, list[str]] = {}
    for suffix in suffixes:
        kind = wild if suffix.startswith("*.") else excepted if suffix.startswith("!") else plain
        kind.setdefault(suffix.count(".") + 1, []).append(suffix.lower().removeprefix("*.").removeprefix("!"))

    def longest(labels: Column) -> Column:
        def ending(k: int) -> Column:
            return F.when(F.size(labels) >= k, F.array_join(F.slice(labels, -k, k), "."))

        tests = [(ending(k).isin(excepted[k]), ending(k)) for k in sorted(excepted, reverse=True)]
        for k in sorted({*plain, *wild}, reverse=True):
            listed = ending(k).isin(plain[k]) if k in plain else F.lit(False)
            if k in wild:
                listed = listed | ending(k - 1).isin(wild[k])
            tests.append(((F.size(labels) > k) & listed, ending(k + 1)))
        return first_rule(tests, F.lit(""))

    return bind(F.split(host_of(c), "[.]", -1), longest)


def quoted_fields(c: Column, delim: str = ",") -> Column:
    """Fields of a delimited line; a quoted field may hold the delimiter, two quotes in it stand for one.

    A quote opens a field only at its beginning; what follows the closing quote is
    kept; a field whose quote is never closed is taken as it is. Lines without a quote
    are only split.
    """
    d = re.escape(delim)
    quoted = r'(?s)^"((?:[^"]|"")*+)"(?!")(.*)$'

    def bare(field: Column) -> Column:
        inner = F.replace(F.regexp_extract(field, quoted, 1), F.lit('""'), F.lit('"'))
        return F.when(field.rlike(quoted), F.concat(inner, F.regexp_extract(field, quoted, 2))).otherwise(field)

    def cut(line: Column) -> Column:
        pattern = rf'(?s){d}("(?:[^"]|"")*+"(?!")[^{d}]*+|[^{d}]*+)'
        return F.transform(F.regexp_extract_all(F.concat(F.lit(delim), line), F.lit(pattern), F.lit(1)), bare)

    return bind(c, lambda line: F.when(line.contains('"'), cut(line)).otherwise(F.split(line, d, -1)))


def abs_url(href: Column, root: Column) -> Column:
    return F.when(href.startswith("http"), href).otherwise(
        F.concat(root, F.lit("/"), F.regexp_replace(href, "^/+", ""))
    )


def root_url(c: Column) -> Column:
    return F.regexp_extract(c, "^([a-zA-Z]+://[^/?#]+)", 1)


def strip_query(c: Column) -> Column:
    return F.substring_index(c, "?", 1)


def _dashed(c: Column, keep: str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), f"[^{keep}]", "-"), "-+", "-")


def slug_name(c: Column) -> Column:
    """File name without extensions and [tags], dashed; "general" when nothing is left."""
    base = F.regexp_extract(F.substring_index(c, "/", -1), r"^([^.]*)", 1)
    untagged = F.regexp_replace(base, r"\[.*?\]", "")
    slug = F.regexp_replace(_dashed(untagged, "a-z0-9"), "^-+|-+$", "")
    return F.when(slug == "", "general").otherwise(slug)


def slug_index(c: Column, prefix: str) -> Column:
    slug = F.regexp_replace(_dashed(c, "a-z0-9_-"), "^-+|-+$", "")
    return F.left(
        F.when(slug.startswith(prefix), slug).otherwise(F.concat(F.lit(prefix), slug)), F.lit(100)
    )


def slug_asset(kind: Column, c: Column, prefix: str) -> Column:
    return F.concat(
        F.lit(prefix), kind, F.lit("-"), F.left(F.regexp_replace(F.lower(c), "[^a-z0-9]", ""), F.lit(80))
    )


def filename_tag(c: Column) -> Column:
    up = F.upper(c)
    return (
        F.when(up.contains("[HASH]"), "hash").when(up.contains("[NOHASH]"), "nohash").otherwise("unknown")
    )


def shape_signature(c: Column) -> Column:
    return F.left(F.regexp_replace(c, r"[\p{L}\p{N}]", ""), F.lit(15))


def symbol_ratio(c: Column) -> Column:
    """Share of characters that banners and rules are drawn with; 0 for empty text."""
    n = F.length(c)
    kept = F.length(F.regexp_replace(c, rules.SYMBOL_CLASS, ""))
    return F.when(n > 0, (n - kept) / n).otherwise(F.lit(0.0))


def clean_header(c: Column) -> Column:
    return F.btrim(strip(c), F.lit("\"'"))


def preview(c: Column, n: int) -> Column:
    return F.left(c, F.lit(n))


def display_name(first: Column, last: Column, fallback: Column) -> Column:
    joined = F.concat_ws(" ", blank_to_null(first), blank_to_null(last))
    return F.coalesce(blank_to_null(joined), fallback.cast("string"))


def human_bytes(c: Column) -> Column:
    """1024 steps, one decimal, ties to even."""
    units = ["B", "KB", "MB", "GB", "TB"]
    out = None
    for power, unit in enumerate(units):
        label = F.concat(F.format_string("%.1f", F.bround(c / F.lit(float(1024**power)), 1)), F.lit(" " + unit))
        test = F.abs(c) < float(1024 ** (power + 1))
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(F.concat(F.format_string("%.1f", F.bround(c / F.lit(float(1024**5)), 1)), F.lit(" PB")))


def first_line(c: Column) -> Column:
    return F.substring_index(c, "\n", 1)


def bind(value: Column, body) -> Column:
    """body(value) with the value computed once.

    A lambda variable is evaluated a single time, where a plain column used by
    many branches may be computed in each of them.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def contains_any(c: Column, words: list[str]) -> Column:
    """True where the lower-cased text holds any of the words."""
    return bind(F.lower(c), lambda low: reduce(lambda a, b: a | b, [low.contains(w.lower()) for w in words] or [F.lit(False)]))


def _matches(low: Column, words: list[str]) -> Column:
    """Words found in the lower-cased text, in list order.

    A word that holds a shorter one of the list ("data leak", "leak") is searched
    for only in texts that hold the shorter one.
    """
    if not words:
        return F.array().cast("array<string>")
    lower = [w.lower() for w in words]
    inner = [next((i for i, r in enumerate(lower) if r != w and r in w), None) for w in lower]
    roots = [i for i, r in enumerate(inner) if r is None]
    while any(r is not None and inner[r] is not None for r in inner):
        inner = [r if r is None or inner[r] is None else inner[r] for r in inner]

    def listed(found: Column) -> Column:
        hits = []
        for i, word in enumerate(words):
            if inner[i] is None:
                test = F.get(found, F.lit(roots.index(i)))
            else:
                test = F.get(found, F.lit(roots.index(inner[i]))) & low.contains(lower[i])
            hits.append(F.when(test, F.lit(word)))
        return F.array_compact(F.array(*hits))

    return bind(F.array(*[low.contains(lower[i]) for i in roots]), listed)


def matched_words(c: Column, words: list[str]) -> Column:
    """Words the text holds, in list order, ignoring case."""
    return bind(F.lower(c), lambda low: _matches(low, words))


def matched_words_or_none(c: Column, words: list[str]) -> Column:
    """An array with the matched words as its one element, or empty where none match.

    Exploding it keeps the flagged rows only and computes the match once, where
    a filter on the match would be pushed below it and compute it twice.
    """
    return F.filter(F.transform(F.array(F.lower(c)), lambda low: _matches(low, words)), lambda m: F.size(m) > 0)


def first_rule(tests: list[tuple[Column, Column | str]], default: Column | None = None) -> Column:
    """Value of the first test that holds: an ordered rule table as one CASE."""
    if not tests:
        return F.lit(None).cast("string") if default is None else default
    out = F
    for test, value in tests:
        out = out.when(test, value if isinstance(value, Column) else F.lit(value))
    return out if default is None else out.otherwise(default)


def canonical_label(c: Column, labels: dict[str, str]) -> Column:
    """Longest key contained in the name wins; else the name, else "Unknown"."""
    ordered = sorted(labels.items(), key=lambda kv: -len(kv[0]))
    return _label(c, ordered)


def canonical_label_first(c: Column, labels: dict[str, str]) -> Column:
    """First key in map order contained in the name wins."""
    return _label(c, list(labels.items()))


def _label(c: Column, ordered: list[tuple[str, str]]) -> Column:
    low = F.lower(c)
    fallback = F.coalesce(blank_to_null(c), F.lit("Unknown"))
    return first_rule([(low.contains(k.lower()), v) for k, v in ordered], fallback)


def drop_header_names(c: Column) -> Column:
    return ~c.rlike(rules.HEADER_ROW)
