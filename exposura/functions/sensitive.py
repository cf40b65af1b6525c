"""Detection and masking of personal data and secrets.

No function here returns a secret: values become a kind, a count, a mask or a
keyed hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from exposura import rules
from exposura.functions.text import bind, is_valid_host, strip


def keyed_hash(c: Column, pepper: str) -> Column:
    """Join key that cannot be looked up without the pepper."""
    return F.sha2(F.concat(F.lit(pepper), F.lower(strip(c))), 256)


def mask(c: Column) -> Column:
    """First character, three stars, last character; short values are all stars."""
    return F.when(
        F.length(c) > 4, F.concat(F.left(c, F.lit(1)), F.lit("***"), F.right(c, F.lit(1)))
    ).when(c.isNotNull(), F.lit("***"))


def secret_kind(c: Column, kinds: list[tuple[str, str]] = rules.SECRET_KINDS) -> Column:
    """Name of the storage format; the value itself goes no further."""
    s = strip(c)
    out = F.when(s.isNull() | (s == "") | (F.upper(s) == "NULL"), "empty")
    for name, pattern in kinds:
        out = out.when(s.rlike(pattern), name)
    return out.otherwise("plaintext")


# A cheap test every text with a match passes; the others skip the pattern.
_GATES = {
    rules.EMAIL: lambda c: c.contains("@"),
    rules.PHONE: lambda c: c.contains("+"),
    rules.IPV4: lambda c: c.rlike(r"[0-9]\.[0-9]"),
    rules.CARD: lambda c: c.rlike("[0-9]{4}[ -]?[0-9]{4}"),
    rules.TOKEN: lambda c: c.contains("eyJ"),
    rules.BEARER: lambda c: c.rlike("(?i)bearer "),
    rules.SERVICE_KEY: lambda c: c.rlike("[spr]k[_-]"),
    rules.KEY_BLOCK: lambda c: c.contains("-----BEGIN "),
    rules.SECRET: lambda c: c.contains("=") | c.contains(":"),
    rules.LOCAL_PHONE: lambda c: c.contains("("),
    rules.IPV6: lambda c: c.contains(":"),
    rules.KEY: lambda c: c.contains("AKIA") | c.contains("ghp_") | c.rlike("[A-Fa-f0-9]{32}"),
}


def tokens(c: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    if pattern in _GATES:
        none = F.when(c.isNotNull(), F.array().cast("array<string>"))
        return F.when(_GATES[pattern](c), found).otherwise(none)
    return found


def luhn_valid(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def card_count(c: Column) -> Column:
    """Card-like numbers whose check digit holds."""
    cleaned = F.transform(tokens(c, rules.CARD), lambda x: F.regexp_replace(x, "[ -]", ""))
    return F.size(F.filter(cleaned, luhn_valid))


def phone_count(c: Column) -> Column:
    digits = F.transform(tokens(c, rules.PHONE), lambda x: F.length(F.regexp_replace(x, "[^0-9]", "")))
    return F.size(F.filter(digits, lambda n: n.between(7, 15)))


def count_of(c: Column, *patterns: str) -> Column:
    return reduce(Column.__add__, [F.size(tokens(c, p)) for p in patterns])


def pii_counts(c: Column) -> dict[str, Column]:
    """How many tokens of every kind that `redact` masks; phones and cards only where they are well formed."""
    return {
        "n_email": count_of(c, rules.EMAIL),
        "n_phone": phone_count(c) + count_of(c, rules.LOCAL_PHONE),
        "n_ip": count_of(c, rules.IPV4, rules.IPV6),
        "n_card": card_count(c),
        "n_key": count_of(c, rules.KEY, rules.SERVICE_KEY, rules.KEY_BLOCK),
        "n_token": count_of(c, rules.TOKEN, rules.BEARER),
        "n_secret": count_of(c, rules.SECRET),
    }


def redact(c: Column) -> Column:
    """Every sensitive token replaced by its kind, whole text."""
    for kind, pattern in rules.SENSITIVE:
        c = bind(
            c,
            lambda x: F.when(_GATES[pattern](x), F.regexp_replace(x, pattern, f"[{kind}]")).otherwise(x),
        )
    return c


def value_shape(c: Column) -> Column:
    """Shape class that stands for a sample value."""
    s = strip(c)
    return (
        F.when(s.isNull() | F.lower(s).isin(rules.NULL_TOKENS), F.lit(None).cast("string"))
        .when(s.rlike(r"^-?[0-9]+$"), "integer")
        .when(s.rlike(r"^-?[0-9]+\.[0-9]+$"), "decimal")
        .when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), "date")
        .when(s.rlike(rf"^{rules.EMAIL}$"), "email")
        .when(s.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "ip")
        .when(s.rlike("^https?://"), "url")
        .when(s.rlike(r"^\{"), "json")
        .otherwise("text")
    )


def table_header(line: Column) -> Column:
    """Whether a first line names columns that only tables have, under a comma, tab or semicolon."""
    low = F.lower(line)

    def named(delim: str) -> Column:
        cells = F.transform(F.split(low, delim, -1), lambda x: F.btrim(strip(x), F.lit("'\"")))
        whole = [h for h in rules.TABLE_HEADERS if not h.endswith("_")]
        begun = [h for h in rules.TABLE_HEADERS if h.endswith("_")]
        hit = F.arrays_overlap(cells, F.array(*[F.lit(h) for h in whole]))
        return low.contains(delim) & (hit | F.exists(cells, lambda x: reduce(Column.__or__, [x.startswith(h) for h in begun])))

    return F.coalesce(named(",") | named("\t") | named(";"), F.lit(False))


def list_shaped(line: Column) -> Column:
    """True for a line laid out like an entry of a credential list.

    The line is only measured: two to four parts under tab, colon or blank, one
    of them an address or a plain name, another at least three characters long.
    """
    def address(p: Column) -> Column:
        return p.contains("@") & p.contains(".")

    def laid_out(parts: Column) -> Column:
        named = F.get(parts, F.lit(0)).rlike(r"^[a-zA-Z0-9_.\-+@#$*!=|]+$")
        other = F.exists(parts, lambda p: ~address(p) & (F.length(p) >= 3))
        return F.size(parts).between(2, 4) & (F.exists(parts, address) | named) & other

    def under(delim: str) -> Column:
        # Seven pieces tell: four parts and a blank on either side make six.
        pieces = F.split(line, rf"\s*(?:{delim}\s*)+", 7)
        parts = F.filter(F.transform(pieces, strip), lambda p: p != "")
        return line.contains(delim) & bind(parts, laid_out)

    return under("\t") | under(":") | under(" ")


def confidence_score(host: Column, user: Column) -> Column:
    """Additive quality score of a parsed log line, from its host and actor only."""
    low = F.lower(host)
    host_points = (
        F.when(low.rlike("^(https|android)://"), 55)
        .when(low.startswith("http://"), 50)
        .when(is_valid_host(host), 40)
        .otherwise(0)
    )
    path_points = F.when(host.contains("/") & ~host.endswith("://"), 10).otherwise(0)
    user_points = (
        F.when(user.contains("@") & user.contains("."), 20)
        .when(user.rlike(r"^\+?[0-9]{7,15}$"), 15)
        .when(user.rlike(r"^[\p{L}\p{N}]+$"), 10)
        .otherwise(0)
    )
    return F.when((host == "") | (user == "") | host.isNull() | user.isNull(), 0).otherwise(
        host_points + path_points + user_points
    )
