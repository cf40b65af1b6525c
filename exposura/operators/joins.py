"""Lookups as set-based joins.

Joins on keys are left to the optimizer, which broadcasts a side whose size is
below spark.sql.autoBroadcastJoinThreshold and shuffles it, with skew handling,
beyond that. Rule tables matched by substring go into the expression as literals
while they are below a checked number of rows, and through an equi-join on
character grams beyond it; there a side is broadcast only once it was counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from exposura.functions import text

LITERAL_RULES = 1000
# From this many phrases on, one pass over the grams of a text costs less than a
# search per phrase, provided the grams are long enough to be rare.
GRAM_RULES = 64
GRAM_LENGTH = 8
# Bytes of text in a side that is sent to every executor, once they have been added up.
SENT_BYTES = 16 << 20


def new_only(src: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in done."""
    return src.join(done.select(key), key, "left_anti")


def already_seen(src: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return src.join(seen.select(key), key, "left_semi")


def count_by_dimension(dim: DataFrame, facts: DataFrame, key: str, counts: dict[str, Column]) -> DataFrame:
    """Dimension rows with counts of their facts, zero where there are none.

    The facts are aggregated before the join, so only one row per key meets the
    dimension.
    """
    totals = facts.groupBy(key).agg(*[c.alias(n) for n, c in counts.items()])
    joined = dim.join(totals, key, "left")
    return joined.fillna(0, subset=list(counts))


def latest_by_dimension(
    dim: DataFrame, facts: DataFrame, key: str, order: list[str], cols: list[str]
) -> DataFrame:
    """Dimension rows with the newest fact of each, NULL where there is none."""
    newest = facts.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("newest"))
    return dim.join(newest, key, "left").select(
        *[F.col(c) for c in dim.columns], *[F.col(f"newest.{c}").alias(c) for c in cols]
    )


def country_lookup(df: DataFrame, code: str, countries: DataFrame) -> DataFrame:
    """countries(country_code, country_name); unknown codes give NULL."""
    return df.join(countries, F.upper(F.col(code)) == F.col("country_code"), "left").drop("country_code")


def fallback_join(columns: DataFrame, aliases: DataFrame) -> DataFrame:
    """(.., name) with the target of its lower-cased name, else the name itself."""
    renamed = aliases.select(F.col("name").alias("alias"), F.col("target").alias("alias_target"))
    joined = columns.join(renamed, F.lower(F.col("name")) == F.col("alias"), "left")
    return joined.withColumn("target", F.coalesce("alias_target", "name")).drop("alias", "alias_target")


def small_rules(table: DataFrame, limit: int = LITERAL_RULES) -> list | None:
    """The rows of a rule table, or None when it has more than the limit.

    At most limit + 1 rows reach the driver.
    """
    rows = table.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def contains_matches(
    df: DataFrame, id_col: str, text_col: str, rules_df: DataFrame, rule_id: str, phrase: str,
    limit: int = LITERAL_RULES,
) -> DataFrame:
    """(id, rule id) for every phrase that is a substring of the text, ignoring case."""
    rows = small_rules(rules_df.select(rule_id, phrase).filter(F.length(phrase) > 0), limit)
    if rows is not None and (
        len(rows) < GRAM_RULES or min(len(r[1]) for r in rows) < 2 * GRAM_LENGTH - 1
    ):
        return _contains_literals(df, id_col, text_col, rows, rules_df, rule_id)
    return contains_by_grams(df, id_col, text_col, rules_df, rule_id, phrase)


def _contains_literals(df, id_col, text_col, rows, rules_df, rule_id) -> DataFrame:
    kind = rules_df.schema[rule_id].dataType
    if not rows:
        return df.select(id_col, F.lit(None).cast(kind).alias(rule_id)).limit(0)
    hits = text.bind(
        F.lower(F.col(text_col)),
        lambda low: F.array_compact(
            F.array(*[F.when(low.contains(phrase.lower()), F.lit(key).cast(kind)) for key, phrase in rows])
        ),
    )
    return df.select(id_col, F.explode(hits).alias(rule_id))


def contains_by_grams(
    df: DataFrame, id_col: str, text_col: str, rules_df: DataFrame, rule_id: str, phrase: str,
    sent: int = SENT_BYTES, literals: int = LITERAL_RULES,
) -> DataFrame:
    """The same pairs for a rule table of any size, by an equi-join on grams.

    With q such that 2q - 1 is at most the length of the shortest phrase, the
    text is cut into consecutive grams of q characters and each phrase gives its
    first q grams. Whatever the offset of an occurrence, one of those grams falls
    on a cut of the text, so no match is lost. Phrases too short for rare grams are
    matched as literals while they are few; else they shorten the grams of all.

    While the phrases' grams are within `sent` bytes they are sent to the texts,
    and a candidate is checked where its text is: only ids leave the task. Beyond
    that, candidates meet the phrases and then the texts by shuffled joins.
    """
    long_enough = F.length(phrase) >= 2 * GRAM_LENGTH - 1
    named = rules_df.filter(F.length(phrase) > 0).select(rule_id, phrase)
    short = small_rules(named.filter(~long_enough), literals)
    if short:
        by_literal = _contains_literals(df, id_col, text_col, short, rules_df, rule_id)
        rest = named.filter(long_enough)
        return by_literal.unionByName(contains_by_grams(df, id_col, text_col, rest, rule_id, phrase, sent, literals))
    low = df.select(id_col, F.lower(F.col(text_col)).alias("_low"))
    phrases = named.select(rule_id, F.lower(F.col(phrase)).alias("_phrase"))
    shortest, size = phrases.agg(
        F.min(F.length("_phrase")), F.sum(F.octet_length("_phrase") + F.octet_length(F.col(rule_id).cast("string")) + 48)
    ).first()
    q = min(12, ((shortest or 1) + 1) // 2)
    grams = F.array_distinct(F.regexp_extract_all("_low", F.lit(f"(?s).{{{q}}}"), F.lit(0)))
    heads = F.array_distinct(
        F.array(*[F.substr(F.col("_phrase"), F.lit(i + 1), F.lit(q)) for i in range(q)])
    )
    if (size or 0) * q <= sent:
        rule_grams = F.broadcast(phrases.select(rule_id, "_phrase", F.explode(heads).alias("_gram")))
        met = low.select(id_col, "_low", F.explode(grams).alias("_gram")).join(rule_grams, "_gram")
        return met.filter(F.col("_low").contains(F.col("_phrase"))).select(id_col, rule_id).distinct()
    text_grams = low.select(id_col, F.explode(grams).alias("_gram"))
    rule_grams = phrases.select(rule_id, F.explode(heads).alias("_gram"))
    candidates = text_grams.join(rule_grams, "_gram").select(id_col, rule_id).distinct()
    checked = low.join(candidates.join(phrases, rule_id), id_col)
    return checked.filter(F.col("_low").contains(F.col("_phrase"))).select(id_col, rule_id)


def taxonomy_label(
    df: DataFrame, name: str, categories: dict[str, str], excluded: list[str]
) -> DataFrame:
    """(name, category) once per name: first category whose keyword it holds, exclusions out.

    Drivers are left out too, unless they belong to a chipset.
    """
    low = F.lower(F.col(name))
    category = text.first_rule([(low.contains(k.lower()), c) for k, c in categories.items()])
    driver = low.contains("driver") & ~low.contains("chipset")
    kept = df.filter(~text.contains_any(low, excluded) & ~driver)
    labelled = kept.select(F.col(name).alias("name"), category.alias("category")).distinct()
    return labelled.filter(F.col("category").isNotNull())


def content_route(df: DataFrame, rules_df: DataFrame, kind: Column) -> DataFrame:
    """(.., kind, destination) for every rule (destination, kind) of the row's kind of content.

    There are few kinds, so a join on them would gather the rows in as few tasks.
    A rule table of checked size becomes literals and every row is routed where it
    is; a larger one is joined, with adaptive skew handling. Works on streams.
    """
    tagged = df.withColumn("kind", kind)
    rows = small_rules(rules_df.select("destination", "kind"))
    if rows is None:
        return tagged.join(rules_df.select("destination", "kind"), "kind")
    by_kind: dict[str, list[str]] = {}
    for destination, name in rows:
        by_kind.setdefault(name, []).append(destination)
    none = F.lit(None).cast("array<string>")
    found = text.first_rule(
        [(kind == name, F.array(*[F.lit(d) for d in where])) for name, where in by_kind.items()], none
    ) if by_kind else none
    return tagged.select("*", F.explode(found).alias("destination"))


def registered_domains(df: DataFrame, column: str, suffixes: DataFrame, out: str = "domain") -> DataFrame:
    """Adds the registered domain of an address, e-mail or host, by a table of public suffixes.

    `suffixes` has one string column, in the notation of `text.registered_domain`; the
    result is the same, and the plan does not grow with the table. Each distinct
    host gives its endings with their lengths; they meet the table by equality; the
    exception, or else the longest suffix that leaves a label, is picked per host by an
    aggregate; hosts then find their rows. "" where no suffix is listed.
    """
    rule = F.lower(text.strip(F.col(suffixes.columns[0])))
    kind = F.when(rule.startswith("!"), 2).when(rule.startswith("*."), 1).otherwise(0)
    name = F.regexp_replace(rule, r"^(?:!|[*][.])", "")
    table = suffixes.select(name.alias("_ending"), kind.alias("_kind")).filter(F.col("_ending") != "").distinct()

    host = text.host_of(F.col(column))
    hosts = df.select(host.alias("_host")).filter("_host <> ''").distinct()
    labels = F.split("_host", "[.]", -1)
    endings = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.struct(
        F.array_join(F.slice(labels, -k, k), ".").alias("_ending"), k.alias("_k")))
    long = hosts.select("_host", F.size(labels).alias("_n"), F.explode(endings).alias("e")).select("_host", "_n", "e._ending", "e._k")
    met = long.join(table, "_ending")
    excepted = F.col("_kind") == 2
    suffix = F.col("_k") + (F.col("_kind") == 1).cast("int")
    kept = F.when(excepted, F.col("_k")).otherwise(suffix + 1)
    found = met.filter(excepted | (F.col("_n") > suffix)).groupBy("_host").agg(
        F.max_by(kept, F.struct(excepted, F.when(excepted, F.col("_k")).otherwise(suffix))).alias("_kept"))
    domains = found.select("_host", F.array_join(F.slice(labels, -F.col("_kept"), F.col("_kept")), ".").alias("_domain"))
    joined = df.withColumn("_host", host).join(domains, "_host", "left")
    return joined.withColumn(out, F.coalesce("_domain", F.lit(""))).drop("_host", "_domain")
