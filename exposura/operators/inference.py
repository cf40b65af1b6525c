"""Format and schema inference over sample rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from exposura import rules
from exposura.functions import sensitive, text

DELIMITERS = [";", "\t", "|", ","]


def count_of(c: Column, s: str) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(s), F.lit("")))) / len(s)


def sniff_delimiter(line: Column) -> Column:
    """Most frequent candidate of a line; ties keep the first, none gives a comma."""
    names = F.array(*[F.lit(d) for d in DELIMITERS])
    counts = F.array(*[count_of(line, d) for d in DELIMITERS])
    return text.bind(
        counts,
        lambda n: F.when(F.array_max(n) == 0, ",").otherwise(
            F.get(names, (F.array_position(n, F.array_max(n)) - 1).cast("int"))
        ),
    )


DATA_LIKE = [
    r"^-?[0-9]+(\.[0-9]+)?$",
    r"^[^@\s]+@[^@\s]+\.[^@\s]+$",
    r"^(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$",
]


def outside_quotes(line: Column, delim: str) -> Column:
    """The line with quoted parts that hold the delimiter blanked."""
    inside = "|" if delim == "|" else delim
    return F.when(
        line.contains('"'), F.regexp_replace(line, f'("[^"{inside}]*")|"[^"]*"', "$1")).otherwise(line)


def header_tokens(line: Column, delim: Column) -> Column:
    """Cleaned tokens of a line under one of the candidate delimiters."""
    parts = text.first_rule(
        [(delim == d, F.split(outside_quotes(line, d), "[|]" if d == "|" else d, -1)) for d in DELIMITERS]
    )
    return F.transform(parts, text.clean_header)


def data_like(token: Column) -> Column:
    out = token.rlike(DATA_LIKE[0])
    for pattern in DATA_LIKE[1:]:
        out = out | token.rlike(pattern)
    return out


def is_headerless(line: Column, delim: Column, names: list[str] | None = None) -> Column:
    """First row is data: half its first eight tokens look like data, or some do and none is a known name."""
    known = [n.lower() for n in (names if names is not None else rules.COLUMN_ALIASES)]

    def verdict(first: Column) -> Column:
        hits = F.size(F.filter(first, data_like))
        unnamed = ~F.exists(first, lambda t: F.lower(t).isin(known))
        needed = F.greatest(F.lit(1), F.floor(F.size(first) / 2).cast("int"))
        return text.bind(hits, lambda n: (n >= needed) | ((n > 0) & unnamed))

    tokens = text.bind(delim, lambda d: F.slice(header_tokens(line, d), 1, 8))
    return (text.strip(line) != "") & text.bind(tokens, verdict)


def classify_column(name: Column, patterns: list[tuple[str, str]] = rules.COLUMN_PATTERNS) -> Column:
    """Target of the first pattern the lower-cased name matches, else "ignore"."""
    low = F.lower(name)
    return text.first_rule([(low.rlike(p), t) for p, t in patterns], F.lit("ignore"))


def learn_aliases(existing: DataFrame, found: DataFrame) -> DataFrame:
    """(name, target): new valid names are added; a kept target changes only from "ignore"."""
    from exposura.operators.filters import valid_alias_key

    clean = found.select(text.strip(F.lower(F.col("name"))).alias("name"), F.col("target").alias("_found"))
    valid = clean.filter(valid_alias_key(F.col("name"))).groupBy("name").agg(F.min("_found").alias("_found"))
    joined = existing.join(valid, "name", "full")
    upgrade = F.col("target").isNull() | ((F.col("target") == "ignore") & F.col("_found").isNotNull())
    return joined.select("name", F.when(upgrade, F.col("_found")).otherwise(F.col("target")).alias("target"))


def schema_catalog(
    files: DataFrame, key: str, header: str, dump: Column | None = None, body: str | None = None, at: Column | None = None,
) -> DataFrame:
    """Per file: key, delimiter, tables, method, scanned_at; each table with its columns.

    A flat file is one table read off its first line ("header"); where that line is
    data its columns are named "0", "1", ..., and no value of it is kept. Where
    `dump` holds, the whole text in `body` is read for its tables (`dump_tables`), the
    delimiter is NULL and the method "statements".
    """
    is_dump = F.coalesce(dump, F.lit(False)) if dump is not None else F.lit(False)
    texts = [F.col(body).alias("_body")] if body else []
    sniffed = files.select(
        key, F.col(header).alias("_line"), sniff_delimiter(F.col(header)).alias("delimiter"), is_dump.alias("_dump"), *texts)
    read = sniffed.select(
        key, "delimiter", "_dump", *(["_body"] if body else []), header_tokens(F.col("_line"), F.col("delimiter")).alias("_tokens"),
        is_headerless(F.col("_line"), F.col("delimiter")).alias("_headerless"),
    )
    ordinals = F.transform("_tokens", lambda t, i: i.cast("string"))
    read = read.withColumn("_columns", F.when(F.col("_headerless"), ordinals).otherwise(F.col("_tokens")))

    def table(name: Column, columns: Column, headerless: Column) -> Column:
        return F.struct(
            name.alias("table_name"), columns.alias("columns"), F.size(columns).alias("n_columns"), headerless.alias("headerless"))

    tables = F.array(table(F.lit("_flat"), F.col("_columns"), F.col("_headerless")))
    if body:
        found = F.transform(dump_tables(F.col("_body")), lambda t: table(t["table_name"], t["columns"], F.lit(False)))
        tables = F.when(F.col("_dump"), found).otherwise(tables)
    return read.select(
        key, F.when(~F.col("_dump"), F.col("delimiter")).alias("delimiter"), tables.alias("tables"),
        F.when(F.col("_dump"), "statements").otherwise("header").alias("method"),
        (at if at is not None else F.current_timestamp()).alias("scanned_at"))


LITERAL = r"(?s)'(?:[^'\\]|\\.|'')*+'"
COMMENT = r"(?s)/\*.*?\*/|(?m:--[ \t][^\n]*|^[ \t]*#[^\n]*)"
TABLE_NAME = r"(?:[`\"\[]?\w+[`\"\]]?\.)*+[`\"\[]?(\w+)"
CREATE = rf"(?is)^\s*CREATE\s+(?:TEMPORARY\s+)?TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?{TABLE_NAME}"
INSERT = rf"(?is)^\s*(?:INSERT\s+(?:IGNORE\s+)?|REPLACE\s+)INTO\s+{TABLE_NAME}"


def dump_tables(c: Column) -> Column:
    """(table_name, columns, method) of every table a dump defines or fills, in order; names only.

    One fold over the pieces between brackets, commas and semicolons carries the open
    table, its depth and its columns so far. Text literals and what follows VALUES
    are blanked first, so no value of a row is looked at. A table that is defined
    has the columns of its definition ("create"); one that is only filled those of
    its first statement's column list, or none ("insert").
    """
    bare = F.regexp_replace(F.regexp_replace(c, LITERAL, "''"), COMMENT, " ")
    bare = F.regexp_replace(bare, r"(?is)\bVALUES\b[^;]*", " ")
    pieces = F.regexp_extract_all(bare, F.lit(r"[(),;]|[^(),;]+"), F.lit(0))
    table = "struct<table_name:string,columns:array<string>,method:string>"
    none, names = F.lit(None).cast("string"), F.array().cast("array<string>")
    start = F.struct(
        F.lit(0).alias("depth"), none.alias("name"), none.alias("method"), names.alias("columns"), F.lit(True).alias("fresh"),
        F.array().cast(f"array<{table}>").alias("out"))

    def column(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^\s*[`\"\[]?(\w+)", 1)
        quoted = piece.rlike(r"^\s*[`\"\[]")
        return F.when((name != "") & (quoted | ~F.lower(name).isin(rules.DDL_CONSTRAINTS)), F.array(name)).otherwise(names)

    def step(at: Column, piece: Column) -> Column:
        opened, closed, said = piece == "(", piece == ")", ~piece.isin("(", ")", ",", ";")
        top, inside = at["depth"] == 0, at["name"].isNotNull() & (at["depth"] == 1)
        depth = F.greatest(F.lit(0), at["depth"] + F.when(opened, 1).when(closed, -1).otherwise(0))
        creates, fills = top & said & piece.rlike(CREATE), top & said & piece.rlike(INSERT)
        ends = at["name"].isNotNull() & ((closed & (at["depth"] == 1)) | (top & (piece == ";")))
        takes = inside & said & at["fresh"]
        fresh = (opened & top) | ((piece == ",") & (at["depth"] == 1)) | (at["fresh"] & ~takes)
        whole = F.struct(at["name"].alias("table_name"), at["columns"].alias("columns"), at["method"].alias("method")).cast(table)
        name = F.when(creates, F.regexp_extract(piece, CREATE, 1)).when(fills, F.regexp_extract(piece, INSERT, 1)).when(ends, none)
        return F.struct(
            depth.alias("depth"),
            name.when(~creates & ~fills & ~ends, at["name"]).alias("name"),
            F.when(creates, "create").when(fills, "insert").otherwise(at["method"]).alias("method"),
            F.when(creates | fills, names).when(takes, F.concat(at["columns"], column(piece))).otherwise(at["columns"]).alias("columns"),
            fresh.alias("fresh"),
            F.when(ends, F.concat(at["out"], F.array(whole))).otherwise(at["out"]).alias("out"))

    def once(found: Column) -> Column:
        def first(x: Column, i: Column) -> Column:
            defined = F.exists(found, lambda y: (y["table_name"] == x["table_name"]) & (y["method"] == "create"))
            earlier = F.exists(F.slice(found, 1, i), lambda y: (y["table_name"] == x["table_name"]) & (y["method"] == x["method"]))
            return ~earlier & ((x["method"] == "create") | ~defined)
        return F.filter(found, first)

    return text.bind(F.aggregate(pieces, start, step, lambda at: at["out"]), once)


def mapping_failed(columns: Column) -> Column:
    """No column name maps to an identity or a financial target."""
    useful = rules.IDENTITY_TARGETS + rules.FINANCIAL_TARGETS
    return ~F.exists(columns, lambda c: classify_column(c).isin(useful))


def ambiguous_names(columns: Column) -> Column:
    return F.exists(columns, lambda c: c.rlike("^[0-9]+$") | F.lower(c).startswith("col_"))


def sample_shapes(df: DataFrame, ordinal: str, columns: list[str], rows: int = 100) -> DataFrame:
    """(column_name, shape) of the first value in the sample that is not a placeholder.

    The sample is the rows whose ordinal, counted from 1, is at most the given number.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), sensitive.value_shape(F.col(c).cast("string")).alias("shape"))
            for c in columns
        ]
    )
    sample = df.filter(F.col(ordinal) <= rows)
    long = sample.select(ordinal, F.explode(pairs).alias("p")).select(ordinal, "p.column_name", "p.shape")
    return long.groupBy("column_name").agg(
        F.min_by("shape", F.when(F.col("shape").isNotNull(), F.col(ordinal))).alias("shape")
    )


def filename_record(name: Column, records: list[dict]) -> Column:
    """(parser, delimiter, header, columns) of the first record whose pattern the lower-cased name matches.

    A record has `pattern` and `parser`; `delimiter`, `header` and `columns` (ordinal
    to target) may be left out and are NULL then.
    """
    kind = "struct<parser:string,delimiter:string,header:boolean,columns:map<int,string>>"

    def row(r: dict) -> Column:
        pairs = [x for k, t in sorted(r.get("columns", {}).items()) for x in (F.lit(int(k)), F.lit(t))]
        return F.struct(
            F.lit(r["parser"]).alias("parser"), F.lit(r.get("delimiter")).cast("string").alias("delimiter"),
            F.lit(r.get("header")).cast("boolean").alias("header"),
            (F.create_map(*pairs) if pairs else F.lit(None)).cast("map<int,string>").alias("columns"),
        ).cast(kind)

    none = F.lit(None).cast(kind)
    return text.first_rule([(F.lower(name).rlike(r["pattern"]), row(r)) for r in records], none) if records else none


def filename_rule(name: Column, table: list[tuple[str, str]]) -> Column:
    """Value of the first pattern the lower-cased name matches, or NULL."""
    low = F.lower(name)
    return text.first_rule([(low.rlike(p), v) for p, v in table])


def is_transaction_header(columns: Column, triggers: list[str] = rules.TRANSACTION_TRIGGERS) -> Column:
    low = F.transform(columns, lambda c: F.lower(text.strip(c)))
    return F.arrays_overlap(low, F.array(*[F.lit(t) for t in triggers]))


def positional_line(line: Column, delim: str = ",") -> Column:
    """The fingerprint of a delimited line, whose quoted fields may hold the delimiter."""
    return text.bind(text.quoted_fields(line, delim), positional_fingerprint)


def positional_fingerprint(fields: Column) -> Column:
    """At least twenty fields, an id-like first and a phone-like fourth."""
    return (
        (F.size(fields) >= 20)
        & F.coalesce(text.strip(F.get(fields, F.lit(0))).rlike("^[0-9]{8,20}$"), F.lit(False))
        & F.coalesce(text.strip(F.get(fields, F.lit(3))).rlike(r"^\+?[0-9]{8,15}$"), F.lit(False))
    )


def sample_lines(c: Column, n: int) -> Column:
    """First n stripped lines that are neither blank nor comments."""
    from exposura.functions.lines import split_lines

    kept = F.filter(
        F.transform(split_lines(c), text.strip), lambda x: (x != "") & ~x.startswith("#")
    )
    return F.slice(kept, 1, n)


def _mean(numbers: Column) -> Column:
    return text.bind(
        numbers,
        lambda a: F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / F.size(a)).otherwise(
            F.lit(0.0)
        ),
    )


def csv_vs_list(c: Column, n: int = 20) -> Column:
    """table, list or undecided, from the mean fields and colons of the first lines."""

    def verdict(lines: Column) -> Column:
        fields = _mean(F.transform(lines, lambda x: count_of(outside_quotes(x, ","), ",") + 1))
        colons = _mean(F.transform(lines, lambda x: count_of(F.replace(x, F.lit("://"), F.lit("")), ":")))
        measured = F.struct(fields.alias("fields"), colons.alias("colons"))
        decided = text.bind(
            measured,
            lambda m: F.when(m["fields"] >= 8, "table")
            .when((m["colons"] >= 0.8) & (m["fields"] < 4), "list")
            .otherwise("undecided"),
        )
        return F.when(F.size(lines) == 0, "list").otherwise(decided)

    return text.bind(sample_lines(c, n), verdict)


def list_share(c: Column, n: int = 25) -> Column:
    """Share of the first lines that are laid out like a credential list; 0 under a table's header."""
    def share(lines: Column) -> Column:
        shaped = F.transform(lines, lambda x: F.when(sensitive.list_shaped(x), 1.0).otherwise(0.0))
        return F.when(sensitive.table_header(F.get(lines, F.lit(0))), 0.0).otherwise(_mean(shaped))

    return text.bind(sample_lines(c, n), share)


def columns_from_ddl(body: Column) -> Column:
    """Column names of a CREATE TABLE body, in order; constraints are skipped.

    Commas inside parentheses or quotes do not separate: such parts are blanked
    before the split.
    """
    bare = F.regexp_replace(body, r"'[^']*'", "''")
    pieces = F.regexp_extract_all(bare, F.lit(r"[()]|[^()]+"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(at: Column, piece: Column) -> Column:
        depth = F.greatest(F.lit(0), at["depth"] + F.when(piece == "(", 1).when(piece == ")", -1).otherwise(0))
        outside = (at["depth"] == 0) & ~piece.isin("(", ")")
        return F.struct(depth.alias("depth"), F.when(outside, F.concat(at["kept"], F.array(piece))).otherwise(at["kept"]).alias("kept"))

    flat = F.array_join(F.aggregate(pieces, start, step, lambda at: at["kept"]), "")
    parts = F.transform(F.split(flat, ",", -1), text.strip)
    names = F.transform(
        parts,
        lambda p: F.struct(
            F.regexp_extract(p, r"^`?(\w+)", 1).alias("name"), p.startswith("`").alias("quoted")
        ),
    )
    kept = F.filter(
        names,
        lambda s: (s["name"] != "") & (s["quoted"] | ~F.lower(s["name"]).isin(rules.DDL_CONSTRAINTS)),
    )
    return F.transform(kept, lambda s: s["name"])
