"""Delimited files whose quoted fields hold line breaks, and large JSON arrays, read by many tasks.

Both need to know what came before a line: whether a quote is open, how deep the
brackets are. Files are read in splits, line by line. What a line does to that
state is a small map; maps are composed first within a split, then over the splits
of a file, and only then is each line's state known. No task reads a whole file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T, Window

from exposura.functions import text

PLACE = ["_file", "_split", "_at"]


def split_lines(spark: SparkSession, path: str | list[str], end: str = "\n") -> DataFrame:
    """(_file, _split, _at, line): lines by file, start of their split and order within it."""
    raw = spark.read.option("lineSep", end).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"))


def _within(df: DataFrame, by: list[str], order: str, keep: Column, turn: Column) -> DataFrame:
    """Adds what the rows before do to a two-valued state: `_set` (a value some row set,
    or NULL) and `_turns` (how often it was turned since, or since the beginning).

    A row keeps the state, turns it, or sets it; `turn` is true for the second and
    `keep` is NULL for the first two and the value for the third.
    """
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(turn.cast("int")).over(before), F.lit(0))
    counted = df.withColumn("_keep", keep).withColumn("_turn", turn.cast("int")).withColumn("_seen", turns)
    last = F.last(F.when(F.col("_keep").isNotNull(), F.struct("_keep", "_seen")), ignorenulls=True).over(before)
    placed = counted.withColumn("_last", last)
    since = F.col("_seen") - F.coalesce(F.col("_last._seen"), F.lit(0))
    return placed.withColumn("_set", F.col("_last._keep")).withColumn("_turns", since).drop("_last", "_seen")


def _state(entry: Column) -> Column:
    """The state before a row, from the state before the first one."""
    return F.pmod(F.coalesce(F.col("_set"), entry) + F.col("_turns"), F.lit(2))


def with_state(lines: DataFrame, from_closed: Column, from_open: Column) -> DataFrame:
    """Adds `_state`, 0 or 1, before each line of a file; files begin with 0.

    `from_closed` and `from_open` say what a line makes of 0 and of 1. Lines meet
    the others of their split only; of a split, one row goes on to be composed with
    the file's other splits.
    """
    a, b = from_closed.cast("int"), from_open.cast("int")
    marked = _within(lines, ["_file", "_split"], "_at", F.when(a == b, a), (a == 1) & (b == 0))
    after_set = F.when(F.col("_keep").isNotNull(), F.col("_keep")).otherwise(
        F.when(F.col("_set").isNotNull(), F.pmod(F.col("_set") + F.col("_turns") + F.col("_turn"), F.lit(2))))
    turned = F.when(after_set.isNull(), F.pmod(F.col("_turns") + F.col("_turn"), F.lit(2)))
    ends = marked.groupBy("_file", "_split").agg(F.max_by(F.struct(after_set.alias("to"), turned.alias("turned")), "_at").alias("m"))
    splits = _within(ends, ["_file"], "_split", F.col("m.to"), F.coalesce(F.col("m.turned"), F.lit(0)) == 1)
    entries = splits.select("_file", "_split", _state(F.lit(0)).alias("_entry"))
    return marked.join(entries, ["_file", "_split"]).withColumn("_state", _state(F.col("_entry"))).select(*lines.columns, "_state")


def open_quote(line: Column, delim: str, inside: bool) -> Column:
    """Whether a quoted field is open after a line, read from outside or from inside one.

    A quote opens a field only at its beginning; within a quoted field two quotes
    stand for one; what follows a closing quote up to the delimiter is plain.
    """
    d = re.escape(delim) if delim != "\t" else r"\t"
    field = rf'(?:"(?:[^"]|"")*+"(?!")[^{d}]*+|(?!")[^{d}]*+)'
    unclosed = rf'"(?:[^"]|"")*+$'
    outside = rf"^(?:{field}{d})*+{unclosed}"
    within = rf'^(?:[^"]|"")*+(?:$|"(?!")[^{d}]*+{d}(?:{field}{d})*+{unclosed})'
    pattern = f"(?s){within if inside else outside}"
    return F.when(line.contains('"'), line.rlike(pattern)).otherwise(F.lit(inside))


def records(lines: DataFrame, whole: Column, opens: Column, glue: str = "\n") -> DataFrame:
    """(_file, _split, _at, record): lines that are no whole record joined from one that opens to the next.

    Only lines of records of more than one line meet; all others stay as they are.
    Records are counted within a split, whose lines have met before, and raised by
    what the file's earlier splits hold: one row per split goes on to be summed.
    """
    marked = lines.withColumn("_whole", whole).withColumn("_opens", opens)
    single = marked.filter("_whole").select(*PLACE, F.col("line").alias("record"))
    parts = marked.filter("not _whole").select(*PLACE, "line", "_opens")
    started = F.coalesce(F.col("_opens"), F.lit(False)).cast("long")
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_file", "_split").agg(F.sum(started).alias("_sum")).select(
        "_file", "_split", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_file", "_split").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    counted = parts.withColumn("_local", F.sum(started).over(inside)).join(offsets, ["_file", "_split"])
    numbered = counted.withColumn("_record", F.col("_local") + F.col("_offset"))
    met = numbered.groupBy("_file", "_record").agg(F.sort_array(F.collect_list(F.struct("_split", "_at", "line"))).alias("l"))
    joined = met.select(
        "_file", F.get("l", F.lit(0))["_split"].alias("_split"), F.get("l", F.lit(0))["_at"].alias("_at"),
        F.array_join(F.transform("l", lambda x: x["line"]), glue).alias("record"))
    return single.unionByName(joined)


def breaks_in_quotes(spark: SparkSession, path: str | list[str], delim: str = ",") -> bool:
    """Whether any line leaves a quoted field open; the scan ends at the first."""
    return not split_lines(spark, path).filter(open_quote(F.col("line"), delim, False)).isEmpty()


def quoted_records(spark: SparkSession, path: str | list[str], delim: str = ",") -> DataFrame:
    """(_file, _split, _at, record) of delimited files whose quoted fields may hold line breaks.

    Blank records go. A file whose last quote is never closed ends in one long record.
    """
    outside, inside = (open_quote(F.col("line"), delim, k) for k in (False, True))
    known = with_state(split_lines(spark, path), outside, inside)
    closed = F.col("_state") == 0
    found = records(known, closed & ~outside, closed)
    trimmed = F.regexp_replace("record", "\r$", "")
    return found.withColumn("record", trimmed).filter(text.strip(F.col("record")) != "")


def quoted_rows(
    spark: SparkSession, path: str | list[str], columns: list[str], delim: str = ",", header: bool = True,
) -> DataFrame:
    """The records as rows of string columns; short rows give NULLs, long rows lose their tail.

    With a header, each file's first record goes.
    """
    found = quoted_records(spark, path, delim)
    if header:
        written = split_lines(spark, path).filter(text.strip(F.col("line")) != "")
        first = written.groupBy("_file").agg(F.min(F.struct("_split", "_at")).alias("_first"))
        found = found.join(first, "_file").filter(F.struct("_split", "_at") != F.col("_first"))
    fields = ", ".join(f"c{i} STRING" for i in range(len(columns)))
    options = {"sep": delim, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    row = F.from_csv("record", fields, options)
    parsed = found.select(row.alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)])


def _brackets(outside: Column) -> Column:
    """Brackets a text opens less those it closes."""
    return (F.length(F.translate(outside, "}]", "")) - F.length(F.translate(outside, "{[", ""))).cast("long")


def array_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(_file, _split, _at, record): the objects of files that hold one JSON array each.

    A file is cut at closing braces, wherever they stand, so that an array on one
    line is split too. For either state before it, in a string or not, a piece says
    how many quotes turn the state and how the depth changes; within a split both
    are summed for both cases, the splits' sums are added up in order, and an object
    ends where the depth is back at one outside of any string.
    """
    pieces = split_lines(spark, path, "}")
    bare = F.regexp_replace("line", r"(?s)\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    counted = pieces.withColumn("_odd", (quotes % 2).cast("int"))
    for entry, said in ((0, bare), (1, F.concat(F.lit('"'), bare))):
        outside = F.regexp_replace(said, r'"[^"]*+(?:"|$)', "")
        closes = F.when(F.col("_odd") == entry, 1).otherwise(0)
        counted = counted.withColumn(f"_d{entry}", _brackets(outside) - closes)

    before = Window.partitionBy("_file", "_split").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    turned = counted.withColumn("_turns", F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2)
    for entry in (0, 1):
        mine = F.when(F.col("_turns") == entry, F.col("_d0")).otherwise(F.col("_d1"))
        turned = turned.withColumn(f"_s{entry}", mine)
    for entry in (0, 1):
        turned = turned.withColumn(f"_b{entry}", F.coalesce(F.sum(f"_s{entry}").over(before), F.lit(0)))

    splits = turned.groupBy("_file", "_split").agg(
        F.sum("_odd").alias("odd"), F.sum("_s0").alias("s0"), F.sum("_s1").alias("s1"))
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    state = splits.withColumn("_entry", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    step = F.when(F.col("_entry") == 0, F.col("s0")).otherwise(F.col("s1"))
    entries = state.withColumn("_step", step).select(
        "_file", "_split", "_entry", F.coalesce(F.sum("_step").over(earlier), F.lit(0)).alias("_above"))

    met = turned.join(entries, ["_file", "_split"])
    outside = F.col("_entry") == 0
    depth = F.col("_above") + F.when(outside, F.col("_b0")).otherwise(F.col("_b1"))
    known = met.withColumn("_state", (F.col("_entry") + F.col("_turns")) % 2).withColumn("_depth", depth).withColumn(
        "_then", depth + F.when(outside, F.col("_s0")).otherwise(F.col("_s1")))
    opens = (F.col("_state") == 0) & (F.col("_depth") <= 1)
    found = records(known, opens & (F.col("_then") == 1), opens, "}")
    begun = F.regexp_replace("record", r'(?s)^(?:[^"{]|"(?:[^"\\]|\\.)*+")*+', "")
    return found.withColumn("record", begun).filter(F.col("record") != "").withColumn("record", F.concat("record", F.lit("}")))


def json_array_rows(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The objects as rows; one that does not parse is skipped, an empty one is a row of NULLs."""
    names = {f.name for f in schema.fields}
    spoilt = "_corrupt"
    while spoilt in names:
        spoilt += "_"
    read = T.StructType([*schema.fields, T.StructField(spoilt, T.StringType())])
    row = F.from_json("record", read, {"columnNameOfCorruptRecord": spoilt})
    parsed = array_elements(spark, path).select(row.alias("r"))
    return parsed.filter(F.col(f"r.{spoilt}").isNull()).select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields])
