"""Readers. Every one returns a lazy, splittable DataFrame unless its doc says why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from exposura import rules
from exposura.functions import files, text
from exposura.sources import quoted


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_delimited(
    spark: SparkSession, path: str, delim: str = ",", columns: list[str] | None = None,
    encoding: str = "UTF-8", multiline: bool = True,
) -> DataFrame:
    """Delimited text with a header; short rows give NULLs, long rows lose their tail.

    Columns come from the argument or, without one, from the header; all are
    strings, so nothing is read twice to guess types. Files are split whatever they
    hold: where a quoted field holds a line break, which one scan finds out, records
    are put together across splits (`quoted_rows`); multiline=False spares the scan
    where there are none. Encodings besides UTF-8 go to the reader that has one task
    read a file with such breaks.
    """
    reader = (
        spark.read.option("sep", delim).option("header", True).option("mode", "PERMISSIVE")
        .option("encoding", encoding).option("escape", '"').option("enforceSchema", True)
    )
    if multiline and encoding.upper() != "UTF-8":
        reader = reader.option("multiLine", True)
    elif multiline and quoted.breaks_in_quotes(spark, path, delim):
        names = columns or reader.option("multiLine", True).csv(path).columns
        return quoted.quoted_rows(spark, path, names, delim)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def _headerless(spark: SparkSession, path: str, delim: str, multiline: bool, width: int | None = None) -> DataFrame:
    """Columns "0", "1", ...: as many as asked for, or as the first record has."""
    reader = spark.read.option("sep", delim).option("header", False).option("mode", "PERMISSIVE").option("escape", '"')
    broken = multiline and quoted.breaks_in_quotes(spark, path, delim)
    if width is None:
        width = len(reader.option("multiLine", broken).csv(path).columns)
    names = [str(i) for i in range(width)]
    if broken:
        return quoted.quoted_rows(spark, path, names, delim, header=False)
    return reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path)


def read_headerless_generic(spark: SparkSession, path: str, delim: str = ",", multiline: bool = True) -> DataFrame:
    """Columns named "0", "1", ... in order; multiline as in read_delimited."""
    return _headerless(spark, path, delim, multiline)


def read_positional(
    spark: SparkSession, path: str, column_map: dict[int, str], delim: str = ",", multiline: bool = True
) -> DataFrame:
    """Headerless text by ordinal; an ordinal past the end of a row is NULL; multiline as in read_delimited."""
    raw = _headerless(spark, path, delim, multiline, max(column_map) + 1)
    return raw.select(*[F.col(str(i)).alias(name) for i, name in sorted(column_map.items())])


def read_json_array(spark: SparkSession, path: str, schema) -> DataFrame:
    """Files holding one array of objects each, however large: a file is read by as many tasks as it has splits.

    An object that does not parse is skipped.
    """
    return quoted.json_array_rows(spark, path, schema)


def read_json_object(spark: SparkSession, path: str, schema) -> DataFrame:
    """Files holding one object; those that do not parse are read as JSON lines."""
    return read_json(spark, path, schema)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One record per line; an array line gives its elements.

    Comment lines and lines that do not parse are skipped.
    """
    lines = spark.read.text(path).select(text.strip(F.col("value")).alias("line"))
    data = lines.filter((F.col("line") != "") & ~F.col("line").rlike("^(#|//)"))
    return _records(data, "line", schema)


def _records(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    c = F.col(column)
    one = F.from_json(c, schema, {"mode": "PERMISSIVE"})
    parsed = F.when(c.startswith("["), F.from_json(c, T.ArrayType(schema))).when(
        c.startswith("{"), F.array(one)
    )
    found = df.select(F.explode(parsed).alias("r"))
    filled = [F.col(f"r.`{f.name}`").isNotNull() for f in schema.fields]
    anything = filled[0]
    for test in filled[1:]:
        anything = anything | test
    return found.filter(anything).select("r.*")


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON lines, one array or one object per file, told apart file by file.

    Each file is parsed whole; one that is no single JSON value is read line by
    line, so a broken line costs that line. The test and the parse run in the tasks,
    and no path reaches the driver. A file is one task's work; JSON lines alone are
    read by `read_jsonl`, which splits them.
    """
    whole = spark.read.text(path, wholetext=True).select(text.strip(F.col("value")).alias("body"))
    marked = whole.withColumn("single", F.try_parse_json(F.concat(F.lit("["), "body", F.lit("]"))).isNotNull())
    parts = F.when(F.col("single"), F.array("body")).otherwise(F.transform(F.split("body", "\n"), text.strip))
    lines = marked.select(F.explode(parts).alias("line"))
    return _records(lines.filter((F.col("line") != "") & ~F.col("line").rlike("^(#|//)")), "line", schema)


HOST_FIELDS = """
  metadata STRUCT<host_id: STRING, country_code: STRING, collected_at: STRING>,
  software ARRAY<STRUCT<name: STRING>>,
  statistics STRUCT<total_password: LONG, total_cookie: LONG, total_token: LONG,
                    total_card: LONG, total_autofill: LONG>
"""


def read_host_records(spark: SparkSession, path: str) -> DataFrame:
    """Host records, metadata, software names and counts only; broken lines are dropped.

    The schema is the filter: values of other fields are never read into a row.
    """
    return spark.read.schema(HOST_FIELDS).option("mode", "DROPMALFORMED").json(path)


def read_text_lines(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, line_number, line) of a text column; blank and comment lines dropped."""
    from exposura.functions.lines import numbered_lines

    exploded = df.select(key, F.explode(numbered_lines(F.col(column))).alias("l"))
    return exploded.select(key, "l.line_number", "l.line")


MESSAGE_BUCKETS = 64


def channel_bucket(channel: Column) -> Column:
    return F.pmod(F.xxhash64(channel.cast("string")), F.lit(MESSAGE_BUCKETS)).cast("int")


def read_messages(
    spark: SparkSession, path: str, channels: str | list = "all", merge_schema: bool = False
) -> DataFrame:
    """Message store as write_messages lays it out; only the buckets of the channels are scanned.

    Merging the schemas of parts written under older ones reads every footer, so
    it is asked for only when a column was added.
    """
    from exposura.operators.filters import select_channels

    stored = spark.read.option("mergeSchema", merge_schema).parquet(path)
    if channels != "all":
        wanted = [channel_bucket(F.lit(str(c))) for c in channels]
        stored = stored.filter(F.col("bucket").isin(*wanted))
    return stored.filter(select_channels(channels)).drop("bucket")


def read_forums(df: DataFrame, active_only: bool = False) -> DataFrame:
    return df.filter("is_active") if active_only else df


def catalog_columns(df: DataFrame, path: str, size: str, is_directory=None) -> DataFrame:
    """The file catalog's columns from a relative path and a size; skipped directories go."""
    p = F.col(path)
    directory = is_directory if is_directory is not None else F.lit(False)
    return df.filter(~files.in_skipped_dir(p)).select(
        p.alias("relative_path"),
        files.filename(p).alias("filename"),
        F.when(~directory, files.extension(p)).alias("extension"),
        F.col(size).cast("long").alias("file_size_bytes"),
        files.parent_directory(p).alias("parent_directory"),
        files.parent_path(p).alias("parent_path"),
        files.depth_level(p, directory).alias("depth_level"),
        directory.alias("is_directory"),
        F.when(~directory, F.regexp_replace(files.extension(p), r"^\.", "")).alias("estimated_type"),
        F.lit("pending").alias("processing_status"),
    )


def catalog_files(spark: SparkSession, root: str, directories: bool = False) -> DataFrame:
    """Catalog of a directory tree, its directories too if asked for; contents are not read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", F.col("length").alias("size"))
    )
    base = root.rstrip("/") + "/"
    relative = F.substring_index(F.col("path"), base, -1)
    listed = catalog_columns(found.withColumn("rel", relative), "rel", "size")
    return listed.unionByName(directory_rows(listed), allowMissingColumns=True) if directories else listed


def directory_rows(catalog: DataFrame) -> DataFrame:
    """Catalog rows of every directory above the files, with child_count and size.

    The size is that of all files below; children are the files and directories
    directly within. Each file counts into its ancestors where it is read, so only
    sums are shuffled.
    """
    parts = F.split("relative_path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    within = F.when(F.size(parts) > 1, above).otherwise(F.array().cast("array<string>"))
    found = catalog.filter(~F.col("is_directory")).select(
        "parent_path", F.col("file_size_bytes").alias("_bytes"), F.explode(within).alias("_dir")
    )
    sums = found.groupBy("_dir").agg(
        F.sum("_bytes").alias("_size"), F.count_if(F.col("parent_path") == F.col("_dir")).alias("_files"))
    folders = sums.groupBy(files.parent_path(F.col("_dir")).alias("_above")).agg(F.count("*").alias("_folders"))
    joined = sums.join(folders, F.col("_dir") == F.col("_above"), "left")
    rows = catalog_columns(joined, "_dir", "_size", F.lit(True))
    counted = joined.select(
        F.col("_dir").alias("relative_path"), (F.col("_files") + F.coalesce("_folders", F.lit(0))).alias("child_count"))
    return rows.join(counted, "relative_path")


def scan_batch_dir(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, size) of every file below a directory; hidden and ~ files skipped."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(root)
    )
    name = files.filename(F.col("path"))
    return found.filter(~name.rlike(r"^[.~]") & ~name.endswith("~")).select("path", F.col("length").alias("size"))


def detect_encoding(content: Column, head: int = 65536) -> Column:
    """Name of the encoding: byte order mark, then UTF-8, else cp1256.

    cp1256 gives every byte a meaning, so no further candidate can be reached.
    Works on the head of the file, which is what the probe is for; a sequence cut
    by the probe's end does not count against UTF-8.
    """
    probe = F.substring(content, 1, head)
    mark = F.hex(F.substring(content, 1, 3))
    valid = F.is_valid_utf8(probe)
    for cut in (1, 2, 3):
        shorter = F.substring(content, 1, head - cut)
        valid = valid | ((F.octet_length(content) > head) & F.is_valid_utf8(shorter))
    return (
        F.when(mark.startswith("EFBBBF"), "utf-8-sig")
        .when(mark.startswith("FFFE") | mark.startswith("FEFF"), "utf-16")
        .when(valid, "utf-8")
        .otherwise("cp1256")
    )


HIGH = bytes(range(128, 256))


def decode_cp1256(content: Column) -> Column:
    """Text of bytes in cp1256: read as Latin-1, the upper half exchanged letter by letter."""
    return F.translate(F.decode(content, "ISO-8859-1"), HIGH.decode("latin-1"), HIGH.decode("cp1256"))


def read_encoded_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, encoding, line) of text files of different encodings, as one table.

    One aggregate over the bytes finds each file's encoding: utf-16 by its byte order
    mark, utf-8 where all of it is valid, else cp1256; flags move, no text. The lines
    then meet their file's encoding and are decoded by it, in the tasks that read
    them. Files with a UTF-16 mark cannot be cut at a line's end byte: their pieces are
    put together again, each file in one task. A mark (UTF-8's is dropped as the file
    is read) and the carriage return at a line's end are no part of the line.
    """
    lines = quoted.split_lines(spark, path).withColumn("b", F.col("line").cast("binary")).drop("line")
    at = F.struct("_split", "_at")
    found = lines.groupBy("_file").agg(
        F.min_by(F.hex(F.substring("b", 1, 2)), at).alias("mark"), F.bool_and(F.is_valid_utf8("b")).alias("valid"))
    encoding = F.when(F.col("mark").isin("FFFE", "FEFF"), "utf-16").when(F.col("valid"), "utf-8").otherwise("cp1256")
    known = lines.join(found.select("_file", encoding.alias("encoding")), "_file")

    one_byte = known.filter("encoding <> 'utf-16'").select(
        "_file", "encoding", F.when(F.col("encoding") == "cp1256", decode_cp1256(F.col("b"))).otherwise(F.col("b").cast("string")).alias("line"))

    pieces = known.filter("encoding = 'utf-16'").groupBy("_file", "encoding").agg(
        F.sort_array(F.collect_list(F.struct("_split", "_at", "b"))).alias("p"))
    whole = F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["b"])), "0A"))
    even = F.when(F.octet_length(whole) % 2 == 1, F.concat(whole, F.unhex(F.lit("0A")))).otherwise(whole)
    split = F.split(F.regexp_replace(F.decode(even, "UTF-16"), "\n$", ""), "\n", -1)
    two_bytes = pieces.select("_file", "encoding", F.explode(split).alias("line"))
    return one_byte.unionByName(two_bytes).select(F.col("_file").alias("file"), "encoding", F.regexp_replace("line", "\r$", "").alias("line"))


def read_run_log(df: DataFrame, column: str = "value") -> DataFrame:
    """(timestamp, level, message) of log lines; lines under four parts dropped."""
    parts = F.split(text.strip(F.col(column)), " ", 4)
    return df.filter(F.size(parts) >= 4).select(
        F.concat_ws(" ", parts[0], parts[1]).alias("timestamp"),
        F.btrim(parts[2], F.lit("[]")).alias("level"),
        parts[3].alias("message"),
    )
