"""Sources (survey 2.1): tables are written out in a format and read back by the reader.

The files go to the shared folder the session names, so the readers face files
that grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from exposura.catalog import views as v
from exposura.catalog.base import q, query, sql_in, strip
from exposura.catalog.q_filters import LOG, run_log
from exposura.session import DEMO_PEPPER, pepper, scratch_path
from exposura.sinks.writers import write_messages
from exposura.sources import readers as r

# Names with a line break, the delimiters and quotes within, or a quote that opens nothing.
NAME = """CASE c_custkey % 5 WHEN 0 THEN c_name || chr(10) || 'of ;,|"' || c_custkey || '"' || chr(10) WHEN 1 THEN '5" ' || c_name ELSE c_name END"""
CUSTOMER = f"SELECT CAST(c_custkey AS VARCHAR) AS id, {NAME} AS name, c_mktsegment AS segment FROM customer"


def _customers(spark, folder):
    k, name = F.col("c_custkey"), F.col("c_name")
    broken = F.concat(name, F.lit('\nof ;,|"'), k, F.lit('"\n'))
    return r.table(spark, folder, "customer").select(
        k.cast("string").alias("id"), F.when(k % 5 == 0, broken).when(k % 5 == 1, F.concat(F.lit('5" '), name)).otherwise(name).alias("name"),
        F.col("c_mktsegment").alias("segment"))


def _written_csv(spark, df, label, sep=",", header=True):
    """The table as delimited lines; a field is quoted only where it must be."""
    def field(c):
        must = c.contains(sep) | c.contains("\n") | c.startswith('"')
        return F.when(must, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)

    path = scratch_path(spark, label)
    line = F.concat_ws(sep, *[field(F.col(c)) for c in df.columns])
    head = spark.createDataFrame([(sep.join(df.columns),)], "value string") if header else None
    body = df.select(line.alias("value"))
    (head.unionByName(body).coalesce(1) if header else body).write.text(path)
    return path


@query("read_delimited", CUSTOMER)
def read_delimited(spark, folder):
    path = _written_csv(spark, _customers(spark, folder), "delimited", ";")
    return r.read_delimited(spark, path, ";", ["id", "name", "segment"])


@query("read_positional", f"SELECT CAST(c_custkey AS VARCHAR) AS id, {NAME} AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS beyond FROM customer")
def read_positional(spark, folder):
    path = _written_csv(spark, _customers(spark, folder), "positional", "|", header=False)
    return r.read_positional(spark, path, {0: "id", 1: "name", 2: "segment", 9: "beyond"}, "|")


@query("read_headerless_generic", f'SELECT CAST(c_custkey AS VARCHAR) AS "0", {NAME} AS "1", c_mktsegment AS "2" FROM customer')
def read_headerless_generic(spark, folder):
    path = _written_csv(spark, _customers(spark, folder), "headerless", header=False)
    return r.read_headerless_generic(spark, path)


RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
JSON_SQL = "SELECT c_custkey AS id, c_name AS name FROM customer"


def _json_lines(spark, folder):
    return r.table(spark, folder, "customer").select(F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))).alias("value"), "c_custkey")


@query("read_jsonl", JSON_SQL)
def read_jsonl(spark, folder):
    """Records, arrays of one record, comments and broken lines."""
    k = F.col("c_custkey")
    noise = F.when(k % 3 == 0, F.lit("# note")).when(k % 3 == 1, F.lit("// note")).otherwise(F.lit('{"id": '))
    record = F.when(k % 2 == 0, F.concat(F.lit("["), "value", F.lit("]"))).otherwise(F.col("value"))
    out = _json_lines(spark, folder).select(F.explode(F.array(noise, record)).alias("value"))
    path = scratch_path(spark, "jsonl")
    out.write.text(path)
    return r.read_jsonl(spark, path, RECORD)


@query("read_json", JSON_SQL)
def read_json(spark, folder):
    """JSON lines and files that hold one array over several lines, side by side."""
    path = scratch_path(spark, "json")
    lines = _json_lines(spark, folder)
    lines.filter("c_custkey % 2 = 0").select("value").write.text(f"{path}/lines")
    _write_arrays(lines.filter("c_custkey % 2 = 1"), f"{path}/arrays")
    return r.read_json(spark, [f"{path}/lines", f"{path}/arrays/part=*"], RECORD)


def _write_arrays(lines, path):
    """Files of one array each, of at most five hundred records."""
    arrays = lines.groupBy(F.floor(F.col("c_custkey") / 500).alias("part")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.sort_array(F.collect_list("value")), ",\n"), F.lit("\n]")).alias("value")
    )
    arrays.write.partitionBy("part").text(path)


@query("read_json_array", "SELECT c_custkey AS id, c_name || '},{\"[' || c_custkey AS name FROM customer")
def read_json_array(spark, folder):
    """One array over all records in one file, with brackets and quotes in its texts, and nested parts."""
    c = r.table(spark, folder, "customer")
    name = F.concat("c_name", F.lit('},{"['), "c_custkey")
    inner = F.struct(F.array(F.struct(F.lit("}").alias("x"))).alias("list"))
    one = F.to_json(F.struct(F.col("c_custkey").alias("id"), inner.alias("more"), name.alias("name")))
    lines = c.select(F.explode(F.array(one, F.lit(","))).alias("value"))
    first, last = (spark.createDataFrame([(x,)], "value string") for x in ("[", "{}]"))
    path = scratch_path(spark, "json-array")
    first.unionByName(lines).unionByName(last).coalesce(1).write.text(path)
    return r.read_json_array(spark, path, RECORD).filter("id IS NOT NULL")


@query("read_json_object", "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation")
def read_json_object(spark, folder):
    path = scratch_path(spark, "json-object")
    n = r.table(spark, folder, "nation")
    body = F.concat(F.lit('{\n "id": '), "n_nationkey", F.lit(',\n "name": "'), "n_name", F.lit('"\n}'))
    n.select(body.alias("value"), F.col("n_nationkey").alias("part")).write.partitionBy("part").text(path)
    return r.read_json_object(spark, f"{path}/part=*", RECORD)


@query("read_host_records", f"""
WITH {v.HOST_COUNTS} SELECT CAST(host_id AS VARCHAR) AS host_id, 'N' || (host_id % 25) AS country_code,
  count(*) FILTER (kind = 'password') AS total_password, count(*) FILTER (kind = 'cookie') AS total_cookie
FROM host_counts GROUP BY host_id""")
def read_host_records(spark, folder):
    """Records with fields the reader must not take up, and broken lines."""
    from exposura.operators.aggregates import host_statistics

    stats = host_statistics(v.host_counts(spark, folder), "host_id", "kind", "n", list(v.KINDS.values()))
    record = F.to_json(F.struct(
        F.struct(F.col("host_id").cast("string").alias("host_id"), F.concat(F.lit("N"), F.col("host_id") % 25).alias("country_code")).alias("metadata"),
        F.struct("total_password", "total_cookie", "total_token", "total_card", "total_autofill").alias("statistics"),
        F.lit("never read").alias("raw"),
    ))
    path = scratch_path(spark, "hosts")
    stats.select(F.explode(F.array(record, F.lit('{"metadata": '))).alias("value")).write.text(path)
    h = r.read_host_records(spark, path)
    return h.select("metadata.host_id", "metadata.country_code", "statistics.total_password", "statistics.total_cookie")


PEPPER = q(DEMO_PEPPER)


@query("read_text_lines", f"""
WITH {v.LINES} SELECT doc_id, CAST(pos AS BIGINT) + 1 AS line_number, sha256({PEPPER} || line) AS line_hash FROM lines
WHERE {strip('line')} <> '' AND NOT starts_with(line, '#')""")
def read_text_lines(spark, folder):
    l = r.read_text_lines(r.table(spark, folder, "documents"), "doc_id", "text")
    return l.select("doc_id", "line_number", F.sha2(F.concat(F.lit(pepper(spark, DEMO_PEPPER)), "line"), 256).alias("line_hash"))


@query("read_messages", f"WITH {v.MESSAGES} SELECT channel, message_id, username, views, CASE WHEN channel % 2 = 1 THEN views END AS forwards FROM messages")
def read_messages(spark, folder):
    """A message store whose odd channels were written later, with one more column."""
    path = scratch_path(spark, "messages")
    m = v.messages(spark, folder).select("channel", "message_id", "username", "views")
    write_messages(m.filter("channel % 2 = 0"), path)
    write_messages(m.filter("channel % 2 = 1").withColumn("forwards", F.col("views")), path)
    stored = r.read_messages(spark, path, merge_schema=True)
    return stored.select("channel", "message_id", "username", "views", "forwards")


@query("read_forums", f"WITH {v.FORUMS} SELECT forum, base_url FROM forums WHERE is_active")
def read_forums(spark, folder):
    return r.read_forums(v.forums(spark, folder), active_only=True).select("forum", "base_url")


@query("read_threads", f"WITH {v.THREADS} SELECT doc_id, forum, dedup_hash FROM threads")
def read_threads(spark, folder):
    return r.read_forums(v.threads(spark, folder)).select("doc_id", "forum", "dedup_hash")


@query("catalog_columns", f"WITH {v.PAGE_FILES} SELECT * FROM page_files")
def catalog_columns(spark, folder):
    """The catalog's columns over the page addresses taken as paths."""
    c = v.page_files(spark, folder)
    return c.withColumn("depth_level", F.col("depth_level").cast("long")).withColumn(
        "file_size_bytes", F.col("file_size_bytes").cast("long")
    )


FILE_SIZES = """SELECT source AS parent_directory, CAST(sum(strlen(text) + 1) AS BIGINT) AS total_size FROM documents GROUP BY source"""


def _text_tree(spark, folder, label):
    """documents as text files in one directory per source."""
    path = scratch_path(spark, label)
    r.table(spark, folder, "documents").select("source", "text").hint("rebalance", "source").write.partitionBy("source").text(path)
    return path


@query("catalog_files", FILE_SIZES)
def catalog_files(spark, folder):
    c = r.catalog_files(spark, _text_tree(spark, folder, "tree")).filter(F.col("extension") == ".txt")
    sizes = c.groupBy("parent_directory").agg(F.sum("file_size_bytes").alias("total_size"))
    return sizes.withColumn("parent_directory", F.regexp_replace("parent_directory", "^source=", ""))


@query("catalog_directories", """
SELECT 'source=' || source AS relative_path, CAST(sum(strlen(text) + 1) AS BIGINT) AS file_size_bytes, CAST(1 AS BIGINT) AS depth_level
FROM documents GROUP BY source""")
def catalog_directories(spark, folder):
    """The directories of a tree that was written out, each with the size of what is below."""
    written = r.catalog_files(spark, _text_tree(spark, folder, "folders"))
    texts = written.filter(F.col("extension") == ".txt")
    return r.directory_rows(texts).select("relative_path", "file_size_bytes", (F.col("depth_level") + 1).cast("long").alias("depth_level"))


@query("scan_batch_dir", FILE_SIZES)
def scan_batch_dir(spark, folder):
    found = r.scan_batch_dir(spark, _text_tree(spark, folder, "batch"), "*.txt")
    source = F.regexp_extract("path", "source=([^/]+)/", 1)
    return found.groupBy(source.alias("parent_directory")).agg(F.sum("size").alias("total_size"))


@query("detect_encoding", """
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'utf-8-sig' WHEN doc_id % 4 = 1 THEN 'utf-16'
  WHEN doc_id % 4 = 2 AND regexp_matches(text, '[à-ÿ]') THEN 'cp1256' ELSE 'utf-8' END AS encoding
FROM documents""")
def detect_encoding(spark, folder):
    k = F.col("doc_id") % 4
    d = r.table(spark, folder, "documents")
    content = (
        F.when(k == 0, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8")))
        .when(k == 1, F.encode(F.concat(F.lit("x"), "text"), "UTF-16"))
        .when((k == 2) & F.col("text").rlike("[à-ÿ]"), F.concat(F.unhex(F.lit("E9E9")), F.encode(F.regexp_replace("text", "[^\\x00-\\x7f]", ""), "UTF-8")))
        .otherwise(F.encode("text", "UTF-8"))
    )
    return d.select("doc_id", r.detect_encoding(content).alias("encoding"))


@query("read_encoded_lines", f"""
WITH {v.LINES}, l AS (SELECT doc_id, (['utf-8', 'utf-16', 'cp1256', 'utf-8'])[doc_id % 4 + 1] AS encoding,
  CASE WHEN doc_id % 4 = 2 THEN regexp_replace(line, '[^\x20-\x7eàâçèéêëîïôùûü]', '', 'g') || 'é' ELSE line END AS line FROM lines)
SELECT doc_id, encoding, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars, min(sha256({PEPPER} || line)) AS least_hash
FROM l GROUP BY doc_id, encoding""")
def read_encoded_lines(spark, folder):
    """A folder whose files are in four encodings, read as one table."""
    k = F.col("doc_id")
    cut = r.table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    only = F.concat(F.regexp_replace("line", "[^\\x20-\\x7eàâçèéêëîïôùûü]", ""), F.lit("é"))
    named = F.concat(k, F.lit("|"), F.when(k % 4 == 2, only).otherwise(F.col("line")))
    rows = cut.select(k, "pos", (k % 32).alias("part"), named.alias("line"))
    heads = spark.range(32).select(F.lit(None).cast("long").alias("doc_id"), F.lit(-1).alias("pos"), F.col("id").alias("part"), F.lit("").alias("line"))
    group = F.col("part") % 4
    content = (
        F.when((group == 0) & (F.col("pos") < 0), F.unhex(F.lit("EFBBBF")))
        .when((group == 1) & (F.col("pos") < 0), F.unhex(F.lit("FEFF00")))
        .when(group == 1, F.concat(F.encode("line", "UTF-16BE"), F.unhex(F.lit("00"))))
        .when((group == 2) & (F.col("pos") >= 0), F.encode("line", "ISO-8859-1"))
        .otherwise(F.encode("line", "UTF-8")))
    path = scratch_path(spark, "encoded")
    placed = rows.unionByName(heads).repartition("part").sortWithinPartitions("part", F.col("pos") >= 0, "doc_id", "pos")
    placed.select("part", content.cast("string").alias("value")).write.partitionBy("part").text(path)
    found = r.read_encoded_lines(spark, f"{path}/part=*").filter("line <> ''")
    line = F.regexp_extract("line", "^[0-9]+[|](.*)$", 1)
    return found.select(F.regexp_extract("line", "^([0-9]+)", 1).cast("long").alias("doc_id"), "encoding", line.alias("line")).groupBy(
        "doc_id", "encoding").agg(
        F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"),
        F.min(F.sha2(F.concat(F.lit(pepper(spark, DEMO_PEPPER)), "line"), 256)).alias("least_hash"))


@query("read_run_log", f"WITH {LOG} SELECT timestamp, level, message FROM log")
def read_run_log(spark, folder):
    return run_log(spark, folder)
