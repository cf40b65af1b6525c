"""Schema and format inference (survey 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import case_first, q, query, sql_in, sql_list, strip
from exposura.catalog.q_aggregates import SHARE_LINES
from exposura.functions import files, text
from exposura.operators import inference as inf
from exposura.plans import jobs
from exposura.sources.readers import table


def _cnt(x: str, d: str) -> str:
    return f"(length({x}) - length(replace({x}, {d}, '')))"


DELIMS = ["';'", "chr(9)", "'|'", "','"]


def _sniff(x: str) -> str:
    best = "greatest(" + ", ".join(_cnt(x, d) for d in DELIMS) + ")"
    return case_first([(f"{best} = 0", "','")] + [(f"{_cnt(x, d)} = {best}", d) for d in DELIMS])


@query("sniff_delimiter", f"SELECT doc_id, {_sniff('l')} AS delimiter FROM (SELECT doc_id, split_part(text, chr(10), 1) AS l FROM documents)")
def sniff_delimiter(spark, folder):
    d = table(spark, folder, "documents")
    return d.select("doc_id", inf.sniff_delimiter(text.first_line(F.col("text"))).alias("delimiter"))


def _head_lines(spark, folder):
    """The first line each of many files would have: names, data, or a mix."""
    o = table(spark, folder, "orders")
    k = F.col("o_orderkey") % 4
    names = F.lit("id;email;status;total")
    data = F.concat_ws(";", F.col("o_orderkey"), F.lit("a@example.com"), "o_orderstatus", F.format_string("%.2f", "o_totalprice"))
    mixed = F.concat_ws("|", F.lit('"a"'), F.lit("b"), F.col("o_custkey"), F.lit("c"), F.lit("d"), F.lit("e"))
    known = F.concat_ws(",", F.lit("email"), F.col("o_custkey"), F.lit("c"), F.lit("d"))
    return o.select("o_orderkey", F.when(k == 0, names).when(k == 1, data).when(k == 2, mixed).otherwise(known).alias("line"))


HEADS = """heads AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'id;email;status;total'
  WHEN 1 THEN o_orderkey || ';a@example.com;' || o_orderstatus || ';' || printf('%.2f', o_totalprice)
  WHEN 2 THEN '"a"|b|' || o_custkey || '|c|d|e' ELSE 'email,' || o_custkey || ',c,d' END AS line FROM orders)"""


KNOWN = sql_in(n.lower() for n in rules.COLUMN_ALIASES)
DATA_LIKE_SQL = " OR ".join(f"regexp_matches(x, {q(p)})" for p in inf.DATA_LIKE)
# The first row is data: half its first eight cells look like data, or some do and none is a known name.
HEADLESS = f"""firsts AS (SELECT o_orderkey, line, d, list_transform(string_split(line, d)[1:8], lambda x: trim(trim(x), '"')) AS a
  FROM (SELECT o_orderkey, line, {_sniff('line')} AS d FROM heads)),
verdicts AS (SELECT o_orderkey, line, d, n >= greatest(1, len(a) // 2) OR (n > 0 AND len(list_filter(a, lambda x: lower(x) IN {KNOWN})) = 0) AS headerless
  FROM (SELECT *, len(list_filter(a, lambda x: {DATA_LIKE_SQL})) AS n FROM firsts))"""


@query("is_headerless", f"WITH {HEADS}, {HEADLESS} SELECT o_orderkey, headerless FROM verdicts")
def is_headerless(spark, folder):
    h = _head_lines(spark, folder)
    delim = inf.sniff_delimiter(F.col("line"))
    return h.select("o_orderkey", inf.is_headerless(F.col("line"), delim).alias("headerless"))


SUFFIXES = ["email", "mobile", "pwd", "nick", "name", "town", "amount", "order_date", "weight", "sex", "last_ip", "uid"]


def _column_names(spark, folder):
    pick = F.get(F.array(*[F.lit(s) for s in SUFFIXES]), F.col("p_size") % len(SUFFIXES))
    return table(spark, folder, "part").select(
        "p_partkey", F.concat_ws("_", F.translate("p_name", " ", "_"), pick).alias("name")
    )


NAMES = f"names AS (SELECT p_partkey, replace(p_name, ' ', '_') || '_' || ({sql_list(SUFFIXES)})[p_size % {len(SUFFIXES)} + 1] AS name FROM part)"
CLASS = case_first([(f"regexp_matches(lower(name), {q(p)})", q(t)) for p, t in rules.COLUMN_PATTERNS], "'ignore'")


@query("classify_columns", f"WITH {NAMES} SELECT p_partkey, {CLASS} AS target FROM names")
def classify_columns(spark, folder):
    return _column_names(spark, folder).select("p_partkey", inf.classify_column(F.col("name")).alias("target"))


@query("learn_aliases", f"""
WITH {NAMES}, found AS (SELECT name, min({CLASS}) AS target FROM names GROUP BY name),
known AS (SELECT name, CASE WHEN length(name) % 2 = 0 THEN 'ignore' ELSE 'city' END AS target FROM found WHERE length(name) % 3 = 0),
junk AS (SELECT * FROM known)
SELECT coalesce(k.name, f.name) AS name, CASE WHEN k.target IS NULL OR (k.target = 'ignore' AND f.target IS NOT NULL) THEN f.target ELSE k.target END AS target
FROM found f LEFT JOIN known k USING (name)""")
def learn_aliases(spark, folder):
    found = _column_names(spark, folder).select("name", inf.classify_column(F.col("name")).alias("target"))
    n = F.length("name")
    known = found.filter(n % 3 == 0).select("name", F.when(n % 2 == 0, "ignore").otherwise("city").alias("target")).distinct()
    junk = found.select(F.concat(F.lit("{"), "name", F.lit("}")).alias("name"), "target")
    return inf.learn_aliases(known, found.unionByName(junk))


@query("schema_catalog", f"""
WITH {HEADS}, {HEADLESS}
SELECT o_orderkey, d AS delimiter, '_flat' AS table_name, len(string_split(line, d)) AS n_columns, headerless, 'header' AS method,
       array_to_string(CASE WHEN headerless THEN list_transform(range(len(string_split(line, d))), lambda i: CAST(i AS VARCHAR))
                            ELSE list_transform(string_split(line, d), lambda x: trim(x, '"')) END, '/') AS columns FROM verdicts""")
def schema_catalog(spark, folder):
    c = inf.schema_catalog(_head_lines(spark, folder), "o_orderkey", "line")
    one = F.get("tables", F.lit(0))
    return c.select(
        "o_orderkey", "delimiter", one["table_name"].alias("table_name"), F.array_join(one["columns"], "/").alias("columns"),
        one["n_columns"].cast("long").alias("n_columns"), one["headerless"].alias("headerless"), "method",
    )


# A dump per part: a table with nested brackets and literals that look like statements, one
# that is only filled, one filled without columns, one under a schema's name.
DUMP = [
    "-- dump (of; everything)\nCREATE TABLE IF NOT EXISTS `", "<name>", "` (\n  `id` int(11) NOT NULL COMMENT 'a, (b); CREATE TABLE x (y)',\n"
    "  price decimal(10,2),\n  kind enum('a','b'),\n  PRIMARY KEY (`id`, price),\n  CONSTRAINT c CHECK ((price > 0))\n) ENGINE=x;\nINSERT INTO `",
    "<name>", "` VALUES (1,2.5,'it''s; (fine)'),(", "<size>", ",3,'INSERT INTO z (q) VALUES');\nINSERT INTO log_", "<size>",
    " (at, `by`) VALUES ('now', 'me');\nINSERT INTO log_", "<size>", " (other) VALUES (1);\nINSERT INTO bare VALUES (1);\n"
    'CREATE TABLE "main"."late" ("key" text, val', "<size>", " text); insert into late (key) values ('a');\n"]
DUMP_SQL = " || ".join({"<name>": "n", "<size>": "CAST(p_size AS VARCHAR)"}.get(x) or q(x) for x in DUMP)
MADE = r'(?is)^\s*CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?(?:[`"]?\w+[`"]?\.)*[`"]?(\w+)'
FILLED = r"(?is)^\s*INSERT\s+INTO\s+[`]?(\w+)"
DDL_WORDS = sql_in(rules.DDL_CONSTRAINTS)
COLUMN = r'^\s*[`"]?(\w+)'


@query("schema_catalog_dump", f"""
WITH d AS (SELECT p_partkey, p_size, replace(p_name, ' ', '_') AS n FROM part),
quiet AS (SELECT p_partkey, regexp_replace({DUMP_SQL}, {q("(?s)'(?:[^']|'')*'")}, '0', 'g') AS t FROM d),
bare AS (SELECT p_partkey, regexp_replace(regexp_replace(t, '-- [^\\n]*', ' ', 'g'), {q(r"(?is)\bVALUES\b[^;]*")}, ' ', 'g') AS t FROM quiet),
st AS (SELECT p_partkey, unnest(range(len(a))) AS pos, unnest(a) AS s FROM (SELECT p_partkey, string_split(t, ';') AS a FROM bare)),
named AS (SELECT p_partkey, pos, s, regexp_extract(s, {q(MADE)}, 1) AS made, regexp_extract(s, {q(FILLED)}, 1) AS filled FROM st),
body AS (SELECT p_partkey, pos, CASE WHEN made <> '' THEN made ELSE filled END AS table_name, made <> '' AS created,
  regexp_replace(regexp_replace(regexp_extract(s, '(?s)[(](.*)[)]', 1), '[(][^()]*[)]', '', 'g'), '[(][^()]*[)]', '', 'g') AS b
  FROM named WHERE made <> '' OR filled <> ''),
kept AS (SELECT * FROM body QUALIFY row_number() OVER (PARTITION BY p_partkey, table_name ORDER BY created DESC, pos) = 1),
cols AS (SELECT p_partkey, pos, table_name, list_filter(list_transform(string_split(b, ','), lambda x: regexp_extract(x, {q(COLUMN)}, 1)),
  lambda x: x <> '' AND lower(x) NOT IN {DDL_WORDS} OR x = 'key' AND table_name = 'late') AS c FROM kept)
SELECT p_partkey, string_agg(table_name || ':' || array_to_string(c, ','), '|' ORDER BY pos) AS tables, count(*) AS n_tables,
  CAST(sum(len(c)) AS BIGINT) AS n_columns, 'statements' AS method, '2024-01-02 03:04:05' AS scanned_at FROM cols GROUP BY p_partkey""")
def schema_catalog_dump(spark, folder):
    """The rows are few bytes and much work, so they are dealt over tasks however few splits their file has."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = table(spark, folder, "part").select("p_partkey", "p_name", "p_size").repartition(tasks)
    names = {"<name>": F.translate("p_name", " ", "_"), "<size>": F.col("p_size").cast("string")}
    dumps = p.select("p_partkey", F.concat(*[names.get(x, F.lit(x)) for x in DUMP]).alias("body"))
    dumps = dumps.withColumn("line", text.first_line(F.col("body")))
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    c = inf.schema_catalog(dumps, "p_partkey", "line", F.lit(True), "body", at)
    listed = F.transform("tables", lambda t: F.concat(t["table_name"], F.lit(":"), F.array_join(t["columns"], ",")))
    return c.select(
        "p_partkey", F.array_join(listed, "|").alias("tables"), F.size("tables").cast("long").alias("n_tables"),
        F.aggregate("tables", F.lit(0).cast("long"), lambda n, t: n + t["n_columns"]).alias("n_columns"), "method",
        F.date_format("scanned_at", "yyyy-MM-dd HH:mm:ss").alias("scanned_at"))


@query("mapping_failed", f"""
WITH {NAMES}, useful AS (SELECT p_partkey, {CLASS} IN {sql_in(rules.IDENTITY_TARGETS + rules.FINANCIAL_TARGETS)} AS u FROM names)
SELECT p_partkey, NOT u AS failed, p_partkey % 2 = 0 AS ambiguous FROM useful""")
def mapping_failed(spark, folder):
    n = _column_names(spark, folder)
    other = F.when(F.col("p_partkey") % 2 == 0, "col_1").otherwise("weight")
    columns = F.array(F.col("name"), other)
    return n.select("p_partkey", inf.mapping_failed(columns).alias("failed"), inf.ambiguous_names(columns).alias("ambiguous"))


@query("sample_values", """
SELECT 'o_orderkey' AS column_name, 'integer' AS shape UNION ALL SELECT 'price', 'decimal' UNION ALL SELECT 'day', 'date'
UNION ALL SELECT 'word', 'text' UNION ALL SELECT 'props', 'json'""")
def sample_values(spark, folder):
    """The first hundred rows are the operator's sample."""
    o = table(spark, folder, "orders").select(
        (F.col("o_orderkey") + 1).alias("line"), "o_orderkey",
        F.when(F.col("o_orderkey") > 2, F.format_string("%.2f", "o_totalprice")).otherwise("n/a").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("word"),
        F.to_json(F.struct("o_custkey")).alias("props"),
    )
    return inf.sample_shapes(o, "line", ["o_orderkey", "price", "day", "word", "props"])


FIELDS = r"""regexp_extract_all(',' || line, ',("(?:[^"]|"")*"[^,]*|[^,]*)', 1)"""
FILE_RULES = [("^red.*gear", "gears"), ("gear|bolt", "metal"), ("^(small|old) ", "sized"), ("ring$", "rings")]


@query("filename_rules", f"""
SELECT p_partkey, {case_first([(f"regexp_matches(lower(p_name), {q(p)})", q(x)) for p, x in FILE_RULES])} AS parser FROM part""")
def filename_rules(spark, folder):
    return table(spark, folder, "part").select("p_partkey", inf.filename_rule(F.upper("p_name"), FILE_RULES).alias("parser"))


FILE_RECORDS = [
    {"pattern": "^red.*gear", "parser": "delimited", "delimiter": ";", "header": False, "columns": {0: "uid", 3: "phone"}},
    {"pattern": "gear|bolt", "parser": "delimited", "delimiter": "\t", "header": True},
    {"pattern": "ring$", "parser": "json"},
]


def _first_record(field):
    """The field of the first record whose pattern the name matches, in SQL."""
    return case_first([(f"regexp_matches(lower(p_name), {q(x['pattern'])})", field(x)) for x in FILE_RECORDS])


@query("filename_records", f"""
SELECT p_partkey, {_first_record(lambda x: q(x["parser"]))} AS parser,
  {_first_record(lambda x: q(x["delimiter"]) if "delimiter" in x else "NULL")} AS delimiter,
  {_first_record(lambda x: str(x["header"]).lower() if "header" in x else "NULL")} AS header,
  {_first_record(lambda x: q(",".join(f"{k}={t}" for k, t in x["columns"].items())) if "columns" in x else "NULL")} AS columns FROM part""")
def filename_records(spark, folder):
    """Whole records by file name: parser, delimiter, header and column map."""
    found = table(spark, folder, "part").select("p_partkey", inf.filename_record(F.upper("p_name"), FILE_RECORDS).alias("r"))
    pairs = F.transform(F.array_sort(F.map_entries("r.columns")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select("p_partkey", "r.parser", "r.delimiter", "r.header", F.array_join(pairs, ",").alias("columns"))


EXTS = [".zip", ".tar.gz", ".pdf", ".txt", ".csv", ".sql", ".jsonl", ".bin", ""]
FAMILY = ["archive", "archive", "binary", "list", "structured_table", "sql_dump", "json", "metadata", "metadata"]


def _named_files(spark, folder):
    d = table(spark, folder, "documents")
    ext = F.get(F.array(*[F.lit(e) for e in EXTS]), (F.col("doc_id") % len(EXTS)).cast("int"))
    return d.select("doc_id", F.concat(F.lit("in/"), "source", F.lit("/f"), "doc_id", ext).alias("path"), "text")


# Samples whose shape must overrule the name: a list, a table with a header, fields with quoted commas.
SAMPLES = [
    "ann@example.com:invented1\nbob@example.com:invented2", "id,first_name,phone\n1,ann,5550\n2,bob,5551",
    '"a,b",c,d\n"e,f",g,h', "a,b,c,d,e,f,g,h\n1,2,3,4,5,6,7,8"]
SAMPLED_SQL = "f AS (SELECT doc_id, CASE doc_id % 5 " + " ".join(f"WHEN {k} THEN {q(x)}" for k, x in enumerate(SAMPLES)) + " ELSE text END AS text FROM documents)"
SHAPE_SQL = f"""l AS (SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM f)),
s AS (SELECT doc_id, pos, {strip('line')} AS line FROM l
  WHERE {strip('line')} <> '' AND NOT starts_with({strip('line')}, '#') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) <= 20),
m AS (SELECT doc_id, avg(len({FIELDS})) AS fields,
  avg(length(replace(line, '://', '')) - length(replace(replace(line, '://', ''), ':', ''))) AS colons FROM s GROUP BY doc_id),
shapes AS (SELECT doc_id, CASE WHEN m.doc_id IS NULL THEN 'list' WHEN fields >= 8 THEN 'table' WHEN colons >= 0.8 AND fields < 4 THEN 'list' ELSE 'undecided' END AS shape
  FROM documents LEFT JOIN m USING (doc_id))"""


def _sampled(spark, folder):
    d = _named_files(spark, folder)
    return d.withColumn("text", text.first_rule([(F.col("doc_id") % 5 == k, x) for k, x in enumerate(SAMPLES)], F.col("text")))


@query("classify_file", f"""
WITH {SAMPLED_SQL}, {SHAPE_SQL}, docs AS (SELECT * FROM f), lines AS (SELECT * FROM l), {SHARE_LINES},
first AS (SELECT doc_id, lower(line) AS low FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) = 1),
topped AS (SELECT doc_id, contains(low, ',') AND len(list_filter(string_split(low, ','), lambda x: trim(x) IN {sql_in(rules.TABLE_HEADERS)})) > 0 AS h FROM first)
SELECT doc_id, CASE WHEN doc_id % {len(EXTS)} = 4 AND doc_id % 2 = 0 THEN 'by_name' WHEN share >= 0.7 THEN 'credential_list'
  WHEN doc_id % {len(EXTS)} = 3 AND (shape = 'table' OR coalesce(topped.h, false)) THEN 'structured_table'
  ELSE ({sql_list(FAMILY)})[doc_id % {len(EXTS)} + 1] END AS parser FROM shapes JOIN share USING (doc_id) LEFT JOIN topped USING (doc_id)""")
def classify_file(spark, folder):
    """By name records, then by the sample's layout, then by suffix and shape."""
    records = [{"pattern": "[02468][.]csv$", "parser": "by_name"}]
    return jobs.classify_file(_sampled(spark, folder), "path", F.col("text"), records, 0.7).select("doc_id", "parser")


@query("csv_vs_list", f"WITH {SAMPLED_SQL}, {SHAPE_SQL} SELECT doc_id, shape FROM shapes")
def csv_vs_list(spark, folder):
    return _sampled(spark, folder).select("doc_id", inf.csv_vs_list(F.col("text")).alias("shape"))


@query("is_transaction_file", f"""
WITH h AS (SELECT o_orderkey, ['id', CASE WHEN o_orderkey % 3 = 0 THEN ' Charge_Amount' ELSE o_orderstatus END, o_orderpriority] AS names FROM orders)
SELECT o_orderkey, len(list_filter(names, lambda x: lower(trim(x)) IN {sql_in(rules.TRANSACTION_TRIGGERS)})) > 0 AS is_transaction FROM h""")
def is_transaction_file(spark, folder):
    second = F.when(F.col("o_orderkey") % 3 == 0, " Charge_Amount").otherwise("o_orderstatus")
    header = F.array(F.lit("id"), second, F.col("o_orderpriority"))
    return table(spark, folder, "orders").select("o_orderkey", inf.is_transaction_header(header).alias("is_transaction"))


# Line of a lineitem: every third has quoted delimiters in its second field, so that counting commas would mislead.
POSITIONAL = """placed AS (SELECT l_orderkey, l_linenumber, lpad(CAST(l_orderkey AS VARCHAR), 9, '1') || ','
  || CASE WHEN l_partkey % 3 = 0 THEN '"a,""b"",,"' WHEN l_partkey % 3 = 1 THEN '"a"' ELSE 'a "b' END || ',b,'
  || CASE WHEN l_suppkey % 2 = 0 THEN '"' || lpad(CAST(l_partkey AS VARCHAR), 10, '5') || '"' ELSE 'none' END
  || repeat(',', CAST(l_linenumber AS INTEGER) + 13) AS line FROM lineitem)"""


@query("positional_fingerprint", f"""
WITH {POSITIONAL}, f AS (SELECT l_orderkey, l_linenumber, {FIELDS} AS a FROM placed)
SELECT l_orderkey, l_linenumber, len(a) >= 20 AND regexp_matches(trim(a[1]), '^[0-9]{{8,20}}$')
  AND regexp_matches(trim(trim(a[4]), '"'), '^[+]?[0-9]{{8,15}}$') AS matches FROM f""")
def positional_fingerprint(spark, folder):
    k = F.col("l_partkey") % 3
    second = F.when(k == 0, '"a,""b"",,"').when(k == 1, '"a"').otherwise('a "b')
    phone = F.concat(F.lit('"'), F.lpad(F.col("l_partkey").cast("string"), 10, "5"), F.lit('"'))
    line = F.concat(
        F.lpad(F.col("l_orderkey").cast("string"), 9, "1"), F.lit(","), second, F.lit(",b,"),
        F.when(F.col("l_suppkey") % 2 == 0, phone).otherwise("none"), F.repeat(F.lit(","), F.col("l_linenumber") + 13),
    )
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", inf.positional_line(line).alias("matches"))


@query("extract_columns_from_create", """
SELECT p_partkey, 'id,' || replace(p_name, ' ', '_') || ',price,note' AS columns FROM part""")
def extract_columns_from_create(spark, folder):
    body = F.concat(
        F.lit("`id` int(11) NOT NULL,\n  `"), F.translate("p_name", " ", "_"),
        F.lit("` varchar(10) DEFAULT 'a,b' COMMENT 'x (y, z)',\n price decimal(10,2),\n note enum('a','b'),\n"
              " PRIMARY KEY (`id`, price),\n UNIQUE KEY `k` (`id`),\n CONSTRAINT c CHECK (price > 0)"),
    )
    return table(spark, folder, "part").select(
        "p_partkey", F.array_join(inf.columns_from_ddl(body), ",").alias("columns")
    )
