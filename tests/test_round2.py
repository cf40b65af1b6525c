"""Inputs on which readers, extractors and rules must lose nothing."""

import os

from pyspark.sql import functions as F, types as T

from conftest import FOLDER
from exposura import catalog
from exposura.functions import html, sensitive, text
from exposura.operators import dedup, inference, joins
from exposura.plans import jobs
from exposura.sinks import writers
from exposura.sources import readers

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def put(folder, name, body):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write(body)


def test_json_files_lose_no_record(spark, tmp_path):
    folder = str(tmp_path / "json")
    put(folder, "broken.json", '{"id":1,"name":"a"}\n{"id":2,\n{"id":3,"name":"c"}\n')
    put(folder, "two.json", '{"id": 6, "name": "f"\n}\n')
    put(folder, "array.json", '[\n{"id":4,"name":"d"},\n{"id":5,"name":"e"}\n]')
    put(folder, "empty.json", "")
    found = readers.read_json(spark, folder, RECORD).collect()
    assert sorted(r["id"] for r in found) == [1, 3, 4, 5, 6]
    assert [r["id"] for r in readers.read_json_object(spark, f"{folder}/two.json", RECORD).collect()] == [6]


def test_quoted_line_breaks_stay_in_their_field(spark, tmp_path):
    folder = str(tmp_path / "csv")
    put(folder, "a.csv", 'id,body,end\n1,"two\nlines",x\n2,one,y\n')
    rows = readers.read_delimited(spark, folder, multiline=True).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "two\nlines", "x"), ("2", "one", "y")]
    put(str(tmp_path / "bare"), "a.csv", '1,"two\nlines",x\n')
    assert readers.read_positional(spark, str(tmp_path / "bare"), {0: "id", 1: "body"}, multiline=True).first()["body"] == "two\nlines"
    assert readers.read_headerless_generic(spark, str(tmp_path / "bare"), multiline=True).count() == 1


def test_newest_status_of_a_key_counts_once(spark):
    rows = spark.createDataFrame([(1, "new", "t0"), (2, "new", "t0")], "id int, status string, status_time string")
    updates = spark.createDataFrame([(1, "old", "t1"), (1, "done", "t2")], "id int, new_status string, new_time string")
    assert sorted(map(tuple, writers.patch_status(rows, updates, "id").collect())) == [(1, "done", "t2"), (2, "new", "t0")]


def test_empty_rule_lists(spark, one):
    assert one(lambda c: text.contains_any(c, []), "x") is False
    assert one(lambda c: text.matched_words(c, []), "x") == []
    assert one(lambda c: text.canonical_label(c, {}), "x") == "x"
    df = spark.createDataFrame([("t",)], "name string")
    assert writers.route_by_table(df, "name", {}).first()["route"] == "main"


def test_delimiters_inside_quotes_do_not_count(one):
    assert one(inference.csv_vs_list, 'a,"x,y,z,p,q,r,s,t",c') == "undecided"
    assert one(lambda c: inference.is_headerless(c, F.lit(",")), '"Doe, 1, 2, 3, 4",email') is False
    assert one(lambda c: inference.header_tokens(c, F.lit(",")), '"a","b,c",d') == ["a", "", "d"]


def test_parentheses_of_any_depth(one):
    body = "`a` int, b decimal(10,2), CHECK ((((((5, 6), 7), 8), 9))), c text"
    assert [n for n in one(inference.columns_from_ddl, body) if n.lower() != "check"] == ["a", "b", "c"]


def test_every_kind_is_masked(one):
    planted = "call (555) 010-9999 or 2001:db8::1 card 3782 822463 10005 password=hunter22 eyJhbGciOi.eyJzdWIiOi.sig_nature to a@example.com"
    masked = one(sensitive.redact, planted)
    for value in ("010-9999", "2001:db8", "822463", "hunter22", "eyJ", "a@example.com"):
        assert value not in masked
    assert masked.startswith("call [PHONE] or [IP] card [CARD] [SECRET]")


def test_elements_end_at_their_own_closing_tag(spark):
    pages = [
        ('<div class="message-body">a<div>b</div>c</div>d', "a<div>b</div>c", "a b c"),
        ('x<div class="other">n</div><div class="message-body">open <b>k</b>', "open <b>k</b>", "n"),
        ('<DIV CLASS="message-body"></DIV>e', "", ""),
        ("no element", "", ""), ("", "", ""), (None, "", ""),
        ('<divider>z</divider><div>y</div>', "", "y"),
        ("<div class='message-body'>" + "<div>q" * 300 + "</div>" * 300 + "end</div>tail", "<div>q" * 300 + "</div>" * 300 + "end",
         "q " * 300 + "end"),
    ]
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(pages)], "i int, h string")
    got = df.select("i", html.element_html(F.col("h"), "div.message-body").alias("a"), html.element_text(F.col("h"), "div").alias("b"))
    assert [(r["a"], r["b"]) for r in got.orderBy("i").collect()] == [(a, b) for _, a, b in pages]


def test_entities_by_name_and_number(spark):
    df = spark.createDataFrame([("&#8217;&#x27;&eacute;&amp;lt;&bogus;&nbsp;&#0;&#55296;&#x1F600; & &;",), ("plain",), (None,)], "h string")
    got = [r["t"] for r in df.select(html.decode_entities(F.col("h")).alias("t")).collect()]
    assert got == ["’'é&lt;&bogus; ��\U0001F600 & &;", "plain", None]


def test_unique_sparse_keeps_equal_rows_without_a_key_in_one_scan(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 5), (None, 6)], "k string, id int")
    out = dedup.unique_sparse(df, "k", ["id"], ["id", "k"])
    assert sorted((r["k"] or "", r["id"]) for r in out.collect()) == [("", 5), ("", 5), ("", 6), ("a", 1)]
    one = catalog.queries()["unique_sparse"](spark, FOLDER)
    assert one._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_phrase_matches_agree_on_both_sides_of_every_switch(spark):
    docs = spark.createDataFrame(
        [(1, "xx The Quick brown fox jumps over it"), (2, "ab"), (2, "ab"), (3, None), (4, "")], "id int, text string")
    phrases = spark.createDataFrame(
        [("p", "quick brown fox jumps"), ("q", "aB"), ("r", "over it and more words"), ("s", ""), ("t", None)], "rule string, phrase string")
    want = {(1, "p"), (2, "q")}
    for sent in (0, 1 << 20):
        for literals in (0, 1000):
            found = joins.contains_by_grams(docs, "id", "text", phrases, "rule", "phrase", sent, literals)
            assert {tuple(r) for r in found.collect()} == want, (sent, literals)
    for limit in (0, 1000):
        assert {tuple(r) for r in joins.contains_matches(docs, "id", "text", phrases, "rule", "phrase", limit).collect()} == want


def test_no_text_moves_where_phrases_are_sent(spark):
    docs, items = readers.table(spark, FOLDER, "documents"), readers.table(spark, FOLDER, "benchmark").withColumnRenamed("text", "phrase")
    found = joins.contains_by_grams(docs, "doc_id", "text", items, "item_id", "phrase")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "strategy=broadcast" in plan


def test_export_keeps_blanks_quotes_and_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, ' lead, "q"\nnext '), (2, "x")], "i int, t string")
    writers.export_csv(df, str(tmp_path / "x"), ["i"])
    back = spark.read.schema("i int, t string").option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "x"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_suffixes_with_wildcards_and_exceptions(spark):
    listed = text.parse_suffixes(["// comment", "", "com", "*.ck", "!www.ck", "co.example"])
    assert listed == ["com", "*.ck", "!www.ck", "co.example"]
    cases = {"https://a.b.com/x": "b.com", "u@m.a.b.ck": "a.b.ck", "x.y.www.ck": "www.ck", "www.ck": "www.ck", "b.ck": "", "ck": "",
             "a.co.example": "a.co.example", "co.example": "", "com": "", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    got = {r["h"]: r["d"] for r in df.select("h", text.registered_domain(F.col("h"), listed).alias("d")).collect()}
    assert got == cases
    assert df.select(text.registered_domain(F.col("h"), []).alias("d")).distinct().collect()[0]["d"] == ""


def test_directories_count_children_and_bytes(spark, tmp_path):
    root = str(tmp_path / "tree")
    for name, size in (("a/x.txt", 3), ("a/b/y.txt", 5), ("a/b/z.txt", 7), ("c/w.txt", 1), ("top.txt", 2)):
        put(os.path.dirname(f"{root}/{name}"), os.path.basename(name), "q" * size)
    found = readers.catalog_files(spark, root, directories=True).collect()
    folders = {r["relative_path"]: (r["child_count"], r["file_size_bytes"], r["parent_path"], r["extension"]) for r in found if r["is_directory"]}
    assert folders == {"a": (2, 15, "", None), "a/b": (2, 12, "a", None), "c": (1, 1, "", None)}
    assert sum(not r["is_directory"] for r in found) == 5


def test_failed_rows_are_counted_and_not_written(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,), (3,)], "i int")
    assert writers.write_index(df, str(tmp_path / "i"), failed=F.col("i").isNull()) == {"written": 2, "failed": 1}
    assert spark.read.parquet(str(tmp_path / "i")).count() == 2


def test_ingest_is_idempotent(spark, tmp_path):
    registry = str(tmp_path / "registry")
    df = spark.createDataFrame([(1, "a,b"), (2, "c"), (3, "c"), (4, None)], "id int, content string")
    first = {r["id"] for r in jobs.ingest_into(df, registry, "id", "content", "one").collect()}
    assert {1, 2} <= first and 3 not in first
    assert {r["id"] for r in jobs.ingest_into(df, registry, "id", "content", "one").collect()} == first
    more = df.filter("id < 3").union(spark.createDataFrame([(9, "new")], df.schema))
    assert [r["id"] for r in jobs.ingest_into(more, registry, "id", "content", "two").collect()] == [9]
    stored = spark.read.parquet(registry)
    assert stored.filter("sha256 IS NOT NULL").count() == 3 and {r["status"] for r in stored.collect()} == {"processed"}


def test_filename_records_come_before_suffix_and_list_check(spark):
    records = [{"pattern": r"^orders_.*\.txt$", "parser": "structured_table", "delimiter": "|", "header": False, "columns": {0: "user_id", 2: "currency"}},
               {"pattern": "^notes", "parser": "list"}]
    sample = "\n".join(f"user{i}@example.com:secret{i}" for i in range(30))
    df = spark.createDataFrame([(1, "in/Orders_1.txt", "x"), (2, "in/notes.csv", "x"), (3, "in/other.txt", sample), (4, "in/z.csv", "a,b")],
                               "i int, path string, s string")
    got = jobs.classify_file(df, "path", F.col("s"), records, 0.7)
    assert {r["i"]: r["parser"] for r in got.collect()} == {1: "structured_table", 2: "list", 3: "credential_list", 4: "structured_table"}
    record = df.select(inference.filename_record(F.lit("orders_7.txt"), records).alias("r")).first()["r"]
    assert (record["delimiter"], record["header"], record["columns"]) == ("|", False, {0: "user_id", 2: "currency"})
