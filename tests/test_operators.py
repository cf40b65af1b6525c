"""Operators on small invented tables, against brute force where order or skew matters."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from exposura import rules
from exposura.operators import aggregates, dedup, filters, inference, joins, ordering, projections, windows
from exposura.plans import jobs
from exposura.sinks import writers
from exposura.sources import readers


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """(id, k, s): a third of all rows under one key, another third under NULL."""
    rng = random.Random(7)
    data = [(i, None if i % 3 == 0 else ("hot" if i % 3 == 1 else f"k{rng.randrange(50)}"), rng.randrange(9)) for i in range(3000)]
    return data, spark.createDataFrame(data, "id long, k string, s long").repartition(8)


def test_first_and_latest_under_a_hot_key(skewed):
    data, df = skewed
    first, last = {}, {}
    for i, k, s in data:
        first.setdefault(k, (i, s))
        last[k] = (i, s)
    got = windows.first_per_key(df, ["k"], ["id"], ["k", "id", "s"])
    assert {r.k: (r.id, r.s) for r in got.collect()} == first
    got = windows.latest_per_key(df, ["k"], ["id"], ["k", "id", "s"])
    assert {r.k: (r.id, r.s) for r in got.collect()} == last


def test_best_by_score_keeps_the_first_of_equals(skewed):
    data, df = skewed
    best = {}
    for i, k, s in data:
        if k not in best or s > best[k][1]:
            best[k] = (i, s)
    got = windows.best_by_score(df, ["k"], "s", "id", ["k", "id", "s"])
    assert {r.k: (r.id, r.s) for r in got.collect()} == best


def test_unique_sparse_keeps_rows_without_key(skewed):
    data, df = skewed
    want = {}
    for i, k, _ in data:
        want.setdefault(k if k is not None else ("null", i), i)
    got = dedup.unique_sparse(df, "k", ["id"], ["id", "k"])
    assert sorted(r.id for r in got.collect()) == sorted(want.values())


def test_block_numbers_across_ranges(skewed):
    data, df = skewed
    blocks, want = defaultdict(int), {}
    for i, k, s in data:
        blocks[k] += s == 0
        want[i] = blocks[k]
    got = windows.block_numbers(df, "k", ["id"], F.col("s") == 0)
    keyed = {i: b for i, b in want.items() if data[i][1] is not None}
    assert {r.id: r.block_id for r in got.collect()} == keyed | {
        r.id: r.block_id for r in got.filter("k is null").collect()
    }
    assert got.filter("k is not null").count() == len(keyed)


def test_first_names_of_a_hot_group(skewed):
    data, df = skewed
    named = df.withColumn("name", F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 5, "0")))
    want = defaultdict(list)
    for i, k, _ in data:
        want[k].append(f"n{i:05d}")
    got = {r.k: r.names for r in aggregates.first_names(named, "k", "name").collect()}
    assert got == {k: sorted(v)[:20] for k, v in want.items()}


def test_insert_or_ignore(spark):
    old = spark.createDataFrame([(1, "a")], "id long, v string")
    new = spark.createDataFrame([(1, "b"), (2, "d"), (2, "c")], "id long, v string")
    assert rows(dedup.insert_or_ignore(old, new, ["id"], ["v"])) == [(1, "a"), (2, "c")]


def test_upsert_newest_wins_and_late_rows_lose(spark):
    old = spark.createDataFrame([(1, 5, "a"), (2, 5, "a"), (3, 5, "a")], "id long, t long, v string")
    new = spark.createDataFrame([(1, 6, "b"), (2, 4, "b"), (3, 5, "b")], "id long, t long, v string")
    assert rows(dedup.upsert(old, new, ["id"], ["t"])) == [(1, 6, "b"), (2, 5, "a"), (3, 5, "b")]


def test_entry_dedup_drops_blank_titles(spark):
    df = spark.createDataFrame([(1, "s", "A"), (2, "s", "a"), (3, "s", " "), (4, "t", "a"), (5, "s", None)], "id long, site string, title string")
    assert rows(dedup.entry_dedup(df, "site", "title", ["id"], ["id", "site", "title"]), "id") == [(1,), (4,)]


def test_keywords(spark):
    assert dedup.parse_keywords(["# c", "", " Data Leak ", "dump"]) == ["data leak", "dump"]
    df = spark.createDataFrame([(1, None, "A DATABASE leaked"), (2, "x", None), (3, "sql", "dump")], "id long, t string, c string")
    got = {r.id: r.matched_keywords for r in dedup.keyword_flag(df, "t", "c").collect()}
    assert got == {1: ["database", "leak", "leaked"], 2: [], 3: ["dump", "sql dump"]}
    assert rows(dedup.keyword_flagged(df, "t", "c"), "id") == [(1,), (3,)]


def test_flagging_twice_adds_nothing(spark):
    t = spark.createDataFrame([("h1", "dump", "x"), (None, "dump", "x"), ("h2", "prose", "x")], "dedup_hash string, title string, content string")
    empty = t.select("dedup_hash").limit(0)
    once = jobs.flag_incremental(t, empty)
    assert [r.dedup_hash for r in once.collect()] == ["h1"]
    assert jobs.flag_incremental(t, once).count() == 0


@pytest.mark.parametrize("phrases", [["abc", "b c", "zz"], ["lorem ipsum dolor", "dolor sit amet con", "quux quux quux"]])
def test_grams_find_what_substring_search_finds(spark, phrases):
    rng = random.Random(3)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "con", "abc", "ab", "c", "zz", "Ünï", "quux"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 40))) for _ in range(120)] + ["", "abc", "LOREM IPSUM DOLOR"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    keys = spark.createDataFrame(list(enumerate(phrases)), "pid long, phrase string")
    want = sorted((i, p) for i, t in enumerate(texts) for p, k in enumerate(phrases) if k in t.lower())
    assert rows(joins.contains_by_grams(docs, "id", "text", keys, "pid", "phrase")) == want
    assert rows(joins.contains_matches(docs, "id", "text", keys, "pid", "phrase")) == want
    assert rows(joins.contains_matches(docs, "id", "text", keys, "pid", "phrase", limit=1)) == want


def test_collision_rules_differ(spark):
    df = spark.createDataFrame([("", "b@example.com")], "email string, mail string")
    assert projections.remap_columns(df).first().email == "b@example.com"
    df = spark.createDataFrame([("a", "b", "", "null")], "payment_country string, payment_country_code string, revenue_country string, currency string")
    got = projections.normalize_transaction(df).first()
    assert (got.country, got.currency) == ("b", None)


def test_unknown_and_ignored_names_stay(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_src long, odd long, junk long")
    assert projections.remap_columns(df, {"junk": "ignore"}).columns == ["_src", "odd", "junk"]


def test_identity_carries_no_secret(spark):
    df = spark.createDataFrame([("A@example.com", "invented-word", "EG")], "email string, password string, country string")
    got = projections.normalize_identity(df, "p")
    assert got.columns == ["email_hash", "secret_kind", "extra_data"]
    row = got.first()
    assert row.secret_kind == "plaintext" and row.extra_data == {"country": "EG"}
    assert "invented-word" not in str(row) and "example.com" not in str(row)


def test_rejects_hold_no_line(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "")], "n long, line string")
    got = writers.reject_rows(df, "n", F.col("line"), F.when(F.col("line") == "", "empty").when(F.length("line") > 2, "long"))
    assert got.columns == ["n", "reason", "line_length"]
    assert rows(got) == [(1, "long", 3), (2, "empty", 0)]


def test_risk_score_ties_go_to_even(spark):
    counts = [("a", "password", 2), ("a", "cookie", 50), ("b", "password", 1), ("b", "cookie", 50), ("c", "cookie", 5000),
              ("d", "password", 99), ("d", "token", 1), ("d", "card", 7), ("d", "cookie", 9999), ("d", "autofill", 999), ("e", "other", 1)]
    df = spark.createDataFrame(counts, "host string, kind string, n long")
    got = dict(rows(aggregates.risk_score(df, "host", "kind", "n", rules.RISK_WEIGHTS_A)))
    assert got == {"a": 0.2, "b": 0.2, "c": 1.0, "d": 7.5, "e": 0.0}
    heavy = [(k, 0.0, 0.0, 4.0) for k in ("password", "token", "card")]
    assert dict(rows(aggregates.risk_score(df, "host", "kind", "n", heavy)))["d"] == 10.0


def test_skip_rate_of_nothing_is_zero(spark):
    df = spark.createDataFrame([], "a long")
    assert tuple(aggregates.skip_rate(df, F.col("a") > 0).first()) == (0, 0, 0.0)


def test_date_range_includes_the_end_day(spark):
    from exposura.functions.times import in_days

    df = spark.sql("select timestamp_ntz'2024-01-02 23:59:59.999' t union all select timestamp_ntz'2024-01-03 00:00:00'")
    assert df.filter(in_days(F.col("t"), end="2024-01-02")).count() == 1
    assert df.filter(in_days(F.col("t"))).count() == 2


def test_notable_processes(spark):
    df = spark.createDataFrame([("SvcHost.exe", 1), ("Tool.exe", 9), ("tool.EXE", 4), ("CrashHandler64", 2), ("b.exe", 3)], "name string, pid long")
    assert [tuple(r) for r in filters.notable_processes(df).collect()] == [("b.exe", 3), ("tool.EXE", 4)]


def test_taxonomy(spark):
    df = spark.createDataFrame([("Google Chrome",), ("Google Chrome",), ("Chrome runtime",), ("AMD Chipset Driver",), ("AMD Driver",), ("Other",)], "n string")
    got = rows(joins.taxonomy_label(df, "n", rules.SOFTWARE_CATEGORIES, rules.SOFTWARE_EXCLUDED))
    assert got == [("AMD Chipset Driver", "other"), ("Google Chrome", "browser")]


@pytest.mark.parametrize("line, want", [("a;b,c", ";"), ("a\tb", "\t"), ("a,b,c;d", ","), ("a", ","), ("a|b", "|")])
def test_sniff_delimiter(one, line, want):
    assert one(inference.sniff_delimiter, line) == want


@pytest.mark.parametrize("line, want", [
    ("id,email,phone", False), ("12,a@example.com,x", True), ("email,12,c,d", False), ("x,12,c,d", True), ("", False), ("a,b", False),
])
def test_headerless(one, line, want):
    assert one(lambda c: inference.is_headerless(c, F.lit(",")), line) is want


@pytest.mark.parametrize("name, want", [
    ("customer_email", "email"), ("Mobile", "phone"), ("emails", "ignore"), ("billing_address", "address"),
    ("order_id", "purchase_ref"), ("user_id", "user_id"), ("grand_total", "charge_amount"),
])
def test_classify_column(one, name, want):
    assert one(inference.classify_column, name) == want


def test_learn_aliases_upgrades_only_ignore(spark):
    old = spark.createDataFrame([("a", "city"), ("b", "ignore"), ("e", "ip")], "name string, target string")
    new = spark.createDataFrame([("A", "email"), ("b", "email"), ("c", "ignore"), ("123", "phone"), ("x@example.com", "email")], "name string, target string")
    assert rows(inference.learn_aliases(old, new)) == [("a", "city"), ("b", "email"), ("c", "ignore"), ("e", "ip")]


def test_columns_from_ddl(one):
    body = "`id` int, `key` text, name varchar(10) default 'a,b', d decimal(10,2), PRIMARY KEY (`id`), key k (name), check (d > (1))"
    assert one(inference.columns_from_ddl, body) == ["id", "key", "name", "d"]


@pytest.mark.parametrize("body, want", [
    ("a,b,c,d,e,f,g,h\n" * 3, "table"), ("x:y\nz:w", "list"), ("https://example.org/a", "undecided"), ("# only\n", "list"),
])
def test_csv_vs_list(one, body, want):
    assert one(inference.csv_vs_list, body) == want


def test_pages_are_consecutive(spark):
    df = spark.range(25).withColumn("d", F.col("id") % 5)
    pages = [ordering.recent_page(df, [F.desc("d"), F.col("id")], p, 10, ["id", "d"]).collect() for p in (1, 2, 3)]
    assert [len(p) for p in pages] == [10, 10, 5]
    assert len({r.id for p in pages for r in p}) == 25 and {r.total for p in pages for r in p} == {25}


def test_search_limit_is_held_within_bounds(spark):
    from exposura.catalog import views
    from conftest import FOLDER

    m = views.messages(spark, FOLDER)
    assert filters.advanced_search(m, limit=0).count() == 1
    assert filters.advanced_search(m, limit=10**6).count() == min(500, m.count())


@pytest.mark.parametrize("raw, want", [
    (b"\xef\xbb\xbfa", "utf-8-sig"), (b"\xff\xfea\x00", "utf-16"), ("é".encode(), "utf-8"), (b"caf\xe9 x", "cp1256"),
    (b"", "utf-8"), (b"a" * 65535 + b"\xe9", "cp1256"), (b"a" * 65535 + "é".encode(), "utf-8"),
])
def test_encoding(spark, raw, want):
    df = spark.createDataFrame([(bytearray(raw),)], "c binary")
    assert df.select(readers.detect_encoding(F.col("c"))).first()[0] == want


def test_magic(spark):
    from exposura.functions.files import is_executable_magic

    df = spark.createDataFrame([(bytearray(b),) for b in (b"\x7fELF..", b"MZ", b"#!/bin/sh", b"text", b"")], "c binary")
    assert [r[0] for r in df.select(is_executable_magic(F.col("c"))).collect()] == [True, True, True, False, False]


def test_ragged_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a;b;c\n1;2\n1;2;3;4\n")
    got = readers.read_delimited(spark, str(tmp_path), ";", ["a", "b", "c"]).fillna("")
    assert rows(got) == [("1", "2", ""), ("1", "2", "3")]


def test_jsonl_skips_what_is_no_record(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text('# c\n// c\n{"id": 1}\n{"id": \n[{"id": 2}, {"id": 3}]\n\nplain\n')
    assert rows(readers.read_jsonl(spark, str(tmp_path), readers.T.StructType().add("id", "long"))) == [(1,), (2,), (3,)]


def test_catalog_skips_directories(spark, tmp_path):
    for name in ("a/x.TXT", "a/.git/y.txt", "z.tar.gz"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("12345")
    got = rows(readers.catalog_files(spark, str(tmp_path)), "relative_path", "extension", "file_size_bytes", "depth_level")
    assert got == [("a/x.TXT", ".txt", 5, 2), ("z.tar.gz", ".gz", 5, 1)]


def test_batch_dir_skips_hidden_files(spark, tmp_path):
    for name in ("x.csv", ".hidden", "~tmp", "b/y.csv"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("1")
    assert readers.scan_batch_dir(spark, str(tmp_path)).count() == 2


def test_run_log_drops_short_lines(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00 [INFO] a b c",), ("short line here",)], "value string")
    assert rows(readers.read_run_log(df)) == [("2024-01-01 00:00:00", "INFO", "a b c")]


def test_dead_letters(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "file_path string")
    good, dead = writers.split_dead_letters(df, "file_path")
    assert (good.count(), dead.count()) == (1, 2)


def test_write_index_counts_what_it_writes(spark, tmp_path):
    assert writers.write_index(spark.range(17), str(tmp_path / "t")) == {"written": 17}


def test_reading_a_channel_scans_its_bucket_only(spark, tmp_path):
    from exposura.sinks.writers import write_messages

    path = str(tmp_path / "m")
    write_messages(spark.range(500).select(F.col("id").alias("channel"), F.lit(1).alias("message_id")), path)
    one = readers.read_messages(spark, path, [3])
    assert [r.channel for r in one.collect()] == [3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "PushedFilters: [IsNotNull(channel), EqualTo(channel,3)]" in plan
    assert readers.read_messages(spark, path).count() == 500
    assert sorted(r.channel for r in readers.read_messages(spark, path, [3, 4, 499, 10**9]).collect()) == [3, 4, 499]


def test_routing_as_literals_and_as_join_agree(spark, monkeypatch):
    rules_df = spark.createDataFrame([("d1", "text"), ("d2", "text"), ("d2", "image")], "destination string, kind string")
    df = spark.createDataFrame([(1, "text"), (2, "image"), (3, "video"), (4, None)], "id long, k string")
    literal = rows(joins.content_route(df, rules_df, F.col("k")), "id", "destination", "kind")
    assert literal == [(1, "d1", "text"), (1, "d2", "text"), (2, "d2", "image")]
    monkeypatch.setattr(joins, "small_rules", lambda table: None)
    assert rows(joins.content_route(df, rules_df, F.col("k")), "id", "destination", "kind") == literal
