"""Cases of this round: quoted fields, catalogs of dumps, markup, encodings, deep pages, sketches, buckets, digests."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from exposura.functions import sensitive, text
from exposura.session import DEMO_PEPPER
from exposura.streaming import jobs as s


def test_quoted_fields_equal_a_csv_reader(spark):
    rng = random.Random(4)
    cells = ['a', '', '"x, y"', '"say ""hi"""', 'b "c" d', '" "', '5"', '"a"b', "'q, r'", "é"]
    lines = [",".join(rng.choice(cells) for _ in range(rng.randrange(1, 7))) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    for r in df.select("line", text.quoted_fields(F.col("line")).alias("f")).collect():
        assert r["f"] == (next(csv.reader([r["line"]]), []) or [""]), r["line"]
    tabs = spark.createDataFrame([('"a\tb"\tc|d',), ("x|y",)], "line string")
    got = tabs.select(text.quoted_fields(F.col("line"), "\t").alias("t"), text.quoted_fields(F.col("line"), "|").alias("p")).collect()
    assert got[0]["t"] == ["a\tb", "c|d"] and got[1]["p"] == ["x", "y"]


def test_quoted_commas_do_not_shift_identities(spark):
    lines = spark.createDataFrame([('1,"Doe, Jo",a@example.com,+15550109999',), ("id,name,email,phone",), ('2,"x""y",B@example.org,',)], "line string")
    got = s.normalize_lines(lines, "line", "id,name,email,phone", DEMO_PEPPER).collect()

    def keyed(x):
        return spark.range(1).select(sensitive.keyed_hash(F.lit(x), DEMO_PEPPER)).first()[0]

    assert {r["email_hash"] for r in got} == {keyed("a@example.com"), keyed("b@example.org")}
    assert {r["phone_hash"] for r in got} == {keyed("+15550109999"), None}
    assert {r["username_hash"] for r in got} == {keyed("Doe, Jo"), keyed('x"y')}
    assert s.header_columns('"Id","last, first", E-mail ') == ["id", "last, first", "e-mail"]


def test_markup_knows_comments_raw_text_and_depth(spark):
    from exposura.functions import html

    page = """<body><!-- <article>no</article> --><script>"<article>"</script><div class='a b' title="x > y"><article>one <!-- </article> --> <b>two</b>
<article>in</article></article></div><p>it's <!-->here</p><article title=don't>last<br/> <style>p{}</style></article><article>open"""
    df = spark.createDataFrame([(page,)], "h string")
    got = df.select(
        html.element_html(F.col("h"), "article").alias("first"), html.elements_html(F.col("h"), "article").alias("all"),
        html.element_text(F.col("h"), "div.b").alias("b"), html.element_text(F.col("h"), "div.c").alias("c"),
        html.element_text(F.col("h"), "div[title*=>], p").alias("t"), html.strip_html(F.col("h")).alias("text"),
        F.array_join(html.tokens(F.col("h")), "").alias("whole"),
        html.attribute(F.col("h"), "div", "title").alias("title"), html.attribute(F.col("h"), "article[title*='t']", "title").alias("bare")).first()
    assert got["first"] == "one <!-- </article> --> <b>two</b>\n<article>in</article>"
    assert [x[:4] for x in got["all"]] == ["one ", "last", "open"]
    assert got["b"] == "one two in" and got["c"] == "" and got["t"] == "one two in" and got["whole"] == page
    assert got["text"] == "one two in it's here last open" and got["title"] == "x > y" and got["bare"] == "don't"


def test_two_layouts_with_nested_cards(spark):
    from exposura.plans import jobs

    rows = [("https://blog.example.com/a", '<ul><li><a href="/1">One</a><ul><li>deep</li></ul> tail</li><li>no link</li></ul>'),
            ("https://example.org/b", '<div class="x box"><h2>Two</h2><div>in<div>ner</div></div><p>text</p><a href="https://example.org/2">go</a></div>')]
    df = spark.createDataFrame(rows, "url string, html string")
    found = jobs.extract_entries(df, "url", "html", [("blog.", {"card": "li", "title": "a", "link": "a"}),
                                                    ("example", {"card": "div.box", "title": "h1,h2", "link": "a", "text": "p"})])
    assert sorted(map(tuple, found.collect())) == [
        ("https://blog.example.com/a", 0, "One", "/1", "One deep tail"), ("https://blog.example.com/a", 1, "", "", "no link"),
        ("https://example.org/b", 0, "Two", "https://example.org/2", "text")]


def test_suffix_table_equals_the_literal_form(spark):
    """Ten thousand rules as data and as literals; the plan does not grow with them."""
    from exposura.operators import joins

    rng = random.Random(5)
    parts = ["a", "b", "c", "co", "uk", "com", "x"]
    listed = ["com", "uk", "co.uk", "*.b", "!a.b", "*.x.com", "c.x"] + [f"s{k}.{rng.choice(parts)}" for k in range(10_000)]
    hosts = [".".join(rng.choice(parts + [f"s{rng.randrange(10_000)}"]) for _ in range(rng.randrange(1, 6))) for _ in range(400)]
    df = spark.createDataFrame([(k, f"https://{h}:80/p" if k % 2 else h) for k, h in enumerate(hosts)] + [(-1, None), (-2, "")], "k int, h string")
    table = spark.createDataFrame([(x,) for x in listed], "suffix string")
    got = {r["k"]: r["domain"] for r in joins.registered_domains(df, "h", table).collect()}
    want = {r["k"]: r["d"] for r in df.select("k", text.registered_domain(F.col("h"), listed).alias("d")).collect()}
    assert got == want

    def length(n):
        rules = table.limit(n)
        return len(joins.registered_domains(df, "h", rules)._jdf.queryExecution().optimizedPlan().toString())

    assert length(10_000) < length(10) + 200


def test_deep_pages_equal_a_sort(spark):
    from exposura.operators import ordering

    rng = random.Random(6)
    rows = [(rng.choice([None, 1.0, 2.5, 2.5, 9.0]), rng.choice([None, "a", "b", "c"]), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "d double, s string, id int").repartition(5)
    order = [F.desc("d"), F.col("s"), F.desc("id")]
    whole = [tuple(r) for r in df.orderBy(*order).collect()]
    for page, size in ((1, 10), (100, 20), (150, 20), (151, 20), (7, 400)):
        got = ordering.deep_page(df, ["-d", "s", "-id"], page, size, ["d", "s", "id"], ranges=8, rows_per_range=60)
        assert [tuple(r)[:3] for r in got.collect()] == whole[(page - 1) * size:page * size]
    assert ordering.deep_page(df.limit(0), ["id"], 3, 10, ["id"]).count() == 0
    same = spark.range(500).select(F.lit(1).alias("a"), "id")
    assert [r["id"] for r in ordering.deep_page(same, ["a", "id"], 40, 10, ["id", "a"], ranges=4, rows_per_range=20).collect()] == list(range(390, 400))


def test_report_levels_exact_and_by_sketches(spark):
    from exposura.plans import jobs

    rng = random.Random(7)
    rows = [(rng.choice("ab"), rng.choice(["x", None]), rng.randrange(3), f"d{rng.randrange(9000)}", rng.randrange(5)) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "kind string, forum string, day int, domain string, n int")
    by = ["kind", "forum", "day"]
    want = sorted(map(tuple, df.rollup(*by).agg(F.sum("n").alias("n"), F.countDistinct("domain").alias("n_domains")).collect()), key=repr)
    exact = jobs.exposure_report(df, by)
    assert sorted(map(tuple, exact.collect()), key=repr) == want
    assert "Expand" not in exact._jdf.queryExecution().executedPlan().toString()
    near = sorted(map(tuple, jobs.exposure_report(df, by, approximate=True).collect()), key=repr)
    assert len(near) == len(want)
    totals = {r[:3] + (r[3],): r[4] for r in want if want.count(r) == 1}
    for r in near:
        if r[:4] in totals:
            assert abs(r[4] - totals[r[:4]]) <= max(2, 0.065 * totals[r[:4]])


def test_a_folder_of_encodings_reads_as_one_table(spark, tmp_path):
    from exposura.sources import readers

    lines = ["first", "café ê", "", "last ü"]
    arabic = ["سلام", "كتاب x", "é"]
    (tmp_path / "a.txt").write_bytes(("\n".join(lines) + "\n").encode("utf-8"))
    (tmp_path / "b.txt").write_bytes(("\r\n".join(lines) + "\r\n").encode("utf-8-sig"))
    (tmp_path / "c.txt").write_bytes("\n".join(arabic).encode("cp1256"))
    (tmp_path / "d.txt").write_bytes(("\n".join(lines + ["ਊ਀", "ĊĀ"]) + "\n").encode("utf-16"))
    (tmp_path / "e.txt").write_bytes(b"\xfe\xff" + ("\n".join(lines) + "\n").encode("utf-16-be"))
    (tmp_path / "f.txt").write_bytes(b"")
    (tmp_path / "g.txt").write_bytes(bytes(range(128, 256)) + b"\n")
    got = {}
    for r in readers.read_encoded_lines(spark, str(tmp_path)).collect():
        got.setdefault((r["file"][-5:], r["encoding"]), []).append(r["line"])
    want = {("a.txt", "utf-8"): lines, ("b.txt", "utf-8"): lines, ("c.txt", "cp1256"): arabic,
            ("d.txt", "utf-16"): lines + ["ਊ਀", "ĊĀ"], ("e.txt", "utf-16"): lines, ("g.txt", "cp1256"): [bytes(range(128, 256)).decode("cp1256")]}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_block_numbers_write_no_row_and_spread_a_hot_key(spark):
    from exposura.operators import windows

    rng = random.Random(9)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), rng.choice([None, 1, 2, 3]), k, rng.random() < 0.1, f"wide{k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "k string, o int, id int, s boolean, w string").repartition(6)
    got = windows.block_numbers(df, "k", ["o", "id"], F.col("s"), rows_per_range=100)
    want, seen = {}, {}
    for k, o, i, s_, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        seen[k] = seen.get(k, 0) + int(s_)
        want[i] = seen[k]
    assert {r["id"]: r["block_id"] for r in got.collect()} == want
    assert got.columns == df.columns + ["block_id"] and "wide" not in plan(got)
    borders = windows.range_borders(df, ["k", "o", "id"], 16)
    counts = [r["count"] for r in df.groupBy(windows.range_number(df, ["k", "o", "id"], borders).alias("r")).count().collect()]
    assert len(counts) > 10 and max(counts) < 3 * 3000 / 16


def test_a_copy_two_batches_later_gives_no_row(spark, tmp_path):
    import shutil

    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()

    def arrive(name, body=None, of=None):
        if of:
            shutil.copy(f"{folder}/{of}", f"{folder}/{name}")
        else:
            (tmp_path / "in" / name).write_text(body)
        s.append_to(s.dir_watch(spark, folder, "*.txt", once_within="1 hour"), out, checkpoint)

    arrive("a.txt", "one\ntwo\n")
    arrive("b.txt", "three\n")
    arrive("c.txt", of="a.txt")
    arrive("d.txt", "one\ntwo\nmore")
    assert sorted(r["line"] for r in spark.read.parquet(out).collect()) == ["more", "one", "one", "three", "two", "two"]


def test_buckets_merge_without_an_exchange(spark, tmp_path):
    from exposura.sinks import bucketed

    path, name, layout = str(tmp_path / "t"), "kept_rows", {"buckets": 4, "parts": 4}
    bucketed.create(spark, name, path, "k BIGINT, v BIGINT, w STRING", ["k"], **layout)
    try:
        def put(rows, batch):
            bucketed.append(spark.createDataFrame(rows, "k long, v long, w string"), name, ["k"], ["v"], batch, **layout)

        def stored():
            return sorted(map(tuple, bucketed.latest(spark, name, ["k"], ["v"]).collect()))

        put([(k, 1, "a") for k in range(100)] + [(3, 0, "old")], 0)
        assert bucketed.compact(spark, name, ["k"], ["v"], 4) == [0, 1, 2, 3]
        put([(3, 2, "b"), (3, 5, "c"), (200, 1, "n")], 1)
        put([(3, 5, "d")], 2)
        put([(3, 5, "d")], 2)
        want = sorted([(k, 1, "a") for k in range(100) if k != 3] + [(3, 5, "d"), (200, 1, "n")])
        assert stored() == want
        assert "Exchange" not in plan(bucketed.latest(spark, name, ["k"], ["v"]))
        before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
        touched = bucketed.compact(spark, name, ["k"], ["v"], 4)
        assert 1 <= len(touched) <= 2 and stored() == want and spark.table(name).count() == len(want)
        rest = [f for f in before if int(f.parent.name.split("=")[1]) not in touched]
        assert rest and all(f.exists() and f.stat().st_mtime_ns == before[f] for f in rest)
        assert bucketed.compact(spark, name, ["k"], ["v"], 4) == []
        spark.sql(f"DROP TABLE {name}")
        bucketed.create(spark, name, path, "k BIGINT, v BIGINT, w STRING", ["k"], **layout)
        assert stored() == want
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


CANARIES = {
    "email": "canary.one@example.com", "phone": "+1 555 010 4477", "local": "(555) 010-8866", "ip": "192.0.2.77", "ip6": "2001:db8::77",
    "card": "4111 1111 1111 1111", "aws": "AKIA" + "CANARYCANARY1234", "hub": "ghp_" + "c4n4ry" * 6, "hex": "c0ffee" * 6,
    "service": "sk_live_c4naryc4naryc4nary", "jwt": "eyJjYW5hcnkx.eyJjYW5hcnky.Y2FuYXJ5Mw", "bearer": "Bearer canary.token-4455",
    "quoted": "my canary word", "single": "other canary word", "bare": "canaryword99", "block": "CANARYBLOCKAAAA",
}


def test_no_canary_survives_redaction_and_every_kind_is_counted(spark):
    from exposura.plans import jobs

    c = CANARIES
    body = (f"mail {c['email']} call {c['phone']} or {c['local']} from {c['ip']} {c['ip6']} card {c['card']}\n{c['aws']} {c['hub']} {c['hex']} {c['service']}\n"
            f"{c['jwt']} Authorization: {c['bearer']}\npassword: \"{c['quoted']}\" api-key='{c['single']}' secret={c['bare']}\n"
            f"-----BEGIN EC PRIVATE KEY-----\n{c['block']}\n-----END EC PRIVATE KEY-----\nplain text stays")
    df = spark.createDataFrame([(1, body), (2, None), (3, "")], "k int, t string")
    out = {r["k"]: r["t"] for r in jobs.redact(df, "t").collect()}
    for name, value in CANARIES.items():
        assert value not in out[1] and value.split()[-1] not in out[1], name
    assert out[1].endswith("plain text stays") and out[2] is None and out[3] == ""
    counts = {r["k"]: r.asDict() for r in jobs.pii_scan(df, "k", "t").collect()}
    assert counts[1] == {"k": 1, "n_email": 1, "n_phone": 2, "n_ip": 2, "n_card": 1, "n_key": 5, "n_token": 2, "n_secret": 3}
    assert all(counts[3][n] == 0 for n in counts[3] if n != "k")


def test_a_table_header_is_no_credential_list(one):
    from exposura.operators import inference

    rows = "1 ann 5550\n2 bob 5551\n"
    assert one(inference.list_share, "id\tfirst_name\tphone\n" + rows) == 0.0
    assert one(inference.list_share, "a;billing_city\n" + rows) == 0.0
    assert one(inference.list_share, "identity\tname\n" + rows) == 1.0
    assert one(inference.list_share, rows) == 1.0 and one(inference.list_share, "") == 0.0
